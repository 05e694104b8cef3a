"""An adaptive radix tree over byte keys, and its walk at fixed-width steps.

Nodes compress the bytes that all their keys share into a prefix and keep their children in a layout that
grows with them: 4 or 16 sorted bytes, an index of 256 bytes to 48 slots, or 256 slots.  A key may be a prefix of
others; its value then lies at an inner node.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to ``room`` (4 or 16) children by their sorted first bytes."""

    __slots__ = ("room", "bytes", "slots")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.slots = room, bytearray(), []

    def find(self, byte: int):
        at = bisect_left(self.bytes, byte)
        return self.slots[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def add(self, byte: int, child):
        """The layout that holds the new child, too: this one or the next larger."""
        if len(self.bytes) == self.room:
            grown = Sorted(16) if self.room == 4 else Indexed()
            for b, c in self.items():
                grown = grown.add(b, c)
            return grown.add(byte, child)
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.slots.insert(at, child)
        return self

    def items(self) -> Iterator:
        return zip(self.bytes, self.slots)


class Indexed:
    """Up to 48 children; a byte's entry of the index is its slot plus one."""

    __slots__ = ("index", "slots")

    def __init__(self):
        self.index, self.slots = bytearray(256), []

    def find(self, byte: int):
        return self.slots[self.index[byte] - 1] if self.index[byte] else None

    def add(self, byte: int, child):
        if len(self.slots) == 48:
            grown = Direct()
            for b, c in self.items():
                grown = grown.add(b, c)
            return grown.add(byte, child)
        self.slots.append(child)
        self.index[byte] = len(self.slots)
        return self

    def items(self) -> Iterator:
        return ((b, self.slots[s - 1]) for b, s in enumerate(self.index) if s)


class Direct:
    """A slot for each byte."""

    __slots__ = ("slots",)

    def __init__(self):
        self.slots = [None] * 256

    def find(self, byte: int):
        return self.slots[byte]

    def add(self, byte: int, child):
        self.slots[byte] = child
        return self

    def items(self) -> Iterator:
        return ((b, c) for b, c in enumerate(self.slots) if c is not None)


class Node:
    __slots__ = ("prefix", "children", "value")

    def __init__(self, prefix: bytes = b"", value=None):
        self.prefix, self.children, self.value = prefix, None, value

    def split(self, at: int) -> None:
        """Cut the prefix: what follows byte ``at`` of it becomes the only child."""
        lower = Node(self.prefix[at + 1:], self.value)
        lower.children = self.children
        self.children = Sorted().add(self.prefix[at], lower)
        self.prefix, self.value = self.prefix[:at], None


def _shared(a: bytes, b: bytes) -> int:
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


class Tree:
    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value) -> None:
        """Put ``value`` at ``key``; a value that is there is replaced."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at = self.root, 0
        while True:
            size = len(node.prefix)
            if not key.startswith(node.prefix, at):
                size = _shared(node.prefix, key[at:at + size])
                node.split(size)
            at += size
            if at == len(key):
                node.value = value
                return
            child = node.children.find(key[at]) if node.children is not None else None
            if child is None:
                node.children = (node.children or Sorted()).add(key[at], Node(key[at + 1:], value))
                return
            node, at = child, at + 1

    def walk(self, width: int) -> Iterator[tuple]:
        """(enter, depth, chain, value) at every multiple of ``width`` bytes on a path, top down by byte order.

        ``enter`` is true before what lies below a position and false after it; ``depth`` counts steps of ``width`` bytes, from
        0; ``chain`` names the path: the digest of the path's name one step above and of the step's bytes.  ``value`` is that of a
        key that ends there.  Positions inside a step are passed over.
        """
        if self.root is None:
            return
        path = bytearray()
        chains: list[bytes] = []
        todo: list = [(self.root, b"")]
        while todo:
            node, edge = todo.pop()
            if node is None:  # all below is done: leave the positions of this span, from the lowest
                size, positions = edge
                for depth, value in reversed(positions):
                    yield False, depth, chains.pop(), value
                del path[size:]
                continue
            size = len(path)
            path += edge + node.prefix
            positions = []
            for depth in range(0 if node is self.root else size // width + 1, len(path) // width + 1):
                end = depth * width
                value = node.value if end == len(path) else None
                above = chains[-1] if chains else b""
                chains.append(hashlib.sha256(above + path[end - width:end]).digest()[:16] if depth else b"root")
                positions.append((depth, value))
                yield True, depth, chains[-1], value
            todo.append((None, (size, positions)))
            if node.children is not None:
                todo += [(child, bytes([byte])) for byte, child in reversed(list(node.children.items()))]
