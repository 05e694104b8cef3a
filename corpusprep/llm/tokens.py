"""Words, lines and hashes of whole texts as numpy arrays, for Arrow batches.

Used inside ``mapInArrow``: Spark deals out the rows, and a task holds one block of
texts (``BLOCK_BYTES``, or one longer text) at a time.  Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GAMMA = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_BYTES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_GAMMA))

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


class Block:
    """Texts one after the other: ``data`` bytes, text i at ``offsets[i]:offsets[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.n = len(offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the first word of each text (n + 1 entries)."""
        return segments(self, ~SEPARATOR[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all lines (split at \\n, empty ones included), and the first line of each text."""
        breaks = np.flatnonzero(self.data == 10)
        # a line begins at each text's start and after each break
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        owner = np.concatenate([np.arange(self.n), np.searchsorted(self.offsets, breaks, "right") - 1])
        order = np.lexsort((starts, owner))
        starts, owner = starts[order], owner[order]
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        ends = np.empty(len(starts), np.int64)
        ends[:-1] = starts[1:] - 1
        ends[last] = self.offsets[owner[last] + 1]
        return starts, ends, np.searchsorted(owner, np.arange(self.n + 1))


def segments(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that do not cross a text's border."""
    n = len(inside)
    border = np.zeros(n + 1, bool)
    border[block.offsets] = True
    before = np.empty(n, bool)
    before[:1] = True
    np.logical_not(inside[:-1], out=before[1:])
    starts = np.flatnonzero(inside & (before | border[:-1]))
    after = np.empty(n, bool)
    after[-1:] = True
    np.logical_not(inside[1:], out=after[:-1])
    ends = np.flatnonzero(inside & (after | border[1:])) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment's bytes: a polynomial of random byte codes, mixed with its length."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(lengths > 0)
    if len(full):
        lens = lengths[full]
        heads = np.cumsum(lens) - lens
        place = np.arange(int(lens.sum())) - np.repeat(heads, lens)
        powers = np.ones(int(lens.max()), np.uint64)
        powers[1:] = _BASE
        np.multiply.accumulate(powers, out=powers)
        at = place + np.repeat(starts[full], lens)
        out[full] = np.add.reduceat(_BYTES[data[at]] * powers[place], heads)
    return mix(out + lengths.astype(np.uint64) * np.uint64(_GAMMA))


def ngrams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n consecutive words at each place that has so many in its text, and these places."""
    owner_end = np.repeat(first[1:], np.diff(first))
    places = np.flatnonzero(np.arange(len(words)) + n <= owner_end)
    total = np.zeros(len(places), np.uint64)
    for k in range(n):
        total = mix(total * np.uint64(_BASE) + words[places + k])
    return total, places


def blocks(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Cuts Arrow batches into blocks of about ``BLOCK_BYTES`` of text; a null text is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
            to = min(to, len(texts))
            yield batch.slice(at, to - at), Block(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
            at = to


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each text's range."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[first[1:]] - total[first[:-1]]
