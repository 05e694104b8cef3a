"""Packing by vector bin packing: examples go into sequences under three limits at once.

A sequence holds at most ``tokens`` tokens, ``segments`` pieces and ``loss`` loss-bearing tokens.  The
dot-product heuristic fills one sequence at a time: of the waiting pieces that fit, it takes the one
whose demand vector has the largest dot product with the capacity left (both in parts of the limits).
With ``cut=True`` examples may be cut: what no piece fills is filled with the beginning of the longest
waiting one, and the last tokens of a partition go into sequences of power-of-two lengths, so that nothing
is padded.  With ``cut=False`` (instruction data) an example stays in one piece unless it is
longer than a sequence.

Every Spark partition packs its own rows in one pass, with at most ``WAITING`` pieces (or those of one sequence, if they are more) in memory, and
numbers its sequences from its partition number on: no shuffle, nothing central, and a lost task is redone alone.

Tokenising: ids of a byte-level BPE vocabulary.  A place between a visible character and a space always
separates two pre-tokens of its pattern, so texts are cut there, each different cut-out is encoded once per block
(and remembered while the cache has room) and the ids are put together; the ids equal those of the whole text.

Defined cases: a null or empty text has the end id only; rows are independent, repeats and null ids are
packed like others; an empty table gives no rows; a very long text is read whole, as a block of its own.  Only id, text and the optional loss flag are read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

WAITING = 256
#: Different cut-outs that a worker remembers with their ids.
CACHE = 400_000
END_ID = 0

_SAFE = np.zeros(256, bool)
_SAFE[0x21:0x7F] = True


class Encoder:
    """Ids of whole texts; ``ranks`` is a tiktoken vocabulary file, ``pattern`` its pre-token pattern."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.width = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.width[rank] = len(token)
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def cuts(self, block: tokens.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the cut-outs, and whether each has another one before and after it in its text."""
        data, n = block.data, len(block.data)
        place = np.flatnonzero(data == 0x20)
        place = place[place > 0]
        before = data[place - 1]
        # visible ASCII, or a letter of two bytes (no white space begins with C3 to DF)
        two = place > 1
        latin = np.zeros(len(place), bool)
        latin[two] = (before[two] >= 0x80) & (before[two] < 0xC0) & (data[place[two] - 2] >= 0xC3) & (data[place[two] - 2] <= 0xDF)
        place = place[_SAFE[before] | latin]
        heads = block.offsets[:-1][block.offsets[:-1] < block.offsets[1:]]
        starts = np.union1d(place, heads)
        ends = np.append(starts[1:], n)[:len(starts)]
        is_head = np.isin(starts, heads, assume_unique=True)
        return starts, ends, ~is_head & ~np.append(is_head[1:], True)[:len(starts)]

    def encode(self, block: tokens.Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block's texts, and where each text's begin (n + 1 places)."""
        starts, ends, inner = self.cuts(block)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(block.n + 1, np.int64)
        raw = block.data.tobytes()
        h = tokens.hashes(block.data, starts, ends)
        kinds, first, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, kinds), max(len(self.keys) - 1, 0))
        known = self.keys[at] == kinds if len(self.keys) else np.zeros(len(kinds), bool)
        new = np.flatnonzero(~known)
        new = new[np.argsort(~inner[first[new]], kind="stable")]  # those with neighbours first: they are encoded in one go
        n_inner = int(inner[first[new]].sum())
        sizes, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        if n_inner:
            a, b = starts[first[new[:n_inner]]], ends[first[new[:n_inner]]]
            joined = b"".join([raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            ids = np.array(self.coding.encode_ordinary(joined.decode("utf-8", "replace")), np.uint32)
            reach = np.cumsum(self.width[ids])
            stop = np.searchsorted(reach, np.cumsum(b - a)) + 1
            sizes.append(np.diff(stop, prepend=0))
            parts.append(ids)
        for i in first[new[n_inner:]].tolist():
            ids = np.array(self.coding.encode_ordinary(raw[starts[i]:ends[i]].decode("utf-8", "replace")), np.uint32)
            sizes.append(np.array([len(ids)]))
            parts.append(ids)
        fresh, flat = np.concatenate(sizes), np.concatenate([self.ids, *parts])
        place, size = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        if len(self.keys):
            place[known], size[known] = self.at[at[known]], self.size[at[known]]
        place[new] = len(self.ids) + np.cumsum(fresh) - fresh
        size[new] = fresh
        if len(self.keys) + len(new) <= CACHE:
            keys = np.concatenate([self.keys, kinds[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.ids = keys[order], flat
            self.at, self.size = np.concatenate([self.at, place[new]])[order], np.concatenate([self.size, fresh])[order]
        many = size[back]
        total = np.concatenate([[0], np.cumsum(many)])
        out = flat[np.repeat(place[back] - total[:-1], many) + np.arange(total[-1])]
        return out, total[np.searchsorted(starts, block.offsets)]


def resolve(ranks: str, pattern: str | None) -> tuple[str, str]:
    """The path of an installed public vocabulary (a bare name), or the given path; its default pattern."""
    import public_tokenizers

    return (ranks if "/" in ranks else public_tokenizers.path(ranks)), pattern or public_tokenizers.PATTERN


class Packer:
    """Waiting pieces of one partition and the sequences made of them."""

    def __init__(self, limits: tuple[int, int, int], cut: bool, first_id: int):
        self.limits, self.cut, self.next_id = np.array(limits, float), cut, first_id
        self.items: list[tuple] = []  # (doc, start, ids, doc_tokens, bears loss)
        self.demand = np.zeros((0, 3))
        self.out: list[tuple] = []

    def loss(self, n: int, bears: bool, start: int) -> int:
        """Loss-bearing tokens of a piece: all that have a token before them in it."""
        return max(0, n - 1) if bears else 0

    def add(self, doc, ids: np.ndarray, bears: bool) -> None:
        size, total = int(self.limits[0]), len(ids)
        longest = size if not bears else min(size, int(self.limits[2]) + 1)
        start = 0
        while total - start >= longest and (total > longest or self.cut):
            self.emit([(doc, start, ids[start:start + longest], total, bears)])
            start += longest
        if start < total:
            self.wait((doc, start, ids[start:], total, bears))
        # a sequence is begun when enough waits for a full one, however short the pieces are
        while len(self.items) > WAITING and (self.demand[:, 0].sum() >= self.limits[0] or len(self.items) >= self.limits[1]):
            self.fill()

    def wait(self, item: tuple) -> None:
        self.items.append(item)
        n = len(item[2])
        self.demand = np.vstack([self.demand, [n, 1, self.loss(n, item[4], item[1])]])

    def take(self, i: int) -> tuple:
        self.demand = np.delete(self.demand, i, axis=0)
        return self.items.pop(i)

    def fill(self) -> None:
        """One sequence from the waiting pieces."""
        left, chosen = self.limits.copy(), []
        while len(self.items) and left[0] >= 1 and left[1] >= 1:
            fits = (self.demand <= left).all(axis=1)
            if not fits.any():
                break
            i = int(np.where(fits, (self.demand / self.limits) @ (left / self.limits), -1.0).argmax())
            chosen.append(self.take(i))
            left -= [len(chosen[-1][2]), 1, self.loss(len(chosen[-1][2]), chosen[-1][4], chosen[-1][1])]
        if self.cut and left[0] >= 1 and left[1] >= 1 and len(self.items):
            i = int(self.demand[:, 0].argmax())
            doc, start, ids, total, bears = self.items[i]
            n = int(min(left[0], left[2] + 1 if bears else left[0], len(ids)))
            self.take(i)
            chosen.append((doc, start, ids[:n], total, bears))
            if n < len(ids):
                self.wait((doc, start + n, ids[n:], total, bears))
        self.emit(chosen)

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total, bears in pieces:
            self.out.append((doc, start, ids, total, self.next_id, offset, self.loss(len(ids), bears, start)))
            offset += len(ids)
        self.next_id += 1

    def finish(self) -> None:
        while len(self.items):
            rest = int(self.demand[:, 0].sum())
            if self.cut and rest < self.limits[0]:
                # what is left of the partition: a sequence of the largest power of two, until nothing is
                self.limits[0] = 1 << (rest.bit_length() - 1)
            self.fill()


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loss_col: str | None = None, max_tokens: int = 1024,
         max_segments: int | None = None, max_loss: int = 1024, cut: bool = True, ranks: str = "byte_bpe_50k.tiktoken",
         pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens (and ids).

    ``loss_col`` names a boolean column: false for texts that bear no loss (prompts); null counts as true.
    Without ``max_segments`` as many pieces share a sequence as its tokens allow.
    """
    max_segments = max_segments or max_tokens
    ids_kind = ", ids array<int>" if with_ids else ""
    schema = ("id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long" + ids_kind)
    bears = F.coalesce(F.col(loss_col).cast("boolean"), F.lit(True)) if loss_col else F.lit(True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), bears.alias("bears"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*resolve(ranks, pattern))
        packer = Packer((max_tokens, max_segments, max_loss), cut, TaskContext.get().partitionId() << 40)

        def done() -> pa.RecordBatch:
            got, packer.out = packer.out, []
            cols = {
                "id": pa.array([g[0] for g in got], pa.int64()), "start": pa.array([g[1] for g in got], pa.int64()),
                "length": pa.array([len(g[2]) for g in got], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(g[2].astype("<u4").tobytes()) for g in got], pa.int64()),
                "doc_tokens": pa.array([g[3] for g in got], pa.int64()), "sequence_id": pa.array([g[4] for g in got], pa.int64()),
                "offset": pa.array([g[5] for g in got], pa.int64()), "loss_tokens": pa.array([g[6] for g in got], pa.int64())}
            if with_ids:
                cols["ids"] = pa.array([g[2].astype(np.int32) for g in got], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(cols)

        for batch, block in tokens.blocks(batches, "text"):
            names, loss = batch.column("id").to_pylist(), batch.column("bears").to_pylist()
            ids, at = encoder.encode(block)
            for i in range(block.n):
                packer.add(names[i], np.append(ids[at[i]:at[i + 1]], np.uint32(END_ID)), loss[i])
            yield done()
        packer.finish()
        yield done()

    return rows.mapInArrow(run, schema)
