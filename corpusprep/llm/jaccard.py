"""N-gram Jaccard join, exact, in the metric space of word-shingle sets.

The Jaccard distance d = 1 - J is a metric.  Documents with J >= t are linked; the result is the
connected components of the links.

Regions.  Pivots that are whole documents are useless at the top: two texts that share no shingle
are at distance 1, so nearly every document is as far from all pivots and every triangle-inequality
window would hold everything (see README).  The top level therefore works in projections of the
space: the shingles are dealt to m parts by their hash, and a document is projected on each part.
J >= t means that the sets differ in at most D = a (1 - t) / t shingles, a being the smaller size;
with more than D parts some projection is the same, at distance 0.  So each projection that occurs is a pivot,
its region holds the documents projected on it, and linked documents meet in a region.  m depends on the size:
sizes are cut into classes, and a document near the lower border of its class is replicated
to the class below (to all classes below, for a low t), where a smaller partner may be.

Inside a region that holds different sets the metric join proper runs, recursively: a pivot is
compared with all members; members within eps = 1 - t are linked to it; if none is farther, the region
is done, otherwise only the far ones and those near ones whose distance to the pivot is
within eps of the closest far one can still form a link (triangle inequality).  Large regions are
split by several pivots into Voronoi cells, a document being replicated to all cells whose pivot is at
most 2 eps farther than its own.  Small regions are compared in full.  Regions that no pivot can split, because their
members are about equally far from it, are joined block by block: a short signature of each member (a hash for each of
some eight times D parts) bounds the number of parts in which two sets differ, and only pairs within D are compared.
Two blocks yield the links of a spanning forest, not all links, and blocks that one component fills do not meet again.

Sets cross the net only where a link is likely.  Every class has a mark, the parities of its hashes dealt to some 4 to 8 bits a
shingle.  Marks differ in no more bits than sets in shingles, so a pair whose marks are too far apart has no link and is not verified, and
a member of a region whose mark is near no other member's is done.  The sets of the others are read again from their texts.

Equal sets are one class; only classes are joined.  Set elements are 64-bit hashes.

Defined cases: null texts and texts without words have no set and link with nothing; a text with fewer
than n words has its whole word sequence as its one shingle; rows that repeat an id or a text are rows of their
own, with the class's component; null ids never name a component (a component of null ids only is null); an empty
table gives no rows; very long texts are read whole.  Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import stage, stage_alone
from .components import components

#: Upper border over lower border of a size class.
CLASS_RATIO = 1.5
#: Regions up to this size are compared in full; larger ones are split, or compared in blocks of about this size.
LEAF = 32
#: Pivots of a Voronoi split.
PIVOTS = 8
SPLITS = 3
#: Members of a block, and bytes of their sets, on average.
BLOCK = 512
BLOCK_BYTES = 8 << 20
#: Members of a block of marks; its marks take ``BLOCK_BYTES`` at most, on average.
MARK_BLOCK = 2048
#: Longs that are sent to all tasks at most (16 bytes each in a hash table).
BROADCAST_KEYS = 1 << 20
#: Classes whose copies a task tells apart before they go to their regions.
SEEN = 1 << 16

_PART = np.uint64(0xC2B2AE3D27D4EB4F)


class Classes:
    """Size classes and the number of parts of each, for J >= num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.borders = [max(1, -(-num // (den - num)))]  # smaller sets have no link to other sets
        while self.borders[-1] < 1 << 40:
            self.borders.append(max(self.borders[-1] + 1, int(self.borders[-1] * CLASS_RATIO)))
        self.parts: dict[int, tuple[int, int]] = {}

    def differ(self, size: int) -> int:
        """How many shingles two linked sets can differ in, the smaller having ``size``."""
        return size * (self.den - self.num) // self.num

    def of(self, k: int) -> tuple[int, int]:
        """(m, spare): parts of class k, of which 1 + spare at least are the same in linked sets."""
        if k not in self.parts:
            need, low = self.differ(self.borders[k + 1] - 1) + 1, self.borders[k]
            spare = 1
            for _ in range(8):  # more spare parts than a set has empty ones, in all but rare cases
                empty = (need + spare) * math.exp(-low / (need + spare))
                spare = math.ceil(empty + 4 * math.sqrt(empty) + 1)
            self.parts[k] = need + spare, spare
        return self.parts[k]

    def regions(self, shingles: np.ndarray) -> np.ndarray:
        """Region keys of a set (different hashes)."""
        size = len(shingles)
        if size < self.borders[0]:
            return np.zeros(0, np.uint64)
        least = max(self.borders[0], -(-size * self.num // self.den))  # the smallest partner's size
        low, own = (int(np.searchsorted(self.borders, x, "right")) - 1 for x in (least, size))
        return np.concatenate([self._keys(shingles, k) for k in range(low, own + 1)])

    def _keys(self, shingles: np.ndarray, k: int) -> np.ndarray:
        m, spare = self.of(k)
        part = (shingles >> np.uint64(11)) % np.uint64(m)
        order = np.argsort(part, kind="stable")
        part = part[order]
        heads = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sums = np.add.reduceat(tokens.mix(shingles[order] * _PART), heads)
        salt = np.uint64(m * int(_PART) % (1 << 64))
        keys = tokens.mix(sums ^ tokens.mix(part[heads] + salt))
        if m - len(heads) > spare:  # so many parts are empty that the same ones may all be empty
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), part[heads])
            keys = np.append(keys, tokens.mix(tokens.mix(empty + salt) + np.uint64(1)))
        return keys


def shingle_sets(block: tokens.Block, n: int) -> Iterator[np.ndarray]:
    """Each text's sorted shingle hashes."""
    low = tokens.Block(tokens.LOWER_AZ[block.data], block.offsets)
    starts, ends, first = low.words()
    words = tokens.hashes(low.data, starts, ends)
    grams, places = tokens.ngrams(words, first, n)
    begin = np.searchsorted(places, first)
    for i in range(block.n):
        count = first[i + 1] - first[i]
        if 0 < count < n:
            whole, _ = tokens.ngrams(words[first[i]:first[i + 1]], np.array([0, count]), int(count))
            yield tokens.mix(whole + np.uint64(count))
        else:
            yield np.unique(grams[begin[i]:begin[i + 1]])


def class_id(shingles: np.ndarray) -> np.uint64:
    """A 64-bit name of the set."""
    return tokens.mix(np.array([tokens.mix(shingles ^ _PART).sum(dtype=np.uint64) + np.uint64(len(shingles))]))[0]


def mark(shingles: np.ndarray) -> bytes:
    """The parity of the number of hashes in each of 2 ** k >= 4 * size cells (64 at least); halves that are added make the next smaller mark."""
    cells = 1 << max(6, (4 * len(shingles) - 1).bit_length())
    odd = np.bincount(((shingles >> np.uint64(33)) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(marked: bytes, words: int) -> np.ndarray:
    """A mark as ``words`` 64-bit words."""
    out = np.frombuffer(marked, np.uint64)
    while len(out) > words:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


def apart(x: bytes, y: bytes) -> int:
    """Elements that are in one of two sets only, at least."""
    words = min(len(x), len(y)) // 8
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())


def _read(docs: DataFrame, n: int) -> DataFrame:
    """(id, size, cid, text_hash, mark) for every row; cid and mark are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in tokens.blocks(batches, "text"):
            sets = list(shingle_sets(block, n))
            size = np.array([len(s) for s in sets], np.int64)
            cid = np.array([class_id(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "text_hash": batch.column("text_hash"), "size": size, "cid": pa.array(cid, mask=size == 0),
                "mark": pa.array([mark(s) if len(s) else None for s in sets], pa.binary())})

    return docs.mapInArrow(run, "id long, text_hash long, size long, cid long, mark binary")


def _points(texts: DataFrame, n: int, classes: Classes) -> DataFrame:
    """(cid, size, regions) of all classes that have regions.

    A task passes over the copies of the last ``SEEN`` classes that it met, so that a large group of copies goes
    to its regions about once a task; the rest of the copies is dropped there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, block in tokens.blocks(batches, "text"):
            if len(seen) > SEEN:
                seen = set()
            new = {}
            for s in shingle_sets(block, n):
                if len(s) >= classes.borders[0] and (name := int(class_id(s))) not in seen:
                    seen.add(name)
                    new[name] = (len(s), classes.regions(s))
            offsets = np.concatenate([[0], np.cumsum([len(k) for _, k in new.values()])]).astype(np.int32)
            flat = np.concatenate([*(k for _, k in new.values()), np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "cid": np.array(list(new), np.uint64).view(np.int64), "size": np.array([size for size, _ in new.values()], np.int64),
                "regions": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})

    return texts.mapInArrow(run, "cid long, size long, regions array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """(cid, shingles): the sets of the ``wanted`` classes, as bytes, read again from their texts."""
    hashes = stage(rows.join(wanted, "cid", "left_semi").select("text_hash").distinct(), "jaccard_texts")
    texts = docs.join(_small(hashes), "text_hash", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in tokens.blocks(batches, "text"):
            sets = {class_id(s): s for s in shingle_sets(block, n) if len(s)}
            yield pa.RecordBatch.from_pydict({"cid": np.array(list(sets), np.uint64).view(np.int64),
                                              "shingles": pa.array([s.tobytes() for s in sets.values()], pa.binary())})

    return stage(texts.mapInArrow(run, "cid long, shingles binary").join(wanted, "cid", "left_semi").dropDuplicates(["cid"]), "jaccard_sets")


def _small(table: DataFrame) -> DataFrame:
    """Marks a staged table of longs for broadcast if it is within ``BROADCAST_KEYS``; else joins shuffle."""
    return F.broadcast(table) if table.count() <= BROADCAST_KEYS else table


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both): sizes of the intersections of class pairs."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
                    for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)]
            yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"), "both": pa.array(both, pa.int64())})

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, both long")


def _apart(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """(a, b, apart): shingles in which class pairs differ, at least."""
    left = marks.select(F.col("cid").alias("a"), F.col("mark").alias("ma"))
    right = marks.select(F.col("cid").alias("b"), F.col("mark").alias("mb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [apart(x.as_py(), y.as_py()) for x, y in zip(batch.column("ma"), batch.column("mb"), strict=True)]
            yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"), "apart": pa.array(least, pa.int64())})

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb").mapInArrow(run, "a long, b long, apart long")


def near_places(size: np.ndarray, far: np.ndarray, root: np.ndarray, marks: list[bytes], side: np.ndarray, num: int, den: int) -> np.ndarray:
    """Places of the members that may have a link with one of another component (and of another side, where there are two), one of them far."""
    order = np.argsort(size, kind="stable")
    size, far, root, side = size[order], far[order], root[order], side[order]
    words = np.array([len(marks[k]) // 8 for k in order])
    last = np.searchsorted(size, size * den // num, "right")  # the largest partner
    near = np.zeros(len(order), bool)
    two = bool(side.any())
    for w in np.unique(words):
        own = np.flatnonzero(words == w)
        first, end = int(own[0]), int(last[own[-1]])
        table = np.stack([folded(marks[k], int(w)) for k in order[first:end]])
        for i in own.tolist():
            j = slice(i + 1, int(last[i]))
            differ = np.bitwise_count(table[i + 1 - first:j.stop - first] ^ table[i - first]).sum(axis=1, dtype=np.int64)
            hit = (differ * (den + num) <= (size[j] + size[i]) * (den - num)) & (far[j] | far[i]) & (root[j] != root[i])
            if two:
                hit &= side[j] != side[i]
            if hit.any():
                near[i] = True
                near[j] |= hit
    return order[near]


def _near(members: DataFrame, marks: DataFrame, num: int, den: int) -> DataFrame:
    """The ``members`` (region, cid, size, far, root, ...) whose marks leave a link with another component open."""
    counts = members.groupBy("region").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / MARK_BLOCK, F.sum("size") / BLOCK_BYTES)).cast("long").alias("blocks"))
    item = F.struct("cid", "size", "far", "root", "mark").alias("item")
    blocks = stage(members.join(counts, "region").join(marks, "cid").select(
        "region", "blocks", F.pmod(F.xxhash64("cid", F.lit(7)), F.col("blocks")).alias("block"), item)
        .groupBy("region", "blocks", "block").agg(F.collect_list("item").alias("items")), "jaccard_marks")

    def near(region, *sides) -> pa.RecordBatch:
        parts = [(np.asarray(x.field("cid")), np.asarray(x.field("size")), np.asarray(x.field("far").to_pylist(), bool), np.asarray(x.field("root")),
                  x.field("mark").to_pylist()) for x in sides]
        cid, size, far, root = (np.concatenate([p[k] for p in parts]) for k in range(4))
        at = near_places(size, far, root, [m for p in parts for m in p[4]], np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]), num, den)
        return pa.RecordBatch.from_pydict({"region": pa.array([region.as_py()] * len(at), pa.int64()), "cid": pa.array(cid[at], pa.int64())})

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, items in zip(batch.column("region"), batch.column("items"), strict=True):
                if len(items.values) > 1:
                    yield near(region, items.values)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, x, y in zip(batch.column("region"), batch.column("x"), batch.column("y"), strict=True):
                yield near(region, x.values, y.values)

    found = blocks.select("region", "items").mapInArrow(alone, "region long, cid long")
    many = blocks.filter("blocks > 1")
    met = many.select("region", F.col("block").alias("i"), F.col("items").alias("x")).join(
        many.select("region", F.col("block").alias("j"), F.col("items").alias("y")), "region").filter("i < j")
    found = found.unionByName(met.select("region", "x", "y").mapInArrow(across, "region long, cid long"))
    return members.join(stage(found.distinct(), "jaccard_near"), ["region", "cid"], "left_semi")


def _members(points: DataFrame) -> DataFrame:
    """(region, cid, size, far): the classes of each region that holds more than one, regions with the same members once."""
    # the keys cross the net once and are not staged: what a region holds is seen beside its members
    region = Window.partitionBy("region")
    met = points.select("cid", "size", F.explode("regions").alias("region")).select(
        "region", "cid", "size", F.min("cid").over(region).alias("x"), F.max("cid").over(region).alias("y"))
    members = stage(met.filter("x < y").select("region", "cid", "size").distinct(), "jaccard_members")
    names = members.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("s1"),
                                          F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("s2"))
    one = names.groupBy("n", "s1", "s2").agg(F.min("region").alias("region")).select("region")
    return members.join(one, "region").withColumn("far", F.lit(True))


def _grouped(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, size, root) of every row; rows with one root are a component, it is null for empty sets."""
    return stage_alone(docs.sparkSession, "jaccard_groups", lambda: _group(docs, n, num, den, id_col, text_col))


def _group(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    classes = Classes(num, den)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    rows = stage(_read(texts, n), "jaccard_rows")
    members = stage_alone(rows.sparkSession, "jaccard_regions", lambda: _members(_points(texts.select("text"), n, classes)))
    marks = stage(rows.join(stage(members.select("cid").distinct(), "jaccard_wanted"), "cid", "left_semi").select("cid", "mark").dropDuplicates(["cid"]),
                  "jaccard_class_marks")

    def sets(wanted: DataFrame) -> DataFrame:
        return _sets(texts, stage(wanted.select("cid").distinct(), "jaccard_wanted"), rows, n)

    links = stage_alone(rows.sparkSession, "jaccard_links", lambda: _links(members, marks, sets, num, den))
    roots = stage(components(links, "jaccard").withColumnRenamed("node", "cid"), "jaccard_roots")
    return rows.select("id", "text_hash", "size", "cid").join(roots, "cid", "left").select(
        "id", "text_hash", "size", F.coalesce("root", "cid").alias("root"))


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id), one row per row of ``docs``; linked when den * intersection >= num * union."""
    named = _grouped(docs, n, num, den, id_col, text_col)
    smallest = named.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("first"))
    return named.join(smallest, "root", "left").select(
        "id", F.col("size").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id (null ids last, then by a hash of the
    text; of repeated rows any).  Rows without words all stay."""
    named = _grouped(docs, n, num, den, id_col, text_col).filter(F.col("root").isNotNull())
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    rows = named.groupBy("root", "id", "text_hash").agg(F.count(F.lit(1)).alias("times")).withColumn("place", place)
    best = rows.groupBy("root").agg(F.min("place").alias("best"))
    fate = stage(rows.join(best, "root").select("id", "text_hash", "times", (F.col("place") == F.col("best")).alias("stays")), "jaccard_fate")
    mark = f"_{'_'.join(docs.columns)}"  # clashes with no column of docs
    keys = lambda t: t.select(F.col("id").alias("k1" + mark), F.col("text_hash").alias("k2" + mark))
    same = docs[id_col].cast("long").eqNullSafe(F.col("k1" + mark)) & (F.xxhash64(docs[text_col]) == F.col("k2" + mark))
    gone, twice = (_small(stage(keys(fate.filter(which)), "jaccard_gone")) for which in ("not stays or times > 1", "stays and times > 1"))
    once = docs.join(gone, same, "left_anti")
    repeated = docs.join(twice, same).dropDuplicates(["k1" + mark, "k2" + mark]).select(*docs.columns)
    return once.unionByName(repeated)


def _links(members: DataFrame, marks: DataFrame, sets: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """(u, v): links that connect all linked classes.  ``members``: region, cid, size, far; ``sets`` gives the sets of classes (cid)."""
    eps = 1 - num / den
    both, union = F.col("both"), F.col("size") + F.col("size_b") - F.col("both")
    linked = (den * both) >= (num * union)
    out = []

    def compared(pairs: DataFrame) -> DataFrame:
        """Adds ``both`` to (region, a, size, b, size_b, ...); null where the sizes alone exclude a link."""
        possible = den * F.least("size", "size_b") >= num * F.greatest("size", "size_b")
        wanted = pairs.filter(possible).select("a", "b").distinct()
        return pairs.join(verified(wanted), ["a", "b"], "left")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stage(pairs, "jaccard_pairs")
        return stage(_verify(pairs, sets(pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))))), "jaccard_both")

    # one pivot: the smallest class, compared with the whole region
    pivot = members.groupBy("region").agg(F.min(F.struct("cid", "size")).alias("p"))
    pairs = (members.join(pivot, "region").select("region", F.col("cid").alias("a"), "size", F.col("p.cid").alias("b"), F.col("p.size").alias("size_b"))
             .filter("a <> b"))
    bounds = stage(_apart(pairs.filter(den * F.least("size", "size_b") >= num * F.greatest("size", "size_b")).select("a", "b").distinct(), marks),
                   "jaccard_apart")
    bounded = stage(pairs.join(bounds, ["a", "b"], "left"), "jaccard_bounded")
    total = F.col("size") + F.col("size_b")
    likely = bounded.filter((den + num) * F.col("apart") <= (den - num) * total).select("a", "b").distinct()
    # a pair that is not verified is as far apart as its marks or its sizes say, at least
    least = F.greatest(F.coalesce("apart", F.lit(0)), F.abs(F.col("size") - F.col("size_b")))
    found = stage(bounded.join(verified(likely), ["a", "b"], "left").withColumn("linked", F.coalesce(linked, F.lit(False))).withColumn(
        "d", F.when(both.isNull(), 2 * least / (total + least)).otherwise(1 - both / union)), "jaccard_star")
    out.append(found.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))
    closest = found.filter(~F.col("linked")).groupBy("region").agg(F.min("d").alias("closest"))
    # windows are 2 eps wide: distances that differ by less can't tell cells apart
    spread = found.groupBy("region").agg((F.percentile_approx("d", 0.9) - F.percentile_approx("d", 0.1) > 2 * eps).alias("splits"))
    # what the pivots connect needs no further comparison: components are the result
    roots = stage(components(out[0], "jaccard_star").select(F.col("node").alias("a"), "root"), "jaccard_star_roots")
    members = stage(found.join(closest, "region").filter(~F.col("linked") | (F.col("d") >= F.col("closest") - eps - 1e-9)).join(spread, "region")
                    .join(roots, "a", "left").select("region", F.col("a").alias("cid"), "size", (~F.col("linked")).alias("far"), "splits",
                                                     F.coalesce("root", "a").alias("root")), "jaccard_open")
    members = stage(_near(members, marks, num, den), "jaccard_open")

    for level in range(SPLITS + 1):
        counts = members.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
        small = members.join(counts.filter(F.col("n") <= LEAF), "region")
        # every pair of a small region, one of whose members is far from its pivot
        other = small.select("region", F.col("cid").alias("b"), F.col("size").alias("size_b"), F.col("far").alias("far_b"), F.col("root").alias("root_b"))
        pairs = (small.withColumnRenamed("cid", "a").join(other, "region").filter("a < b and root <> root_b and (far or far_b)")
                 .select("a", "size", "b", "size_b").distinct())
        out.append(compared(pairs).filter(linked).select(F.col("a").alias("u"), F.col("b").alias("v")))
        large = stage(members.join(counts.filter(F.col("n") > LEAF), "region"), "jaccard_large")
        whole = large if level == SPLITS else large.filter(~F.col("splits"))
        if whole.head(1):
            out.append(_block_links(whole, sets(whole), num, den))
        large = large.filter("splits")
        if level == SPLITS or not large.head(1):
            break
        pivot_links, members = _voronoi(large, compared, linked, both, union, eps)
        out.append(pivot_links)

    total = out[0]
    for part in out[1:]:
        total = total.unionByName(part)
    return total.distinct()


def _voronoi(large: DataFrame, compared, linked, both, union, eps: float):
    """Links with the pivots, and the members of the cells (of whole regions where cells would not get smaller)."""
    # pivots: the far members with the smallest hashes, one from each of PIVOTS slices of the region
    slices = large.filter("far").groupBy("region", F.pmod(F.xxhash64("cid"), F.lit(PIVOTS)).alias("slice")).agg(
        F.min(F.struct(F.xxhash64("cid", "region").alias("h"), "cid", "size")).alias("p"))
    pivots = slices.select("region", F.col("p.cid").alias("b"), F.col("p.size").alias("size_b"))
    pairs = large.withColumnRenamed("cid", "a").join(pivots, "region").filter("a <> b")
    found = stage(compared(pairs).withColumn("linked", F.coalesce(linked, F.lit(False))).withColumn(
        "d", 1 - F.coalesce(both, F.least("size", "size_b")) / F.when(both.isNull(), F.greatest("size", "size_b")).otherwise(union))
        # a distance known from the sizes only is a lower bound; it never excludes a cell
        .withColumn("exact", both.isNotNull()), "jaccard_cells")
    links = found.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
    home = found.filter("exact").groupBy("region", "a").agg(F.min("d").alias("home"))
    cells = (found.join(home, ["region", "a"], "left").filter(F.col("home").isNull() | (F.col("d") <= F.col("home") + 2 * eps + 1e-9))
             .join(pivots.select("region", F.col("b").alias("a")), ["region", "a"], "left_anti")
             .withColumn("cell", F.xxhash64("region", "b")))
    # in a cell, too, only the far ones and those near ones that the triangle inequality allows
    closest = cells.filter(~F.col("linked")).groupBy("cell").agg(F.min("d").alias("closest"))
    cells = stage(cells.join(closest, "cell").filter(~F.col("linked") | (F.col("d") >= F.col("closest") - eps - 1e-9)), "jaccard_cells")
    sizes = cells.groupBy("region").agg(F.count(F.lit(1)).alias("after")).join(
        large.groupBy("region").agg(F.count(F.lit(1)).alias("before")), "region")
    stuck = stage(sizes.filter(F.col("after") > 2 * F.col("before")).select("region"), "jaccard_stuck")
    goes_on = cells.join(stuck, "region", "left_anti").select(
        F.col("cell").alias("region"), F.col("a").alias("cid"), "size", (~F.col("linked")).alias("far"), F.lit(True).alias("splits"), "root")
    rest = large.join(stuck, "region", "left_semi").select("region", "cid", "size", "far", F.lit(False).alias("splits"), "root")
    return links, stage(goes_on.unionByName(rest), "jaccard_open")


def signature(shingles: np.ndarray, parts: int) -> np.ndarray:
    """16 bits for each part of a set; sets that are equal on a part have the same bits there."""
    part = ((shingles >> np.uint64(9)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    heads = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
    out = np.zeros(parts, np.uint16)
    out[part[order][heads]] = (tokens.mix(np.add.reduceat(tokens.mix(shingles[order] + _PART), heads)) >> np.uint64(48)).astype(np.uint16)
    return out


def _block_links(large: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v): links that connect all linked members of each region (region, cid, size, far, root) that are not connected yet.

    Blocks are compared with themselves and with the next one first, and roots are brought up to date.  Then members are
    dealt anew, those of a large component to blocks of their own: pairs of blocks that lie in one component
    are connected, and only the others meet.  So a dense group costs a chain of blocks.
    """
    large = large.select("region", "cid", "size", "far", "root")
    n_blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") * 8 / BLOCK_BYTES)).cast("long")
    # the same parts for all members of a region
    shape = stage(large.groupBy("region").agg(
        n_blocks.alias("blocks"), (8 * F.floor(F.max("size") * (den - num) / num) + 8).cast("int").alias("parts")), "jaccard_shape")
    dealt = large.join(shape, "region").withColumn("block", F.pmod(F.xxhash64("cid", F.lit(3)), F.col("blocks")))
    blocks = _blocks(dealt, sets)
    i = blocks.select("region", F.col("block").alias("i"))
    chain = i.withColumn("j", F.col("i")).unionByName(i.join(blocks.select("region", F.col("block").alias("j")), "region").filter("j = i + 1"))
    first = stage(_forests(blocks, chain, num, den), "jaccard_chain")

    # blocks of two have met
    open_ = large.join(shape.filter("blocks > 2"), "region")
    if not open_.head(1):
        return first
    known = large.select(F.col("cid").alias("u"), F.col("root").alias("v")).distinct().unionByName(first)
    roots = stage(components(known, "jaccard_blocks").select(F.col("node").alias("cid"), F.col("root").alias("now")), "jaccard_block_roots")
    named = stage(open_.join(roots, "cid", "left").withColumn("root", F.coalesce("now", "root")).drop("now"), "jaccard_named")
    part = named.groupBy("region", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), n_blocks.alias("own"))
    own = F.when(F.col("n") >= BLOCK / 2, F.col("root"))
    rest = part.filter(F.col("n") < BLOCK / 2).groupBy("region").agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK, F.sum("total") * 8 / BLOCK_BYTES)).alias("others"))
    dealt = (named.join(part, ["region", "root"]).join(rest, "region", "left")
             .withColumn("group", F.when(own.isNotNull(), F.xxhash64(F.lit(1), "root")).otherwise(F.lit(0).cast("bigint")))
             .withColumn("block", F.xxhash64("group", F.pmod(F.xxhash64("cid", F.lit(5)), F.when(own.isNotNull(), F.col("own")).otherwise(F.col("others"))))))
    blocks = _blocks(dealt.drop("n", "total", "own", "others", "group"), sets)
    names = blocks.select("region", "block", "low", "high")
    pairs = names.withColumnRenamed("block", "i").join(
        names.select("region", F.col("block").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j")), "region").filter(
        "i <= j and not (low = high and low_j = high_j and low = low_j)").select("region", "i", "j")
    return first.unionByName(stage(_forests(blocks, pairs, num, den), "jaccard_rest"))


def _blocks(dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """(region, block, parts, low, high, items): members of a block with their sets, and its smallest and largest root."""
    item = F.struct("cid", "size", "far", "root", "shingles").alias("item")
    rows = dealt.join(sets, "cid").select("region", "block", "parts", "root", item)
    return stage(rows.groupBy("region", "block", "parts").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.collect_list("item").alias("items")), "jaccard_blocks")


def _forests(blocks: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v) for each pair (region, i, j) of blocks: links that join the components that its linked members belong to."""
    left = blocks.select("region", F.col("block").alias("i"), "parts", F.col("items").alias("x"))
    right = blocks.select("region", F.col("block").alias("j"), F.col("items").alias("y"))
    met = pairs.join(left, ["region", "i"]).join(right, ["region", "j"]).select("parts", (F.col("i") == F.col("j")).alias("same"), "x", "y")

    def load(items, parts: int):
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in items.field("shingles")]
        marks = np.stack([signature(s, parts) for s in sets])
        return np.asarray(items.field("cid")), np.asarray(items.field("size")), np.asarray(items.field("far")), np.asarray(items.field("root")), marks, sets

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                parts, same = batch.column("parts")[k].as_py(), batch.column("same")[k].as_py()
                x = load(batch.column("x")[k].values, parts)
                u, v = forest(x, x if same else load(batch.column("y")[k].values, parts), same, num, den)
                yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return met.mapInArrow(link, "u long, v long")


def forest(x, y, same: bool, num: int, den: int) -> tuple[list[int], list[int]]:
    """Ends of links between two blocks (ids, sizes, far, roots, signatures, sets), one for each two components that become one.

    Every pair of members in different components, one of them far, whose signatures differ in D parts at most is
    looked at, nearest signatures first, and verified if its components are still apart.
    """
    (a, na, fa, ra, ma, sa), (b, nb, fb, rb, mb, sb) = x, y
    off = np.zeros((len(a), len(b)), np.int32)
    for p in range(ma.shape[1]):
        off += ma[:, p, None] != mb[None, :, p]
    low, high = np.minimum(na[:, None], nb[None]), np.maximum(na[:, None], nb[None])
    near = (off <= low * (den - num) // num) & (den * low >= num * high) & (fa[:, None] | fb[None]) & (ra[:, None] != rb[None])
    i, j = np.nonzero(np.triu(near, 1) if same else near)
    order = np.argsort(off[i, j], kind="stable")
    _, tree = np.unique(np.concatenate([ra, rb]), return_inverse=True)
    parent = list(range(len(a) + len(b)))

    def find(n: int) -> int:
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    u, v = [], []
    for s, t in zip(i[order].tolist(), j[order].tolist(), strict=True):
        one, two = find(int(tree[s])), find(int(tree[len(a) + t]))
        if one != two:
            both = len(np.intersect1d(sa[s], sb[t], assume_unique=True))
            if den * both >= num * (int(na[s]) + int(nb[t]) - both):
                parent[max(one, two)] = min(one, two)
                u.append(int(a[s]))
                v.append(int(b[t]))
    return u, v
