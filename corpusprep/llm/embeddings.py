"""Embedding near-duplicates by an epsilon grid order join, exact for cosine similarity.

For vectors of length 1, cosine >= t means a Euclidean distance <= eps = sqrt(2 - 2 t).  The vectors are
projected on their leading principal axes (an orthonormal map, which shortens distances), the
projections are cut into cells of width eps, and all vectors are sorted by label and cells.  The sorted
sequence is cut into blocks; blocks, runs of blocks and runs of partitions form intervals, each
with the box of its projections.  Starting from the whole sequence, interval pairs are joined
recursively: a pair whose labels do not meet or whose boxes are more than eps apart is provably
distant and skipped, all others go on with their parts.  Pairs of blocks are compared in full with
double-precision products.

Equal vectors of a label are compared once.  A block pair returns link counts and a spanning forest of
its links, never all pairs of a dense group.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and vectors without
a label, link with nothing; vectors of different lengths link with nothing; repeated rows are vectors of
their own, linked with each other; a null id counts as a vector but never names a component (its
``kept`` is false); an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import components

#: Leading principal axes that make the grid.
AXES = 4
#: Bytes of the vectors in a block; a block has at least 16.
BLOCK_BYTES = 1 << 16
FAN = 16


def principal_axes(vectors: DataFrame, axes: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and leading axes for each vector length, from sums over all vectors (dim + dim^2 numbers a length)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, x, _ in _by_length(batch.column("vec")):
                part = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                total[dim] = total.get(dim, 0) + part
        for dim, t in total.items():
            yield pa.RecordBatch.from_pydict({"dim": np.full(len(t), dim, np.int32), "i": np.arange(len(t), dtype=np.int64), "x": t})

    rows = vectors.select("vec").mapInArrow(sums, "dim int, i long, x double").groupBy("dim", "i").agg(F.sum("x").alias("x")).toPandas()
    out = {}
    for dim, g in rows.groupby("dim"):
        t = g.sort_values("i")["x"].to_numpy()
        mean = t[1:dim + 1] / t[0]
        cov = t[dim + 1:].reshape(dim, dim) / t[0] - np.outer(mean, mean)
        _, vec = np.linalg.eigh(cov)
        out[int(dim)] = mean, vec[:, ::-1][:, :axes]
    return out


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each vector length: unit vectors in double precision and their rows."""
    lists = column.cast(pa.large_list(pa.float64()))
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        x = flat[offsets[rows][:, None] + np.arange(dim)[None]]
        # scaled first, so that very large and very small components neither overflow nor vanish
        x = x / np.abs(x).max(axis=1, keepdims=True)
        yield int(dim), x / np.sqrt((x * x).sum(axis=1, keepdims=True)), rows


def _place(vectors: DataFrame, axes: dict, width: float) -> DataFrame:
    """Adds dim and the projections ``p`` (AXES numbers, 0 where a vector has fewer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.zeros((batch.num_rows, AXES))
            dims = np.zeros(batch.num_rows, np.int32)
            for dim, x, rows in _by_length(batch.column("vec")):
                mean, vec = axes[dim]
                p[rows, :vec.shape[1]] = (x - mean) @ vec
                dims[rows] = dim
            out = {c: batch.column(c) for c in ("cid", "label", "vec", "members")}
            out |= {"dim": dims} | {f"p{k}": p[:, k] for k in range(AXES)}
            yield pa.RecordBatch.from_pydict(out)

    kinds = dict(vectors.dtypes)
    placed = vectors.select("cid", "label", "vec", "members").mapInArrow(
        run, f"cid long, label {kinds['label']}, vec {kinds['vec']}, members long, dim int, " + ", ".join(f"p{k} double" for k in range(AXES)))
    return placed.withColumns({f"c{k}": F.floor(F.col(f"p{k}") / width).cast("int") for k in range(AXES)})


def _blocks(placed: DataFrame) -> DataFrame:
    """(part, nth, label, dim, lo, hi, cids, members, vecs): runs of the sorted sequence that share label and length."""
    order = ["label", "dim", *[f"c{k}" for k in range(AXES)], "cid"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        waiting: list[pa.Table] = []

        def cut(table: pa.Table) -> pa.RecordBatch:
            nonlocal nth
            table = table.combine_chunks()
            p = np.stack([table.column(f"p{k}").to_numpy() for k in range(AXES)], axis=1)
            vecs = table.column("vec").combine_chunks().values.to_numpy(zero_copy_only=False).astype(np.float64)
            row = {
                "part": [part], "nth": [nth], "label": table.column("label").slice(0, 1).to_pylist(), "dim": table.column("dim").slice(0, 1).to_pylist(),
                "lo": [p.min(axis=0).tolist()], "hi": [p.max(axis=0).tolist()], "cids": [table.column("cid").to_numpy().tobytes()],
                "members": [table.column("members").to_numpy().tobytes()],
                "vecs": [vecs.astype(np.float32).tobytes() if single else vecs.tobytes()]}
            nth += 1
            return pa.RecordBatch.from_pydict(row, schema=out_schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            label, dim = np.asarray(batch.column("label")), np.asarray(batch.column("dim"))
            change = np.flatnonzero((label[1:] != label[:-1]) | (dim[1:] != dim[:-1])) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
                piece = pa.Table.from_batches([batch.slice(a, b - a)])
                if waiting and (waiting[0].column("label")[0] != piece.column("label")[0] or waiting[0].column("dim")[0] != piece.column("dim")[0]):
                    yield cut(pa.concat_tables(waiting))
                    waiting = []
                waiting.append(piece)
                size = max(16, BLOCK_BYTES // (item * max(1, int(dim[a]))))
                table = pa.concat_tables(waiting)
                while table.num_rows >= size:
                    yield cut(table.slice(0, size))
                    table = table.slice(size)
                waiting = [table] if table.num_rows else []
        if waiting:
            yield cut(pa.concat_tables(waiting))

    kinds = dict(placed.dtypes)
    single = kinds["vec"] == "array<float>"
    item = 4 if single else 8
    schema = f"part int, nth int, label {kinds['label']}, dim int, lo array<double>, hi array<double>, cids binary, members binary, vecs binary"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(schema))
    return ordered.mapInArrow(run, schema)


def near_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """(i, j): ids of block pairs (i <= j) that may hold a link, by recursion over intervals of the sequence.

    ``boxes``: part, nth, key (what must be equal to link), lo, hi.
    """
    top = boxes.agg(F.max("part"), F.max("nth")).first()
    if top[0] is None:
        return boxes.sparkSession.createDataFrame([], "i long, j long")
    # the number of an interval: its partition run and its block run, a level's width is FAN times the one below
    widths = [(1, 1)]
    while widths[-1][1] <= top[1]:
        widths.append((1, widths[-1][1] * FAN))
    while widths[-1][0] <= top[0]:
        widths.append((widths[-1][0] * FAN, widths[-1][1]))

    def number(level: int):
        parts, run = widths[level]
        return F.floor(F.col("part") / parts) * (1 << 31) + F.floor(F.col("nth") / run)

    pairs = None
    for level in range(len(widths) - 1, -1, -1):
        keys = [number(level).alias("id")] + ([number(level + 1).alias("up")] if level + 1 < len(widths) else [F.lit(0).alias("up")])
        table = boxes.select(*keys, "key", "lo", "hi").groupBy("id", "up").agg(
            F.min("key").alias("k0"), F.max("key").alias("k1"),
            F.array(*[F.min(F.col("lo")[k]) for k in range(AXES)]).alias("lo"), F.array(*[F.max(F.col("hi")[k]) for k in range(AXES)]).alias("hi"))
        left = table.select(*[F.col(c).alias(f"a_{c}") for c in table.columns])
        right = table.select(*[F.col(c).alias(f"b_{c}") for c in table.columns])
        if pairs is None:
            joined = left.join(right, F.col("a_up") == F.col("b_up"))  # the top level has one interval
        else:
            joined = pairs.join(left, F.col("i") == F.col("a_up")).join(right, F.col("j") == F.col("b_up"))
        gap2 = sum((F.pow(F.greatest(F.lit(0.0), F.col("a_lo")[k] - F.col("b_hi")[k], F.col("b_lo")[k] - F.col("a_hi")[k]), 2) for k in range(AXES)), F.lit(0.0))
        near = (F.col("a_id") <= F.col("b_id")) & (F.col("a_k0") <= F.col("b_k1")) & (F.col("b_k0") <= F.col("a_k1")) & (gap2 <= (eps + 1e-9) ** 2)
        pairs = stage(joined.filter(near).select(F.col("a_id").alias("i"), F.col("b_id").alias("j")), f"ego_pairs{level}")
    return pairs


def _compare(pairs: DataFrame, threshold: float, single: bool) -> DataFrame:
    """(kind, a, b): kind 0 adds b links to vector a, kind 1 is an edge of a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def load(row, side):
            cids = np.frombuffer(row[f"{side}_cids"], np.int64)
            raw = np.frombuffer(row[f"{side}_vecs"], np.float32 if single else np.float64).astype(np.float64).reshape(len(cids), -1)
            raw = raw / np.abs(raw).max(axis=1, keepdims=True)
            return cids, np.frombuffer(row[f"{side}_members"], np.int64), raw, np.sqrt((raw * raw).sum(axis=1))

        for batch in batches:
            kind, left, right = [], [], []
            for row in batch.to_pylist():
                (ca, na, xa, la), (cb, nb, xb, lb) = load(row, "a"), load(row, "b")
                cosine = (xa @ xb.T) / (la[:, None] * lb[None])
                close = np.argwhere(np.abs(cosine - threshold) < 1e-9)  # settled one by one
                for p, q in close:
                    cosine[p, q] = math.fsum(xa[p] * xb[q]) / (la[p] * lb[q])
                linked = cosine >= threshold
                same = row["i"] == row["j"]
                if same:
                    linked = np.triu(linked, 1)
                    linked |= linked.T
                if not linked.any():
                    continue
                for c, add in ((ca, linked @ nb), *(() if same else ((cb, linked.T @ na),))):
                    some = add > 0
                    kind.append(np.zeros(some.sum(), np.int32))
                    left.append(c[some])
                    right.append(add[some])
                p, q = np.nonzero(linked)
                ids = np.concatenate([ca, cb])
                root = np.arange(len(ids))
                while True:  # smallest label among neighbours until nothing changes
                    low = root.copy()
                    np.minimum.at(low, p, root[q + (0 if same else len(ca))])
                    np.minimum.at(low, q + (0 if same else len(ca)), root[p])
                    low = low[low]
                    if (low == root).all():
                        break
                    root = low
                edge = np.flatnonzero(root != np.arange(len(ids)))
                kind.append(np.ones(len(edge), np.int32))
                left.append(ids[edge])
                right.append(ids[root[edge]])
            if kind:
                yield pa.RecordBatch.from_pydict({"kind": np.concatenate(kind), "a": np.concatenate(left).astype(np.int64), "b": np.concatenate(right).astype(np.int64)})

    return pairs.mapInArrow(run, "kind int, a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str | None = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector of ``vectors``."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    vec = F.col(vec_col)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    valid = vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, number) & F.exists(vec, lambda x: x != 0)
    label = F.col(label_col) if label_col else F.lit(0)
    rows = stage(vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.when(valid & label.isNotNull(), vec).alias("vec"),
        F.monotonically_increasing_id().alias("row_id")), "ego_rows")
    classes = stage(rows.filter(F.col("vec").isNotNull()).groupBy("label", "vec").agg(
        F.min("row_id").alias("cid"), F.count(F.lit(1)).alias("members"), F.min("vec_id").alias("first_id")), "ego_classes")
    axes = principal_axes(classes, AXES)
    blocks = stage(_blocks(_place(classes, axes, eps or 1.0)).withColumn("id", F.col("part") * (1 << 31) + F.col("nth")), "ego_blocks")
    pairs = near_pairs(blocks.select("part", "nth", F.struct("label", "dim").alias("key"), "lo", "hi"), eps)
    side = lambda s, on: blocks.select(F.col("id").alias(on), F.struct("label", "dim").alias(f"{s}_key"),
                                       *[F.col(c).alias(f"{s}_{c}") for c in ("cids", "members", "vecs")])
    loaded = (pairs.join(side("a", "i"), "i").join(side("b", "j"), "j").filter(F.col("a_key") == F.col("b_key")).drop("a_key", "b_key"))
    single = dict(classes.dtypes)["vec"] == "array<float>"
    found = stage(_compare(loaded, threshold, single), "ego_links")
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("others"))
    roots = components(found.filter("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")), "ego")
    named = (classes.select("cid", "members", "first_id", "label", "vec").join(counts, "cid", "left")
             .join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select(
        F.col("label").alias("l"), F.col("vec").alias("v"), (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component_id")
    out = rows.join(named, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
