"""Sharding by a hypergeometric communication matrix: a uniform shuffle into exact sizes.

Rows lie in P partitions.  A matrix says how many rows of each partition go to each
shard; drawn from the multivariate hypergeometric law it is distributed as under a
uniform random permutation of all rows, while the shard sizes are exact (they differ by
one at most).  Then each partition permutes its rows and deals them out by its matrix
row, the rows are exchanged, and each shard permutes what it received.

The matrix is drawn as a tree: a node holds the shard counts of a range of partitions and
deals them to ``FAN`` children, so all nodes of a level are drawn in parallel.  A draw
inverts the exact distribution function on the values within nine deviations of the mode.

Partition numbers are written with the rows, so that a lost executor or a new scan layout
cannot change them between the draw and the dealing.

Defined cases: null texts have 8 bytes and checksum 0; null and repeated ids are rows like
others; an empty table gives no rows; with fewer rows than shards the last shards are empty.
Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, unit

FAN = 16
#: Rows that one task orders when a shard is permuted, on average.
SLOT_ROWS = 65536


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(u: Column, population: Column, marked: Column, draws: Column) -> Column:
    """The number of marked among ``draws`` from ``population`` without replacement, by inversion at ``u``."""

    def body(p):
        n, k, d = p["n"].cast("double"), p["k"].cast("double"), p["d"].cast("double")
        mode = F.floor((d + 1) * (k + 1) / (n + 2))
        sd = F.sqrt(F.greatest(F.lit(0.0), d * (k / F.greatest(n, F.lit(1.0))) * (n - k) / F.greatest(n, F.lit(1.0))
                               * (n - d) / F.greatest(n - 1, F.lit(1.0))))
        reach = F.ceil(9 * sd) + 10
        low = F.greatest(F.lit(0).cast("bigint"), p["d"] + p["k"] - p["n"], mode - reach)
        high = F.greatest(low, F.least(p["d"], p["k"], mode + reach))
        # probabilities relative to that of the lowest value, by the ratio of neighbours
        ratio = lambda x: (k - x) * (d - x) / ((x + 1) * (n - k - d + x + 1))

        def total(values):
            return F.aggregate(values, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("t")),
                               lambda a, x: F.struct((a["w"] * ratio(x)).alias("w"), (a["t"] + a["w"]).alias("t")), lambda a: a["t"])

        def pick(q):
            start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("t"), F.lit(0).cast("bigint").alias("j"))
            return F.aggregate(
                q["v"], start,
                lambda a, x: F.struct((a["w"] * ratio(x)).alias("w"), (a["t"] + a["w"]).alias("t"),
                                      (a["j"] + (a["t"] + a["w"] < p["u"] * q["t"]).cast("bigint")).alias("j")),
                lambda a: F.least(F.element_at(q["v"], 1) + a["j"], F.element_at(q["v"], -1)))

        return let(F.sequence(low, high), lambda v: let(F.struct(v.alias("v"), total(v).alias("t")), pick))

    return let(F.struct(u.alias("u"), population.cast("bigint").alias("n"), marked.cast("bigint").alias("k"), draws.cast("bigint").alias("d")), body)


def communication_matrix(counts: DataFrame, shards: int, n_rows: int, seed: int) -> DataFrame:
    """(pid, n, share): how many of a partition's n rows go to each shard.  ``counts``: (pid, n), one row per partition."""
    spark = counts.sparkSession
    sizes = [n_rows // shards + (s < n_rows % shards) for s in range(shards)]
    last = counts.agg(F.max("pid")).first()[0] or 0
    depth = 1
    while FAN ** depth <= last:
        depth += 1
    nodes = spark.range(1).select(F.lit(0).cast("bigint").alias("node"), F.array(*[F.lit(x).cast("bigint") for x in sizes]).alias("share"))
    for level in range(1, depth + 1):
        width = FAN ** (depth - level)
        children = (
            counts.groupBy(F.floor(F.col("pid") / width).alias("child")).agg(F.sum("n").alias("n"))
            .groupBy(F.floor(F.col("child") / FAN).alias("node")).agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children"))
        )

        def deal(acc, c):
            """Draws one child's counts from what its elder siblings left (run while ``level`` holds)."""
            def shard(a, i):
                have = F.element_at(acc["left"], i)
                got = hypergeometric(unit(F.lit(seed), F.lit(level), c["child"], i), a["pool"], have, a["need"])
                return let(got, lambda x: F.struct((a["need"] - x).alias("need"), (a["pool"] - have).alias("pool"),
                                                   F.concat(a["out"], F.array(x)).alias("out")))

            pool = F.aggregate(acc["left"], F.lit(0).cast("bigint"), lambda t, x: t + x)
            begin = F.struct(c["n"].alias("need"), pool.alias("pool"), F.array().cast("array<bigint>").alias("out"))
            drawn = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), begin, shard, lambda a: a["out"])
            return let(drawn, lambda d: F.struct(
                F.zip_with(acc["left"], d, lambda x, y: x - y).alias("left"),
                F.concat(acc["out"], F.array(F.struct(c["child"].alias("node"), d.alias("share")))).alias("out")))

        begin = F.struct(F.col("share").alias("left"), F.array().cast("array<struct<node:bigint,share:array<bigint>>>").alias("out"))
        dealt = F.aggregate("children", begin, deal, lambda a: a["out"])
        nodes = stage(nodes.join(children, "node").select(F.explode(dealt).alias("c")).select("c.node", "c.share"), f"shard_level{level}")
    return nodes.withColumnRenamed("node", "pid")


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", seed: int = 11,
          carry: Sequence[str] = ()) -> DataFrame:
    """(id, size, crc, shard, slot): shards of exact size, slots from 0 without gaps in a uniform random order.

    ``carry`` names columns of ``docs`` that come back in a struct ``row``.
    """
    text = F.col(text_col)
    rows = stage(docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("crc"),
        F.spark_partition_id().cast("long").alias("pid"),
        F.monotonically_increasing_id().alias("row_id"),
        *([F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []),
    ), "shard_rows")
    counts = stage(rows.groupBy("pid").agg(F.count(F.lit(1)).alias("n")), "shard_counts")
    n_rows = counts.agg(F.sum("n")).first()[0] or 0
    matrix = communication_matrix(counts, shards, n_rows, seed)
    upto = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda i: F.aggregate(
        F.slice("share", 1, i), F.lit(0).cast("bigint"), lambda t, x: t + x))
    matrix = stage(matrix.select("pid", upto.alias("upto")), "shard_matrix")

    first = Window.partitionBy("pid").orderBy(F.xxhash64(F.lit(seed), F.lit("first"), "id", "row_id"), "row_id")
    narrow = rows.select("pid", "id", "row_id").withColumn("nth", F.row_number().over(first) - 1)
    buckets = max(1, -(-n_rows // (shards * SLOT_ROWS)))
    dealt = stage(
        narrow.join(matrix, "pid").select(
            "row_id",
            F.size(F.filter("upto", lambda x: x <= F.col("nth"))).alias("shard"),
            F.xxhash64(F.lit(seed), F.lit("second"), "id", "row_id").alias("order"),
        ).withColumn("bucket", F.floor(unit(F.col("order")) * buckets)),
        "shard_dealt")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
                    .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "shard_offsets")
    second = Window.partitionBy("shard", "bucket").orderBy("order", "row_id")
    placed = (dealt.withColumn("at", F.row_number().over(second) - 1).join(offsets, ["shard", "bucket"])
              .select("row_id", "shard", (F.col("offset") + F.col("at")).alias("slot")))
    return rows.join(placed, "row_id").select("id", "size", "crc", "shard", "slot", *(["row"] if carry else []))


def write_shards(sharded: DataFrame, path: str, shards: int) -> None:
    """One folder per shard, rows in slot order within its files."""
    (sharded.repartition(shards, "shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
