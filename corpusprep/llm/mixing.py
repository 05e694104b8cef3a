"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  The whole part of target / source size is
allocated to each of its documents with certainty.  The rest is a Pareto order sample with unequal
probabilities: a document of s words has the inclusion odds level * (1 + floor(log2 s)), so that longer documents are likelier,
and the source's level is such that the expected words are the rest.  With u uniform, documents are
ranked by (u / (1 - u)) / (inclusion odds) and taken in that order until the source's remaining words are used
up (the sample size is fixed in words, so each source comes out at its target).

A document that would pass the target is skipped and the next ones are tried, through
the whole source, until less than one word is left.

Ranking a source never sorts it as a whole.  A round cuts what is left of a source, without
the documents that no longer fit, into buckets of the rank; bucket sums tell which buckets are
taken whole and in which one the target is crossed; only that one is ordered.  The next
round goes on behind it.  A crossing bucket of more than ``BUCKET_ROWS`` documents is cut
again, documents of equal rank by a hash of their row, so none is ordered beyond that size.

Defined cases: a null text has no words; a null source is a source of its own,
last in order; null ids are kept as they are; rows with equal id and text are
separate documents with the same rank, in an order by row; an empty table gives no rows; a source
without words has target 0.  Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, unit, word_count

#: Documents that one task orders at most; buckets have half as many on average.
BUCKET_ROWS = 4096

#: Keys are (rank, tie): ranks lie in (0, 1), ties are any long.
_KEY = "struct<rank:double,tie:bigint>"
#: Halvings of the interval of log levels, -LEVEL .. LEVEL.
HALVINGS, LEVEL = 60, 60.0
_SPANS = f"array<struct<lo:{_KEY},hi:{_KEY},room:double,listed:boolean>>"


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, max_copies: int) -> DataFrame:
    """One row per source: source, source_size, n_docs, target.

    The weights go round the sources in code point order (null last).  ``share`` of
    all words is dealt by weight; what passes ``max_copies`` times a source's size
    goes to the others by weight, until none is above.  Sources are ordered by
    (limit / weight): the limited ones are a prefix of that order.  The table has a
    row per source only, made from sums, so its two windows hold no documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = per_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")))
    cap = (F.col("source_size") * max_copies).cast("double")
    by_limit = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = weighted.withColumn("cap", cap).select(
        "*",
        F.row_number().over(by_limit).alias("nth"),
        (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"),
    )
    # the first source, in limit order, whose part of what is left fits
    fits = F.col("cap") >= F.col("weight") * F.col("left") / F.col("left_weight")
    first = F.min(F.when(fits, F.struct("nth", "left", "left_weight"))).over(every)
    return level.withColumn("first", first).select(
        "source", "source_size", "n_docs",
        F.when(F.col("nth") < F.col("first.nth"), F.col("cap"))
        .otherwise(F.col("weight") * F.col("first.left") / F.col("first.left_weight")).alias("target"),
    )


def preference(size: Column) -> Column:
    """The factor of a document's inclusion odds: 1 more for each doubling of its words."""
    return F.when(size > 0, 1 + F.floor(F.log2(size))).otherwise(1).cast("double")


def _expected(level: Column, factor: Column) -> Column:
    """Inclusion probability at the odds level * factor."""
    return level * factor / (1 + level * factor)


def odds_levels(sizes: DataFrame) -> DataFrame:
    """(source_key, classes): words by preference of each source, some 60 entries at most."""
    by_class = sizes.groupBy("source", preference(F.col("size")).alias("factor")).agg(F.sum("size").alias("words"))
    return by_class.groupBy(F.col("source").alias("source_key")).agg(F.sort_array(F.collect_list(F.struct("factor", "words"))).alias("classes"))


def solve_level(classes: Column, left: Column) -> Column:
    """The level at which the expected words of ``classes`` are ``left``: halving, as they grow with the level."""

    def words(at: Column) -> Column:
        return F.aggregate(classes, F.lit(0.0), lambda acc, c: acc + c["words"] * _expected(F.exp(at), c["factor"]))

    def halve(span: Column, _: Column) -> Column:
        middle = (span["lo"] + span["hi"]) / 2
        below = words(middle) < left
        return F.struct(F.when(below, middle).otherwise(span["lo"]).alias("lo"), F.when(below, span["hi"]).otherwise(middle).alias("hi"))

    begin = F.struct(F.lit(-LEVEL).alias("lo"), F.lit(LEVEL).alias("hi"))
    return F.exp(F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), begin, halve, lambda span: (span["lo"] + span["hi"]) / 2))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_copies: int = 2, seed: int = 7,
        carry: Sequence[str] = ()) -> DataFrame:
    """Rows of (id, source, size, source_size, target, copies, taken, expected, carry columns): the mix takes ``copies`` of each row.

    ``expected`` is the number of copies in expectation: certain ones and the inclusion probability.
    ``carry`` names further columns of ``docs`` to bring along; they come back in
    a struct ``row`` so that no name clashes with the operator's own.
    """
    text = F.col(text_col)
    narrow = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(text).alias("size"),
        unit(F.lit(seed), F.col(id_col), F.xxhash64(text)).alias("u"),
        F.monotonically_increasing_id().alias("row_id"),
        *([F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []),
    )
    staged = stage(narrow, "mix_docs")
    rows = staged.select("source", "size", "u", "row_id")

    copies = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    targets = stage(
        source_targets(rows, weights, share, max_copies)
        .withColumn("whole", F.coalesce(F.floor(copies), F.lit(0)).cast("long"))
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
        .join(odds_levels(rows), F.col("source").eqNullSafe(F.col("source_key")), "left")
        .withColumn("level", F.when((F.col("source_size") > 0) & (F.col("left") > 0), solve_level(F.col("classes"), F.col("left"))).otherwise(0.0))
        .drop("classes", "source_key"),
        "mix_targets")

    def ranked(frame: DataFrame) -> DataFrame:
        """Adds key: rank (in (0, 1), increasing in the Pareto ranking variable) and tie (different for each row)."""
        odds = (F.col("u") / (1 - F.col("u"))) / (F.col("level") * preference(F.col("size")))
        key = F.struct((odds / (1 + odds)).alias("rank"), F.xxhash64("row_id").alias("tie"))
        return frame.withColumn("key", F.when(F.col("level") > 0, key))

    def with_source(frame: DataFrame, table: DataFrame) -> DataFrame:
        renamed = table.withColumnRenamed("source", "source_key")
        return frame.join(renamed, frame["source"].eqNullSafe(renamed["source_key"]), "left").drop("source_key")

    picks = _fill(targets, lambda state: ranked(with_source(rows, state)))
    plan = stage(targets.join(picks.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"),
                 "mix_plan")

    out = ranked(with_source(staged, plan))
    drawn = F.exists("spans", lambda s: (F.col("key") > s["lo"]) & (F.col("key") <= s["hi"]) & (F.col("size") <= s["room"])
                     & (~s["listed"] | F.array_contains("picked", F.col("row_id"))))
    out = out.withColumn("copies", F.col("whole") + F.coalesce(drawn, F.lit(False)).cast("int"))
    return out.select("id", "source", "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"),
                      (F.col("whole") + _expected(F.col("level"), preference(F.col("size")))).alias("expected"), *(["row"] if carry else []))


def _key(rank: float, tie: int) -> Column:
    return F.struct(F.lit(rank).alias("rank"), F.lit(tie).cast("bigint").alias("tie"))


def _fill(targets: DataFrame, candidates: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(source, spans, picked): a document is drawn if it lies in one of the spans (lo < key <= hi, size <= room) and,
    where the span is listed, its row_id is picked.

    ``candidates`` gives each row (source, size, row_id, key) the columns of a table of sources.  The state of a source is
    its room, the window (lo, hi] of keys that is looked at and how that is cut: ``n_cut`` equal parts of
    cut_lo .. cut_hi, by rank or by tie.  Behind hi everything is still undecided, before lo all is decided.
    """
    start, end = _key(-1.0, 0), _key(2.0, 0)
    whole = {"cut_lo": F.lit(0.0), "cut_hi": F.lit(1.0), "by_tie": F.lit(False),
             "n_cut": F.ceil(F.col("n_docs") * 2 / BUCKET_ROWS).cast("double")}
    state = stage(targets.filter("level > 0").select(
        "source", "level", "n_docs", F.col("left").alias("room"), start.alias("lo"), end.alias("hi"), *[c.alias(n) for n, c in whole.items()],
        F.array().cast(_SPANS).alias("spans"), F.array().cast("array<bigint>").alias("picked")), "mix_state")
    inside = (F.col("key") > F.col("lo")) & (F.col("key") <= F.col("hi")) & (F.col("size") <= F.col("room")) & (F.col("room") >= 1)

    def joined(one: DataFrame, other: DataFrame) -> DataFrame:
        renamed = other.withColumnRenamed("source", "s")
        return one.join(renamed, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")

    while state.filter((F.col("room") >= 1) & (F.col("lo") < end)).limit(1).count():
        place = F.when(F.col("by_tie"), F.col("key.tie").cast("double")).otherwise(F.col("key.rank"))
        width = F.col("cut_hi") - F.col("cut_lo")
        part = F.when(width > 0, F.floor((place - F.col("cut_lo")) / F.when(width > 0, width) * F.col("n_cut"))).otherwise(0)
        sums = candidates(state.drop("spans", "picked", "n_docs")).filter(inside).withColumn(
            "bucket", F.greatest(F.lit(0), F.least(part, F.col("n_cut") - 1)).cast("long")).groupBy("source", "bucket", "room").agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
        order = Window.partitionBy("source").orderBy("bucket")
        running = sums.select("*", F.sum("words").over(order).alias("upto"),
                              F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("prev"))
        # the first bucket that leaves less than a word, if there is one
        cross = F.min(F.when(F.col("room") - F.col("upto") < 1, F.struct(
            "bucket", "n", "first", "last", "prev", (F.col("upto") - F.col("words")).alias("before"))))
        found = running.groupBy("source").agg(cross.alias("at"), F.sum("words").alias("total"))
        seen = stage(joined(state, found), "mix_round")

        # one that is small enough is ordered: take what still fits
        leaf = F.col("at").isNotNull() & (F.col("at.n") <= BUCKET_ROWS)
        behind = F.coalesce(F.col("at.prev"), F.col("lo"))
        left = F.col("room") - F.col("at.before")
        leaves = seen.filter(leaf).select("source", "level", behind.alias("lo"), F.col("at.last").alias("hi"), left.alias("room"))
        empty = F.array().cast("array<bigint>")
        picks = (
            candidates(leaves).filter(inside).groupBy("source", "room")
            .agg(F.sort_array(F.collect_list(F.struct("key", "row_id", "size"))).alias("items"))
            .select("source", F.size("items").alias("tried"), F.aggregate(
                "items", F.struct(F.col("room").alias("room"), empty.alias("ids")),
                lambda a, x: F.when((x["size"] <= a["room"]) & (a["room"] >= 1), F.struct(
                    (a["room"] - x["size"]).alias("room"), F.concat(a["ids"], F.array(x["row_id"])).alias("ids"))).otherwise(a)).alias("took")))
        picks = stage(picks, "mix_picks")

        crossed, none = F.col("at").isNotNull(), F.col("total").isNull()
        span = lambda hi, room, listed: F.array(F.struct(
            behind.alias("lo") if listed else F.col("lo"), hi.alias("hi"), room.alias("room"), F.lit(listed).alias("listed")))
        no_span = F.array().cast(_SPANS)
        taken_whole = F.when(none | (crossed & F.col("at.prev").isNull()), no_span).otherwise(
            span(F.coalesce(F.col("at.prev"), F.col("hi")), F.col("room"), False))
        deeper = crossed & ~leaf
        by_tie = F.col("at.first.rank") == F.col("at.last.rank")
        cut = {"cut_lo": F.when(by_tie, F.col("at.first.tie").cast("double")).otherwise(F.col("at.first.rank")),
               "cut_hi": F.when(by_tie, F.col("at.last.tie").cast("double")).otherwise(F.col("at.last.rank")),
               "by_tie": by_tie, "n_cut": F.ceil(F.col("at.n") * 2 / BUCKET_ROWS).cast("double")}
        state = stage(joined(seen, picks.drop("tried")).select(
            "source", "level", "n_docs",
            F.when(none, F.col("room")).when(~crossed, F.col("room") - F.col("total")).otherwise(F.coalesce(F.col("took.room"), left)).alias("room"),
            F.when(deeper, behind).when(crossed, F.col("at.last")).otherwise(F.col("hi")).alias("lo"),
            F.when(deeper, F.col("at.last")).otherwise(end).alias("hi"),
            *[F.when(deeper, cut[n]).otherwise(whole[n]).alias(n) for n in whole],
            F.concat("spans", taken_whole, F.when(leaf, span(F.col("at.last"), left, True)).otherwise(no_span)).alias("spans"),
            F.concat("picked", F.coalesce(F.col("took.ids"), empty)).alias("picked")), "mix_state")
    return state.select("source", "spans", "picked")
