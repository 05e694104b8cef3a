"""Per-language sampling and first-N selections.

Both decide on narrow staged columns and then fetch the few chosen rows, so no
record crosses a shuffle to be ranked.  "The first N" counts rows per group and split
and numbers rows only in the split where a group reaches N; the sample ranks
only IDs whose hash lies below a bound that about N of a language pass.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.fixed import DEFAULT_SEED
from corpusprep.functions.coerce import as_str
from corpusprep.operators.filtering import type_matches
from corpusprep.operators.identity import RID
from corpusprep.sources.jsonl import SEQ, VAR

LANG = "_lang"


def clean_languages(languages: Iterable[str] | None) -> list[str] | None:
    """Whitelist: stripped, deduplicated, blanks dropped; None = discover."""
    if languages is None:
        return None
    return sorted({x.strip() for x in languages if x and x.strip()})


def discover_languages(
    records: DataFrame, *, lang_field: str = "lg", type_field: str = "", type_value: str = ""
) -> DataFrame:
    """Distinct non-blank languages of type-matching records, sorted."""
    v = F.col(VAR)
    langs = records.filter(type_matches(v, type_field, type_value)).select(as_str(v, lang_field).alias(lang_field))
    return langs.filter(F.col(lang_field) != "").distinct().orderBy(lang_field)


def sample_order(seed: int, key: str = RID):
    """Seeded uniform order: a hash of seed and ID, ties by ID."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))), F.col(key)]


def sample_position(seed: int, key: str = RID):
    """The first 52 bits of the sample order's hash as a number in [0, 1)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def _bounds(pool: DataFrame, n: int, lang_col: str) -> DataFrame:
    """``_bound`` per language: a little above n / count, or 1 where fewer than n pass it."""
    sizes = pool.groupBy(lang_col).agg(F.count(F.lit(1)).alias("_ids"))
    sizes = sizes.withColumn("_bound", F.lit(n + 4 * n ** 0.5 + 16) / F.col("_ids"))
    passed = pool.join(sizes, lang_col).filter(F.col("_u") < F.col("_bound")).groupBy(lang_col).agg(F.count(F.lit(1)).alias("_passed"))
    enough = F.coalesce("_passed", F.lit(0)) >= F.least(F.lit(n), F.col("_ids"))
    return sizes.join(passed, lang_col, "left").select(lang_col, F.when(enough, F.col("_bound")).otherwise(1.0).alias("_bound"))


def sample_per_language(
    candidates: DataFrame,
    n: int,
    *,
    seed: int = DEFAULT_SEED,
    languages: Iterable[str] | None = None,
    lang_col: str = LANG,
    key: str = RID,
    fetch_from: DataFrame | None = None,
) -> DataFrame:
    """At most ``n`` distinct IDs per language, uniform and repeatable for a seed.

    ``candidates`` carries the ID (``key``), language (``lang_col``) and line
    position (``_seq``).  Only the narrow ``(id, language, position)`` tuples
    are deduplicated (earliest line per ID) and ranked; the picked IDs --
    at most ``n`` per language -- are staged and their rows fetched by ID alone.
    A line position depends on how a scan is cut, so it never joins two scans:
    of several lines with a picked ID the earliest is kept afterwards, on the
    fetched rows only.  ``fetch_from`` names where the full rows are fetched
    (default: the candidates); pass the records *before* an anti join so full
    records never cross a shuffle.  The result does not depend on how the input
    is partitioned, nor on a new layout between ranking and fetching.
    """
    from corpusprep.operators.identity import keep_first
    from corpusprep.sources.staging import stage

    wanted = clean_languages(languages)

    def in_languages(rows: DataFrame) -> DataFrame:
        rows = rows.filter(F.col(lang_col) != "")
        return rows if wanted is None else rows.filter(F.col(lang_col).isin(wanted))

    pool = in_languages(candidates)
    if SEQ not in pool.columns:
        pool = pool.withColumn(SEQ, F.monotonically_increasing_id())
    # earliest line per ID decides its language (keep-first dedup), narrow
    # struct order compares the line position first (positions are unique)
    firsts = pool.groupBy(key).agg(F.min(F.struct(F.col(SEQ).alias("_s"), F.col(lang_col).alias("_l"))).alias("_f"))
    firsts = firsts.select(key, F.col("_f._l").alias(lang_col)).withColumn("_u", sample_position(seed, key))
    firsts = stage(firsts, "sample_pool")
    near = firsts.join(_bounds(firsts, n, lang_col), lang_col).filter(F.col("_u") < F.col("_bound"))
    w = Window.partitionBy(lang_col).orderBy(*sample_order(seed, key))
    picked = near.withColumn("_pick", F.row_number().over(w)).filter(F.col("_pick") <= n).select(key)
    picked = stage(picked, "sample_ids")  # at most n per language
    source = pool if fetch_from is None else in_languages(fetch_from)
    if SEQ not in source.columns:
        source = source.withColumn(SEQ, F.monotonically_increasing_id())
    return keep_first(source.join(picked, key, "left_semi"), key, SEQ).select(*source.columns)


def _split_of(df: DataFrame, order: str):
    """The part of a line's position that names its split (runs of 65,536 for plain numbers)."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.StructType):
        return F.struct(*[F.col(order)[f].alias(f) for f in kind.names[:-1]])
    if isinstance(kind, T.IntegralType):
        return F.floor(F.col(order) / 65536)
    raise TypeError(f"{order}: a line position (line_seq) or a whole number, not {kind.simpleString()}")


def first_n_per_group(df: DataFrame, group_col: str, n: int, order: str = SEQ) -> DataFrame:
    """The first ``n`` rows of each group in ``order``.

    Group, position and a 128-bit hash of the row are staged.  Rows are counted by group and split; running sums
    over the splits of a group say which of them lie within its first n, and only in the one where
    n is reached are positions numbered: the largest task holds the narrow rows of one split.  The chosen rows are
    fetched by group and hash (rows that are equal but for their position stand in for each other), so positions
    never join two scans.  Null groups form a group.  The parsed VARIANT is not carried:
    the few selected lines are parsed again.
    """
    from corpusprep.sources.jsonl import STATUS, parse_lines
    from corpusprep.sources.staging import stage

    carried = [c for c in df.columns if c not in (VAR, STATUS, order)]
    row = F.struct(F.xxhash64(*carried).alias("x"), F.xxhash64(F.lit(1), *carried).alias("y"))
    narrow = stage(df.select(F.col(group_col).alias("_g"), F.col(order).alias("_o"), _split_of(df, order).alias("_s"), row.alias("_k")), "first_n")
    ahead = Window.partitionBy("_g").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    counts = narrow.groupBy("_g", "_s").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_left", F.lit(n) - F.coalesce(F.sum("_n").over(ahead), F.lit(0))).filter("_left > 0")
    counts = stage(counts.select(F.col("_g").alias("_cg"), F.col("_s").alias("_cs"), "_n", "_left"), "first_n_splits")
    met = narrow.join(counts, F.col("_g").eqNullSafe(F.col("_cg")) & (F.col("_s") == F.col("_cs")))
    whole = met.filter(F.col("_n") <= F.col("_left")).select("_g", "_o", "_k")
    numbered = met.filter(F.col("_n") > F.col("_left")).withColumn("_i", F.row_number().over(Window.partitionBy("_g", "_s").orderBy("_o")))
    picked = stage(whole.unionByName(numbered.filter(F.col("_i") <= F.col("_left")).select("_g", "_o", "_k")), "first_n_picked")
    wanted = picked.select(F.col("_g").alias("_wg"), F.col("_k").alias("_wk")).distinct()
    found = df.select(F.struct(*carried).alias("_row"), row.alias("_k"))
    same = F.col(f"_row.{group_col}").eqNullSafe(F.col("_wg")) & (F.col("_k") == F.col("_wk"))
    rows = found.join(wanted, same).groupBy("_wg", "_wk").agg(F.first("_row").alias("_row"))
    first = picked.join(rows, F.col("_g").eqNullSafe(F.col("_wg")) & (F.col("_k") == F.col("_wk")))
    columns = [F.col("_o").alias(c) if c == order else F.col("_row")[c].alias(c) for c in df.columns if c not in (VAR, STATUS)]
    first = first.select(*columns)
    return parse_lines(first) if VAR in df.columns and "value" in df.columns else first
