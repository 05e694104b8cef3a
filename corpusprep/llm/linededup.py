"""Line dedup: exact set-similarity join of lines, as DataFrame operations.

A line's tokens are the hashes of its runs of ``n`` words (its whole word sequence if it has fewer).  Tokens are
ordered by rarity: ``BUCKETS`` counters over all words of the corpus give each word a frequency class, and a
token's sort key is the class of its rarest word followed by its hash.  A run is at most as frequent as its rarest
word, so tokens with a rare word come first and those of common passages last.  Lines with Jaccard >= t share a token among their first n - ceil(t n) + 1 (prefix filter), their
sizes differ by t at most (length filter), and the place of the shared token limits what they can still share
(positional filter).  Surviving pairs are verified on their whole token sets.

Lines are compared with the first line of each of their keys first; what that settles looks for no other partner.

A line occurrence is removed when an equal or linked line occurs earlier; documents are ordered by id (null ids
last, then by a hash of the text), lines by their number.  Equal lines are one class with its first occurrence, so a
line that occurs a billion times is compared once.

Defined cases: null texts stay null; lines without a word are never removed; rows with the same id and text are one
document and come out alike; a document may lose all its lines and then has an empty text; an empty table gives no
rows; very long lines are read whole.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, stage_alone

BUCKETS = 1 << 16
#: Longs that are sent to all tasks at most (16 bytes each in a hash table).
BROADCAST_KEYS = 1 << 20


def _line_hash(line: Column) -> list[Column]:
    """128 bits, as two longs."""
    return [F.xxhash64(line), F.xxhash64(F.lit(1), line)]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, pos, line) of all lines with a word."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.split(F.col(text_col), "\n", -1).alias("lines"))
    return rows.select("id", "text_hash", F.posexplode("lines").alias("pos", "line")).filter(F.btrim("line", F.lit(" \t\x0b\x0c\r")) != "")


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.translate(line, "\t\x0b\x0c\r", "    "), " ", -1), "")


def _place() -> Column:
    """Where a line stands: documents by id (null ids last) and a hash of the text, lines by number."""
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "pos")


def _bucket(word_hash: Column) -> Column:
    return word_hash.bitwiseAND(BUCKETS - 1).cast("int")


_LOW = (1 << 58) - 1


def _tokens(line: Column, n: int, classes: Column) -> Column:
    """Different tokens of a line, rarest first: 5 bits of the rarest word's frequency class, 58 bits of hash."""
    key = lambda h: F.shiftleft(F.get(classes, _bucket(h)).cast("bigint"), 58).bitwiseOR(h.bitwiseAND(F.lit(_LOW)))
    words = F.transform(F.transform(_words(line), lambda w: F.xxhash64(w)), key)

    def runs(w):
        size = F.size(w)
        low = lambda h: h.bitwiseAND(F.lit(_LOW))
        fields = [f"w{i}" for i in range(n)]
        # the words of a run side by side, so that a token costs n steps, however long the line is
        beside = F.arrays_zip(*[(w if i == 0 else F.slice(w, i + 1, F.greatest(size - i, F.lit(0)))).alias(f) for i, f in enumerate(fields)])

        def token(z):
            parts = [z[f] for f in fields]
            return (F.least(*parts) if n > 1 else parts[0]).bitwiseAND(F.lit(~_LOW)).bitwiseOR(low(F.xxhash64(*parts)))

        short = F.array(F.array_min(w).bitwiseAND(F.lit(~_LOW)).bitwiseOR(low(F.xxhash64(F.lit(0), w))))
        return F.when(size < n, short).otherwise(F.transform(F.slice(beside, 1, F.greatest(size - (n - 1), F.lit(1))), token))

    return F.sort_array(F.array_distinct(F.element_at(F.transform(F.array(words), runs), 1)))


def frequency_classes(lines: DataFrame) -> list[int]:
    """A class for each bucket of words, 0 the rarest: half steps of the binary logarithm of its count over the mean."""
    counts = (lines.select(F.explode(_words(F.col("line"))).alias("w")).groupBy(_bucket(F.xxhash64("w")).alias("b"))
              .agg(F.count(F.lit(1)).alias("n")))
    got = {r["b"]: r["n"] for r in counts.collect()}  # BUCKETS rows at most
    mean = max(1.0, sum(got.values()) / BUCKETS)
    return [min(31, max(0, 12 + round(2 * math.log2(got[b] / mean)))) if b in got else 0 for b in range(BUCKETS)]


def _part(size: Column, num: int, den: int) -> Column:
    """ceil(size * num / den) in whole numbers."""
    return F.floor((size * num + (den - 1)) / den).cast("int")


def _class_table(lines: DataFrame, tokens: Column, num: int, den: int) -> DataFrame:
    """Classes of equal lines: (h1, h2, first, times, size, prefix), ``first`` being the place of the first occurrence."""
    h1, h2 = _line_hash(F.col("line"))
    size = F.size("keys")
    prefix = F.slice("keys", 1, F.greatest(F.lit(1), size - _part(size, num, den) + 1))
    return stage(
        lines.select(h1.alias("h1"), h2.alias("h2"), _place().alias("place"), tokens.alias("keys"))
        .select("h1", "h2", "place", size.alias("size"), prefix.alias("prefix"))
        .groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times"), F.first("size").alias("size"),
                                 F.first("prefix").alias("prefix")), "line_classes")


def _shared_keys(classes: DataFrame) -> DataFrame:
    """(key, line, id, packed, lead, lead_packed) for each line that shares a prefix key with an earlier one, the first of which leads.

    ``packed`` holds a line's size and the key's place in it.  Keys of one line only go here and are written no more.
    """
    entries = classes.select(F.col("h1").alias("line"), F.col("first")["id"].alias("id"), "size", F.posexplode("prefix").alias("at", "key")).select(
        "key", "line", "id", (F.col("size").cast("bigint") * (1 << 32) + F.col("at")).alias("packed"))
    # keys cross the net once: the first line of a key is seen beside its other lines
    lead = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "line", "packed")).over(Window.partitionBy("key"))
    met = entries.withColumn("lead", lead).select(
        "key", "line", "id", "packed", F.col("lead")["line"].alias("lead"), F.col("lead")["packed"].alias("lead_packed"))
    return stage(met.filter("line <> lead"), "line_keys")


def _may_link(pa: Column, pb: Column, num: int, den: int) -> tuple[Column, Column, Column]:
    """Whether two lines with a shared key can be linked, by sizes and places; the overlap they need, and what is left from the key on."""
    size, at = lambda p: F.shiftright(p, 32), lambda p: p.bitwiseAND(F.lit((1 << 32) - 1))
    fits = den * F.least(size(pa), size(pb)) >= num * F.greatest(size(pa), size(pb))
    # J >= t needs this overlap; from a shared key on, at most the shorter rest can be shared
    need = F.ceil((size(pa) + size(pb)) * num / (num + den) - 1e-9)
    rest = F.least(size(pa) - at(pa), size(pb) - at(pb))
    return fits & (F.least(at(pa), at(pb)) + rest >= need), need, rest


def _settle(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(h1, h2): of each pair (a, b) of line names that is linked, the class that occurs later."""
    side = lambda x: sets.select(F.col("h1").alias(x), F.col("h2").alias(f"{x}2"), F.col("first").alias(f"f{x}"), F.col("tokens").alias(f"t{x}"))
    both = F.size(F.array_intersect("ta", "tb"))
    linked = den * both >= num * (F.size("ta") + F.size("tb") - both)
    found = pairs.join(side("a"), "a").join(side("b"), "b").filter(linked)
    later = F.when(F.col("fa") > F.col("fb"), F.struct(F.col("a").alias("h1"), F.col("a2").alias("h2"))).otherwise(
        F.struct(F.col("b").alias("h1"), F.col("b2").alias("h2")))
    return found.select(later.alias("later")).select("later.h1", "later.h2").distinct()


def _line_sets(lines: DataFrame, names: DataFrame, classes: DataFrame, tokens: Column) -> DataFrame:
    """(h1, h2, first, tokens) of the classes with these names (h1)."""
    h1, h2 = _line_hash(F.col("line"))
    names = stage(names.distinct(), "line_wanted")
    marked = F.broadcast(names) if names.count() <= BROADCAST_KEYS else names
    some = lines.select("line", h1.alias("h1"), h2.alias("h2"), _place().alias("place")).join(marked, "h1", "left_semi")
    # one occurrence of each class is split into tokens
    first = classes.join(marked, "h1", "left_semi").select("h1", "h2", "first")
    once = some.join(first, (some["h1"] == first["h1"]) & (some["h2"] == first["h2"]) & (some["place"] == first["first"])).select(
        first["h1"], first["h2"], "first", "line").dropDuplicates(["h1", "h2"])
    return stage(once.select("h1", "h2", "first", tokens.alias("tokens")), "line_sets")


def settled_lines(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Classes (h1, h2, first, times) of equal lines, and (h1, h2) of those that are linked with a class that occurs earlier.

    A line is lost as soon as one earlier line is linked, so all lines are first compared with the first line of each of
    their keys only: a group of near copies costs as many comparisons as it has lines.  Those that are settled by it
    look for no other partner (they stay partners for later lines); only the rest meets all lines of its keys.
    """
    lines = _lines(docs, id_col, text_col)
    tokens = _tokens(F.col("line"), n, F.from_json(F.lit(json.dumps(frequency_classes(lines))), "array<tinyint>"))
    classes = _class_table(lines, tokens, num, den)
    keys = _shared_keys(classes)

    possible, _, _ = _may_link(F.col("packed"), F.col("lead_packed"), num, den)
    pairs = stage(keys.filter(possible).select(F.col("line").alias("a"), F.col("lead").alias("b")).distinct(), "line_pairs")
    sets = _line_sets(lines, pairs.select(F.col("a").alias("h1")).union(pairs.select("b")), classes, tokens)
    settled = stage(_settle(pairs, sets, num, den), "line_settled")
    # names all of whose classes are settled
    open_names = sets.join(settled, ["h1", "h2"], "left_anti").select("h1")
    closed = settled.select("h1").distinct().join(open_names, "h1", "left_anti").select(F.col("h1").alias("line"))

    left = keys.join(closed, "line", "left_anti").select("key", F.col("line").alias("a"), F.col("id").alias("ia"), F.col("packed").alias("pa"))
    right = keys.select("key", F.col("line").alias("b"), F.col("id").alias("ib"), F.col("packed").alias("pb"))
    possible, need, rest = _may_link(F.col("pa"), F.col("pb"), num, den)
    earlier = F.col("ia").isNull() | (F.col("ib") <= F.col("ia"))
    met = left.join(right, "key").filter((F.col("a") != F.col("b")) & earlier & possible)
    # pairs none of which leads a shared key: all shared keys of their prefixes are here, and the rest behind the last one
    more = stage(met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min(rest).alias("rest"), F.max(need).alias("need"))
                 .filter(F.col("shared") + F.col("rest") - 1 >= F.col("need")).select("a", "b").join(pairs, ["a", "b"], "left_anti"), "line_pairs")
    names = more.select(F.col("a").alias("h1")).union(more.select("b")).join(sets.select("h1"), "h1", "left_anti")
    sets = sets.unionByName(_line_sets(lines, names, classes, tokens))
    return classes.select("h1", "h2", "first", "times"), settled.unionByName(_settle(more, sets, num, den)).distinct()


def removed_lines(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, removed): the line numbers that a document loses, where there are any."""
    return stage_alone(docs.sparkSession, "line_removed", lambda: _removed(docs, n, num, den, id_col, text_col))


def _removed(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    classes, settled = settled_lines(docs, n, num, den, id_col, text_col)
    # a class's later occurrences go, and its first one if the class is settled
    firsts = classes.join(settled, ["h1", "h2"], "left_semi").select("first.id", "first.text_hash", "first.pos")
    repeated = stage(classes.filter("times > 1").select("h1", "h2", "first"), "line_repeated")
    h1, h2 = _line_hash(F.col("line"))
    occurrences = _lines(docs, id_col, text_col).select(_place().alias("place"), h1.alias("h1"), h2.alias("h2"))
    later = occurrences.join(repeated, ["h1", "h2"]).filter(F.col("place") > F.col("first")).select("place.id", "place.text_hash", "place.pos")
    return firsts.unionByName(later).groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def dedup_lines(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines taken out of the text column; all rows and columns stay."""
    removed = removed_lines(docs, n, num, den, id_col, text_col)
    names = [f"_removed_{i}_{'_'.join(docs.columns)}" for i in range(3)]  # none clashes with a column of docs
    lost = removed.select(F.col("id").alias(names[0]), F.col("text_hash").alias(names[1]), F.col("removed").alias(names[2]))
    joined = docs.join(lost, docs[id_col].eqNullSafe(F.col(names[0])) & (F.xxhash64(docs[text_col]) == F.col(names[1])), "left")
    left = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda line, i: ~F.array_contains(F.col(names[2]), i)), "\n")
    return joined.withColumn(text_col, F.when(F.col(names[2]).isNull(), F.col(text_col)).otherwise(left)).drop(*names).select(*docs.columns)
