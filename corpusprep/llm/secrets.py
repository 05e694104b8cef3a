"""Secret scan: fixed patterns plus sliding-window entropy, as column expressions.

Two finders run on every whole text:

* base patterns (``BASE``): leftmost non-overlapping matches of each kind;
* entropy: candidate strings (runs of 20 or more token characters) are classed
  by their characters; a window slides over each, its Shannon entropy kept up to
  date by adding the entering and removing the leaving character's count.  Windows
  at or above the class's bits are merged into spans.  Candidates on the allow list
  (words, paths of words, digit groups, UUIDs, long repeats, marked examples) are
  suppressed; so are spans that lie inside a base match.

The entropy of a window of W characters with counts c is log2 W - sum(c log2 c) / W,
so the test is an upper bound on sum(c log2 c), held in integer millionths: the
result does not depend on the order of updates.

Defined cases: a null or empty text has no spans; equal rows give equal results;
offsets are code points, ends exclusive.  Per-row work only: no shuffle, no state.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class Pattern:
    """``value_group`` is the group whose length must reach ``min_length``."""
    kind: str
    regex: str
    value_group: int = 0
    min_length: int = 1


# A run of 24 or more is what remains of all maximal runs when the shorter ones are
# dropped; the same holds for AKIA with 16 more.  An assignment that is dropped
# still uses up its characters, so its length is tested after matching.
BASE = (
    Pattern("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Pattern("access", "AKIA[A-Z0-9]{16,}"),
    Pattern("hex", "[0-9a-f]{24,}"),
)

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"


@dataclass(frozen=True)
class EntropyClass:
    """Candidates that match ``regex`` (the first class that does counts)."""
    name: str
    regex: str
    window: int
    bits: float


CLASSES = (
    EntropyClass("hex", "^[0-9A-Fa-f]+$", 20, 3.0),
    EntropyClass("base64", "^[A-Za-z0-9+/_=-]+$", 20, 3.7),
)

ALLOW = (
    # possessive groups: what follows a word begins with a separator, so nothing is ever given back, and a group
    # that never gives back takes no stack, however long the candidate is
    "^[A-Za-z]?[a-z]*(?:[-_/+=]+[A-Za-z]?[a-z]*)*+$",  # words and paths of words
    "^[A-Z]*(?:[-_/+=]+[A-Z]*)*+$",  # the same in capitals
    "^[0-9_/+=-]+$",  # digit groups, dates, rulers
    "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # UUIDs
    "([-_/+=A-Za-z0-9])\\1{9,}",  # long repeats
    "(?i)example|placeholder|xxxx|changeme",  # marked as no secret
)

#: Matches that are placed in one go.
RUN = 256

_SPANS = "array<struct<start:int,rank:int,end:int>>"


def clogc(window: int) -> list[int]:
    """c log2 c in millionths for c = 0 .. window."""
    return [0] + [round(c * math.log2(c) * 1e6) for c in range(1, window + 1)]


def clogc_bound(window: int, bits: float) -> int:
    """The largest sum(c log2 c) of a window that has at least ``bits`` of entropy."""
    return math.floor(window * (math.log2(window) - bits) * 1e6)


def _matches(text: Column, regex: str, value_group: int) -> Column:
    """array<struct<start, found, value>> of the leftmost non-overlapping matches."""
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(regex), F.lit(value_group)) if value_group else found
    parts = F.arrays_zip(F.split(text, regex, -1).alias("gap"), found.alias("found"), value.alias("value"))
    kind = "array<struct<start:int,found:string,value:string>>"

    def run(some):
        """The matches of a run of parts, counted from the run's start, and where it ends."""
        begin = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

        def step(acc, part):
            at = acc["at"] + F.char_length(part["gap"])
            item = F.struct(at.alias("start"), part["found"].alias("found"), part["value"].alias("value"))
            # the last gap has no match behind it
            return F.when(part["found"].isNull(), acc).otherwise(F.struct(
                (at + F.char_length(part["found"])).alias("at"), F.concat(acc["out"], F.array(item)).alias("out")))

        return F.aggregate(some, begin, step)

    def shift(runs):
        """Runs of runs: where each begins is the sum of those before it."""
        begins = F.aggregate(runs, F.array(F.lit(0)), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r["at"])))
        return _let(begins, lambda b: F.flatten(F.transform(runs, lambda r, i: F.transform(r["out"], lambda m: F.struct(
            (m["start"] + F.element_at(b, i + 1)).alias("start"), m["found"].alias("found"), m["value"].alias("value"))))))

    # arrays grow by copying: only within runs, so that a text of many matches does not cost their square
    return _let(parts, lambda p: _let(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(p) - 1) / RUN).cast("int")), lambda k: run(F.slice(p, k * RUN + 1, F.lit(RUN)))), shift))


def _base_spans(text: Column, p: Pattern) -> Column:
    spans = F.transform(
        F.filter(_matches(text, p.regex, p.value_group), lambda m: F.char_length(m["value"]) >= p.min_length),
        lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(p.kind)).alias("rank"),
                           (m["start"] + F.char_length(m["found"])).alias("end")))
    return F.when(text.rlike(p.regex), spans).otherwise(F.array().cast(_SPANS))


def _windows(start: Column, string: Column, cls: EntropyClass) -> Column:
    """Merged spans of the windows of ``string`` that reach the class's bits."""
    w, bound = cls.window, clogc_bound(cls.window, cls.bits)
    f = F.array(*[F.lit(x).cast("bigint") for x in clogc(w)])
    at = lambda c: F.element_at(f, c + 1)

    def scan(s):  # s: chars, the positions of the candidate's characters in its own alphabet
        zeros = F.struct(
            F.transform(s["alphabet"], lambda _: F.lit(0)).alias("counts"), F.lit(0).cast("bigint").alias("sum"),
            F.lit(-1).alias("open"), F.lit(-1).alias("close"), F.array().cast(_SPANS).alias("out"))

        def step(acc, i):
            into = F.element_at(s["chars"], i)
            outof = F.when(i > w, F.element_at(s["chars"], F.greatest(i - w, F.lit(1)))).otherwise(F.lit(0))
            had = F.element_at(acc["counts"], into)
            left = F.element_at(acc["counts"], F.greatest(outof, F.lit(1)))
            total = F.when(into == outof, acc["sum"]).otherwise(
                acc["sum"] + at(had + 1) - at(had) + F.when(outof > 0, at(left - 1) - at(left)).otherwise(F.lit(0).cast("bigint")))
            counts = F.transform(acc["counts"], lambda c, j: c + (j + 1 == into).cast("int") - (j + 1 == outof).cast("int"))
            return F.struct(counts.alias("counts"), total.alias("sum"), acc["open"].alias("open"), acc["close"].alias("close"),
                            acc["out"].alias("out"))

        def close(acc, i):
            hit = (i >= w) & (acc["sum"] <= bound)
            fresh = hit & (i - w > acc["close"])
            done = F.when(fresh & (acc["close"] >= 0), F.concat(acc["out"], F.array(span(acc["open"], acc["close"])))).otherwise(acc["out"])
            return F.struct(acc["counts"].alias("counts"), acc["sum"].alias("sum"), F.when(fresh, i - w).otherwise(acc["open"]).alias("open"),
                            F.when(hit, i).otherwise(acc["close"]).alias("close"), done.alias("out"))

        def span(a, b):
            return F.struct((start + a).alias("start"), F.lit(KINDS.index("entropy")).alias("rank"), (start + b).alias("end"))

        steps = F.sequence(F.lit(1), F.size(s["chars"]))
        return F.aggregate(
            steps, zeros, lambda acc, i: _let(step(acc, i), lambda a: close(a, i)),
            lambda acc: F.when(acc["close"] >= 0, F.concat(acc["out"], F.array(span(acc["open"], acc["close"])))).otherwise(acc["out"]))

    chars = F.split(string, "")
    return _let(F.array_distinct(chars), lambda alphabet: _let(
        F.struct(alphabet.alias("alphabet"), F.transform(chars, lambda c: F.array_position(alphabet, c).cast("int")).alias("chars")), scan))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _entropy_spans(text: Column) -> Column:
    none = F.array().cast(_SPANS)

    def spans(m):
        allowed = F.lit(False)
        for regex in ALLOW:
            allowed = allowed | m["found"].rlike(regex)
        found = none
        for cls in reversed(CLASSES):
            found = F.when(m["found"].rlike(cls.regex), _windows(m["start"], m["found"], cls)).otherwise(found)
        return F.when(allowed, none).otherwise(found)

    return F.when(text.rlike(CANDIDATE), F.flatten(F.transform(_matches(text, CANDIDATE, 0), spans))).otherwise(none)


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Adds ``out``: struct<base, entropy> of span arrays (start, rank in KINDS, end), each in order.

    A column of ``docs`` called like ``out`` is replaced; all others stay.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = F.sort_array(F.concat(*[_base_spans(text, p) for p in BASE]))
    with_base = docs.withColumn(out, F.struct(base.alias("base"), _entropy_spans(text).alias("entropy")))
    clear = F.filter(F.col(out)["entropy"], lambda e: ~F.exists(
        F.col(out)["base"], lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])))
    return with_base.withColumn(out, F.struct(F.col(out)["base"].alias("base"), clear.alias("entropy")))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def redact(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark`` (overlapping spans by one mark)."""
    spans = F.sort_array(F.concat(secrets["base"], secrets["entropy"]))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, begin,
        lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] < a["at"], a["out"]).otherwise(
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def _sql_matches(name: str, regex: str, value_group: int) -> str:
    r = regex.replace("'", "''")
    return f"""{name} AS (
  SELECT doc_id, found, value,
         sum(length(gap)) OVER w + coalesce(sum(length(found)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT doc_id, generate_subscripts(found, 1) AS i, unnest(found) AS found, unnest(value) AS value, unnest(gap[1:len(found)]) AS gap
        FROM (SELECT doc_id, regexp_extract_all(t, '{r}', 0) AS found, regexp_extract_all(t, '{r}', {value_group}) AS value,
                     string_split_regex(t, '{r}') AS gap FROM d))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


def oracle_sql() -> str:
    """The same spans in DuckDB, each window counted afresh."""
    parts = ["d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"]
    union = []
    for p in BASE:
        parts.append(_sql_matches(f"m_{p.kind}", p.regex, p.value_group))
        union.append(f"SELECT doc_id, {KINDS.index(p.kind)} AS rank, start, start + length(found) AS stop FROM m_{p.kind} "
                     f"WHERE length(value) >= {p.min_length}")
    parts.append("base AS (" + " UNION ALL ".join(union) + ")")
    parts.append(_sql_matches("m_cand", CANDIDATE, 0))
    # DuckDB's engine knows no possessive groups and needs none
    allow = " AND ".join("NOT regexp_matches(found, '{}')".format(a.replace(")*+$", ")*$")) for a in ALLOW if "\\1" not in a)
    repeats = " AND ".join(f"NOT contains(found, repeat('{c}', 10))" for c in
                           "-_/+=0123456789" + "".join(map(chr, range(65, 91))) + "".join(map(chr, range(97, 123))))
    cls = "CASE " + " ".join(f"WHEN regexp_matches(found, '{c.regex}') THEN {i}" for i, c in enumerate(CLASSES)) + " END"
    pick = lambda get: "CASE cls " + " ".join(f"WHEN {i} THEN {get(c)}" for i, c in enumerate(CLASSES)) + " END"
    w = max(c.window for c in CLASSES)
    parts.append(f"cand AS (SELECT row_number() OVER (ORDER BY doc_id, start) AS id, doc_id, start, found, {cls} AS cls FROM m_cand WHERE {allow} AND {repeats})")
    parts.append(f"win AS (SELECT id, doc_id, start, cls, found, {pick(lambda c: c.window)} AS w, {pick(lambda c: clogc_bound(c.window, c.bits))} AS bound, "
                 f"unnest(range(0, greatest(0, length(found) - {pick(lambda c: c.window)} + 1))) AS k FROM cand)")
    parts.append(f"hit AS (SELECT id, doc_id, start + k AS a, start + k + w AS b FROM win WHERE bound >= list_sum(list_transform("
                 f"map_values(list_aggregate(string_split(substr(found, (k + 1)::BIGINT, w), ''), 'histogram')), lambda c: ({clogc(w)})[c::BIGINT + 1])))")
    parts.append("isle AS (SELECT *, sum(CASE WHEN before IS NULL OR a > before THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY a) AS g "
                 "FROM (SELECT *, lag(b) OVER (PARTITION BY id ORDER BY a) AS before FROM hit))")
    parts.append("ent AS (SELECT doc_id, 3 AS rank, min(a) AS start, max(b) AS stop FROM isle GROUP BY id, doc_id, g)")
    parts.append("kept AS (SELECT * FROM ent e WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND b.start <= e.start AND e.stop <= b.stop))")
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    text = f"{kinds}[rank + 1] || ':' || start::BIGINT || ':' || stop::BIGINT"
    parts.append(f"a AS (SELECT doc_id, string_agg({text}, ',' ORDER BY start, rank) AS s, count(*) FILTER (rank = 0) AS n0, "
                 "count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2 FROM base GROUP BY doc_id)")
    parts.append(f"b AS (SELECT doc_id, string_agg({text}, ',' ORDER BY start, rank) AS s, count(*) FILTER (rank = 3) AS n3 "
                 "FROM (SELECT * FROM base UNION ALL SELECT * FROM kept) GROUP BY doc_id)")
    return ("WITH " + ",\n".join(parts) + "\nSELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, "
            "sha256(coalesce(a.s, '')) AS base_sha256, coalesce(b.s, '') AS spans, coalesce(n3, 0) AS n_entropy "
            "FROM d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)")
