"""The registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, jaccard, language, linededup, merkle, mixing, packing, quality, secrets, sharding, toxicity, trie, urls
from .common import read_table, stage


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every text; the digest covers the base patterns, ``spans`` everything."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).select("doc_id", "secrets")
    base, extra = F.col("secrets.base"), F.col("secrets.entropy")
    return found.select(
        "doc_id",
        secrets.count_kind(base, "assign").alias("n_assign"),
        secrets.count_kind(base, "access").alias("n_access"),
        secrets.count_kind(base, "hex").alias("n_hex"),
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.sort_array(F.concat(base, extra))).alias("spans"),
        F.size(extra).cast("long").alias("n_entropy"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document: weights 3, 1, 2, 150 % of all words, at most 2 copies."""
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, max_copies=2).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "expected")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine >= 0.98 between all vectors of a label."""
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    docs = read_table(spark, sf_dir, "documents")
    return jaccard.jaccard_components(docs, n=3, num=90, den=100).withColumnRenamed("id", "doc_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document loses to earlier equal or similar ones (5-word tokens, Jaccard >= 0.8)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = linededup.removed_lines(docs, n=5, num=80, den=100)
    lines = docs.select("doc_id", F.xxhash64("text").alias("hash"),
                        F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")).cast("long").alias("breaks"), F.col("text").isNull().alias("empty"))
    joined = lines.join(removed, lines["doc_id"].eqNullSafe(removed["id"]) & (lines["hash"] == removed["text_hash"]), "left")
    none = F.array().cast("array<int>")
    return joined.select("doc_id", F.when(F.col("empty"), 0).otherwise(F.col("breaks") + 1).cast("long").alias("n_lines"),
                         F.size(F.coalesce("removed", none)).cast("long").alias("n_removed"),
                         F.array_join(F.coalesce("removed", none), ",").alias("removed"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in one of 24 shards whose row counts differ by one at most."""
    docs = read_table(spark, sf_dir, "documents")
    return sharding.shard(docs, shards=24).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, max_tokens=1024, cut=True).withColumnRenamed("id", "doc_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the CRF's verdict for every document."""
    docs = read_table(spark, sf_dir, "documents")
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.assess(docs, weights).withColumnRenamed("id", "doc_id")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the fold crc32(doc_id) mod 4 = 2 is never learned from."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    models = language.learn(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return language.identify_calibrated(docs, models, ~held_out).withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score", "cross_entropy", "rejected")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; the fold crc32(doc_id) mod 5 = 0 is never learned from."""
    docs = read_table(spark, sf_dir, "documents")
    fold = lambda c: F.crc32(F.col(c).cast("string")) % 5
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), fold("id") != 0)
    return model.score(docs).select(
        F.col("id").alias("doc_id"), F.coalesce(fold("id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest, proofs and their check after tampering: where 5 divides crc32(doc_id), the leaf of the lower-cased text is folded."""
    docs = read_table(spark, sf_dir, "documents")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    lower = F.translate("text", merkle.UPPER, merkle.LOWER)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf_hash(*[lower if c == "text" else F.col(c) for c in columns]))
    proofs = merkle.build(docs, columns, "doc_id", "source", {"tampered": tampered}).proofs()
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the contract's conversations: c begins with the first h turns of c - c % 5, its own turns from the h-th on follow."""
    turns = stage(trie.number_turns(trie.turn_keys(conversations)), "trie_given")
    convs = turns.filter("place = 0").select("conv", "total")
    h, base = F.crc32(F.col("conv").cast("string")) % 9, F.col("conv") - F.col("conv") % 5
    plan = (convs.select("conv", h.alias("h"), base.alias("base")).join(convs.select(F.col("conv").alias("base"), F.col("total").alias("has")), "base", "left")
            .select("conv", "base", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken")))
    heads = turns.filter("place < 8").drop("total").withColumnRenamed("conv", "base").join(plan, "base").filter("place < h")
    own = turns.join(plan, "conv").filter("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    columns = ["conv", "place", "key", "bytes"]
    return heads.select(columns).unionByName(own.select(columns)), convs.select("conv")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(*rebuilt_turns(read_table(spark, sf_dir, "conversations")))


#: The query's rules, as fixed by the contract: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for the URL of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(read_table(spark, sf_dir, "pages"), rules).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_mix_sources": op2_mix_sources,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_line_dedup": op5_line_dedup,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_merkle": op11_merkle,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_url_filter": op13_url_filter,
}

ORACLE: dict[str, str] = {
    "op1_secrets": secrets.oracle_sql(),
}

_WORDS = "'[^\\x20\\x09-\\x0D]+'"


def _grams(words: str, n: int) -> str:
    """Distinct runs of n words of a word list; the whole list where it has fewer."""
    run = " || ' ' || ".join(f"{words}[i + {k}]" for k in range(n))
    return (f"CASE WHEN len({words}) = 0 THEN [] WHEN len({words}) < {n} THEN [array_to_string({words}, ' ')] "
            f"ELSE list_distinct(list_transform(range(1, len({words}) - {n} + 2), lambda i: {run})) END")


_REACH = """reach AS (SELECT {id} AS a, {id} AS b FROM {nodes} UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
comp AS (SELECT a AS {id}, min(b) AS component_id FROM reach GROUP BY a)"""

ORACLE["op3_embedding_dedup"] = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
{_REACH.format(id='vec_id', nodes='v')}
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN comp USING (vec_id)"""

ORACLE["op4_ngram_jaccard"] = f"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w FROM documents),
s AS (SELECT doc_id, {_grams('w', 3)} AS g FROM d),
size AS (SELECT doc_id, len(g) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
pair AS (SELECT a, b FROM met JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * met.n >= 90 * (p.n + q.n - met.n)),
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
{_REACH.format(id='doc_id', nodes='d')}
SELECT doc_id, n AS n_shingles, component_id FROM size JOIN comp USING (doc_id)"""

ORACLE["op5_line_dedup"] = f"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents),
l AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS pos, unnest(s) AS line FROM d),
o AS (SELECT *, row_number() OVER (ORDER BY doc_id, pos) AS place FROM l WHERE regexp_matches(line, {_WORDS})),
c AS (SELECT line, min(place) AS first FROM o GROUP BY line),
s AS (SELECT line, first, {_grams('w', 5)} AS g FROM (SELECT *, regexp_extract_all(line, {_WORDS}) AS w FROM c)),
e AS (SELECT line, first, len(g) AS n, unnest(g) AS g FROM s),
met AS (SELECT x.line AS a, y.line AS b, any_value(x.n) AS na, any_value(y.n) AS nb, any_value(y.first) AS other, count(*) AS n
  FROM e x JOIN e y ON x.g = y.g AND x.line <> y.line GROUP BY 1, 2),
near AS (SELECT a AS line, min(other) AS other FROM met WHERE 100 * n >= 80 * (na + nb - n) GROUP BY a),
r AS (SELECT doc_id, pos FROM o JOIN c USING (line) LEFT JOIN near USING (line) WHERE place > first OR other < place),
q AS (SELECT doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS removed FROM r GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_removed, coalesce(removed, '') AS removed
FROM d LEFT JOIN q USING (doc_id)"""

# crc32 bit by bit: DuckDB has none
_CRC = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(8 * strlen({0})), "
        "lambda i: CAST((ascii({0}[CAST(i // 8 + 1 AS INTEGER)]) >> CAST(i % 8 AS INTEGER)) & 1 AS BIGINT))), "
        "lambda c, b: xor(c >> 1, xor(c & 1, b) * 3988292384)), CAST(4294967295 AS BIGINT))")


def _crc32(number: str) -> str:
    """SQL for the unsigned crc32 of a number's decimal digits."""
    return _CRC.format(f"CAST({number} AS VARCHAR)")


def _leaf(text: str) -> str:
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tree(name: str, leaves: str, group: str) -> str:
    return f"""{name} AS (SELECT * FROM {leaves} UNION ALL SELECT {group}, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM
  (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {name}) WHERE n > 1 GROUP BY {group}, lvl, i // 16)"""


_STEP = """string_agg(CASE WHEN s.i < {at} THEN s.h ELSE '' END, '' ORDER BY s.i) || '|' || string_agg(CASE WHEN s.i > {at} THEN s.h ELSE '' END, '' ORDER BY s.i)"""

ORACLE["op11_merkle"] = f"""WITH RECURSIVE d AS (SELECT doc_id, source, {_leaf('text')} AS h, {_leaf(_LOWER_TEXT)} AS t FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM d),
n AS (SELECT source, 0 AS lvl, i, h FROM o),
{_tree('tree', 'n', 'source')},
sub AS (SELECT source, arg_max(h, lvl) AS h, max(lvl) AS height FROM tree GROUP BY source),
p AS (SELECT 0 AS g, 0 AS lvl, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, h FROM sub),
{_tree('top', 'p', 'g')},
r AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS height FROM top),
low AS (SELECT o.source, o.i, s.lvl, {_STEP.format(at='(o.i // CAST(pow(16, s.lvl) AS BIGINT))')} AS step
  FROM o JOIN sub ON sub.source IS NOT DISTINCT FROM o.source
  JOIN tree s ON s.source IS NOT DISTINCT FROM o.source AND s.lvl < sub.height AND s.i // 16 = o.i // CAST(pow(16, s.lvl + 1) AS BIGINT) GROUP BY ALL),
q AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM sub),
high AS (SELECT q.source, s.lvl, {_STEP.format(at='(q.i // CAST(pow(16, s.lvl) AS BIGINT))')} AS step
  FROM q JOIN r ON true JOIN top s ON s.lvl < r.height AND s.i // 16 = q.i // CAST(pow(16, s.lvl + 1) AS BIGINT) GROUP BY ALL),
lows AS (SELECT source, i, list(step ORDER BY lvl) AS steps FROM low GROUP BY source, i),
highs AS (SELECT source, list(step ORDER BY lvl) AS steps FROM high GROUP BY source),
f AS (SELECT o.doc_id, o.h AS leaf, sub.h AS subroot, root, list_concat(coalesce(lows.steps, []), coalesce(highs.steps, [])) AS steps,
    CASE WHEN {_crc32('o.doc_id')} % 5 = 0 THEN t ELSE o.h END AS begin
  FROM o JOIN sub ON sub.source IS NOT DISTINCT FROM o.source JOIN r ON true
  LEFT JOIN lows ON lows.source IS NOT DISTINCT FROM o.source AND lows.i = o.i LEFT JOIN highs ON highs.source IS NOT DISTINCT FROM o.source),
e AS (SELECT *, list_reduce(list_prepend(begin, steps), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM e"""

ORACLE["op12_conversation_trie"] = f"""WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, n, {_crc32('c')} % 9 AS h, c - c % 5 AS b FROM (SELECT c, count(*) AS n FROM t GROUP BY c)),
z AS (SELECT k.c, p, r, x FROM k JOIN t ON t.c = k.b AND p < h UNION ALL
  SELECT k.c, p - k.h + least(k.h, coalesce(f.n, 0)), r, x FROM k JOIN t ON t.c = k.c AND p >= k.h LEFT JOIN k f ON f.c = k.b),
s AS (SELECT k.c, coalesce(list(strlen(r) || ':' || r || strlen(x) || ':' || x ORDER BY p) FILTER (p IS NOT NULL), []) AS seq,
  coalesce(list(strlen(x) ORDER BY p) FILTER (p IS NOT NULL), []) AS sz FROM k LEFT JOIN z USING (c) GROUP BY k.c),
m AS (SELECT c, d, sha256(array_to_string(seq[:d], '')) AS q, len(seq) = d AS ended, CASE WHEN d > 0 THEN sz[d] ELSE 0 END AS w
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM s)),
n AS (SELECT d, q, min(c) AS c, count(*) AS n, any_value(w) AS w,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends FROM m GROUP BY d, q),
a AS (SELECT n.d, n.q, n.c, n.n, n.w, n.ends, u.c AS up, u.q AS uq FROM n LEFT JOIN m ON m.c = n.c AND m.d = n.d - 1 LEFT JOIN n u ON u.d = m.d AND u.q = m.q),
g AS (SELECT d - 1 AS d, uq AS q, count(*) AS kids FROM a WHERE d > 0 GROUP BY ALL),
o AS (SELECT a.*, coalesce(kids, 0) AS kids FROM a LEFT JOIN g USING (d, q)),
e AS (SELECT m.d, m.q, count(*) FILTER (o.kids = 0) AS leaves, sum((o.n - 1) * o.w) AS saved FROM o JOIN m ON m.c = o.c AND m.d <= o.d GROUP BY m.d, m.q)
SELECT o.c AS conv_id, CAST(o.d AS BIGINT) AS depth, o.up AS parent_conv_id, o.n AS n_convs, o.kids AS n_children, e.leaves AS n_leaves,
  CAST(e.saved AS BIGINT) AS saved_tokens, o.ends AS ends_sha256 FROM o JOIN e USING (d, q)"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLE["op13_url_filter"] = f"""WITH rules(rh, rp, rv) AS (VALUES {_RULES}),
u AS (SELECT row_number() OVER () AS k, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
b AS (SELECT k, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS verdict FROM p JOIN rules
  ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN b USING (k)"""
