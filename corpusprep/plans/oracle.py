"""DuckDB twins of the record views in :mod:`corpusprep.plans.views`.

Each constant is a CTE body over the driver tables; the catalogue composes
them into the oracle query of each registered query.
"""

RECORDS = """records AS (
  SELECT doc_id,
    source || '-' || CAST(1900 + doc_id % 50 AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR) AS id,
    source AS newspaper,
    CAST(1900 + doc_id % 50 AS INTEGER) AS yr,
    CASE WHEN doc_id % 5 = 0 THEN 'page' ELSE 'article' END AS tp,
    lang AS lg,
    n_chars AS len,
    round(length(regexp_replace(text, '[^\\p{L}\\p{N}_]+', '', 'g')) / length(text), 3) AS ocrqa,
    text AS ft
  FROM documents)"""

NO_TEXT = """no_text AS (
  SELECT doc_id, id, newspaper, yr, tp, lg,
    CASE WHEN doc_id % 6 <> 0 THEN len END AS len, ocrqa,
    CASE WHEN doc_id % 3 <> 0 THEN ft END AS ft
  FROM records)"""

LANG_VARIANTS = """langs AS (
  SELECT doc_id, id, newspaper, yr, tp,
    CASE WHEN doc_id % 7 = 0 THEN ''
         WHEN doc_id % 11 = 0 THEN lg || '/' || upper(lg)
         WHEN doc_id % 13 = 0 THEN '.' || lg || '-'
         ELSE lg END AS lg,
    len, ocrqa, ft, doc_id % 17 = 0 AS broken
  FROM records)"""

# Language folder name: runs outside [A-Za-z0-9._-] -> '_', strip '._-', blank -> unknown.
BUCKET_EXPR = """coalesce(nullif(trim(regexp_replace(coalesce(nullif(trim({x}), ''), 'unknown'),
  '[^A-Za-z0-9._-]+', '_', 'g'), '._-'), ''), 'unknown')"""


# Python str.strip() in DuckDB: trim() with the 29 code points it removes.
PY_SPACE_CHARS = " || ".join(
    f"chr({c})" for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def py_strip(x: str) -> str:
    return f"trim({x}, {PY_SPACE_CHARS})"


ARCHIVE = """archive AS (
  SELECT id, ft, len, substr(ft, 1, 60) AS title, newspaper, yr FROM records WHERE doc_id % 11 <> 0)"""

TITLES = """titled AS (
  SELECT doc_id, CASE WHEN doc_id % 23 = 0 THEN '' WHEN doc_id % 29 = 0 THEN sha1(id) ELSE id END AS id, tp, lg, len,
    CASE WHEN doc_id % 4 = 0 THEN 'Own title ' || CAST(doc_id AS VARCHAR) WHEN doc_id % 4 = 1 THEN '  ' END AS title,
    ft, doc_id % 17 = 0 AS broken
  FROM records)"""


AD_RULE = """CASE WHEN length(regexp_replace({t}, '[^0-9]', '', 'g')) * 200 > length({t}) OR length({t}) < 300
  THEN 'ad' ELSE 'non-ad' END"""

PROCESSED = """processed AS (
  SELECT *, """ + AD_RULE.format(t="ft") + """ AS ad_class FROM records WHERE doc_id % 7 = 0)"""


PROVIDERS = """srcs AS (
  SELECT DISTINCT source, coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER), 0) AS k FROM documents),
dup AS (SELECT arg_min(source, k) AS s FROM srcs WHERE k % 4 = 1),
listing AS (
  SELECT source AS newspaper,
    CASE WHEN k % 4 = 3 THEN '' ELSE (SELECT n_name FROM nation WHERE n_nationkey = k % 4) END AS country FROM srcs
  UNION ALL
  SELECT s AS newspaper, (SELECT n_name FROM nation WHERE n_nationkey = 2) AS country FROM dup),
pmap AS (
  SELECT source AS newspaper,
    CASE WHEN source = (SELECT s FROM dup) THEN (SELECT n_name FROM nation WHERE n_nationkey = 2)
         WHEN k % 4 = 3 THEN ''
         ELSE (SELECT n_name FROM nation WHERE n_nationkey = k % 4) END AS country
  FROM srcs)"""

KEYWORD_INPUT = """kin AS (
  SELECT doc_id, id, lg, CAST(yr AS VARCHAR) AS year, newspaper,
    CASE WHEN doc_id % 2 = 0 THEN 'Title ' || CAST(doc_id AS VARCHAR) ELSE '' END AS title,
    CASE WHEN doc_id % 13 = 0 THEN '' ELSE ft END AS article, len
  FROM records),
kreq AS (
  SELECT k.*, coalesce(p.country, '') AS country, k.article <> '' AS sent
  FROM kin k LEFT JOIN pmap p ON p.newspaper = k.newspaper),
kres AS (
  SELECT *,
    sent AND doc_id % 10 <> 0 AS parsed,
    CASE WHEN sent AND doc_id % 9 <> 0 THEN length(article) // 4 + 20 ELSE 0 END AS prompt_tokens,
    CAST(CASE WHEN sent AND doc_id % 9 <> 0 THEN 12 ELSE 0 END AS BIGINT) AS completion_tokens,
    CASE WHEN sent AND doc_id % 9 <> 0 THEN length(article) // 4 + 32 ELSE 0 END AS total_tokens,
    sent AND doc_id % 9 = 0 AS usage_missing
  FROM kreq)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
