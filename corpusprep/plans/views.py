"""Record views derived by Spark from the driver tables.

The engine's input is JSONL; these views turn ``documents`` (and ``nation``)
into JSON lines with the record shape of an article corpus, so every query
exercises the same scan/parse path as a file input and grows with the table.
Each rule here has a SQL twin in :mod:`corpusprep.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.profile import NON_WORD_RE
from corpusprep.sources.jsonl import SEQ, parse_lines  # noqa: F401  (re-exported)

RUN_TS = "2024-01-01T00:00:00+00:00"

# Derived input tables written to the shared folder, once per session.
_WRITTEN: dict[tuple, str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    from corpusprep.session import checkpoint_dir

    from corpusprep.sources.store import path_exists

    key = (checkpoint_dir(spark), sf_dir, name)
    if key not in _WRITTEN or not path_exists(spark, _WRITTEN[key]):
        _WRITTEN[key] = build()
    return _WRITTEN[key]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year_of(doc_id: Column) -> Column:
    return (F.lit(1900) + doc_id % 50).cast("int")


def record_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` plus the record fields (id, newspaper, yr, tp, lg, len, ocrqa, ft).

    The quality of an empty text is 0 / 0, NaN as in the SQL; Spark's division would fail the job.
    """
    d = F.col("doc_id")
    text = F.col("text")
    n = F.char_length(text)
    words = F.char_length(F.regexp_replace(text, NON_WORD_RE, ""))
    return docs.select(
        d,
        F.concat_ws("-", F.col("source"), year_of(d).cast("string"), d.cast("string")).alias("id"),
        F.col("source").alias("newspaper"),
        year_of(d).alias("yr"),
        F.when(d % 5 == 0, F.lit("page")).otherwise(F.lit("article")).alias("tp"),
        F.col("lang").alias("lg"),
        F.col("n_chars").alias("len"),
        F.when(n > 0, F.round(words / n, 3)).when(n == 0, F.lit(float("nan"))).alias("ocrqa"),
        text.alias("ft"),
    )


def as_lines(rows: DataFrame, cols: list[str] | None = None, seq: str = "doc_id") -> DataFrame:
    """JSON lines (``value``) with their order (``_seq``); NULL fields are left out."""
    cols = cols or [c for c in rows.columns if c != seq]
    return rows.select(F.to_json(F.struct(*cols)).alias("value"), F.col(seq).cast("bigint").alias(SEQ))


def record_rows(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """The record fields; ``ordered``: in ``doc_id`` order.

    The documents are put in order before anything is derived from them: the range partition samples its input, which
    would derive every field once more, and in the few tasks of the scan.
    """
    docs = documents(spark, sf_dir)
    return record_columns(docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id") if ordered else docs)


def jsonl_view(spark: SparkSession, sf_dir: str, name: str, build_lines) -> DataFrame:
    """Parsed lines of a record view, read from JSONL files.

    The view's lines are written once per session, in the order of ``build_lines``
    (``doc_id``, see :func:`record_rows`), into the shared scratch folder; every query then reads them
    with the engine's own JSONL scan, as it would read a corpus.
    """
    from corpusprep.session import scratch_path
    from corpusprep.sources.jsonl import read_jsonl, write_jsonl

    def build():
        path = scratch_path(spark, name)
        write_jsonl(build_lines(), path)
        return path

    return read_jsonl(spark, _once(spark, sf_dir, f"jsonl:{name}", build))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed lines of the ``records`` view."""
    return jsonl_view(spark, sf_dir, "records", lambda: as_lines(record_rows(spark, sf_dir, ordered=True)))


def no_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``records`` with ``ft`` missing where doc_id%3=0 and ``len`` missing where doc_id%6=0."""
    d = F.col("doc_id")
    r = record_rows(spark, sf_dir, ordered=True)
    return r.withColumn("ft", F.when(d % 3 != 0, F.col("ft"))).withColumn("len", F.when(d % 6 != 0, F.col("len")))


def records_no_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl_view(spark, sf_dir, "records_no_text", lambda: as_lines(no_text_rows(spark, sf_dir)))


def dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``records`` whose lines are cut to 40 characters where doc_id%17=0 (invalid JSON)."""
    lines = as_lines(record_rows(spark, sf_dir, ordered=True))
    return lines.withColumn(
        "value", F.when(F.col(SEQ) % 17 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    )


def records_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl_view(spark, sf_dir, "records_dirty", lambda: dirty_rows(spark, sf_dir))


def lang_variant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language values a splitter must make safe: blank, ``xx/XX``, ``.xx-``."""
    d = F.col("doc_id")
    lg = (
        F.when(d % 7 == 0, F.lit(""))
        .when(d % 11 == 0, F.concat(F.col("lg"), F.lit("/"), F.upper("lg")))
        .when(d % 13 == 0, F.concat(F.lit("."), F.col("lg"), F.lit("-")))
        .otherwise(F.col("lg"))
    )
    return record_rows(spark, sf_dir, ordered=True).withColumn("lg", lg)


def records_langs(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    def build():
        lines = as_lines(lang_variant_rows(spark, sf_dir))
        if dirty:
            lines = lines.withColumn(
                "value", F.when(F.col(SEQ) % 17 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
            )
        return lines

    return jsonl_view(spark, sf_dir, f"records_langs_{'dirty' if dirty else 'clean'}", build)


def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive lines (id, ft, len, title = first 60 characters) with shard columns;
    records where doc_id%11=0 are not archived."""
    r = record_rows(spark, sf_dir).filter(F.col("doc_id") % 11 != 0)
    line = F.to_json(F.struct("id", "ft", "len", F.substring("ft", 1, 60).alias("title")))
    return r.select(line.alias("value"), "newspaper", F.col("yr").cast("string").alias("yr"))


def archive_path(spark: SparkSession, sf_dir: str) -> str:
    """The archive written once into the shared scratch folder."""
    from corpusprep.session import scratch_path
    from corpusprep.sources.archive import write_archive

    def build():
        path = scratch_path(spark, "archive")
        write_archive(archive_rows(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "archive", build)


def title_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title-job input: own title where doc_id%4=0, blank where %4=1, absent
    otherwise; blank ID where doc_id%23=0, else a SHA-1 where doc_id%29=0 (an ID that names no shard); line cut where doc_id%17=0."""
    d = F.col("doc_id")
    r = record_rows(spark, sf_dir, ordered=True)
    r = r.withColumn(
        "title",
        F.when(d % 4 == 0, F.concat(F.lit("Own title "), d.cast("string"))).when(d % 4 == 1, F.lit("  ")),
    ).withColumn("id", F.when(d % 23 == 0, F.lit("")).when(d % 29 == 0, F.sha1(F.col("id"))).otherwise(F.col("id")))
    lines = as_lines(r.select("doc_id", "id", "tp", "lg", "len", "title", "ft"))
    return lines.withColumn(
        "value", F.when(F.col(SEQ) % 17 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    )


def records_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed lines of the title job's input."""
    return jsonl_view(spark, sf_dir, "titles", lambda: title_rows(spark, sf_dir))


def processed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled store: records with doc_id%7=0 and the rule label, in doc_id order."""
    from corpusprep.plans.doubles import rule_label

    r = record_rows(spark, sf_dir, ordered=True).filter(F.col("doc_id") % 7 == 0)
    return r.withColumn("ad_class", rule_label(F.col("ft")))


def store_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl_view(spark, sf_dir, "store", lambda: as_lines(processed_rows(spark, sf_dir)))


def id_number(record_id: Column) -> Column:
    """The ``doc_id`` at the end of a view ID (``source-year-doc_id``)."""
    return F.regexp_extract(record_id, "([0-9]+)$", 1).cast("bigint")


def duplicated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``records`` plus a later copy (tp='dup') of every record with doc_id%8=0."""
    r = record_rows(spark, sf_dir)
    copies = r.filter(F.col("doc_id") % 8 == 0).withColumn("tp", F.lit("dup"))
    first = as_lines(r)
    later = as_lines(copies).withColumn(SEQ, F.col(SEQ) + F.lit(1_000_000_000))
    return parse_lines(first.unionByName(later))


def providers_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row provider document built from the newspapers and ``nation``.

    Newspaper ``srcK`` is listed under provider ``P{K%4}`` whose country is
    nation K%4 (blank for P3); the newspaper with the smallest K%4=1 number is
    also listed under P2; P0 lists a blank title; ``PX`` has non-list titles
    and ``PY`` is not an object.
    """
    docs = documents(spark, sf_dir)
    k = F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int"), F.lit(0))
    srcs = docs.select(F.lit("s").alias("kind"), k.alias("key"), F.col("source").alias("name")).distinct()
    nat = table(spark, sf_dir, "nation").select(
        F.lit("n").alias("kind"), F.col("n_nationkey").cast("int").alias("key"), F.col("n_name").alias("name")
    )
    rows = srcs.unionByName(nat)
    is_s, is_n = F.col("kind") == "s", F.col("kind") == "n"
    aggs = []
    for j in range(4):
        aggs.append(F.array_sort(F.collect_list(F.when(is_s & (F.col("key") % 4 == j), F.col("name")))).alias(f"t{j}"))
        aggs.append(F.max(F.when(is_n & (F.col("key") == j), F.col("name"))).alias(f"c{j}"))
    aggs.append(F.min_by(F.when(is_s & (F.col("key") % 4 == 1), F.col("name")),
                         F.when(is_s & (F.col("key") % 4 == 1), F.col("key"))).alias("dup"))
    one = rows.agg(*aggs)
    entries = []
    for j in range(4):
        titles = F.col(f"t{j}")
        if j == 0:
            titles = F.concat(titles, F.array(F.lit("  ")))
        if j == 2:
            titles = F.concat(titles, F.array(F.col("dup")))
        country = F.lit("") if j == 3 else F.col(f"c{j}")
        entries.append(F.concat(F.lit(f'"P{j}":'), F.to_json(F.struct(country.alias("country"), titles.alias("titles")))))
    entries.append(F.lit('"PX":{"country":"ZZ","titles":"src0"}'))
    entries.append(F.lit('"PY":"not an object"'))
    return one.select(F.concat(F.lit("{"), F.concat_ws(",", *entries), F.lit("}")).alias("value"))


def providers_path(spark: SparkSession, sf_dir: str) -> str:
    from corpusprep.session import scratch_path

    def build():
        path = scratch_path(spark, "providers")
        providers_doc(spark, sf_dir).coalesce(1).write.text(path)
        return path

    return _once(spark, sf_dir, "providers", build)


def keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword-job input: records with a title where doc_id%2=0 and blank text where doc_id%13=0."""
    d = F.col("doc_id")
    r = record_rows(spark, sf_dir)
    r = r.withColumn("title", F.when(d % 2 == 0, F.concat(F.lit("Title "), d.cast("string")))).withColumn(
        "ft", F.when(d % 13 == 0, F.lit("")).otherwise(F.col("ft"))
    )
    return r.select("doc_id", "id", "lg", "yr", "tp", "len", "title", "ft")


def keyword_folder(spark: SparkSession, sf_dir: str) -> str:
    """Per-language folder of the keyword input (written by the split job), with
    a summary file and a stale ``keywords_`` file that the scan must skip."""
    return _once(spark, sf_dir, "keyword_folder", lambda: _write_keyword_folder(spark, sf_dir))


def _write_keyword_folder(spark: SparkSession, sf_dir: str) -> str:
    from corpusprep.operators.split import split_by_language, summary_json
    from corpusprep.session import scratch_path

    path = scratch_path(spark, "keyword_input")
    res = split_by_language(parse_lines(as_lines(keyword_rows(spark, sf_dir))), path, preserve_order=True)
    summary_json(res.summary).coalesce(1).write.text(path + "/_summary_tmp")
    _rename_single(spark, path + "/_summary_tmp", path + "/languages_summary.json")
    # an earlier run's output, which the scan must skip: the names of the languages are enough
    stale = record_rows(spark, sf_dir).select(F.to_json(F.struct("lg")).alias("value")).distinct()
    stale.coalesce(1).write.text(path + "/_stale_tmp")
    _rename_single(spark, path + "/_stale_tmp", path + "/keywords_xx.jsonl")
    return path


def _rename_single(spark: SparkSession, folder: str, target: str) -> None:
    """Move the one part file of ``folder`` to ``target`` (file names only, through the driver)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_dir = jvm.org.apache.hadoop.fs.Path(folder)
    fs = src_dir.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(src_dir) if s.getPath().getName().startswith("part-")]
    fs.rename(parts[0], jvm.org.apache.hadoop.fs.Path(target))


def reply_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded model replies per document: invalid JSON where doc_id%10=0, a JSON
    array where %11=0, a non-list ``english_keywords`` where %7=0; usage absent
    where %9=0, total 0 where %4=0 and -1 where %5=0; text behind the JSON where
    %17=0 and a second object where %19=0."""
    d = F.col("doc_id")
    r = record_rows(spark, sf_dir)
    listed = F.concat(F.lit('{"english_keywords": ["'), F.col("newspaper"), F.lit('", " ", "'), F.col("lg"),
                      F.lit(' press", 3, null]}'))
    reply = (
        F.when(d % 10 == 0, F.lit("not json {"))
        .when(d % 11 == 0, F.lit("[1]"))
        .when(d % 17 == 0, F.concat(listed, F.lit(" trailing")))
        .when(d % 19 == 0, F.concat(listed, F.lit(","), listed))
        .when(d % 7 == 0, F.lit('{"english_keywords": "none"}'))
        .otherwise(listed)
    )
    p = (F.col("len") / 4).cast("bigint") + 20
    usage = F.when(d % 9 != 0, True)
    return r.select(
        "doc_id", "id", reply.alias("reply"),
        F.when(usage, p).alias("prompt_tokens"),
        F.when(usage, F.lit(12).cast("bigint")).alias("completion_tokens"),
        F.when(usage, F.when(d % 4 == 0, F.lit(0)).when(d % 5 == 0, F.lit(-1)).otherwise(p + 12)).cast("bigint").alias("total_tokens"),
    )


def coerce_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-built JSON lines whose ``len`` and ``title`` take every loose form."""
    d = F.col("doc_id")
    r = record_rows(spark, sf_dir)
    n = F.col("len").cast("string")
    k = d % 11
    raw_len = (
        F.when(k == 0, n).when(k == 1, F.concat(F.lit('"'), n, F.lit('"')))
        .when(k == 2, F.concat(n, F.lit(".7"))).when(k == 3, F.concat(F.lit('"'), n, F.lit('.7"')))
        .when(k == 4, F.lit("true")).when(k == 5, F.lit("null"))
        .when(k == 6, F.concat(F.lit('" '), n, F.lit(' "'))).when(k == 7, F.concat(n, F.lit("e0")))
        .when(k == 8, F.lit('"0.8f"')).when(k == 9, F.lit("-1"))
    )
    j = d % 7
    src = F.col("newspaper")
    raw_title = (
        F.when(j == 0, F.concat(F.lit('"  '), src, F.lit('  "')))
        .when(j == 1, F.concat(F.lit('"\\u00a0'), src, F.lit('\\u3000"')))
        .when(j == 2, F.lit("null"))
        .when(j == 4, d.cast("string"))
        .when(j == 5, F.lit("true"))
        .when(j == 6, F.concat(F.lit('"tab\\t'), src, F.lit('\\n"')))
    )
    body = F.concat(
        F.lit('{"id": '), F.to_json(F.array("id")).substr(F.lit(2), F.length(F.to_json(F.array("id"))) - 2),
        F.when(raw_len.isNotNull(), F.concat(F.lit(', "len": '), raw_len)).otherwise(F.lit("")),
        F.when(raw_title.isNotNull(), F.concat(F.lit(', "title": '), raw_title)).otherwise(F.lit("")),
        F.lit("}"),
    )
    return r.select(body.alias("value"), d.alias(SEQ))


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of bad line, chosen by doc_id%13 (see the oracle)."""
    good = as_lines(record_rows(spark, sf_dir).select("doc_id", "id", "lg", "len"))
    v = F.col("value")
    k = F.col(SEQ) % 13
    line = (
        F.when(k == 0, F.lit("")).when(k == 1, F.lit("   "))
        .when(k == 2, F.concat(F.lit(" "), v))
        .when(k == 3, F.substring(v, 1, 20)).when(k == 4, F.concat(v, F.lit(" x")))
        .when(k == 5, F.concat(v, F.lit(","), v)).when(k == 6, F.lit("[1,2]")).when(k == 7, F.lit("5"))
        .when(k == 8, F.concat(F.lit('{"id":"first",'), F.substring(v, 2, 1 << 30)))
        .when(k == 9, F.lit('{"id": NaN}')).when(k == 10, F.lit("{'id': 'x'}"))
        .otherwise(v)
    )
    return good.select(line.alias("value"), SEQ)
