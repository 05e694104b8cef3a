"""Summary totals and archive pruning."""

from pyspark.sql import functions as F

from conftest import SMALL
from corpusprep.fields import Fields
from corpusprep.operators import keywords, split
from corpusprep.plans import doubles
from corpusprep.plans import views as V
from corpusprep.session import scratch_path
from corpusprep.sources import archive as A
from corpusprep.sources import folder, providers
from corpusprep.sources.jsonl import valid_records


def test_split_totals_are_the_sum_of_languages(spark):
    res = split.split_by_language(V.records_langs(spark, SMALL), scratch_path(spark, "split-sum"))
    row = res.summary.first()
    assert row.total_records == sum(e.records for e in row.languages_summary)
    assert row.total_len == sum(e.total_len for e in row.languages_summary)
    assert row.languages == sorted(row.languages)
    assert row.invalid_json_lines > 0


def test_keyword_totals_are_the_sum_of_languages(spark):
    recs = valid_records(folder.scan_language_folder(spark, V.keyword_folder(spark, SMALL)))
    countries = providers.newspaper_country(providers.read_providers(spark, V.providers_path(spark, SMALL)))
    res = keywords.with_results(keywords.generate(recs, countries, doubles.recorded_completer, fields=Fields(year="yr")))
    stats = keywords.keyword_stats(res, folder.LANG_FILE)
    row = keywords.keyword_summary_row(stats, folder.LANG_FILE, input_prefix="in", output_prefix="out",
                                       providers_path="p", model="m", base_url="").first()
    for total, part in [("total_records", "records"), ("total_failed_records", "failed_records"),
                        ("total_prompt_tokens", "prompt_tokens"), ("total_tokens", "total_tokens"),
                        ("total_usage_missing_records", "usage_missing_records")]:
        assert getattr(row, total) == sum(getattr(e, part) for e in row.languages_summary), total


def test_archive_lookup_prunes_shards(spark):
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    ids = V.record_rows(spark, SMALL).filter(F.col("doc_id") < 5).select(F.col("id").alias("_id"))
    junk = spark.createDataFrame([(f"{i:040x}",) for i in range(50)] + [("no-such-shard",), ("",), (None,)], "_id string")
    found = A.lookup(arch, ids.union(junk), "_id", stage_keys=True)
    assert 0 < found.count() <= 5
    # the staged result hides the scan: check the archive read of the same shards
    shards = ids.select(F.split_part("_id", F.lit("-"), F.lit(1)).alias("newspaper"), F.split_part("_id", F.lit("-"), F.lit(2)).alias("yr")).distinct()
    read = arch.read(shards)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(newspaper" in plan and plan.count("SubqueryAdaptiveBroadcast dynamicpruning") >= 2
    assert read.select("newspaper", "yr").distinct().count() == shards.count()


def test_ids_without_a_shard_are_left_out(spark, monkeypatch):
    """A SHA-1 names no folder; no list of shards passes through the driver."""
    seen = []
    arch = A.Archive(spark, V.archive_path(spark, SMALL))
    lines = A.Archive._partition_lines
    monkeypatch.setattr(A.Archive, "_partition_lines", lambda self, shards: seen.append(shards) or lines(self, shards))
    ids = spark.createDataFrame([(f"{i:040x}",) for i in range(5)] + [("src1-1901-1",)], "_id string")
    real = type(ids).collect
    monkeypatch.setattr(type(ids), "collect", lambda self: (_ for _ in ()).throw(AssertionError("collect in lookup")))
    found = A.lookup(arch, ids, "_id")
    monkeypatch.setattr(type(ids), "collect", real)
    assert [tuple(r) for r in seen[0].collect()] == [("src1", "1901")] and found.count() <= 1


def test_archive_shard_file_layout(spark):
    """The same lookups over ``<newspaper>/<newspaper>-<year>.jsonl.bz2`` files."""
    import bz2
    import json
    import os

    from urllib.parse import urlparse

    rows = V.archive_rows(spark, SMALL).collect()
    root = scratch_path(spark, "archive-files")
    local = urlparse(root).path if root.startswith("file:") else root
    by_shard = {}
    for r in rows:
        by_shard.setdefault((r.newspaper, r.yr), []).append(r.value)
    for (paper, year), lines in by_shard.items():
        os.makedirs(os.path.join(local, paper), exist_ok=True)
        with bz2.open(os.path.join(local, paper, f"{paper}-{year}.jsonl.bz2"), "wt", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n")
    ids = V.record_rows(spark, SMALL).select(F.col("id").alias("_id"))
    a = A.lookup(A.Archive(spark, V.archive_path(spark, SMALL)), ids, "_id")
    b = A.lookup(A.Archive(spark, root, layout="shard_files"), ids, "_id")
    cols = ["a_id", "a_text", "a_len", "a_title"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    assert b.count() == len({json.loads(x)["id"] for v in by_shard.values() for x in v})
    some = sorted(by_shard)[:3]
    wanted = spark.createDataFrame([*some, ("no", "such")], "newspaper string, yr string")
    plan = A.Archive(spark, root, layout="shard_files").read(wanted)
    assert plan.select("newspaper", "yr").distinct().count() == 3


def test_publish_language_files(spark):
    from corpusprep.operators.split import publish_language_files, read_split, split_by_language

    out = scratch_path(spark, "split-pub")
    split_by_language(V.records_langs(spark, SMALL), out)
    before = {r[0]: r[1] for r in read_split(spark, out).groupBy("lang_bucket").count().collect()}
    target = scratch_path(spark, "published")
    paths = publish_language_files(spark, out, target)
    assert set(paths) == set(before) and all(p.endswith(".jsonl") for p in paths.values())
    scanned = folder.scan_language_folder(spark, target)
    after = {r[0]: r[1] for r in valid_records(scanned).groupBy(folder.LANG_FILE).count().collect()}
    assert after == before


def test_tfidf_matches_brute_force(spark):
    """Top-5 TF-IDF terms per article against a plain-Python computation."""
    import math
    import re
    from collections import Counter

    import __spark_entry__ as E

    got = {r.id: r.keywords for r in E.queries()["tfidf_keywords"](spark, SMALL).collect()}
    docs = {r.id: r.ft for r in V.record_rows(spark, SMALL).select("id", "ft").collect()}
    token = re.compile(r"[^\W_]+")
    tfs = {i: Counter(token.findall(t.lower())) for i, t in docs.items()}
    df = Counter(term for c in tfs.values() for term in c)
    n = len(docs)
    for i, c in tfs.items():
        scored = sorted(c.items(), key=lambda kv: (-round(kv[1] * math.log((n + 1) / (df[kv[0]] + 1)), 9), kv[0]))
        assert got[i] == "|".join(t for t, _ in scored[:5]), i


def test_keyword_run_per_file_cap(spark):
    recs = valid_records(folder.scan_language_folder(spark, V.keyword_folder(spark, SMALL)))
    countries = providers.newspaper_country(providers.read_providers(spark, V.providers_path(spark, SMALL)))
    res = keywords.generate(recs, countries, doubles.recorded_completer, fields=Fields(year="yr"), max_per_file=7)
    per_file = {r[0]: r[1] for r in res.groupBy(folder.LANG_FILE).count().collect()}
    have = {r[0]: r[1] for r in recs.groupBy(folder.LANG_FILE).count().collect()}
    assert per_file == {k: min(7, v) for k, v in have.items()}


def test_title_lines_rewritten_correctly(spark):
    import json

    from corpusprep.operators import enrich

    parsed = V.parse_lines(V.title_rows(spark, SMALL))
    out = enrich.enrich_titles(parsed, A.Archive(spark, V.archive_path(spark, SMALL)))
    original = {r.i: r.value for r in parsed.select(F.col("_seq").alias("i"), "value").collect()}
    rows = out.select(F.col("_seq").alias("i"), "value", "t_state", "t_title").collect()
    assert any(r.t_state == "enriched" for r in rows)
    for r in rows:
        rec, before = json.loads(r.value), json.loads(original[r.i])
        if r.t_state == "enriched":
            assert rec.pop("title") == r.t_title
            before.pop("title", None)
        assert rec == before
