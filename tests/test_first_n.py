"""First N and samples: equal to a plain ranking, with no window over lines."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import sampling
from corpusprep.operators.identity import RID
from corpusprep.sources.jsonl import SEQ, VAR, read_jsonl, valid_records


def _plain(rows, n):
    out, seen = [], {}
    for g, o, v in sorted(rows, key=lambda r: r[1]):
        seen[g] = seen.get(g, 0) + 1
        if seen[g] <= n:
            out.append((g, o, v))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 7, 500, 10**6])
def test_first_n_equals_a_plain_ranking(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(["a", "a", "a", "b", None, f"g{i % 50}"]), o, rng.choice(["same line", f"line {o}"]))
            for i, o in enumerate(rng.sample(range(400_000), 3000))]  # several runs of 65,536 numbers
    df = spark.createDataFrame(rows, f"g string, {SEQ} long, value string").repartition(9)
    got = sampling.first_n_per_group(df, "g", n).select("g", SEQ, "value").collect()
    assert sorted((tuple(r) for r in got), key=repr) == _plain(rows, n)


def test_first_n_of_files_in_part_order(spark, tmp_path):
    """Equal lines count each; part 100000 follows part 99999; empty files and blank lines have no rows."""
    names = ["part-99999-x.txt", "part-100000-x.txt", "part-00002-x.txt", "part-00010-x.txt", "other.txt"]
    for i, name in enumerate(names):
        (tmp_path / name).write_text("".join(f'{{"id": "{name}", "k": {j // 2}}}\n\n' for j in range(6)))
    (tmp_path / "part-00001-x.txt").write_text("")
    df = valid_records(read_jsonl(spark, str(tmp_path))).withColumn("g", F.lit("x"))
    first = sampling.first_n_per_group(df, "g", 15)
    got = [r["value"] for r in first.orderBy(SEQ).collect()]
    by_order = ["other.txt", "part-00002-x.txt", "part-00010-x.txt", "part-99999-x.txt", "part-100000-x.txt"]
    expected = [f'{{"id": "{name}", "k": {j // 2}}}' for name in by_order for j in range(6)][:15]
    assert got == expected and VAR in first.columns


def test_first_n_windows_hold_narrow_rows_only(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), F.col("id").alias(SEQ), F.concat(F.lit("line "), F.col("id").cast("string")).alias("value"))
    plans = []
    stage = sampling.__dict__.get("stage")
    import corpusprep.sources.staging as staging

    real = staging.stage
    try:
        staging.stage = lambda d, name: plans.append(d._jdf.queryExecution().executedPlan().toString()) or real(d, name)
        out = sampling.first_n_per_group(df, "g", 10)
    finally:
        staging.stage = real
    assert stage is None
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    windows = [line for p in plans for line in p.splitlines() if "Window" in line]
    assert windows and not any("value" in line or "_row" in line for line in windows)
    with pytest.raises(TypeError):
        sampling.first_n_per_group(df.withColumn(SEQ, F.col("value")), "g", 3)


@pytest.mark.parametrize("n", [1, 5, 200, 5000])
def test_sample_equals_a_plain_ranking(spark, n):
    rng = random.Random(7)
    rows = [(f"id{rng.randrange(2500)}", rng.choice(["de", "de", "de", "fr", "", f"x{i % 20}"]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, f"{RID} string, _lang string, {SEQ} long").repartition(5)
    got = sorted((r["_lang"], r[RID]) for r in sampling.sample_per_language(df, n, seed=3).collect())
    first = {}
    for i, lang, _ in rows:
        if lang:
            first.setdefault(i, lang)
    langs = {}
    for i, lang in first.items():
        langs.setdefault(lang, []).append(i)
    order = lambda i: (hashlib.md5(f"3:{i}".encode()).hexdigest(), i)
    assert got == sorted((lang, i) for lang, ids in langs.items() for i in sorted(ids, key=order)[:n])


def test_sample_ranks_few_and_widens_where_too_few_pass(spark, monkeypatch):
    rows = [(f"id{i}", "de", i) for i in range(20_000)]
    df = spark.createDataFrame(rows, f"{RID} string, _lang string, {SEQ} long")
    pool = df.select(RID, "_lang").withColumn("_u", sampling.sample_position(3))
    bound = sampling._bounds(pool, 100, "_lang").first()["_bound"]
    assert bound == (100 + 40 + 16) / 20_000
    assert 100 <= pool.filter(F.col("_u") < bound).count() <= 230
    # a language whose hashes all lie above the bound: every ID is ranked
    unlucky = pool.filter(F.col("_u") > 0.5)
    assert sampling._bounds(unlucky, 100, "_lang").first()["_bound"] == 1.0
