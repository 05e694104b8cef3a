"""The pipeline's stages, each against a plain version on its own input, and the whole run."""

from collections import Counter

import corpus_pipeline as C
import pytest
from llm_tables import SMALL, awkward, empty  # noqa: F401
from corpusprep.llm import quality
from corpusprep.llm.common import read_table, stage
from pyspark.sql import functions as F
from test_joins import WORD, brute_components, brute_lines
from test_row_operators import base_counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = read_table(spark, SMALL, "documents"), []
    for name, function in C.STAGES:
        done = stage(function(spark, docs, SMALL), name)
        out.append((docs, done))
        docs = done
    return out


def test_columns(steps):
    for _, done in steps[:-1]:
        assert done.columns == COLUMNS


def test_quality(spark, steps):
    docs, done = steps[0]
    weights = quality.train(docs, read_table(spark, SMALL, "labels"))
    kept = {r["id"] for r in quality.assess(docs, weights).filter("kept").collect()}
    rows = done.collect()
    assert {r["doc_id"] for r in rows} == kept and len(rows) == len(kept)
    assert all((n := base_counts(r["text"]))[0] >= 50 and 100 * n[4] <= 50 * n[0] for r in rows)


def test_lines(steps):
    docs, done = steps[1]
    rows = [tuple(r) for r in docs.select("doc_id", F.xxhash64("text"), "text").collect()]
    lost = brute_lines(rows, 5, 80, 100)
    expected = {}
    for d, h, t in rows:
        text = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in lost.get((d, h), []))
        if WORD.search(text):
            expected[d] = text
    assert {r["doc_id"]: r["text"] for r in done.collect()} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in done.collect() if r["doc_id"] in {d for d, _ in lost})


def test_near_duplicates(steps):
    docs, done = steps[2]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in done.collect()) == sorted(d for d, _, c in brute_components(rows, 5, 80, 100) if d == c)


def test_near_duplicates_of_the_raw_table(spark):
    docs = read_table(spark, SMALL, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in C.near_duplicates(spark, docs, SMALL).collect()) == sorted(
        d for d, _, c in brute_components(rows, 5, 80, 100) if d == c)


def test_mix(steps):
    docs, done = steps[3]
    before, after = {r["doc_id"]: r for r in docs.collect()}, Counter(r["doc_id"] for r in done.collect())
    assert set(after) <= set(before) and max(after.values()) <= 2
    size = lambda d: len(WORD.findall(before[d]["text"] or ""))
    total = sum(map(size, before))
    assert sum(size(d) * n for d, n in after.items()) == pytest.approx(1.5 * total, rel=0.05)


def test_packing(steps):
    docs, done = steps[4]
    copies = Counter(r["doc_id"] for r in docs.collect())
    tokens = {}
    for r in done.collect():
        tokens.setdefault(r["doc_id"], [0, r["doc_tokens"]])[0] += r["length"]
    assert {d: t[0] for d, t in tokens.items()} == {d: copies[d] * t[1] for d, t in tokens.items()} and set(tokens) == set(copies)


def test_whole_run(spark, steps):
    assert C.run(spark, SMALL).agg(F.sum("length")).first()[0] == steps[-1][1].agg(F.sum("length")).first()[0]


def test_stages_on_awkward_rows(spark, awkward, empty):
    for name, function in C.STAGES:
        out = function(spark, awkward, SMALL)
        if name == "quality_rules":  # short, blank or repetitive, every one of them
            assert out.count() == 0
        else:
            assert out.count() >= 1
        if name != "pack_sequences":
            assert out.columns == awkward.columns
        assert function(spark, empty, SMALL).count() == 0
