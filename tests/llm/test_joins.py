"""Embedding, shingle and line joins and the pipeline against brute force; awkward rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_tables import SMALL, awkward, empty  # noqa: F401
from corpusprep.llm import common, embeddings, jaccard, linededup, queries, tokens
from corpusprep.llm.components import components
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, n, lower=True):
    w = WORD.findall((text or "").translate(LOWER) if lower else (text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def linked_pairs(sets, num, den):
    holders, out = defaultdict(list), []
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        out += [(j, i) for j, k in shared.items() if den * k >= num * (len(s) + len(sets[j]) - k)]
        for g in s:
            holders[g].append(i)
    return out


def brute_components(rows, n, num, den):
    """rows: (id, text); sizes and the smallest id of each row's component."""
    sets = [shingles(t, n) for _, t in rows]
    groups = Groups(len(rows))
    for a, b in linked_pairs(sets, num, den):
        groups.join(a, b)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[groups.find(i)] = min(smallest.get(groups.find(i), doc), doc)
    return [(doc, len(sets[i]), smallest.get(groups.find(i))) for i, (doc, _) in enumerate(rows)]


def none_first(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randint(5000, 5400), rng.randint(5000, 5400)) for _ in range(300)]
    groups = Groups(6000)
    for a, b in edges:
        groups.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: groups.find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def awkward_corpus(seed):
    """Groups of near copies round the threshold, equal copies, a passage that many share, short texts, chains."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 3000}"
    texts = []
    for size, edits in ((120, 8), (60, 15), (200, 30), (30, 3), (12, 2)):
        texts += variants(rng, [word() for _ in range(size)], 40, edits)
    passage = [word() for _ in range(60)]
    for _ in range(150):
        own = [word() for _ in range(rng.randint(5, 60))]
        texts.append(" ".join(own[:3] + passage + own[3:]))
    chain = [word() for _ in range(100)]
    for _ in range(25):
        texts.append(" ".join(chain))
        chain = chain[2:] + [word(), word()]
    texts += [" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(60)] + ["A b", "a B", "a  b", None, "", " \n "] * 2
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("n,num,den,leaf", [(3, 90, 100, 32), (5, 80, 100, 32), (2, 70, 100, 4), (3, 85, 100, 4)])
def test_jaccard_brute_force(spark, monkeypatch, n, num, den, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)  # a small leaf sends groups through cells and blocks
    monkeypatch.setattr(jaccard, "BLOCK", 2 * leaf)
    rows = awkward_corpus(n * 100 + num)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n, num, den).collect()
    assert none_first(map(tuple, got)) == none_first(brute_components(rows, n, num, den))


def coded(rows, n):
    """Sets of ``rows`` by id, and the tables of one region without any pivot that holds them."""
    from hashlib import blake2b

    sets = {i: s for i, s in ((i, shingles(t, n)) for i, t in rows) if s}
    code = lambda s: np.sort(np.array([int.from_bytes(blake2b(repr(g).encode(), digest_size=8).digest(), "little") for g in s], np.uint64))
    return sets, [(i, bytearray(code(s).tobytes())) for i, s in sets.items()], [(1, i, len(s), True, i) for i, s in sets.items()]


def roots_of(ids, pairs):
    groups = Groups(max(ids) + 1)
    for a, b in pairs:
        groups.join(a, b)
    return [groups.find(i) for i in ids]


@pytest.mark.parametrize("block,size", [(1000, 8 << 20), (50, 8 << 20), (20, 8 << 20), (1000, 40_000)])
def test_jaccard_block_path(spark, monkeypatch, block, size):
    """The signature blocks alone, without any pivot, find only links and connect all linked sets, however they are dealt."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", size)
    sets, coded_sets, large = coded(awkward_corpus(5), 3)
    got = [(r["u"], r["v"]) for r in jaccard._block_links(
        spark.createDataFrame(large, "region long, cid long, size long, far boolean, root long"),
        spark.createDataFrame(coded_sets, "cid long, shingles binary"), 80, 100).collect()]
    ids = sorted(sets)
    linked = {(ids[a], ids[b]) for a, b in linked_pairs([sets[i] for i in ids], 80, 100)}
    assert linked and {(min(p), max(p)) for p in got} <= linked
    assert roots_of(ids, got) == roots_of(ids, linked)


def test_jaccard_dense_group_costs_a_chain_of_blocks(spark, monkeypatch):
    """Near copies that are all about equally far from each other: links grow with the members, not with their square."""
    monkeypatch.setattr(jaccard, "BLOCK", 50)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(w if rng.random() > 0.01 else f"x{rng.random()}" for w in base)) for i in range(600)]
    sets, coded_sets, large = coded(rows, 3)
    got = [(r["u"], r["v"]) for r in jaccard._block_links(
        spark.createDataFrame(large, "region long, cid long, size long, far boolean, root long"),
        spark.createDataFrame(coded_sets, "cid long, shingles binary"), 80, 100).collect()]
    ids = sorted(sets)
    linked = {(ids[a], ids[b]) for a, b in linked_pairs([sets[i] for i in ids], 80, 100)}
    assert len(linked) > 20 * len(ids) and len(got) < 3 * len(ids)
    assert roots_of(ids, got) == roots_of(ids, linked)


@pytest.mark.parametrize("num,den", [(80, 100), (90, 100), (30, 100)])
def test_jaccard_marks_lose_no_link(num, den):
    """Marks differ in no more bits than their sets in elements, whatever the sizes; members of links are near, others mostly not."""
    rng = np.random.default_rng(num)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [rng.choice(pool, int(k), replace=False) for k in [1, 2, 3, *rng.integers(4, 900, 60)]]
    sets += [np.concatenate([s[int(len(s) * rng.uniform(0, 0.3)):], rng.choice(pool, 2)]) for s in sets]
    sets = [np.unique(s) for s in sets]
    marks = [jaccard.mark(s) for s in sets]
    union = {(i, j): len(np.union1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i)}
    both = {(i, j): len(sets[i]) + len(sets[j]) - u for (i, j), u in union.items()}
    for (i, j), u in union.items():
        assert jaccard.apart(marks[i], marks[j]) == jaccard.apart(marks[j], marks[i]) <= u - both[i, j]
    links = [p for p, u in union.items() if den * both[p] >= num * u]
    size, n = np.array([len(s) for s in sets]), len(sets)
    found = jaccard.near_places(size, np.ones(n, bool), np.arange(n), marks, np.zeros(n, int), num, den)
    assert links and {x for p in links for x in p} <= set(found.tolist())
    # a link between equal roots, between members that are not far, or on one side is none that is open
    for root, far, side in ((np.zeros(n, int), np.ones(n, bool), np.zeros(n, int)), (np.arange(n), np.zeros(n, bool), np.zeros(n, int)),
                            (np.arange(n), np.ones(n, bool), np.ones(n, int))):
        assert not len(jaccard.near_places(size, far, root, marks, side, num, den))
    unlike = [rng.integers(0, 1 << 63, 300, dtype=np.uint64) for _ in range(50)]
    assert not len(jaccard.near_places(np.full(50, 300), np.ones(50, bool), np.arange(50), [jaccard.mark(s) for s in unlike], np.zeros(50, int), 80, 100))


def test_jaccard_blocks_of_marks(spark, monkeypatch):
    """Regions of several blocks of marks: the members of links in two blocks are found."""
    monkeypatch.setattr(jaccard, "MARK_BLOCK", 7)
    monkeypatch.setattr(jaccard, "LEAF", 4)
    rows = awkward_corpus(11)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 80, 100).collect()
    assert none_first(map(tuple, got)) == none_first(brute_components(rows, 3, 80, 100))


def test_jaccard_texts_with_a_common_passage_send_no_sets(spark, monkeypatch):
    """Texts that share a passage meet in regions; their sets do not cross the net, as their marks say that they have no link."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([f"w{rng.random()}" for _ in range(60)] + passage)) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more") for i in range(3)]
    staged, real = {}, jaccard.stage

    def counted(df, name):
        out = real(df, name)
        staged[name] = staged.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5, 80, 100).collect()
    assert staged["jaccard_members"] > 60 and staged["jaccard_sets"] <= 12
    assert {r["id"]: r["component_id"] for r in got} == {i: i % 100 for i, _ in rows}


def test_jaccard_parts_find_every_link():
    """Linked sets share a region key, whatever their sizes."""
    rng = np.random.default_rng(4)
    for num, den in ((90, 100), (80, 100), (50, 100)):
        classes = jaccard.Classes(num, den)
        for _ in range(400):
            size = int(rng.integers(1, 400))
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            keep = int(rng.integers(0, size + 1))
            b = np.unique(np.concatenate([a[:keep], rng.integers(0, 1 << 63, int(rng.integers(0, 40))).astype(np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if len(b) and both < max(len(a), len(b)) and den * both >= num * (len(a) + len(b) - both):
                assert len(np.intersect1d(classes.regions(a), classes.regions(b)))


def test_jaccard_awkward(awkward, empty):
    got = jaccard.jaccard_components(awkward, 3, 90, 100).collect()
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert none_first(map(tuple, got)) == none_first(brute_components(rows, 3, 90, 100))
    assert jaccard.jaccard_components(empty).count() == 0
    kept = jaccard.keep_one(awkward, 3, 90, 100)
    assert kept.columns == awkward.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[3] == ids[4] == ids[5] == 1
    assert jaccard.keep_one(empty).count() == 0


@pytest.mark.parametrize("seen", [1 << 16, 0])
def test_jaccard_copies_go_to_their_regions_once_a_task(spark, monkeypatch, seen):
    monkeypatch.setattr(jaccard, "SEEN", seen)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text + (" tail" if i % 10 == 9 else "")) for i in range(200)] + [(200 + i, f"other{i} " * 3 + text[i * 8:90]) for i in range(5)] + [(None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)  # seen = 0: each text forgets the one before it
    try:
        points = jaccard._points(docs.select("text"), 3, jaccard.Classes(80, 100))
        most = max(r["count"] for r in points.groupBy("cid", F.spark_partition_id()).count().collect())
        got = jaccard.jaccard_components(docs, 3, 80, 100).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert most == 1 if seen else most > 1
    assert none_first(map(tuple, got)) == none_first(brute_components(rows, 3, 80, 100))


@pytest.mark.parametrize("module,name,run", [
    (jaccard, "jaccard_members", lambda d: jaccard.jaccard_components(d)), (linededup, "line_keys", lambda d: linededup.removed_lines(d))])
def test_join_keys_cross_the_net_once(awkward, monkeypatch, module, name, run):
    plans = {}

    def spy(df, at):
        plans[at] = df._jdf.queryExecution().executedPlan().toString()
        return common.stage(df, at)

    monkeypatch.setattr(module, "stage", spy)
    run(awkward).count()
    assert len(re.findall(r"\bExchange hash", plans[name])) == 1 and "Join" not in plans[name]


def test_staging_leaves_no_shuffle_files(spark, tmp_path):
    import time

    spark.sparkContext._jvm.System.gc()  # earlier tests' files go first
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {b for b in re.findall(r"shuffle_\d+_\d+_\d+\.data", manager.getAllFiles().mkString(" "))}
    before, own = files(), spark.conf.get(common.CLEANUP)
    rows = spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("id").alias("n"))
    made = common.write_back(rows.join(rows.withColumnRenamed("n", "m").hint("merge"), "k").repartition(3, "n"), str(tmp_path / "made"))
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert made.count() == 97 and spark.conf.get(common.CLEANUP) == own


def test_keep_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(5, "a b c d e f g h"), (5, "a b c d e f g h"), (9, "A B c d e f g h"), (7, "other words here")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.keep_one(docs).collect())) == [(5, "a b c d e f g h"), (7, "other words here")]


def brute_vectors(rows, threshold):
    ok = {}
    for i, (_, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float)
    links, groups = Counter(), Groups(len(rows))
    for i in ok:
        for j in ok:
            if i < j and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]):
                if ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    groups.join(i, j)
    smallest = {}
    for i, (doc, _, _) in enumerate(rows):
        if doc is not None:
            smallest[groups.find(i)] = min(smallest.get(groups.find(i), doc), doc)
    return [(doc, links[i], smallest.get(groups.find(i)), doc is not None and smallest[groups.find(i)] == doc) for i, (doc, _, _) in enumerate(rows)]


@pytest.mark.parametrize("threshold", [0.98, 0.9])
def test_embeddings_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(embeddings, "BLOCK_BYTES", 2048)
    rng = np.random.default_rng(7)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(40):
            rows.append((len(rows), (centre + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.2, 0.5])).tolist(), int(c % 3)))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(30)]  # equal vectors
    rows += [(len(rows) + i, [x * 3 for x in rows[1][1]], 0) for i in range(3)]  # scaled
    rows += [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0), (1003, [1.0] * 15 + [None], 0), (1004, [float("inf")] + [1.0] * 15, 0),
             (1005, rows[0][1], None), (1006, rows[0][1][:8], 0), (1007, rows[0][1][:8], 0), (1008, [], 0), (None, rows[0][1], 0), (None, None, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit(1)).repartition(5)
    got = embeddings.near_duplicates(frame, threshold).collect()
    assert none_first(map(tuple, got)) == none_first(brute_vectors(rows, threshold))
    assert embeddings.near_duplicates(frame.limit(0), threshold).count() == 0


def brute_lines(rows, n, num, den):
    """rows: (id, hash, text); removed line numbers by (id, hash)."""
    found, sets = [], {}
    for doc, h, text in set(rows):
        for pos, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                found.append(((doc is None, doc or 0, h, pos), line, (doc, h)))
                sets.setdefault(line, shingles(line, n, lower=False))
    first = {}
    for place, line, _ in sorted(found, key=lambda f: f[0]):
        first.setdefault(line, place)
    order = sorted(sets, key=first.get)
    other = {}
    for a, b in linked_pairs([sets[x] for x in order], num, den):
        other[order[b]] = min(other.get(order[b], first[order[a]]), first[order[a]])
    out = defaultdict(list)
    for place, line, doc in found:
        if place > first[line] or other.get(line, place) < place:
            out[doc].append(place[3])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("n,num,den", [(5, 80, 100), (1, 80, 100), (2, 60, 100)])
def test_line_dedup_brute_force(spark, n, num, den):
    rng = random.Random(n)
    lines = ["common line of many documents here now", "x", "", "  ", "tab\tseparated words\x0bin a line"]
    base = [f"w{i}" for i in range(30)]
    lines += variants(rng, base, 30, 8) + [" ".join(rng.choices(base, k=rng.randint(1, 12))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(150)] + [(3, None), (None, "\n".join(lines[:9])), (7, "x\nx"), (7, "x\nx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pos", F.lit(1)).withColumn("id", F.lit("clash")).repartition(3)
    keyed = [tuple(r) for r in docs.select("doc_id", F.xxhash64("text"), "text").collect()]
    got = {(r["id"], r["text_hash"]): list(r["removed"]) for r in linededup.removed_lines(docs, n, num, den).collect()}
    expected = brute_lines(keyed, n, num, den)
    assert got == expected
    out = linededup.dedup_lines(docs, n, num, den)
    assert out.columns == docs.columns
    left = sorted((d is not None, d or 0, t is not None, t or "") for d, t in out.select("doc_id", "text").collect())
    cut = lambda d, h, t: t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in expected.get((d, h), []))
    assert left == sorted((d is not None, d or 0, t is not None, cut(d, h, t) or "") for d, h, t in keyed)


def test_line_dedup_awkward(awkward, empty):
    out = linededup.dedup_lines(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert linededup.dedup_lines(empty).count() == 0


def test_registered_joins_on_the_small_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op4_ngram_jaccard(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(docs, 3, 90, 100))
    vectors = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op3_embedding_dedup(spark, SMALL).collect())) == sorted(brute_vectors(vectors, 0.98))
    expected = brute_lines([(d, 0, t) for d, t in docs], 5, 80, 100)
    for r in queries.op5_line_dedup(spark, SMALL).collect():
        lost = expected.get((r["doc_id"], 0), [])
        assert r["removed"] == ",".join(map(str, lost)) and r["n_removed"] == len(lost)


def test_words_and_lines_of_blocks():
    import pyarrow as pa

    texts = ["a b\nc", None, "", "\n\nx\n", "é y z", " \t", "last"]
    for _, block in tokens.blocks([pa.RecordBatch.from_pydict({"text": pa.array(texts)})], "text"):
        raw = block.data.tobytes()
        for (starts, ends, first), cut in ((block.words(), WORD.findall), (block.lines(), lambda t: t.split("\n"))):
            for i, t in enumerate(texts):
                assert [raw[a:b].decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]], strict=True)] == cut(t or "")


def test_operators_leave_only_their_result_staged(spark, awkward, tmp_path, monkeypatch):
    made = iter(range(1000))
    monkeypatch.setattr(common, "scratch_path", lambda _, name: str(tmp_path / f"{name}-{next(made)}"))
    left = lambda: sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert linededup.dedup_lines(awkward).count() == awkward.count()
    assert left() == ["line_removed"]
    assert jaccard.jaccard_components(awkward).count() == awkward.count()
    assert left() == ["jaccard_groups", "line_removed"]

    def fails():
        common.stage(awkward.select("doc_id"), "half_way")
        raise ValueError("no")

    with pytest.raises(ValueError):
        common.stage_alone(spark, "never", fails)
    assert left() == ["jaccard_groups", "line_removed"]
