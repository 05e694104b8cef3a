"""Merkle manifest, conversation trie and URL filter against brute force, and their awkward rows."""

import hashlib
import random

import pytest
from llm_tables import awkward, empty  # noqa: F401
from corpusprep.llm import merkle, trie, urls
from corpusprep.llm.art import Direct, Indexed, Sorted, Tree
from pyspark.sql import functions as F


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """The root and, for each leaf, its siblings (left, right) by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, k in enumerate(at):
            first = k // 16 * 16
            run = level[first:first + 16]
            paths[i].append(("".join(run[:k - first]), "".join(run[k - first + 1:])))
        level = [sha("".join(level[j:j + 16])) for j in range(0, len(level), 16)]
        at = [k // 16 for k in at]
    return level[0], paths


def plain_manifest(rows):
    """{(id, leaf): [(subroot, root, siblings)]} of rows (id, group, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], plain_leaf(row)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = plain_tree([leaf for _, leaf in groups[g]])
    root, tops = plain_tree([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for (i, leaf), path in zip(groups[g], trees[g][1]):
            out.append((g, i, leaf, trees[g][0], root, [tuple(p) for p in path + top]))
    return sorted(out, key=repr)


def test_merkle_brute_force(spark):
    rng = random.Random(5)
    sizes = {None: 3, "": 1, "a": 17, "b": 16, "c": 257, "ü": 300, "d": 4097, "e": 256}
    sizes |= {f"s{i}": 2 for i in range(40)}
    rows = [(i, g, rng.choice(["", "x", None, "Größe", "A" * 50])) for g, n in sizes.items() for i in range(n)]
    rows += [(5, "a", "x"), (5, "a", "x"), (None, "a", "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "id long, grp string, text string").repartition(7)
    manifest = merkle.build(df, ("id", "grp", "text"), "id", "grp", {"mark": F.upper("text")})
    proofs = manifest.proofs()
    got = sorted(((r["group"], r["id"], r["leaf"], r["subroot"], r["root"], [(p["left"], p["right"]) for p in r["path"]]) for r in proofs.collect()), key=repr)
    expected = plain_manifest(rows)
    assert got == expected
    assert manifest.root() == expected[0][4]
    good = proofs.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
                         (merkle.fold(F.lit(sha("x")), F.col("path")) == F.col("root")).alias("bad"))
    assert all(r["ok"] and not r["bad"] for r in good.collect())
    assert len(manifest.groups.levels) == 2  # 4097 leaves: stored levels 0 and 2 of 4


def test_merkle_stored_and_reopened(spark, tmp_path):
    rows = [(i, "g", str(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, grp string, text string")
    path = f"file://{tmp_path}/manifest"
    built = merkle.build(df, ("id", "text"), "id", "grp", path=path)
    again = merkle.open_manifest(spark, path)
    assert again.root() == built.root() and again.proofs().count() == 600
    other = merkle.build(df.withColumn("text", F.when(F.col("id") == 599, "changed").otherwise(F.col("text"))), ("id", "text"), "id", "grp")
    assert other.root() != built.root()


def test_merkle_awkward(spark, awkward, empty):
    proofs = merkle.build(awkward, ("doc_id", "text", "size"), "doc_id", "source").proofs()
    rows = proofs.select("leaf", "root", merkle.fold(F.col("leaf"), F.col("path")).alias("folded")).collect()
    assert len(rows) == awkward.count() and all(r["folded"] == r["root"] for r in rows)
    nothing = merkle.build(empty, ("doc_id", "text"), "doc_id", "source")
    assert nothing.proofs().count() == 0 and nothing.root() is None


def test_radix_tree_layouts_and_order():
    rng = random.Random(1)
    for alphabet, length in ((3, 8), (40, 3), (256, 2), (256, 1)):
        tree, plain = Tree(), {}
        for _ in range(3000):
            key = bytes(rng.randrange(alphabet) for _ in range(rng.randrange(length + 1)))
            tree.insert(key, len(plain))
            plain[key] = len(plain) if key not in plain else plain[key]
        names = [(enter, depth, value is not None) for enter, depth, _, value in tree.walk(1)]
        prefixes = {k[:i] for k in plain for i in range(len(k) + 1)}
        assert sum(e for e, _, _ in names) == len(prefixes) == sum(not e for e, _, _ in names)
        assert sum(v for e, _, v in names if e) == len(plain)
    grown, kinds = Sorted(), set()
    for b in rng.sample(range(256), 256):
        grown = grown.add(b, b)
        kinds.add((type(grown).__name__, getattr(grown, "room", 0)))
    assert kinds == {("Sorted", 4), ("Sorted", 16), ("Indexed", 0), ("Direct", 0)}
    assert [b for b, _ in grown.items()] == list(range(256)) and all(grown.find(b) == b for b in range(256))
    assert isinstance(Indexed().add(7, "x").add(3, "y"), Indexed) and isinstance(grown, Direct)


def plain_trie(convs):
    """The nodes of {conv: [(role, text)]}."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {k: [] for k in members}
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(children[k]), leaves[k], saved[k],
                   sha(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k)))) for k, m in members.items())


def spark_trie(spark, convs, **how):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)] + [(None, 0, "user", "left out")]
    keys = trie.turn_keys(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    ids = spark.createDataFrame([(c,) for c in convs], "conv long")
    out = trie.prefix_trie(trie.number_turns(keys), ids, **how).collect()
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], *r[3:]) for r in out)


@pytest.mark.parametrize("chunk", [1, 3, 20_000])
def test_trie_brute_force(spark, chunk):
    rng = random.Random(chunk)
    turn = lambda: (rng.choice(["user", "bot"]), rng.choice(["a", "bé", "ccc"]))
    convs = {c: [turn() for _ in range(rng.randrange(6))] for c in range(120)}
    convs |= {1000 + c: [("user", "same"), ("bot", "words")] for c in range(90)}  # copies
    convs |= {2000 + c: [("user", "first"), ("bot", f"{c}"), ("user", "tail"), ("bot", "end")] for c in range(60)}  # a hot first turn
    long = [("user", f"turn {i}") for i in range(40)]
    convs |= {3000: long, 3001: long, 3002: long[:25], 3003: long[:25] + [("bot", "turns off")] * 9, -7: []}
    assert spark_trie(spark, convs, chunk=chunk, run=8) == plain_trie(convs)


def test_trie_awkward(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, None, "", ""), (2, 0, "user", "x"), (2, 0, "user", "x"), (3, 5, "u", "long " * 20000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for clash in ("conv", "key", "place", "total", "own", "name", "node"):
        df = df.withColumn(clash, F.lit("clash"))
    got = {(r["conv_id"], r["depth"]): r for r in trie.conversation_trie(df).collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 2), (1, 3), (3, 1)}
    assert got[1, 3]["n_convs"] == 2 and got[1, 3]["ends_sha256"] == sha("1,2") and got[1, 0]["n_leaves"] == 2 and got[1, 0]["saved_tokens"] == 2
    assert trie.conversation_trie(df.filter("conv_id < 0")).count() == 0


URLS = [
    "http://example.com/en/1", "http://a.b.example.com/en/x?y#z", "HTTP://WWW.EXAMPLE.COM/EN/", "https://www.example.com/en/a/b/c", "http://notexample.com/en/1",
    "http://example.com", "http://example.com?x=/en/", "http://example.com#/en/", "http://x.net/es/1", "http://net/fr/", "http://x.net/de/", "no scheme", "", None,
    "http:///en/", "http://./en/", "://example.com/en/?", "http://a.com://b.net/es/", "http://example.com/enough", "http://.example.com//en/", "ftp://user@x.example.com:80/en/",
    "http://t.com/" + "a/" * 3000 + "z", "http://" + "a." * 3000 + "deep.org/p/q/r", "http://deep.org/p/q", "http://sub.deep.org/p/qx\n/y",
]
LIST = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
        ("deep.org", "/p/q", "block"), ("deep.org", "/p/", "allow"), ("example.com", "/enou", "block"), ("Example.com:80", "", "block"),
        ("x.net", "", "allow"), ("x.net", "", "block"), (None, "/", "block"), ("org", None, "block"), ("zzz", "/", None), ("com", "/", "allow")]


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    host, tail = low(rest[:end]), rest[end:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h) + len(p or ""), len(h), v == "block", low(h) + (p or ""), v) for h, p, v in rules
            if h and v and (host == low(h) or host.endswith("." + low(h))) and path.startswith(p or "")]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_urls_brute_force(spark):
    rules = spark.createDataFrame(LIST, "host string, path string, verdict string")
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect()}
    assert got == {i: plain_verdict(u, LIST) for i, u in enumerate(URLS)}
    kept = {r["page_id"] for r in urls.keep_allowed(pages, rules).collect()}
    assert kept == {i for i, v in got.items() if v[3] == "allow"}


def test_urls_by_shuffled_join(spark):
    """A list too large to broadcast gives the same verdicts."""
    many = LIST + [(f"h{i}.com", "/", "block") for i in range(500)]
    rules = spark.createDataFrame(many, "host string, path string, verdict string")
    rows = list(enumerate(URLS * 3 + [f"http://h{i % 700}.com/x" for i in range(2000)]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: plain_verdict(u, many) for i, u in rows}


def test_urls_awkward(spark):
    rows = [(None, None, "x"), (None, "http://a.net/es/", "y"), (1, "http://a.net/es/", "y"), (1, "http://a.net/es/", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for clash in ("id", "host", "path", "row", "short", "said", "verdict", "rule", "r_host"):
        pages = pages.withColumn(clash, F.lit("clash"))
    rules = spark.createDataFrame([("net", "/es/", "block")], "host string, path string, verdict string")
    got = sorted(((r["id"], r["verdict"]) for r in urls.judge(pages, rules).collect()), key=repr)
    assert got == [(1, "block"), (1, "block"), (None, "allow"), (None, "block")]
    assert urls.keep_allowed(pages, rules).columns == pages.columns and urls.keep_allowed(pages, rules).count() == 1
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert all(r["rule"] is None for r in urls.judge(pages, rules.limit(0)).collect())
