"""Prefix trie of conversations: adaptive radix trees over fixed-width turn ids, grown in sorted chunks.

A turn's id is the first 16 bytes of the SHA-256 of its role and text; a conversation's key is its turns' ids in a
row.  Every distinct sequence of first turns is a node; nodes lie at byte depths that are
multiples of 16, other branching points of the trees name nothing.

1. Each prefix has a 128-bit name, the running xor of hashes of place and turn.  From the first prefix
   that no other conversation has, a conversation is alone: these tails are paths without branches,
   their nodes follow from the turn rows, and the trees never hold them.
2. What is left of the keys, up to the first turn of the tail, is grouped (a group of copies is one row with a
   count), dealt out by a range partition and sorted.  Each task grows a tree for every ``CHUNK`` keys.  Nodes on
   the paths of a chunk's first and last key may go on in its neighbours: they come out open, with the sums
   of their closed children.  All other nodes are final.
3. The open nodes, two paths for each chunk, are added up by their names, and their subtrees by doubling: in each round a
   node adds what its descendants at twice the distance have gathered.

A conversation of any length, a first turn that all share or a group of copies thus never meets in one task; only a key that
several conversations share from the first turn to the last travels as one row (about 60 bytes a turn).  The digest of the ids that end at a node
is one SHA-256 over their list by definition: the list is made in sorted pieces of ``PIECE`` ids and hashed as a stream.

Defined cases: null roles and texts are empty; turns are ordered by turn, null first, then by id; rows without conversation id
belong to no conversation and are left out; a conversation without turns ends at the root; equal conversations share all nodes;
an empty table has no node.  Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .art import Tree
from .common import places, stage

WIDTH = 16
#: Keys (and bytes of keys) of one tree.
CHUNK, CHUNK_BYTES = 20_000, 4 << 20
#: Ids in one piece of a list that is hashed.
PIECE = 4096
#: Turns whose names are summed in one window.
RUN = 4096

_GROWN = ("node binary, parent binary, open boolean, depth long, conv long, up_conv long, n long, kids long, leaves long, "
          "saved long, bytes long, ends string")


def turn_keys(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, key, bytes): a turn's id as 32 hex digits and the UTF-8 bytes of its text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    return turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))


def number_turns(keys: DataFrame) -> DataFrame:
    """(conv, place, key, bytes, total): turns by their places from 0."""
    hashed = stage(keys.select(F.col("conv").alias("g"), "turn", "key", "bytes"), "trie_turns")
    path = scratch_path(keys.sparkSession, "trie_lined")
    return places(hashed, ("turn", "key"), path).select(F.col("g").alias("conv"), "place", "key", "bytes", "total")


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes of all conversations of a table of turns, see ``prefix_trie``."""
    keys = turn_keys(turns, conv_col, turn_col, role_col, text_col)
    return prefix_trie(number_turns(keys), keys.select("conv").distinct())


def _prefixes(turns: DataFrame, length: int) -> DataFrame:
    """``turns`` with ``name``: 128 bits for each conversation's first turns up to this one, in runs of ``length`` turns."""
    run = F.floor(F.col("place") / length)
    marked = turns.withColumns({"run": run, "x": F.xxhash64("place", "key"), "y": F.xxhash64("key", "place")})
    here = Window.partitionBy("conv", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = marked.withColumns({"x": F.bit_xor("x").over(here), "y": F.bit_xor("y").over(here)})
    longer = turns.filter(F.col("place") == length).select("conv")
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (marked.join(longer, "conv", "left_semi").groupBy("conv", "run").agg(F.bit_xor("x").alias("x0"), F.bit_xor("y").alias("y0"))
            .withColumns({"x0": F.bit_xor("x0").over(earlier), "y0": F.bit_xor("y0").over(earlier)}))
    none = F.lit(0).cast("long")
    name = F.struct(F.col("x").bitwiseXOR(F.coalesce("x0", none)).alias("x"), F.col("y").bitwiseXOR(F.coalesce("y0", none)).alias("y"))
    return inner.join(runs, ["conv", "run"], "left").select(*turns.columns, name.alias("name"))


def prefix_trie(turns: DataFrame, convs: DataFrame, chunk: int = CHUNK, run: int = RUN) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv: distinct ids) with ``turns`` (conv, place, key, bytes; places from 0 without gaps).

    A row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ``chunk`` (keys of one tree) and ``run`` (turns named in one window) change no result.
    """
    named = stage(_prefixes(turns.select("conv", "place", "key", "bytes"), run), "trie_names")
    alone = (named.groupBy("name", "place").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
             .filter("n = 1").groupBy("conv").agg(F.min("place").alias("own")))
    facts = stage(convs.select("conv").join(named.groupBy("conv").agg(F.count(F.lit(1)).alias("total")), "conv", "left")
                  .join(alone, "conv", "left").select("conv", F.coalesce("total", F.lit(0)).alias("total"), "own"), "trie_facts")
    placed = named.join(facts, "conv").select("conv", "place", "key", "bytes", "total", "own")

    in_tree = placed.filter((F.col("place") <= F.col("own")) | F.col("own").isNull())
    parts = in_tree.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "key", "bytes"))).alias("t"))
    keyed = facts.join(parts, "conv", "left").select(
        "conv", F.unhex(F.array_join(F.coalesce("t.key", F.array().cast("array<string>")), "")).alias("key"),
        F.coalesce("t.bytes", F.array().cast("array<long>")).alias("sizes"),
        (F.col("total") > F.when(F.col("t").isNull(), 0).otherwise(F.size("t"))).alias("more"))
    keyed = stage(keyed, "trie_keys")
    groups = stage(keyed.groupBy("key", "more").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.first("sizes").alias("sizes"))
                   .withColumn("ends", F.when(~F.col("more"), F.sha2("key", 256))), "trie_groups")
    grown = stage(groups.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(partial(_grow, chunk), _GROWN), "trie_nodes")

    opened = _close(grown.filter("open"))
    closed = grown.filter("NOT open").select("conv", "depth", "up_conv", "n", "kids", "leaves", "saved", "ends", "parent")
    under = closed.filter("parent IS NOT NULL").drop("up_conv").join(opened.select(F.col("node").alias("parent"), F.col("conv").alias("up_conv")), "parent")
    nodes = closed.filter("parent IS NULL").drop("parent").unionByName(under.drop("parent")).unionByName(opened.drop("node"))
    digests = _end_digests(keyed.filter(~F.col("more")).select(F.sha2("key", 256).alias("ends"), "conv"))
    nobody = F.sha2(F.lit(""), 256)
    ended = nodes.filter("ends IS NOT NULL").join(digests, "ends").drop("ends")
    shared = nodes.filter("ends IS NULL").drop("ends").withColumn("digest", nobody).unionByName(ended).select(
        F.col("conv").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("digest").alias("ends_sha256"))
    depth, one = F.col("place") + 1, F.lit(1).cast("long")
    tails = placed.filter(F.col("place") > F.col("own")).select(
        F.col("conv").alias("conv_id"), depth.alias("depth"), F.col("conv").alias("parent_conv_id"), one.alias("n_convs"),
        (depth < F.col("total")).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(depth == F.col("total"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(nobody).alias("ends_sha256"))
    return shared.unionByName(tails)


def _grow(chunk: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of sorted keys (key, more, n, conv, sizes, ends), a tree for each chunk."""
    rows, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            rows.append(row)
            size += len(row["key"]) + 8 * len(row["sizes"])
            if len(rows) >= chunk or size >= CHUNK_BYTES:
                yield from _nodes(rows)
                rows, size = [], 0
    if rows:
        yield from _nodes(rows)


def _border(key: bytes) -> set[bytes]:
    """The names of the nodes on a key's path."""
    found = [b"root"]
    for at in range(0, len(key), WIDTH):
        found.append(hashlib.sha256(found[-1] + key[at:at + WIDTH]).digest()[:16])
    return set(found)


def _nodes(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    tree = Tree()
    for row in rows:
        tree.insert(row["key"], row)
    border = _border(rows[0]["key"]) | _border(rows[-1]["key"])
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("open", pa.bool_()), ("depth", pa.int64()),
                        ("conv", pa.int64()), ("up_conv", pa.int64()), ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
                        ("bytes", pa.int64()), ("ends", pa.string())])
    out: list[dict] = []
    stack: list[dict] = []  # the nodes on the path
    for enter, depth, chain, value in tree.walk(WIDTH):
        if enter:
            stack.append({"n": 0, "conv": None, "kids": 0, "leaves": 0, "saved": 0, "below": [], "bytes": 0, "ends": None, "name": chain})
            if value is not None:
                me = stack[-1]
                me |= {"n": value["n"], "conv": value["conv"], "ends": value["ends"], "kids": int(value["more"]), "leaves": int(value["more"])}
                for at, node in enumerate(stack):  # a text's size is known at every end below it
                    node["bytes"] = value["sizes"][at - 1] if at else 0
            continue
        me = stack.pop()
        up = stack[-1] if stack else None
        is_open = chain in border
        if not is_open:
            me["leaves"] = me["leaves"] or 1
            me["saved"] += (me["n"] - 1) * me["bytes"]
        if up is not None:
            up["n"] += me["n"]
            up["conv"] = me["conv"] if up["conv"] is None else min(up["conv"], me["conv"])
            if not is_open:
                up["kids"] += 1
                up["leaves"] += me["leaves"]
                up["saved"] += me["saved"]
        up_open = up is not None and up["name"] in border
        row = {"node": chain if is_open else None, "parent": up["name"] if up_open else None,
               "open": is_open, "depth": depth, "conv": me["conv"], "up_conv": None, "n": me["n"], "kids": me["kids"], "leaves": me["leaves"], "saved": me["saved"], "bytes": me["bytes"], "ends": me["ends"]}
        out.append(row)
        for child in me["below"]:  # a node's smallest member is known now
            child["up_conv"] = me["conv"]
        if up is not None:
            up["below"].append(row)
    for at in range(0, len(out), CHUNK):
        yield pa.RecordBatch.from_pylist(out[at:at + CHUNK], schema)


def _close(parts: DataFrame) -> DataFrame:
    """The open nodes, added up over the chunks that know a part of them."""
    parts = stage(parts.groupBy("node").agg(
        F.first("parent", ignorenulls=True).alias("parent"), F.first("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"),
        F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.first("bytes").alias("bytes"),
        F.first("ends", ignorenulls=True).alias("ends")), "trie_open")
    children = parts.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("open_kids"))
    ups = parts.select(F.col("node").alias("parent"), F.col("conv").alias("up_conv"))
    own = parts.join(children, "node", "left").join(ups, "parent", "left").withColumn("kids", F.col("kids") + F.coalesce("open_kids", F.lit(0)))
    own = own.withColumns({"leaves": F.when(F.col("kids") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")),
                           "saved": F.col("saved") + (F.col("n") - 1) * F.col("bytes")})
    # sums over descendants at a distance below 1, 2, 4 ...; up is the ancestor at that distance
    sums = stage(own.select("node", F.col("parent").alias("up"), "leaves", "saved"), "trie_sums")
    deepest, reach = parts.agg(F.max("depth")).first()[0] or 0, 1
    while reach <= deepest:
        given = sums.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = sums.select(F.col("node").alias("up"), F.col("up").alias("next"))
        none = F.lit(0).cast("long")
        sums = stage(sums.join(given, "node", "left").join(above, "up", "left").select(
            "node", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", none)).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", none)).alias("saved")), "trie_sums")
        reach *= 2
    return own.select("node", "depth", "conv", "up_conv", "n", "kids", "ends").join(sums.select("node", "leaves", "saved"), "node").select(
        "node", "conv", "depth", "up_conv", "n", "kids", "leaves", "saved", "ends")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(ends, digest): the SHA-256 of each list of conversation ids, ascending, joined by commas."""
    ends = stage(ends, "trie_ends")
    pieces = ends.repartitionByRange("ends", "conv").sortWithinPartitions("ends", "conv").mapInArrow(_pieces, "ends string, first long, ids string")
    return pieces.repartition("ends").sortWithinPartitions("ends", "first").mapInArrow(_hash, "ends string, digest string")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, ids = None, []
    piece = lambda: pa.RecordBatch.from_pydict({"ends": [name], "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]})
    for batch in batches:
        for ends, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (ends != name or len(ids) == PIECE):
                yield piece()
                ids = []
            name = ends
            ids.append(conv)
    if ids:
        yield piece()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, running = None, None
    done = lambda: pa.RecordBatch.from_pydict({"ends": [name], "digest": [running.hexdigest()]})
    for batch in batches:
        for ends, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if ends == name:
                running.update(b",")
            else:
                if running is not None:
                    yield done()
                name, running = ends, hashlib.sha256()
            running.update(ids.encode())
    if running is not None:
        yield done()
