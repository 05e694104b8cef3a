"""Merkle manifest of a table: trees of sparse stored levels, interior nodes regenerated for proofs.

Every row is a leaf: SHA-256 of its named columns, each ``-`` if null, else its byte count, ``:`` and its value.
The leaves of a group, in order, are the lowest level of the group's tree; every ``FANOUT`` consecutive nodes become the hash
of their concatenated hex digests until one remains, the group's subroot.  The subroots, in order of
their groups, are the leaves of a top tree in the same way; its root names the whole dataset.

Only every ``KEEP_EVERY``-th level is stored, in blocks of the ``FANOUT ** KEEP_EVERY`` nodes that one node of the next
stored level covers.  A proof walks down the stored levels: each block regenerates the levels in between
from its stored nodes, hands to each node its siblings below the block's parent and the parent's own proof,
and keeps nothing.  So a block is the largest thing a task holds, whatever a group's size; leaves get their
places by a range partition and running counts over its parts, never by a group's rows in one task.

Defined cases: null columns are ``-``; null groups form one group, first; null ids come first; rows with equal ids are
ordered by leaf, so equal rows have neighbouring leaves and one proof each; a group of one row has its leaf as subroot; an empty table has no leaves and no
root.  Columns other than those named are not read.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import places, write_back

FANOUT = 16
KEEP_EVERY = 2
#: Leaves under one node of the next stored level.
SPAN = FANOUT ** KEEP_EVERY
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_hash(*values: Column) -> Column:
    """The hash of a row's values: ``-`` for null, else byte count, ``:`` and value."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))


def siblings(path: Column) -> Column:
    """The digests of a proof, level by level from the leaf, left to right, as one text."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def _height(total: Column) -> Column:
    """Levels above ``total`` leaves: the least h with FANOUT ** h >= total."""
    return sum(((total > F.lit(FANOUT ** h)).cast("int") for h in range(1, 15)), (total > 1).cast("int"))


def _above(nodes: Column) -> Column:
    """The next level over a block's nodes."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int")),
                       lambda j: digest(F.array_join(F.slice(nodes, j * FANOUT + 1, F.lit(FANOUT)), "")))


def _regenerate(blocks: DataFrame, level: int) -> DataFrame:
    """``blocks`` with their own levels (l0: the stored nodes) up to the parent, which is the only node of the last."""
    out = blocks.withColumns({"l0": F.col("nodes.node"), "steps": F.least(F.lit(KEEP_EVERY), F.col("height") - level)})
    for s in range(1, KEEP_EVERY + 1):
        out = out.withColumn(f"l{s}", _above(F.col(f"l{s - 1}")))
    return out


def _blocks(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(g, height, run, nodes): the nodes (place, node, carry) of SPAN consecutive places in a row; bounded by SPAN."""
    return nodes.groupBy("g", "height", F.floor(F.col("place") / SPAN).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("place", "node", *carry))).alias("nodes"))


@dataclass
class Forest:
    """The trees of all groups: stored levels 0, KEEP_EVERY, 2 * KEEP_EVERY ... as blocks, and the roots (g, height, root)."""

    levels: list[DataFrame]
    roots: DataFrame

    @staticmethod
    def build(leaves: DataFrame, order: Sequence[str], carry: Sequence[str], path: str) -> Forest:
        """``leaves``: (g, node, order columns, carried columns)."""
        placed = places(leaves, order, os.path.join(path, "leaves"))
        nodes = placed.select("g", "place", "node", *carry, _height(F.col("total")).alias("height"))
        levels, roots, level = [], [], 0
        while True:
            blocks = write_back(_blocks(nodes, carry if not level else ()), os.path.join(path, f"level_{level}"))
            levels.append(blocks)
            last = F.col("height") <= level + KEEP_EVERY
            parent = F.element_at(F.array(*[F.col(f"l{s}") for s in range(KEEP_EVERY + 1)]), F.col("steps") + 1)[0]
            parents = _regenerate(blocks, level).select("g", "height", F.col("run").alias("place"), parent.alias("node"))
            roots.append(parents.filter(last).select("g", "height", F.col("node").alias("root")))
            # one number: the tallest tree
            if (blocks.agg(F.max("height")).first()[0] or 0) <= level + KEEP_EVERY:
                break
            nodes, level = parents.filter(~last), level + KEEP_EVERY
        every = roots[0]
        for more in roots[1:]:
            every = every.unionByName(more)
        return Forest(levels, write_back(every, os.path.join(path, "roots")))

    @staticmethod
    def open(spark: SparkSession, path: str, n_levels: int) -> Forest:
        return Forest([spark.read.parquet(os.path.join(path, f"level_{i * KEEP_EVERY}")) for i in range(n_levels)],
                      spark.read.parquet(os.path.join(path, "roots")))

    def proofs(self, tops: DataFrame, carry: Sequence[str], wanted: Sequence[str] = ()) -> DataFrame:
        """(g, node, carried columns, path, ``wanted``) for every leaf.  ``tops``: (g, path, wanted columns) of each group's root.

        A path holds (left, right) of each level: the siblings before and after the node, as one text each.
        """
        ends = self.roots.select(F.col("g").alias("up_g"), "height").join(tops, F.col("up_g").eqNullSafe(F.col("g"))).select(
            "up_g", F.lit(0).cast("long").alias("up_place"), F.col("height").alias("up_height"), F.col("path").alias("up"), *wanted)
        above = None
        for i in range(len(self.levels) - 1, -1, -1):
            level = i * KEEP_EVERY
            here = ends.filter((F.col("up_height") <= level + KEEP_EVERY) & ((F.col("up_height") > level) if level else F.lit(True))).drop("up_height")
            above = here if above is None else here.unionByName(above)
            blocks = _regenerate(self.levels[i], level)
            met = blocks.join(above, F.col("g").eqNullSafe(F.col("up_g")) & (F.col("run") == F.col("up_place")))
            items = F.transform("nodes", lambda x, k: F.struct(
                x["place"].alias("place"), x["node"].alias("node"), *([x[c].alias(c) for c in carry] if not level else []),
                F.concat(F.filter(F.array(*[_side(s, k) for s in range(KEEP_EVERY)]), lambda p: p["left"].isNotNull()), F.col("up")).alias("path")))
            out = met.select("g", F.explode(items).alias("x"), *wanted)
            if level:
                above = out.select(F.col("g").alias("up_g"), F.col("x.place").alias("up_place"), F.col("x.path").alias("up"), *wanted)
        return out.select("g", "x.node", *[F.col(f"x.{c}").alias(c) for c in carry], "x.path", *wanted)


def _side(step: int, k: Column) -> Column:
    """(left, right) of a block's node ``k`` at its ``step``-th regenerated level; nulls above the tree's root."""
    nodes = F.col(f"l{step}")
    at = F.floor(k / FANOUT ** step).cast("int")
    first = F.floor(at / FANOUT).cast("int") * FANOUT
    text = lambda start, n: F.when(F.col("steps") > step, F.array_join(F.slice(nodes, start, n), ""))
    return F.struct(text(first + 1, at - first).alias("left"), text(at + 2, first + (FANOUT - 1) - at).alias("right"))


@dataclass
class Manifest:
    """What is stored of a dataset: the groups' trees and the tree over their subroots."""

    groups: Forest
    top: Forest
    carry: tuple[str, ...]

    def root(self) -> str | None:
        found = self.top.roots.first()
        return found["root"] if found else None

    def proofs(self) -> DataFrame:
        """(group, id, leaf, carried columns, path, subroot, root) for every row: ``fold(leaf, path)`` is the root."""
        start = self.top.roots.select("g", F.array().cast("array<struct<left:string,right:string>>").alias("path"), "root")
        tops = self.top.proofs(start, ("group",), ("root",)).select(F.col("group").alias("g"), "path", F.col("node").alias("subroot"), "root")
        out = self.groups.proofs(tops, ("id", *self.carry), ("subroot", "root"))
        return out.select(F.col("g").alias("group"), "id", F.col("node").alias("leaf"), *self.carry, "path", "subroot", "root")


def build(rows: DataFrame, columns: Sequence[str], id_col: str, group_col: str, carry: Mapping[str, Column] | None = None,
          path: str | None = None) -> Manifest:
    """Manifest of ``rows``: leaves over ``columns``, by id in a tree for each group; ``carry`` travels with the leaves.

    ``path`` is a new folder that all executors share (by default under the checkpoint folder); ``open_manifest`` reads it later.
    """
    spark, carry = rows.sparkSession, dict(carry or {})
    path = path or scratch_path(spark, "merkle")
    # texts are read and hashed once; a range partition samples its input before it deals it out
    leaves = write_back(rows.select(F.col(group_col).alias("g"), F.col(id_col).alias("id"), leaf_hash(*[F.col(c) for c in columns]).alias("node"),
                                *[c.alias(f"c_{name}") for name, c in carry.items()])
                    .select("g", "id", "node", *[F.col(f"c_{name}").alias(name) for name in carry]), os.path.join(path, "hashed"))
    groups = Forest.build(leaves, ("id", "node"), ("id", *carry), os.path.join(path, "groups"))
    tops = groups.roots.select(F.lit(0).alias("g"), F.col("g").alias("group"), F.col("root").alias("node"))
    top = Forest.build(tops, ("group",), ("group",), os.path.join(path, "top"))
    facts = spark.range(1).select(F.lit(len(groups.levels)).alias("groups"), F.lit(len(top.levels)).alias("top"),
                                  F.array(*[F.lit(c) for c in carry]).cast("array<string>").alias("carry"))
    facts.write.parquet(os.path.join(path, "facts"))
    return Manifest(groups, top, tuple(carry))


def open_manifest(spark: SparkSession, path: str) -> Manifest:
    """A manifest that ``build`` wrote to ``path``."""
    facts = spark.read.parquet(os.path.join(path, "facts")).first()
    return Manifest(Forest.open(spark, os.path.join(path, "groups"), facts["groups"]),
                    Forest.open(spark, os.path.join(path, "top"), facts["top"]), tuple(facts["carry"]))
