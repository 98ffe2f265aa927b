"""Merkle dataset manifest with incremental witnesses (operator 13).

Each row is a leaf: the SHA-256 of its columns.  The leaves of one tree (here: one language)
ascend by id; as long as several nodes remain, every two neighbours become their hash, and a
last one without a neighbour becomes the hash of itself.  The roots of the trees, in
order, form one more tree of the same kind, whose root stands for the whole table.

A leaf's witness is what it takes to recompute the root: per level the sibling and its
side.  Witnesses grow while leaves are appended: a ``Frontier`` holds the open subtrees,
whose leaves have partial witnesses, and each completed sibling extends the witnesses on
both sides.  Over the cluster the leaves are cut into aligned blocks of ``2 ** BITS``; each
block is one frontier in one task.  The roots of the blocks are appends to the next round of
blocks, and so on; a leaf's witness is its block's part, then the block's own witness.

Defined results: a null value hashes as such; a null language is a tree of its own, the
first; null ids come after all others, and rows with equal ids are ordered by their hash;
repeated rows are leaves each; an empty text is not a null one; a text of any length is
hashed whole inside Spark; an empty table gives an empty result; only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import id_order, materialize, partitions

BITS = 12                     # a block holds 2 ** BITS nodes at most
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NONE = "-"                    # a level at which a node has no sibling


def joined_hash(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode("ascii")).hexdigest()


class Frontier:
    """Open subtrees of an append-only tree, with the witness of every leaf so far."""

    def __init__(self):
        self.witnesses: list[list[str]] = []
        self.open: list[tuple[int, str, int]] = []      # level, digest, first leaf

    def append(self, digest: str) -> None:
        self.open.append((0, digest, len(self.witnesses)))
        self.witnesses.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._merge()

    def _merge(self) -> None:
        """The last two open subtrees are siblings: each extends the other's witnesses."""
        _, right, middle = self.open.pop()
        level, left, first = self.open.pop()
        for leaf in range(first, middle):
            self.witnesses[leaf].append("R" + right)
        for leaf in range(middle, len(self.witnesses)):
            self.witnesses[leaf].append("L" + left)
        self.open.append((level + 1, joined_hash(left, right), first))

    def seal(self, levels: int) -> str:
        """The root ``levels`` above the leaves; nodes without a sibling are hashed alone."""
        while len(self.open) > 1 or self.open[0][0] < levels:
            level, digest, first = self.open[-1]
            if len(self.open) > 1 and self.open[-2][0] == level:
                self._merge()
                continue
            for leaf in range(first, len(self.witnesses)):
                self.witnesses[leaf].append(NONE)
            self.open[-1] = (level + 1, joined_hash(digest), first)
        return self.open[0][1]


def leaf_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns: ``-`` for a null, else UTF-8 byte count, ``:``, value."""
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"),
                            c.cast("string")), F.lit("-")) for c in columns]), 256)


def fold(leaf: Column, witness: Column) -> Column:
    """The root that follows from a leaf and its witness."""
    def up(node: Column, step: Column) -> Column:
        side, sibling = F.substring(step, 1, 1), step.substr(F.lit(2), F.lit(64))
        return F.sha2(F.when(side == "L", F.concat(sibling, node))
                       .when(side == "R", F.concat(node, sibling)).otherwise(node), 256)
    return F.aggregate(witness, leaf, up)


def siblings(witness: Column) -> Column:
    """The siblings of a witness from the leaf to the root, as one string."""
    return F.array_join(F.transform(witness, lambda x: x.substr(F.lit(2), F.lit(64))), "")


def _with(df: DataFrame, ddl: str) -> StructType:
    return StructType(df.schema.fields + StructType.fromDDL(ddl).fields)


def _place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number the rows of each tree within a sorted partition."""
    part, tree, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        trees = batch["tree"].to_numpy(object)
        if not len(trees):
            continue
        begins = np.flatnonzero(np.r_[True, trees[1:] != trees[:-1]])
        place = np.arange(len(trees)) - np.repeat(begins, np.diff(np.r_[begins, len(trees)]))
        if trees[0] == tree:
            place[:begins[1] if len(begins) > 1 else len(trees)] += count
        tree, count = trees[-1], int(place[-1]) + 1
        yield batch.assign(part=np.int32(part), place=place)


def numbered(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` with ``pos`` (0, 1, 2, ... within ``tree`` by ``order``) and the tree's ``total``.

    ``nodes`` must be read from a written table.  It is sorted by range partitions over the
    cluster (rows with equal keys can be parted); per tree only the counts of partitions meet.
    """
    schema = _with(nodes, "row long, part int, place long")
    keys = ["tree", *order, "row"]
    placed = materialize(
        nodes.withColumn("row", F.monotonically_increasing_id())
             .repartitionByRange(partitions(nodes.sparkSession), *keys)
             .sortWithinPartitions(*keys).mapInPandas(_place, schema), name)
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    all_of = Window.partitionBy("tree")
    before = all_of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("tree").alias("of_tree"), F.col("part").alias("of_part"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(all_of).alias("total"))
    return (placed.join(offsets, (F.col("tree") == F.col("of_tree"))
                        & (F.col("part") == F.col("of_part")))
                  .withColumn("pos", F.col("before") + F.col("place"))
                  .select(*nodes.columns, "pos", "total"))


def _blocks(nodes: DataFrame, bits: int, name: str) -> DataFrame:
    """One frontier for each aligned block: ``nodes`` with ``block``, ``witness`` and ``top``.

    ``top``, the root of the block, is on the block's first row.
    """
    rows = nodes.withColumn("block", F.shiftright("pos", bits))
    schema = _with(rows, "witness array<string>, top string")

    def append_all(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos", ignore_index=True)
        frontier = Frontier()
        for digest in group["digest"]:
            frontier.append(digest)
        levels = min(bits, (int(group["total"].iloc[0]) - 1).bit_length())
        tops = [frontier.seal(levels)] + [None] * (len(group) - 1)
        return group.assign(witness=frontier.witnesses, top=tops)

    return materialize(rows.groupBy("tree", "block").applyInPandas(append_all, schema), name)


def trees(nodes: DataFrame, bits: int, name: str) -> list[DataFrame]:
    """The rounds of blocks over ``nodes`` (tree, digest, pos, total, ...): the last round has
    one block in each tree."""
    rounds = [_blocks(nodes, bits, f"{name}-0")]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1 << bits:
        most = -(-most // (1 << bits))
        nodes = rounds[-1].where("top is not null").select(
            "tree", F.col("top").alias("digest"), F.col("block").alias("pos"),
            F.ceil(F.col("total") / (1 << bits)).alias("total"))
        rounds.append(_blocks(nodes, bits, f"{name}-{len(rounds)}"))
    return rounds


def witnessed(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first round's rows with whole witnesses.

    ``above`` has for each tree the rest of the witness (``path``) and other columns, which
    are added.  Each (tree, block) stands for one block's rows, so no key of a join is hot.
    """
    extra = [c for c in above.columns if c not in ("tree", "path")]
    up = rounds[-1].join(above, "tree").withColumn(
        "witness", F.concat("witness", "path")).drop("path")
    for rows in reversed(rounds[:-1]):
        higher = up.select(F.col("tree").alias("up_tree"), F.col("pos").alias("up_pos"),
                           F.col("witness").alias("up_witness"), *extra)
        up = (rows.join(higher, (F.col("tree") == F.col("up_tree"))
                        & (F.col("block") == F.col("up_pos")))
                  .withColumn("witness", F.concat("witness", "up_witness"))
                  .drop("up_tree", "up_pos", "up_witness"))
    return up


def manifest(docs: DataFrame, tampered: Column | None = None, bits: int = BITS) -> DataFrame:
    """``docs`` → doc_id, leaf, subroot, root, witness, and changed: the leaf of a changed row.

    ``tampered`` tells which rows are to be changed (1 is added to ``n_chars``); ``changed`` is
    null for the others.
    """
    columns = {c: F.col(c) for c in LEAF_COLUMNS}
    changed = columns | {"n_chars": F.col("n_chars") + 1}
    tampered = F.lit(False) if tampered is None else tampered
    # null first, then bytewise
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = materialize(docs.select(
        tree.alias("tree"), "doc_id", id_order("doc_id").alias("doc_order"),
        leaf_hash(list(columns.values())).alias("digest"),
        F.when(tampered, leaf_hash(list(changed.values()))).alias("changed")), "leaves")
    rounds = trees(numbered(leaves, ["doc_order", "digest"], "leaves-placed"), bits, "witnesses")
    # the trees' roots are the leaves of one more tree
    roots = materialize(rounds[-1].where("top is not null").select(
        F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("top").alias("digest")),
        "subroots")
    above = trees(numbered(roots, ["of"], "subroots-placed"), bits, "subroot-witnesses")
    root = above[-1].where("top is not null").select(
        "tree", F.col("top").alias("root"), F.array().cast("array<string>").alias("path"))
    paths = witnessed(above, root).select(
        F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root",
        F.col("witness").alias("path"))
    return witnessed(rounds, paths).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "witness", "changed")
