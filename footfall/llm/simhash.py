"""SimHash near-dedup by meet-in-the-middle ball hashing (operator 8).

Two fingerprints that differ in at most three bits have a point between them
that is at most one bit from one of them and at most two bits from the other.
Each distinct fingerprint emits its variants within half the radius: all
within one bit and, if its number of set bits is even, all within two.  (Of two
fingerprints three bits apart exactly one is even; two bits apart, both reach
the point between by one bit.)  Variants are shuffled by a hash of the variant;
whoever meets on one is verified by the bit distance.

A variant travels as its fingerprint and the number of the flip mask, packed per
task and hash range, two bytes a variant.  The ranges hold about
``RANGE_VARIANTS`` variants each at any size of the input.  Equal fingerprints are
one before this, so no variant has more than 2,081 owners.  On a variant the
nearest smallest owner (within one bit) is linked to every other owner: these
links are all true links, and they connect what all pairs would connect.

Defined results: a null, empty or wordless text has fingerprint zero, linked like
any other; a null id counts as greater than all others when the smallest of a
component is sought (a component of null ids only has a null id); rows with equal
ids each get their own text's fingerprint; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, free_name, id_order, materialize, mix, partitions
from .components import components

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 3
RANGE_VARIANTS = 1_000_000
_BATCH = 2048               # fingerprints whose variants a task holds at a time


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text: bit set in over half of the shingle hashes."""
    # bytes.lower() and bytes.split() touch A-Z and the six white-space bytes only
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[lo:lo + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(ones * 2 > len(hashes)).tolist())


def fingerprint(text: str, shingle: int = SHINGLE) -> Column:
    """A long column: the fingerprint's 64 bits of the column ``text``."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts],
                                  dtype=np.uint64).view(np.int64), index=texts.index)
    # nondeterministic to the planner, so that a filter on the result doesn't run it again
    return F.pandas_udf(run, "long").asNondeterministic()(F.col(text))


def _masks() -> np.ndarray:
    """Flip masks: none, each single bit, each pair of bits."""
    one = np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))
    i, j = np.triu_indices(BITS, 1)
    return np.concatenate(([np.uint64(0)], one, one[i] | one[j]))


MASKS = _masks()
_NEAR = 1 + BITS            # masks of at most one bit come first


def _emit(batches: Iterator[pd.DataFrame], ranges: int) -> Iterator[pd.DataFrame]:
    """Pack the variants of a batch of fingerprints by the hash range of the variant."""
    for batch in batches:
        every = batch["fp"].to_numpy(np.int64).view(np.uint64)
        even = np.bitwise_count(every) % 2 == 0
        for fps, n in ((every[even], len(MASKS)), (every[~even], _NEAR)):
            for lo in range(0, len(fps), _BATCH):
                part = fps[lo:lo + _BATCH]
                at = (mix(part[:, None] ^ MASKS[None, :n]) % np.uint64(ranges)).astype(
                    np.uint16 if ranges < 1 << 16 else np.uint32).ravel()
                order = np.argsort(at, kind="stable")
                at = at[order]
                owner, mask = np.divmod(order, n)
                edges = np.r_[0, np.flatnonzero(np.diff(at)) + 1, len(at)]
                rows = []
                for a, b in zip(edges[:-1], edges[1:]):
                    own = owner[a:b]
                    begin = np.r_[0, np.flatnonzero(np.diff(own)) + 1]
                    rows.append((int(at[a]), part[own[begin]].tobytes(),
                                 np.diff(np.r_[begin, b - a]).astype(np.uint16).tobytes(),
                                 mask[a:b].astype(np.uint16).tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "fps", "counts", "masks"])


def _meet(group: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links between the fingerprints that meet on a variant of one hash range."""
    fps = np.frombuffer(b"".join(group["fps"]), np.uint64)
    counts = np.frombuffer(b"".join(group["counts"]), np.uint16)
    masks = np.frombuffer(b"".join(group["masks"]), np.uint16)
    owner = np.repeat(fps, counts)
    variant = owner ^ MASKS[masks]
    order = np.argsort(variant)
    variant = variant[order]
    same = variant[1:] == variant[:-1]
    keep = np.zeros(len(variant), bool)
    keep[1:] |= same
    keep[:-1] |= same
    order, variant = order[keep], variant[keep]
    owner, near = owner[order], masks[order] < _NEAR
    if not len(owner):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    begin = np.r_[0, np.flatnonzero(variant[1:] != variant[:-1]) + 1]
    none = np.uint64(2**64 - 1)
    # 2^64-1 marks "no near owner"; as an owner itself it loses nothing: a link to itself
    anchor = np.minimum.reduceat(np.where(near, owner, none), begin)
    anchor = np.repeat(anchor, np.diff(np.r_[begin, len(owner)]))
    has = np.repeat(np.logical_or.reduceat(near, begin), np.diff(np.r_[begin, len(owner)]))
    link = has & (owner != anchor) & (np.bitwise_count(owner ^ anchor) <= radius)
    pairs = np.unique(np.stack([owner[link], anchor[link]], axis=1), axis=0)
    return pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints (``fp`` long) → links a, b that connect all within ``radius``."""
    if not 0 <= radius <= 3:
        raise ValueError("balls of one and two bits reach a distance of at most three")
    spark = fps.sparkSession
    n = fps.count()
    spread = n * (len(MASKS) + _NEAR) / 2
    ranges = max(partitions(spark), math.ceil(spread / RANGE_VARIANTS))
    packed = fps.select("fp").mapInPandas(
        partial(_emit, ranges=ranges), "bucket long, fps binary, counts binary, masks binary")
    return packed.groupBy("bucket").applyInPandas(lambda group: _meet(group, radius),
                                                  "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` (doc_id, text) → doc_id, fp (long), component_id, one row per input row."""
    return _clusters(_marked(docs, shingle), radius).drop("root")


def _marked(docs: DataFrame, shingle: int) -> DataFrame:
    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   fingerprint("text", shingle).alias("fp")), "fingerprints")


def _clusters(marked: DataFrame, radius: int) -> DataFrame:
    """A written table (doc_id, fp) → doc_id, fp, root (a fingerprint), component_id."""
    spark = marked.sparkSession
    fps = materialize(marked.groupBy("fp").agg(F.min(id_order("doc_id")).alias("first")), "fps")
    # one task per core and a few more: the emitted variants are a thousand times the rows
    roots = components(links(fps.repartition(partitions(spark), "fp"), radius))
    rooted = fps.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component")
    return (marked.join(named, F.col("fp") == F.col("_fp"))
                  .select("doc_id", "fp", "root",
                          F.when((F.col("component") == LAST_ID) & F.col("doc_id").isNull(),
                                 F.lit(None)).otherwise(F.col("component")).alias("component_id")))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest id.

    Among repeated rows of that id and text any one stays.  Columns are kept;
    a column of the input may have any name.
    """
    mark, place = free_name(docs, "fingerprint"), free_name(docs, "id_order")
    found = _clusters(_marked(docs, shingle), radius).withColumn("o", id_order("doc_id"))
    first = (found.groupBy("root").agg(F.min(F.struct("o", "fp")).alias("k"))
                  .select(F.col("k.o").alias("o"), F.col("k.fp").alias("f")))
    marked = docs.withColumn(mark, fingerprint("text", shingle)).withColumn(
        place, id_order("doc_id"))
    return (marked.join(first, (marked[place] == first["o"]) & (marked[mark] == first["f"]),
                        "left_semi")
                  .dropDuplicates([place, mark]).select(*docs.columns))
