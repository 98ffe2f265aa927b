"""Sharding by jump consistent hashing (operator 9), in DataFrame functions only.

A stable key is hashed to 64 bits and jumps through the shard numbers: from
shard ``b`` to ``floor((b + 1) * 2^31 / (1 + (key >> 33)))`` while that is below the
shard count, with ``key = key * 2862933555777941757 + 1 (mod 2^64)`` before each
jump.  There is no ring table; one more shard takes its fair part of the rows
and moves none between the others.

Defined results: a null key is a key like any other (hashed by its own constant);
rows with equal keys share a shard; a null text has no bytes.  The place of a row
inside its shard (``slot``) is gapless from 0; its order among the rows of the shard
is any.  Columns of the input are kept by ``shard_table``; those with the names of the
result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, with_rank

SHARDS = 16
MULTIPLIER = 2862933555777941757
_LOW32 = (1 << 32) - 1


def _next_key(high: Column, low: Column) -> tuple[Column, Column]:
    """``key * MULTIPLIER + 1`` modulo 2^64 on 32-bit halves; no product leaves 63 bits."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & _LOW32
    m1, m0 = m_low >> 16, m_low & 0xFFFF
    p0, p1 = low * F.lit(m0), low * F.lit(m1)
    small = p0 + F.shiftleft(p1.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    q0, q1 = high * F.lit(m0), (high * F.lit(m1)).bitwiseAND(F.lit(0xFFFF))
    large = (F.shiftright(small, 32) + F.shiftright(p1, 16)
             + (low * F.lit(m_high)).bitwiseAND(F.lit(_LOW32))
             + q0.bitwiseAND(F.lit(_LOW32)) + F.shiftleft(q1, 16))
    return large.bitwiseAND(F.lit(_LOW32)), small.bitwiseAND(F.lit(_LOW32))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (int, 0 to ``shards`` - 1) of a 64-bit ``key``."""
    if shards < 1:
        raise ValueError("at least one shard")

    def jump(state: Column, _: Column) -> Column:
        # a finished row (next >= shards) stays as it is
        high, low = _next_key(state["high"], state["low"])
        at = state["next"]
        over = F.floor((at + F.lit(1)) * (F.lit(float(1 << 31))
                                          / (F.shiftright(high, 1) + F.lit(1)).cast("double")))
        moved = F.struct(high.alias("high"), low.alias("low"), at.alias("at"),
                         over.cast("long").alias("next"))
        return F.when(at < F.lit(shards), moved).otherwise(state)

    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"),
                     key.bitwiseAND(F.lit(_LOW32)).alias("low"),
                     F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))
    # each jump moves on by at least one shard
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump,
                       lambda s: s["at"].cast("int"))


def stable_key(col: str | Column) -> Column:
    """64 stable bits of a key column of any type; null has its own."""
    c = F.col(col) if isinstance(col, str) else col
    return F.xxhash64(c)


def shard_table(df: DataFrame, key: str, shards: int = SHARDS) -> DataFrame:
    """``df`` with ``shard``, ``grown_shard`` (one shard more) and ``slot``, through a written table."""
    k = stable_key(key)
    placed = materialize(df.drop("slot").withColumn("shard", jump_shard(k, shards))
                           .withColumn("grown_shard", jump_shard(k, shards + 1)), "shards")
    return with_rank(placed, ["shard"], "slot")
