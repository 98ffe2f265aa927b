"""Helpers shared by the operators: tables, lineage cuts, ranks and words."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.session import ensure_checkpoint_dir

# A null id takes part as if it were greater than every other id.
LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()``, survives lost executors, and keeps
    column pruning for the readers.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir().rstrip("/")
    path = f"{root}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_order(col: str | Column) -> Column:
    """Ids as they are compared: a null counts as the greatest."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("long"), F.lit(LAST_ID))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_rank(df: DataFrame, keys: Sequence[str], name: str, block_rows: int = 1 << 16
              ) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... without gaps within each group of ``keys``.

    ``df`` must be read from a written table, so that its row order is fixed.
    A group is numbered in blocks of at most ``block_rows`` rows of one input
    split; only the block counts meet per group.  No group, however large,
    is sorted in one task.
    """
    keys = list(keys)
    row, block, inside = (free_name(df, n) for n in ("row_no", "block_no", "row_in_block"))
    rows = (df.drop(name).withColumn(row, F.monotonically_increasing_id())
              .withColumn(block, F.floor(F.col(row) / block_rows)))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    key_names = [free_name(df, f"key_{i}_of_block") for i in range(len(keys))]
    count, other, total = (free_name(df, n) for n in ("rows_of_block", "block_of", "rows_before"))
    offsets = (rows.groupBy(*keys, block).agg(F.count(F.lit(1)).alias(count))
                   .select(*[F.col(k).alias(n) for k, n in zip(keys, key_names)],
                           F.col(block).alias(other),
                           F.coalesce(F.sum(count).over(before), F.lit(0)).alias(total)))
    within = Window.partitionBy(*keys, block).orderBy(row)
    ranked = rows.withColumn(inside, F.row_number().over(within) - 1)
    cond = F.col(block) == F.col(other)
    for k, n in zip(keys, key_names):
        cond = cond & F.col(k).eqNullSafe(F.col(n))
    return (ranked.join(offsets, cond)
                  .withColumn(name, F.col(total) + F.col(inside))
                  .select(*[c for c in df.columns if c != name], name))


# --- words inside Python tasks -------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs without U+0020 and U+0009 to U+000D, as UTF-8.

    ``bytes.split()`` splits at exactly these six characters.
    """
    return text.encode("utf-8", "replace").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two independent 64-bit hashes for each word, shape (n, 2)."""
    if not words:
        return np.zeros((0, 2), np.uint64)
    digests = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.frombuffer(digests, dtype="<u8").reshape(-1, 2)


_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)   # odd multipliers, one per lane
_powers: list[tuple[np.ndarray, np.ndarray]] = [
    (np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in _ODD]


def _power_tables(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a lane's multiplier and of its inverse modulo 2^64."""
    up, down = _powers[lane]
    if len(up) < n:
        n = max(n, 2 * len(up), 4096)
        base, inverse = _ODD[lane], pow(_ODD[lane], -1, 1 << 64)
        factors = np.ones(n, np.uint64)
        factors[1:] = base
        up = np.cumprod(factors)
        factors[1:] = inverse
        down = np.cumprod(factors)
        _powers[lane] = (up, down)
    return up, down


def window_hashes(hashes: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` consecutive words."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(lane, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes[:, lane] * up[:n], out=sums[1:])
    return mix((sums[size:] - sums[:n - size + 1]) * down[:n - size + 1])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64-bit result (murmur3 finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def minimisers(keys: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least key of every ``width`` neighbouring keys (leftmost on ties).

    They depend on content alone, so equal stretches select equal positions.
    A text with fewer keys than ``width`` selects none.
    """
    if len(keys) < width:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(keys, width)
    step = 1 << 16
    found = [np.unique(view[i:i + step].argmin(axis=1) + np.arange(i, min(i + step, len(view))))
             for i in range(0, len(view), step)]
    return np.unique(np.concatenate(found))
