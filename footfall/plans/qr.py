"""The triangular factor of a tall design in one distributed pass.

Each task reduces its Arrow batches to one R factor of the columns; factors are
merged by stacking and reducing again, first within a bounded number of groups
and then on the driver, which receives at most ``GROUPS`` factors of p x p numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import materialize

GROUPS = 256


@dataclass
class Factor:
    r: np.ndarray       # p x p, upper triangular up to signs
    n: int              # rows
    sums: np.ndarray    # what ``design`` adds up beside


# Rows of a packed block, blocks of a file, and the one column of a frame of blocks.
BLOCK_ROWS = 1 << 13
FILE_BLOCKS = 16
PACKED = "packed_rows"
CODEC = "zstd"


def _complete(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles, without the rows that miss one."""
    cols = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    return df.select(*cols).dropna()


def packed_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The complete rows of ``columns`` as written blocks: the number of rows, then their doubles
    column after column, compressed.

    For a fit that reads its rows in many passes: a block needs no conversion.  The blocks
    themselves are compressed, not the file: the blocks of a partition are read at once, by the
    JVM and as one Arrow batch, and so weigh there what they weigh in the file.  A file has few.
    """
    def block(held, n):
        flat = pa.compress(np.vstack(held).T.tobytes(), codec=CODEC, asbytes=True)
        return pd.DataFrame({PACKED: [n.to_bytes(8, "little") + flat]})

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch.to_numpy(dtype=float))
            n += len(batch)
            if n >= BLOCK_ROWS:
                yield block(held, n)
                held, n = [], 0
        if n:
            yield block(held, n)

    return materialize(_complete(df, columns).mapInPandas(pack, f"{PACKED} binary"), "packed",
                       rows_per_file=FILE_BLOCKS)


def triangular_factor(df: DataFrame, columns: list[str], constant: bool = False,
                      design: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
                      sums: int = 0) -> Factor:
    """R of ``columns`` (after a column of ones if ``constant``); rows with a null are skipped.

    ``design`` makes the rows to be reduced from those of ``columns``, as many columns, and
    ``sums`` numbers that are added up over all rows.  ``df`` may be ``packed_rows`` of ``columns``.
    """
    width, p = len(columns), len(columns) + int(constant)
    packed = df.columns == [PACKED]
    out = "task long, n long, r binary, sums binary"

    def unpacked(block):
        n = int.from_bytes(block[:8], "little")
        return np.frombuffer(pa.decompress(block[8:], decompressed_size=8 * n * width, codec=CODEC,
                                           asbytes=True)).reshape(width, n).T

    def arrays(batches):
        for batch in batches:
            if packed:
                yield from map(unpacked, batch[PACKED])
            else:
                yield batch.to_numpy(dtype=float)

    def reduce_rows(batches):
        r, n, total = np.zeros((0, p)), 0, np.zeros(sums)
        for z in arrays(batches):
            n += len(z)
            if constant:
                z = np.column_stack([np.ones(len(z)), z])
            if design:
                z, more = design(z)
                total = total + more
            r = np.linalg.qr(np.vstack([r, z]), mode="r")
        if n:
            yield pd.DataFrame({"task": [TaskContext.get().partitionId()], "n": [n],
                                "r": [r.tobytes()], "sums": [total.tobytes()]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        stack = np.vstack([np.frombuffer(b).reshape(-1, p) for b in group["r"]])
        return pd.DataFrame({"n": [int(group["n"].sum())],
                             "r": [np.linalg.qr(stack, mode="r").tobytes()],
                             "sums": [sum(map(np.frombuffer, group["sums"])).tobytes()]})

    rows = df if packed else _complete(df, columns)
    tasks = rows.mapInPandas(reduce_rows, out)
    merged = tasks.groupBy(F.pmod("task", F.lit(GROUPS)).alias("g")).applyInPandas(
        merge, "n long, r binary, sums binary").collect()
    r, n, total = np.zeros((0, p)), 0, np.zeros(sums)
    for row in merged:
        r = np.linalg.qr(np.vstack([r, np.frombuffer(row["r"]).reshape(-1, p)]), mode="r")
        n += row["n"]
        total = total + np.frombuffer(row["sums"])
    full = np.zeros((p, p))
    full[:len(r)] = r
    return Factor(full, n, total)


def factors_by(df: DataFrame, columns: list[str], key: str, constant: bool = False
               ) -> dict[int, Factor]:
    """The factor of ``columns`` for each value of the integer column ``key``, in one pass.

    Factors merge (``merged``), so those of parts give that of any union of them.
    """
    cols = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    names = [f"x{i}" for i in range(len(columns))]
    p = len(columns) + int(constant)

    def reduce_rows(batches):
        of: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            for k, rows in batch.groupby("key", sort=False):
                z = rows[names].to_numpy(dtype=float)
                if constant:
                    z = np.column_stack([np.ones(len(z)), z])
                r, n = of.get(k, (np.zeros((0, p)), 0))
                of[k] = np.linalg.qr(np.vstack([r, z]), mode="r"), n + len(z)
        task = TaskContext.get().partitionId()
        if of:
            yield pd.DataFrame([(k, task, n, r.tobytes()) for k, (r, n) in of.items()],
                               columns=["key", "task", "n", "r"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        stack = np.vstack([np.frombuffer(b).reshape(-1, p) for b in group["r"]])
        return pd.DataFrame({"key": [group["key"].iloc[0]], "n": [int(group["n"].sum())],
                             "r": [np.linalg.qr(stack, mode="r").tobytes()]})

    tasks = df.select(F.col(key).cast("int").alias("key"), *cols).dropna(
        subset=["key", *names]).mapInPandas(reduce_rows, "key int, task long, n long, r binary")
    out: dict[int, Factor] = {}
    for row in tasks.groupBy("key", F.pmod("task", F.lit(GROUPS)).alias("g")).applyInPandas(
            merge, "key int, n long, r binary").collect():
        part = Factor(np.frombuffer(row["r"]).reshape(-1, p), row["n"], np.zeros(0))
        out[row["key"]] = merged([out[row["key"]], part]) if row["key"] in out else part
    return out


def merged(factors: list[Factor]) -> Factor:
    """The factor of all rows behind ``factors``."""
    r = np.linalg.qr(np.vstack([f.r for f in factors]), mode="r")
    return Factor(r, sum(f.n for f in factors), np.zeros(0))
