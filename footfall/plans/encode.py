"""Mark columns categorical.

In MLlib a categorical feature is an indexed column with nominal attribute
metadata, which tree learners read through ``VectorAssembler``; ``StringIndexer``
provides it.  Its fit gathers each column's distinct values, which are bounded by
the number of categories of these calendar and code columns.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns that the AutoML script turns into factors.
FACTORS = ["dow", "wom", "year", "month", "day", "day_of_week", "holiday_flg",
           "air_genre_name", "air_area_name", *(f"air_genre_name{i}" for i in range(10)),
           *(f"air_area_name{i}" for i in range(10)), "cluster", "large_party"]


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers as text that sorts as the numbers do."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.col(c) if kinds[c] == "string" else F.when(
        F.col(c).isNotNull(), F.format_string("%020.3f", F.col(c).cast("double")))
        for c in columns})


def as_factors(df: DataFrame, columns: list[str], handle_invalid: str = "keep"
               ) -> tuple[DataFrame, StringIndexerModel]:
    """``df`` with ``columns`` as nominal indices (in value order), and the fitted codes.

    No columns, or names that ``df`` lacks, raise ``ValueError``.
    """
    if not columns:
        raise ValueError("as_factors needs at least one column")
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"not in the frame: {', '.join(unknown)}")
    indexer = StringIndexer(inputCols=list(columns), outputCols=[f"__f_{c}" for c in columns],
                            stringOrderType="alphabetAsc", handleInvalid=handle_invalid)
    codes = indexer.fit(_as_text(df.select(*columns), columns))
    return apply_factors(df, codes), codes


def apply_factors(df: DataFrame, codes: StringIndexerModel) -> DataFrame:
    """Replace the columns of ``codes`` by their indices; unseen values get one of their own."""
    columns = codes.getInputCols()
    out = codes.transform(_as_text(df, columns)).drop(*columns)
    return out.withColumnsRenamed({f"__f_{c}": c for c in columns})


def largest_factor(codes: StringIndexerModel) -> int:
    """Categories of the largest factor, with the one for unseen values."""
    return max(map(len, codes.labelsArray)) + 1
