"""Text column builders."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def id_date_text(c) -> Column:
    """third '_'-separated field of a submission id (the ISO date).

    Indexing past the end raises under ANSI mode, as the original did.
    """
    return F.split(_c(c), "_").getItem(2)


def id_store(c) -> Column:
    """the first two '_'-separated fields, i.e. the store id."""
    return F.substring_index(_c(c), "_", 2)


def make_id(store, day) -> Column:
    """store '_' ISO date."""
    return F.concat_ws("_", _c(store), _c(day).cast("string"))


def replace_char(c, old: str, new: str) -> Column:
    """F4 + F6: one-character replacement; a missing value becomes 'nan'."""
    return F.translate(F.coalesce(_c(c).cast("string"), F.lit("nan")), old, new)


def tokens(c, n: int, sep: str = " ") -> list[Column]:
    """the first ``n`` ``sep``-separated tokens, '' past the end.

    The split is written once; codegen shares it between the ``n`` outputs.
    """
    parts = F.split(_c(c), re.escape(sep))
    return [F.coalesce(F.get(parts, i), F.lit("")) for i in range(n)]
