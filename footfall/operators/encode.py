"""Label encoding (E1, E2): distinct values sorted by code point -> 0..m-1.

Codes for any number of columns are fitted in one distributed pass: the
(column, value) pairs are stacked, de-duplicated and numbered with
``global_ordinal``; a column's codes are its ordinals minus the column's
first ordinal.  Applying a small dictionary (checked size) compiles it into a
literal map expression; a large one (e.g. store ids at scale) is applied by a
join, never collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.joins import DEFAULT_BROADCAST_ROWS
from footfall.operators.ordinal import global_ordinal

# Dictionaries up to this many entries are inlined as a map literal (a map
# lookup scans its keys, so only tiny ones); larger ones are joined, broadcast
# when the fitted size (an exact count) is within the broadcast bound.
MAX_INLINE_CODES = 64


@dataclass
class LabelCodes:
    table: DataFrame           # column, value, code
    sizes: dict[str, int]      # distinct values per column (bounded by #columns)

    def codes_for(self, column: str) -> DataFrame:
        return self.table.where(F.col("column") == column).select("value", "code")

    def _inline_maps(self, columns: list[str]) -> dict[str, Column]:
        """Literal maps for small dictionaries, fetched in one job."""
        if not columns:
            return {}
        rows = self.table.where(F.col("column").isin(columns)).collect()  # size checked
        flat: dict[str, list] = {c: [] for c in columns}
        for r in rows:
            flat[r["column"]] += [F.lit(r["value"]), F.lit(r["code"])]
        return {c: (F.create_map(*v) if v else F.create_map().cast("map<string,int>"))
                for c, v in flat.items()}

    def apply(self, df: DataFrame, columns: dict[str, str] | None = None,
              handle_invalid: str = "error") -> DataFrame:
        """Replace/add code columns.  ``columns`` maps source -> output name
        (default: every fitted column, in place).

        ``handle_invalid``: ``"error"`` raises on an unseen value (lazily, via
        ``raise_error`` inside the plan); ``"keep"`` yields null.
        """
        columns = columns or {c: c for c in self.sizes}
        small = [c for c in columns if self.sizes.get(c, 0) <= MAX_INLINE_CODES]
        maps = self._inline_maps(small)
        inline = {}
        for src, dst in columns.items():
            value = F.col(src).cast("string")
            if src in maps:
                code = F.try_element_at(maps[src], value)
                inline[dst] = self._guard(value, code, src, handle_invalid)
            else:
                tag = f"__code_{dst}"
                codes = self.codes_for(src).select(F.col("value").alias(f"{tag}_v"),
                                                   F.col("code").alias(tag))
                if self.sizes.get(src, 0) <= DEFAULT_BROADCAST_ROWS:
                    codes = F.broadcast(codes)
                df = (df.join(codes, value == F.col(f"{tag}_v"), "left")
                        .withColumn(dst, self._guard(value, F.col(tag), src, handle_invalid))
                        .drop(tag, f"{tag}_v"))
        return df.withColumns(inline) if inline else df

    @staticmethod
    def _guard(value: Column, code: Column, name: str, handle_invalid: str) -> Column:
        code = code.cast("int")
        if handle_invalid == "error":
            return F.when(value.isNotNull() & code.isNull(),
                          F.raise_error(F.concat(F.lit(f"unseen label in {name}: "), value))
                          ).otherwise(code).cast("int")
        return code


def fit_label_codes(df: DataFrame, columns: list[str]) -> LabelCodes:
    """E1 fit for ``columns`` of ``df`` in one pass."""
    stacked = (df.select(F.explode(F.array(*[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in columns])).alias("kv"))
                 .select("kv.column", "kv.value")
                 .where(F.col("value").isNotNull())
                 .distinct())
    numbered, _ = global_ordinal(stacked, ["column", "value"])
    firsts = {r["column"]: (r["first"], r["n"]) for r in
              numbered.groupBy("column").agg(F.min("ordinal").alias("first"),
                                             F.count("*").alias("n")).collect()}
    first = (F.create_map(*[x for c, (f, _) in firsts.items() for x in (F.lit(c), F.lit(f))])
             if firsts else F.create_map().cast("map<string,bigint>"))
    table = numbered.select("column", "value",
                            (F.col("ordinal") - F.element_at(first, F.col("column")))
                            .cast("int").alias("code"))
    return LabelCodes(table=table, sizes={c: firsts.get(c, (0, 0))[1] for c in columns})


def label_encode(df: DataFrame, columns: list[str], handle_invalid: str = "error"
                 ) -> DataFrame:
    """Fit on ``df`` and replace ``columns`` by their codes (fit_transform)."""
    return fit_label_codes(df, columns).apply(df, handle_invalid=handle_invalid)
