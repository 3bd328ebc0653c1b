"""Daily sketches of every column: kept once, merged for any range of days.

A day's row holds, per column, exact counts of rows and nulls, a HyperLogLog
sketch of its distinct values and, for numeric columns, a KLL sketch of its
distribution.  Sketches are bounded in size and mergeable, so the profile of any
range reads one small row a day and column and never the fact again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import is_numeric

#: log2 of the registers of the distinct sketches, and the accuracy parameter of the quantile sketches.
LG_CONFIG_K, KLL_K = 14, 400


def distinct_error(lg_config_k: int = LG_CONFIG_K) -> float:
    """Three standard errors of a merged distinct count, as a share of it."""
    return 3 * 1.04 / math.sqrt(2 ** lg_config_k)


def rank_error(k: int = KLL_K) -> float:
    """Rank error of a merged quantile at 99 % confidence, as a share of the rows (2.446 / k ** 0.9433)."""
    return 2.446 / k ** 0.9433


def daily_sketches(df: DataFrame, columns: Sequence[str] | None = None, date_col: str = "date") -> DataFrame:
    """(date, column, n_rows, n_null, distinct, quantiles): a row for each day and column.

    One aggregation: the sketches are built map-side and merged by day, so a day
    that holds most rows is no hot group.  ``quantiles`` is null for other than numeric columns.
    """
    columns = [c for c in (columns or df.columns) if c != date_col]
    kinds = dict(df.dtypes)
    aggs, parts = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        aggs += [F.count(value).alias(f"_n{i}"), F.hll_sketch_agg(value.cast("string"), LG_CONFIG_K).alias(f"_d{i}")]
        quantiles = F.lit(None).cast("binary")
        if is_numeric(kinds[c]):
            aggs.append(F.kll_sketch_agg_double(value.cast("double"), F.lit(KLL_K)).alias(f"_k{i}"))
            quantiles = F.col(f"_k{i}")
        parts.append(F.struct(F.lit(c).alias("column"), F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_n{i}")).alias("n_null"),
                              F.col(f"_d{i}").alias("distinct"), quantiles.alias("quantiles")))
    return df.groupBy(date_col).agg(*aggs).select(date_col, F.inline(F.array(*parts)))


def merged_profile(sketches: DataFrame, start=None, end=None, fractions: Sequence[float] = (0.25, 0.5, 0.75),
                   date_col: str = "date") -> DataFrame:
    """Profile of the days from ``start`` to ``end`` (inclusive) out of stored sketches alone: column, n_rows, n_null,
    n_distinct (within ``distinct_error``) and one column for each fraction (within ``rank_error``; null where there is no value)."""
    days = sketches
    if start is not None:
        days = days.where(F.col(date_col) >= F.lit(str(start)).cast("date"))
    if end is not None:
        days = days.where(F.col(date_col) <= F.lit(str(end)).cast("date"))
    merged = days.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles", F.lit(KLL_K)).alias("_k"))
    filled = F.coalesce(F.kll_sketch_get_n_double("_k"), F.lit(0)) > 0
    names = [f"q{round(100 * f)}" for f in fractions]
    return merged.select("column", "n_rows", "n_null", "n_distinct",
                         *[F.when(filled, F.kll_sketch_get_quantile_double("_k", F.lit(float(f)))).alias(n) for f, n in zip(fractions, names)])
