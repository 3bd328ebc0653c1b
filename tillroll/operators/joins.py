"""Joins: fact x stores, series x holidays, manifest-driven assembly, EDA merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.series import neighbour_indicators

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC_TYPES or dtype.startswith("decimal")


def main_stores_join(main: DataFrame, stores: DataFrame, key: str = "store_nbr") -> DataFrame:
    """Fact LEFT JOIN store dimension.

    No broadcast hint: the dimension's size is not proven here, so AQE picks a
    broadcast hash join from runtime statistics when the side is small and a
    shuffle join otherwise.
    """
    return main.join(stores, key, "left")


def merge_series_holidays(series: DataFrame, holidays: DataFrame, date_col: str = "date",
                          neighbours: bool = True) -> DataFrame:
    """Daily series LEFT JOIN holiday one-hot; holiday columns filled with 0 and,
    optionally, their values on the next/previous 1 and 2 days added."""
    fill_cols = sorted(c for c in holidays.columns if c != date_col)
    merged = series.join(holidays, date_col, "left").na.fill(0, subset=fill_cols)
    if neighbours:
        merged = neighbour_indicators(merged, fill_cols, date_col)
    return merged


def merge_all(main: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame) -> DataFrame:
    """(fact LEFT JOIN stores) LEFT JOIN (oil LEFT JOIN holidays, filled, neighbours) on date."""
    left = main_stores_join(main, stores)
    daily = merge_series_holidays(oil, holidays)
    return left.join(daily, "date", "left")


def merge_fill(main: DataFrame, other: DataFrame, on: str | Sequence[str] = "date",
               fill_num_nas: int | None = None) -> DataFrame:
    """Left join; optionally fill the *other* table's numeric columns."""
    keys = [on] if isinstance(on, str) else list(on)
    merged = main.join(other, keys, "left")
    if fill_num_nas is not None:
        if not isinstance(fill_num_nas, int):
            raise TypeError("fill_num_nas must be an int")
        num_cols = [c for c, t in other.dtypes if is_numeric(t) and c not in keys]
        merged = merged.na.fill(fill_num_nas, subset=num_cols)
    return merged
