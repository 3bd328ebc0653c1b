"""Daily series operators: calendar densify + fill, percent change, neighbour
indicators, time-range rolling, sequential dates.

The oil and holiday series hold one row per calendar day, so they are bounded by
the calendar, not by the data volume.  Their windows may therefore run without a
partition key; each operator also takes ``series_keys`` to run many series in
parallel partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.calendar import (day_name, days_since_15th, days_since_last,
                                         days_since_paycheck, is_weekend)
from tillroll.functions.numeric import pct_change_from
from tillroll.operators.rolling import DAY, day_number

# Percent-change windows counted from today and from the lag.
OIL_WINDOWS_FROM_0 = (1, 2, 4, 7, 14)
OIL_LAG = 16
OIL_WINDOWS_FROM_LAG = (1, 7, 14, 28, 91, 365)


def _w(series_keys: Sequence[str]):
    return Window.partitionBy(*series_keys) if series_keys else Window.partitionBy()


def densify_calendar(df: DataFrame, date_col: str = "date", series_keys: Sequence[str] = ()) -> DataFrame:
    """Every calendar day between the first and last date (per series), right-joined."""
    keys = list(series_keys)
    bounds = df.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    days = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(date_col))
    return days.join(df, [*keys, date_col], "left")


def fill_gaps(df: DataFrame, value_cols: Sequence[str], date_col: str = "date",
              series_keys: Sequence[str] = ()) -> DataFrame:
    """Forward fill, then back fill every remaining leading null."""
    w = _w(series_keys).orderBy(date_col)
    past = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    future = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = df
    for c in value_cols:
        out = out.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(past),
                                           F.first(c, ignorenulls=True).over(future)))
    return out


def clean_oil(oil: DataFrame, value_col: str = "dcoilwtico", date_col: str = "date") -> DataFrame:
    dense = densify_calendar(oil.select(date_col, value_col), date_col)
    return fill_gaps(dense, [value_col], date_col)


def calendar_features(df: DataFrame, date_col: str = "date", fix_month_end: bool = False) -> DataFrame:
    d = F.col(date_col)
    return df.select(
        "*",
        day_name(d).alias("dayOfWeek"),
        is_weekend(d).alias("isWeekend"),
        F.month(d).alias("Month"),
        days_since_15th(d).alias("daysSince15th"),
        days_since_last(d, fix_month_end).alias("daysSinceLast"),
        days_since_paycheck(d, fix_month_end).alias("daysSincePaycheck"))


def pct_change_features(df: DataFrame, value_col: str, periods: dict[str, int],
                        date_col: str = "date", series_keys: Sequence[str] = ()) -> DataFrame:
    """``x / x[t-n] - 1`` over rows ordered by date; missing and 0/0 -> 0, x/0 -> inf."""
    w = _w(series_keys).orderBy(date_col)
    return df.select("*", *[pct_change_from(F.col(value_col), F.lag(value_col, n).over(w)).alias(name)
                            for name, n in periods.items()])


def oil_pct_periods(windows_from_0: Sequence[int] = OIL_WINDOWS_FROM_0, lag: int = OIL_LAG,
                    windows_from_lag: Sequence[int] = OIL_WINDOWS_FROM_LAG) -> dict[str, int]:
    p = {f"oilPrice_PctChange_lag0_window{w}": int(w) for w in windows_from_0}
    p.update({f"oilPrice_PctChange_lag{lag}_window{w}": int(lag) + int(w) for w in windows_from_lag})
    return p


def process_oil(oil: DataFrame, windows_from_0: Sequence[int] = OIL_WINDOWS_FROM_0,
                lag: int = OIL_LAG, windows_from_lag: Sequence[int] = OIL_WINDOWS_FROM_LAG,
                fix_month_end: bool = False) -> DataFrame:
    """Dense, filled oil series with calendar and percent-change features."""
    filled = clean_oil(oil)
    feats = calendar_features(filled, "date", fix_month_end)
    return pct_change_features(feats, "dcoilwtico", oil_pct_periods(windows_from_0, lag, windows_from_lag))


def neighbour_indicators(df: DataFrame, cols: Sequence[str], date_col: str = "date",
                         series_keys: Sequence[str] = ()) -> DataFrame:
    """Indicator of the next / previous 1 and 2 rows; edges are 0; cast to int."""
    w = _w(series_keys).orderBy(date_col)
    shifted = []
    for offset, suffix in ((-1, "1next"), (-2, "2next"), (1, "1before"), (2, "2before")):
        for c in cols:
            moved = F.lead(c, -offset).over(w) if offset < 0 else F.lag(c, offset).over(w)
            shifted.append(F.coalesce(moved.cast("int"), F.lit(0)).alias(f"{c}_{suffix}"))
    return df.select("*", *shifted)


def rolling_time_range(df: DataFrame, value_col: str, days: int = 7,
                       stats: Sequence[str] = ("mean", "std", "min", "max"),
                       date_col: str = "date", group_cols: Sequence[str] = ()) -> DataFrame:
    """Statistics over the time frame (date - days, date] per group (one row per date)."""
    from tillroll.functions.stats import stats_exprs
    w = _w(group_cols).orderBy(DAY).rangeBetween(-(int(days) - 1), 0)
    with_day = df.withColumn(DAY, day_number(date_col))
    return with_day.select(*group_cols, date_col, *stats_exprs(value_col, stats, (), window=w))


def daily_sum(df: DataFrame, value_col: str = "sales", date_col: str = "date",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """Plain (not densified) daily sum per group."""
    return df.groupBy(*group_cols, date_col).agg(F.sum(value_col).alias(value_col))


def assign_ascending_dates(df: DataFrame, order_cols: Sequence[str], date_col: str = "date") -> DataFrame:
    """Row k (in ``order_cols`` order) gets ``min(date) + k`` days.

    A distributed row index: the range-partitioned sort is checkpointed to the
    shared checkpoint folder (fixing partition membership even if executors are
    lost), each row gets its in-partition position from
    ``monotonically_increasing_id`` and its partition's offset from a cumulative
    count over one row per partition (a table bounded by the partition count).
    """
    start = df.agg(F.min(date_col)).scalar()
    # the checkpoint keeps the sorted partitions in order (a Parquet re-read would
    # not); persisting first lets the checkpoint write reuse the sort
    sorted_df = df.orderBy(*order_cols).persist()
    ordered = sorted_df.checkpoint(eager=True)
    sorted_df.unpersist()
    mid = F.monotonically_increasing_id()
    t = (ordered.withColumn("_mid", mid)
         .withColumn("_pid", F.shiftright("_mid", 33))
         .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = t.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    idx = t.join(F.broadcast(offsets), "_pid")
    return (idx.withColumn(date_col, F.date_add(start, (F.col("_off") + F.col("_pos")).cast("int")))
            .select(*df.columns))
