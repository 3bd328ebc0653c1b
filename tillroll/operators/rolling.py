"""Densified daily totals and lagged rolling features per group.

Plan shape for one group key ``g`` (e.g. ``family``)::

    fact --partial agg--> Exchange(date, g) --sum--> sums           (pre-aggregated)
    sums.distinct(g) x calendar spine  --semi--> observed dates        (dense grid)
    grid LEFT JOIN sums  ->  Exchange(g) -> Sort(g, day)
      -> Window[rows frames for every window size]                     (one sort)
      -> Window[range frame at -lag days]                              (no new sort)

The grid is bounded by (#categories x #calendar days) no matter how large the fact
table is, and every category's series is at most the calendar length, so the
windowed part never sees a hot key: skew in the fact only reaches the partial
aggregation, which combines map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize, task_slots
from tillroll.functions.stats import (DEFAULT_QUANTILES, DEFAULT_STATS, feature_suffix,
                                      final_stat_columns, quantile_label, stat_labels, stat_name,
                                      stats_exprs)

DAY = "_day"

# Default lag and window sizes of the sales features.
DEFAULT_LAG = 16
DEFAULT_WINDOWS = (1, 7, 28, 91, 365)

# Frames longer than this take their exact quantiles from the series step: Spark's own window frames
# sort the frame again for every row, which costs more than the step even for a frame of one row.
LONG_FRAME = 0

def _series_window(group_cols: Sequence[str]):
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    return w.orderBy(DAY)


def day_number(date_col: str = "date") -> Column:
    """Integer day ordinal; range frames over it count calendar days."""
    return F.unix_date(F.col(date_col))


def dense_grid(keys: DataFrame, group_cols: Sequence[str], date_col: str = "date") -> DataFrame:
    """Every observed date x every non-null category of ``group_cols``.

    ``keys`` holds (date, *group_cols) rows, ideally already aggregated.  The grid
    is built as a per-category calendar spine (``sequence`` between the global
    first and last date, both scalar subqueries) filtered to observed dates with a
    semi join, so no Cartesian join is planned and nothing is collected.
    """
    g = list(group_cols)
    dates = keys.select(date_col).distinct()
    lo = dates.agg(F.min(date_col)).scalar()
    hi = dates.agg(F.max(date_col)).scalar()
    cats = keys.select(*g).dropna().distinct()
    # dealt out by number: a category is a few bytes but becomes a row a day
    cats = cats.repartition(task_slots(keys.sparkSession), *g)
    spine = cats.select(*g, F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias(date_col))
    return spine.join(dates, date_col, "left_semi")


def daily_totals(df: DataFrame, group_cols: Sequence[str] = (), value_col: str = "sales",
                 date_col: str = "date", densify: bool = True,
                 log_col: str | None = "log_sales", materialize_sums: bool = True) -> DataFrame:
    """Daily totals of ``value_col`` per group, densified over observed dates.

    Missing cells and all-null sums become 0 (test rows carry null sales), and
    ``log_col`` = log1p(total).  Output: date, *group_cols, value_col, log_col.

    The grid reads the (date, group) sums four times (dates, categories, first
    and last day); ``materialize_sums`` checkpoints that small aggregate so the
    fact table is scanned and aggregated once.
    """
    g = list(group_cols)
    sums = df.groupBy(date_col, *g).agg(F.sum(value_col).alias(value_col))
    if g and densify:
        if materialize_sums:
            sums = materialize(sums)
        sums = dense_grid(sums, g, date_col).join(sums, [date_col, *g], "left")
    total = F.coalesce(F.col(value_col).cast("double"), F.lit(0.0))
    cols = [F.col(date_col), *[F.col(c) for c in g], total.alias(value_col)]
    if log_col:
        cols.append(F.log1p(total).alias(log_col))
    return sums.select(*cols)


def rolling_feature_names(group_cols: Sequence[str], value_cols: Sequence[str], windows: Sequence[int],
                          lag: int, stats: Sequence[str] = DEFAULT_STATS,
                          quantiles: Sequence = DEFAULT_QUANTILES) -> list[str]:
    names = []
    for w in windows:
        suffix = feature_suffix(group_cols, lag, w)
        for v in value_cols:
            names += [stat_name(v, s, suffix) for s in stat_labels(stats, quantiles)]
    return names


def lagged_rolling_features(totals: DataFrame, group_cols: Sequence[str] = (),
                            value_cols: Sequence[str] = ("sales", "log_sales"),
                            windows: Sequence[int] = DEFAULT_WINDOWS, lag: int = DEFAULT_LAG,
                            stats: Sequence[str] = DEFAULT_STATS,
                            quantiles: Sequence = DEFAULT_QUANTILES,
                            date_col: str = "date", method: str = "auto") -> DataFrame:
    """Rolling statistics over the last ``w`` rows (observed dates), moved ``lag``
    calendar days forward onto the existing (date, group) keys; gaps become 0.

    Window sizes count rows of the dense series, the lag counts calendar days:
    a date whose ``date - lag`` was not observed gets 0, as do the first ``lag``
    days and the (null) deviation of a one-row frame.

    ``method``:

    * ``"window"`` -- Spark window frames.  All window sizes share one
      partition/sort and the lag is a one-day RANGE frame on the same order, so
      there is no join and no extra shuffle.  Spark re-aggregates a sliding frame
      for every row (cost rows x frame), which is fine for short frames.
    * ``"series"`` -- ``mapInPandas`` over series clustered by key (see
      ``series_stats``):
      vectorised NumPy mean / two-pass deviation over sliding views, pandas'
      O(n log w) rolling quantiles and O(n) rolling min / max.  A series holds one
      row per observed day, so a group is bounded by the calendar length, never
      by the fact table's size.
    * ``"auto"`` -- ``"series"`` if a frame is longer than ``LONG_FRAME`` rows and
      quantiles are asked for, ``"window"`` otherwise.  Both skip nulls and give the same values.
    """
    if method == "auto":
        method = "series" if quantiles and max(windows) > LONG_FRAME else "window"
    if method == "series":
        from tillroll.operators.series_stats import rolling_series_features
        return rolling_series_features(totals, group_cols, value_cols, windows, lag, stats,
                                       quantiles, date_col)
    g = list(group_cols)
    base = _series_window(g)
    exprs, finals = [], []
    for w in windows:
        frame = base.rowsBetween(-(int(w) - 1), Window.currentRow)
        suffix = feature_suffix(g, lag, w)
        for v in value_cols:
            exprs += stats_exprs(v, stats, quantiles, window=frame, suffix=suffix)
            finals += final_stat_columns(v, stats, quantiles, suffix)
    rolled = (totals.withColumn(DAY, day_number(date_col)).select(date_col, *g, DAY, *exprs)
              .select(date_col, *g, DAY, *finals))
    names = rolling_feature_names(g, value_cols, windows, lag, stats, quantiles)
    shift = base.rangeBetween(-int(lag), -int(lag))
    shifted = [F.coalesce(F.first(n).over(shift), F.lit(0.0)).alias(n) for n in names]
    return rolled.select(date_col, *g, *shifted)


def compute_rolling_stats(df: DataFrame, group_cols: Sequence[str] = (), value_col: str = "sales",
                          windows: Sequence[int] = DEFAULT_WINDOWS, lag: int = DEFAULT_LAG,
                          stats: Sequence[str] = DEFAULT_STATS,
                          quantiles: Sequence = DEFAULT_QUANTILES, date_col: str = "date",
                          method: str = "auto") -> DataFrame:
    """Totals then lagged rolling features: one feature table per group."""
    totals = daily_totals(df, group_cols, value_col, date_col)
    return lagged_rolling_features(totals, group_cols, (value_col, "log_sales"), windows, lag,
                                   stats, quantiles, date_col, method)


# --- cross-sectional daily statistics and their rolled variant -------------------------

def daily_stats(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (),
                stats: Sequence[str] = DEFAULT_STATS, quantiles: Sequence = DEFAULT_QUANTILES,
                date_col: str = "date", densify: bool = True,
                nan_quantiles: bool = True, approx_accuracy: int | None = None) -> DataFrame:
    """Statistics over the rows of each (date, group); names ``{col}_{stat}_wrt_{groups}``.

    With ``densify`` every observed date x category appears (statistics of an
    empty cell are null).  ``nan_quantiles`` makes a quantile null when the cell
    holds a null value, as NumPy does.  Exact quantiles use the distributed rank
    method of ``profile.exact_grouped_quantiles`` (no cell is held by one task);
    ``approx_accuracy`` uses bounded, mergeable sketches instead.
    """
    g = list(group_cols)
    suffix = feature_suffix(g)
    keys = [date_col, *g]
    if approx_accuracy is not None or not quantiles:
        aggs, finals = [], []
        for v in value_cols:
            aggs += stats_exprs(v, stats, quantiles, suffix=suffix, null_if_any_null=nan_quantiles,
                                approx_accuracy=approx_accuracy)
            finals += final_stat_columns(v, stats, quantiles, suffix)
        out = df.groupBy(*keys).agg(*aggs).select(*keys, *finals)
    else:
        # plain statistics combine map-side; exact quantiles use the distributed
        # rank method, so a hot (date, group) cell is spread over many tasks
        from tillroll.operators.profile import exact_quantiles_by_column
        plain = [e for v in value_cols for e in stats_exprs(v, stats, (), suffix=suffix)]
        counts = [F.count(F.col(v)).alias(f"_nn_{v}") for v in value_cols]
        out = df.groupBy(*keys).agg(*plain, *counts, F.count(F.lit(1)).alias("_rows"))
        qv = exact_quantiles_by_column(df, keys, value_cols, [float(q) / 100 for q in quantiles])
        out = out.join(qv, keys, "left")
        cols = []
        for v in value_cols:
            cols += [F.col(stat_name(v, s_, suffix)) for s_ in stats]
            has_null = F.col("_rows") > F.col(f"_nn_{v}")
            for i, q in enumerate(quantiles):
                val = F.col("_q")[v][i]
                if nan_quantiles:
                    val = F.when(has_null, F.lit(None).cast("double")).otherwise(val)
                cols.append(val.alias(stat_name(v, quantile_label(q), suffix)))
        out = out.select(*keys, *cols)
    if g and densify:
        out = materialize(out)
        out = dense_grid(out, g, date_col).join(out, [date_col, *g], "left")
    names = [stat_name(v, s, suffix) for v in value_cols for s in stat_labels(stats, quantiles)]
    return out.select(date_col, *g, *names)


def roll_daily_stats(stats_df: DataFrame, group_cols: Sequence[str] = (), lag: int = DEFAULT_LAG,
                     window: int = 1, date_col: str = "date") -> DataFrame:
    """Rolling mean of every statistic over ``window`` rows, shifted ``lag`` rows
    within the group; rows whose shifted values are all null are dropped."""
    g = list(group_cols)
    value_cols = [c for c in stats_df.columns if c not in (date_col, *g)]
    w = (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(date_col)
    frame = w.rowsBetween(-(int(window) - 1), Window.currentRow)
    rolled = stats_df.select(date_col, *g, *[F.avg(c).over(frame).alias(c) for c in value_cols])
    suffix = f"_lag{lag}_window{window}"
    shifted = rolled.select(date_col, *g, *[F.lag(c, int(lag)).over(w).alias(c + suffix)
                                             for c in value_cols])
    return shifted.na.drop(how="all", subset=[c + suffix for c in value_cols])
