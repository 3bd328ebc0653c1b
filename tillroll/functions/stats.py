"""Aggregate builders shared by grouped and windowed statistics.

A statistic list such as ``("mean", "std", "min", "max")`` plus quantiles
``(5, 25, 50, 75, 95)`` becomes named aggregate ``Column`` objects that work
both in ``groupBy().agg`` and ``.over(window)``.  Standard deviation is the
sample deviation; quantiles are exact with linear interpolation.  All requested
quantiles of a column share one ``percentile`` aggregate (one buffer and one sort
per frame instead of one per quantile).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default statistic set and quantiles of the rolling features.
DEFAULT_STATS = ("mean", "std", "min", "max")
DEFAULT_QUANTILES = (5, 25, 50, 75, 95)

_AGGS = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
}


def quantile_label(q) -> str:
    return f"q{q:g}" if isinstance(q, float) else f"q{q}"


def stat_name(col: str, stat: str, suffix: str = "") -> str:
    return f"{col}_{stat}{suffix}"


def quantile_array_name(col: str, suffix: str = "") -> str:
    return f"_{col}_quantiles{suffix}"


def stats_exprs(col: str, stats: Sequence[str] = DEFAULT_STATS,
                quantiles: Sequence = DEFAULT_QUANTILES, window=None,
                suffix: str = "", null_if_any_null: bool = False,
                approx_accuracy: int | None = None) -> list[Column]:
    """Named statistics of ``col``; evaluated over ``window`` when given.

    Quantiles come back as ONE array column (``quantile_array_name``) holding all
    requested quantiles; ``split_quantiles`` turns it into named columns in the
    next projection (so the frame is sorted once, not once per quantile).
    ``null_if_any_null`` makes quantiles null when the group holds a null value
    (NumPy's quantile of an array with NaN is NaN).  ``approx_accuracy`` switches
    grouped quantiles to ``percentile_approx``: a mergeable sketch of bounded size
    (relative rank error 1/accuracy), for groups too large to hold their values
    in one task; the exact default keeps a group's distinct values together.
    """
    c = F.col(col)

    def over(e: Column) -> Column:
        return e.over(window) if window is not None else e

    out = []
    for s in stats:
        out.append(over(_AGGS[s](c)).alias(stat_name(col, s, suffix)))
    if quantiles:
        fractions = [float(q) / 100 for q in quantiles]
        if approx_accuracy is not None:
            arr = over(F.percentile_approx(c, fractions, approx_accuracy).cast("array<double>"))
        else:
            arr = over(F.percentile(c, fractions))
        if null_if_any_null:
            has_null = over(F.count(F.lit(1))) > over(F.count(c))
            arr = F.when(~has_null, arr)
        out.append(arr.alias(quantile_array_name(col, suffix)))
    return out


def split_quantiles(col: str, quantiles: Sequence = DEFAULT_QUANTILES, suffix: str = "") -> list[Column]:
    """Named quantile columns from the array built by ``stats_exprs``."""
    arr = F.col(quantile_array_name(col, suffix))
    return [arr.getItem(i).alias(stat_name(col, quantile_label(q), suffix)) for i, q in enumerate(quantiles)]


def final_stat_columns(col: str, stats: Sequence[str] = DEFAULT_STATS,
                       quantiles: Sequence = DEFAULT_QUANTILES, suffix: str = "") -> list[Column]:
    """Projection after ``stats_exprs``: plain stats by name, quantiles split out."""
    out = [F.col(stat_name(col, s, suffix)) for s in stats]
    if quantiles:
        out += split_quantiles(col, quantiles, suffix)
    return out


def stat_labels(stats: Sequence[str] = DEFAULT_STATS, quantiles: Sequence = DEFAULT_QUANTILES) -> list[str]:
    return list(stats) + [quantile_label(q) for q in quantiles]


def feature_suffix(group_cols: Sequence[str], lag: int | None = None, window: int | None = None) -> str:
    """``_wrt_{groups}`` plus ``_lag{lag}_window{window}`` naming used by feature tables."""
    s = f"_wrt_{'_'.join(group_cols)}" if group_cols else ""
    if lag is not None and window is not None:
        s += f"_lag{lag}_window{window}"
    return s
