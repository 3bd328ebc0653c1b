"""Per-series rolling statistics with NumPy / pandas inside a Pandas UDF.

Spark re-aggregates a sliding window frame for every row, so a 365-row frame
costs 365 updates per row and percentile sorts the frame per row.  Each
category series here holds one row per observed day (bounded by the calendar),
so a whole series is processed at once inside ``mapInPandas`` over data
hash-partitioned by series and sorted by day; for each series:

* mean and sample deviation: O(n) trailing sums of the centred series in
  extended precision (a constant frame gets deviation exactly 0);
* min / max / quantiles: frames up to ``SORTED_MATRIX_MAX_WINDOW`` rows sort one
  sliding matrix and read every order statistic from it; longer frames use
  pandas' O(n) rolling extrema and O(n log w) skip-list quantiles; quantiles
  interpolate linearly between order statistics;
* lag: values of day ``d - lag`` looked up with ``searchsorted`` on the day
  ordinal; missing days and undefined statistics become 0.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.stats import feature_suffix, quantile_label, stat_name

DAY = "_day"
ALL_KEY = "_series"


# Frames up to this many rows take min, max and all quantiles from one sorted
# sliding matrix (n x w doubles); longer frames use pandas' O(n) rolling extrema
# and O(n log w) skip-list quantiles.  Both give identical order statistics.
SORTED_MATRIX_MAX_WINDOW = 512


def _trailing_sums(v: np.ndarray, w: int) -> np.ndarray:
    """Sum of the trailing ``w`` values (fewer at the head), extended precision."""
    p = np.concatenate([np.zeros(1, dtype=np.longdouble), np.cumsum(v, dtype=np.longdouble)])
    idx = np.arange(1, len(v) + 1)
    return p[idx] - p[np.maximum(idx - w, 0)]


def _mean_std(x: np.ndarray, w: int, lo: np.ndarray | None = None, hi: np.ndarray | None = None):
    """Trailing mean and sample deviation of the values present (NaN = missing) in O(n).

    Sums are centred on the series mean and accumulated in extended precision;
    a frame whose min equals its max has deviation exactly 0; a frame without
    values has neither, one with a single value no deviation.
    """
    there = ~np.isnan(x)
    cnt = _trailing_sums(there.astype(np.longdouble), w)
    c = np.longdouble(x[there].mean()) if there.any() else np.longdouble(0)
    y = np.where(there, x, 0.0).astype(np.longdouble) - np.where(there, c, 0)
    s1 = _trailing_sums(y, w)
    s2 = _trailing_sums(y * y, w)
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(cnt > 0, s1 / cnt + c, np.nan).astype(float)
        var = (s2 - s1 * s1 / cnt) / (cnt - 1)
    var = np.maximum(var.astype(float), 0.0)
    var[cnt < 2] = np.nan
    if lo is not None and hi is not None:
        var[(lo == hi) & (cnt >= 2)] = 0.0
    return mean, np.sqrt(var)


def _sorted_frames(x: np.ndarray, w: int):
    """Every trailing frame sorted (missing values and the padding of head frames sort last), and its number of values."""
    m = np.sort(sliding_window_view(np.concatenate([np.full(w - 1, np.nan), x]), w), axis=1)
    return m, _trailing_sums((~np.isnan(x)).astype(np.longdouble), w).astype(np.int64)


def _quantiles_sorted(x: np.ndarray, w: int, qs: Sequence, sorted_frames=None) -> list[np.ndarray]:
    """All quantiles of the trailing frames from one sorted sliding matrix."""
    m, cnt = sorted_frames if sorted_frames is not None else _sorted_frames(x, w)
    rows = np.arange(len(x))
    out = []
    for q in qs:
        pos = (float(q) / 100) * np.maximum(cnt - 1, 0)
        lo = np.floor(pos).astype(np.int64)
        hi = np.minimum(lo + 1, np.maximum(cnt - 1, 0))
        vlo, vhi = m[rows, lo], m[rows, hi]
        out.append(np.where(pos == lo, vlo, vlo + (vhi - vlo) * (pos - lo)))
    return out


def series_stats(x: np.ndarray, w: int, stats: Sequence[str], quantiles: Sequence) -> dict[str, np.ndarray]:
    """Statistics of the values present in the trailing ``w`` rows, for every position; NaN where there are none."""
    out: dict[str, np.ndarray] = {}
    there = (~np.isnan(x)).astype(np.longdouble)
    if "count" in stats:
        out["count"] = _trailing_sums(there, w).astype(float)
    if w == 1:
        for s in stats:
            out.setdefault(s, np.full(len(x), np.nan) if s == "std" else x.copy())
        for q in quantiles:
            out[quantile_label(q)] = x.copy()
        return out
    if w <= SORTED_MATRIX_MAX_WINDOW:
        frames = _sorted_frames(x, w)
        m, cnt = frames
        lo, hi = m[:, 0], m[np.arange(len(x)), np.maximum(cnt - 1, 0)]
        qvals = _quantiles_sorted(x, w, quantiles, frames) if quantiles else []
    else:
        roll = pd.Series(x).rolling(w, min_periods=1)
        lo, hi = roll.min().to_numpy(), roll.max().to_numpy()
        qvals = [roll.quantile(float(q) / 100, interpolation="linear").to_numpy() for q in quantiles]
    out["min"], out["max"] = lo, hi
    if "mean" in stats or "std" in stats:
        out["mean"], out["std"] = _mean_std(x, w, lo, hi)
    if "sum" in stats:
        out["sum"] = np.where(_trailing_sums(there, w) > 0, _trailing_sums(np.nan_to_num(x), w), np.nan).astype(float)
    for q, v in zip(quantiles, qvals):
        out[quantile_label(q)] = v
    return out


def _roll_one_series(pdf: pd.DataFrame, keys: list[str], value_cols, windows, lag, stats, quantiles,
                     names: list[str]):
    """(key columns, day ordinals, n x len(names) feature block) of one series."""
    days = pdf[DAY].to_numpy(dtype=np.int64)
    if len(days) > 1 and not np.all(days[1:] > days[:-1]):  # arrives sorted; sort otherwise
        pdf = pdf.sort_values(DAY, kind="stable")
        days = pdf[DAY].to_numpy(dtype=np.int64)
    n = len(days)
    src = np.searchsorted(days, days - lag)
    src_c = np.minimum(src, n - 1)
    hit = (src < n) & (days[src_c] == days - lag)
    feats = np.empty((n, len(names)))
    col = {name: i for i, name in enumerate(names)}
    group_cols = [k for k in keys if k != ALL_KEY]
    for w in windows:
        suffix = feature_suffix(group_cols, lag, w)
        for v in value_cols:
            res = series_stats(pdf[v].to_numpy(dtype=float), int(w), stats, quantiles)
            for label in list(stats) + [quantile_label(q) for q in quantiles]:
                moved = np.where(hit, res[label][src_c], 0.0)
                feats[:, col[stat_name(v, label, suffix)]] = np.nan_to_num(moved, nan=0.0)
    return {k: pdf[k].to_numpy() for k in keys}, days, feats


def _ship_by_value() -> None:
    """Pickle this module and the naming helpers by value, so Python workers
    need neither the package installed nor the driver's working directory."""
    import sys

    from pyspark import cloudpickle
    for name in (__name__, "tillroll.functions.stats"):
        cloudpickle.register_pickle_by_value(sys.modules[name])


def rolling_series_features(totals: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                            windows: Sequence[int], lag: int, stats: Sequence[str],
                            quantiles: Sequence, date_col: str = "date") -> DataFrame:
    from tillroll.operators.rolling import rolling_feature_names
    _ship_by_value()
    g = list(group_cols)
    names = rolling_feature_names(g, value_cols, windows, lag, stats, quantiles)
    keys = g if g else [ALL_KEY]
    src = totals.select(*g, F.unix_date(F.col(date_col)).alias(DAY), *value_cols)
    if not g:
        src = src.withColumn(ALL_KEY, F.lit(0))
    key_fields = [src.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField(DAY, T.IntegerType()),
                           *[T.StructField(n, T.DoubleType()) for n in names]])
    vc, wins, qs, st = tuple(value_cols), tuple(int(w) for w in windows), tuple(quantiles), tuple(stats)

    def roll_groups(pdf: pd.DataFrame) -> pd.DataFrame:
        # rows are clustered by series: split at key changes instead of hashing
        change = np.zeros(len(pdf), dtype=bool)
        for k in keys:
            col = pdf[k].to_numpy()
            change[1:] |= col[1:] != col[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), len(pdf)]
        parts = [_roll_one_series(pdf.iloc[a:b], keys, vc, wins, int(lag), st, qs, names)
                 for a, b in zip(bounds[:-1], bounds[1:])]
        res = pd.DataFrame(np.concatenate([p[2] for p in parts]), columns=names)
        res.insert(0, DAY, np.concatenate([p[1] for p in parts]).astype(np.int32))
        for i, k in enumerate(keys):
            res.insert(i, k, np.concatenate([p[0][k] for p in parts]))
        return res

    def fn(batches):
        # rows arrive clustered by series and sorted by day; a series may span two
        # Arrow batches, so the last (possibly incomplete) series is carried over
        carry = None
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            for pdf in batches:
                if carry is not None and len(carry):
                    pdf = pd.concat([carry, pdf], ignore_index=True)
                if pdf.empty:
                    continue
                last = np.ones(len(pdf), dtype=bool)
                for k in keys:
                    col = pdf[k].to_numpy()
                    last &= col == col[-1]
                carry = pdf[last]
                done = pdf[~last]
                if len(done):
                    yield roll_groups(done)
            if carry is not None and len(carry):
                yield roll_groups(carry)

    # hash-partition by series and sort by day: every series is contiguous inside
    # one partition, so whole Arrow batches of many series go through pandas
    # (cheaper than one grouped call per series)
    # The partition count is the session's: the input is small per row, so AQE
    # would otherwise coalesce it into a few partitions and serialise the Python
    # work.  Partitioning on a hash of the key (not the key
    # itself) keeps the optimizer from treating this exchange as redundant with an
    # upstream, coalescable partitioning on the same key.
    n_parts = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    clustered = (src.repartition(n_parts, F.xxhash64(*keys).alias("_series_hash"))
                 .sortWithinPartitions(*keys, DAY))
    rolled = clustered.mapInPandas(fn, schema)
    return rolled.select(F.date_from_unix_date(DAY).alias(date_col), *g, *names)
