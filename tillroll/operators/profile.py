"""Profiling queries behind the exploratory charts (the drawing is not rebuilt).

Every profile is one or two aggregations; per-column results are produced in
long form by unpivoting with ``stack`` inside the scan's projection, so adding
columns adds rows, not jobs.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.joins import is_numeric
from tillroll.session import materialize


def _stack(cols: Sequence[str], value_type: str = "string") -> str:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {value_type})" for c in cols)
    return f"stack({len(cols)}, {pairs}) AS (column, value)"


# Most distinct values of a column that are counted in the one aggregation of all columns, and rows of a column to a task beyond.
DISTINCT_BOUND, DISTINCT_ROWS = 50_000, 1_000_000


def profile_table(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: dtype, rows, nulls, distinct non-null values.

    One aggregation over the typed columns (no unpivoting, no casts to text):
    exact distinct counts are de-duplicated map-side; ``approx`` uses
    HyperLogLog++ sketches.

    Exact counts keep every value of a column once per task, so sketches first
    tell the columns of few values from the others (the rows are written, several
    passes read them).  A column of many values is dealt out alone by value, in
    as many parts as its rows ask for: what a task holds does not grow with the table.
    """
    name = {i: F.col(f"`{c}`") for i, c in enumerate(df.columns)}
    sketch = {i: F.approx_count_distinct(c) for i, c in name.items()}
    many = {}
    if not approx:
        df = materialize(df, "profiled")
        about = df.agg(F.count(F.lit(1)), *sketch.values()).first()
        parts = -(-about[0] // DISTINCT_ROWS)
        many = {f"_d{i}": _distinct_values(df.select(c.alias("v")), parts) for i, c in name.items()
                if about[i + 1] > DISTINCT_BOUND}
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in name.items():
        aggs.append(F.count_if(c.isNull()).alias(f"_n{i}"))
        if f"_d{i}" not in many:
            aggs.append((sketch[i] if approx else F.count_distinct(c)).alias(f"_d{i}"))
    rows = ", ".join(f"'{c}', '{t}', _n{i}, _d{i}" for i, (c, t) in enumerate(df.dtypes))
    return df.agg(*aggs).withColumns(many) \
        .select("n_rows", F.expr(f"stack({len(df.columns)}, {rows}) AS (column, dtype, n_null, n_distinct)")) \
        .select("column", "dtype", "n_rows", "n_null", "n_distinct")


def _distinct_values(values: DataFrame, parts: int):
    """The number of distinct non-null ``v`` as a scalar, counted in ``parts`` parts by value."""
    dealt = values.where("v IS NOT NULL").repartition(parts, "v")
    return dealt.groupBy("v").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n_distinct")).scalar()


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c, t in df.dtypes if is_numeric(t) and c not in exclude]


def _bucket(value, low, high, bins: int):
    """Equal-width bin of ``value`` (null for null); the maximum falls in the last bin, a constant in the first."""
    width = high - low
    place = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((value - low) / width * bins), F.lit(bins - 1)))
    return F.when(value.isNotNull(), place).cast("int")


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 100) -> DataFrame:
    """Equal-width histogram per numeric column between its min and max (nulls
    excluded; the max falls in the last bin): column, bin, lo, hi, n.

    Two scans and no join with rows: the bounds of all columns are one row, read
    as a scalar subquery; every row is binned where it is, and the bins are
    counted map-side.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    value = {c: F.col(f"`{c}`").cast("double") for c in cols}
    bounds = df.agg(F.struct(*[F.struct(F.min(v).alias("mn"), F.max(v).alias("mx")).alias(f"c{i}")
                               for i, v in enumerate(value.values())]).alias("b"))
    one = bounds.scalar()
    binned = F.array(*[F.struct(F.lit(c).alias("column"), _bucket(v, one[f"c{i}"]["mn"], one[f"c{i}"]["mx"], bins)
                                .alias("bin")) for i, (c, v) in enumerate(value.items())])
    counts = (df.select(F.explode(binned).alias("x")).where("x.bin IS NOT NULL")
              .groupBy("x.column", "x.bin").agg(F.count(F.lit(1)).alias("n")))
    low = F.create_map(*[e for i, c in enumerate(cols) for e in (F.lit(c), one[f"c{i}"])])
    edge = lambda k: F.col("m.mn") + (F.col("m.mx") - F.col("m.mn")) * k / bins
    return counts.withColumn("m", low[F.col("column")]).select(
        "column", "bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"), "n")


def correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                 top: int = 15, precision: int | None = 3) -> DataFrame:
    """Pearson correlation of each numeric column with ``target`` over rows where
    both are present; undefined (constant column) is null and sorts last.
    Ranked by the unrounded |corr| desc, then name; the first ``top`` rows, rounded last."""
    cols = [c for c in (columns if columns is not None else numeric_columns(df)) if c != target]
    y = F.col(target)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        xp, yp = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        corr = F.try_divide(F.covar_samp(xp, yp), F.stddev_samp(xp) * F.stddev_samp(yp))
        aggs.append(corr.alias(f"_c{i}"))
    wide = df.agg(*aggs)
    long = wide.select(F.expr(f"stack({len(cols)}, " + ", ".join(f"'{c}', _c{i}" for i, c in enumerate(cols))
                              + ") AS (column, corr)"))
    w = Window.orderBy(F.abs("corr").desc_nulls_last(), F.col("column"))  # one row per column
    ranked = long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return ranked if precision is None else ranked.withColumn("corr", F.round("corr", precision))


def scatter_bins(df: DataFrame, target: str, columns: Sequence[str] | None = None, bins: int = 50,
                 top: int | None = None) -> DataFrame:
    """2-D binned counts of (column value, target) per column over rows that have
    both: column, x_bin, y_bin, n.  Planned like ``histogram``.

    ``columns`` defaults to all numeric columns but the target.  ``top`` keeps the
    columns that ``correlations`` ranks first, inside the same plan: their names
    are a scalar, and the bins of other columns are null before they are exploded.
    """
    columns = [c for c in (columns if columns is not None else numeric_columns(df)) if c != target]
    y = F.col(f"`{target}`").cast("double")
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    ends = lambda v: (F.min(v).alias("mn"), F.max(v).alias("mx"))
    pair = []
    for i, v in enumerate(value.values()):
        pair.append(F.struct(*ends(F.when(y.isNotNull(), v))).alias(f"x{i}"))
        pair.append(F.struct(*ends(F.when(v.isNotNull(), y))).alias(f"y{i}"))
    one = df.agg(F.struct(*pair).alias("b")).scalar()
    entries = [F.struct(F.lit(c).alias("column"),
                        _bucket(v, one[f"x{i}"]["mn"], one[f"x{i}"]["mx"], bins).alias("x_bin"),
                        _bucket(y, one[f"y{i}"]["mn"], one[f"y{i}"]["mx"], bins).alias("y_bin"))
               for i, (c, v) in enumerate(value.items())]
    if top is not None:
        ranked = correlations(df, target, columns, top, precision=None)
        names = ranked.agg(F.collect_set("column")).scalar()  # at most ``top`` names
        entries = [F.when(F.array_contains(names, F.lit(c)), x) for c, x in zip(value, entries)]
    both = df.select(F.explode(F.array(*entries)).alias("x")).where("x.x_bin IS NOT NULL AND x.y_bin IS NOT NULL")
    return (both.groupBy("x.column", "x.x_bin", "x.y_bin")
            .agg(F.count(F.lit(1)).alias("n")))


def distribution_by_category(df: DataFrame, categories: Sequence[str] | str, target: str,
                             quantiles: Sequence[float] = (0.25, 0.5, 0.75),
                             approx_accuracy: int | None = None) -> DataFrame:
    """Target distribution per value of each category column: column, value (as text), n, mean, min, quartiles, max.

    Count, mean, min and max combine map-side.  Exact quartiles come from
    ``exact_grouped_quantiles`` (a hot category is spread over many tasks);
    ``approx_accuracy`` uses bounded ``percentile_approx`` sketches instead.
    The target and the categories are written first, one row a row: several passes read them.
    """
    cols = [categories] if isinstance(categories, str) else list(categories)
    y = F.col(f"`{target}`")
    rows = materialize(df.where(y.isNotNull()).select(
        y.alias("_y"), *[F.col(f"`{c}`").cast("string").alias(f"_c{i}") for i, c in enumerate(cols)]), "distribution")
    pairs = ", ".join(f"'{c}', _c{i}" for i, c in enumerate(cols))
    present = rows.select("_y", F.expr(f"stack({len(cols)}, {pairs}) AS (column, value)"))
    y, key = F.col("_y"), ["column", "value"]
    out = present.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"), F.min(y).alias("min"), F.max(y).alias("max"))
    if approx_accuracy is not None:
        q = present.groupBy(*key).agg(
            F.percentile_approx(y, list(quantiles), approx_accuracy).cast("array<double>").alias("_q"))
    else:
        q = exact_grouped_quantiles(present, key, "_y", quantiles)
    q = q.select(F.col("column").alias("_c"), F.col("value").alias("_v"), "_q")
    names = [f"q{int(round(p * 100))}" for p in quantiles]
    same = F.col("column").eqNullSafe(F.col("_c")) & F.col("value").eqNullSafe(F.col("_v"))
    return out.join(q, same).select(*key, "n", "mean", "min", "max",
                                    *[F.col("_q").getItem(i).alias(n) for i, n in enumerate(names)])


def date_spans(df: DataFrame, date_col: str = "date") -> DataFrame:
    """First and last date overall, on train rows and on test rows (one pass)."""
    d = F.col(date_col)
    row = df.agg(F.min(d).alias("all_min"), F.max(d).alias("all_max"),
                 F.min(F.when(F.col("is_train") == 1, d)).alias("train_min"),
                 F.max(F.when(F.col("is_train") == 1, d)).alias("train_max"),
                 F.min(F.when(F.col("is_test") == 1, d)).alias("test_min"),
                 F.max(F.when(F.col("is_test") == 1, d)).alias("test_max"))
    return row.select(F.expr("stack(3, 'all', all_min, all_max, 'train', train_min, train_max, "
                             "'test', test_min, test_max) AS (subset, min_date, max_date)"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with their multiplicity ``n``."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > 1)


def repeated_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with their multiplicity ``n``, by fingerprint first.

    A 64-bit print of each row (nulls marked, so that they count) is counted
    map-side; only rows whose print occurs more than once are shuffled whole and
    compared column by column, so equal prints of different rows do no harm.
    """
    marked = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    printed = df.withColumn("_print", F.xxhash64(*marked))
    again = printed.groupBy("_print").count().where("count > 1").select("_print")
    return duplicate_rows(printed.join(again, "_print", "left_semi").drop("_print"))


def missing_spans(df: DataFrame, group_cols: Sequence[str], date_col: str = "date", value_col: str | None = None,
                  calendar: DataFrame | None = None) -> DataFrame:
    """Days without a row (or without a ``value_col``) in each group's series, as spans: group, first, last, n_days.

    Gaps and islands: distinct days of a group in order, each compared with the one
    before.  Spans lie between a group's first and last day; with ``calendar``
    (rows of ``date_col``) between the calendar's.  Days are de-duplicated
    map-side, so a series holds one row a day whatever the size of the fact.
    """
    g = list(group_cols)
    seen = df if value_col is None else df.where(F.col(f"`{value_col}`").isNotNull())
    days = seen.where(F.col(date_col).isNotNull()).select(*g, date_col).distinct()
    if calendar is not None:  # a day before the calendar's first and one past its last close the series
        ends = calendar.agg(F.array(F.date_sub(F.min(date_col), 1), F.date_add(F.max(date_col), 1))).scalar()
        days = days.unionByName(df.select(*g).distinct().select(*g, F.explode(ends).alias(date_col)))
    before = F.lag(date_col).over((Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(date_col))
    gap = days.withColumn("_before", before).where(F.datediff(date_col, "_before") > 1)
    return gap.select(*g, F.date_add("_before", 1).alias("first"), F.date_sub(date_col, 1).alias("last"),
                      (F.datediff(date_col, "_before") - 1).alias("n_days"))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the order of the columns ``order`` (nulls last), with their ``row`` from 1.

    A table has no order of its own, so it is stated; the columns that are left
    break ties, and equal rows are interchangeable.  Each task keeps ``n`` rows.
    """
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in (*order, *(c for c in df.columns if c not in order))]
    first = df.orderBy(*keys).limit(n)  # a top-n per partition, then of those
    return first.withColumn("row", F.row_number().over(Window.orderBy(*keys)))


def top_categories(df: DataFrame, columns: Sequence[str], top: int = 20, buckets: int = 64) -> DataFrame:
    """The ``top`` most frequent non-null values per column (ties by value).

    Two stages, so no column's whole domain meets in one task: a top-``top`` per
    (column, hash bucket of the value), then the final ranking over at most
    ``buckets * top`` candidates per column.  Exact, because the order (count
    desc, value) is total and every global winner wins its own bucket.
    """
    long = df.select(F.expr(_stack(columns))).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = (F.col("n").desc(), F.col("value"))
    local = (counts.withColumn("_b", F.pmod(F.xxhash64("value"), F.lit(buckets)))
             .withColumn("_r", F.row_number().over(Window.partitionBy("column", "_b").orderBy(*order)))
             .where(F.col("_r") <= top).drop("_b", "_r"))
    w = Window.partitionBy("column").orderBy(*order)
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def exact_quantiles_by_column(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                              fractions: Sequence[float]) -> DataFrame:
    """``exact_grouped_quantiles`` of several columns in one pass: the columns are ranked together as (group, column,
    value).  Output: group columns and a map ``_q`` from column to its quantiles."""
    g = list(group_cols)
    rows = materialize(df.select(*dict.fromkeys([*g, *value_cols])), "quantile_rows")
    long = rows.select(*g, F.expr(_stack(value_cols, "DOUBLE")))
    each = exact_grouped_quantiles(long, [*g, "column"], "value", fractions)
    pairs = F.map_from_entries(F.collect_list(F.struct("column", "_q")))  # one entry a column
    return each.groupBy(*g).agg(pairs.alias("_q"))


#: Spans of a power of two in which exact quantiles first count a group's values.
SPANS = 256


def _span(v):
    """The span of a double: ascends with it, ``SPANS`` to a power of two, mirrored below zero; at most 5 million in all."""
    size = F.abs(v)
    of_size = F.floor(F.log(size) * F.lit(SPANS / math.log(2))) + F.lit(2_000_000)  # above 0 for the least double
    return F.when(F.isnan(v), F.lit(5_000_000)).when(size == 0, F.lit(0)).when(
        size == float("inf"), F.signum(v) * F.lit(4_000_000)).otherwise(F.when(v < 0, -of_size).otherwise(of_size)).cast("int")


def _same(left: Sequence[str], right: Sequence[str]):
    """Whether the columns agree one by one, nulls included."""
    return functools.reduce(operator.and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def exact_grouped_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                            fractions: Sequence[float], partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group, with no group held by one task.

    A first pass counts each group's values by spans of size (``_span``), map-side,
    with the least and the greatest of each: a group is as many rows as it has
    spans, whatever its rows.  The counts tell the span of every needed rank; the
    first and the last rank of a span, and all of a span with one value, are known.
    A second pass reads only the spans that hold another needed rank and ranks
    their values (``_ranks``).  So ``df`` is read twice: better a written table.
    The same steps at every size.
    Output: group columns and one ``_q`` array in the order of ``fractions``.
    """
    from tillroll.session import ensure_checkpoint_dir
    g = list(group_cols)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(value_col).cast("double")
    v = df.select(*g, F.when(value == 0, F.lit(0.0)).otherwise(value).alias("_v")).where(F.col("_v").isNotNull())
    v = v.withColumn("_span", _span(F.col("_v")))
    spans = v.groupBy(*g, "_span").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    each = Window.partitionBy(*g)
    placed = spans.withColumn("_n", F.sum("_c").over(each)).withColumn("_before", F.coalesce(
        F.sum("_c").over(each.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    wanted, held = [], F.lit(False)
    for i, p in enumerate(fractions):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        lo = F.floor(pos)
        for upper, rank in ((False, lo), (True, F.least(lo + 1, F.col("_n") - 1))):
            rank = rank - F.col("_before")
            held = held | rank.between(F.lit(0), F.col("_c") - 1)
            wanted.append(F.struct(F.lit(i).alias("i"), F.lit(upper).alias("upper"), (pos - lo).alias("frac"),
                                   rank.alias("rank")))
    picks = placed.where(held).select(*g, "_span", "_c", "_lo", "_hi", F.explode(F.array(*wanted)).alias("w")) \
        .where("w.rank >= 0 AND w.rank < _c").select(*g, "_span", "w.*", F.when(
            (F.col("w.rank") == 0) | (F.col("_lo") == F.col("_hi")), F.col("_lo")).when(
            F.col("w.rank") == F.col("_c") - 1, F.col("_hi")).alias("_v"))
    picks = materialize(picks, "quantile_picks")
    left = picks.where("_v IS NULL")
    keys, other = [*g, "_span"], [f"_k{i}" for i in range(len(g) + 1)]
    sought = materialize(left.select(*[F.col(c).alias(o) for c, o in zip(keys, other)]).distinct(), "quantile_spans")
    counted = v.join(sought, _same(keys, other), "left_semi").groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranks = _ranks(counted, keys, n_parts)
    ranks = ranks.select(*[F.col(c).alias(o) for c, o in zip(keys, other)], F.col("_v").alias("_value"), "_c", "_rank")
    holds = (F.col("_rank") <= F.col("rank")) & (F.col("rank") < F.col("_rank") + F.col("_c"))
    found = picks.where("_v IS NOT NULL").unionByName(left.join(ranks, _same(keys, other) & holds)
                                                      .select(*keys, "i", "upper", "frac", "rank", F.col("_value").alias("_v")))
    per_q = found.groupBy(*g, "i").agg(
        F.max(F.when(~F.col("upper"), F.col("_v"))).alias("vlo"),
        F.max(F.when(F.col("upper"), F.col("_v"))).alias("vhi"),
        F.first("frac").alias("frac"))
    val = F.when(F.col("frac") == 0, F.col("vlo")).otherwise(
        F.col("vlo") + (F.col("vhi") - F.col("vlo")) * F.col("frac"))
    return per_q.groupBy(*g).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("i"), val.alias("v")))), lambda s: s["v"])
        .alias("_q"))


def _ranks(counted: DataFrame, group_cols: Sequence[str], n_parts: int) -> DataFrame:
    """The first rank ``_rank``, from 0, in its group of each value ``_v`` that stands ``_c`` times.

    The values are range-partitioned on (group, value), so a group of many values
    spans many partitions, and checkpointed (fixing partition membership).  A
    value's rank is the sum of the counts before it in its partition plus the
    group's counts in earlier partitions (a table of #partitions x #groups rows).
    """
    g = list(group_cols)
    laid = counted.repartitionByRange(n_parts, *g, "_v").sortWithinPartitions(*g, "_v").persist()
    fixed = laid.checkpoint(eager=True)
    laid.unpersist()
    t = fixed.withColumn("_pid", F.spark_partition_id())
    per_part = t.groupBy(*g, "_pid").agg(F.sum("_c").alias("_in_part"))
    w = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(*g, "_pid", F.coalesce(F.sum("_in_part").over(w), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*g, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = t.withColumn("_before", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    names = [f"_g{i}" for i in range(len(g))]
    off = offsets.select(*[F.col(c).alias(o) for c, o in zip(g, names)], F.col("_pid").alias("_p"), "_off")
    return placed.join(off, (F.col("_pid") == F.col("_p")) & _same(g, names)).select(
        *g, "_v", "_c", (F.col("_off") + F.col("_before")).alias("_rank"))
