"""Gaps, repeated rows, heads, top correlates, shared rank passes and daily sketches against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import profile, rolling, sketches

DAY = dt.date(2020, 1, 1)


def frame(spark, n=400, seed=2):
    rng = random.Random(seed)
    rows = [(DAY + dt.timedelta(days=rng.randrange(30)), rng.choice(["a", "b", None]), rng.choice([None, *range(6)]), rng.gauss(0, 1)) for _ in range(n)]
    return spark.createDataFrame(rows, "date date, g string, v int, w double").repartition(3), rows


@pytest.mark.parametrize("calendar", [False, True])
def test_missing_spans(spark, calendar):
    df, rows = frame(spark, 60)
    cal = spark.createDataFrame([(DAY - dt.timedelta(days=2),), (DAY + dt.timedelta(days=40),)], "date date")
    got = {tuple(r) for r in profile.missing_spans(df, ["g"], value_col="v", calendar=cal if calendar else None).collect()}
    want = set()
    for g in ("a", "b", None):
        have = {r[0] for r in rows if r[1] == g and r[2] is not None}
        lo, hi = (DAY - dt.timedelta(days=2), DAY + dt.timedelta(days=40)) if calendar else (min(have), max(have))
        run = []
        for k in range((hi - lo).days + 2):
            day = lo + dt.timedelta(days=k)
            if day <= hi and day not in have:
                run.append(day)
            elif run:
                want.add((g, run[0], run[-1], len(run)))
                run = []
    assert got == want and want


def test_repeated_rows_equal_whole_grouping(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, 1, "x"), (2, 2, None), (2, 2, None), (2, 2, None), (3, 3, "y")]
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(3)
    want = {(1, None, "x", 2), (2, 2, None, 3)}
    assert {tuple(r) for r in profile.repeated_rows(df).collect()} == want == {tuple(r) for r in profile.duplicate_rows(df).collect()}
    assert profile.repeated_rows(df.limit(0)).collect() == []


def test_head_in_a_stated_order(spark):
    df, rows = frame(spark, 50)
    want = sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0], r[1] is None, r[1] or "", r[3]))[:7]
    assert [tuple(r)[:4] for r in profile.head(df, 7, ["v"]).orderBy("row").collect()] == want


def test_scatter_over_the_top_correlates(spark):
    df = frame(spark)[0].selectExpr("*", "v * 2.0 + w * 0.1 AS near", "w * w AS far")
    top = [r["column"] for r in profile.correlations(df, "v", top=1).collect()]
    assert top == ["near"]
    got = sorted(map(tuple, profile.scatter_bins(df, "v", bins=5, top=1).collect()))
    assert got == sorted(map(tuple, profile.scatter_bins(df, "v", ["near"], bins=5).collect()))


def test_several_columns_share_one_rank_pass(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    df, rows = frame(spark)
    written, real = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: written.append(1) or real(self, *a, **k))
    out = rolling.daily_stats(df, ["v", "w"], ["g"], densify=False, nan_quantiles=False)
    assert len(written) == 1
    for r in out.collect():
        for i, c in ((2, "v"), (3, "w")):
            values = [x[i] for x in rows if x[0] == r["date"] and x[1] == r["g"] and x[i] is not None]
            if values and r["g"] is not None:
                assert r[f"{c}_q25_wrt_g"] == pytest.approx(np.quantile(values, .25)) and r[f"{c}_max_wrt_g"] == max(values)


def test_merged_sketches_hold_their_stated_errors(spark, tmp_path):
    n = 60_000
    df = spark.range(n).select(F.expr("date_add(DATE '2020-01-01', CAST(id % 40 AS INT))").alias("date"), F.col("id").alias("key"),
                               (F.col("id") % 977).cast("string").alias("name"), F.when(F.col("id") % 5 > 0, F.col("id") * 0.5).alias("value"),
                               F.lit(None).cast("double").alias("none"))
    sketches.daily_sketches(df).write.parquet(str(tmp_path / "s"))
    kept = spark.read.parquet(str(tmp_path / "s"))
    assert kept.count() == 40 * 4
    got = {r["column"]: r for r in sketches.merged_profile(kept, "2020-01-11", "2020-01-30").collect()}
    part = df.where("date BETWEEN DATE '2020-01-11' AND DATE '2020-01-30'").toPandas()
    assert {c: (r["n_rows"], r["n_null"]) for c, r in got.items()} == {c: (len(part), int(part[c].isna().sum())) for c in got}
    for c in got:
        assert abs(got[c]["n_distinct"] - part[c].nunique()) <= sketches.distinct_error() * part[c].nunique() + 1
    value = np.sort(part["value"].dropna().to_numpy())
    for f, name in ((.25, "q25"), (.5, "q50"), (.75, "q75")):
        assert abs(np.searchsorted(value, got["value"][name]) / len(value) - f) <= sketches.rank_error()
    assert got["name"]["q50"] is None and got["none"]["q50"] is None


def test_columns_of_many_values_are_counted_in_parts_by_value(spark, monkeypatch):
    monkeypatch.setattr(profile, "DISTINCT_BOUND", 10)
    monkeypatch.setattr(profile, "DISTINCT_ROWS", 50)
    rows = [(i % 3, i // 2, None if i % 5 == 0 else i * 0.5, None, str(i % 40)) for i in range(300)] + [(0, 0, float("nan"), None, None)] * 2
    df = spark.createDataFrame(rows, "few int, `a b` int, d double, none string, s string")
    dealt = []
    count = profile._distinct_values
    monkeypatch.setattr(profile, "_distinct_values", lambda v, parts: dealt.append(parts) or count(v, parts))
    got = {r["column"]: (r.dtype, r.n_rows, r.n_null, r.n_distinct) for r in profile.profile_table(df).collect()}
    assert got == {"few": ("int", 302, 0, 3), "a b": ("int", 302, 0, 150), "d": ("double", 302, 60, 241), "none": ("string", 302, 302, 0),
                   "s": ("string", 302, 2, 40)}
    assert dealt == [7, 7, 7]
    assert {r["column"]: r.n_distinct for r in profile.profile_table(df.limit(0)).collect()} == dict.fromkeys(got, 0)


def test_exact_quantiles_rank_only_the_spans_that_hold_them(spark, monkeypatch):
    ranked = []
    ranks = profile._ranks
    monkeypatch.setattr(profile, "_ranks", lambda counted, *a: ranked.append(counted.count()) or ranks(counted, *a))
    rows = [("wide", float(i) - 5000.5) for i in range(10_001)] + [("edge", x) for x in (
        float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 5e-324, -5e-324, 1.7e308)] + [(None, 3.0), ("one", 7.25)]
    df = spark.createDataFrame(rows, "g string, v double")
    fr = [0.0, 0.03, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: r._q for r in profile.exact_grouped_quantiles(df, ["g"], "v", fr).collect()}
    assert got["wide"] == pytest.approx([10_000 * f - 5000.5 for f in fr], abs=1e-9)
    assert got["edge"][0] == float("-inf") and math.isnan(got["edge"][-1]) and got["edge"][3] == 0.0
    assert got[None] == [3.0] * 6 and got["one"] == [7.25] * 6
    assert sum(ranked) < 300  # all 10,012 values before
