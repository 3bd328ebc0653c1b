"""Steps whose cost must not grow with a domain, nor their plans with the number of columns."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import model, rolling
from tillroll.plans import common, queries


def stores_frame(spark, stores, rows=600):
    data = [(i, dt.date(2017, 1, 1 + i % 28), i % stores, "A" if i % 3 else "B", float(i % 7), math.log1p(i % stores % 5), 1, 0) for i in range(rows)]
    return spark.createDataFrame(data, "id long, date date, store_nbr long, fam string, x double, log_sales double, is_train int, is_test int")


def test_sum_of_the_encoded_features_reads_no_dense_row(spark, sf_small):
    df = queries.q_encode_features(spark, sf_small)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "unwrap_udt" in plan.lower() or "unwrapudt" in plan.lower()
    enc = model.encode_features(fixtures_train(spark, sf_small), queries.model_frame(spark, sf_small))
    dense = {r.id: float(r.features.toArray().sum()) for r in enc.select("id", "features").collect()}
    assert {r.id: r.feature_sum for r in df.collect()} == pytest.approx(dense)


def fixtures_train(spark, sf_dir):
    return queries.model_frame(spark, sf_dir).where("is_train = 1")


def test_trees_see_one_feature_a_category_column_whatever_its_domain(spark, tmp_path):
    hp = model.add_constant_hyperparams({"n_estimators": 3, "max_depth": 3, "max_bin": 16})
    for stores in (5, 300):  # more categories than bins
        df = stores_frame(spark, stores)
        fitted = model.fit_boosted(df, hp)
        assert fitted.stages[-1].numFeatures == 4  # store, fam, x and its null mark
        new = df.withColumn("store_nbr", F.lit(-1).cast("long"))  # unknown: a slot of its own
        assert fitted.transform(new).where("prediction IS NULL OR isnan(prediction)").count() == 0
        model.save_model(fitted, str(tmp_path / f"m{stores}"))
        again = model.load_model(str(tmp_path / f"m{stores}")).transform(df).select("id", "prediction").collect()
        assert sorted(again) == sorted(fitted.transform(df).select("id", "prediction").collect())
        error = model.clipped_rmse(fitted.transform(df), "log_sales", "prediction")
        assert error < 0.5 * df.agg(F.stddev_pop("log_sales")).first()[0]


def test_rounding_off_ties_equals_the_decimal(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10 ** rng.randrange(-6, 12) for _ in range(3000)]
    values += [k / 8 / 10 ** p + e for k in range(-200, 200) for p in range(6) for e in (0.0, 1e-9, -1e-7)]
    values += [0.0, -0.0, -0.00001, 1e9, -1e9, 123456789.00005, math.nan, math.inf, -math.inf, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (4, 6):
        c = F.col("v")
        special = F.isnan(c) | (F.abs(c) == float("inf"))
        exact = F.round(c.cast(f"decimal(38,{places + 2})"), places).cast("double")
        was = df.select(F.when(special, c).when(F.abs(c) >= common.WHOLE, F.round(c)).otherwise(exact)).collect()
        assert [repr(r[0]) for r in common.rounded(df, places).collect()] == [repr(r[0]) for r in was]


def test_many_rounded_columns_are_one_expression(spark):
    df = spark.range(3).select("id", *[(F.col("id") / (k + 3)).alias(f"c{k}") for k in range(20)])
    out = common.rounded(df)
    assert out.columns == df.columns
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("decimal(38,6)") <= 2


def test_short_frames_with_quantiles_sort_no_window_frames(spark):
    rows = [(dt.date(2017, 1, 1) + dt.timedelta(days=d), s, float((d * 7 + s) % 11)) for d in range(40) for s in range(3)]
    df = spark.createDataFrame(rows, "date date, store_nbr int, sales double")
    for w in (1, 7, 28):
        auto = rolling.compute_rolling_stats(df, ["store_nbr"], windows=(w,))
        assert "percentile" not in auto._jdf.queryExecution().optimizedPlan().toString()
        frames = rolling.compute_rolling_stats(df, ["store_nbr"], windows=(w,), method="window")
        got, want = (sorted(map(tuple, common.rounded(x).collect())) for x in (auto, frames))
        assert got == want


def test_category_domains_are_read_from_the_fact_once(spark, tmp_path):
    """Each value of the domains passes a counter when it is computed."""
    from tillroll.sources import catmeta
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 1)], "x string, y int")
    meta = catmeta.category_metadata(rows.where("x <> 'b'").mapInArrow(count, rows.schema), ["x", "y"])
    for bound in (0, 1, 2000):
        passed.value = 0
        got = catmeta.apply_cat_meta(rows, meta, bound=bound).collect()
        assert sorted(map(tuple, got), key=str) == sorted([("a", 1), (None, None), (None, None), ("c", 1)], key=str)
        assert passed.value == 2


def test_stump_rows_are_computed_once(spark, sf_small):
    plan = queries.stump_rows(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_ranges_given_beforehand_leave_the_rows_computed_once(spark, tmp_path):
    """Each batch of rows passes a counter when it is computed."""
    from tillroll.sources import files
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(len(b))
            yield b

    df = spark.sql("SELECT date_add(DATE '2020-01-01', CAST(id % 10 AS int)) AS date, id FROM range(0, 500, 1, 4)")
    ranges = files.equal_ranges(df, "date", 3)
    files.save_as_parquet(df.mapInPandas(count, df.schema), str(tmp_path / "t"), cluster_by="date", ranges=ranges, parts=3)
    assert passed.value == 500
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.columns == ["date", "id"] and sorted(stored.collect()) == sorted(df.collect())
    spans = stored.groupBy(F.input_file_name().alias("f")).agg(F.min("date").alias("lo"), F.max("date").alias("hi")).orderBy("lo").collect()
    assert len(spans) == 3 and all(a.hi < b.lo for a, b in zip(spans, spans[1:]))
