"""The four batch jobs end to end on the smallest scale."""

import os

from pyspark.sql import functions as F

from tillroll.plans import process_data, score, train, tune
from tillroll.sources.manifest import load_and_merge_from_manifest, read_manifest


def test_jobs_end_to_end(spark, sf_small, tmp_path):
    out = str(tmp_path / "clean")
    spec = process_data.run(spark, out, sf_dir=sf_small, groups=("family", "type"), windows=(7, 28))
    assert len(spec["rolling_stats"]) == 2
    m = read_manifest(spark, os.path.join(out, "manifest.json"))
    assert m["secondary_data"][0]["merge_cols"] == ["store_nbr"]
    wide = load_and_merge_from_manifest(spark, os.path.join(out, "manifest.json"))
    main = spark.read.parquet(spec["main_data"]["parquet_path"])
    assert wide.count() == main.count()
    assert "sales_q50_wrt_type_lag16_window28" in wide.columns and "is_holiday_event" in wide.columns
    trials_path = str(tmp_path / "trials")
    trials = tune.run(spark, os.path.join(out, "manifest.json"), trials_path, n_trials=1, n_backtests=2,
                      valset_size=16, max_rounds=3)
    assert trials.count() == 1 and trials.first().loss >= 0
    # resumable: a second run appends the next trial id
    trials = tune.run(spark, os.path.join(out, "manifest.json"), trials_path, n_trials=1, n_backtests=2,
                      valset_size=16, max_rounds=3)
    assert sorted(r.trial_id for r in trials.collect()) == [0, 1]
    models = train.run(spark, os.path.join(out, "manifest.json"), trials_path, str(tmp_path / "models"),
                       n_seeds=1, sample_frac=0.5, n_iter=1)
    assert models[0][2] >= 0
    paths = score.run(spark, os.path.join(out, "manifest.json"), str(tmp_path / "models"),
                      str(tmp_path / "subs"), "2001-07-17", "2001-08-01")
    sub = spark.read.option("header", True).csv(paths[0])
    assert sub.columns == ["id", "sales"]
    assert sub.count() == main.where(F.col("is_test") == 1).count()


def test_store_level_rollup_equals_direct_totals(spark, sf_small, tmp_path):
    from tillroll import fixtures
    from tillroll.operators import rolling
    from tillroll.operators.joins import main_stores_join
    main = fixtures.main_view(spark, sf_small)
    stores = fixtures.stores_view(spark, sf_small)
    direct = rolling.daily_totals(main_stores_join(main, stores), ["type"])
    store_daily = main.groupBy("date", "store_nbr").agg(F.sum("sales").alias("sales"))
    rolled = rolling.daily_totals(main_stores_join(store_daily, stores), ["type"])
    a = {(r.date, r.type): r.sales for r in direct.collect()}
    b = {(r.date, r.type): r.sales for r in rolled.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) <= 1e-6 * max(1.0, abs(a[k])) for k in a)


def test_process_job_from_raw_csv(spark, sf_small, tmp_path):
    """The raw-file entry: train / test / stores / oil / holidays CSVs with explicit schemas."""
    from tillroll import fixtures
    from tillroll.sources import files
    raw = tmp_path / "raw"
    main = fixtures.main_view(spark, sf_small)
    cols = ["id", "date", "store_nbr", "family", "sales", "onpromotion"]
    files.write_csv(main.where(F.col("is_train") == 1).select(*cols), str(raw / "train.csv"))
    files.write_csv(main.where(F.col("is_test") == 1).select(*[c for c in cols if c != "sales"]),
                    str(raw / "test.csv"))
    files.write_csv(fixtures.stores_view(spark, sf_small), str(raw / "stores.csv"))
    files.write_csv(fixtures.oil_view(spark, sf_small), str(raw / "oil.csv"))
    files.write_csv(fixtures.holidays_events_view(spark, sf_small), str(raw / "holidays_events.csv"))
    out = str(tmp_path / "clean")
    spec = process_data.run(spark, out, raw_dir=str(raw), groups=("type",), windows=(7,))
    got = spark.read.parquet(spec["main_data"]["parquet_path"])
    assert got.count() == main.count()
    flags = {(r.is_train, r.is_test): r["count"] for r in got.groupBy("is_train", "is_test").count().collect()}
    assert flags == {(1, 0): main.where(F.col("is_train") == 1).count(),
                     (0, 1): main.where(F.col("is_test") == 1).count()}
    assert got.where(F.col("is_test") == 1).where(F.col("log_sales").isNotNull()).count() == 0
    feats = spark.read.parquet(spec["rolling_stats"][0]["parquet_path"])
    assert "log_sales_q95_wrt_type_lag16_window7" in feats.columns and feats.count() > 0
