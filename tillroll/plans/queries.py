"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables through the fixture views, so its work grows
with the data.  Floating outputs are rounded to ``DECIMALS`` for a stable
comparison with the DuckDB oracles in ``oracles.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll import fixtures
from tillroll.operators import boosting as _boosting
from tillroll.operators import clean, rolling
from tillroll.operators import evaluate as _ev
from tillroll.operators import holidays as _hol
from tillroll.operators import joins as _joins
from tillroll.operators import model as _model
from tillroll.operators import profile as _pf
from tillroll.operators import series as _series
from tillroll.operators import sketches as _sk
from tillroll.operators.assemble import assemble_features
from tillroll.session import materialize, scratch_path
from tillroll.sources import catmeta as _cm
from tillroll.sources import files as _files
from tillroll.plans import process_data
from tillroll.plans.common import GROUPS, HOLIDAY_COMBOS, main_df, main_stores, rounded
from tillroll.sources.manifest import lay_out, load_and_merge_from_manifest, load_laid_out, table_spec, write_manifest

Query = Callable[[SparkSession, str], DataFrame]


def q_combine_train_test(spark, sf_dir):
    m = fixtures.main_view(spark, sf_dir)
    train = m.where(F.col("is_train") == 1).drop("is_train", "is_test")
    test = m.where(F.col("is_test") == 1).drop("is_train", "is_test", "sales")
    combined, _, _ = clean.combine_train_test(train, test)
    return combined.select(*m.columns)


def q_log_target(spark, sf_dir):
    return rounded(main_df(spark, sf_dir))


def q_main_stores_join(spark, sf_dir):
    return rounded(main_stores(spark, sf_dir))


def q_stores_clean(spark, sf_dir):
    return clean.process_stores(fixtures.stores_view(spark, sf_dir))


def _daily_totals(group):
    def q(spark, sf_dir):
        g = [group] if group else []
        return rounded(rolling.daily_totals(main_stores(spark, sf_dir), g))
    return q


def _rolling(group, windows):
    def q(spark, sf_dir):
        g = [group] if group else []
        return rounded(rolling.compute_rolling_stats(main_stores(spark, sf_dir), g, windows=windows))
    return q


def registry_core() -> dict[str, Query]:
    q: dict[str, Query] = {
        "combine_train_test": q_combine_train_test,
        "log_target": q_log_target,
        "main_stores_join": q_main_stores_join,
        "stores_clean": q_stores_clean,
        "daily_totals_global": _daily_totals(None),
    }
    for g in GROUPS:
        q[f"daily_totals_{g}"] = _daily_totals(g)
    for g in GROUPS:
        for w in rolling.DEFAULT_WINDOWS:
            q[f"rolling_{g}_w{w}"] = _rolling(g, (w,))
    return q


# --- oil series and calendar ------------------------------------------------------------


def q_oil_fill(spark, sf_dir):
    return rounded(_series.clean_oil(fixtures.oil_view(spark, sf_dir)))


def q_calendar_features(spark, sf_dir):
    return rounded(_series.calendar_features(_series.clean_oil(fixtures.oil_view(spark, sf_dir))))


def q_oil_pct_change(spark, sf_dir):
    filled = _series.clean_oil(fixtures.oil_view(spark, sf_dir))
    return rounded(_series.pct_change_features(filled, "dcoilwtico", _series.oil_pct_periods()))


def q_process_oil(spark, sf_dir):
    return rounded(_series.process_oil(fixtures.oil_view(spark, sf_dir)))


# --- holidays ---------------------------------------------------------------------------

def q_holiday_clean(spark, sf_dir):
    return clean.clean_holidays_events(fixtures.holidays_events_view(spark, sf_dir))


def _onehot(spark, sf_dir):
    return _hol.process_holidays_events(fixtures.holidays_events_view(spark, sf_dir), HOLIDAY_COMBOS)


def q_holiday_onehot(spark, sf_dir):
    return _onehot(spark, sf_dir)


def q_holiday_neighbours(spark, sf_dir):
    oil = _series.clean_oil(fixtures.oil_view(spark, sf_dir))
    hol = _onehot(spark, sf_dir)
    return rounded(_joins.merge_series_holidays(oil, hol))


def q_merge_all(spark, sf_dir):
    oil = _series.process_oil(fixtures.oil_view(spark, sf_dir))
    hol = _onehot(spark, sf_dir)
    return rounded(_joins.merge_all(main_df(spark, sf_dir), fixtures.stores_view(spark, sf_dir), oil, hol))


def q_merge_fill(spark, sf_dir):
    m = main_df(spark, sf_dir).select("date", "sales")
    oil = _series.process_oil(fixtures.oil_view(spark, sf_dir))
    return rounded(_joins.merge_fill(m, oil, "date", fill_num_nas=0))


def registry_series() -> dict[str, Query]:
    return {
        "oil_fill": q_oil_fill,
        "calendar_features": q_calendar_features,
        "oil_pct_change": q_oil_pct_change,
        "process_oil": q_process_oil,
        "holiday_clean": q_holiday_clean,
        "holiday_onehot": q_holiday_onehot,
        "holiday_neighbours": q_holiday_neighbours,
        "merge_all": q_merge_all,
        "merge_fill": q_merge_fill,
    }


# --- sources, sinks, category metadata, assembly ----------------------------------------


CAT_COLUMNS = ["store_nbr", "family", "city", "state", "type", "cluster"]
# An example inclusive date range for the range scan.
RANGE_START, RANGE_END = "1998-01-01", "1998-12-31"


def _scratch(spark, name):
    return scratch_path(spark, f"queries/{name}-{uuid.uuid4().hex}")


def q_scan_csv_raw(spark, sf_dir):
    path = _scratch(spark, "train_csv")
    fact = clean.get_train(fixtures.main_view(spark, sf_dir))
    # written in another column order: the scan goes by the header
    _files.write_csv(fact.select("sales", "family", "date", "store_nbr", "onpromotion", "id"), path)
    return rounded(_files.read_csv(spark, path, "train"))


def q_parquet_roundtrip(spark, sf_dir):
    path = _scratch(spark, "main_parquet")
    _files.save_as_parquet(main_df(spark, sf_dir), path)
    return rounded(_files.load_from_parquet(spark, path))


def q_scan_date_range(spark, sf_dir):
    return rounded(_files.filter_date_range(main_df(spark, sf_dir), RANGE_START, RANGE_END))


def q_category_metadata(spark, sf_dir):
    return _cm.category_metadata(main_stores(spark, sf_dir), CAT_COLUMNS)


def q_category_union(spark, sf_dir):
    metas = [_cm.category_metadata(main_df(spark, sf_dir), ["store_nbr", "family"]),
             _cm.category_metadata(fixtures.stores_view(spark, sf_dir), ["store_nbr", "city", "state",
                                                                        "type", "cluster"])]
    return _cm.categories_by_column(_cm.union_cat_meta(metas))


def q_apply_categories(spark, sf_dir):
    m = main_df(spark, sf_dir)
    known = _cm.category_metadata(clean.get_train(m), ["family", "store_nbr"])
    return rounded(clean.apply_categories(m, known))


def feature_tables(spark, sf_dir):
    """The fact (written once: four branches read it), the secondary and the rolling tables with their keys.

    Doubles are rounded here, where each value stands once, and not in the wide rows that repeat it: no join reads them.
    """
    m = materialize(main_df(spark, sf_dir), "fact")
    stores = fixtures.stores_view(spark, sf_dir)
    ms = _joins.main_stores_join(m, stores)
    secondary = [(stores, ["store_nbr"]),
                 (_series.process_oil(fixtures.oil_view(spark, sf_dir)), ["date"]),
                 (_onehot(spark, sf_dir), ["date"])]
    rolls = [(rolling.compute_rolling_stats(ms, ["family"], windows=(7,), method="window"), ["date", "family"]),
             (rolling.compute_rolling_stats(ms, ["type"], windows=(28,), method="window"), ["date", "type"])]
    return rounded(m), [(rounded(df), keys) for df, keys in secondary], [(rounded(df), keys) for df, keys in rolls]


def q_feature_assembly(spark, sf_dir):
    m, secondary, rolls = feature_tables(spark, sf_dir)
    return assemble_features(m, secondary, rolls, written=True)


#: Buckets of the registered layout.
BUCKETS = 16


def q_bucketed_assembly(spark, sf_dir):
    """The same tables laid out once: the fact meets its largest group of tables bucket by bucket."""
    out = _scratch(spark, "bucketed")
    main, secondary, rolls = feature_tables(spark, sf_dir)
    specs = []
    for k, (df, keys) in enumerate([(main, ()), *secondary, *rolls]):
        _files.save_as_parquet(df, f"{out}/table_{k}")
        specs.append(table_spec(f"table_{k}", f"{out}/table_{k}", None, keys))
    cut = 1 + len(secondary)
    write_manifest(spark, {"main_data": specs[0], "secondary_data": specs[1:cut], "rolling_stats": specs[cut:]}, f"{out}/manifest.json")
    lay_out(spark, f"{out}/manifest.json", f"{out}/laid_out", BUCKETS)
    return load_laid_out(spark, f"{out}/laid_out")


def q_manifest_assembly(spark, sf_dir):
    """The process job's tables for all six groups, read back by their manifest over a date range."""
    out = _scratch(spark, "manifest")
    process_data.run(spark, out, sf_dir=sf_dir, combos=HOLIDAY_COMBOS)
    wide = load_and_merge_from_manifest(spark, f"{out}/manifest.json", start_date=RANGE_START, end_date=RANGE_END)
    return rounded(wide.select(*MANIFEST_COLUMNS, *[c for g in GROUPS for c in manifest_features(g)]))


# One feature of each kind and window from every group's rolling table, beside the joined dimensions.
MANIFEST_COLUMNS = ("id", "date", "store_nbr", "family", "sales", "city", "state", "type", "cluster", "dcoilwtico",
                    "is_holiday_event")


def manifest_features(group):
    return [f"sales_{s}_wrt_{group}_lag16_window{w}" for s, w in
            zip(("mean", "q50", "max", "q95", "min"), rolling.DEFAULT_WINDOWS)]


def registry_sources() -> dict[str, Query]:
    return {
        "scan_csv_raw": q_scan_csv_raw,
        "parquet_roundtrip": q_parquet_roundtrip,
        "scan_date_range": q_scan_date_range,
        "category_metadata": q_category_metadata,
        "category_union": q_category_union,
        "apply_categories": q_apply_categories,
        "feature_assembly": q_feature_assembly,
        "bucketed_assembly": q_bucketed_assembly,
        "manifest_assembly": q_manifest_assembly,
    }


# --- library variants: cross-sectional stats, rolled stats, time-range rolling ---------

def q_daily_stats(spark, sf_dir):
    return rounded(rolling.daily_stats(main_stores(spark, sf_dir), ["sales"], ["family"]))


def q_roll_daily_stats(spark, sf_dir):
    stats = rolling.daily_stats(main_stores(spark, sf_dir), ["sales"], ["family"])
    return rounded(rolling.roll_daily_stats(stats, ["family"], lag=16, window=7))


def q_rolling_7d_global(spark, sf_dir):
    daily = _series.daily_sum(clean.get_train(main_df(spark, sf_dir)))
    return rounded(_series.rolling_time_range(daily, "sales", days=7))


def q_rolling_7d_store(spark, sf_dir):
    daily = _series.daily_sum(clean.get_train(main_df(spark, sf_dir)), group_cols=["store_nbr"])
    return rounded(_series.rolling_time_range(daily, "sales", days=7, group_cols=["store_nbr"]))


def q_ascending_dates(spark, sf_dir):
    return rounded(_series.assign_ascending_dates(main_df(spark, sf_dir), ["id"]))


def registry_variants() -> dict[str, Query]:
    return {
        "daily_stats": q_daily_stats,
        "roll_daily_stats": q_roll_daily_stats,
        "rolling_7d_global": q_rolling_7d_global,
        "rolling_7d_store": q_rolling_7d_store,
        "ascending_dates": q_ascending_dates,
    }


# --- evaluation -------------------------------------------------------------------------


# Folds of the tuning job (8 folds of 16 days) and the predictors
# scored as trials (lagged weekly family statistics of log sales).
TUNE_FOLDS, TUNE_DAYS = 8, 16
PRED_COL = "log_sales_mean_wrt_family_lag16_window7"
CANDIDATES = ("log_sales_mean_wrt_family_lag16_window7", "log_sales_q50_wrt_family_lag16_window7",
              "log_sales_min_wrt_family_lag16_window7", "log_sales_max_wrt_family_lag16_window7")


def scored_frame(spark, sf_dir):
    """Fact with the lagged weekly family features as ready-made predictions.

    Folds, sizes and losses each read this frame, so it is written once to the
    checkpoint folder (as the tuning job persists its assembled frame).
    """
    feats = rolling.compute_rolling_stats(main_stores(spark, sf_dir), ["family"], windows=(7,), method="window")
    return materialize(main_df(spark, sf_dir).join(feats, ["date", "family"], "left"))


def q_split_train_test(spark, sf_dir):
    return rounded(clean.get_train(main_df(spark, sf_dir)))


def q_feature_projection(spark, sf_dir):
    return rounded(clean.get_features(main_stores(spark, sf_dir)))


def q_backtest_folds(spark, sf_dir):
    return _ev.fold_sizes(clean.get_train(main_df(spark, sf_dir)), TUNE_FOLDS, TUNE_DAYS)


def q_rmse_clipped(spark, sf_dir):
    return rounded(_ev.rmse_clipped(clean.get_train(scored_frame(spark, sf_dir)), "log_sales", PRED_COL))


def q_backtest_loss(spark, sf_dir):
    folds = _ev.backtest_predictor(clean.get_train(scored_frame(spark, sf_dir)), "log_sales", PRED_COL,
                                   TUNE_FOLDS, TUNE_DAYS)
    # the fold table has TUNE_FOLDS rows, so an un-partitioned window over it is tiny
    every = Window.partitionBy()
    mean = F.when(F.count_if(F.col("loss").isNull()).over(every) == 0, F.avg("loss").over(every))
    return rounded(folds.withColumn("mean_loss", mean))


def predictor_trials(spark, sf_dir):
    train = clean.get_train(scored_frame(spark, sf_dir))  # written already: nothing to cache
    rows = []
    for i, c in enumerate(CANDIDATES):
        folds = _ev.backtest_predictor(train, "log_sales", c, TUNE_FOLDS, TUNE_DAYS)
        rows.append(_ev.mean_loss(folds).select(F.lit(i).alias("trial_id"), F.lit(c).alias("predictor"),
                                                F.col("mean_loss").alias("loss")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def q_best_trial(spark, sf_dir):
    return rounded(_ev.best_trial(predictor_trials(spark, sf_dir)))


def scored_test(spark, sf_dir):
    """The test rows only, filtered before the join; nothing is written."""
    feats = rolling.compute_rolling_stats(main_stores(spark, sf_dir), ["family"], windows=(7,), method="window")
    return clean.get_test(main_df(spark, sf_dir)).join(feats, ["date", "family"], "left")


def q_submission(spark, sf_dir):
    return rounded(_ev.submission(scored_test(spark, sf_dir), PRED_COL))


# --- profiling --------------------------------------------------------------------------

def q_profile_table(spark, sf_dir):
    return _pf.profile_table(main_df(spark, sf_dir))


def q_histogram(spark, sf_dir):
    return rounded(_pf.histogram(main_df(spark, sf_dir), bins=100))


def q_correlations(spark, sf_dir):
    m = main_df(spark, sf_dir)
    return rounded(_pf.correlations(m, "sales", ["id", "store_nbr", "onpromotion", "log_sales",
                                                 "is_train", "is_test"]))


# Every numeric column but the target.
SCATTER_COLUMNS = ["id", "store_nbr", "onpromotion", "log_sales", "is_train", "is_test"]


def q_scatter_bins(spark, sf_dir):
    return _pf.scatter_bins(main_df(spark, sf_dir), "sales", SCATTER_COLUMNS, bins=50)


def q_distribution_by_category(spark, sf_dir):
    return rounded(_pf.distribution_by_category(main_stores(spark, sf_dir), GROUPS, "sales"))


def q_date_spans(spark, sf_dir):
    return _pf.date_spans(main_df(spark, sf_dir))


def q_duplicate_rows(spark, sf_dir):
    return rounded(_pf.duplicate_rows(main_df(spark, sf_dir)))


def q_repeated_rows(spark, sf_dir):
    """Rows that two scans of the fact share: all of the first, the example range of the second."""
    m = main_df(spark, sf_dir)
    return rounded(_pf.repeated_rows(m.unionByName(_files.filter_date_range(m, RANGE_START, RANGE_END))))


def q_missing_spans(spark, sf_dir):
    """Days on which a store sold nothing of a family, between the pair's first and last training day."""
    return _pf.missing_spans(clean.get_train(main_df(spark, sf_dir)), ["store_nbr", "family"], value_col="sales")


HEAD_ROWS = 20


def q_head_rows(spark, sf_dir):
    return rounded(_pf.head(main_df(spark, sf_dir), HEAD_ROWS, ["date", "store_nbr", "family", "id"]))


SCATTER_TOP = 3


def q_scatter_top_correlates(spark, sf_dir):
    return _pf.scatter_bins(main_df(spark, sf_dir), "sales", bins=50, top=SCATTER_TOP)


def q_columns_by_kind(spark, sf_dir):
    """The training rows' columns told apart by type and name, with their values counted in one pass."""
    train = clean.get_train(main_stores(spark, sf_dir))
    features = clean.get_features(train)
    cats, nums = _model.feature_columns(features)
    kinds = {"category": cats, "number": nums, "target": clean.get_targets(train).columns,
             "numeric type": clean.columns_of_type(features, numeric=True), "other type": clean.columns_of_type(features, numeric=False),
             "flag by prefix": clean.columns_matching(train, prefix="is_"), "sales by part": clean.columns_matching(train, contains="sales"),
             "key by pattern": clean.columns_matching(train, regex="_nbr$|^id$")}
    names = sorted({c for columns in kinds.values() for c in columns})
    counts = train.agg(F.struct(*[F.count(F.col(c)).alias(c) for c in names]).alias("n"))
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column"), F.col("n")[c].alias("n")) for kind, columns in kinds.items() for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def q_sketch_profile(spark, sf_dir):
    """Profile of the example range out of daily sketches alone, beside what holds of the exact one."""
    m = main_df(spark, sf_dir)
    path = _scratch(spark, "sketches")
    _sk.daily_sketches(m).write.parquet(path)
    merged = _sk.merged_profile(spark.read.parquet(path), RANGE_START, RANGE_END)
    exact = _pf.profile_table(_files.filter_date_range(m, RANGE_START, RANGE_END)).select("column", F.col("n_distinct").alias("_exact"))
    off = F.abs(F.col("n_distinct") - F.col("_exact"))
    return merged.join(exact, "column").select("column", "n_rows", "n_null", F.col("_exact").alias("n_distinct"),
                                               (off <= _sk.distinct_error() * F.col("_exact") + 1).alias("within_error"))


def q_daily_stats_two_columns(spark, sf_dir):
    """Two value columns ranked in one pass."""
    return rounded(rolling.daily_stats(main_stores(spark, sf_dir), ["sales", "onpromotion"], ["family"]))


def q_top_categories(spark, sf_dir):
    return _pf.top_categories(main_stores(spark, sf_dir), ["store_nbr", "family", "city", "state", "type",
                                                           "cluster"], top=20)


def registry_eval() -> dict[str, Query]:
    return {
        "split_train_test": q_split_train_test,
        "feature_projection": q_feature_projection,
        "backtest_folds": q_backtest_folds,
        "rmse_clipped": q_rmse_clipped,
        "backtest_loss": q_backtest_loss,
        "best_trial": q_best_trial,
        "submission": q_submission,
        "profile_table": q_profile_table,
        "histogram": q_histogram,
        "correlations": q_correlations,
        "scatter_bins": q_scatter_bins,
        "distribution_by_category": q_distribution_by_category,
        "date_spans": q_date_spans,
        "duplicate_rows": q_duplicate_rows,
        "repeated_rows": q_repeated_rows,
        "missing_spans": q_missing_spans,
        "head_rows": q_head_rows,
        "scatter_top_correlates": q_scatter_top_correlates,
        "columns_by_kind": q_columns_by_kind,
        "sketch_profile": q_sketch_profile,
        "daily_stats_two_columns": q_daily_stats_two_columns,
        "top_categories": q_top_categories,
    }


# --- models, trials and sinks: results with a known answer --------------------------------


# Small-run settings for the driver-run model keys (2 trials,
# 2 folds of 16 days, at most 10 boosting rounds).
SMOKE_TRIALS, SMOKE_FOLDS, SMOKE_DAYS, SMOKE_ITER = 2, 2, 16, 10
GBT_PARAMS = _model.add_constant_hyperparams({"n_estimators": 10, "max_depth": 4, "learning_rate": 0.3,
                                              "subsample": 1.0, "colsample_bytree": 1.0, "max_bin": 32})


def model_frame(spark, sf_dir):
    return main_stores(spark, sf_dir)


def written_frame(spark, sf_dir):
    """The model frame, written once: every fold, sample and pass of a fit reads it."""
    return materialize(model_frame(spark, sf_dir), "model_frame")


def q_sample_fact(spark, sf_dir):
    return rounded(clean.sample_rows(main_df(spark, sf_dir), 0.1, seed=42))


def q_encode_features(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    enc = _model.encode_features(clean.get_train(df), df)
    # only the entries that are not 0: a dense row is as long as the largest domain
    slots = F.aggregate(F.unwrap_udt("features")["values"], F.lit(0.0), lambda s, x: s + x)
    # slot of each category (the domain's size if unknown), and the sum of the whole feature vector
    return enc.select("id", *[F.col(f"{c}__idx").cast("int").alias(f"{c}_slot") for c in sorted(GROUPS)],
                      slots.alias("feature_sum"))


def q_fit_gbt(spark, sf_dir):
    df = written_frame(spark, sf_dir)
    train = clean.get_train(df)
    model, rmse = _model.fit_scored(train, GBT_PARAMS)
    return model.transform(clean.get_test(df)).select(
        "id", F.col("prediction").isNotNull().alias("predicted"), F.lit(rmse < constant_rmse(train)).alias("beats_constant"))


def constant_rmse(train) -> float:
    """RMSE of the best constant predictor."""
    return train.agg(F.stddev_pop("log_sales")).first()[0]


# Two yes/no features, stumps, rounds and step of the cases whose fit SQL can state.
STUMP_ROUNDS, STUMP_STEP, PENALTY = 8, 0.3, 10.0
STUMP_FEATURES = ("odd_store", "weekend")


def stump_rows(spark, sf_dir):
    """Training rows with two yes/no features, and whether they are of the last ``SMOKE_DAYS`` days."""
    train = clean.get_train(main_df(spark, sf_dir)).where(F.col("log_sales").isNotNull())
    last = train.agg(F.max("date")).scalar()
    rows = train.select("log_sales", (F.col("store_nbr") % 2).cast("double").alias("odd_store"),
                        F.dayofweek("date").isin(1, 7).cast("double").alias("weekend"),
                        (F.datediff(last, "date") < SMOKE_DAYS).alias("held_out"))
    # written: a fit and the passes after it read the rows several times
    return VectorAssembler(inputCols=list(STUMP_FEATURES), outputCol="features").transform(materialize(rows, "stump_rows"))


def _stumps(rounds):
    return GBTRegressor(labelCol="log_sales", maxIter=rounds, maxDepth=1, stepSize=STUMP_STEP, maxBins=32, seed=1)


def q_early_stopping(spark, sf_dir):
    """Error on the held-out days after every round, and the round that a patience of 100 keeps."""
    rows = stump_rows(spark, sf_dir)
    model, errors = _boosting.fit_with_patience(_stumps(STUMP_ROUNDS), rows.where("NOT held_out"), rows.where("held_out"), "log_sales", 100)
    found = [(k, e, k == model.getNumTrees) for k, e in enumerate(errors, 1)]
    return rounded(spark.createDataFrame(found, "round int, mse double, kept boolean"))


def q_penalised_leaves(spark, sf_dir):
    """One stump on one feature with an L2 penalty on its leaves: its prediction for every training row."""
    rows = VectorAssembler(inputCols=["odd_store"], outputCol="features").transform(stump_rows(spark, sf_dir).drop("features"))
    model = _boosting.shrink_leaves(_stumps(1).fit(rows), rows, "log_sales", PENALTY)
    return rounded(model.transform(rows).groupBy("odd_store", "prediction").agg(F.count(F.lit(1)).alias("n")), 6)


def q_model_roundtrip(spark, sf_dir):
    df = written_frame(spark, sf_dir)
    model = _model.build_model(df, GBT_PARAMS).fit(clean.get_train(df))
    path = _scratch(spark, "model")
    _model.save_model(model, path)
    loaded = _model.load_model(path)
    test = clean.get_test(df)
    a = model.transform(test).select("id", F.col("prediction").alias("p_fitted"))
    b = loaded.transform(test).select("id", F.col("prediction").alias("p_loaded"))
    return a.join(b, "id").select("id", (F.col("p_fitted") == F.col("p_loaded")).alias("equal"))


def run_trials(spark, frame):
    return _model.tune(clean.get_train(frame), SMOKE_TRIALS, _scratch(spark, "trials"), n_backtests=SMOKE_FOLDS,
                       valset_size=SMOKE_DAYS, space=_model.with_rounds(SMOKE_ITER))


def q_tune(spark, sf_dir):
    rounds = F.get_json_object("params", "$.n_estimators").cast("int")
    return run_trials(spark, written_frame(spark, sf_dir)).select(
        "trial_id", "study", "n_folds", (F.col("loss") > 0).alias("defined_loss"),
        (rounds <= SMOKE_ITER).alias("fitted_rounds_recorded"))


def q_train_best(spark, sf_dir):
    df = written_frame(spark, sf_dir)
    hp = _model.best_params(run_trials(spark, df))
    best = constant_rmse(clean.get_train(df))
    res = _model.train_best(df, hp, n_seeds=1, sample_frac=0.1, n_iter=10)
    return spark.createDataFrame([(s, r < best) for s, _, r in res], "seed int, beats_constant boolean")


# Chunks of the training job, and each one's share of the rows.
CHUNKS, CHUNK_SHARE = 10, 0.1


def q_chunked_boosting(spark, sf_dir):
    df = written_frame(spark, sf_dir)
    best = constant_rmse(clean.get_train(df))
    _, losses = _model.train_chunked(df, GBT_PARAMS, sample_frac=CHUNK_SHARE, n_iter=CHUNKS)
    return spark.createDataFrame([(i, x < best) for i, x in enumerate(losses)], "chunk int, beats_constant boolean")


def q_trials_append(spark, sf_dir):
    trials = predictor_trials(spark, sf_dir).collect()  # a handful of rows, one per candidate
    path = _scratch(spark, "trials_table")
    for t in trials:
        _model.append_trials(spark, [(int(t["trial_id"]), "predictor", t["predictor"], float(t["loss"]), 8)], path)
    return rounded(_model.load_trials(spark, path))


def q_write_submission(spark, sf_dir):
    sub = _ev.submission(scored_test(spark, sf_dir), PRED_COL)
    path = _scratch(spark, "submission_csv")
    _files.write_csv(sub, path)
    return rounded(_files.read_csv(spark, path, "id long, sales double"))


def registry_models() -> dict[str, Query]:
    return {
        "sample_fact": q_sample_fact,
        "encode_features": q_encode_features,
        "fit_gbt": q_fit_gbt,
        "early_stopping": q_early_stopping,
        "penalised_leaves": q_penalised_leaves,
        "model_roundtrip": q_model_roundtrip,
        "tune": q_tune,
        "train_best": q_train_best,
        "chunked_boosting": q_chunked_boosting,
        "trials_append": q_trials_append,
        "write_submission": q_write_submission,
    }


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q.update(registry_core())
    q.update(registry_series())
    q.update(registry_sources())
    q.update(registry_variants())
    q.update(registry_eval())
    q.update(registry_models())
    return q
