"""Unit tests on tiny frames: golden values and the workload's value-changing rules."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tillroll.functions.calendar import days_since_15th, days_since_last, days_since_paycheck
from tillroll.operators import clean, evaluate, holidays, joins, rolling, series

D = dt.date


def test_calendar_goldens(spark):
    # (date, since15th, sinceLast, sincePaycheck), penultimate-day quirk included
    gold = [(D(2017, 8, 9), 25, 9, 9), (D(2017, 8, 14), 30, 14, 14), (D(2017, 8, 15), 0, 15, 0),
            (D(2017, 8, 29), 14, 29, 14), (D(2017, 8, 30), 15, 0, 0), (D(2017, 8, 31), 16, 31, 16),
            (D(2017, 9, 1), 17, 1, 1), (D(2017, 2, 27), 12, 0, 0), (D(2017, 2, 28), 13, 28, 13),
            (D(2016, 2, 28), 13, 0, 0), (D(2016, 2, 29), 14, 29, 14), (D(2017, 3, 1), 14, 1, 1)]
    df = spark.createDataFrame([(g[0],) for g in gold], "date date")
    got = df.select("date", days_since_15th("date").alias("a"), days_since_last("date").alias("b"),
                    days_since_paycheck("date").alias("c")).collect()
    assert sorted((r.date, r.a, r.b, r.c) for r in got) == sorted(gold)


def test_calendar_fixed_month_end(spark):
    df = spark.createDataFrame([(D(2017, 8, 31),), (D(2017, 8, 30),)], "date date")
    got = {r.date: r.v for r in df.select("date", days_since_last("date", True).alias("v")).collect()}
    assert got == {D(2017, 8, 31): 0, D(2017, 8, 30): 30}


def _main(spark, rows):
    return spark.createDataFrame(rows, "date date, g string, sales double")


def test_densify_and_lagged_rolling_golden(spark):
    m = _main(spark, [(D(2017, 1, 1), "a", 1.0), (D(2017, 1, 1), "b", 2.0), (D(2017, 1, 3), "a", None)])
    totals = rolling.daily_totals(m, ["g"])
    got = sorted((r.date, r.g, r.sales) for r in totals.collect())
    # absent cells and all-null sums are 0; no 01-02 row (only observed dates)
    assert got == [(D(2017, 1, 1), "a", 1.0), (D(2017, 1, 1), "b", 2.0),
                   (D(2017, 1, 3), "a", 0.0), (D(2017, 1, 3), "b", 0.0)]
    for method in ("window", "series"):
        r = rolling.lagged_rolling_features(totals, ["g"], ["sales"], windows=[2], lag=0, quantiles=(),
                                            method=method)
        vals = {(x.date, x.g): (x["sales_mean_wrt_g_lag0_window2"], x["sales_std_wrt_g_lag0_window2"])
                for x in r.collect()}
        assert vals[(D(2017, 1, 1), "a")] == (1.0, 0.0)  # std of one row is undefined -> 0
        assert vals[(D(2017, 1, 3), "a")][0] == pytest.approx(0.5)
        assert vals[(D(2017, 1, 3), "a")][1] == pytest.approx(0.707107, abs=1e-6)
        assert vals[(D(2017, 1, 3), "b")][1] == pytest.approx(1.414214, abs=1e-6)


def test_lag_is_calendar_days_and_fills_zero(spark):
    # observed dates 1, 2, 4; lag 2: day 4 reads day 2, day 2 has no day 0 -> 0, day 1 -> 0
    m = _main(spark, [(D(2017, 1, 1), "a", 1.0), (D(2017, 1, 2), "a", 3.0), (D(2017, 1, 4), "a", 5.0)])
    totals = rolling.daily_totals(m, ["g"])
    for method in ("window", "series"):
        r = rolling.lagged_rolling_features(totals, ["g"], ["sales"], windows=[2], lag=2, quantiles=(),
                                            method=method)
        got = {x.date: x["sales_mean_wrt_g_lag2_window2"] for x in r.collect()}
        assert got == {D(2017, 1, 1): 0.0, D(2017, 1, 2): 0.0, D(2017, 1, 4): 2.0}


def test_window_and_series_methods_agree(spark):
    import random
    rnd = random.Random(7)
    rows = [(D(2017, 1, 1) + dt.timedelta(days=d), g, round(rnd.uniform(0, 100), 2))
            for d in range(60) if d % 9 != 4 for g in "abc" if rnd.random() > 0.2]
    totals = rolling.daily_totals(_main(spark, rows), ["g"])
    a = rolling.lagged_rolling_features(totals, ["g"], windows=[1, 5, 20], lag=3, method="window")
    b = rolling.lagged_rolling_features(totals, ["g"], windows=[1, 5, 20], lag=3, method="series")
    ra = {(r.date, r.g): r for r in a.collect()}
    rb = {(r.date, r.g): r for r in b.collect()}
    assert ra.keys() == rb.keys()
    for k in ra:
        for c in a.columns[2:]:
            assert ra[k][c] == pytest.approx(rb[k][c], rel=1e-9, abs=1e-9), (k, c)


def test_both_rolling_methods_skip_nulls(spark):
    rows = [(D(2017, 1, 1) + dt.timedelta(days=k), "a", v) for k, v in enumerate((1.0, None, 2.0, 4.0, None, None, None, 5.0))]
    totals = spark.createDataFrame(rows, "date date, g string, sales double")
    for w in (1, 2, 3, 600):
        both = [[tuple(r) for r in rolling.lagged_rolling_features(
            totals, ["g"], ["sales"], [w], lag=0, stats=("mean", "std", "min", "max", "sum", "count"), quantiles=(25, 50),
            method=m).orderBy("date").collect()] for m in ("window", "series")]
        for a, b in zip(*both):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-9), w
    means = [r.sales_mean_wrt_g_lag0_window2 for r in rolling.lagged_rolling_features(
        totals, ["g"], ["sales"], [2], lag=0, method="series").orderBy("date").collect()]
    assert means[:3] == [1.0, 1.0, 2.0]


def test_rolling_mean_skips_null(spark):
    df = spark.createDataFrame([(D(2017, 1, 1), 1.0), (D(2017, 1, 2), None), (D(2017, 1, 3), 2.0)],
                               "date date, v double")
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("date").rowsBetween(-1, 0)
    got = [r.m for r in df.select("date", F.avg("v").over(w).alias("m")).orderBy("date").collect()]
    assert got == [1.0, 1.0, 2.0]


def test_pct_change_edge_cases(spark):
    df = spark.createDataFrame([(D(2017, 1, i + 1), v) for i, v in enumerate([0.0, 1.0, 0.0, 0.0])],
                               "date date, x double")
    got = [r.p for r in series.pct_change_features(df, "x", {"p": 1}).orderBy("date").collect()]
    assert got[0] == 0.0 and math.isinf(got[1]) and got[1] > 0 and got[2] == -1.0 and got[3] == 0.0


def test_oil_fill_forward_then_all_leading_back(spark):
    df = spark.createDataFrame([(D(2017, 1, 1), None), (D(2017, 1, 2), None), (D(2017, 1, 3), 5.0),
                                (D(2017, 1, 6), 7.0)], "date date, dcoilwtico double")
    got = [(r.date, r.dcoilwtico) for r in series.clean_oil(df).orderBy("date").collect()]
    assert got == [(D(2017, 1, 1), 5.0), (D(2017, 1, 2), 5.0), (D(2017, 1, 3), 5.0), (D(2017, 1, 4), 5.0),
                   (D(2017, 1, 5), 5.0), (D(2017, 1, 6), 7.0)]


def test_holiday_onehot_clip_and_transfer(spark):
    h = spark.createDataFrame([
        (D(2017, 12, 8), "Holiday", "Local", "Loja", "x", False),
        (D(2017, 12, 8), "Transfer", "Local", "Quito", "x", True),   # transfer counts as holiday
        (D(2017, 12, 8), "Holiday", "Local", "Quito", "y", False),   # same combo twice -> still 1
        (D(2017, 12, 22), "Additional", "National", "Ecuador", "z", False)],
        "date date, type string, locale string, locale_name string, description string, transferred boolean")
    out = holidays.process_holidays_events(h)
    rows = {r.date: r.asDict() for r in out.collect()}
    d8 = rows[D(2017, 12, 8)]
    assert d8["combo_('Local', 'Loja', 'Holiday')"] == 1 and d8["combo_('Local', 'Quito', 'Holiday')"] == 1
    assert d8["combo_('National', 'Ecuador', 'Additional')"] == 0 and d8["is_holiday_event"] == 1
    assert len([c for c in out.columns if c.startswith("combo_")]) == 3


def test_assembly_keeps_holiday_nulls_merge_all_fills(spark):
    from tillroll.operators.assemble import assemble_features
    main = spark.createDataFrame([(1, D(2017, 1, 1), 1), (2, D(2017, 1, 2), 1)], "id int, date date, store_nbr int")
    stores = spark.createDataFrame([(1, "Q")], "store_nbr int, city string")
    hol = spark.createDataFrame([(D(2017, 1, 1), 1, 1)], "date date, c int, is_holiday_event int")
    oil = spark.createDataFrame([(D(2017, 1, 1), 1.0), (D(2017, 1, 2), 2.0)], "date date, dcoilwtico double")
    a = {r.id: r for r in assemble_features(main, [(stores, ["store_nbr"]), (hol, ["date"])]).collect()}
    assert a[2].c is None and a[1].c == 1
    m = {r.id: r for r in joins.merge_all(main, stores, oil, hol).collect()}
    assert m[2].c == 0 and m[2].c_1before == 1 and m[1].c_1next == 0


def test_unmatched_left_join_rows(spark):
    main = spark.createDataFrame([(1, 1), (2, 99)], "id int, store_nbr int")
    stores = spark.createDataFrame([(1, "Q")], "store_nbr int, city string")
    got = {r.id: r.city for r in joins.main_stores_join(main, stores).collect()}
    assert got == {1: "Q", 2: None}


def test_fold_boundary_and_empty_train(spark):
    # last date = day 10; fold 0 of 3 days: val (7, 10], train < 7, day 7 in neither
    rows = [(D(2017, 1, d), 1.0, 1.0) for d in range(5, 11)]
    df = spark.createDataFrame(rows, "date date, log_sales double, pred double")
    sizes = {r.fold: (r.n_train, r.n_val) for r in evaluate.fold_sizes(df, 2, 3).collect()}
    assert sizes[0] == (2, 3)          # train days 5, 6; val 8, 9, 10
    assert sizes[1] == (0, 3)          # train < day 4: empty
    losses = {r.fold: r.loss for r in evaluate.backtest_predictor(df, "log_sales", "pred", 2, 3).collect()}
    assert losses[1] == 0.0 and losses[0] == 0.0


def test_rmse_clips_predictions_submission_does_not(spark):
    df = spark.createDataFrame([(1, 1.0, -1.0)], "id long, y double, p double")
    assert evaluate.rmse_clipped(df, "y", "p").first().rmse == pytest.approx(1.0)
    assert evaluate.submission(df, "p").first().sales == pytest.approx(math.expm1(-1.0))


def test_daily_stats_quantile_null_with_null_member(spark):
    m = _main(spark, [(D(2017, 1, 1), "a", 1.0), (D(2017, 1, 1), "a", None), (D(2017, 1, 1), "b", 3.0)])
    got = {r.g: r for r in rolling.daily_stats(m, ["sales"], ["g"], quantiles=(50,)).collect()}
    assert got["a"]["sales_q50_wrt_g"] is None and got["a"]["sales_mean_wrt_g"] == 1.0
    assert got["b"]["sales_q50_wrt_g"] == 3.0


def test_combine_train_test_flags(spark):
    train = spark.createDataFrame([(1, 2.0)], "id long, sales double")
    test = spark.createDataFrame([(2,)], "id long")
    for disjoint in (True, False):
        main, _, _ = clean.combine_train_test(train, test, disjoint_ids=disjoint)
        got = {r.id: (r.sales, r.is_train, r.is_test) for r in main.collect()}
        assert got == {1: (2.0, 1, 0), 2: (None, 0, 1)}


def test_ascending_dates(spark):
    df = spark.createDataFrame([(i, D(2017, 1, 5)) for i in (5, 3, 9, 1)], "id int, date date").repartition(3)
    got = sorted((r.id, r.date) for r in series.assign_ascending_dates(df, ["id"]).collect())
    assert got == [(1, D(2017, 1, 5)), (3, D(2017, 1, 6)), (5, D(2017, 1, 7)), (9, D(2017, 1, 8))]


def test_series_path_with_series_split_across_batches(spark):
    import random
    rnd = random.Random(11)
    rows = [(D(2017, 1, 1) + dt.timedelta(days=d), g, round(rnd.uniform(0, 50), 2))
            for d in range(40) for g in "abcd" if rnd.random() > 0.1]
    totals = rolling.daily_totals(_main(spark, rows), ["g"])
    expected = {(r.date, r.g): r for r in
                rolling.lagged_rolling_features(totals, ["g"], windows=[3, 10], lag=2, method="window").collect()}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        got = rolling.lagged_rolling_features(totals, ["g"], windows=[3, 10], lag=2, method="series").collect()
    finally:
        spark.conf.set(key, old)
    assert len(got) == len(expected)
    for r in got:
        e = expected[(r.date, r.g)]
        for c in r.asDict():
            if c not in ("date", "g"):
                assert r[c] == pytest.approx(e[c], rel=1e-9, abs=1e-9), (r.date, r.g, c)


def test_column_selection_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3)], "id int, combo_x string, sales_lag16_window365 double, n long")
    assert clean.columns_matching(df, contains="lag16_window365") == ["sales_lag16_window365"]
    assert clean.columns_matching(df, prefix="combo_") == ["combo_x"]
    assert clean.columns_of_type(df, numeric=True) == ["id", "sales_lag16_window365", "n"]


def test_approx_quantiles_are_bounded_and_close(spark):
    from tillroll.operators import profile
    rows = [(D(2017, 1, 1), "hot" if i % 3 else "cold", float(i)) for i in range(3000)]
    m = _main(spark, rows)
    exact = {r.g: r for r in rolling.daily_stats(m, ["sales"], ["g"], quantiles=(50,)).collect()}
    approx = {r.g: r for r in rolling.daily_stats(m, ["sales"], ["g"], quantiles=(50,),
                                                  approx_accuracy=10000).collect()}
    for g in ("hot", "cold"):
        assert abs(exact[g]["sales_q50_wrt_g"] - approx[g]["sales_q50_wrt_g"]) <= 3.0
    d = {r.value: r for r in profile.distribution_by_category(m, "g", "sales", approx_accuracy=10000).collect()}
    assert d["hot"].n == 2000 and abs(d["hot"].q50 - 1500) <= 3.0


def test_exact_grouped_quantiles_spread_hot_group(spark):
    import random
    from tillroll.operators import profile
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice("abc"), float(rnd.randint(0, 500))) for _ in range(3000)]
    rows.append(("solo", 7.0))
    df = spark.createDataFrame(rows, "g string, v double")
    fr = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r.g: r._q for r in profile.exact_grouped_quantiles(df, ["g"], "v", fr, partitions=7).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", fr).alias("q")).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k


def test_assembly_joins_tables_of_any_size_behind_their_keys(spark):
    main = spark.createDataFrame([(1, D(2017, 1, 1), 5), (2, D(2017, 1, 2), 6)], "id long, date date, store_nbr long")
    stores = spark.createDataFrame([(5, "Quito"), (6, "Loja")], "store_nbr long, city string")
    city = spark.range(200_000).selectExpr("date_add(date'2017-01-01', cast(id div 2 as int)) as date",
                                           "if(id % 2 = 0, 'Quito', 'Loja') as city", "id as feature")
    from tillroll.operators.assemble import assemble_features
    out = assemble_features(main, [(stores, ["store_nbr"])], [(city, ["date", "city"])])
    assert out.columns == ["id", "date", "store_nbr", "city", "feature"]
    assert sorted((r.id, r.feature) for r in out.collect()) == [(1, 0), (2, 3)]


def test_category_domains_of_any_size_apply_alike(spark):
    from tillroll.sources.catmeta import apply_cat_meta
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "id int, c string, d string")
    meta = spark.createDataFrame([("c", "a"), ("c", "a"), ("e", "q")], "column string, value string")
    got = sorted((r.id, r.c, r.d) for r in apply_cat_meta(df, meta, ["c", "d"]).collect())
    assert got == [(1, "a", None), (2, None, None), (3, None, None)]
    many = meta.unionByName(spark.range(20_000).selectExpr("'c' as column", "cast(id as string) as value"))
    assert sorted((r.id, r.c) for r in apply_cat_meta(df, many).collect()) == [(1, "a"), (2, None), (3, None)]


def test_csv_columns_go_by_the_header(spark, tmp_path):
    from tillroll.sources import files
    (tmp_path / "stores.csv").write_text("state,city,extra,cluster,type,store_nbr\nPichincha,Quito,?,13,D,1\n")
    row = files.read_csv(spark, str(tmp_path / "stores.csv"), "stores").first()
    assert (row.store_nbr, row.city, row.state, row.type, row.cluster) == (1, "Quito", "Pichincha", "D", 13)
    (tmp_path / "oil.csv").write_text("date,price\n2017-01-01,3\n")
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "oil.csv"), "oil")
    (tmp_path / "bad.csv").write_text("date,dcoilwtico\n2017-01-01,three\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv"), "oil").collect()


def test_a_cluster_without_a_shared_folder_is_refused():
    from tillroll import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Spark:
        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(Spark(master))


def test_undefined_losses_never_win(spark, tmp_path):
    from tillroll.operators import model
    trials = spark.createDataFrame([(0, "gbt", "{\"a\": 0}", float("nan"), 2), (1, "gbt", "{\"a\": 1}", 0.7, 2)], model.TRIALS_SCHEMA)
    assert model.best_params(trials)["a"] == 1
    folds = spark.createDataFrame([(0, 0.5), (1, None)], "fold int, loss double")
    assert evaluate.mean_loss(folds).first().mean_loss is None
    losses = spark.createDataFrame([(0, None), (1, 0.9)], "trial_id int, loss double")
    assert evaluate.best_trial(losses).first().trial_id == 1
    assert model.load_trials(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        model.load_trials(spark, str(tmp_path / "broken")).count()


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(2000).selectExpr("id", "id % 7 as k")
    a = {r.id for r in clean.sample_rows(df.repartition(3), 0.1, 5).collect()}
    b = {r.id for r in clean.sample_rows(df.repartition(11, "k"), 0.1, 5).collect()}
    assert a == b and 120 < len(a) < 280
    assert a != {r.id for r in clean.sample_rows(df, 0.1, 6).collect()}


def test_correlations_rank_before_rounding(spark):
    from tillroll.operators import profile
    rows = [(float(k), float(k) + 0.4 * (k % 3), float(k) + 0.2 * (k % 3)) for k in range(60)]
    df = spark.createDataFrame(rows, "y double, a double, b double")
    got = profile.correlations(df, "y").collect()
    assert [r.column for r in got] == ["b", "a"] and got[0].corr == got[1].corr == 1.0
