"""Plan checks: built-in expressions only, pushdown reaches the scan, entry smoke."""

import datetime as dt

import __spark_entry__ as E
from tillroll.sources import files

from tillroll.operators import rolling
from tillroll.plans import queries

# exact quantiles of long frames are the one deliberate Python stage
LONG = tuple(f"_w{w}" for w in rolling.DEFAULT_WINDOWS if w > rolling.LONG_FRAME)
# these run jobs while being built; covered by their own tests
RUN_JOBS = ("tune", "train_best", "model_roundtrip", "trials_append", "best_trial", "fit_gbt", "chunked_boosting",
            "manifest_assembly", "bucketed_assembly", "early_stopping", "penalised_leaves", "sketch_profile")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_at_a_time_python_udfs(spark, sf_small):
    for key, q in queries.registry().items():
        if key in RUN_JOBS:
            continue
        plan = _plan(q(spark, sf_small))
        assert "BatchEvalPython" not in plan, key
        if not (key.startswith("rolling_") and key.endswith(LONG)):
            assert "MapInPandas" not in plan and "FlatMapGroupsInPandas" not in plan \
                and "ArrowEvalPython" not in plan, key


def test_bins_join_and_shuffle_no_unpivoted_rows(spark, sf_small):
    for key in ("histogram", "scatter_bins"):
        plan = _plan(queries.registry()[key](spark, sf_small))
        lines = plan.splitlines()
        assert any("Generate explode" in x for x in lines) and "partial_count" in plan
        for k, line in enumerate(lines):  # binned rows (they have a ``column``) are only shuffled as partial counts
            if "column#" in line and "Join" in line or "BroadcastExchange" in line and "string" in line:
                raise AssertionError(line)
            if "Exchange hashpartitioning(column#" in line:
                assert "partial_count" in lines[k + 1], key


def test_date_range_pushed_to_parquet_scan(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2017, 1, d), float(d)) for d in range(1, 11)], "date date, v double")
    files.save_as_parquet(df, str(tmp_path / "t"))
    q = files.load_from_parquet(spark, str(tmp_path / "t"), "2017-01-03", "2017-01-05")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2017-01-03), LessThanOrEqual(date,2017-01-05)]" \
        in plan
    assert q.count() == 3
    assert files.load_from_parquet(spark, str(tmp_path / "t"), "2017-01-03", None).count() == 10


def test_column_pruning_and_single_fact_pass(spark, sf_small):
    # global totals need date and sales only: discount and the other columns are pruned
    plan = _plan(E.queries()["daily_totals_global"](spark, sf_small))
    scans = [p.split(">")[0] for p in plan.split("ReadSchema: ")[1:] if p.startswith("struct<l_")]
    assert len(scans) == 1 and "l_discount" not in scans[0] and "l_quantity" not in scans[0], scans
    # the densified totals read the fact once, inside the checkpoint of the (date, family)
    # sums; the plan itself only reads the checkpointed aggregate
    plan = _plan(E.queries()["daily_totals_family"](spark, sf_small))
    assert "struct<l_" not in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "sales_q95_wrt_family_lag16_window365" in df.columns
