"""DuckDB oracle SQL for the registered queries (same keys as ``queries.py``).

Statements read the driver tables through the fixture views (as CTEs) and
round floating outputs to ``DECIMALS`` like the Spark side.
"""

from __future__ import annotations

from tillroll.fixtures import FIXTURE_SQL
from tillroll.functions.stats import DEFAULT_QUANTILES, DEFAULT_STATS, feature_suffix, quantile_label
from tillroll.operators.rolling import DEFAULT_LAG, DEFAULT_WINDOWS
from tillroll.plans.common import DECIMALS, GROUPS, HOLIDAY_COMBOS

D = DECIMALS

MAIN_LOG = "SELECT *, ln(1 + sales) AS log_sales FROM main"
MAIN_STORES = ("SELECT ml.*, st.city, st.state, st.type, st.cluster "
               "FROM main_log ml LEFT JOIN stores st ON ml.store_nbr = st.store_nbr")


def sql(ctes: list[tuple[str, str]], body: str) -> str:
    """WITH <fixture views and extra CTEs> <body>; fixture names expand to their SQL."""
    parts = []
    for name, text in ctes:
        parts.append(f"{name} AS ({FIXTURE_SQL[name] if text is None else text})")
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


BASE = [("main", None), ("main_log", MAIN_LOG)]
BASE_STORES = BASE + [("stores", None), ("main_stores", MAIN_STORES)]


def rexpr(expr: str) -> str:
    """Same rounding as ``common.round_half_up``."""
    return (f"CASE WHEN isnan({expr}) OR isinf({expr}) THEN {expr} WHEN abs({expr}) >= 1e9 THEN ROUND({expr}) "
            f"ELSE CAST(ROUND(CAST({expr} AS DECIMAL(38,{D + 2})), {D}) AS DOUBLE) END")


def r(expr: str, alias: str) -> str:
    return f"{rexpr(expr)} AS \"{alias}\""


def totals_ctes(group: str | None) -> list[tuple[str, str]]:
    if not group:
        return BASE_STORES + [
            ("s", "SELECT date, SUM(sales) AS sales FROM main_stores GROUP BY date"),
            ("t", "SELECT date, CAST(COALESCE(sales, 0) AS DOUBLE) AS sales, "
                  "ln(1 + COALESCE(sales, 0)) AS log_sales FROM s")]
    g = group
    return BASE_STORES + [
        ("s", f"SELECT date, {g}, SUM(sales) AS sales FROM main_stores GROUP BY date, {g}"),
        ("d", "SELECT DISTINCT date FROM s"),
        ("c", f"SELECT DISTINCT {g} FROM s WHERE {g} IS NOT NULL"),
        ("t", f"SELECT d.date, c.{g}, CAST(COALESCE(s.sales, 0) AS DOUBLE) AS sales, "
              f"ln(1 + COALESCE(s.sales, 0)) AS log_sales "
              f"FROM d CROSS JOIN c LEFT JOIN s ON s.date = d.date AND s.{g} = c.{g}")]


def daily_totals_sql(group: str | None) -> str:
    keys = f"date, {group}" if group else "date"
    return sql(totals_ctes(group), f"SELECT {keys}, {r('sales', 'sales')}, {r('log_sales', 'log_sales')} FROM t")


STAT_SQL = {"mean": "AVG({c})", "std": "STDDEV_SAMP({c})", "min": "MIN({c})", "max": "MAX({c})"}


def rolling_sql(group: str | None, window: int, lag: int = DEFAULT_LAG,
                stats=DEFAULT_STATS, quantiles=DEFAULT_QUANTILES, round_output: bool = True,
                values=("sales", "log_sales")) -> str:
    g = [group] if group else []
    suffix = feature_suffix(g, lag, window)
    exprs, names = [], []
    for v in values:
        for s in stats:
            names.append(f"{v}_{s}{suffix}")
            exprs.append(f"{STAT_SQL[s].format(c=v)} OVER w AS \"{names[-1]}\"")
        for q in quantiles:
            names.append(f"{v}_{quantile_label(q)}{suffix}")
            exprs.append(f"quantile_cont({v}, {q / 100}) OVER w AS \"{names[-1]}\"")
    part = f"PARTITION BY {group} " if group else ""
    keys = ", ".join(["date", *g])
    roll = (f"SELECT {keys}, {', '.join(exprs)} FROM t "
            f"WINDOW w AS ({part}ORDER BY date ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)")
    on = " AND ".join([f"rr.{x} = t.{x}" for x in g] + [f"rr.date + {lag} = t.date"])
    outs = ", ".join((r(f"COALESCE(rr.\"{n}\", 0)", n) if round_output
                      else f"COALESCE(rr.\"{n}\", 0) AS \"{n}\"") for n in names)
    tkeys = ", ".join(f"t.{x}" for x in ["date", *g])
    return sql(totals_ctes(group) + [("rr", roll)], f"SELECT {tkeys}, {outs} FROM t LEFT JOIN rr ON {on}")


def registry_core() -> dict[str, str]:
    o = {
        "combine_train_test": sql([("main", None)], "SELECT * FROM main"),
        "log_target": sql(BASE, f"SELECT id, date, store_nbr, family, onpromotion, {r('sales', 'sales')}, "
                                f"is_train, is_test, {r('log_sales', 'log_sales')} FROM main_log"),
        "main_stores_join": sql(BASE_STORES, f"SELECT id, date, store_nbr, family, onpromotion, "
                                             f"{r('sales', 'sales')}, is_train, is_test, "
                                             f"{r('log_sales', 'log_sales')}, city, state, type, cluster "
                                             f"FROM main_stores"),
        "stores_clean": sql([("stores", None)], "SELECT * FROM stores"),
        "daily_totals_global": daily_totals_sql(None),
    }
    for g in GROUPS:
        o[f"daily_totals_{g}"] = daily_totals_sql(g)
    for g in GROUPS:
        for w in DEFAULT_WINDOWS:
            o[f"rolling_{g}_w{w}"] = rolling_sql(g, w)
    return o


# --- oil series and calendar ------------------------------------------------------------

OIL_FILLED = [("oil", None),
              ("b", "SELECT MIN(date) AS lo, MAX(date) AS hi FROM oil"),
              ("cal", "SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), "
                      "INTERVAL 1 DAY)) AS DATE) AS date FROM b"),
              ("j", "SELECT cal.date, oil.dcoilwtico FROM cal LEFT JOIN oil ON cal.date = oil.date"),
              ("filled", "SELECT date, COALESCE("
                         "LAST_VALUE(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN "
                         "UNBOUNDED PRECEDING AND CURRENT ROW), "
                         "FIRST_VALUE(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN "
                         "CURRENT ROW AND UNBOUNDED FOLLOWING)) AS dcoilwtico FROM j")]

CALENDAR_COLS = (
    "dayname(date) AS dayOfWeek, dayofweek(date) IN (0, 6) AS isWeekend, "
    "CAST(month(date) AS INTEGER) AS Month, "
    "CAST(CASE WHEN day(date) >= 15 THEN day(date) - 15 "
    "ELSE day(date_trunc('month', date) - INTERVAL 1 DAY) - 15 + day(date) END AS INTEGER) AS daysSince15th, "
    "CAST(CASE WHEN day(date) = day(last_day(date)) - 1 THEN 0 ELSE day(date) END AS INTEGER) AS daysSinceLast, "
    "CAST(least(CASE WHEN day(date) >= 15 THEN day(date) - 15 "
    "ELSE day(date_trunc('month', date) - INTERVAL 1 DAY) - 15 + day(date) END, "
    "CASE WHEN day(date) = day(last_day(date)) - 1 THEN 0 ELSE day(date) END) AS INTEGER) AS daysSincePaycheck")


def pct_sql(col: str, n: int) -> str:
    prev = f"LAG({col}, {n}) OVER (ORDER BY date)"
    return (f"CASE WHEN {prev} IS NULL OR {col} IS NULL THEN 0.0 "
            f"WHEN {prev} = 0 THEN CASE WHEN {col} > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN {col} < 0 THEN CAST('-inf' AS DOUBLE) ELSE 0.0 END "
            f"ELSE {col} / {prev} - 1 END")


def oil_pct_cols() -> list[tuple[str, str]]:
    from tillroll.operators.series import oil_pct_periods
    return [(name, pct_sql("dcoilwtico", n)) for name, n in oil_pct_periods().items()]


def process_oil_ctes() -> list[tuple[str, str]]:
    pct = ", ".join(f"{e} AS \"{n}\"" for n, e in oil_pct_cols())
    return OIL_FILLED + [("oilfe", f"SELECT date, dcoilwtico, {CALENDAR_COLS}, {pct} FROM filled")]


def select_rounded(table: str, double_cols: list[str], other_cols: list[str]) -> str:
    cols = other_cols + [r(f'"{c}"', c) for c in double_cols]
    return f"SELECT {', '.join(cols)} FROM {table}"


OIL_DOUBLES = ["dcoilwtico"]
CAL_OTHER = ["date", "dayOfWeek", "isWeekend", "Month", "daysSince15th", "daysSinceLast", "daysSincePaycheck"]


def pct_names() -> list[str]:
    return [n for n, _ in oil_pct_cols()]


# --- holidays ---------------------------------------------------------------------------

HOL_CLEAN = ("SELECT date, CASE WHEN type = 'Transfer' THEN 'Holiday' ELSE type END AS type, locale, "
             "locale_name, description, transferred FROM holidays_events")
COMBO = "'combo_(''' || locale || ''', ''' || locale_name || ''', ''' || type || ''')'"
MARKS = [*HOLIDAY_COMBOS, "is_holiday_event"]


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# the labels are fixed, so the pivot is one aggregate per label
HOL_CTES = [("holidays_events", None), ("hc", HOL_CLEAN),
            ("hl", f"SELECT date, {COMBO} AS combo FROM hc"),
            ("onehot", "SELECT date, " + ", ".join(
                f'MAX(CASE WHEN combo = {text(c)} THEN 1 ELSE 0 END) AS "{c}"' for c in HOLIDAY_COMBOS)
             + ", 1 AS is_holiday_event FROM hl GROUP BY date")]

# oil LEFT JOIN onehot, filled with 0, then every mark's neighbours
NEIGHBOUR_CTES = [
    ("marked", "SELECT f.date, " + ", ".join(f'COALESCE(o."{c}", 0) AS "{c}"' for c in MARKS)
     + " FROM filled f LEFT JOIN onehot o ON o.date = f.date"),
    ("wide", "SELECT date, " + ", ".join(
        f'CAST("{c}" AS INTEGER) AS "{c}", ' + ", ".join(
            f'CAST(COALESCE({fn}("{c}", {n}) OVER (ORDER BY date), 0) AS INTEGER) AS "{c}_{n}{side}"'
            for n in (1, 2) for fn, side in (("LEAD", "next"), ("LAG", "before"))) for c in MARKS) + " FROM marked")]


def registry_series() -> dict[str, str]:
    pct = pct_names()
    return {
        "oil_fill": sql(OIL_FILLED, select_rounded("filled", OIL_DOUBLES, ["date"])),
        "calendar_features": sql(OIL_FILLED + [("c", f"SELECT date, dcoilwtico, {CALENDAR_COLS} FROM filled")],
                                 select_rounded("c", OIL_DOUBLES, CAL_OTHER)),
        "oil_pct_change": sql(OIL_FILLED + [("p", "SELECT date, dcoilwtico, " + ", ".join(
            f"{e} AS \"{n}\"" for n, e in oil_pct_cols()) + " FROM filled")],
            select_rounded("p", OIL_DOUBLES + pct, ["date"])),
        "process_oil": sql(process_oil_ctes(), select_rounded("oilfe", OIL_DOUBLES + pct, CAL_OTHER)),
        "holiday_clean": sql([("holidays_events", None)], HOL_CLEAN),
        "holiday_onehot": sql(HOL_CTES, "SELECT * FROM onehot"),
        "holiday_neighbours": sql(OIL_FILLED + HOL_CTES + NEIGHBOUR_CTES,
                                  f"SELECT wide.*, {r('f.dcoilwtico', 'dcoilwtico')} FROM wide "
                                  "JOIN filled f ON f.date = wide.date"),
        "merge_all": sql(BASE_STORES + process_oil_ctes() + HOL_CTES + NEIGHBOUR_CTES + [
            ("oilr", select_rounded("oilfe", OIL_DOUBLES + pct, CAL_OTHER))],
            "SELECT ms.id, ms.date, ms.store_nbr, ms.family, ms.onpromotion, "
            f"{rexpr('ms.sales')} AS sales, ms.is_train, ms.is_test, {rexpr('ms.log_sales')} AS log_sales, "
            "ms.city, ms.state, ms.type, ms.cluster, oilr.* EXCLUDE (date), wide.* EXCLUDE (date) "
            "FROM main_stores ms LEFT JOIN oilr ON oilr.date = ms.date LEFT JOIN wide ON wide.date = ms.date"),
        "merge_fill": sql(BASE + process_oil_ctes(),
                          f"SELECT m.date, {rexpr('m.sales')} AS sales, o.dayOfWeek, o.isWeekend, "
                          "COALESCE(o.Month, 0) AS Month, COALESCE(o.daysSince15th, 0) AS daysSince15th, "
                          "COALESCE(o.daysSinceLast, 0) AS daysSinceLast, "
                          "COALESCE(o.daysSincePaycheck, 0) AS daysSincePaycheck, "
                          + ", ".join(f"{rexpr(f'COALESCE(o.{chr(34)}{c}{chr(34)}, 0)')} AS \"{c}\""
                                      for c in ["dcoilwtico"] + pct)
                          + " FROM main_log m LEFT JOIN oilfe o ON o.date = m.date"),
    }


# --- sources, category metadata, assembly -----------------------------------------------

MAIN_COLS_ROUNDED = (f"id, date, store_nbr, family, onpromotion, {rexpr('sales')} AS sales, is_train, is_test, "
                     f"{rexpr('log_sales')} AS log_sales")


def cat_pairs(table: str, cols: list[str]) -> str:
    return " UNION ".join(f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {table} "
                          f"WHERE {c} IS NOT NULL" for c in cols)


def manifest_assembly_sql() -> str:
    """The registered columns of the manifest's wide table over the example date range."""
    from tillroll.plans.queries import RANGE_END, RANGE_START, manifest_features
    ctes, joins, outs = BASE + [("stores", None)] + process_oil_ctes() + HOL_CTES, [], []
    for g in GROUPS:
        for w, feature in zip(DEFAULT_WINDOWS, manifest_features(g)):
            name = f"r_{g}_{w}"
            stat = feature.split("_")[1]  # only the statistic that is returned
            one = {"stats": (), "quantiles": (int(stat[1:]),)} if stat[0] == "q" else {"stats": (stat,), "quantiles": ()}
            ctes = ctes + [(name, rolling_sql(g, w, round_output=False, values=("sales",), **one))]
            side = "m" if g in ("store_nbr", "family") else "st"
            joins.append(f"LEFT JOIN {name} ON {name}.date = m.date AND {name}.{g} = {side}.{g}")
            outs.append(r(f'{name}."{feature}"', feature))
    return sql(ctes, f"SELECT m.id, m.date, m.store_nbr, m.family, {rexpr('m.sales')} AS sales, st.city, st.state, st.type, "
                     f"st.cluster, {r('oilfe.dcoilwtico', 'dcoilwtico')}, onehot.is_holiday_event, {', '.join(outs)} "
                     "FROM main_log m LEFT JOIN stores st ON st.store_nbr = m.store_nbr "
                     "LEFT JOIN oilfe ON oilfe.date = m.date LEFT JOIN onehot ON onehot.date = m.date "
                     + " ".join(joins) + f" WHERE m.date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'")


def registry_sources() -> dict[str, str]:
    cat_cols = ["store_nbr", "family", "city", "state", "type", "cluster"]
    fam7 = rolling_sql("family", 7)
    typ28 = rolling_sql("type", 28)
    pct = pct_names()
    assembly = sql(
        BASE + [("stores", None)] + process_oil_ctes() + HOL_CTES + [
            ("oilr", select_rounded("oilfe", OIL_DOUBLES + pct, CAL_OTHER)),
            ("rf", "SELECT * FROM (" + fam7 + ")"), ("rt", "SELECT * FROM (" + typ28 + ")")],
        f"SELECT m.id, m.date, m.store_nbr, m.family, m.onpromotion, {rexpr('m.sales')} AS sales, "
        f"m.is_train, m.is_test, {rexpr('m.log_sales')} AS log_sales, st.city, st.state, st.type, st.cluster, "
        "oilr.* EXCLUDE (date), onehot.* EXCLUDE (date), rf.* EXCLUDE (date, family), "
        "rt.* EXCLUDE (date, type) "
        "FROM main_log m LEFT JOIN stores st ON st.store_nbr = m.store_nbr "
        "LEFT JOIN oilr ON oilr.date = m.date LEFT JOIN onehot ON onehot.date = m.date "
        "LEFT JOIN rf ON rf.date = m.date AND rf.family = m.family "
        "LEFT JOIN rt ON rt.date = m.date AND rt.type = st.type")
    return {
        "scan_date_range": sql(BASE, f"SELECT {MAIN_COLS_ROUNDED} FROM main_log "
                                     "WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"),
        "category_metadata": sql(BASE_STORES, cat_pairs("main_stores", cat_cols)),
        "category_union": sql(BASE + [("stores", None),
                                      ("u", cat_pairs("main_log", ["store_nbr", "family"]) + " UNION "
                                       + cat_pairs("stores", ["store_nbr", "city", "state", "type", "cluster"]))],
                              "SELECT \"column\", COUNT(*) AS n_categories, "
                              "array_to_string(list_sort(list(value)), '|') AS categories FROM u "
                              "GROUP BY \"column\""),
        "apply_categories": sql(BASE + [("k", "SELECT DISTINCT family FROM main_log WHERE is_train = 1"),
                                        ("ks", "SELECT DISTINCT store_nbr FROM main_log WHERE is_train = 1")],
                                f"SELECT id, date, CASE WHEN store_nbr IN (SELECT store_nbr FROM ks) "
                                f"THEN store_nbr END AS store_nbr, "
                                f"CASE WHEN family IN (SELECT family FROM k) THEN family END AS family, "
                                f"onpromotion, {rexpr('sales')} AS sales, is_train, is_test, "
                                f"{rexpr('log_sales')} AS log_sales FROM main_log"),
        "feature_assembly": assembly,
        "bucketed_assembly": assembly,
        "manifest_assembly": manifest_assembly_sql(),
        "scan_csv_raw": sql([("main", None)], f"SELECT id, date, store_nbr, family, {r('sales', 'sales')}, onpromotion "
                                              "FROM main WHERE is_train = 1"),
        "parquet_roundtrip": sql(BASE, f"SELECT {MAIN_COLS_ROUNDED} FROM main_log"),
    }


# --- library variants -------------------------------------------------------------------

def daily_stats_select(g: str, v: str = "sales") -> str:
    sfx = f"_wrt_{g}"
    parts = [f"AVG({v}) AS \"{v}_mean{sfx}\"", f"STDDEV_SAMP({v}) AS \"{v}_std{sfx}\"",
             f"MIN({v}) AS \"{v}_min{sfx}\"", f"MAX({v}) AS \"{v}_max{sfx}\""]
    for q in DEFAULT_QUANTILES:
        parts.append(f"CASE WHEN COUNT(*) > COUNT({v}) THEN NULL ELSE quantile_cont({v}, {q / 100}) END "
                     f"AS \"{v}_{quantile_label(q)}{sfx}\"")
    return ", ".join(parts)


def daily_stats_names(g: str, v: str = "sales") -> list[str]:
    return [f"{v}_{s}_wrt_{g}" for s in list(DEFAULT_STATS) + [quantile_label(q) for q in DEFAULT_QUANTILES]]


def daily_stats_ctes(g: str) -> list[tuple[str, str]]:
    return BASE_STORES + [
        ("ds", f"SELECT date, {g}, {daily_stats_select(g)} FROM main_stores GROUP BY date, {g}"),
        ("d", "SELECT DISTINCT date FROM ds"),
        ("c", f"SELECT DISTINCT {g} FROM ds WHERE {g} IS NOT NULL"),
        ("dsd", f"SELECT d.date, c.{g}, ds.* EXCLUDE (date, {g}) FROM d CROSS JOIN c "
                f"LEFT JOIN ds ON ds.date = d.date AND ds.{g} = c.{g}")]


def registry_variants() -> dict[str, str]:
    g = "family"
    names = daily_stats_names(g)
    rolled = ", ".join(f"AVG(\"{n}\") OVER (PARTITION BY {g} ORDER BY date ROWS BETWEEN 6 PRECEDING AND "
                       f"CURRENT ROW) AS \"{n}\"" for n in names)
    shifted = ", ".join(f"LAG(\"{n}\", 16) OVER (PARTITION BY {g} ORDER BY date) AS \"{n}_lag16_window7\""
                        for n in names)
    not_all_null = " OR ".join(f"\"{n}_lag16_window7\" IS NOT NULL" for n in names)
    w7 = "WINDOW w AS ({p}ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"
    stats7 = ("AVG(sales) OVER w AS sales_mean, STDDEV_SAMP(sales) OVER w AS sales_std, "
              "MIN(sales) OVER w AS sales_min, MAX(sales) OVER w AS sales_max")
    r7 = ", ".join(r(c, c) for c in ("sales_mean", "sales_std", "sales_min", "sales_max"))
    return {
        "daily_stats": sql(daily_stats_ctes(g), select_rounded("dsd", names, ["date", g])),
        "roll_daily_stats": sql(daily_stats_ctes(g) + [
            ("rl", f"SELECT date, {g}, {rolled} FROM dsd"),
            ("sh", f"SELECT date, {g}, {shifted} FROM rl")],
            select_rounded(f"sh WHERE {not_all_null}", [n + "_lag16_window7" for n in names], ["date", g])),
        "rolling_7d_global": sql(BASE + [
            ("ds", "SELECT date, SUM(sales) AS sales FROM main_log WHERE is_train = 1 GROUP BY date"),
            ("rw", f"SELECT date, {stats7} FROM ds " + w7.format(p=""))],
            f"SELECT date, {r7} FROM rw"),
        "rolling_7d_store": sql(BASE + [
            ("ds", "SELECT store_nbr, date, SUM(sales) AS sales FROM main_log WHERE is_train = 1 "
                   "GROUP BY store_nbr, date"),
            ("rw", f"SELECT store_nbr, date, {stats7} FROM ds " + w7.format(p="PARTITION BY store_nbr "))],
            f"SELECT store_nbr, date, {r7} FROM rw"),
        "ascending_dates": sql(BASE, "SELECT id, CAST(MIN(date) OVER () + CAST(ROW_NUMBER() OVER (ORDER BY id) - 1 "
                                     "AS INTEGER) AS DATE) AS date, store_nbr, family, onpromotion, "
                                     f"{rexpr('sales')} AS sales, is_train, is_test, "
                                     f"{rexpr('log_sales')} AS log_sales FROM main_log"),
    }


# --- evaluation and profiling -----------------------------------------------------------

PRED = "log_sales_mean_wrt_family_lag16_window7"
CANDIDATES = ("log_sales_mean_wrt_family_lag16_window7", "log_sales_q50_wrt_family_lag16_window7",
              "log_sales_min_wrt_family_lag16_window7", "log_sales_max_wrt_family_lag16_window7")
FOLDS, DAYS = 8, 16


def scored_ctes() -> list[tuple[str, str]]:
    return BASE + [("rf", "SELECT * FROM (" + rolling_sql("family", 7, round_output=False) + ")"),
                   ("scored", "SELECT m.*, rf.* EXCLUDE (date, family) FROM main_log m "
                              "LEFT JOIN rf ON rf.date = m.date AND rf.family = m.family"),
                   ("tr", "SELECT * FROM scored WHERE is_train = 1"),
                   ("lastd", "SELECT MAX(date) AS last FROM tr")]


def fold_ctes() -> list[tuple[str, str]]:
    return [("folds", f"SELECT CAST(i AS INTEGER) AS fold, CAST(last - CAST((i + 1) * {DAYS} AS INTEGER) AS DATE) "
                      f"AS first_val_date, CAST(last - CAST(i * {DAYS} AS INTEGER) AS DATE) AS last_val_date "
                      f"FROM range({FOLDS}) t(i), lastd"),
            ("sizes", "SELECT f.fold, f.first_val_date, f.last_val_date, "
                      "(SELECT COUNT(*) FROM tr WHERE tr.date < f.first_val_date) AS n_train, "
                      "(SELECT COUNT(*) FROM tr WHERE tr.date > f.first_val_date AND tr.date <= f.last_val_date) "
                      "AS n_val FROM folds f")]


def fold_loss_sql(pred: str) -> str:
    return ("SELECT s.fold, s.first_val_date, s.last_val_date, s.n_train, s.n_val, "
            "CASE WHEN s.n_train = 0 THEN 0.0 ELSE (SELECT SQRT(AVG(POWER(tr.log_sales - "
            f"GREATEST(tr.\"{pred}\", 0), 2))) FROM tr WHERE tr.date > s.first_val_date "
            "AND tr.date <= s.last_val_date) END AS loss FROM sizes s")


def trials_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS trial_id, '{c}' AS predictor, (SELECT CASE WHEN COUNT(*) = COUNT(loss) THEN AVG(loss) END FROM ({fold_loss_sql(c)})) "
        "AS loss" for i, c in enumerate(CANDIDATES))


#: What type and name tell of the training rows' columns.
COLUMN_KINDS = [
    *[("category", c) for c in ("store_nbr", "family", "city", "state", "type", "cluster")], ("number", "onpromotion"), ("target", "log_sales"),
    *[("numeric type", c) for c in ("store_nbr", "onpromotion", "cluster")], *[("other type", c) for c in ("family", "city", "state", "type")],
    *[("flag by prefix", c) for c in ("is_train", "is_test")], *[("sales by part", c) for c in ("sales", "log_sales")],
    *[("key by pattern", c) for c in ("id", "store_nbr")]]


def two_columns_ctes(g: str) -> list[tuple[str, str]]:
    both = f"{daily_stats_select(g)}, {daily_stats_select(g, 'onpromotion')}"
    return [(name, text.replace(daily_stats_select(g), both) if name == "ds" else text) for name, text in daily_stats_ctes(g)]


def registry_eval() -> dict[str, str]:
    from tillroll.plans.queries import RANGE_END, RANGE_START
    trials = trials_sql()
    corr_cols = ["id", "store_nbr", "onpromotion", "log_sales", "is_train", "is_test"]
    corr_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(covar_samp(CASE WHEN sales IS NOT NULL THEN {c} END, "
        f"CASE WHEN {c} IS NOT NULL THEN sales END) / NULLIF(stddev_samp(CASE WHEN sales IS NOT NULL THEN {c} END) * "
        f"stddev_samp(CASE WHEN {c} IS NOT NULL THEN sales END), 0) AS DOUBLE) AS corr FROM main_log"
        for c in corr_cols)
    num = ["id", "store_nbr", "onpromotion", "sales", "is_train", "is_test", "log_sales"]
    long_num = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM main_log "
                                  f"WHERE {c} IS NOT NULL" for c in num)
    prof_cols = {"id": "bigint", "date": "date", "store_nbr": "bigint", "family": "string", "onpromotion": "bigint",
                 "sales": "double", "is_train": "int", "is_test": "int", "log_sales": "double"}
    prof = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kind}' AS dtype, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_null, "
        f"COUNT(DISTINCT {c}) AS n_distinct FROM main_log" for c, kind in prof_cols.items())
    sc_cols = ["id", "store_nbr", "onpromotion", "log_sales", "is_train", "is_test"]
    long_sc = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, "
                                 f"CAST(sales AS DOUBLE) AS y FROM main_log WHERE {c} IS NOT NULL AND sales IS NOT NULL"
                                 for c in sc_cols)
    cat_cols = ["store_nbr", "family", "city", "state", "type", "cluster"]
    long_cat = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM main_stores "
                                  f"WHERE {c} IS NOT NULL" for c in cat_cols)

    long_value = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, sales FROM main_stores "
                                    "WHERE sales IS NOT NULL" for c in cat_cols)

    def bucket(v, mn, mx, bins):
        return (f"CAST(CASE WHEN {mx} - {mn} = 0 THEN 0 ELSE LEAST(FLOOR(({v} - {mn}) / ({mx} - {mn}) * {bins}), "
                f"{bins - 1}) END AS INTEGER)")

    return {
        "split_train_test": sql(BASE, f"SELECT {MAIN_COLS_ROUNDED} FROM main_log WHERE is_train = 1"),
        "feature_projection": sql(BASE_STORES, "SELECT store_nbr, family, onpromotion, city, state, type, cluster "
                                               "FROM main_stores"),
        "backtest_folds": sql(BASE + [("tr", "SELECT * FROM main_log WHERE is_train = 1"),
                                      ("lastd", "SELECT MAX(date) AS last FROM tr")] + fold_ctes(),
                              "SELECT fold, first_val_date, last_val_date, n_train, n_val FROM sizes"),
        "rmse_clipped": sql(scored_ctes(), f"SELECT {rexpr(f'SQRT(AVG(POWER(log_sales - GREATEST({PRED}, 0), 2)))')} "
                                           "AS rmse FROM tr"),
        "backtest_loss": sql(scored_ctes() + fold_ctes() + [("fl", fold_loss_sql(PRED))],
                             f"SELECT fold, first_val_date, last_val_date, n_train, n_val, {rexpr('loss')} AS loss, "
                             f"{rexpr('CASE WHEN COUNT(*) OVER () = COUNT(loss) OVER () THEN AVG(loss) OVER () END')} AS mean_loss FROM fl"),
        "best_trial": sql(scored_ctes() + fold_ctes() + [("trials", trials)],
                          f"SELECT trial_id, predictor, {rexpr('loss')} AS loss FROM trials "
                          "ORDER BY loss, trial_id LIMIT 1"),
        "submission": sql(scored_ctes(), f"SELECT CAST(id AS BIGINT) AS id, {rexpr(f'EXP({PRED}) - 1')} AS sales "
                                         "FROM scored WHERE is_test = 1"),
        "profile_table": sql(BASE, prof),
        "histogram": sql(BASE + [("l", long_num), ("rg", "SELECT \"column\", MIN(value) AS mn, MAX(value) AS mx "
                                                         "FROM l GROUP BY 1"),
                                 ("b", f"SELECT l.\"column\", {bucket('value', 'mn', 'mx', 100)} AS bin, COUNT(*) AS n "
                                       "FROM l JOIN rg USING (\"column\") GROUP BY 1, 2")],
                         "SELECT b.\"column\", b.bin, " + r("mn + (mx - mn) * bin / 100", "lo") + ", "
                         + r("mn + (mx - mn) * (bin + 1) / 100", "hi") + ", n FROM b JOIN rg USING (\"column\")"),
        "correlations": sql(BASE + [("c", corr_rows)],
                            "SELECT \"column\", ROUND(corr, 3) AS corr, CAST(ROW_NUMBER() OVER (ORDER BY abs(corr) DESC NULLS LAST, "
                            "\"column\") AS INTEGER) AS rank FROM (SELECT * FROM c) QUALIFY rank <= 15"),
        "scatter_bins": sql(BASE + [("l", long_sc), ("rg", "SELECT \"column\", MIN(value) xmn, MAX(value) xmx, "
                                                           "MIN(y) ymn, MAX(y) ymx FROM l GROUP BY 1")],
                            f"SELECT \"column\", {bucket('value', 'xmn', 'xmx', 50)} AS x_bin, "
                            f"{bucket('y', 'ymn', 'ymx', 50)} AS y_bin, COUNT(*) AS n FROM l JOIN rg "
                            "USING (\"column\") GROUP BY 1, 2, 3"),
        "distribution_by_category": sql(BASE_STORES + [("lc", long_value)], "SELECT \"column\", value, COUNT(*) AS n, "
                                        + r("AVG(sales)", "mean") + ", "
                                        + r("MIN(sales)", "min") + ", " + r("MAX(sales)", "max") + ", "
                                        + r("quantile_cont(sales, 0.25)", "q25") + ", "
                                        + r("quantile_cont(sales, 0.5)", "q50") + ", "
                                        + r("quantile_cont(sales, 0.75)", "q75")
                                        + " FROM lc GROUP BY 1, 2"),
        "date_spans": sql(BASE, "SELECT 'all' AS subset, MIN(date) AS min_date, MAX(date) AS max_date FROM main_log "
                                "UNION ALL SELECT 'train', MIN(date), MAX(date) FROM main_log WHERE is_train = 1 "
                                "UNION ALL SELECT 'test', MIN(date), MAX(date) FROM main_log WHERE is_test = 1"),
        "duplicate_rows": sql(BASE, f"SELECT {MAIN_COLS_ROUNDED}, COUNT(*) AS n FROM main_log "
                                    "GROUP BY ALL HAVING COUNT(*) > 1"),
        "repeated_rows": sql(BASE, f"SELECT {MAIN_COLS_ROUNDED}, CAST(2 AS BIGINT) AS n FROM main_log "
                                   f"WHERE date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"),
        "missing_spans": sql(BASE + [
            ("seen", "SELECT DISTINCT store_nbr, family, date FROM main_log WHERE is_train = 1 AND sales IS NOT NULL AND date IS NOT NULL"),
            ("g", "SELECT *, LAG(date) OVER (PARTITION BY store_nbr, family ORDER BY date) AS before FROM seen")],
            "SELECT store_nbr, family, CAST(before + 1 AS DATE) AS first, CAST(date - 1 AS DATE) AS last, "
            "CAST(date_diff('day', before, date) - 1 AS INTEGER) AS n_days FROM g WHERE date_diff('day', before, date) > 1"),
        "head_rows": sql(BASE, f"SELECT {MAIN_COLS_ROUNDED}, CAST(ROW_NUMBER() OVER (ORDER BY date NULLS LAST, store_nbr NULLS LAST, "
                               "family NULLS LAST, id NULLS LAST) AS INTEGER) AS row FROM main_log QUALIFY row <= 20"),
        "scatter_top_correlates": sql(BASE + [("c", corr_rows), ("l", long_sc), ("rg", "SELECT \"column\", MIN(value) xmn, MAX(value) xmx, "
                                                                                   "MIN(y) ymn, MAX(y) ymx FROM l GROUP BY 1")],
                                      f"SELECT \"column\", {bucket('value', 'xmn', 'xmx', 50)} AS x_bin, "
                                      f"{bucket('y', 'ymn', 'ymx', 50)} AS y_bin, COUNT(*) AS n FROM l JOIN rg USING (\"column\") "
                                      "WHERE \"column\" IN (SELECT \"column\" FROM c ORDER BY abs(corr) DESC NULLS LAST, \"column\" LIMIT 3) GROUP BY 1, 2, 3"),
        "columns_by_kind": sql(BASE_STORES, " UNION ALL ".join(
            f"SELECT '{kind}' AS kind, '{c}' AS \"column\", COUNT({c}) AS n FROM main_stores WHERE is_train = 1" for kind, c in COLUMN_KINDS)),
        "sketch_profile": sql(BASE, " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_null, COUNT(DISTINCT {c}) AS n_distinct, TRUE AS within_error "
            f"FROM main_log WHERE date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'" for c in prof_cols if c != "date")),
        "daily_stats_two_columns": sql(two_columns_ctes("family"), select_rounded(
            "dsd", daily_stats_names("family") + daily_stats_names("family", "onpromotion"), ["date", "family"])),
        "top_categories": sql(BASE_STORES + [("l", long_cat), ("cnt", "SELECT \"column\", value, COUNT(*) AS n "
                                                                      "FROM l GROUP BY 1, 2")],
                              "SELECT \"column\", value, n, CAST(ROW_NUMBER() OVER (PARTITION BY \"column\" "
                              "ORDER BY n DESC, value) AS INTEGER) AS rank FROM cnt QUALIFY rank <= 20"),
    }


def boosted_stumps_sql() -> str:
    """Boosting of stumps on two yes/no features, stated over their four cells: each round takes the feature whose
    two group means explain more of the targets (the label, later twice the residual) and adds them times the step."""
    from tillroll.plans.queries import SMOKE_DAYS, STUMP_ROUNDS, STUMP_STEP
    pick = lambda c: f"max(CASE WHEN cell = {c} THEN {{}} END)"
    cells = ", ".join(f"{pick(c).format(x)} AS {x}{c}" for c in range(4) for x in ("n", "s", "m", "v"))
    total = "vq + " + " + ".join(f"(coalesce(m{c}, 0) * f{c} * f{c} - 2 * f{c} * coalesce(v{c}, 0))" for c in range(4))
    mean = {"a0": "(t0 + t1) / (n0 + n1)", "a1": "(t2 + t3) / (n2 + n3)", "b0": "(t0 + t2) / (n0 + n2)", "b1": "(t1 + t3) / (n1 + n3)"}
    step = ", ".join(f"f{c} + w * CASE WHEN first THEN {mean[f'a{c // 2}']} ELSE {mean[f'b{c % 2}']} END AS f{c}" for c in range(4))
    targets = ", ".join(f"CASE WHEN round = 0 THEN s{c} ELSE 2 * (s{c} - n{c} * f{c}) END AS t{c}" for c in range(4))
    gain = "((t0 + t1) * {a0} + (t2 + t3) * {a1}) >= ((t0 + t2) * {b0} + (t1 + t3) * {b1})".format(**mean)
    keep = ", ".join(f"{x}{c}" for c in range(4) for x in ("n", "s", "m", "v"))
    return sql(BASE, "").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ", " + (
        f"x AS (SELECT 2 * (store_nbr % 2) + CAST(dayofweek(date) IN (0, 6) AS INT) AS cell, log_sales AS y, "
        f"date_diff('day', date, max(date) OVER ()) < {SMOKE_DAYS} AS held FROM main_log WHERE is_train = 1 AND log_sales IS NOT NULL), "
        f"g AS (SELECT cell, CAST(count(*) FILTER (NOT held) AS DOUBLE) AS n, sum(y) FILTER (NOT held) AS s, "
        f"CAST(count(*) FILTER (held) AS DOUBLE) AS m, sum(y) FILTER (held) AS v, sum(y * y) FILTER (held) AS q FROM x GROUP BY cell), "
        f"c AS (SELECT {cells}, sum(q) AS vq, sum(m) AS held FROM g), "
        f"b AS (SELECT 0 AS round, 0.0::DOUBLE AS f0, 0.0::DOUBLE AS f1, 0.0::DOUBLE AS f2, 0.0::DOUBLE AS f3, * FROM c UNION ALL "
        f"SELECT round + 1, {step}, {keep}, vq, held FROM (SELECT *, {gain} AS first, CASE WHEN round = 0 THEN 1 ELSE {STUMP_STEP} END AS w "
        f"FROM (SELECT *, {targets} FROM b WHERE round < {STUMP_ROUNDS}))), "
        f"e AS (SELECT round, ({total}) / held AS mse FROM b WHERE round > 0) "
        f"SELECT CAST(round AS INT) AS round, {r('mse', 'mse')}, round = (SELECT arg_min(round, mse) FROM e) AS kept FROM e")


def registry_models() -> dict[str, str]:
    """Results with a known answer: ids, slots of sorted domains, and losses below the constant predictor's."""
    from tillroll.plans.queries import PENALTY, SMOKE_FOLDS, SMOKE_TRIALS
    sub = registry_eval()
    slots = ", ".join(f"COALESCE((SELECT slot FROM d WHERE d.c = '{g}' AND d.v = CAST(ms.{g} AS VARCHAR)), "
                      f"(SELECT COUNT(*) FROM d WHERE d.c = '{g}')) AS {g}_slot" for g in GROUPS)
    known = " + ".join(f"(SELECT COUNT(*) FROM d WHERE d.c = '{g}' AND d.v = CAST(ms.{g} AS VARCHAR))" for g in GROUPS)
    domain = " UNION ALL ".join(f"SELECT '{g}' AS c, CAST({g} AS VARCHAR) AS v FROM main_stores WHERE is_train = 1 "
                                "GROUP BY ALL" for g in GROUPS)
    return {
        "sample_fact": sql(BASE, f"SELECT {MAIN_COLS_ROUNDED} FROM main_log WHERE substr(md5(CAST(id AS VARCHAR) || ':42'), "
                                 f"1, 8) < '{int(0.1 * (1 << 32)):08x}'"),
        "encode_features": sql(BASE_STORES + [
            ("dv", domain), ("d", "SELECT c, v, CAST(ROW_NUMBER() OVER (PARTITION BY c ORDER BY v) - 1 AS INTEGER) AS slot "
                                  "FROM dv")],
            "SELECT id, " + ", ".join(f"CAST({g}_slot AS INTEGER) AS {g}_slot" for g in sorted(GROUPS))
            + f", CAST(known + onpromotion AS DOUBLE) AS feature_sum FROM (SELECT ms.id, ms.onpromotion, {slots}, {known} AS known "
              "FROM main_stores ms)"),
        "fit_gbt": sql([("main", None)], "SELECT id, TRUE AS predicted, TRUE AS beats_constant FROM main WHERE is_test = 1"),
        "early_stopping": boosted_stumps_sql(),
        "penalised_leaves": sql(BASE, "SELECT CAST(store_nbr % 2 AS DOUBLE) AS odd_store, CAST(ROUND(CAST(any_value(base) + SUM(log_sales - base) / (COUNT(*) + "
                                      f"{PENALTY}) AS DECIMAL(38,8)), 6) AS DOUBLE) AS prediction, COUNT(*) AS n FROM (SELECT *, AVG(log_sales) OVER () "
                                      "AS base FROM main_log WHERE is_train = 1 AND log_sales IS NOT NULL) GROUP BY 1"),
        "model_roundtrip": sql([("main", None)], "SELECT id, TRUE AS equal FROM main WHERE is_test = 1"),
        "tune": sql([("main", None)], f"SELECT CAST(i AS INTEGER) AS trial_id, 'gbt' AS study, {SMOKE_FOLDS} AS n_folds, "
                    f"COUNT(*) > 0 AS defined_loss, TRUE AS fitted_rounds_recorded FROM range({SMOKE_TRIALS}) t(i), main "
                    "WHERE is_train = 1 GROUP BY i"),
        "train_best": sql([("main", None)], "SELECT 0 AS seed, COUNT(*) > 0 AS beats_constant FROM main WHERE is_train = 1"),
        "chunked_boosting": sql([("main", None)], "SELECT CAST(i AS INTEGER) AS chunk, COUNT(*) > 0 AS beats_constant "
                                                  "FROM range(10) t(i), main WHERE is_train = 1 GROUP BY i"),
        "trials_append": sql(scored_ctes() + fold_ctes() + [("trials", trials_sql())],
                             f"SELECT CAST(trial_id AS INTEGER) AS trial_id, 'predictor' AS study, predictor AS params, "
                             f"{rexpr('loss')} AS loss, {FOLDS} AS n_folds FROM trials"),
        "write_submission": sub["submission"],
    }


def registry() -> dict[str, str]:
    o: dict[str, str] = {}
    o.update(registry_core())
    o.update(registry_series())
    o.update(registry_sources())
    o.update(registry_variants())
    o.update(registry_eval())
    o.update(registry_models())
    return o
