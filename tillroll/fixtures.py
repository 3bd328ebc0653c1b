"""Retail views over the driver's star-schema tables.

The test data holds no retail-sales files, so the four raw inputs of the
workload are derived from the TPC-H-like tables (definitions in FIXTURES.md §3):

* ``main``             daily sales per (date, supplier-as-store, brand-as-family)
* ``stores``           supplier dimension with city / state / type / cluster
* ``oil``              weekday price series with one leading gap
* ``holidays_events``  event calendar from the urgent orders

Each view is written with the DataFrame API so Catalyst prunes columns and
pushes filters into the Parquet scans; ``FIXTURE_SQL`` holds the same
definitions as SQL text for DuckDB oracles.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The last 16 days (after this date) play the test set.
TEST_START_EXCLUSIVE = "2001-07-16"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def main_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact table: one row per (date, store_nbr, family) with sales and flags."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                .join(part, li.l_partkey == part.p_partkey))
    daily = (joined.groupBy(
                F.col("o_orderdate").cast("date").alias("date"),
                F.col("l_suppkey").alias("store_nbr"),
                F.col("p_brand").alias("family"),
                F.substring("p_brand", 7, 1 << 20).cast("int").alias("brand_no"))
             .agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("s"),
                  F.count(F.when(F.col("l_discount") >= 0.05, 1)).alias("onpromotion")))
    is_test = F.col("date") > F.lit(TEST_START_EXCLUSIVE).cast("date")
    day_key = (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).cast("bigint")
    return daily.select(
        (day_key * 10000000 + F.col("store_nbr") * 100 + F.col("brand_no")).alias("id"),
        "date", "store_nbr", "family", "onpromotion",
        F.when(is_test, F.lit(None).cast("double")).otherwise(F.col("s").cast("double")).alias("sales"),
        F.when(is_test, F.lit(0)).otherwise(F.lit(1)).alias("is_train"),
        F.when(is_test, F.lit(1)).otherwise(F.lit(0)).alias("is_test"))


def stores_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    bal = F.col("s_acctbal")
    store_type = (F.when(bal < 1000, "A").when(bal < 3000, "B").when(bal < 5000, "C")
                  .when(bal < 7500, "D").otherwise("E"))
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").alias("store_nbr"), F.col("n_name").alias("city"),
                     F.col("r_name").alias("state"), store_type.alias("type"),
                     (F.col("s_suppkey") % 17 + 1).cast("int").alias("cluster")))


def oil_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday price series; the first observed day is blanked to exercise the back fill."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    d = F.col("o_orderdate").cast("date")
    daily = (o.where(~F.substring(F.dayname(d), 1, 3).isin("Sat", "Sun"))
              .groupBy(d.alias("date"))
              .agg(F.round(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double")
                           / F.count(F.lit(1)) / 1000, 2).alias("price")))
    # The series has one row per weekday (bounded by the calendar, not by the
    # orders table), so a window over all of it is small and keeps one scan.
    first_day = F.min("date").over(Window.partitionBy())
    return daily.select("date", F.when(F.col("date") == first_day, F.lit(None).cast("double"))
                        .otherwise(F.col("price")).alias("dcoilwtico"))


def holidays_events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Fixed value: every urgent order is an event row.
    events = o.where(F.col("o_orderpriority") == "1-URGENT")
    j = (events.join(c, events.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
               .join(r, n.n_regionkey == r.r_regionkey))
    nk = F.col("c_nationkey") % 3
    return j.select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(F.col("o_orderstatus") == "F", "Holiday").when(F.col("o_orderstatus") == "O", "Transfer")
         .otherwise("Additional").alias("type"),
        F.when(nk == 0, "National").when(nk == 1, "Regional").otherwise("Local").alias("locale"),
        F.when(nk == 0, "ALL").otherwise(F.col("r_name")).alias("locale_name"),
        F.col("o_orderpriority").alias("description"),
        (F.col("o_orderkey") % 7 == 0).alias("transferred"))


VIEWS = {
    "main": main_view,
    "stores": stores_view,
    "oil": oil_view,
    "holidays_events": holidays_events_view,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)


# The same four views as SQL text (DuckDB and Spark SQL both accept it).
FIXTURE_SQL = {
    "main": """
SELECT CAST(year(date)*10000+month(date)*100+day(date) AS BIGINT)*10000000 + store_nbr*100 + brand_no AS id,
       date, store_nbr, family, onpromotion,
       CASE WHEN date > DATE '2001-07-16' THEN NULL ELSE CAST(s AS DOUBLE) END AS sales,
       CASE WHEN date > DATE '2001-07-16' THEN 0 ELSE 1 END AS is_train,
       CASE WHEN date > DATE '2001-07-16' THEN 1 ELSE 0 END AS is_test
FROM (SELECT CAST(o_orderdate AS DATE) AS date, l_suppkey AS store_nbr, p_brand AS family,
             CAST(substr(p_brand, 7) AS INT) AS brand_no,
             SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS s,
             COUNT(CASE WHEN l_discount >= 0.05 THEN 1 END) AS onpromotion
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      GROUP BY 1, 2, 3, 4) t""",
    "stores": """
SELECT s_suppkey AS store_nbr, n_name AS city, r_name AS state,
       CASE WHEN s_acctbal < 1000 THEN 'A' WHEN s_acctbal < 3000 THEN 'B' WHEN s_acctbal < 5000 THEN 'C'
            WHEN s_acctbal < 7500 THEN 'D' ELSE 'E' END AS type,
       CAST(s_suppkey % 17 + 1 AS INT) AS cluster
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "oil": """
SELECT date, CASE WHEN date = MIN(date) OVER () THEN NULL ELSE price END AS dcoilwtico
FROM (SELECT CAST(o_orderdate AS DATE) AS date,
             ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) / 1000, 2) AS price
      FROM orders WHERE substr(dayname(CAST(o_orderdate AS DATE)), 1, 3) NOT IN ('Sat', 'Sun')
      GROUP BY 1) t""",
    "holidays_events": """
SELECT CAST(o_orderdate AS DATE) AS date,
       CASE o_orderstatus WHEN 'F' THEN 'Holiday' WHEN 'O' THEN 'Transfer' ELSE 'Additional' END AS type,
       CASE c_nationkey % 3 WHEN 0 THEN 'National' WHEN 1 THEN 'Regional' ELSE 'Local' END AS locale,
       CASE c_nationkey % 3 WHEN 0 THEN 'ALL' ELSE r_name END AS locale_name,
       o_orderpriority AS description, o_orderkey % 7 = 0 AS transferred
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
WHERE o_orderpriority = '1-URGENT'""",
}

