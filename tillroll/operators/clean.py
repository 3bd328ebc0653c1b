"""Cleaning, flags and projections of the fact and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.calendar import parse_date

# Columns that are never model features, and the target column.
NON_FEATURES = ("id", "date", "is_train", "is_test", "sales", "log_sales")
TARGET_COL = "log_sales"


def combine_train_test(train: DataFrame, test: DataFrame, id_col: str = "id",
                       disjoint_ids: bool = True):
    """Union train and test (missing columns -> null) with ``is_train`` / ``is_test``.

    With ``disjoint_ids`` (ids unique across the two files) membership equals the
    side a row came from, so the flags are literals tagged before the union and no
    id list is built.  Otherwise membership is looked up with left joins on the
    distinct ids of each side.  Returns (main, train_ids, test_ids); the id sets
    stay distributed DataFrames.
    """
    train_ids = train.select(id_col)
    test_ids = test.select(id_col)
    if disjoint_ids:
        main = (train.withColumn("is_train", F.lit(1)).withColumn("is_test", F.lit(0))
                .unionByName(test.withColumn("is_train", F.lit(0)).withColumn("is_test", F.lit(1)),
                             allowMissingColumns=True))
    else:
        both = train.unionByName(test, allowMissingColumns=True)
        tr = train_ids.distinct().withColumn("is_train", F.lit(1))
        te = test_ids.distinct().withColumn("is_test", F.lit(1))
        main = (both.join(tr, id_col, "left").join(te, id_col, "left")
                .withColumn("is_train", F.coalesce("is_train", F.lit(0)))
                .withColumn("is_test", F.coalesce("is_test", F.lit(0))))
    return main, train_ids, test_ids


def clean_main(main: DataFrame, date_col: str = "date") -> DataFrame:
    """Typed dates (strings parsed as yyyy-MM-dd)."""
    if dict(main.dtypes).get(date_col) == "string":
        main = main.withColumn(date_col, parse_date(date_col))
    return main


def add_log_target(main: DataFrame, value_col: str = "sales", log_col: str = "log_sales") -> DataFrame:
    return main.withColumn(log_col, F.log1p(F.col(value_col)))


def process_main(main: DataFrame) -> DataFrame:
    return add_log_target(clean_main(main))


STORE_COLUMNS = ("store_nbr", "city", "state", "type", "cluster")


def process_stores(stores: DataFrame) -> DataFrame:
    """Store dimension, typed; the feature step adds nothing."""
    return stores.select(*STORE_COLUMNS)


def clean_holidays_events(h: DataFrame, date_col: str = "date") -> DataFrame:
    """A celebrated transfer counts as a holiday; ``transferred`` is kept as is."""
    h = h.withColumn("type", F.when(F.col("type") == "Transfer", F.lit("Holiday"))
                     .otherwise(F.col("type")))
    if dict(h.dtypes).get(date_col) == "string":
        h = h.withColumn(date_col, parse_date(date_col))
    return h


def get_train(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_train") == 1)


def get_test(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_test") == 1)


def get_features(df: DataFrame, non_features: Sequence[str] = NON_FEATURES) -> DataFrame:
    return df.drop(*non_features)


def get_targets(df: DataFrame, target: str = TARGET_COL) -> DataFrame:
    return df.select(target)


def apply_categories(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Values outside a column's category list become null (see ``sources.catmeta``)."""
    from tillroll.sources.catmeta import apply_cat_meta
    return apply_cat_meta(df, categories)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42, id_col: str = "id") -> DataFrame:
    """A seeded sample without replacement: rows whose md5 of id and seed falls below the fraction.

    The choice depends on the row alone, not on partitions or their order, so it
    is the same on every cluster and when a lost task runs again.
    """
    if fraction >= 1.0:
        return df
    below = f"{int(fraction * (1 << 32)):08x}"
    return df.where(F.substring(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed)))), 1, 8) < below)


def columns_matching(df: DataFrame, contains: str | None = None, prefix: str | None = None,
                     regex: str | None = None) -> list[str]:
    """Column names selected by substring, prefix or regular expression (schema only)."""
    import re
    out = []
    for c in df.columns:
        if contains is not None and contains not in c:
            continue
        if prefix is not None and not c.startswith(prefix):
            continue
        if regex is not None and not re.search(regex, c):
            continue
        out.append(c)
    return out


def columns_of_type(df: DataFrame, numeric: bool) -> list[str]:
    """Numeric columns (``numeric=True``) or the others; read from the schema only."""
    from tillroll.operators.joins import is_numeric
    return [c for c, t in df.dtypes if is_numeric(t) == numeric]
