"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import fixtures
from tillroll.operators.clean import add_log_target
from tillroll.operators.joins import main_stores_join

# Fixed value: decimals kept when comparing floating results with the oracle.
DECIMALS = 4

# The grouping keys of the rolling features.
GROUPS = ("store_nbr", "family", "city", "state", "type", "cluster")


# The holiday labels of the fixture calendar: (locale, locale_name, type) combinations.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
HOLIDAY_COMBOS = sorted(
    f"combo_('{locale}', '{name}', '{kind}')" for kind in ("Additional", "Holiday")
    for locale, name in [("National", "ALL"), *((x, r) for x in ("Regional", "Local") for r in REGIONS)])


# Fixed value: doubles from here on are compared as whole numbers.
WHOLE = 1e9
# Distance from a tie, in units of the last place, beyond which a double's nearest whole number of places
# is taken straight, and the number of places up to which a double resolves that distance.
NEAR_TIE, PLACES = 0.01, 1e12


def round_half_up(c, decimals: int = DECIMALS):
    """Round a double half-up at ``decimals`` through DECIMAL(38, decimals + 2).

    The intermediate decimal absorbs last-bit differences of floating sums, so
    exact ties (e.g. a mean of 2-decimal money over 8 rows) round the same way
    in every engine.  A double of ``WHOLE`` or more has no room for them and is
    rounded to a whole number; NaN and infinities pass through.

    That decimal costs an object a value, so only values near a tie take it: the
    two roundings move a value by less than ``NEAR_TIE`` of the last place, and
    off a tie the nearest whole number of places is the same either way.
    """
    special = F.isnan(c) | (F.abs(c) == float("inf"))
    scaled = c.cast("double") * F.lit(10.0 ** decimals)
    clear = (F.abs(scaled) < PLACES) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > NEAR_TIE)
    nearest = F.floor(scaled + F.lit(0.5)) / F.lit(10.0 ** decimals)
    exact = F.round(c.cast(f"decimal(38,{decimals + 2})"), decimals).cast("double")
    return F.when(special, c).when(clear, nearest).when(F.abs(c) >= WHOLE, F.round(c)).otherwise(exact)


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every double column (comparison-stable output).

    All columns are rounded as one array: a projection that repeats the expression for each of many columns compiles to a
    method too long for the JVM's compiler, which then interprets it for every row.
    """
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    if not doubles:
        return df
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in doubles])
    out = df.withColumn("_rounded", F.transform(values, lambda c: round_half_up(c, decimals)))
    place = {c: i for i, c in enumerate(doubles)}
    return out.select(*[F.col("_rounded")[place[c]].alias(c) if c in place else F.col(f"`{c}`") for c in df.columns])


def main_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned fact with ``log_sales``."""
    return add_log_target(fixtures.main_view(spark, sf_dir))


def main_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_stores_join(main_df(spark, sf_dir), fixtures.stores_view(spark, sf_dir))
