"""Column builders: pure functions from ``Column`` to ``Column`` (all JVM-side)."""

from tillroll.functions.calendar import (  # noqa: F401
    day_name, days_since_15th, days_since_last, days_since_paycheck, is_weekend, parse_date)
from tillroll.functions.numeric import (  # noqa: F401
    expm1, log1p, pct_change_from, safe_ratio)
from tillroll.functions.stats import (  # noqa: F401
    DEFAULT_QUANTILES, DEFAULT_STATS, stat_name, stats_exprs)
