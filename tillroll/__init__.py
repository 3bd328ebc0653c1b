"""tillroll: daily retail-demand feature engineering, backtesting and scoring on Spark.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is built from
built-in DataFrame / SQL / ML expressions so Catalyst plans the whole job.

Sub-packages
------------
sources     scans and sinks (CSV, Parquet, category metadata, manifests, submissions,
            models, trial tables)
functions   column builders (calendar features, percent change, statistics, naming)
operators   table-level operators (cleaning, densified totals, rolling features,
            holidays, series fill, joins, evaluation, models, profiling)
plans       the four batch jobs: process, tune, train, score
"""

__version__ = "0.1.0"
