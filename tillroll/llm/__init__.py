"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``benchmark``.

One module per operator; ``queries.py`` holds the registered ``opN_*`` queries
and ``oracles.py`` their DuckDB SQL.  Nothing outside this folder imports it
except ``corpus_pipeline.py`` and, behind a guard, ``__spark_entry__.py``.

The Python stages run as ``mapInArrow`` / ``mapInPandas`` tasks, so this package
has to be installed on the executors (or shipped with ``--py-files``).
"""
