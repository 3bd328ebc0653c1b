"""Batch jobs and the registry of checked queries.

process_data  raw views -> cleaned tables, oil / holiday features, rolling feature
              tables, category metadata and the join manifest
tune          manifest -> assembled training frame -> backtested trials table
train         best trial -> GBT models (one per seed)
score         models + test window -> submission CSV
queries       one DataFrame-returning callable per operator (driver contract)
oracles       DuckDB SQL for the same keys
"""
