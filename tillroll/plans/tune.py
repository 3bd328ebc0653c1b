"""Job 2: manifest -> assembled training frame -> backtested trials table.

    python -m tillroll.plans.tune --manifest M --trials T [--n-trials 5 --n-backtests 8 --valset-size 16]
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from tillroll.operators import clean, model
from tillroll.session import job_session
from tillroll.sources.manifest import load_and_merge_from_manifest


def run(spark: SparkSession, manifest_path: str, trials_path: str, n_trials: int = 5, n_backtests: int = 8,
        valset_size: int = 16, n_jobs: int = 1, study: str = "gbt", seed: int = 42,
        max_rounds: int | None = None, sample: float = 1.0, **plugins):
    """``max_rounds`` narrows the search space; ``plugins`` are ``model.tune``'s (space, model_builder, loss_fn)."""
    df = clean.get_train(load_and_merge_from_manifest(spark, manifest_path, sample=sample, seed=seed))
    # every fold of every trial filters this frame: keep it (spilling to disk if needed)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if max_rounds is not None:
        plugins.setdefault("space", model.with_rounds(max_rounds))
    try:
        return model.tune(df, n_trials, trials_path, study, seed, n_backtests, valset_size, n_jobs, **plugins)
    finally:
        df.unpersist()


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--manifest", required=True)
    ap.add_argument("--trials", required=True)
    ap.add_argument("--n-trials", type=int, default=5)
    ap.add_argument("--n-backtests", type=int, default=8)
    ap.add_argument("--valset-size", type=int, default=16)
    ap.add_argument("--n-jobs", type=int, default=1)
    ap.add_argument("--study", default="gbt")
    ap.add_argument("--max-rounds", type=int, help="upper bound of n_estimators in the search space")
    a = ap.parse_args(argv)
    spark = job_session("tillroll-tune")
    run(spark, a.manifest, a.trials, a.n_trials, a.n_backtests, a.valset_size, a.n_jobs, a.study,
        max_rounds=a.max_rounds)


if __name__ == "__main__":
    main()
