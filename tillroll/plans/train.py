"""Job 3: best trial -> one GBT model per seed, saved as Spark ML pipelines.

    python -m tillroll.plans.train --manifest M --trials T --models DIR [--n-seeds 1 --sample-frac 0.1 --n-iter 10]
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.operators import model
from tillroll.session import job_session
from tillroll.sources.manifest import load_and_merge_from_manifest


def run(spark: SparkSession, manifest_path: str, trials_path: str, models_dir: str, study: str = "gbt",
        n_seeds: int = 1, sample_frac: float = 0.1, n_iter: int = 10, continue_boosting: bool = False):
    """[(seed, path, loss)]; the loss is one value, or one for each chunk of a continued booster."""
    trials = model.load_trials(spark, trials_path).where(F.col("study") == study)
    hp = model.best_params(trials)

    def sampled(fraction: float, seed: int):  # the fact is sampled before any table is joined to it
        return load_and_merge_from_manifest(spark, manifest_path, sample=fraction, seed=seed)

    out = []
    if continue_boosting:
        for seed in range(n_seeds):
            booster, losses = model.train_chunked(None, hp, seed, sample_frac, n_iter, sampled=sampled)
            path = os.path.join(models_dir, f"{study}_chunked_{seed}")
            booster.save(path)
            out.append((seed, path, losses))
        return out
    for seed, m, rmse in model.train_best(None, hp, n_seeds, sample_frac, n_iter, sampled=sampled):
        path = os.path.join(models_dir, f"{study}_model_{seed}")
        model.save_model(m, path)
        out.append((seed, path, rmse))
    return out


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--manifest", required=True)
    ap.add_argument("--trials", required=True)
    ap.add_argument("--models", required=True)
    ap.add_argument("--study", default="gbt")
    ap.add_argument("--n-seeds", type=int, default=1)
    ap.add_argument("--sample-frac", type=float, default=0.1)
    ap.add_argument("--n-iter", type=int, default=10)
    ap.add_argument("--continue-boosting", action="store_true",
                    help="n_iter chunk models on fresh samples, each fit to the residual so far")
    a = ap.parse_args(argv)
    spark = job_session("tillroll-train")
    run(spark, a.manifest, a.trials, a.models, a.study, a.n_seeds, a.sample_frac, a.n_iter,
        a.continue_boosting)


if __name__ == "__main__":
    main()
