"""Job 4: models + test window -> submission CSV per seed (id, sales).

    python -m tillroll.plans.score --manifest M --models DIR --out DIR --start 2017-08-16 --end 2017-08-31
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.operators import model
from tillroll.session import job_session
from tillroll.sources import files
from tillroll.sources.manifest import load_and_merge_from_manifest


def run(spark: SparkSession, manifest_path: str, models_dir: str, out_dir: str, start_date: str,
        end_date: str, study: str = "gbt", n_seeds: int = 1, chunks: int | None = None) -> list[str]:
    """Score the test rows of the date window; ``chunks`` loads chunked boosters."""
    df = load_and_merge_from_manifest(spark, manifest_path, start_date=start_date, end_date=end_date)
    paths = []
    for seed in range(n_seeds):
        if chunks:
            booster = model.ChunkedBooster.load(os.path.join(models_dir, f"{study}_chunked_{seed}"), chunks)
            sub = booster.transform(df.where(F.col("is_test") == 1)).select(
                F.col("id").cast("long").alias("id"), F.expm1("prediction").alias("sales"))
        else:
            m = model.load_model(os.path.join(models_dir, f"{study}_model_{seed}"))
            sub = model.predict_submission(m, df)
        path = os.path.join(out_dir, f"{study}_submission_{seed}")
        files.write_csv(sub, path)
        paths.append(path)
    return paths


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--manifest", required=True)
    ap.add_argument("--models", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--start", required=True)
    ap.add_argument("--end", required=True)
    ap.add_argument("--study", default="gbt")
    ap.add_argument("--n-seeds", type=int, default=1)
    ap.add_argument("--chunks", type=int, help="number of chunk models (chunked boosters)")
    a = ap.parse_args(argv)
    spark = job_session("tillroll-score")
    run(spark, a.manifest, a.models, a.out, a.start, a.end, a.study, a.n_seeds, a.chunks)


if __name__ == "__main__":
    main()
