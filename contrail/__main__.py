"""Command line for the batch stages: ``python -m contrail <stage> ...``.

Stages (inputs are CSV with the flight schema or Parquet tables):

  profile    --input raw.csv --out stats_dir
  prepare    --input raw.csv --out clean.parquet --order-by col ...
  relabel    --input clean.parquet --out v.parquet --rules v1|v2|v3|v4
  featurize  --input clean.parquet --out features.parquet
  train      --input features.parquet --out models_dir --runs runs.parquet [--version v] [--trees n --depth n]
  report     --input features.parquet --models models_dir --out report_dir
  compare    --old a.parquet --new b.parquet --out cmp.parquet
  evolution  --versions name=path ... --out versions.parquet

Every stage writes a new output; no input is modified in place.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, path: str) -> DataFrame:
    from contrail.sources import read_flights

    if path.endswith(".csv") or path.endswith(".csv.gz"):
        return read_flights(spark, path)
    return spark.read.parquet(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="contrail")
    p.add_argument("stage", choices=["profile", "prepare", "relabel", "featurize", "train", "report", "compare", "evolution"])
    p.add_argument("--input")
    p.add_argument("--out", required=True)
    p.add_argument("--order-by", nargs="*", default=[])
    p.add_argument("--rules", default="v1")
    p.add_argument("--models")
    p.add_argument("--runs")
    p.add_argument("--version")
    p.add_argument("--versions", nargs="*", default=[])
    p.add_argument("--old")
    p.add_argument("--new")
    p.add_argument("--key", default="flight_id")
    p.add_argument("--trees", type=int, help="trees of either model (default: as documented in operators/learn.py)")
    p.add_argument("--depth", type=int, help="depth of the trees")
    a = p.parse_args(argv)

    from contrail.operators import learn, sampling
    from contrail.plans import jobs
    from contrail.session import get_session
    from contrail.sources import union_versions, write_table

    spark = spark or get_session()
    if a.stage == "profile":
        jobs.profile_job(spark, _read(spark, a.input), a.out, a.input, a.key)
    elif a.stage == "prepare":
        jobs.prepare_job(_read(spark, a.input), a.out, a.key, a.order_by)
    elif a.stage == "relabel":
        seed, rules = sampling.RULE_SETS[a.rules]
        write_table(sampling.relabel(_read(spark, a.input), rules, a.key, seed), a.out)
    elif a.stage == "featurize":
        jobs.featurize_job(_read(spark, a.input), a.out, key=a.key)
    elif a.stage == "train":
        own = {k: v for k, v in (("n_estimators", a.trees), ("max_depth", a.depth)) if v}
        res = jobs.train_job(spark, _read(spark, a.input), a.out, a.runs or f"{a.out}/runs", a.key,
                             dict(learn.DELAY_PARAMS, **own), dict(learn.REASON_PARAMS, **own), a.version)
        print(res)
    elif a.stage == "report":
        jobs.report_job(spark, _read(spark, a.input), a.models, a.out, a.key)
    elif a.stage == "compare":
        versions = union_versions({"old": _read(spark, a.old), "new": _read(spark, a.new)})
        jobs.compare_job(versions, "old", "new", a.out)
    elif a.stage == "evolution":
        named = dict(v.split("=", 1) for v in a.versions)
        jobs.evolution_job(union_versions({n: _read(spark, path) for n, path in named.items()}), a.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
