"""Run the pipeline from raw CSV files to a trained and evaluated model.

    python -m rebasket --raw data/raw --root out
    python -m rebasket --raw data/raw --root out --check-drift
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from rebasket.config import DEFAULT_STAGES, DEMO_TRAINING, STAGES, TrainingConfig
from rebasket.plans.pipeline import Job, retrain_if_drifted, run
from rebasket.session import configure


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rebasket", description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True, help="folder of the CSV files")
    parser.add_argument("--root", required=True, help="folder for tables, models and metrics")
    parser.add_argument("--records", help="JSON records for the deployment stage")
    parser.add_argument("--json-list", action="store_true", help="records are one JSON list per file")
    parser.add_argument("--stages", nargs="+", choices=STAGES, default=list(DEFAULT_STAGES))
    parser.add_argument("--demo", action="store_true", help="settings for a small sample")
    parser.add_argument("--max-rows", type=int, help="train on so many rows only")
    parser.add_argument("--resume", action="store_true", help="skip stages that are finished")
    parser.add_argument(
        "--check-drift", action="store_true", help="run only if the last metrics have drifted"
    )
    return parser.parse_args(arguments)


def job_of(options: argparse.Namespace) -> Job:
    training = DEMO_TRAINING if options.demo else TrainingConfig(max_rows=options.max_rows)
    return Job(
        raw=options.raw,
        root=options.root,
        records=options.records,
        records_are_arrays=options.json_list,
        stages=tuple(options.stages),
        training=training,
    )


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    spark = configure(SparkSession.builder.appName("rebasket").getOrCreate())
    if options.check_drift:
        ran = retrain_if_drifted(spark, job_of(options))
        print("pipeline has run" if ran else "model stable, nothing to do")
        return
    for stage, result in run(spark, job_of(options), resume=options.resume, clean=True).items():
        print(f"{stage}: {'skipped' if result is None else getattr(result, 'metrics', result)}")


if __name__ == "__main__":
    main()
