"""Run a job from its documents: ``spark-submit -m`` or ``python -m sluiceway``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from sluiceway.plans.job import Job
from sluiceway.plans.runner import run_job

# The settings block that holds Spark's own configuration.
SPARK_SETTINGS = "spark-config"


def job_session(job: Job, name: str = "sluiceway") -> SparkSession:
    """A session with the settings the job's documents ask for."""
    builder = SparkSession.builder.appName(name)
    for key, value in job.settings(SPARK_SETTINGS).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sluiceway", description=__doc__)
    parser.add_argument("--process", required=True, help="process document, a JSON file")
    parser.add_argument("--shared", help="global document with connections, paths and Spark settings, a JSON file")
    parser.add_argument("--batch-id")
    parser.add_argument("--period")
    parser.add_argument("--run-id", help="tracking id for the run log; a new one unless given")
    parser.add_argument("--log-path", help="folder of the run log")
    parser.add_argument("--count-source", action="store_true", help="count the source's rows, a scan of its own")
    given = parser.parse_args(arguments)
    process = json.loads(Path(given.process).read_text(encoding="utf-8"))
    shared = json.loads(Path(given.shared).read_text(encoding="utf-8")) if given.shared else {}
    spark = job_session(Job(process, shared))
    result = run_job(
        spark,
        process,
        shared,
        batch_id=given.batch_id,
        period=given.period,
        log_path=given.log_path,
        count_source=given.count_source,
        run_id=given.run_id,
    )
    result.release()


if __name__ == "__main__":
    main()
