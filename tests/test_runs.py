"""Appending by run: re-runs, attempts that never counted, and columns that come and go."""

import pytest
from pyspark.sql import functions as F

from sluiceway.sinks.files import write_files
from sluiceway.sinks.runs import append_run, committed_runs, read_runs, remove_outdated


def _rows(spark, n, **more):
    return spark.range(n).select("id", (F.col("id") % 3).cast("string").alias("part"), *[F.lit(v).alias(k) for k, v in more.items()])


def _counts(spark, path):
    return {r.run_id: r["count"] for r in read_runs(spark, path).groupBy("run_id").count().collect()}


def test_a_run_appended_again_replaces_its_own_rows_only(spark, folder):
    path = f"{folder}/table"
    assert append_run(_rows(spark, 10), path, "a", "part") == 10
    assert append_run(_rows(spark, 7), path, "b", "part") == 7
    assert append_run(_rows(spark, 4), path, "a", "part") == 4
    assert _counts(spark, path) == {"a": 4, "b": 7}
    assert {r.run_id: r.rows for r in committed_runs(spark, path).collect()} == {"a": 4, "b": 7}
    assert read_runs(spark, path, ["b"]).count() == 7
    assert remove_outdated(spark, path) == 1 and _counts(spark, path) == {"a": 4, "b": 7}
    assert append_run(_rows(spark, 0), path, "a", "part") == 0
    assert _counts(spark, path) == {"b": 7}


def test_an_attempt_that_was_not_committed_is_not_read(spark, folder, monkeypatch):
    path = f"{folder}/table"
    append_run(_rows(spark, 5), path, "a")

    def dies(df, place, **options):
        write_files(df, place, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr("sluiceway.sinks.runs.write_files", dies)
    with pytest.raises(RuntimeError, match="lost"):
        append_run(_rows(spark, 50), path, "a")
    with pytest.raises(RuntimeError, match="lost"):
        append_run(_rows(spark, 50), path, "b")
    assert _counts(spark, path) == {"a": 5}
    assert remove_outdated(spark, path) == 2 and _counts(spark, path) == {"a": 5}


def test_columns_of_all_runs_and_refusals(spark, folder):
    path = f"{folder}/table"
    append_run(_rows(spark, 2, extra=1), path, "a")
    append_run(_rows(spark, 3, other="x"), path, "b")
    got = read_runs(spark, path)
    assert got.columns == ["run_id", "id", "part", "extra", "other"]
    assert got.where("run_id = 'b' AND extra IS NULL AND other = 'x'").count() == 3
    append_run(_rows(spark, 1, extra="text"), path, "c")
    with pytest.raises(TypeError, match="extra"):
        read_runs(spark, path)
    with pytest.raises(ValueError, match="already"):
        append_run(_rows(spark, 1, run_id="x"), path, "d")
    with pytest.raises(ValueError, match="id"):
        append_run(_rows(spark, 1), path, "")
    with pytest.raises(FileNotFoundError):
        read_runs(spark, path, ["nowhere"])
