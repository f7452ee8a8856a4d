import os
import tempfile
from glob import glob

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sluiceway.sinks.files import load_files, output_path, write_files
from sluiceway.sinks.staging import staging_folder, staging_root
from sluiceway.sinks.tables import load_table, register_partitions, table_columns, table_inventory, table_location


def rows(spark, n=100):
    return spark.range(n).select("id", (F.col("id") % 4).cast("string").alias("p"))


def data_files(path):
    return [f for f in glob(f"{path}/**/*", recursive=True) if os.path.isfile(f) and "part-" in f]


def test_output_path():
    assert output_path("s3://b/p/", "x_abc", "202510") == "s3://b/p/x_202510"
    assert output_path(" /b/ ") == "/b"
    for nothing in (None, " "):
        with pytest.raises(ValueError, match="bucket"):
            output_path(nothing)


def test_formats_and_codecs_are_checked_first(spark, folder):
    for file_format, codec in (("orcc", None), ("parquet", "bzip2"), ("csv", "zstd"), ("json", "nope")):
        with pytest.raises(ValueError):
            write_files(rows(spark), f"{folder}/x", file_format, compression=codec)
    assert not os.path.exists(f"{folder}/x")
    for file_format, codec in (("parquet", "lz4"), ("csv", "bzip2"), ("json", "deflate"), ("text", "gzip")):
        write_files(rows(spark), f"{folder}/{file_format}", file_format, compression=codec)
        assert data_files(f"{folder}/{file_format}")


def test_partition_gets_few_files_however_many_tasks_write(spark, folder):
    df = rows(spark).repartition(16)
    write_files(df, f"{folder}/few", partition_by=["p"])
    write_files(df, f"{folder}/many", partition_by=["p"], distribute=False)
    assert len(data_files(f"{folder}/few")) == 4 < len(data_files(f"{folder}/many"))


def test_a_hot_partition_value_is_split(spark, folder):
    """Nine rows in ten share a value; it is written by several tasks, and every row is there."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot"))
        df = spark.range(0, 300_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), hot.alias("p"))
        write_files(df, folder, partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(data_files(f"{folder}/p=hot")) > 4
    assert spark.read.parquet(folder).distinct().count() == 300_000


def test_partition_columns_that_are_missing(spark, folder):
    with pytest.warns(UserWarning, match="q"):
        write_files(rows(spark), folder, partition_by=["p", "q"])
    assert sorted(os.path.basename(d) for d in glob(f"{folder}/*=*")) == ["p=0", "p=1", "p=2", "p=3"]


def test_csv_options(spark, folder):
    write_files(rows(spark, 1).coalesce(1), f"{folder}/a", "csv", header=False, delimiter="~", extension="dat")
    (path,) = data_files(f"{folder}/a")
    assert path.endswith(".dat") and open(path).read() == "0~0\n"
    write_files(rows(spark, 1).coalesce(1), f"{folder}/b", "csv")
    assert open(data_files(f"{folder}/b")[0]).read() == "id,p\n0,0\n"


def test_text_rows_without_nulls(spark, folder):
    write_files(spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b"), folder, "text")
    assert open(data_files(folder)[0]).read() == '{"a":1}\n'


def last_plan(spark):
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return found.apply(found.size() - 1).physicalPlanDescription()


def counting(seen):
    return lambda df: df.observe(seen, F.count(F.lit(1)).alias("rows"))


def test_constant_partitions_are_neither_shuffled_nor_sorted(spark, folder, table):
    seen = Observation()
    load_files(rows(spark), {"bucket": f"{folder}/x", "auto_partition": "y"}, "1", "202510", tap=counting(seen))
    plan = last_plan(spark)
    assert "WriteFiles" in plan and "Sort" not in plan and "Exchange" not in plan
    assert seen.get["rows"] == 100
    seen = Observation()
    load_table(rows(spark), PROPS, "202510", tap=counting(seen))
    plan = last_plan(spark)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "Sort" in plan and "fecinformacion" not in plan.split("Sort")[1].split("]")[0]
    assert seen.get["rows"] == 100


def test_rows_per_file(spark, folder):
    write_files(rows(spark).coalesce(1), folder, rows_per_file=30)
    assert len(data_files(folder)) == 4


def test_auto_partition_skips_columns_that_exist(spark, folder):
    df = rows(spark).withColumn("batch_id", F.lit("9"))
    load_files(df, {"bucket": folder, "auto_partition": "y"}, batch_id="1", period="202510")
    assert [os.path.basename(d) for d in glob(f"{folder}/*=*")] == ["fecinformacion=202510"]
    assert spark.read.parquet(folder).select("batch_id").distinct().first()[0] == "9"


@pytest.fixture
def table(spark, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sink_test LOCATION '{folder}/db'")
    spark.sql("DROP TABLE IF EXISTS sink_test.t")
    spark.sql(
        "CREATE TABLE sink_test.t (id BIGINT, extra DATE, p STRING, fecinformacion STRING) USING parquet "
        f"PARTITIONED BY (p, fecinformacion) LOCATION '{folder}/t'"
    )
    yield "sink_test", "t"
    spark.sql("DROP TABLE sink_test.t")


PROPS = {"schema": "sink_test", "table": "t"}


def test_table_facts(spark, table, folder):
    assert [(n, part) for n, _, part in table_columns(spark, *table)] == [
        ("id", False), ("extra", False), ("p", True), ("fecinformacion", True),
    ]
    assert table_location(spark, *table).endswith(f"{folder}/t")
    assert [r.tableName for r in table_inventory(spark, "sink_test").collect()] == ["t"]


def test_table_append_and_overwrite(spark, table):
    assert load_table(rows(spark), PROPS, "202509") == "sink_test.t"
    load_table(rows(spark), PROPS, "202510")
    found = spark.table("sink_test.t")
    assert found.count() == 200 and found.where("extra IS NULL AND fecinformacion = '202510' AND p = '1'").count() == 25
    load_table(rows(spark, 8), PROPS | {"mode": "overwrite", "only_written_partitions": "y"}, "202510")
    assert spark.table("sink_test.t").count() == 108
    load_table(rows(spark, 8), PROPS | {"mode": "overwrite"}, "202510")
    assert spark.table("sink_test.t").count() == 8


def test_table_needs_its_partition_columns(spark, table):
    with pytest.raises(ValueError, match="partition columns"):
        load_table(rows(spark).drop("p"), PROPS, "202510")
    with pytest.raises(ValueError, match="partition columns"):
        load_table(rows(spark), PROPS, None)
    with pytest.raises(ValueError, match="schema"):
        load_table(rows(spark), {"table": "t"})


def test_one_partition_can_be_registered_by_name(spark, table, folder):
    rows(spark).drop("p").write.parquet(f"{folder}/t/p=z/fecinformacion=1")
    assert spark.table("sink_test.t").count() == 0
    register_partitions(spark, *table, {"p": "z", "fecinformacion": "1"})
    assert spark.table("sink_test.t").count() == 100
    register_partitions(spark, *table, {"p": "it's \\ odd", "fecinformacion": "1"})
    assert spark.sql("SHOW PARTITIONS sink_test.t").count() == 2


def test_staging_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = staging_folder(spark, "a"), staging_folder(spark, "a")
    assert first != second
    if named:
        assert first.startswith(named.rstrip("/") + "/")


class Session:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_no_machine_local_folder_on_a_cluster():
    assert staging_root(Session(**{"spark.checkpoint.dir": "s3://x/y/", "spark.master": "yarn"})) == "s3://x/y"
    assert staging_root(Session(**{"spark.master": "local[2]"})).startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError):
        staging_root(Session(**{"spark.master": "yarn"}))
