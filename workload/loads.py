"""Whole jobs: fan-out, tolerated errors, run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators.protection import decrypt_columns, protection_methods
from sluiceway.plans.runner import run_job
from sluiceway.sinks.staging import staging_folder
from sluiceway.sources.files import read_delimited, read_parquet
from workload.registry import EXAMPLE_KEY, query, table, write_batch


def _file_load(bucket: str, name: str, transform_id: str | None = None, **props: object) -> dict:
    load = {"load_type": "S3", "load_properties": {"bucket": bucket, "name": name, **props}}
    return load if transform_id is None else {"transform_id": transform_id, **load}


def protected_orders(spark, sf_dir):
    """A whole job on orders: two transforms, hashed keys, files by order status."""
    bucket = staging_folder(spark, "orders")
    job = {
        "process_modules": [
            {
                "transform": [
                    {"transform_id": "1", "transform_sql": "SELECT * FROM {{SOURCE_INPUT}} WHERE o_totalprice > 1000"},
                    {
                        "transform_id": "2",
                        "transform_sql": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM tx_1",
                    },
                ]
            },
            {
                "load": [
                    _file_load(
                        bucket,
                        "orders_abc",
                        "2",
                        partition_by="o_orderstatus",
                        data_protect_columns={"type": "volt-sha-256", "columns": "o_custkey"},
                    )
                ]
            },
        ]
    }
    run_job(spark, job, batch_id="4001", period="202510", base=table(spark, sf_dir, "orders"))
    return read_parquet(spark, f"{bucket}/orders_202510")


query(
    "job_protected_orders",
    """
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS o_custkey, o_orderstatus, o_totalprice
    FROM orders WHERE o_totalprice > 1000
    """,
)(protected_orders)


@query(
    "job_equal_transforms",
    """
    WITH t AS (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS latest FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
    SELECT 'first' AS load, * FROM t UNION ALL SELECT 'second', * FROM t UNION ALL SELECT 'many', * FROM t WHERE n > 5
    """,
)
def job_equal_transforms(spark, sf_dir):
    """Two transforms that say the same in other words are aggregated once, for two loads and a third transform."""
    bucket = staging_folder(spark, "equal")
    texts = {
        "first": "SELECT o_custkey, count(*) AS n, max(o_orderdate) AS latest FROM {{SOURCE_INPUT}} "
        "WHERE o_orderstatus <> 'P' GROUP BY o_custkey",
        "second": "select o.o_custkey, count(*) n, max(o.o_orderdate) latest from source_table o "
        "where o.o_orderstatus <> 'P' group by o.o_custkey",
        "many": "SELECT * FROM tx_second WHERE n > 5",
    }
    job = {
        "process_modules": [
            {
                "transform": [{"transform_id": i, "transform_sql": text} for i, text in texts.items()],
                "load": [_file_load(bucket, i, i) for i in texts],
            }
        ]
    }
    result = run_job(spark, job, batch_id="1", period="202510", base=table(spark, sf_dir, "orders"))
    assert result.frames["first"] is result.frames["second"]
    frames = [read_parquet(spark, f"{bucket}/{i}").select(F.lit(i).alias("load"), "o_custkey", "n", "latest") for i in texts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "job_fan_out",
    """
    SELECT 'base' AS load, o_orderkey, o_orderpriority FROM orders
    UNION ALL SELECT 'urgent', o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%'
    UNION ALL SELECT 'urgent csv', o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%'
    """,
)
def job_fan_out(spark, sf_dir):
    """Three loads: one of the base, two of one transform."""
    bucket = staging_folder(spark, "fan-out")
    job = {
        "process_modules": [
            {"load": [_file_load(bucket, "base")]},
            {
                "transform": [
                    {
                        "transform_id": "1",
                        "transform_sql": "SELECT o_orderkey, o_orderpriority FROM {{SOURCE_INPUT}} "
                        "WHERE o_orderpriority LIKE '1%'",
                    }
                ],
                "load": [
                    _file_load(bucket, "urgent", "1"),
                    _file_load(bucket, "urgent csv", "1", format="csv", delimiter="|"),
                ],
            },
        ]
    }
    run_job(spark, job, batch_id="1", period="202510", base=table(spark, sf_dir, "orders"))
    wanted = ["o_orderkey", "o_orderpriority"]
    frames = [
        read_parquet(spark, f"{bucket}/base").select(F.lit("base").alias("load"), *wanted),
        read_parquet(spark, f"{bucket}/urgent").select(F.lit("urgent").alias("load"), *wanted),
        read_delimited(spark, f"{bucket}/urgent csv", "o_orderkey bigint, o_orderpriority string", header=True).select(
            F.lit("urgent csv").alias("load"), *wanted
        ),
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "job_tolerated_error",
    "SELECT 'ok' AS status, 'good' AS target, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM part "
    "UNION ALL SELECT 'error', 'bad', NULL, 'AnalysisException'",
)
def job_tolerated_error(spark, sf_dir):
    """A load that fails and may fail is logged, and the next one runs."""
    bucket = staging_folder(spark, "tolerated")
    job = {
        "config_app": [{"name": "transform", "properties": {"parallelism": 1}}],
        "process_modules": [
            {
                "load": [
                    _file_load(bucket, "bad", mode="error", error_continue="y"),
                    _file_load(bucket, "good"),
                ]
            }
        ],
    }
    table(spark, sf_dir, "part").write.parquet(f"{bucket}/bad")
    result = run_job(spark, job, base=table(spark, sf_dir, "part"))
    target = F.element_at(F.split("target", "/"), -1).alias("target")
    return result.log().where("stage = 'load'").select("status", target, "rows", "error")


@query(
    "job_run_log",
    """
    SELECT 'extract' AS stage, count(*) AS rows FROM orders
    UNION ALL SELECT 'transform', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'transform', count(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'load', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'load', count(DISTINCT o_custkey) FROM orders
    """,
)
def job_run_log(spark, sf_dir):
    """Rows per stage, counted while the loads write."""
    bucket = staging_folder(spark, "log")
    job = {
        "process_modules": [
            {
                "transform": [
                    {"transform_sql": "SELECT * FROM {{SOURCE_INPUT}} WHERE o_orderstatus = 'F'"},
                    {"transform_sql": "SELECT o_custkey, count(*) AS n FROM {{SOURCE_INPUT}} GROUP BY o_custkey"},
                ],
                "load": [_file_load(bucket, "a", "1", partition_by="o_orderpriority"), _file_load(bucket, "b", "2")],
            }
        ]
    }
    base = table(spark, sf_dir, "orders")
    run_job(spark, job, batch_id="1", period="202510", base=base, log_path=f"{bucket}/log", count_source=True)
    return read_parquet(spark, f"{bucket}/log").select("stage", "rows")


@query(
    "job_batch_to_table",
    """
    SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, c_mktsegment, c_acctbal, '202510' AS fecinformacion
    FROM customer WHERE c_acctbal >= 0
    """,
)
def job_batch_to_table(spark, sf_dir):
    """Batch folder to catalog table: extract, transform, protect, period column."""
    from workload.sinks import _new_table

    columns = [
        {"name": "c_custkey", "data_type": "BIGINT", "order": "1"},
        {"name": "c_mktsegment", "data_type": "STRING", "order": "2"},
        {"name": "c_acctbal", "data_type": "DOUBLE", "order": "3"},
    ]
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    root = write_batch(rows, "77", "202510", {"format": "text", "columns": columns})
    schema, name = _new_table(
        spark, "c_custkey STRING, c_mktsegment STRING, c_acctbal DOUBLE, fecinformacion STRING", "fecinformacion"
    )
    job = {
        "process_modules": [
            {
                "transform": [{"transform_id": "t", "transform_sql": "SELECT * FROM {{SOURCE_INPUT}} WHERE c_acctbal >= 0"}],
                "load": [
                    {
                        "transform_id": "t",
                        "load_type": "athena",
                        "load_properties": {
                            "schema": schema,
                            "table": name,
                            "data_protect_columns": {"type": "sha-256", "columns": "c_custkey"},
                        },
                    }
                ],
            }
        ]
    }
    shared = {"config_app": [{"name": "paths", "properties": {"path_data_s3": " ", "path_data_onprem": root}}]}
    run_job(spark, job, shared, batch_id="77", period="202510")
    return spark.table(f"{schema}.{name}")


@query(
    "job_file_module",
    """
    SELECT doc_id, kind FROM (
      SELECT doc_id, source AS kind, count(*) OVER (PARTITION BY doc_id) AS n FROM documents
    ) WHERE n = 1 AND trim(kind) <> ''
    """,
)
def job_file_module(spark, sf_dir):
    """A described file: cleansing, header check, quality split, protection."""
    landing, bucket = staging_folder(spark, "landing"), staging_folder(spark, "accepted")
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "source AS KIND", "lang")
    rows.write.options(sep="|", header=True).csv(f"{landing}/docs_202510.txt")
    properties = {
        "format": "text",
        "path": landing,
        "name": "docs_abc",
        "extension": "txt",
        "delimiter": "|",
        "header": "y",
        "columns": "doc_id,kind,lang",
        "clean": {"type": "rules", "enabled_ind": "Y"},
        "reject": {"umbral": "10", "enabled_ind": "Y", "path": f"{bucket}/rejected"},
        "quality_integration": {"columns_key": "doc_id", "columns_critical": "doc_id,kind", "enabled_ind": "Y"},
        "data_protection": {"name_method": "cipher-a", "columns_sensitive": "kind", "enabled_ind": "Y"},
    }
    job = {
        "process_modules": [
            {"extract": [{"type": "file", "properties": properties}], "load": [_file_load(bucket, "accepted")]}
        ]
    }
    run_job(spark, job, period="202510", methods=protection_methods({"cipher-a": EXAMPLE_KEY}))
    opened = decrypt_columns(read_parquet(spark, f"{bucket}/accepted"), ["kind"], EXAMPLE_KEY)
    return opened.select(F.col("doc_id").cast("bigint").alias("doc_id"), "kind")
