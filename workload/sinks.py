"""Sinks: written, read back, and compared with what should be there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.protection import decrypt_columns, encrypt_columns
from sluiceway.sinks.files import load_files, write_files
from sluiceway.sinks.jdbc import aligned_rows
from sluiceway.sinks.runs import append_run, read_runs
from sluiceway.sinks.staging import staging_folder
from sluiceway.sinks.tables import load_table, register_partitions, table_columns, table_location
from sluiceway.sources.files import read_delimited, read_parquet
from workload.registry import EXAMPLE_KEY, query, table


@query("sink_parquet", "SELECT * FROM lineitem")
def sink_parquet(spark, sf_dir):
    path = staging_folder(spark, "sink")
    write_files(table(spark, sf_dir, "lineitem"), path, compression="zstd")
    return read_parquet(spark, path)


@query("sink_csv", "SELECT * FROM customer")
def sink_csv(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    path = staging_folder(spark, "sink")
    write_files(rows, path, "csv", delimiter=";", compression="gzip")
    return read_delimited(spark, path, schema=rows.schema, delimiter=";", header=True)


@query("sink_json", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def sink_json(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    path = staging_folder(spark, "sink")
    write_files(rows, path, "json")
    return spark.read.schema(rows.schema).json(path)


@query("sink_text_rows", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_text_rows(spark, sf_dir):
    """Whole rows as JSON text, partitioned by one of their columns."""
    rows = table(spark, sf_dir, "documents")
    path = staging_folder(spark, "sink")
    write_files(rows, path, "text", partition_by=["lang"], compression="gzip")
    lines = spark.read.schema("value string, lang string").text(path)
    return lines.select(F.from_json("value", rows.schema).alias("row")).select("row.*")


@query("sink_delimited_text", "SELECT * REPLACE (sha256(o_orderstatus) AS o_orderstatus) FROM orders")
def sink_delimited_text(spark, sf_dir):
    """``text`` with a delimiter, header, extension and compression, as jobs declare it."""
    rows = table(spark, sf_dir, "orders")
    props = {
        "bucket": staging_folder(spark, "sink"),
        "name": "orders_abc",
        "format": "text",
        "extension": "csv",
        "delimiter": "|",
        "header": "y",
        "compression": "gzip",
        "data_protect_columns": {"type": "volt-sha-256", "columns": "o_orderstatus"},
    }
    path = load_files(rows, props, period="202510")
    return read_delimited(spark, path, schema=rows.schema, header=True)


@query("sink_partitioned", "SELECT * FROM orders")
def sink_partitioned(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    props = {"bucket": staging_folder(spark, "sink"), "partitions": ["o_orderstatus", "o_orderpriority", "unknown"]}
    return read_parquet(spark, load_files(rows, props), rows.schema)


@query("sink_partition_pruning", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def sink_partition_pruning(spark, sf_dir):
    """Only the folder of one partition value is read."""
    rows = table(spark, sf_dir, "orders")
    path = load_files(rows, {"bucket": staging_folder(spark, "sink"), "partition_by": "o_orderstatus"})
    return read_parquet(spark, path).where("o_orderstatus = 'F'")


@query("sink_auto_partition", "SELECT *, '0007' AS batch_id, '0202510' AS fecinformacion FROM supplier")
def sink_auto_partition(spark, sf_dir):
    """Batch and period become folders; declared on reading, they keep their zeros."""
    rows = table(spark, sf_dir, "supplier")
    props = {"bucket": staging_folder(spark, "sink"), "auto_partition": "Y"}
    path = load_files(rows, props, batch_id="0007", period="0202510")
    schema = T.StructType(rows.schema.fields).add("batch_id", "string").add("fecinformacion", "string")
    return read_parquet(spark, path, schema)


@query(
    "sink_period_name",
    """
    SELECT part.*, CASE half WHEN 0 THEN 'stock_202510' ELSE 'stock_of_202510_all' END AS folder
    FROM part CROSS JOIN (VALUES (0), (1)) h(half)
    """,
)
def sink_period_name(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    bucket = staging_folder(spark, "sink")
    paths = [
        load_files(rows, {"bucket": bucket, "name": name}, period="202510")
        for name in ("stock_ABC", "stock_of_{fecinfo}_all")
    ]
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return spark.read.parquet(*paths).select("*", folder.alias("folder"))


@query("sink_append", "SELECT * FROM nation UNION ALL SELECT * FROM nation")
def sink_append(spark, sf_dir):
    rows = table(spark, sf_dir, "nation")
    path = staging_folder(spark, "sink")
    for mode in ("overwrite", "append", "ignore"):
        write_files(rows, path, mode=mode)
    return read_parquet(spark, path)


@query("sink_overwrite", "SELECT r_regionkey, r_name FROM region")
def sink_overwrite(spark, sf_dir):
    path = staging_folder(spark, "sink")
    write_files(table(spark, sf_dir, "nation"), path)
    write_files(table(spark, sf_dir, "region"), path)
    return read_parquet(spark, path).select("r_regionkey", "r_name")


@query(
    "sink_overwrite_written_partitions",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'again' ELSE 'first' END AS run, o_orderstatus FROM orders
    """,
)
def sink_overwrite_written_partitions(spark, sf_dir):
    """A second run replaces only the partitions it writes."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("first").alias("run"), "o_orderstatus")
    props = {"bucket": staging_folder(spark, "sink"), "partition_by": "o_orderstatus", "only_written_partitions": "y"}
    load_files(rows, props)
    path = load_files(rows.where("o_orderstatus = 'F'").withColumn("run", F.lit("again")), props)
    return read_parquet(spark, path)


def _new_table(spark, columns: str, partitions: str) -> tuple[str, str]:
    """A new external table in the shared folder; its schema and name."""
    folder, schema, name = staging_folder(spark, "tables"), "sluiceway_check", f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{folder}/db'")
    spark.sql(
        f"CREATE TABLE {schema}.{name} ({columns}) USING parquet "
        f"PARTITIONED BY ({partitions}) LOCATION '{folder}/{name}'"
    )
    return schema, name


@query(
    "sink_catalog_table",
    """
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS o_custkey, CAST(NULL AS VARCHAR) AS note,
           period AS fecinformacion
    FROM orders CROSS JOIN (VALUES ('0202509'), ('0202510')) p(period)
    """,
)
def sink_catalog_table(spark, sf_dir):
    """Two periods appended; the period column is added, a missing one is NULL."""
    rows = table(spark, sf_dir, "orders").select("O_ORDERKEY", "o_custkey", "o_orderstatus")
    schema, name = _new_table(
        spark, "o_orderkey BIGINT, o_custkey STRING, note STRING, fecinformacion STRING", "fecinformacion"
    )
    props = {"schema": schema, "table": name, "data_protect_columns": {"type": "sha256", "columns": "o_custkey"}}
    for period in ("0202509", "0202510"):
        load_table(rows, props, period)
    return spark.table(f"{schema}.{name}")


@query(
    "sink_catalog_partition_columns",
    "SELECT l_orderkey, l_linenumber, l_returnflag AS RETURNFLAG, l_linestatus AS linestatus FROM lineitem",
)
def sink_catalog_partition_columns(spark, sf_dir):
    """Partitioned by data columns, whose names differ from the table's by case."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag AS returnflag", "l_linestatus AS LineStatus"
    )
    schema, name = _new_table(
        spark,
        "l_orderkey BIGINT, l_linenumber INT, RETURNFLAG STRING, linestatus STRING",
        "RETURNFLAG, linestatus",
    )
    load_table(rows, {"schema": schema, "table": name, "mode": "overwrite"})
    return spark.table(f"{schema}.{name}").select("l_orderkey", "l_linenumber", "RETURNFLAG", "linestatus")


@query(
    "sink_catalog_rerun_period",
    """
    SELECT supplier.*, CASE period WHEN '202510' THEN 'again' ELSE 'first' END AS run, period AS fecinformacion
    FROM supplier CROSS JOIN (VALUES ('202509'), ('202510')) p(period)
    """,
)
def sink_catalog_rerun_period(spark, sf_dir):
    """Running a period again replaces that period and no other."""
    rows = table(spark, sf_dir, "supplier").withColumn("run", F.lit("first"))
    schema, name = _new_table(
        spark,
        "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE, run STRING, fecinformacion STRING",
        "fecinformacion",
    )
    props = {"schema": schema, "table": name, "mode": "overwrite", "only_written_partitions": "y"}
    load_table(rows, props, "202509")
    load_table(rows, props, "202510")
    load_table(rows.withColumn("run", F.lit("again")), props, "202510")
    return spark.table(f"{schema}.{name}")


@query(
    "aligned_to_table_inventory",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS client, c_name AS label, CAST(c_nationkey AS BIGINT) AS place,
           CAST(c_acctbal AS DOUBLE) AS balance, CAST(NULL AS DATE) AS opened
    FROM customer
    """,
)
def aligned_to_table_inventory(spark, sf_dir):
    """The destination's columns are looked up, and the rows fitted to them by position."""
    schema, name = _new_table(spark, "client STRING, label STRING, place BIGINT, balance DOUBLE, opened DATE", "opened")
    destination = [(column, data_type) for column, data_type, _ in table_columns(spark, schema, name)]
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return aligned_rows(rows, destination, by_position=True, dialect="spark")


@query("sink_catalog_repair", "SELECT * FROM customer")
def sink_catalog_repair(spark, sf_dir):
    """Partitions written by somebody else are found when the table is repaired."""
    rows = table(spark, sf_dir, "customer")
    schema, name = _new_table(
        spark,
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
        "c_mktsegment",
    )
    write_files(rows, table_location(spark, schema, name), mode="append", partition_by=["c_mktsegment"])
    register_partitions(spark, schema, name)
    return spark.table(f"{schema}.{name}")


@query(
    "ingest_raw_sealed_opened",
    """
    SELECT copy, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, copy = 'sealed' AS hidden
    FROM customer CROSS JOIN (VALUES ('raw'), ('sealed'), ('opened')) c(copy)
    """,
)
def ingest_raw_sealed_opened(spark, sf_dir):
    """The same rows as raw, encrypted and decrypted files."""
    root = staging_folder(spark, "ingest")
    source = f"{root}/landing"
    table(spark, sf_dir, "customer").write.options(sep="|", header=True).csv(source)
    raw = read_delimited(spark, source, header=True)
    write_files(raw, f"{root}/raw")
    write_files(encrypt_columns(raw, ["c_name"], EXAMPLE_KEY), f"{root}/sealed")
    stored = read_parquet(spark, f"{root}/sealed")
    write_files(decrypt_columns(stored, ["c_name"], EXAMPLE_KEY), f"{root}/opened")

    def copy(name):
        rows = read_parquet(spark, f"{root}/{name}").withColumn("copy", F.lit(name))
        return rows.withColumn("hidden", ~F.col("c_name").startswith("Customer"))

    sealed = decrypt_columns(copy("sealed"), ["c_name"], EXAMPLE_KEY)
    return copy("raw").unionByName(sealed).unionByName(copy("opened"))


@query(
    "sink_append_again",
    "SELECT run_id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders, (VALUES ('4001_202510'), ('4001_202511')) r(run_id) "
    "WHERE run_id = '4001_202510' OR o_totalprice >= 100000",
)
def sink_append_again(spark, sf_dir):
    """One run appended twice, once with too many rows, and another appended once: each run's last rows are there once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path = staging_folder(spark, "sink")
    append_run(orders.union(orders), path, "4001_202510", "o_orderstatus")
    append_run(orders.where("o_totalprice >= 100000"), path, "4001_202511", "o_orderstatus")
    append_run(orders, path, "4001_202510", "o_orderstatus")
    return read_runs(spark, path)
