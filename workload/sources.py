"""Readers: every input is derived from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators.cleansing import cut_fields
from sluiceway.operators.columns import join_fields
from sluiceway.sinks.staging import staging_folder
from sluiceway.sources.batches import read_batch
from sluiceway.sources.files import (
    read_delimited,
    read_first_available,
    read_fixed_width,
    read_headerless,
    read_parquet,
)
from sluiceway.sources.splits import derived_ranges
from sluiceway.sources.typed import read_typed
from workload.registry import query, table, write_batch


@query("parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'")
def parquet_scan(spark, sf_dir):
    lines = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lines.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


ORDER_COLUMNS = [
    {"name": "o_orderstatus", "data_type": "VARCHAR(1)", "order": "3"},
    {"name": "o_orderkey", "data_type": "BIGINT", "order": "1"},
    {"name": "o_custkey", "data_type": "LONG", "order": "2"},
    {"name": "o_totalprice", "data_type": "DOUBLE", "order": 4},
    {"name": " ", "data_type": "INT", "order": 5},
    {"name": "o_orderdate", "data_type": "TIMESTAMP", "order": "6"},
    "o_orderpriority",
]
ORDERS_AS_DECLARED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders
"""


def _order_lines(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )


def _without_zone(df):
    """Declared times are instants; orders has them without a zone."""
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("batch_gzip_declared_schema", ORDERS_AS_DECLARED)
def batch_gzip_declared_schema(spark, sf_dir):
    about = {"format": "text", "compression": "gzip", "delimiter": "|", "columns": ORDER_COLUMNS}
    root = write_batch(_order_lines(spark, sf_dir), "4001", "202510", about, compression="gzip")
    return _without_zone(read_batch(spark, root, "4001", "202510", partitions=spark.sparkContext.defaultParallelism))


@query("batch_text_declared_schema", ORDERS_AS_DECLARED)
def batch_text_declared_schema(spark, sf_dir):
    about = {"format": "text", "delimiter": ";", "columns": ORDER_COLUMNS}
    root = write_batch(_order_lines(spark, sf_dir), "4002", "202510", about, extension="txt")
    return _without_zone(read_batch(spark, root, "4002", "202510"))


@query(
    "batch_text_bad_cells",
    """
    SELECT c_custkey, CAST(NULL AS INTEGER) AS c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer
    """,
)
def batch_text_bad_cells(spark, sf_dir):
    """A cell that does not parse as its declared type is NULL."""
    columns = [
        {"name": "c_custkey", "data_type": "BIGINT", "order": 1},
        {"name": "c_name", "data_type": "INT", "order": 2},
        {"name": "c_nationkey", "data_type": "INT", "order": 3},
        {"name": "c_acctbal", "data_type": "DOUBLE", "order": 4},
        {"name": "c_mktsegment", "data_type": "VARCHAR(10)", "order": 5},
    ]
    rows = table(spark, sf_dir, "customer")
    root = write_batch(rows, "4003", "202510", {"format": "text", "columns": columns})
    return read_batch(spark, root, "4003", "202510")


@query(
    "batch_text_undeclared",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS "_c0", s_name AS "_c1", CAST(s_nationkey AS VARCHAR) AS "_c2",
           CAST(s_acctbal AS VARCHAR) AS "_c3"
    FROM supplier
    """,
)
def batch_text_undeclared(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    root = write_batch(rows, "4004", "202510", {"format": "text"})
    return read_batch(spark, root, "4004", "202510")


@query("batch_parquet", "SELECT * FROM customer")
def batch_parquet(spark, sf_dir):
    root = write_batch(table(spark, sf_dir, "customer"), "4005", "202510", {"format": "parquet"})
    return read_batch(spark, root, "4005", "202510")


@query(
    "csv_header_infer",
    "SELECT * FROM part",
)
def csv_header_infer(spark, sf_dir):
    folder = staging_folder(spark, "landing")
    rows = table(spark, sf_dir, "part")
    rows.write.options(sep="|", header=True).csv(f"{folder}/data.csv")
    found = read_first_available(spark, folder)
    return found.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query(
    "csv_types_one_scan",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day,
           CAST(o_orderdate AS TIMESTAMP) AS moment, o_orderpriority,
           CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS mixed,
           CAST(o_custkey AS BIGINT) * 10000000000 AS large, CAST(NULL AS VARCHAR) AS nothing
    FROM orders
    """,
)
def csv_types_one_scan(spark, sf_dir):
    """Types of cells by one aggregate: whole numbers of two sizes, fractions, days, times, a mixture, no cell at all."""
    day, moment = F.col("o_orderdate").cast("date"), F.col("o_orderdate").cast("timestamp")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        day.cast("string").alias("day"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("moment"),
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(day.cast("string")).alias("mixed"),
        (F.col("o_custkey").cast("bigint") * 10_000_000_000).alias("large"),
        F.lit(None).cast("string").alias("nothing"),
    )
    folder = staging_folder(spark, "landing")
    rows.write.options(sep="|", header=True).csv(f"{folder}/orders")
    found = read_typed(spark, f"{folder}/orders", header=True)
    return found.withColumn("moment", F.col("moment").cast("timestamp_ntz"))


@query(
    "read_split_derived",
    """
    SELECT l_orderkey, l_linenumber, CAST(1 AS BIGINT) AS n_ranges, l_returnflag = 'R' AS in_null_range
    FROM lineitem
    """,
)
def read_split_derived(spark, sf_dir):
    """Ranges of equal depth over a column with one hot value and NULLs: every row is in exactly one."""
    split = F.when(F.col("l_returnflag") == "R", F.lit(None)).when(F.col("l_linenumber") == 1, 7).otherwise(F.col("l_orderkey"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", split.cast("bigint").alias("split"))
    met = [F.coalesce(F.expr(p), F.lit(False)) for p in derived_ranges(rows, "split", 16)]
    count = sum((m.cast("bigint") for m in met[1:]), met[0].cast("bigint"))
    return rows.select("l_orderkey", "l_linenumber", count.alias("n_ranges"), met[-1].alias("in_null_range"))


@query("first_available_parquet", "SELECT * FROM supplier")
def first_available_parquet(spark, sf_dir):
    folder = staging_folder(spark, "landing")
    rows = table(spark, sf_dir, "supplier")
    rows.write.parquet(f"{folder}/data.parquet")
    rows.limit(0).write.options(sep="|", header=True).csv(f"{folder}/data.txt")
    return read_first_available(spark, folder)


@query(
    "csv_headerless",
    "SELECT c_custkey AS col_1, c_name AS col_2, c_nationkey AS col_3, c_acctbal AS col_4, c_mktsegment AS col_5 "
    "FROM customer",
)
def csv_headerless(spark, sf_dir):
    folder = staging_folder(spark, "landing")
    rows = table(spark, sf_dir, "customer")
    rows.write.options(sep="|").csv(folder)
    return read_headerless(spark, folder).withColumn("col_1", F.col("col_1").cast("bigint"))


@query(
    "csv_header_all_strings",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS o_custkey,
           o_orderstatus, o_orderpriority
    FROM orders
    """,
)
def csv_header_all_strings(spark, sf_dir):
    """Leading zeros survive when nothing is inferred."""
    folder = staging_folder(spark, "landing")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("o_custkey"), "o_orderstatus", "o_orderpriority"
    )
    rows.write.options(sep="|", header=True).csv(folder)
    return read_delimited(spark, folder, header=True)


PART_FIELDS = ((1, 12), (13, 40), (53, 10), (63, 25), (88, 6), (94, 12))
PART_NAMES = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query(
    "fixed_width",
    """
    SELECT rpad(CAST(p_partkey AS VARCHAR), 12, ' ') AS p_partkey, rpad(p_name, 40, ' ') AS p_name,
           rpad(p_brand, 10, ' ') AS p_brand, rpad(p_type, 25, ' ') AS p_type,
           rpad(CAST(p_size AS VARCHAR), 6, ' ') AS p_size,
           rpad(CAST(p_retailprice AS VARCHAR), 12, ' ') AS p_retailprice
    FROM part
    """,
)
def fixed_width(spark, sf_dir):
    padded = [
        F.rpad(F.col(name).cast("string"), width, " ") for name, (_, width) in zip(PART_NAMES, PART_FIELDS)
    ]
    path = staging_folder(spark, "fixed-width")
    table(spark, sf_dir, "part").select(F.concat(*padded).alias("value")).write.text(path)
    return read_fixed_width(spark, path, PART_FIELDS, PART_NAMES)


CLEANSED = """
    replace(replace(replace(replace({text}, '''', ''), chr(8211), '-'), chr(160), ' '), chr(195) || chr(339), chr(220))
"""


@query(
    "raw_lines_to_delimited",
    f"""
    WITH lines AS (
      SELECT unnest(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))) AS line
      FROM documents
    ), clean AS (SELECT {CLEANSED.format(text="line")} AS line FROM lines)
    SELECT substr(line, 1, 3) || '~|~' || substr(line, 4, 50) || '~|~' || substr(line, 54, 6) || '~|~' ||
           substr(line, 60, 50) || '~|~' || substr(line, 110, 6) || '~|~' || substr(line, 116, 50) AS value,
           count(*) AS copies
    FROM clean GROUP BY 1
    """,
)
def raw_lines_to_delimited(spark, sf_dir):
    """Cleanse raw lines, cut them at fixed places, join the fields again."""
    path = staging_folder(spark, "raw-lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return join_fields(read_fixed_width(spark, path)).groupBy("value").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "cut_fields_trimmed",
    "SELECT trim(substr(c_name, 1, 9)) AS kind, trim(substr(c_name, 10, 9)) AS number FROM customer",
)
def cut_fields_trimmed(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return cut_fields(rows, ((1, 9), (10, 9)), ("kind", "number"), line="c_name", trim=True)
