"""Column operators: protection, cleaning, casting, alignment, audit columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.functions.crypto import encrypt_text
from sluiceway.operators.cleansing import cleanse_columns
from sluiceway.operators.columns import (
    add_audit_columns,
    add_period_for_table,
    add_run_partitions,
    align_by_name,
    align_by_position,
    cast_to_destination,
    clean_blanks,
    join_fields,
    match_column_case,
    null_to_empty,
    require_header,
    rows_to_json,
    select_existing,
)
from sluiceway.operators.protection import (
    decrypt_columns,
    encrypt_columns,
    hash_columns,
    protect_columns,
    protection_methods,
)
from sluiceway.plans.run_log import sample_rows
from sluiceway.sinks.jdbc import aligned_rows, audited_rows, truncating_rows
from workload.registry import EXAMPLE_KEY, query, table
from workload.sources import CLEANSED


@query(
    "sha_protect",
    """
    SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, sha256(c_name) AS c_name, c_nationkey,
           sha256(nullif(c_mktsegment, 'BUILDING')) AS c_mktsegment
    FROM customer
    """,
)
def sha_protect(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "c_nationkey", "nullif(c_mktsegment, 'BUILDING') AS c_mktsegment"
    )
    return hash_columns(rows, ["c_custkey", "c_name", "c_mktsegment"])


@query("sha_protect_whole_texts", "SELECT doc_id, sha256(text) AS text, lang FROM documents")
def sha_protect_whole_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return protect_columns(rows, {"type": "volt-sha-256", "columns": "text"})


@query(
    "aes_roundtrip",
    "SELECT c_custkey, c_name, c_mktsegment, true AS hidden FROM customer",
)
def aes_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    sealed = encrypt_columns(rows.withColumn("clear", F.col("c_name")), ["c_name", "c_mktsegment"], EXAMPLE_KEY)
    shown = sealed.withColumn("hidden", F.col("c_name") != F.col("clear")).drop("clear")
    return decrypt_columns(shown, ["c_name", "c_mktsegment"], EXAMPLE_KEY)


@query(
    "aes_roundtrip_whole_texts",
    """
    SELECT doc_id, text, 4 * ((16 * (octet_length(encode(text)) // 16 + 1) + 2) // 3) AS sealed_length
    FROM documents
    """,
)
def aes_roundtrip_whole_texts(spark, sf_dir):
    """Long texts too: one unbroken line of base64, of exactly the padded length."""
    sealed = encrypt_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], EXAMPLE_KEY)
    measured = sealed.withColumn("sealed_length", F.length("text").cast("bigint"))
    return decrypt_columns(measured, ["text"], EXAMPLE_KEY)


@query(
    "aes_equal_stays_equal",
    "SELECT c_mktsegment, count(*) AS customers, CAST(1 AS BIGINT) AS cipher_texts FROM customer GROUP BY c_mktsegment",
)
def aes_equal_stays_equal(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("sealed", encrypt_text(F.col("c_mktsegment"), EXAMPLE_KEY))
    per_text = rows.groupBy("c_mktsegment", "sealed").agg(F.count(F.lit(1)).alias("n"))
    return per_text.groupBy("c_mktsegment").agg(
        F.sum("n").alias("customers"), F.count(F.lit(1)).alias("cipher_texts")
    )


@query("aes_decrypt_other_text", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name FROM customer")
def aes_decrypt_other_text(spark, sf_dir):
    return decrypt_columns(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_name"], EXAMPLE_KEY)


@query(
    "protection_by_method_name",
    "SELECT sha256(CAST(s_suppkey AS VARCHAR)) AS s_suppkey, s_name, s_acctbal FROM supplier",
)
def protection_by_method_name(spark, sf_dir):
    """A source's protection block picks its method by name."""
    methods = protection_methods({"cipher-a": EXAMPLE_KEY})
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sealed = protect_columns(
        rows, {"name_method": "CIPHER-A", "columns_sensitive": "s_name", "enabled_ind": "Y"}, methods
    )
    opened = decrypt_columns(sealed, ["s_name"], EXAMPLE_KEY)
    skipped = protect_columns(opened, {"name_method": "x", "columns_sensitive": "s_name", "enabled_ind": "N"}, methods)
    return protect_columns(skipped, {"type": "sha-256", "columns": "s_suppkey"}, methods)


# Events with every kind of bad value, said the same way in both dialects.
DIRTY_EVENTS = """
    SELECT event_id,
           CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN NULL WHEN 3 THEN 'abc'
             WHEN 4 THEN concat(CAST(user_id AS {text}), '.7') WHEN 5 THEN concat('-', CAST(user_id AS {text}), '.25')
             WHEN 6 THEN concat('99999999', CAST(user_id AS {text}), '000') ELSE concat(' ', CAST(event_id AS {text}), ' ') END AS amount,
           CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '2024-02-30' WHEN 3 THEN NULL
             ELSE substr(CAST(CAST(ts AS DATE) AS {text}), 1, 10) END AS day,
           CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE event_type END AS kind,
           CASE event_id % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'f' WHEN 2 THEN '' WHEN 3 THEN 'maybe'
             WHEN 4 THEN 'no' WHEN 5 THEN '1' ELSE NULL END AS flag
    FROM events
"""
DIRTY_ORACLE = "WITH dirty AS (" + DIRTY_EVENTS.format(text="VARCHAR") + ")"


def _dirty(spark, sf_dir):
    return spark.sql(
        DIRTY_EVENTS.format(text="STRING").replace("FROM events", "FROM {events}"),
        events=table(spark, sf_dir, "events"),
    )


@query(
    "null_to_empty",
    DIRTY_ORACLE
    + """
    SELECT event_id, coalesce(amount, '') AS amount, coalesce(day, '') AS day, coalesce(kind, '') AS kind,
           coalesce(flag, '') AS flag FROM dirty
    """,
)
def run_null_to_empty(spark, sf_dir):
    return null_to_empty(_dirty(spark, sf_dir))


DESTINATION = {
    "event_id": "bigint",
    "amount": "integer",
    "day": "date",
    "kind": "character varying",
    "flag": "boolean",
}


@query(
    "clean_blanks_catalog",
    DIRTY_ORACLE
    + """
    SELECT event_id, CASE WHEN trim(amount) = '' THEN NULL ELSE amount END AS amount,
           CASE WHEN trim(day) = '' THEN NULL ELSE day END AS day, coalesce(kind, '') AS kind,
           CASE WHEN trim(flag) = '' THEN NULL ELSE flag END AS flag FROM dirty
    """,
)
def clean_blanks_catalog(spark, sf_dir):
    return clean_blanks(_dirty(spark, sf_dir), DESTINATION, null_to_empty=True)


@query(
    "clean_blanks_generic",
    DIRTY_ORACLE
    + """
    SELECT event_id, CASE WHEN trim(amount) = '' THEN NULL ELSE amount END AS amount,
           CASE WHEN trim(day) = '' THEN NULL ELSE day END AS day, coalesce(kind, '') AS kind, flag FROM dirty
    """,
)
def clean_blanks_generic(spark, sf_dir):
    """The generic classes do not know booleans and leave them alone."""
    types = DESTINATION | {"kind": "VARCHAR(20)"}
    return clean_blanks(_dirty(spark, sf_dir), types, null_to_empty=True, classify="generic")


@query(
    "cast_to_destination",
    DIRTY_ORACLE
    + """
    SELECT event_id, TRY_CAST(trunc(TRY_CAST(amount AS DECIMAL(38,10))) AS INTEGER) AS amount,
           TRY_CAST(day AS DATE) AS day, kind,
           CASE WHEN flag IN ('true', '1') THEN true WHEN flag IN ('f', 'no') THEN false END AS flag
    FROM dirty
    """,
)
def run_cast_to_destination(spark, sf_dir):
    return cast_to_destination(_dirty(spark, sf_dir), DESTINATION)


@query(
    "cast_numbers",
    """
    SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS l_extendedprice,
           CAST(trunc(l_quantity) AS BIGINT) AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate
    FROM lineitem
    """,
)
def cast_numbers(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate"
    )
    types = {
        "l_orderkey": "integer",
        "l_linenumber": "smallint",
        "l_extendedprice": "numeric(12,2)",
        "l_quantity": "bigint",
        "l_shipdate": "date",
    }
    out = cast_to_destination(rows, types)
    return out.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


@query(
    "align_position_pad",
    """
    SELECT s_suppkey AS id, s_name AS label, s_nationkey AS place, s_acctbal AS money,
           CAST(NULL AS DATE) AS opened, CAST(NULL AS VARCHAR) AS note FROM supplier
    """,
)
def align_position_pad(spark, sf_dir):
    destination = [
        ("id", "bigint"),
        ("label", "varchar(25)"),
        ("place", "integer"),
        ("money", "double precision"),
        ("opened", "date"),
        ("note", "text"),
    ]
    return align_by_position(table(spark, sf_dir, "supplier"), destination)


@query(
    "align_position_swap",
    "SELECT s_suppkey AS s_nationkey, s_nationkey AS s_suppkey FROM supplier",
)
def align_position_swap(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return align_by_position(rows, [("s_nationkey", "bigint"), ("s_suppkey", "integer")])


@query("align_position_cut", "SELECT s_suppkey AS id, s_name AS label FROM supplier")
def align_position_cut(spark, sf_dir):
    return align_by_position(table(spark, sf_dir, "supplier"), [("id", "bigint"), ("label", "text")])


@query("align_by_name", "SELECT s_acctbal, s_suppkey FROM supplier")
def run_align_by_name(spark, sf_dir):
    return align_by_name(table(spark, sf_dir, "supplier"), ["s_acctbal", "unknown", "s_suppkey"])


@query("select_existing", "SELECT p_brand, p_partkey FROM part")
def run_select_existing(spark, sf_dir):
    return select_existing(table(spark, sf_dir, "part"), ["p_brand", "unknown", "p_partkey"])


@query(
    "audit_columns",
    "SELECT o_orderkey, '202510' AS fecinfo, 4001 AS batch_id, true AS stamped FROM orders",
)
def audit_columns(spark, sf_dir):
    out = add_audit_columns(table(spark, sf_dir, "orders").select("o_orderkey"), "202510", "4001")
    return out.withColumn("stamped", F.col("load_ts").isNotNull()).drop("load_ts")


@query(
    "audit_columns_already_there",
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS fecinfo, CAST(o_custkey AS INTEGER) AS batch_id,
           CAST(o_orderdate AS DATE) AS load_day
    FROM orders
    """,
)
def audit_columns_already_there(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey AS fecinfo", "cast(o_custkey AS string) AS batch_id", "o_orderdate AS load_ts"
    )
    out = add_audit_columns(rows, "202510", 1)
    return out.withColumn("load_day", F.col("load_ts").cast("date")).drop("load_ts")


@query("run_partition_columns", "SELECT o_orderkey, '7' AS batch_id, '202510' AS fecinformacion FROM orders")
def run_partition_columns(spark, sf_dir):
    return add_run_partitions(table(spark, sf_dir, "orders").select("o_orderkey"), "7", "202510")


@query(
    "period_and_case_of_table",
    "SELECT o_orderkey AS O_OrderKey, o_orderstatus, '0202510' AS fecinformacion FROM orders",
)
def period_and_case_of_table(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    with_period = add_period_for_table(rows, ["FecInformacion"], "0202510")
    return match_column_case(with_period, ["O_OrderKey", "fecinformacion"])


@query(
    "rows_to_json",
    """
    SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey ||
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"c_mktsegment":"' || c_mktsegment || '"' END || '}' AS value
    FROM customer
    """,
)
def run_rows_to_json(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "c_nationkey", "nullif(c_mktsegment, 'BUILDING') AS c_mktsegment"
    )
    return rows_to_json(rows)


@query(
    "clean_text",
    f"SELECT doc_id, {CLEANSED.format(text='text')} AS text FROM documents",
)
def clean_text(spark, sf_dir):
    return cleanse_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])


@query(
    "join_fields",
    """
    SELECT CAST(o_orderkey AS VARCHAR) || '~|~' || coalesce(nullif(o_orderstatus, 'F'), '') || '~|~' ||
           o_orderpriority AS value FROM orders
    """,
)
def run_join_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'F') AS o_orderstatus", "o_orderpriority"
    )
    return join_fields(rows)


@query(
    "sample_protected",
    "SELECT CAST(5 AS BIGINT) AS n, true AS all_hidden",
)
def sample_protected(spark, sf_dir):
    """A look at a few rows, after protection."""
    sample = sample_rows(hash_columns(table(spark, sf_dir, "orders").select("o_custkey"), ["o_custkey"]))
    return sample.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.length("o_custkey") == 64).alias("all_hidden"))


@query("header_check", "SELECT toxic, doc_id, quality FROM labels")
def header_check(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").toDF("DOC_ID", "Quality", "toxic")
    return require_header(rows, ["toxic", "doc_id", "quality"])


@query(
    "jdbc_audited_rows",
    "SELECT 9 AS batch_id, o_orderkey, '202510' AS fecinfo FROM orders",
)
def jdbc_audited_rows(spark, sf_dir):
    """Rows as the audited JDBC sink appends them."""
    props = {"dbtable": "t", "select_cols": ["batch_id", "o_orderkey", "unknown", "fecinfo"]}
    return audited_rows(table(spark, sf_dir, "orders"), props, "202510", "9")


@query(
    "jdbc_truncating_rows",
    "SELECT event_id, coalesce(kind, '') AS kind FROM (" + DIRTY_EVENTS.format(text="VARCHAR") + ") d",
)
def jdbc_truncating_rows(spark, sf_dir):
    """Rows as the truncating JDBC sink writes them."""
    return truncating_rows(_dirty(spark, sf_dir).select("event_id", "kind"), {"null_to_empty": "Y"})


@query(
    "jdbc_aligned_rows_by_name",
    DIRTY_ORACLE
    + """
    SELECT TRY_CAST(nullif(trim(day), '') AS DATE) AS day, coalesce(kind, '') AS kind,
           CAST(TRY_CAST(nullif(trim(amount), '') AS DECIMAL(14,2)) AS DOUBLE) AS amount, event_id
    FROM dirty
    """,
)
def jdbc_aligned_rows_by_name(spark, sf_dir):
    """Rows as the aligned JDBC sink writes them, columns found by name."""
    destination = [
        ("day", "date"),
        ("kind", "varchar(20)"),
        ("amount", "numeric(14,2)"),
        ("unknown", "text"),
        ("event_id", "bigint"),
    ]
    out = aligned_rows(_dirty(spark, sf_dir), destination, null_to_empty=True)
    return out.withColumn("amount", F.col("amount").cast("double"))


@query(
    "jdbc_aligned_rows_by_position",
    DIRTY_ORACLE
    + """
    SELECT CAST(event_id AS VARCHAR) AS id, TRY_CAST(trunc(TRY_CAST(amount AS DECIMAL(38,10))) AS BIGINT) AS units,
           TRY_CAST(nullif(trim(day), '') AS DATE) AS on_day, kind AS label,
           CASE WHEN flag IN ('true', '1') THEN true WHEN flag IN ('f', 'no') THEN false END AS ok,
           CAST(NULL AS SMALLINT) AS extra
    FROM dirty
    """,
)
def jdbc_aligned_rows_by_position(spark, sf_dir):
    """Rows as the aligned JDBC sink writes them, columns found by position."""
    destination = [
        ("id", "varchar(20)"),
        ("units", "int8"),
        ("on_day", "date"),
        ("label", "text"),
        ("ok", "bool"),
        ("extra", "smallint"),
    ]
    return aligned_rows(_dirty(spark, sf_dir), destination, by_position=True)
