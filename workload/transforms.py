"""Spark SQL transforms over one base relation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.plans.transforms import last_result, load_transforms, run_transforms
from sluiceway.sinks.staging import staging_folder
from workload.registry import query, table, write_small_text


@query(
    "transform_inline",
    "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders WHERE o_orderstatus = 'F'",
)
def transform_inline(spark, sf_dir):
    modules = [
        {
            "transform_id": "1",
            "transform_type": "code",
            "transform_sql": "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM {{SOURCE_INPUT}} "
            "WHERE o_orderstatus = 'F'",
        }
    ]
    return run_transforms(table(spark, sf_dir, "orders"), load_transforms(spark, modules))["1"]


@query("transform_fixed_projection", "SELECT o_orderkey, o_custkey FROM orders")
def transform_fixed_projection(spark, sf_dir):
    modules = [{"transform_sql": "SELECT o_orderkey, o_custkey FROM source_table"}]
    return run_transforms(table(spark, sf_dir, "orders"), load_transforms(spark, modules))["1"]


@query(
    "transform_token_twice",
    """
    SELECT o_orderkey FROM orders
    WHERE o_totalprice > (SELECT CAST(avg(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) FROM orders)
    """,
)
def transform_token_twice(spark, sf_dir):
    sql = (
        "SELECT o_orderkey FROM {{SOURCE_INPUT}} WHERE o_totalprice > "
        "(SELECT CAST(avg(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) FROM {{SOURCE_INPUT}})"
    )
    return run_transforms(table(spark, sf_dir, "orders"), load_transforms(spark, [{"transform_sql": sql}]))["1"]


@query(
    "transform_file",
    "SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem WHERE l_linestatus = 'O'",
)
def transform_file(spark, sf_dir):
    folder = staging_folder(spark, "sql")
    sql = "SELECT l_orderkey\n,l_partkey\n,l_shipdate\nFROM {{SOURCE_INPUT}}\nWHERE l_linestatus = 'O'"
    write_small_text(spark, f"{folder}/open_lines.sql", sql)
    modules = [{"transform_id": "7", "transform_type": "file", "transform_sql": "open_lines.sql"}]
    return run_transforms(table(spark, sf_dir, "lineitem"), load_transforms(spark, modules, folder))["7"]


@query(
    "transform_chain",
    """
    SELECT l_returnflag, count(*) AS orders, CAST(sum(items) AS BIGINT) AS items FROM (
      SELECT l_orderkey, l_returnflag, count(*) AS items FROM lineitem GROUP BY l_orderkey, l_returnflag
    ) per_order WHERE items > 1 GROUP BY l_returnflag
    """,
)
def transform_chain(spark, sf_dir):
    """The last transform is declared first: order follows what the texts read."""
    modules = [
        {
            "transform_id": "report",
            "transform_sql": "SELECT l_returnflag, count(*) AS orders, sum(items) AS items FROM tx_big "
            "GROUP BY l_returnflag",
        },
        {"transform_id": "big", "transform_sql": "SELECT * FROM tx_per_order WHERE items > 1"},
        {
            "transform_id": "per_order",
            "transform_sql": "SELECT l_orderkey, l_returnflag, count(*) AS items FROM {{SOURCE_INPUT}} "
            "GROUP BY l_orderkey, l_returnflag",
        },
    ]
    return run_transforms(table(spark, sf_dir, "lineitem"), load_transforms(spark, modules))["report"]


@query("transform_pruned", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus")
def transform_pruned(spark, sf_dir):
    """A transform nobody asks for is not even analysed."""
    modules = [
        {"transform_id": "1", "transform_sql": "SELECT o_orderstatus FROM {{SOURCE_INPUT}}"},
        {"transform_id": "2", "transform_sql": "SELECT no_such_column FROM {{SOURCE_INPUT}}"},
        {"transform_id": "3", "transform_sql": "SELECT o_orderstatus, count(*) AS orders FROM tx_1 GROUP BY 1"},
    ]
    frames = run_transforms(table(spark, sf_dir, "orders"), load_transforms(spark, modules), only={"3"})
    return frames["3"]


@query(
    "transform_several",
    """
    SELECT 'status' AS kind, o_orderstatus AS name, count(*) AS orders FROM orders GROUP BY o_orderstatus
    UNION ALL
    SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority
    """,
)
def transform_several(spark, sf_dir):
    count = "SELECT '{0}' AS kind, o_order{0} AS name, count(*) AS orders FROM {{{{SOURCE_INPUT}}}} GROUP BY o_order{0}"
    modules = [{"transform_sql": count.format(kind)} for kind in ("status", "priority")]
    frames = run_transforms(table(spark, sf_dir, "orders"), load_transforms(spark, modules))
    return frames["1"].unionByName(frames["2"])


@query("transform_last_result", "SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey")
def transform_last_result(spark, sf_dir):
    base = table(spark, sf_dir, "nation")
    modules = [
        {"transform_sql": "SELECT n_name FROM {{SOURCE_INPUT}}"},
        {"transform_sql": "SELECT n_regionkey, count(*) AS nations FROM {{SOURCE_INPUT}} GROUP BY n_regionkey"},
    ]
    return last_result(base, run_transforms(base, load_transforms(spark, modules)))


@query("transform_none", "SELECT * FROM supplier")
def transform_none(spark, sf_dir):
    """Without transforms the input passes through."""
    base = table(spark, sf_dir, "supplier")
    return last_result(base, run_transforms(base, []))


@query(
    "transform_jobs_in_turn",
    "SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'parts', count(*) FROM part",
)
def transform_jobs_in_turn(spark, sf_dir):
    """Two jobs of one session use the same view names and do not disturb each other."""
    found = []
    for source, name in (("orders", "orders"), ("parts", "part")):
        modules = [{"transform_sql": "SELECT count(*) AS n FROM {{SOURCE_INPUT}}"}]
        frame = run_transforms(table(spark, sf_dir, name), load_transforms(spark, modules))["1"]
        found.append(frame.select(F.lit(source).alias("source"), "n"))
    return found[0].unionByName(found[1])
