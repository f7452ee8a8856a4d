"""SQL that the transform stage hands to Spark as it is, one query per category."""

from __future__ import annotations

from sluiceway.plans.transforms import INPUT_TOKEN, load_transforms, run_transforms
from workload.registry import query, table


def _passes(name: str, base: str, sql: str, others: tuple[str, ...] = (), oracle: str | None = None) -> None:
    """Register SQL text over a base table and session views of other tables."""

    def run(spark, sf_dir):
        for other in others:
            table(spark, sf_dir, other).createOrReplaceTempView(other)
        try:
            return run_transforms(table(spark, sf_dir, base), load_transforms(spark, [{"transform_sql": sql}]))["1"]
        finally:
            for other in others:
                spark.catalog.dropTempView(other)

    query(name, (oracle or sql).replace(INPUT_TOKEN, base))(run)


_passes(
    "pass_filter",
    "lineitem",
    "SELECT l_orderkey, l_linenumber FROM {{SOURCE_INPUT}} "
    "WHERE l_shipdate >= DATE '1995-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24",
)
_passes(
    "pass_join",
    "lineitem",
    "SELECT o_orderpriority, sum(items) AS items, CAST(sum(price) AS DOUBLE) AS price FROM "
    "(SELECT l_orderkey, count(*) AS items, sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS price "
    "FROM {{SOURCE_INPUT}} GROUP BY l_orderkey) l JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority",
    ("orders",),
    oracle="SELECT o_orderpriority, count(*) AS items, "
    "CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS price "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority",
)
_passes(
    "pass_outer_join",
    "customer",
    "SELECT c_custkey, coalesce(n, 0) AS orders FROM {{SOURCE_INPUT}} LEFT JOIN "
    "(SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey",
    ("orders",),
)
_passes(
    "pass_semi_anti",
    "customer",
    "SELECT c_custkey FROM {{SOURCE_INPUT}} c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) "
    "AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey = 0)",
    ("orders", "nation"),
)
_passes(
    "pass_interval_join",
    "events",
    "WITH spans AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INT) AS h, count(*) AS n "
    "FROM {{SOURCE_INPUT}} GROUP BY user_id, event_type, CAST(ts AS DATE), CAST(hour(ts) AS INT)) "
    "SELECT a.user_id, a.event_type, a.day, a.h, a.n, b.n AS next_n FROM spans a LEFT JOIN spans b "
    "ON a.user_id = b.user_id AND a.event_type = b.event_type AND b.day = a.day AND b.h = a.h + 1",
)
# A range join meets by user and hour: a later event lies in the hour of the earlier one or the next.
_passes(
    "pass_range_join",
    "events",
    "WITH later AS (SELECT user_id, ts, explode(array(date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR)) "
    "AS from_hour FROM {{SOURCE_INPUT}}) "
    "SELECT a.event_id, count(b.ts) AS within_an_hour FROM {{SOURCE_INPUT}} a LEFT JOIN later b "
    "ON a.user_id = b.user_id AND date_trunc('hour', a.ts) = b.from_hour AND b.ts > a.ts "
    "AND b.ts <= a.ts + INTERVAL 1 HOUR GROUP BY a.event_id",
    oracle="SELECT a.event_id, count(b.ts) AS within_an_hour FROM events a LEFT JOIN events b "
    "ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR GROUP BY a.event_id",
)
# The latest click at or before each purchase, in one pass over both, sorted by time.
_passes(
    "pass_asof_join",
    "events",
    "SELECT event_id, clicked FROM (SELECT event_id, event_type, "
    "max(CASE WHEN event_type = 'click' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts) AS clicked "
    "FROM {{SOURCE_INPUT}} WHERE event_type IN ('click', 'purchase')) e WHERE event_type = 'purchase'",
    oracle="SELECT p.event_id, c.ts AS clicked FROM (SELECT * FROM events WHERE event_type = 'purchase') p "
    "ASOF LEFT JOIN (SELECT user_id, ts FROM events WHERE event_type = 'click') c "
    "ON p.user_id = c.user_id AND p.ts >= c.ts",
)
_passes(
    "pass_agg",
    "lineitem",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, "
    "CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity, max(l_shipdate) AS latest "
    "FROM {{SOURCE_INPUT}} WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus",
)
_passes(
    "pass_rollup",
    "orders",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {{SOURCE_INPUT}} "
    "GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
)
_passes(
    "pass_grouping_sets",
    "part",
    "SELECT p_brand, p_size, count(*) AS n FROM {{SOURCE_INPUT}} GROUP BY GROUPING SETS ((p_brand), (p_size), ())",
)
# Windows run over counts per day, so that a window holds days and never rows.
_passes(
    "pass_window",
    "orders",
    "SELECT o_custkey, day, n, CAST(sum(n) OVER (PARTITION BY o_custkey ORDER BY day) AS BIGINT) AS so_far, "
    "lag(n) OVER (PARTITION BY o_custkey ORDER BY day) AS earlier, "
    "CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, day) AS BIGINT) AS place FROM "
    "(SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM {{SOURCE_INPUT}} "
    "GROUP BY o_custkey, CAST(o_orderdate AS DATE)) d",
)
_passes(
    "pass_topk",
    "orders",
    "SELECT o_orderkey, o_totalprice FROM {{SOURCE_INPUT}} ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
_passes(
    "pass_setop",
    "orders",
    "(SELECT DISTINCT o_custkey AS k FROM {{SOURCE_INPUT}} WHERE o_orderstatus = 'F' INTERSECT "
    "SELECT c_custkey FROM customer WHERE c_acctbal > 0) EXCEPT "
    "SELECT DISTINCT o_custkey FROM {{SOURCE_INPUT}} WHERE o_totalprice > 300000",
    ("customer",),
)
_passes(
    "pass_union_distinct",
    "orders",
    "SELECT o_orderstatus AS code FROM {{SOURCE_INPUT}} UNION SELECT l_linestatus FROM lineitem",
    ("lineitem",),
)
_passes(
    "pass_json_date",
    "events",
    "SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k, "
    "year(ts) AS y, month(ts) AS m, CAST(ts AS DATE) AS day FROM {{SOURCE_INPUT}}",
    oracle="SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
    "CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(ts AS DATE) AS day FROM events",
)
_passes(
    "pass_strings",
    "documents",
    "SELECT doc_id, upper(lang) AS lang, length(text) AS characters, "
    "length(text) - length(replace(text, 'e', '')) AS es, substr(source, 4) AS source FROM {{SOURCE_INPUT}}",
    oracle="SELECT doc_id, upper(lang) AS lang, CAST(length(text) AS INTEGER) AS characters, "
    "CAST(length(text) - length(replace(text, 'e', '')) AS INTEGER) AS es, substr(source, 4) AS source FROM documents",
)
_passes(
    "pass_arrays",
    "embeddings",
    "SELECT vec_id, size(embedding) AS width, CAST(embedding[0] AS DOUBLE) AS first_value, "
    "CAST(array_max(embedding) AS DOUBLE) AS top FROM {{SOURCE_INPUT}}",
    oracle="SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width, CAST(embedding[1] AS DOUBLE) AS first_value, "
    "CAST(list_max(embedding) AS DOUBLE) AS top FROM embeddings",
)
_passes(
    "pass_cte_case",
    "conversations",
    "WITH turns AS (SELECT conv_id, role, turn FROM {{SOURCE_INPUT}}) "
    "SELECT conv_id, count(*) AS turns, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS by_user, "
    "max(turn) AS last_turn FROM turns GROUP BY conv_id HAVING count(*) > 1",
)
