"""Completeness, key uniqueness, reject split."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators.quality import (
    REASONS,
    flag_quality,
    mark_repeated_keys,
    quality_counts,
    split_rejects,
)
from workload.registry import query, table

# Lines of which some columns are NULL or blank, said the same in both dialects.
GAPPY_LINES = """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linenumber = 3 THEN NULL ELSE l_partkey END AS l_partkey,
           CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '  ' ELSE l_returnflag END AS l_returnflag
    FROM lineitem
"""
GAPPY_ORACLE = f"""
    WITH g AS ({GAPPY_LINES}),
    f AS (SELECT *, l_partkey IS NULL AS no_part, l_returnflag IS NULL OR trim(l_returnflag) = '' AS no_flag,
                 l_partkey IS NOT NULL AND count(*) OVER (PARTITION BY l_partkey, l_linenumber) > 1 AS again FROM g)
"""


def _gappy(spark, sf_dir):
    return spark.sql(
        GAPPY_LINES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem")
    )


@query(
    "quality_critical",
    GAPPY_ORACLE
    + """
    SELECT l_orderkey, l_linenumber,
           concat_ws(',', CASE WHEN no_part THEN 'blank:l_partkey' END,
                     CASE WHEN no_flag THEN 'blank:l_returnflag' END) AS reasons FROM f
    """,
)
def quality_critical(spark, sf_dir):
    flagged = flag_quality(_gappy(spark, sf_dir), critical=["l_partkey", "l_returnflag"])
    return flagged.select("l_orderkey", "l_linenumber", F.concat_ws(",", REASONS).alias("reasons"))


@query(
    "quality_unique_key",
    "SELECT l_orderkey, l_partkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) > 1 AS repeated FROM lineitem",
)
def quality_unique_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return mark_repeated_keys(rows, ["l_orderkey"])


@query(
    "quality_unique_key_hot",
    "SELECT l_orderkey, l_linenumber, l_returnflag, "
    "count(*) OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber) > 1 AS repeated FROM lineitem",
)
def quality_unique_key_hot(spark, sf_dir):
    """Few keys hold all rows, and go the way of hot keys."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    marked = mark_repeated_keys(rows, ["l_returnflag", "l_linestatus", "l_linenumber"], hot_rows=100)
    return marked.drop("l_linestatus")


@query(
    "quality_unique_text",
    "SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS repeated FROM documents",
)
def quality_unique_text(spark, sf_dir):
    """Whole texts as key: the exact copies, found by their digests."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_repeated_keys(rows, ["text"], long_keys=True).drop("text")


@query(
    "quality_all_reasons",
    GAPPY_ORACLE
    + """
    SELECT l_orderkey, l_linenumber,
           concat_ws(',', CASE WHEN no_flag THEN 'blank:l_returnflag' END, CASE WHEN no_part THEN 'null_key' END,
                     CASE WHEN again THEN 'repeated_key' END) AS reasons FROM f
    """,
)
def quality_all_reasons(spark, sf_dir):
    flagged = flag_quality(_gappy(spark, sf_dir), ["l_partkey", "l_linenumber"], ["l_returnflag"])
    return flagged.select("l_orderkey", "l_linenumber", F.concat_ws(",", REASONS).alias("reasons"))


@query(
    "quality_counts",
    GAPPY_ORACLE
    + """
    SELECT count(*) AS total, count(*) FILTER (WHERE no_flag OR no_part OR again) AS rejected,
           count(*) FILTER (WHERE NOT (no_flag OR no_part OR again)) AS accepted FROM f
    """,
)
def run_quality_counts(spark, sf_dir):
    return quality_counts(_gappy(spark, sf_dir), ["l_partkey", "l_linenumber"], ["l_returnflag"])


@query(
    "reject_split_accepted",
    "SELECT doc_id, lang FROM (SELECT doc_id, lang, count(*) OVER (PARTITION BY text) AS n FROM documents) d "
    "WHERE n = 1 AND trim(lang) <> ''",
)
def reject_split_accepted(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    accepted, _, _ = split_rejects(documents, ["text"], ["lang"], limit_percent=100, long_keys=True)
    return accepted.select("doc_id", "lang")


@query(
    "reject_split_rejected",
    GAPPY_ORACLE
    + """
    SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN no_flag THEN 'blank:l_returnflag' END,
           CASE WHEN no_part THEN 'null_key' END, CASE WHEN again THEN 'repeated_key' END) AS reasons
    FROM f WHERE no_flag OR no_part OR again
    """,
)
def reject_split_rejected(spark, sf_dir):
    _, rejected, _ = split_rejects(_gappy(spark, sf_dir), ["l_partkey", "l_linenumber"], ["l_returnflag"])
    return rejected.select("l_orderkey", "l_linenumber", F.concat_ws(",", REASONS).alias("reasons"))
