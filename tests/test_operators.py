import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluiceway.functions.crypto import CipherKey
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
    ProtectionError,
    decrypt_columns,
    encrypt_columns,
    hash_columns,
    protect_columns,
)
from sluiceway.operators.quality import (
    REASONS,
    RejectLimitExceeded,
    check_quality,
    flag_quality,
    mark_repeated_keys,
    split_rejects,
)
from sluiceway.sinks.jdbc import aligned_rows

KEY = CipherKey(bytes(32), bytes(16))


def test_filters_and_columns_reach_the_scan_through_every_operator(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    types = {"l_partkey": "integer", "l_comment": "text"}
    out = hash_columns(lines, ["l_suppkey"])
    out = cast_to_destination(clean_blanks(out, types), types)
    out = null_to_empty(add_audit_columns(out, "202510", 1))
    out = match_column_case(align_by_name(out, [*lines.columns, "fecinfo"]), ["L_TAX"])
    plan = out.where("l_orderkey = 7").select("l_partkey", "fecinfo")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_orderkey,7)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "Exchange" not in plan and plan.count("Project") == 1


def test_clean_blanks_keeps_types_and_other_columns(spark):
    df = spark.sql("SELECT ' ' AS a, 5 AS n, CAST(NULL AS INT) AS m, array(1) AS arr, ' ' AS free")
    out = clean_blanks(df, {"a": "int", "n": "int", "m": "varchar(3)", "arr": "int"}, null_to_empty=True)
    assert tuple(out.first()) == (None, 5, "", [1], " ")
    assert out.columns == df.columns
    same = clean_blanks(df, {"m": "varchar(3)"})
    assert same.first()["m"] is None


@pytest.mark.parametrize("dest", ["integer", "date", "timestamp", "boolean", "numeric(5,1)", "real", "clob", "varchar(9)"])
def test_aligned_rows_clean_before_they_cast(spark, dest):
    df = spark.createDataFrame([("",), ("  ",), (None,), ("1",), ("2024-01-02",), ("x",)], "a string")
    for flag in (False, True):
        fused = aligned_rows(df, [("a", dest)], null_to_empty=flag)
        steps = cast_to_destination(clean_blanks(df, {"a": dest}, flag), {"a": dest})
        assert fused.collect() == steps.collect() and fused.schema == steps.schema


def test_null_to_empty_only_touches_strings(spark):
    row = null_to_empty(spark.sql("SELECT CAST(NULL AS STRING) AS s, CAST(NULL AS INT) AS n")).first()
    assert tuple(row) == ("", None)
    assert null_to_empty(spark.sql("SELECT 1 AS n")).columns == ["n"]


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("1.5", None)], "`a.b` string, `c``d` string")
    assert cast_to_destination(df, {"a.b": "int"}).first()["a.b"] == 1
    assert hash_columns(df, ["a.b"]).columns == df.columns
    assert join_fields(df).first()[0] == "1.5~|~"
    assert rows_to_json(df).first()[0] == '{"a.b":"1.5"}'
    assert mark_repeated_keys(df, ["a.b"]).first()["repeated"] is False


def test_alignment(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert align_by_position(df, [("b", "int"), ("a", "text"), ("c", "date")]).dtypes == [
        ("b", "int"), ("a", "string"), ("c", "date"),
    ]
    twice = df.select("a", F.col("b").alias("a"))
    assert tuple(align_by_position(twice, [("p", "int"), ("q", "text")]).first()) == (1, "x")
    assert align_by_name(df, ["nothing"]).columns == ["a", "b"]
    assert align_by_name(df, ["b", "A"]).columns == ["b"]
    with pytest.raises(ValueError):
        select_existing(df, ["nothing"])


def test_audit_and_run_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = add_audit_columns(df)
    assert (out.first().fecinfo, out.first().batch_id) == ("", -1)
    assert dict(out.dtypes)["load_ts"] == "timestamp"
    have = spark.sql("SELECT 202510 AS fecinfo, '5' AS batch_id, '2024-01-01 00:00:00' AS load_ts")
    assert tuple(add_audit_columns(have, "x", 1).first()) == ("202510", 5, dt.datetime(2024, 1, 1))
    out = add_run_partitions(have, "7", "202510")
    assert out.columns[-1] == "fecinformacion" and out.first().batch_id == "5"
    assert add_run_partitions(df, None, None).columns == ["a"]
    assert add_period_for_table(df, ["x"], "202510").columns == ["a"]
    assert add_period_for_table(df, ["FECINFORMACION"], None).columns == ["a"]
    assert match_column_case(df, ["A", "b"]).columns == ["A"]


def test_header_check(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert require_header(df, ["b", "a"]).columns == ["b", "a"]
    for expected in (["a"], ["a", "b", "c"], ["a", "c"]):
        with pytest.raises(ValueError, match="header check"):
            require_header(df, expected)


def test_protection_fails_closed(spark):
    df = spark.createDataFrame([("x",)], "a string")
    for attempt in (
        lambda: hash_columns(df, ["a", "b"]),
        lambda: encrypt_columns(df, ["b"], KEY),
        lambda: decrypt_columns(df, ["b"], KEY),
        lambda: protect_columns(df, {"type": "rot13", "columns": "a"}),
        lambda: protect_columns(df, {"columns": "a"}),
        lambda: protect_columns(df, {"type": "sha-256", "columns": "b"}),
    ):
        with pytest.raises(ProtectionError):
            attempt()
    for nothing in (None, {}, {"type": "rot13"}, {"type": "rot13", "columns": " "}):
        assert protect_columns(df, nothing).first().a == "x"


KEYED = (
    [(1, "a", "x")] * 40
    + [(2, "b", " "), (2, "c", None), (2, "b", "y")]
    + [(None, "a", "x"), (None, "a", "x"), (3, None, "z")]
    + [(n, str(n), "ok") for n in range(100, 160)]
)


def keyed(spark):
    return spark.createDataFrame(KEYED, "k int, l string, c string").repartition(4)


def expected_reasons():
    counts = Counter((k, l) for k, l, _ in KEYED)
    rows = []
    for k, l, c in KEYED:
        reasons = ["blank:c"] if c is None or not c.strip() else []
        if k is None or l is None:
            reasons.append("null_key")
        elif counts[(k, l)] > 1:
            reasons.append("repeated_key")
        rows.append((k, l, c, reasons))
    return sorted(rows, key=str)


@pytest.mark.parametrize("hot_rows", [2, 30, 10**6])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
@pytest.mark.parametrize("few_repeats", [False, True])
@pytest.mark.parametrize("long_keys", [False, True])
def test_quality_against_brute_force(spark, hot_rows, broadcast, few_repeats, long_keys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        flagged = flag_quality(keyed(spark), ["k", "l"], ["c"], hot_rows, few_repeats, long_keys)
        assert sorted(map(tuple, flagged.collect()), key=str) == expected_reasons()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_a_hot_key_do_not_meet_in_one_task(spark):
    """The join spreads them by input partition, and the counts are computed once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 16).select((F.col("id") % 4000 < 3900).alias("hot"), "id")
        df = df.select(F.when(F.col("hot"), F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
        marked = mark_repeated_keys(df, ["k"], hot_rows=1000)
        # The mark is used in the count, or the join with the repeated keys would be optimised away.
        spread = marked.where("k = -1").groupBy(F.spark_partition_id()).agg(F.count_if("repeated").alias("n")).collect()
        assert len(spread) > 4 and sum(r.n for r in spread) == 3900
        nulls = mark_repeated_keys(df.select(F.when(F.col("k") >= 0, F.col("k")).alias("k"), "id"), ["k"], hot_rows=1000)
        spread = nulls.where("k is null").groupBy(F.spark_partition_id()).agg(F.count_if(~F.col("repeated")).alias("n")).collect()
        assert len(spread) > 4 and sum(r.n for r in spread) == 3900
        assert marked.where("repeated").count() == 3900
        rows = marked.collect()
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 4000 and "SortMergeJoin" in plan and "ReusedExchange" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_few_repeats_shuffle_no_rows(spark):
    marked = mark_repeated_keys(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), ["l_orderkey"], few_repeats=True)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_float_keys_that_are_equal_repeat(spark):
    df = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D), (double('NaN')), (double('NaN')), (1.0D) t(k)")
    assert mark_repeated_keys(df, ["k"]).where("repeated").count() == 4


def test_long_keys_tell_keys_apart_as_plain_ones_do(spark):
    keys = {
        "timestamp": ["2020-01-01 00:00:00.000001", "2020-01-01 00:00:00.000002", "2020-01-01 00:00:00.000002"],
        "timestamp_ntz": ["2020-01-01 00:00:00.000001", "2020-01-01 00:00:00.000002", "2020-01-01 00:00:00.000002"],
        "double": ["0.0", "-0.0", "NaN", "NaN", "1.0", "1.0000000000000002"],
        "float": ["0.0", "-0.0", "NaN", "NaN", "1.0", "1.1"],
        "decimal(20,6)": ["1.000001", "1.000002", "1.000001"],
        "string": ["a", "a ", "a", ""],
        "binary": ["a", "b", "a"],
        "date": ["2020-01-01", "2020-01-02", "2020-01-01"],
        "bigint": ["1", "2", "1"],
    }
    for kind, values in keys.items():
        df = spark.createDataFrame([(v,) for v in [*values, None]], "t string").select(F.col("t").cast(kind).alias("k"), "t")
        plain, long = (
            sorted(map(str, mark_repeated_keys(df, ["k"], long_keys=long).select("t", "repeated").collect())) for long in (False, True)
        )
        assert plain == long, kind


def test_totals_and_limit(spark):
    df = keyed(spark)
    bad = sum(bool(r) for *_, r in expected_reasons())
    totals = check_quality(df, ["k", "l"], ["c"])
    assert (totals.total, totals.rejected, totals.accepted) == (len(KEYED), bad, len(KEYED) - bad)
    assert totals.repeated_keys == 2 and totals.few_repeats
    long = check_quality(df, ["k", "l"], ["c"], long_keys=True)
    assert (long.total, long.rejected, long.repeated_keys) == (totals.total, totals.rejected, 2)
    accepted, rejected, _ = split_rejects(df, ["k", "l"], ["c"], limit_percent=100)
    assert (accepted.count(), rejected.count()) == (totals.accepted, totals.rejected)
    assert accepted.columns == df.columns and rejected.columns == [*df.columns, REASONS]
    with pytest.raises(RejectLimitExceeded):
        split_rejects(df, ["k", "l"], ["c"], limit_percent=10)
    share = 100 * bad / len(KEYED)
    totals.require_at_most(share + 1e-9)
    empty = check_quality(df.limit(0), ["k"], ["c"])
    assert (empty.total, empty.rejected) == (0, 0)
    empty.require_at_most(0)
    only_critical = check_quality(df, critical=["c"])
    assert only_critical.rejected == 2
    assert flag_quality(df).where(F.size(REASONS) == 0).count() == len(KEYED)


def test_types_of_a_spark_inventory_stay(spark):
    types = ["double", "float", "tinyint", "binary", "decimal(9,3)", "timestamp", "timestamp_ntz", "string"]
    df = spark.sql("SELECT 1.5 AS a, 1.5 AS b, 1 AS c, 'x' AS d, 1.5 AS e, '2020-01-01 00:00:00.000001' AS f, '2020-01-01' AS g, 1 AS h")
    out = aligned_rows(df, [(n, t) for n, t in zip("abcdefgh", types)], dialect="spark")
    assert [t for _, t in out.dtypes] == types
    assert out.first()["f"].microsecond == 1 and out.first()["d"] == bytearray(b"x")


def test_null_to_empty_with_dots_in_names(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS `a.b`, CAST(NULL AS INT) AS c")
    assert [tuple(r) for r in null_to_empty(df).collect()] == [("", None)]
