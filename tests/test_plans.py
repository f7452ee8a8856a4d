import json
import os
import threading
import warnings

import pytest
from pyspark.sql import functions as F

from sluiceway.__main__ import main
from sluiceway.functions.crypto import CipherKey
from sluiceway.operators.protection import ProtectionError, decrypt_columns, protection_methods
from sluiceway.operators.quality import RejectLimitExceeded
from sluiceway.plans import runner
from sluiceway.plans.job import Job
from sluiceway.plans.runner import load_target, run_job
from sluiceway.plans.run_log import sample_rows
from sluiceway.plans.sources import read_base
from sluiceway.plans.transforms import Transform, load_transforms, needed_in_order, run_transforms
from sluiceway.sinks import jdbc
from sluiceway.sinks.staging import remove_staged
from workload.registry import write_batch

KEY = CipherKey(bytes(32), bytes(16))


def rows(spark, n=10):
    return spark.range(n).select("id", (F.col("id") % 3).cast("string").alias("part"))


def file_load(bucket, name=None, transform_id=None, **props):
    load = {"load_type": "s3", "load_properties": {"bucket": bucket, "name": name, **props}}
    return load | ({"transform_id": transform_id} if transform_id is not None else {})


def job(transforms=(), loads=(), extract=()):
    return {"process_modules": [{"extract": list(extract)}, {"transform": list(transforms)}, {"load": list(loads)}]}


# Job documents


def test_modules_of_a_kind_join_across_blocks():
    document = {"process_modules": [{"load": [{"a": 1}]}, {"transform": [{"b": 1}]}, {"load": [{"a": 2}]}]}
    assert [m["a"] for m in Job(document).modules("load")] == [1, 2]
    assert Job({}).modules("extract") == []
    with pytest.raises(ValueError):
        Job(document).modules("other")


def test_process_settings_win_key_by_key():
    shared = {"config_app": [{"name": "paths", "properties": {"a": 1, "b": 1}}, {"name": "cnx", "properties": {"password": "pw"}}]}
    process = {"config_app": [{"name": "paths", "properties": {"b": 2}}, {"name": "load", "properties": {"parallelism": "3"}}]}
    both = Job(process, shared)
    assert both.settings("paths") == {"a": 1, "b": 2} and both.settings("none") == {}
    assert both.parallelism() == 3 and Job({}).parallelism() == 1
    assert both.connection("cnx") == {"password": "pw"} and "pw" not in repr(both)
    with pytest.raises(KeyError):
        both.connection("paths2")


# Transforms


def test_order_follows_what_texts_read():
    parts = [Transform("c", "FROM tx_b JOIN TX_A"), Transform("b", "FROM tx_a"), Transform("a", "x"), Transform("d", "x")]
    assert [t.id for t in needed_in_order(parts)] [:1] != ["c"]
    order = [t.id for t in needed_in_order(parts)]
    assert order.index("a") < order.index("b") < order.index("c")
    assert {t.id for t in needed_in_order(parts, {"b"})} == {"a", "b"}
    assert needed_in_order(parts, set()) == []
    with pytest.raises(ValueError, match="circle"):
        needed_in_order([Transform("1", "tx_2"), Transform("2", "tx_1")])


def test_similar_ids_are_told_apart():
    parts = [Transform("1", "x"), Transform("10", "x"), Transform("r", "FROM tx_10")]
    assert parts[2].reads({"1", "10", "r"}) == {"10"}


def test_transform_modules(spark, folder):
    with open(f"{folder}/q.sql", "w") as out:
        out.write("SELECT id\nFROM {{SOURCE_INPUT}}")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        found = load_transforms(
            spark,
            [
                {"transform_sql": "SELECT 1"},
                {"transform_id": "empty"},
                {"transform_id": 9, "transform_type": "FILE", "transform_sql": "q.sql"},
                {"transform_sql": "looks_like.sql"},
            ],
            folder,
        )
    assert [(t.id, t.sql) for t in found] == [
        ("1", "SELECT 1"), ("9", "SELECT id\nFROM {{SOURCE_INPUT}}"), ("4", "looks_like.sql"),
    ]
    assert len([w for w in seen if w.category is UserWarning]) == 2
    with pytest.raises(FileNotFoundError):
        load_transforms(spark, [{"transform_type": "file", "transform_sql": "none.sql"}], folder)
    for bad in ([{"transform_id": "a b", "transform_sql": "x"}], [{"transform_id": "a", "transform_sql": "x"}] * 2):
        with pytest.raises(ValueError):
            load_transforms(spark, bad)


def test_views_of_the_session_come_back(spark):
    spark.range(3).createOrReplaceTempView("source_table")
    try:
        result = run_transforms(rows(spark), [Transform("1", "SELECT count(*) AS n FROM source_table")])["1"]
        assert spark.table("source_table").count() == 3
        assert not spark.catalog.tableExists("tx_1")
        assert result.first().n == 10
    finally:
        spark.catalog.dropTempView("source_table")
    with pytest.raises(Exception, match="no_such"):
        run_transforms(rows(spark), [Transform("1", "SELECT no_such FROM source_table")])
    assert not spark.catalog.tableExists("source_table")


def test_jobs_of_one_session_at_the_same_time(spark):
    found = {}

    def work(n):
        sql = [Transform("1", "SELECT id FROM source_table"), Transform("2", "SELECT count(*) AS n FROM tx_1")]
        found[n] = run_transforms(spark.range(n), sql)["2"].first().n

    threads = [threading.Thread(target=work, args=(n,)) for n in range(1, 9)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert found == {n: n for n in range(1, 9)}


def test_transform_reads_only_what_its_load_needs(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    result = run_transforms(base, [Transform("1", "SELECT * FROM source_table"), Transform("2", "SELECT l_tax FROM tx_1 WHERE l_tax > 1")])
    plan = result["2"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_tax:double>" in plan and "GreaterThan(l_tax,1.0)" in plan


# Runner


def test_unknown_load_type_or_transform_stops_before_any_load(spark, folder):
    good = file_load(f"{folder}/good")
    for bad in ({"load_type": "ftp"}, {}, file_load(folder, "x", "nope"), file_load(" ", "x")):
        with pytest.raises(ValueError):
            run_job(spark, job(loads=[good, bad]), base=rows(spark))
        with pytest.raises(ValueError, match="load|bucket"):
            run_job(spark, job(loads=[good, bad]), batch_id="no such batch", period="1")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/good")


def test_load_without_id_takes_the_base_and_ids_may_be_numbers(spark, folder):
    document = job(
        [{"transform_id": 5, "transform_sql": "SELECT id FROM {{SOURCE_INPUT}} WHERE id < 4"}],
        [file_load(folder, "all"), file_load(folder, "some", 5)],
    )
    result = run_job(spark, document, base=rows(spark))
    assert spark.read.parquet(f"{folder}/all").count() == 10
    assert spark.read.parquet(f"{folder}/some").count() == 4
    logged = {(e.stage, e.target.rsplit("/", 1)[-1]): e.rows for e in result.entries}
    assert logged == {("extract", "frame"): None, ("load", "all"): 10, ("load", "some"): 4, ("transform", "tx_5"): 4}
    assert {e.status for e in result.entries} == {"ok"} and len({e.run_id for e in result.entries}) == 1


def test_without_loads_every_transform_is_planned_and_nothing_runs(spark):
    result = run_job(spark, job([{"transform_sql": "SELECT count(*) AS n FROM source_table"}]), base=rows(spark))
    assert result.frames["1"].first().n == 10
    assert run_job(spark, {}, base=rows(spark)).frames == {}


def test_rows_are_counted_whatever_the_sink_does_with_them(spark, folder):
    loads = [
        file_load(folder, "p", partition_by="part"),
        file_load(folder, "t", format="text", partition_by="part"),
        file_load(folder, "c", format="csv", compression="gzip"),
    ]
    result = run_job(spark, job(loads=loads), base=rows(spark, 1000))
    assert [e.rows for e in result.entries if e.stage == "load"] == [1000] * 3


def test_shared_transform_is_computed_once_and_released(spark, folder):
    document = job(
        [{"transform_id": "r", "transform_sql": "SELECT id, uuid() AS u FROM source_table"}],
        [file_load(folder, "a", "r"), file_load(folder, "b", "r")],
    )
    result = run_job(spark, document, base=rows(spark))
    a, b = (sorted(map(tuple, spark.read.parquet(f"{folder}/{n}").collect())) for n in "ab")
    assert a == b
    assert not result.frames["r"].storageLevel.useMemory


@pytest.mark.parametrize("share", ["persist", "table", "none"])
def test_sharing_of_a_result_with_several_consumers(spark, folder, share):
    document = job(
        [
            {"transform_id": "r", "transform_sql": "SELECT id, uuid() AS u FROM source_table", "share": share},
            {"transform_id": "s", "transform_sql": "SELECT * FROM tx_r"},
            {"transform_id": "t", "transform_sql": "SELECT * FROM tx_r WHERE id >= 0"},
        ],
        [file_load(folder, "s", "s"), file_load(folder, "t", "t")],
    )
    result = run_job(spark, document, base=rows(spark))
    s, t = (sorted(map(tuple, spark.read.parquet(f"{folder}/{n}").collect())) for n in "st")
    assert s == t and len(s) == 10
    counts = {e.target: e.rows for e in result.entries if e.stage == "transform"}
    assert counts == {"tx_r": None if share == "none" else 10, "tx_s": 10, "tx_t": 10}
    assert ("uuid" in result.frames["s"]._jdf.queryExecution().optimizedPlan().toString()) == (share != "table")
    with pytest.raises(ValueError, match="shared"):
        Transform("1", "x", "sometimes")


def keyed_source(spark, folder):
    """A file module with a quality check, and a session whose staging folder is known."""
    spark.createDataFrame([(str(i), f"n{i}") for i in range(20)], "k string, name string").write.csv(
        f"{folder}/in.txt", sep="|", header=True
    )
    props = {"path": folder, "name": "in", "columns": "k,name", "quality_integration": {"columns_key": "k"}}
    return {"type": "file", "properties": props}


def _counted_base(spark, n):
    """A frame of n rows, and an accumulator of the rows that were read from it."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    return spark.range(n).mapInPandas(count, "id long"), read


@pytest.mark.parametrize("at_once", [1, 3])
def test_equal_transforms_are_computed_once(spark, folder, at_once):
    base, read = _counted_base(spark, 40)
    texts = {
        "a": "SELECT id, id * 2 AS twice FROM source_table WHERE id > 9",
        "b": "select x.id, x.id * 2 twice\nfrom {{SOURCE_INPUT}} x where x.id > 9",  # a, written otherwise
        "c": "SELECT id, id * 2 AS other FROM source_table WHERE id > 9",  # another name
        "d": "SELECT count(*) AS n FROM tx_a",
        "e": "SELECT count(*) AS n FROM tx_b",  # equal to d, since b is a
        "u": "SELECT uuid() AS u FROM tx_b",
        "v": "SELECT uuid() AS u FROM tx_a",
    }
    process = job(
        transforms=[{"transform_id": i, "transform_sql": t} for i, t in texts.items()],
        loads=[file_load(folder, i, i) for i in texts if i != "c"],
    )
    shared = {"config_app": [{"name": "load", "properties": {"parallelism": at_once}}]}
    result = run_job(spark, process, shared, batch_id="7", period="202510", base=base)
    assert read.value == 40
    assert {e.target: e.rows for e in result.entries if e.stage == "transform"} == {f"tx_{i}": r for i, r in zip("abdeuv", [30, 30, 1, 1, 30, 30])}
    assert result.frames["a"] is result.frames["b"] and result.frames["d"] is result.frames["e"] and result.frames["u"] is not result.frames["v"]
    assert [result.frames[i].first().n for i in "de"] == [30, 30]


def test_independent_shared_results_are_filled_side_by_side(spark):
    met = threading.Barrier(2, timeout=60)

    def settle(transform, df):
        if transform.id != "3":
            met.wait()  # ends only if both are here at the same time
        return df.persist()

    texts = [Transform("1", "SELECT id FROM source_table"), Transform("2", "SELECT part FROM source_table"), Transform("3", "SELECT * FROM tx_1, tx_2")]
    frames = run_transforms(rows(spark), texts, settle=settle, at_once=2)
    assert list(frames) == ["1", "2", "3"] and frames["3"].count() == 100
    for df in frames.values():
        df.unpersist()


@pytest.mark.parametrize("share", [None, "none"])
def test_base_of_several_loads_is_read_once(spark, folder, share):
    loads = [file_load(folder, n) for n in "abc"]
    settings = {"config_app": [{"name": "extract", "properties": {"share": share}}]} if share else {}
    result = run_job(spark, job(loads=loads, extract=[keyed_source(spark, folder)]) | settings)
    assert any("/in.txt/" in f for f in result.base.inputFiles()) == (share == "none")
    assert [e.rows for e in result.entries if e.stage == "load"] == [20] * 3
    assert [e.rows for e in result.entries if e.stage == "extract"] == [None if share else 20]
    staged = list(result.staged)
    assert len(staged) == (0 if share else 1) and all(os.path.isdir(p) for p in staged)
    result.release()
    assert not any(os.path.exists(p) for p in staged) and not result.staged


def test_staged_tables_go_when_a_run_fails(spark, folder):
    loads = [file_load(folder, "a"), file_load(folder, "b", data_protect_columns={"type": "sha256", "columns": "none"})]
    made = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(runner, "staging_folder", lambda spark, label: made.append(f"{folder}/sluiceway/{label}") or made[-1])
        with pytest.raises(ProtectionError):
            run_job(spark, job(loads=loads, extract=[keyed_source(spark, folder)]))
    assert made == [f"{folder}/sluiceway/base"] and not os.path.exists(made[0])
    with pytest.raises(ValueError, match="no staging folder"):
        remove_staged(spark, folder)


def test_gzip_batch_is_spread_as_the_job_says(spark, folder):
    about = {"format": "text", "compression": "gzip", "columns": ["k"]}
    root = write_batch(spark.range(100).selectExpr("cast(id as string) k").coalesce(1), "7", "202510", about, compression="gzip")
    shared = {"config_app": [{"name": "paths", "properties": {"path_data_s3": root}}]}
    module = {"type": "batch", "properties": {"partitions": "5"}}
    df, _ = read_base(spark, Job(job(extract=[module]), shared, "7", "202510"))
    assert df.rdd.getNumPartitions() == 5 and df.count() == 100


def test_views_leave_persisted_frames_alone(spark):
    base = rows(spark).persist()
    kept = []

    def settle(transform, df):
        kept.append(df.persist())
        return df

    texts = [Transform("r", "SELECT id FROM source_table"), Transform("s", "SELECT * FROM tx_r WHERE id > 1")]
    result = run_transforms(base, texts, settle=settle)
    assert base.storageLevel.useMemory and kept[0].storageLevel.useMemory
    assert "InMemoryTableScan" in result["s"]._jdf.queryExecution().executedPlan().toString()
    for df in (base, *kept):
        df.unpersist()


def test_tolerated_errors_and_the_others(spark, folder):
    rows(spark).write.parquet(f"{folder}/taken")
    failing = file_load(folder, "taken", mode="errorifexists")
    tolerant = file_load(folder, "taken", mode="errorifexists", error_continue="Y")
    sequential = {"config_app": [{"name": "transform", "properties": {"parallelism": 1}}]}
    result = run_job(spark, job(loads=[tolerant, file_load(folder, "next")]) | sequential, base=rows(spark))
    assert [(e.status, e.error) for e in result.entries if e.stage == "load"] == [("error", "AnalysisException"), ("ok", None)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_job(spark, job(loads=[failing, file_load(folder, "never")]) | sequential, base=rows(spark), log_path=f"{folder}/log")
    logged = spark.read.parquet(f"{folder}/log")
    assert sorted((r.stage, r.status) for r in logged.collect()) == [("extract", "ok"), ("load", "error"), ("run", "error")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/never")


def test_protection_errors_are_never_tolerated(spark, folder):
    load = file_load(folder, "x", error_continue="y", data_protect_columns={"type": "sha-256", "columns": "nope"})
    with pytest.raises(ProtectionError):
        run_job(spark, job(loads=[load]), base=rows(spark))


def test_log_holds_no_messages(spark, folder):
    load = file_load(folder, "x", mode="secret-mode", error_continue="y")
    result = run_job(spark, job(loads=[load]), base=rows(spark), log_path=f"{folder}/log")
    assert "secret-mode" not in str(result.entries[1])
    assert result.log().columns == spark.read.parquet(f"{folder}/log").columns


def test_loads_of_one_target_keep_their_order(spark, folder):
    loads = [file_load(folder, "x", mode="overwrite")] + [file_load(folder, "x", mode="append")] * 2 + [file_load(folder, f"y{i}") for i in range(4)]
    run_job(spark, job(loads=loads), base=rows(spark))
    assert spark.read.parquet(f"{folder}/x").count() == 30
    assert spark.read.parquet(*[f"{folder}/y{i}" for i in range(4)]).count() == 40


@pytest.mark.parametrize("parallelism", [1, 4])
def test_a_load_inside_another_ones_folder_keeps_its_place(spark, folder, parallelism):
    loads = [file_load(f"{folder}/out", "detail"), file_load(folder, "out", mode="overwrite"), file_load(folder, "else")]
    settings = {"config_app": [{"name": "load", "properties": {"parallelism": parallelism}}]}
    run_job(spark, job(loads=loads) | settings, base=rows(spark))
    assert spark.read.parquet(f"{folder}/out").count() == 10
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/out/detail")


def test_transforms_with_one_target_keep_their_own_counts(spark, folder):
    texts = [
        {"transform_id": "1", "transform_sql": "SELECT * FROM source_table"},
        {"transform_id": "2", "transform_sql": "SELECT * FROM source_table WHERE id < 3"},
    ]
    loads = [file_load(folder, "x", "1", mode="append"), file_load(folder, "x", "2", mode="append")]
    result = run_job(spark, job(texts, loads), base=rows(spark))
    assert {e.target: e.rows for e in result.entries if e.stage == "transform"} == {"tx_1": 10, "tx_2": 3}


def test_literals_and_aliases_are_no_references(spark, folder):
    texts = [
        {"transform_id": "id", "transform_sql": "SELECT id AS tx_amount FROM {{SOURCE_INPUT}} -- not tx_amount"},
        {"transform_id": "amount", "transform_sql": "SELECT 'FROM tx_id' AS t, id FROM {{SOURCE_INPUT}}"},
        {"transform_id": "b", "transform_sql": "WITH c AS (SELECT * FROM TX_id) SELECT * FROM c WHERE tx_amount IN (SELECT id FROM tx_amount)"},
    ]
    found = {t.id: t.reads({"id", "amount", "b"}) for t in load_transforms(spark, texts)}
    assert found == {"id": set(), "amount": set(), "b": {"id", "amount"}}
    run_job(spark, job(texts, [file_load(folder, "x", "b")]), base=rows(spark))
    assert spark.read.parquet(f"{folder}/x").count() == 10


def test_a_permanent_view_of_a_results_name_stays(spark, folder):
    spark.range(3).write.saveAsTable("kept_rows", path=f"{folder}/kept_rows")
    spark.sql("CREATE OR REPLACE VIEW tx_kept AS SELECT * FROM kept_rows")
    try:
        texts = [Transform("kept", "SELECT id FROM source_table"), Transform("s", "SELECT * FROM tx_kept")]
        assert run_transforms(rows(spark), texts)["s"].count() == 10
        assert spark.table("tx_kept").count() == 3
    finally:
        spark.sql("DROP VIEW tx_kept")
        spark.sql("DROP TABLE kept_rows")


def test_jdbc_loads_go_to_their_sinks(spark, monkeypatch):
    """The writer itself is replaced: no database is at hand."""
    written = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, options, mode, tap: written.append((tap(df).collect(), df.columns, options, mode)))
    monkeypatch.setattr(jdbc, "remote_columns", lambda spark, options, table: [("part", "varchar(9)"), ("id", "smallint")])
    cnx = {"username": "u", "password": "p", "server": "h", "port": "1", "database": "d", "schema": "s"}
    shared = {"config_app": [{"name": n, "properties": cnx} for n in ("postgres-cnx-01", "redshift-cnx-01", "t-1")]}
    loads = [
        {"load_type": "Postgres", "load_properties": {"dbtable": "p.t", "select_cols": ["batch_id", "id"]}},
        {"load_type": "redshift", "load_properties": {"dbtable": "t", "mode": "OVERWRITE"}},
        {"load_type": "teradata", "load_properties": {"connection_name": "t-1", "dbtable": "x.t", "mode": "ignore", "connections": 8}},
    ]
    sequential = {"config_app": [{"name": "transform", "properties": {"parallelism": 1}}]}
    result = run_job(spark, job(loads=loads) | sequential, shared, batch_id="4", period="202510", base=rows(spark, 3))
    audited, aligned, truncating = written
    assert audited[1] == ["batch_id", "id"] and audited[3] == "append"
    assert audited[2]["url"] == "jdbc:postgresql://h:1/d" and audited[2]["isolationLevel"] == "READ_COMMITTED"
    assert audited[2]["driver"] == "org.postgresql.Driver" and audited[2]["batchsize"] == "5000"
    assert aligned[1] == ["part", "id"] and aligned[3] == "overwrite" and aligned[2]["truncate"] == "true"
    assert aligned[2]["dbtable"] == "s.t" and aligned[2]["url"] == "jdbc:redshift://h:1/d"
    assert truncating[3] == "append" and "truncate" not in truncating[2] and truncating[2]["numPartitions"] == "8"
    assert [e.rows for e in result.entries if e.stage == "load"] == [3, 3, 3]
    assert load_target(loads[0], Job({})) == "postgres:default:p.t"


def test_jdbc_sinks_refuse_incomplete_jobs(spark):
    df = rows(spark)
    with pytest.raises(ValueError, match="dbtable"):
        jdbc.load_audited(df, {}, {})
    with pytest.raises(ValueError, match="password"):
        jdbc.load_truncating(df, {"dbtable": "t"}, {"username": "u"})
    with pytest.raises(ValueError, match="server"):
        jdbc.load_aligned(df, {"dbtable": "s.t"}, {"database": "d"})
    with pytest.raises(ValueError, match="connection_name"):
        run_job(spark, job(loads=[{"load_type": "teradata", "load_properties": {"dbtable": "t"}}]), base=df)
    assert jdbc.truncating_options({"dbtable": "t", "mode": "overwrite"}, {"password": "p"})[1] == "overwrite"


def test_a_job_from_documents(spark, folder):
    spark.range(5).write.csv(f"{folder}/in/7_202510/data", sep="|")
    documents = {
        "in/7_202510/metadata.json": {"metadata": {"format": "text", "columns": [{"name": "a", "data_type": "BIGINT"}]}},
        "process.json": job([{"transform_sql": "SELECT a * 2 AS b FROM {{SOURCE_INPUT}}"}], [file_load(folder, "out_abc", "1")]),
        "shared.json": {
            "config_app": [
                {"name": "paths", "properties": {"path_data_onprem": f"{folder}/in"}},
                {"name": "spark-config", "properties": {"spark.sql.test.only": "seen"}},
            ]
        },
    }
    for name, document in documents.items():
        with open(f"{folder}/{name}", "w") as out:
            json.dump(document, out)
    names = ["--process", f"{folder}/process.json", "--shared", f"{folder}/shared.json"]
    main([*names, "--batch-id", "7", "--period", "202510", "--run-id", "r1", "--log-path", f"{folder}/log", "--count-source"])
    assert sorted(r.b for r in spark.read.parquet(f"{folder}/out_202510").collect()) == [0, 2, 4, 6, 8]
    logged = spark.read.parquet(f"{folder}/log").collect()
    assert {(r.run_id, r.stage, r.rows) for r in logged} == {("r1", s, 5) for s in ("extract", "transform", "load")}
    assert spark.conf.get("spark.sql.test.only") == "seen"


# Extract stage


def write_file(folder, text, name="f_202510.txt", encoding="utf-8"):
    with open(f"{folder}/{name}", "w", encoding=encoding) as out:
        out.write(text)


def file_module(folder, **props):
    base = {"path": folder, "name": "f_abc", "extension": "txt", "delimiter": "|", "header": "y"}
    return {"type": "file", "properties": base | props}


def test_described_file(spark, folder):
    write_file(folder, "B|a\n'x'|01\n–|02\n|03\nz|03\n")
    module = file_module(
        folder,
        columns="a,b",
        clean={"enabled_ind": "Y"},
        quality_integration={"columns_key": "a", "columns_critical": "b", "enabled_ind": "Y"},
        reject={"umbral": "50", "enabled_ind": "Y", "path": f"{folder}/rejected"},
        data_protection={"name_method": "M", "columns_sensitive": "b", "enabled_ind": "Y"},
    )
    methods = protection_methods({"m": KEY})
    df, label = read_base(spark, Job(job(extract=[module]), period="202510"), methods)
    assert label == "file:f_abc" and df.columns == ["a", "b"]
    assert sorted(map(tuple, decrypt_columns(df, ["b"], KEY).collect())) == [("01", "x"), ("02", "-")]
    rejected = decrypt_columns(spark.read.parquet(f"{folder}/rejected"), ["b"], KEY)
    assert sorted((r.a, r.b or "", r.reject_reasons) for r in rejected.collect()) == [
        ("03", "", ["blank:b", "repeated_key"]),
        ("03", "z", ["repeated_key"]),
    ]


def test_reject_limit_of_a_file(spark, folder):
    write_file(folder, "a\n1\n1\n2\n")
    quality = {"columns_key": "a", "enabled_ind": "Y"}
    module = file_module(folder, quality_integration=quality, reject={"umbral": "10", "enabled_ind": "Y"})
    with pytest.raises(RejectLimitExceeded):
        run_job(spark, job(extract=[module]), period="202510")
    off = file_module(folder, quality_integration=quality, reject={"umbral": "10", "enabled_ind": "N"})
    assert run_job(spark, job(extract=[off]), period="202510").base.count() == 1
    unchecked = file_module(folder, quality_integration=quality | {"enabled_ind": "N"})
    assert run_job(spark, job(extract=[unchecked]), period="202510").base.count() == 3


def test_single_byte_and_fixed_width_files(spark, folder):
    write_file(folder, "a|b\nPEÑA’s|x–y €\n", encoding="cp1252")
    df, _ = read_base(spark, Job(job(extract=[file_module(folder, clean={"charset": "cp1252"})]), period="202510"))
    assert tuple(df.first()) == ("PEÑA's", "x-y €")
    write_file(folder, "ab1\ncd2\n", name="w.txt")
    module = file_module(folder, name="w", columns="k,v", clean={"fields": [[1, 2], [3, 1]]})
    df, _ = read_base(spark, Job(job(extract=[module])))
    assert sorted(map(tuple, df.collect())) == [("ab", "1"), ("cd", "2")]


def test_extract_modules_of_other_kinds(spark, monkeypatch):
    with pytest.raises(ValueError, match="known kind"):
        read_base(spark, Job(job(extract=[{"type": "queue"}])))
    with pytest.raises(ValueError, match="data_connection"):
        read_base(spark, Job(job(extract=[{"extract_type": "JDBC"}])))
    with pytest.raises(ValueError, match="root"):
        read_base(spark, Job({}, batch_id="1", period="2"))
    from sluiceway.plans import sources

    seen = {}
    monkeypatch.setattr(sources, "read_jdbc", lambda spark, connection, **kw: seen.update(kw, connection=connection) or spark.range(1))
    module = {"extract_type": "jdbc", "data_connection": "c", "dbtable": "t", "partitionColumn": "k", "lowerBound": 1, "upperBound": 9, "numPartitions": "4"}
    shared = {"config_app": [{"name": "c", "properties": {"server": "h"}}]}
    df, label = read_base(spark, Job(job(extract=[file_module("x"), module]), shared))
    assert label == "jdbc:t" and seen["connection"] == {"server": "h"} and seen["split"].parts == 4


def test_sample(spark):
    assert sample_rows(rows(spark), 3).count() == 3
    assert runner.LOAD_TYPES == ("s3", "athena", "teradata", "redshift", "postgres", "jdbc_postgres", "jdbc")
