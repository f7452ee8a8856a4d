import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from sluiceway.functions.names import is_yes
from sluiceway.sources.batches import batch_folder, batch_root, descriptor_schema, read_batch
from sluiceway.sources.files import PLAIN_FILES, has_files, read_delimited, read_first_available, read_fixed_width
from sluiceway.sources.jdbc import ReadSplit, read_jdbc, read_options, remote_columns
from sluiceway.sources.splits import derived_ranges
from sluiceway.sources.typed import read_typed

CONNECTION = {
    "driver": "no.such.Driver",
    "username": "u",
    "password": "p",
    "server": "h",
    "port": 1234,
    "database": "d",
    "connection_url": "jdbc:nosuch://{{server}}:{{port}}/{{database}}",
}


def put(path, text, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt") as out:
        out.write(text)


def batch(root, about, files):
    put(f"{root}/7_202510/metadata.json", json.dumps({"metadata": about}, indent=1))
    for name, text in files.items():
        put(f"{root}/7_202510/data/{name}", text, gzip.open if name.lower().endswith(".gz") else open)


def test_descriptor_schema():
    columns = [
        {"name": "late", "data_type": "int", "order": "20"},
        "plain",
        {"name": "first", "data_type": "DECIMAL(10,2)", "order": "1"},
        {"name": "unordered"},
        {"name": "odd", "data_type": "DATE", "order": "x"},
        {"name": "  ", "data_type": "INT", "order": "2"},
    ]
    schema = descriptor_schema({"metadata": {"columns": columns}})
    assert schema.simpleString() == (
        "struct<unordered:string,odd:date,first:decimal(10,2),late:int,plain:string>"
    )
    assert all(f.nullable for f in schema.fields)
    assert descriptor_schema({"metadata": {}}) is None
    assert descriptor_schema({}) is None


def test_batch_place():
    assert batch_root({"path_data_s3": " ", "path_data_onprem": "/x/"}) == "/x"
    assert batch_root({"path_data_s3": "s3://b/p/", "path_data_onprem": "/x"}) == "s3://b/p"
    assert batch_folder("/x/", "7", "202510") == "/x/7_202510"
    with pytest.raises(ValueError):
        batch_root({})
    for batch_id, period in (("", "202510"), ("7", None)):
        with pytest.raises(ValueError):
            batch_folder("/x", batch_id, period)


def test_batch_reads_only_data_files_whatever_their_case(spark, folder):
    columns = [{"name": "a", "data_type": "INT", "order": 1}, {"name": "b", "data_type": "DATE", "order": 2}]
    files = {"one.CSV": "1|2024-01-01\n", "two.dat": "x|bad\n", "three.json": "9|2024-01-01\n", "sub/four.csv": "5|\n"}
    batch(folder, {"format": "text", "columns": columns}, files)
    rows = sorted(map(tuple, read_batch(spark, folder, "7", "202510").collect()), key=str)
    assert [(a, str(b)) for a, b in rows] == [(1, "2024-01-01"), (None, "None")]


def test_batch_without_data_extension_is_read_whole(spark, folder):
    batch(folder, {"delimiter": ","}, {"part-0": "1,a\n", "part-1": "2,b\n"})
    df = read_batch(spark, folder, "7", "202510")
    assert df.columns == ["_c0", "_c1"] and df.count() == 2


def test_batch_gzip(spark, folder):
    about = {"format": "text", "compression": "GZIP", "columns": ["a"]}
    batch(folder, about, {"x.TXT.GZ": "q\nr\n", "y.txt": "not me\n"})
    df = read_batch(spark, folder, "7", "202510", partitions=3)
    assert sorted(r.a for r in df.collect()) == ["q", "r"] and df.rdd.getNumPartitions() == 3


def test_missing_descriptor_or_data(spark, folder):
    with pytest.raises(FileNotFoundError):
        read_batch(spark, folder, "7", "202510")
    put(f"{folder}/7_202510/metadata.json", "{}")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_batch(spark, folder, "7", "202510")


def test_first_available_order_and_failure(spark, folder):
    with pytest.raises(FileNotFoundError):
        read_first_available(spark, folder)
    put(f"{folder}/data.csv", "a|b\n1|x\n")
    assert read_first_available(spark, folder).dtypes == [("a", "int"), ("b", "string")]
    put(f"{folder}/data.txt", "c|d\n2|y\n")
    assert read_first_available(spark, folder).columns == ["c", "d"]


def test_blank_header_means_no_header(spark, folder):
    put(f"{folder}/data.txt", "|\n2|y\n")
    df = read_first_available(spark, folder)
    assert df.columns == ["col_1", "col_2"] and df.count() == 2


def test_strings_keep_leading_zeros(spark, folder):
    put(f"{folder}/s.txt", "CODMES|CODDOC\n202510|00000001\n")
    assert tuple(read_delimited(spark, f"{folder}/s.txt", header=True).first()) == ("202510", "00000001")
    assert has_files(spark, folder, PLAIN_FILES) and not has_files(spark, folder, "*.gz")


def test_fixed_width_places_count_after_cleansing(spark, folder):
    put(f"{folder}/raw", "00'1" + "NAME".ljust(50) + "AB\n")
    row = read_fixed_width(spark, f"{folder}/raw").first()
    assert (row.col_1, row.col_2, row.col_3, row.col_6) == ("001", "NAME".ljust(50), "AB", "")


def test_jdbc_options():
    options = read_options(CONNECTION, dbtable="s.t")
    assert options == {
        "url": "jdbc:nosuch://h:1234/d",
        "driver": "no.such.Driver",
        "user": "u",
        "password": "p",
        "dbtable": "s.t",
    }
    assert read_options(CONNECTION, "s.t", "SELECT 1")["query"] == "SELECT 1"
    split = read_options(CONNECTION, query="SELECT 1 AS k", split=ReadSplit("k", 0, 9, 4), fetch_size=100)
    assert "query" not in split and split["dbtable"] == "(SELECT 1 AS k) q"
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "k", "0", "9", "4",
    )
    assert split["fetchsize"] == "100"
    with pytest.raises(ValueError, match="dbtable"):
        read_options(CONNECTION)
    for key in CONNECTION:
        with pytest.raises(ValueError, match=key):
            read_options({**CONNECTION, key: ""}, "t")


def test_jdbc_readers_reach_the_driver(spark):
    """No database is at hand; Spark gets as far as looking for its driver."""
    with pytest.raises(Exception, match="no.such.Driver"):
        read_jdbc(spark, CONNECTION, dbtable="s.t")
    with pytest.raises(Exception, match="no.such.Driver"):
        remote_columns(spark, {"url": "jdbc:nosuch://h", "driver": "no.such.Driver"}, "s.t")


def test_flags_default_to_off():
    assert not is_yes({}.get("header"))


CELLS = {
    "small": (["1", "-2", None], "int"),
    "long": (["1", "3000000000", "0"], "bigint"),
    "longer": (["1", "99999999999999999999", "0"], "decimal(38,0)"),
    "longest": (["1", "9" * 50, "0"], "double"),
    "fraction": (["1", "2.5", "1e3"], "double"),
    "day": (["2024-02-29", None, "1999-12-31"], "date"),
    "no_day": (["2023-02-29", "2024-02-29", None], "string"),
    "time": (["2024-02-29", "2024-01-01 10:11:12.5", None], "timestamp"),
    "mixed": (["2024-02-29", "7", None], "string"),
    "empty": ([None, None, None], "string"),
    "dotted.name": (["1", "x", "2"], "string"),
}


def test_types_of_cells(spark, folder):
    rows = list(zip(*[cells for cells, _ in CELLS.values()]))
    put(f"{folder}/a/one.csv", "|".join(CELLS) + "\n" + "".join("|".join(c or "" for c in r) + "\n" for r in rows[:2]))
    put(f"{folder}/a/two.csv", "|".join(CELLS) + "\n" + "|".join(c or "" for c in rows[2]) + "\n")
    got = read_typed(spark, f"{folder}/a", header=True)
    assert got.columns == list(CELLS)
    assert [t for _, t in got.dtypes] == [t for _, t in CELLS.values()]
    assert got.count() == 3
    # One type for a column, whichever file or row comes first.
    assert [t for _, t in read_typed(spark, f"{folder}/a/two.csv", header=True).dtypes][3] == "int"
    put(f"{folder}/none.csv", "a|b\n")
    assert read_typed(spark, f"{folder}/none.csv", header=True).dtypes == [("a", "string"), ("b", "string")]


def test_text_is_parsed_once(spark, folder):
    put(f"{folder}/a.csv", "a|b\n1|2\n")
    plan = read_typed(spark, f"{folder}/a.csv", header=True).select("b")._jdf.queryExecution().toString()
    assert "csv" not in plan.lower().replace("a.csv", "") and "ReadSchema: struct<c1:string>" in plan


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,2)", "date", "timestamp"])
def test_derived_ranges_are_even_and_miss_no_row(spark, kind):
    """A third of the rows hold one value, some none; the other values are far apart at one end."""
    number = F.when(F.col("id") % 3 == 0, 50).when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") * F.col("id")) % 90_000)
    value = {
        "date": F.date_add(F.lit("2000-01-01").cast("date"), number.cast("int")),
        "timestamp": F.timestamp_seconds(number.cast("bigint") * 1000),
    }.get(kind, number.cast(kind))
    rows = spark.range(0, 20_000, 1, 4).select(value.alias("a`b c"))
    ranges = derived_ranges(rows, "a`b c", 20)
    sizes = [rows.where(r).count() for r in ranges]
    assert sum(sizes) == 20_000 and sizes[-1] == rows.where(F.col("`a``b c`").isNull()).count() > 0
    filled = 20_000 - sizes[-1]
    assert sorted(sizes[:-1])[-2] < 2 * filled / 20 and max(sizes[:-1]) < filled / 2
    once = sum(F.coalesce(F.expr(r), F.lit(False)).cast("int") for r in ranges)
    assert rows.where(once != 1).isEmpty()


def test_derived_ranges_at_the_edges(spark):
    none = spark.range(3).select(F.lit(None).cast("int").alias("a"))
    assert derived_ranges(none, "a", 4) == derived_ranges(none, "a", 1) == ["`a` IS NOT NULL", "`a` IS NULL"]
    odd = spark.createDataFrame([(float("nan"),), (float("-inf"),), (1.0,), (2.0,), (None,)], "a double")
    assert sum(odd.where(r).count() for r in derived_ranges(odd, "a", 2)) == 5
    with pytest.raises(TypeError):
        derived_ranges(spark.createDataFrame([("x",)], "a string"), "a", 2)
    with pytest.raises(ValueError):
        derived_ranges(none, "a", 0)
    with pytest.raises(ValueError, match="not by both"):
        read_jdbc(spark, CONNECTION, dbtable="s.t", split=ReadSplit("a", 1, 2, 2), ranges=["a IS NULL"])
