import base64
import shutil
import subprocess

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.casts import lenient_cast
from sluiceway.functions.cleansing import cleanse
from sluiceway.functions.crypto import CipherKey, decrypt_text, encrypt_text, sha256_hex
from sluiceway.functions.names import fill_template, is_yes, name_list, split_table_name, stamp_period
from sluiceway.functions.types import parse_type, type_class

KEY = CipherKey(bytes(range(32)), bytes(range(16)))


@pytest.mark.parametrize(
    "text, descriptor, destination",
    [
        ("DECIMAL(10,2)", T.DecimalType(10, 2), T.DecimalType(10, 2)),
        ("numeric( 12 , 4 )", T.DecimalType(12, 4), T.DecimalType(38, 10)),
        ("DECIMAL", T.StringType(), T.DecimalType(38, 10)),
        ("BIGINT", T.LongType(), T.LongType()),
        ("int8", T.StringType(), T.LongType()),
        ("SMALLINT", T.ShortType(), T.ShortType()),
        ("INT", T.IntegerType(), T.IntegerType()),
        ("int4", T.StringType(), T.IntegerType()),
        ("INTEGER", T.IntegerType(), T.IntegerType()),
        ("LONG", T.LongType(), T.StringType()),
        ("BYTEINT", T.StringType(), T.StringType()),
        ("NUMBER(10,2)", T.StringType(), T.StringType()),
        ("DOUBLE", T.DoubleType(), T.StringType()),
        ("double precision", T.DoubleType(), T.DoubleType()),
        ("FLOAT", T.DoubleType(), T.StringType()),
        ("float8", T.DoubleType(), T.DoubleType()),
        ("REAL", T.DoubleType(), T.FloatType()),
        ("float4", T.DoubleType(), T.FloatType()),
        ("BOOLEAN", T.StringType(), T.BooleanType()),
        ("bool", T.StringType(), T.BooleanType()),
        ("DATE", T.DateType(), T.DateType()),
        ("DATETIME", T.DateType(), T.StringType()),
        ("TIMESTAMP", T.TimestampType(), T.TimestampType()),
        ("timestamp without time zone", T.TimestampType(), T.TimestampType()),
        ("TIME", T.TimestampType(), T.StringType()),
        ("VARCHAR(20)", T.StringType(), T.StringType()),
        ("", T.StringType(), T.StringType()),
    ],
)
def test_type_texts(text, descriptor, destination):
    assert parse_type(text) == descriptor
    assert parse_type(text, "destination") == destination


@pytest.mark.parametrize(
    "text, catalog, generic",
    [
        ("varchar(10)", "string", "string"),
        ("character varying", "string", "string"),
        ("text", "string", "string"),
        ("CLOB", "other", "string"),
        ("boolean", "other", None),
        ("integer", "other", "other"),
        ("numeric(4,1)", "other", "other"),
        ("timestamp", "other", "other"),
    ],
)
def test_type_classes(text, catalog, generic):
    assert type_class(text) == catalog
    assert type_class(text, "generic") == generic


@pytest.mark.parametrize(
    "name, stamped",
    [
        ("out_abc", "out_202510"),
        ("out_ABC", "out_202510"),
        ("out_abc_x", "out_abc_x"),
        ("out_{fecinfo}_abc", "out_202510_abc"),
        ("{fecinfo}{fecinfo}", "202510202510"),
        ("abc", "abc"),
        ("_abc", "_202510"),
        ("", ""),
    ],
)
def test_period_in_names(name, stamped):
    assert stamp_period(name, "202510") == stamped


def test_small_helpers():
    assert [is_yes(v) for v in ("Y", " yes ", "1", "true", True, "n", "", None)] == [True] * 5 + [False] * 3
    assert name_list(" a, ,b ") == name_list(["a", " b", ""]) == ["a", "b"]
    assert name_list(None) == []
    assert fill_template("x://{{server}}:{{port}}/{{other}}", {"server": "h", "port": 1}) == "x://h:1/{{other}}"
    assert split_table_name("s.t.u") == ("s", "t.u")
    assert split_table_name("t", "d") == ("d", "t")
    for bad in ("t", ".t", "s."):
        with pytest.raises(ValueError):
            split_table_name(bad)


TARGETS = ["tinyint", "smallint", "int", "bigint", "decimal(10,2)", "double", "float", "boolean", "date", "timestamp"]


def both_casts(spark, texts):
    """Our casts, and what a session without strict casts would give."""
    df = spark.createDataFrame([(t,) for t in texts], "x string").coalesce(1)
    types = [T._parse_datatype_string(t) for t in TARGETS]
    ours = df.select(*[lenient_cast(F.col("x"), T.StringType(), t).cast("string") for t in types]).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        loose = df.select(*[F.col("x").cast(t).cast("string") for t in types]).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    return [tuple(r) for r in ours], [tuple(r) for r in loose]


FIXED = [
    "1.5", "-1.9", "1e3", " 12 ", "99999999999", "abc", "", " ", "+7", "-", "+", ".", "-.", "1.", ".5", "-.5", "1.5e1",
    "0x10", "0x1p3", "1_000", "12abc", "1.a", "\t3\n", "\x7f4\x00", "--1", "2147483647", "2147483648", "-2147483648",
    "-2147483649", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "127", "128", "-128", "-129",
    "32767", "32768", "000000000000000000000000000012", "1 2", "Infinity", "-inf", "NaN", "nan", "1d", "1f", "1.5D",
    "tRue", " yes ", "YES", "n", "0", "1", "falsey", "2020-1-1", "2020", "2020-02-30", "202510", "2020-01-01T00:00:00",
    "99999999999999999999.5", "1.9999999999999999999999999", "12345678901234567890123456789012345678901", "1.005",
    "12345678.999", "99999999.995", None,
]


def test_text_casts_as_a_loose_session_would(spark):
    ours, loose = both_casts(spark, FIXED)
    assert dict(zip(FIXED, ours)) == dict(zip(FIXED, loose))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789+-.eE dDfFnNaAiItTyYsSoOxX\t", max_size=24), min_size=40, max_size=80))
def test_random_text_casts_as_a_loose_session_would(spark, texts):
    ours, loose = both_casts(spark, texts)
    assert dict(zip(texts, ours)) == dict(zip(texts, loose))


def test_other_casts_give_null_where_nothing_fits(spark):
    df = spark.sql("SELECT 99999999999L AS l, 1e20D AS d, DATE '2024-01-01' AS day, 12.5BD AS n, true AS b")

    def cast(name, target):
        return df.select(lenient_cast(F.col(name), df.schema[name].dataType, T._parse_datatype_string(target))).first()[0]

    assert cast("l", "int") is None
    assert cast("d", "bigint") is None
    assert cast("day", "int") is None
    assert cast("n", "int") == 12
    assert cast("b", "int") == 1
    assert str(cast("day", "timestamp"))[:10] == "2024-01-01"


def test_sha256(spark):
    df = spark.sql("SELECT 12 AS n, CAST(NULL AS STRING) AS nothing, 'ñ' AS s")
    row = df.select(sha256_hex(F.col("n")), sha256_hex(F.col("nothing")), sha256_hex(F.col("s"))).first()
    import hashlib

    assert list(row) == [hashlib.sha256(b"12").hexdigest(), None, hashlib.sha256("ñ".encode()).hexdigest()]


TEXTS = ["", "hola", "a" * 15, "a" * 16, "b" * 83, "ñandú 北京", "x" * 5000]


@pytest.mark.skipif(shutil.which("openssl") is None, reason="no openssl to compare with")
def test_cipher_text_is_plain_aes(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    for text, sealed in df.select("x", encrypt_text(F.col("x"), KEY)).collect():
        command = ["openssl", "enc", "-aes-256-cbc", "-K", KEY.key.hex(), "-iv", KEY.iv.hex()]
        want = subprocess.run(command, input=text.encode(), capture_output=True, check=True).stdout
        assert sealed == base64.b64encode(want).decode()


def test_cipher_roundtrip_and_bad_input(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "x string")
    sealed = df.withColumn("e", encrypt_text(F.col("x"), KEY))
    rows = sealed.withColumn("d", decrypt_text(F.col("e"), KEY)).collect()
    assert [r.d for r in rows] == [*TEXTS, None]
    bad = spark.createDataFrame([(t,) for t in ("", " ", "====", "!!bad", "abcd", "A" * 22 + "==")], "x string")
    assert [r[0] for r in bad.select(decrypt_text(F.col("x"), KEY)).collect()] == [None] * 6
    other = CipherKey(bytes(32), bytes(16))
    assert sealed.where("x = 'hola'").select(decrypt_text(F.col("e"), other)).first()[0] is None


def test_key_is_derived_and_never_printed(spark, capsys):
    key = CipherKey.derive("secret", b"salt", bytes(16), rounds=10)
    import hashlib

    assert key.key == hashlib.pbkdf2_hmac("sha256", b"secret", b"salt", 10, 32)
    df = spark.createDataFrame([("a",)], "x string").select(encrypt_text(F.col("x"), key).alias("x"))
    df.explain("extended")
    printed = capsys.readouterr().out + repr(key) + str(df._jdf.queryExecution())
    assert key.key.hex() not in printed.lower() and repr(key.key) not in printed
    with pytest.raises(ValueError):
        CipherKey(b"short", bytes(16))


def test_cleansing_utf8(spark):
    df = spark.createDataFrame([("d'Ó–a\u00a0b Ã\u0153x – ''",)], "x string")
    assert df.select(cleanse(F.col("x"))).first()[0] == "dÓ-a b Üx - "


def test_cleansing_single_bytes(spark, folder):
    raw = b"a'b\xe2\x80\x93c\xc2\xa0d\xc3\x83\xc5\x93e\x96f\x92g\x94h\x85i\x93j\x90k\x91l\x95m\x97n\x8ao\xd3p\x80q"
    with open(f"{folder}/raw.txt", "wb") as out:
        out.write(raw + b"\n")
    df = spark.read.text(f"{folder}/raw.txt")
    assert df.select(cleanse(F.col("value"), "cp1252")).first()[0] == "ab-c dÜe-f'ghijklmnSoÓp€q"


def test_cleansing_with_own_rules_keeps_their_order(spark):
    df = spark.createDataFrame([("a-b_c",)], "x string")
    assert df.select(cleanse(F.col("x"), rules=[("-", "_"), ("_", "+"), ("+c", "!")])).first()[0] == "a+b!"
