"""Content-addressed web archive: payloads once by digest, record headers apart, records rebuilt by joins.

An archive is a folder with two tables. `payloads` holds each payload's bytes once, under its SHA-256; `records` holds
the exact header block of every WARC record, in the order of the fields written, with the digest it refers to. A
record's bytes are its header block, the payload and two line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.sinks.staging import staging_folder

# The alphabet of base32 (RFC 4648), and that of base-32 numbers as Spark's conv() writes them.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# The profile of a revisit by equal payload, and the type of its content.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTML_TYPE = "text/html; charset=utf-8"
# The date of records whose own is not known.
UNDATED = "1970-01-01T00:00:00Z"
LINE = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of bytes in base32: every 5 hexadecimal digits are 4 digits of base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), CONV32, BASE32)


def _header(names: list[tuple[str, Column]]) -> Column:
    """Header block of the fields that are not NULL."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(LINE)) for name, value in names]
    return F.concat(F.lit(f"WARC/1.1{LINE}"), *[F.coalesce(x, F.lit("")) for x in lines], F.lit(LINE))


def field(header: Column, name: str) -> Column:
    """A field of a header block; NULL where the block has none."""
    found = F.regexp_extract(header, rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(header.contains(f"\n{name}: "), found)


def write_archive(pages: DataFrame, path: str, key: str, url: str, html: str, least: int = 0, date: str | None = None) -> None:
    """Write a record per row of `pages`.

    Of rows with equal payloads of at least `least` bytes, the one with the largest key is a response and the others
    revisit it; rows with smaller payloads are all responses. A NULL html is an empty payload. A NULL key is smaller
    than any other; rows that repeat the largest key with the same payload are all responses to the one stored
    payload. Line ends in a url are percent-encoded, so that a header field stays one line. `date` names a column of
    timestamps; without it, and where it is NULL, records have the date `UNDATED`. Rows alike in key, url, payload and
    date are numbered, so that no two records share an id. Other columns are ignored.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    when = F.date_format(F.to_utc_timestamp(F.col(date).cast("timestamp"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date else F.lit(None)
    rows = pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(when, F.lit(UNDATED)).alias("date"),
        payload.alias("payload"),
    )
    digest = F.sha2("payload", 256).alias("digest")
    # One shuffle of payloads: equal ones become one already before it.
    rows.groupBy(digest, F.octet_length("payload").cast("long").alias("bytes")).agg(
        F.first("payload").alias("payload")
    ).select("digest", "bytes", "payload").write.parquet(f"{path}/payloads")

    # Rows alike become one row and a count before any shuffle, whatever their number.
    slim = rows.groupBy(
        "key", "url", "date", digest, F.octet_length("payload").cast("long").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1")
    ).agg(F.count(F.lit(1)).alias("alike"))
    # An id is the key, a hash of what else tells records apart, and a number among those alike.
    rest = F.substring(F.sha2(F.concat_ws("\n", F.col("date"), F.col("digest"), F.coalesce(F.concat(F.lit("u"), "url"), F.lit("none"))), 256), 1, 32)
    slim = slim.withColumn("name", F.concat(F.coalesce(F.col("key").cast("string"), F.lit("none")), F.lit(":"), rest))
    # NULL keys come last in a maximum.
    largest = slim.groupBy("digest").agg(F.max(F.struct("key", "name")).alias("largest")).withColumnRenamed("digest", "of")
    named = slim.join(largest, F.col("digest") == F.col("of")).withColumn("nr", F.explode(F.sequence(F.lit(1).cast("long"), "alike")))
    is_response = (F.col("bytes") < least) | F.col("key").eqNullSafe(F.col("largest.key"))
    clean_url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = _header(
        [
            ("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
            ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), "name", F.lit(":"), F.col("nr").cast("string"), F.lit(">"))),
            ("WARC-Date", F.col("date")),
            ("WARC-Target-URI", clean_url),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
            ("WARC-Refers-To", F.when(~is_response, F.concat(F.lit("<urn:page:"), F.col("largest.name"), F.lit(":1>")))),
            ("WARC-Profile", F.when(~is_response, F.lit(SAME_PAYLOAD))),
            ("Content-Type", F.when(is_response, F.lit(HTML_TYPE))),
            ("Content-Length", F.when(is_response, F.col("bytes")).otherwise(0).cast("string")),
        ]
    )
    named.select(header.alias("header"), "digest", "bytes").write.parquet(f"{path}/records")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payloads with their digest, each checked anew: bytes that don't match their digest end the job."""
    rows = spark.read.parquet(f"{path}/payloads")
    wrong = (F.sha2("payload", 256) != F.col("digest")) | (F.octet_length("payload") != F.col("bytes"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("payload doesn't match its digest "), "digest")).cast("string")).otherwise(F.col("digest"))
    return rows.select(checked.alias("digest"), F.octet_length("payload").cast("long").alias("bytes"), "payload")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: key, type, what a revisit refers to, header block, and size and digest of the payload read."""
    stored = read_payloads(spark, path).select(
        F.col("digest").alias("of"), F.col("bytes").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest")
    )
    records = spark.read.parquet(f"{path}/records").select("header", "digest")
    number = lambda name: F.regexp_extract(field(F.col("header"), name), "^<urn:page:(-?[0-9]+):[0-9a-f]+:[0-9]+>$", 1)
    return records.join(stored, F.col("digest") == F.col("of")).select(
        F.nullif(number("WARC-Record-ID"), F.lit("")).cast("long").alias("key"),
        field(F.col("header"), "WARC-Target-URI").alias("url"),
        "payload_bytes",
        "payload_digest",
        field(F.col("header"), "WARC-Type").alias("record_type"),
        F.nullif(number("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
        "header",
        "digest",
    )


def rebuilt(spark: SparkSession, path: str) -> DataFrame:
    """The records as they are in a WARC file: (header, payload, record), revisits with the payload they refer to apart.

    `payload` is the full payload of every record, `record` the bytes of the record itself, which for a revisit hold
    no payload.
    """
    records = spark.read.parquet(f"{path}/records").select("header", "digest")
    stored = read_payloads(spark, path).select(F.col("digest").alias("of"), "payload")
    own = F.when(field(F.col("header"), "WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.join(stored, F.col("digest") == F.col("of")).select(
        "header", "payload", F.concat(F.col("header").cast("binary"), own, F.lit(b"\r\n\r\n")).alias("record")
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_folder(spark, "archive")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, "page_id", "url", "html")
    return read_records(spark, path).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# A digest in base32 is the 160 bits of the hash in 32 letters of 5 bits; SQL takes them from 8 numbers of 20 bits.
_LETTERS = " || ".join(
    f"substr('{BASE32}', 1 + CAST((('0x' || substr(sha, {1 + 5 * k}, 5))::BIGINT >> {shift}) & 31 AS INTEGER), 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)
OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS sha,
      max(page_id) OVER (PARTITION BY body) AS largest FROM p)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM d
"""
