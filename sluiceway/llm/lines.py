"""Line dedup by a deletion-neighbourhood join.

Lines are compared by their words. A line's neighbourhood within one edit is found by hashed variants: each line emits
what is left when it drops one word (with the place of the word), and itself with a gap at every place. Lines that
differ by a replaced word share the variant that drops it; a line with one word more shares its variant with the
shorter line's gap. Everything that shares a variant and place is within one edit, so the earliest line of a variant
stands for all of them, and no pairs of a group are emitted.

One edit leaves one half of a line untouched. Only lines that share a half with another line can have a neighbour, so
only these emit variants: the others, nearly all of a corpus, cost four hashes each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.shared import WORD, free_name, let, staged

# Lines of fewer words are only compared exactly: one edit of five words leaves a similarity of 0.8.
LEAST_WORDS = 5
# Rows of a hot half or variant are dealt out over so many places where they meet what is known of it.
SALTS = 16
_CHUNK = 64


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def words_of(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(f"({WORD})"), 1)


def running_sums(values: Column) -> Column:
    """Sums of an array of longs up to each element; by chunks, so that long arrays are not copied for every element."""

    def sums(items: Column) -> Column:
        return F.aggregate(
            items,
            F.array().cast("array<bigint>"),
            lambda s, x: F.concat(s, F.array(F.coalesce(F.get(s, F.size(s) - 1), F.lit(0).cast("bigint")) + x)),
        )

    def inside(all_values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / _CHUNK).cast("int"))
        return F.transform(starts, lambda c: sums(F.slice(all_values, c * _CHUNK + 1, F.lit(_CHUNK))))

    def added(chunks: Column) -> Column:
        before = sums(F.transform(chunks, lambda c: F.get(c, F.size(c) - 1)))
        return let(
            before,
            lambda b: F.transform(
                chunks, lambda c, i: F.transform(c, lambda x: x + F.when(i > 0, F.get(b, i - 1)).otherwise(F.lit(0)))
            ),
        )

    return let(
        values,
        lambda v: F.when(F.size(v) > 0, F.flatten(let(inside(v), added))).otherwise(F.array().cast("array<bigint>")),
    )


def _print(text: Column) -> Column:
    """With the key, what a row is told by: keys may be NULL or stand at several texts."""
    return F.xxhash64(text)


def _place() -> Column:
    return F.struct(F.col("key").isNull().alias("last"), "key", "print", "nr")


def _occurrences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every line with words: its place (no key last, key, print, nr), two hashes, and hashes of its halves."""
    body = F.col(text).cast("string")
    rows = docs.select(
        F.col(key).cast("long").alias("key"), _print(body).alias("print"), F.posexplode(lines_of(body)).alias("nr", "line")
    ).select("key", "print", "nr", words_of(F.col("line")).alias("words"))
    n = F.size("words")
    # A partner has as many words, one more or one less; the halves are those of the shorter of both.
    half = F.floor(n / 2).cast("int")
    less = F.floor((n - 1) / 2).cast("int")

    def halves(size: Column) -> list[Column]:
        return [
            F.xxhash64(F.lit("first"), size, F.slice("words", F.lit(1), size)),
            F.xxhash64(F.lit("last"), size, F.slice("words", n - size + 1, size)),
        ]

    keys = F.when(n >= LEAST_WORDS, F.when(half == less, F.array(*halves(half))).otherwise(F.array(*halves(half), *halves(less))))
    return rows.where(n > 0).select(
        _place().alias("place"),
        F.xxhash64("words").alias("h1"),
        F.xxhash64(F.lit(1), "words").alias("h2"),
        keys.alias("halves"),
    )


def _shared_keys(rows: DataFrame, key: str, about: list[Column]) -> DataFrame:
    """What several rows have in common: one row (key, salt, about) per key of more than one row and salt."""
    return (
        rows.groupBy(F.col(key).alias("of"))
        .agg(F.count(F.lit(1)).alias("rows"), *about)
        .where("rows > 1")
        .drop("rows")
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def _sums(words: Column) -> Column:
    """Sums over a line's words up to each place, of hashes of a word and its distance from the line's start and end."""
    n = F.size("words")
    mask = F.lit((1 << 40) - 1)
    from_left = running_sums(F.transform(words, lambda w, i: F.xxhash64(i, w).bitwiseAND(mask)))
    from_right = running_sums(F.transform(words, lambda w, i: F.xxhash64(n - i, w).bitwiseAND(mask)))
    zero = F.array(F.lit(0).cast("bigint"))
    return F.struct(F.concat(zero, from_left).alias("left"), F.concat(zero, from_right).alias("right"))


def _variants(sums: Column, n: Column) -> Column:
    """Hashes of a line of `n` words without its j-th word, for every j, and of the line with a gap at every place.

    A variant is told by the sum over the words before the gap and the sum over those after it.
    """
    left, right = sums["left"], sums["right"]
    whole = F.get(right, n)
    dropped = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda j: F.struct(j.alias("gap"), F.xxhash64(n - 1, j, F.get(left, j), whole - F.get(right, j + 1)).alias("key")),
    )
    gaps = F.transform(
        F.sequence(F.lit(0), n),
        lambda j: F.struct(j.alias("gap"), F.xxhash64(n, j, F.get(left, j), whole - F.get(right, j)).alias("key")),
    )
    return F.concat(dropped, gaps)


def _one_edit(a: Column, b: Column, gap: Column) -> Column:
    """Are two different lines one edit apart, at the gap?"""

    def without(words: Column) -> Column:
        return F.concat(F.slice(words, F.lit(1), gap), F.slice(words, gap + 2, F.greatest(F.size(words) - gap - 1, F.lit(0))))

    same = F.when(F.size(a) == F.size(b), without(a) == without(b))
    return same.when(F.size(a) == F.size(b) + 1, without(a) == b).otherwise(a == without(b))


def _near_earlier(docs: DataFrame, firsts: DataFrame, key: str, text: str) -> DataFrame:
    """(h1, h2) of lines that have an earlier line within one edit."""
    halves = firsts.where("halves is not null").select("h1", F.explode("halves").alias("half"))
    shared = staged(_shared_keys(halves, "half", []), "halves")
    open_lines = (
        halves.withColumn("salt", _salt("h1"))
        .join(shared, (F.col("half") == F.col("of")) & (F.col("salt") == F.col("at")), "left_semi")
        .select(F.col("h1").alias("open"))
        .distinct()
    )
    # Their words are read where each line stands first.
    wanted = (
        firsts.join(open_lines, F.col("h1") == F.col("open"), "left_semi")
        .groupBy(F.col("place.key").alias("in"), F.col("place.print").alias("of"))
        .agg(F.collect_set(F.struct("place.nr", "h1")).alias("wanted"))
    )
    body = F.col(text).cast("string")
    texts = docs.select(F.col(key).cast("long").alias("key"), _print(body).alias("print"), body.alias("text"))
    lines = (
        texts.join(wanted.hint("merge"), F.col("key").eqNullSafe(F.col("in")) & (F.col("print") == F.col("of")))
        .select(
            "key",
            "print",
            F.explode(
                let(
                    lines_of(F.col("text")),
                    lambda all_lines: F.transform(
                        "wanted", lambda w: F.struct(w["nr"], w["h1"], F.get(all_lines, w["nr"]).alias("line"))
                    ),
                )
            ).alias("one"),
        )
        .select("key", "print", "one.nr", F.col("one.h1").alias("wanted"), words_of(F.col("one.line")).alias("words"))
        .select("key", "print", "nr", "wanted", "words", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"))
        .where("h1 = wanted")
        .drop("wanted")
    )
    lines = staged(lines, "lines")
    lines = lines.withColumn("place", _place())
    emitted = lines.select(
        "h1", F.explode(let(_sums(F.col("words")), lambda s: _variants(s, F.size("words")))).alias("variant")
    ).select("h1", "variant.*")
    # Nearly all variants are met once: only their hashes are counted, and what belongs to the others is read later.
    shared_variants = staged(_shared_keys(emitted, "key", []), "variants")
    at_salt = (F.col("key") == F.col("of")) & (F.col("salt") == F.col("at"))
    members = emitted.withColumn("salt", _salt("h1")).join(shared_variants, at_salt, "left_semi")
    places = lines.select(F.col("h1").alias("p1"), "h2", "place")
    members = staged(members.join(places, F.col("h1") == F.col("p1")).drop("p1"), "members")
    met = _shared_keys(members, "key", [F.min(F.struct("place", "h1", "h2")).alias("earliest")])
    pairs = (
        members.join(met, at_salt)
        .where(F.col("earliest.place") < F.col("place"))
        .groupBy("h1", "h2", F.col("earliest.h1").alias("e1"), F.col("earliest.h2").alias("e2"))
        .agg(F.min("gap").alias("gap"))  # lines of repeated words meet at many gaps; any one tells the edit
    )
    ours = lines.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("words").alias("a"))
    theirs = lines.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("words").alias("b"))
    return (
        pairs.join(ours, (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2")))
        .join(theirs, (F.col("e1") == F.col("b1")) & (F.col("e2") == F.col("b2")))
        .where(_one_edit(F.col("a"), F.col("b"), F.col("gap")))
        .select("h1", "h2")
        .distinct()
    )


def dropped_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, print, numbers): the lines of each document that repeat an earlier one, exactly or within one edit."""
    rows = staged(_occurrences(docs, key, text), "occurrences")
    firsts = staged(
        rows.groupBy("h1", "h2").agg(
            F.min("place").alias("place"), F.count(F.lit(1)).alias("rows"), F.first("halves").alias("halves")
        ),
        "firsts",
    )
    near = _near_earlier(docs, firsts, key, text).withColumn("near", F.lit(True))
    near = near.withColumnsRenamed({"h1": "n1", "h2": "n2"})
    known = (
        firsts.join(near, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")), "left")
        .where("near or rows > 1")
        .select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("place").alias("first"), "near")
    )
    known = staged(known, "known")
    return (
        rows.select("place", "h1", "h2")
        .join(known, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
        .where(F.col("near") | (F.col("place") > F.col("first")))
        .groupBy(F.col("place.key").alias("in"), F.col("place.print").alias("of"))
        .agg(F.collect_set("place.nr").alias("numbers"))
    )


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with every line left out that repeats an earlier one, exactly or within one edit of its words.

    Earlier is by key, hash of the text and number of the line; a NULL key is last. Lines end with a line feed and are compared by their
    words as written. A line is left out if any earlier line of at least `LEAST_WORDS` words is one word put in, left
    out or replaced away from it, or any earlier line has the same words. Lines without words stay, and so do all rows:
    a text may end up empty, a NULL text stays NULL. Rows are told apart by key
    and text: different texts of one key, or of none, are documents of their own; rows that repeat both count as one
    document and keep the same lines. An empty table gives an empty result.
    """
    gone = staged(dropped_lines(docs, key, text), "gone")
    key_of, print_of, numbers = (free_name(name, docs) for name in ("_in", "_of", "_numbers"))
    gone = gone.withColumnsRenamed({"in": key_of, "of": print_of, "numbers": numbers})

    def kept(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(numbers))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    cut = let(lines_of(F.col(text).cast("string")), kept)
    # What is known per document grows with the documents, so it is never sent to every executor.
    same = F.col(key).cast("long").eqNullSafe(F.col(key_of)) & (_print(F.col(text).cast("string")) == F.col(print_of))
    joined = docs.join(gone.hint("merge"), same, "left")
    return joined.withColumn(
        text, F.when(F.col(numbers).isNull() | F.col(text).isNull(), F.col(text)).otherwise(cut)
    ).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", F.length("text").cast("long").alias("chars_kept"), F.md5("text").alias("text_md5"))


# Candidates share the first or the last half of the shorter line; the common start and end of both tell the edits.
OP2_SQL = r"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS nr, unnest(parts) AS line FROM parts),
worded AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM lines),
kinds AS (SELECT w, min((doc_id, nr)) AS first FROM worded WHERE len(w) > 0 GROUP BY w),
long AS (SELECT w, first, CAST(len(w) AS BIGINT) AS n FROM kinds WHERE len(w) >= 5),
sizes AS (SELECT *, n AS m FROM long UNION ALL SELECT *, n - 1 FROM long),
halves AS (SELECT *, md5(array_to_string(w[1:m // 2], ' ')) AS half, 1 AS side FROM sizes
  UNION ALL SELECT *, md5(array_to_string(w[n - m // 2 + 1:n], ' ')), 2 FROM sizes),
pairs AS (SELECT DISTINCT a.w AS w, a.n AS n, b.w AS v, b.n AS k FROM halves a JOIN halves b
  ON a.half = b.half AND a.side = b.side AND a.m = b.m AND b.first < a.first AND (a.n = a.m OR b.n = b.m)),
ends AS (SELECT w, n, k,
  coalesce(list_position(list_transform(range(1, least(n, k) + 1), lambda i: w[i] <> v[i]), true) - 1, least(n, k)) AS start,
  coalesce(list_position(list_transform(range(0, least(n, k)), lambda i: w[n - i] <> v[k - i]), true) - 1, least(n, k)) AS tail
  FROM pairs),
near AS (SELECT DISTINCT w FROM ends WHERE start + tail >= greatest(n, k) - 1),
kept AS (SELECT l.doc_id, l.nr, l.line FROM worded l LEFT JOIN kinds k ON l.w = k.w LEFT JOIN near ON l.w = near.w
  WHERE len(l.w) = 0 OR (near.w IS NULL AND k.first = (l.doc_id, l.nr))),
texts AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY nr) AS text FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(t.text, '')) END AS BIGINT) AS chars_kept,
  CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(t.text, '')) END AS text_md5
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""
