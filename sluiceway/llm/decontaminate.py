"""Benchmark decontamination by spaced-seed hashing.

A mask looks at some words of a stretch and ignores those between. Hashes of all places of the test texts are joined
with those of the training texts; around each hit, both texts are laid side by side and words compared. A stretch of
`WINDOW` words with at most `ERRORS` replaced ones is an overlap. The masks are chosen so that some place of at least one
of them avoids any `ERRORS` replaced words of a window: no overlap is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.shared import BLANKS, let, staged

WINDOW, ERRORS = 13, 2
# Places of the words a mask looks at.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
# Test texts of fewer words than this are no evidence.
LEAST_WORDS = 5
# Seeds of test texts up to which they are sent to every executor (16 MB of hashes); beyond, both sides are shuffled.
BROADCAST_SEEDS = 500_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, letters in lower case."""
    plain = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    words = F.filter(F.split(plain, f"[{BLANKS}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(hashes: Column, at: Column, masks: tuple[tuple[int, ...], ...]) -> Column:
    """Hash of the words every mask looks at when it stands at word `at`; NULL where a mask reaches beyond the text."""

    def of(nr: int, mask: tuple[int, ...]) -> Column:
        return F.when(at + mask[-1] < F.size(hashes), F.xxhash64(F.lit(nr), *[F.get(hashes, at + x) for x in mask]))

    return F.array(*[of(nr, mask) for nr, mask in enumerate(masks)])


def _places(texts: DataFrame, hashes: str, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Every place of every mask: the columns of `texts` but for `hashes`, and (at, seed).

    Words become rows before they are hashed together: that stays in generated code, where a lambda over the words
    would be interpreted. The generators are outer ones, since for others Spark asks for the array's size first and
    computes it twice for that.
    """
    rest = [c for c in texts.columns if c != hashes]
    placed = texts.select(*rest, hashes, F.posexplode_outer(hashes).alias("at", "_word"))
    found = placed.select(*rest, "at", F.explode_outer(_seeds(F.col(hashes), F.col("at"), masks)).alias("seed"))
    return found.where("seed is not null")


def _compared(words: Column, test: Column, shift: Column, window: int, errors: int) -> Column:
    """Where words of a training text overlap a test text laid at `shift`: start and end in its words, and equal words."""
    least = F.least(F.size(test), F.lit(window))
    allowed = F.when(F.size(test) >= window, errors).otherwise(0)
    laid = F.transform(test, lambda t, q: F.coalesce((F.get(words, shift + q) == t) & (shift + q >= 0), F.lit(False)))
    starts = F.sequence(F.lit(0), F.size(test) - least)
    inside = lambda a: (shift + a >= 0) & (shift + a + least <= F.size(words))
    wrong = lambda equal, a: F.size(F.filter(F.slice(equal, a + 1, least), lambda e: ~e))

    def overlap(equal: Column) -> Column:
        good = F.filter(starts, lambda a: inside(a) & (wrong(equal, a) <= allowed))
        found = lambda g: F.struct(
            (shift + F.array_min(g)).alias("start"),
            (shift + F.array_max(g) + least).alias("end"),
            F.size(F.filter(equal, lambda e: e)).alias("equal"),
        )
        return let(good, lambda g: F.when(F.size(g) > 0, found(g)))

    return let(laid, overlap)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    errors: int = ERRORS,
    masks: tuple[tuple[int, ...], ...] = MASKS,
) -> DataFrame:
    """`docs` with a column `overlaps`: structs of item, start, end (words, exclusive) and equal words; empty if clean.

    A document overlaps an item where `window` words in a row agree but for at most `errors` replaced ones. An item of
    fewer words, of at least `LEAST_WORDS`, must stand in the document whole and unchanged; shorter ones, and NULL or
    empty texts on either side, overlap nothing. Words are cut at blanks and compared without case. Repeated rows get
    equal results, items with equal texts are each reported. A clashing column `overlaps` is replaced. Empty tables on
    either side are allowed.
    """
    tests = staged(
        benchmark.select(F.col(item).alias("item"), word_hashes(F.col(item_text)).alias("test"))
        .where(F.size("test") >= LEAST_WORDS)
        .distinct(),
        "tests",
    )
    # A whole short item is a mask of its own; there is one for each length below the window, at most.
    lengths = [r.n for r in tests.where(F.size("test") < window).select(F.size("test").alias("n")).distinct().collect()]
    masks = (*masks, *(tuple(range(n)) for n in sorted(lengths)))
    seeds = tests.select("item", F.col("test").alias("hashes"))
    seeds = _places(seeds, "hashes", masks).withColumnsRenamed({"at": "item_at", "seed": "item_seed"})
    seeds = staged(seeds.select("item", "item_at", "item_seed"), "seeds")
    slim = seeds.select("item_seed", "item", "item_at")
    if slim.count() <= BROADCAST_SEEDS:
        slim = F.broadcast(slim)
    body = F.col(text).cast("string")
    words = docs.select(
        F.col(key).cast("long").alias("key"), F.xxhash64(body).alias("print"), word_hashes(body).alias("hashes")
    )
    hits = (
        _places(words, "hashes", masks)
        .join(slim, F.col("seed") == F.col("item_seed"))
        .select("key", "print", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    hits = staged(hits, "hits").join(tests.withColumnRenamed("item", "of"), F.col("item").eqNullSafe(F.col("of")))
    per_doc = hits.groupBy(F.col("key").alias("_key"), F.col("print").alias("_print")).agg(
        F.collect_list(F.struct("item", "test", "shift")).alias("_hits")
    )
    rows = docs.drop("overlaps").join(
        per_doc, F.col(key).cast("long").eqNullSafe(F.col("_key")) & (F.xxhash64(body) == F.col("_print")), "left"
    )

    def laid(words: Column) -> Column:
        return F.transform(
            "_hits",
            lambda h: F.struct(h["item"].alias("item"), _compared(words, h["test"], h["shift"], window, errors).alias("o")),
        )

    found = F.when(F.col("_hits").isNotNull(), let(word_hashes(body), laid))
    kept = F.transform(
        F.filter(found, lambda f: f["o"].isNotNull()),
        lambda f: F.struct(f["item"].alias("item"), *[f["o"][c].alias(c) for c in ("start", "end", "equal")]),
    )
    empty = F.filter(F.array(F.struct(F.lit(None).cast(benchmark.schema[item].dataType).alias("item"), *[F.lit(0).alias(c) for c in ("start", "end", "equal")])), lambda x: F.lit(False))
    return rows.withColumn("overlaps", F.coalesce(F.array_sort(kept), empty)).drop("_key", "_print", "_hits")


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that overlap no item of the benchmark, with their columns."""
    return overlaps(docs, benchmark, key, text).where(F.size("overlaps") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = overlaps(docs.select("doc_id", "text"), benchmark)
    items = F.array_sort(F.array_distinct(F.transform("overlaps", lambda o: o["item"])))
    return found.select(
        "doc_id",
        (F.size("overlaps") > 0).alias("contaminated"),
        F.size("overlaps").cast("long").alias("n_overlaps"),
        F.array_join(F.transform(items, lambda i: i.cast("string")), ",").alias("items"),
        F.coalesce(F.array_max(F.transform("overlaps", lambda o: o["equal"])), F.lit(0)).cast("long").alias("most_equal"),
    )


# Items are laid over documents wherever a window has four words in a row in common: two replaced ones leave that much.
OP8_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
items AS (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS t FROM benchmark),
long AS (SELECT * FROM items WHERE len(t) >= 5),
item_grams AS (SELECT item_id, unnest(range(len(t) - 3)) AS q, unnest(list_transform(range(1, len(t) - 2), lambda i: array_to_string(t[i:i + 3], ' '))) AS g FROM long),
doc_grams AS (SELECT doc_id, unnest(range(len(w) - 3)) AS p, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) AS g FROM docs WHERE len(w) >= 4),
laid AS (SELECT DISTINCT doc_id, item_id, p - q AS shift FROM doc_grams JOIN item_grams USING (g)),
beside AS (SELECT doc_id, item_id, shift, len(w) AS n, len(t) AS k, least(len(t), 13) AS size,
  list_transform(range(0, len(t)), lambda q: CASE WHEN shift + q >= 0 AND shift + q < len(w) AND w[shift + q + 1] = t[q + 1] THEN 1 ELSE 0 END) AS same
  FROM laid JOIN docs USING (doc_id) JOIN long USING (item_id)),
found AS (SELECT doc_id, item_id, list_sum(same) AS equal FROM beside
  WHERE len(list_filter(range(0, k - size + 1), lambda a: shift + a >= 0 AND shift + a + size <= n
    AND list_sum(same[a + 1:a + size]) >= CASE WHEN k >= 13 THEN 11 ELSE size END)) > 0),
per_doc AS (SELECT doc_id, count(*) AS n, max(equal) AS most,
  array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) > 0 AS contaminated, CAST(coalesce(n, 0) AS BIGINT) AS n_overlaps,
  coalesce(items, '') AS items, CAST(coalesce(most, 0) AS BIGINT) AS most_equal
FROM documents d LEFT JOIN per_doc f ON d.doc_id = f.doc_id
"""
