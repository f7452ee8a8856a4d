"""Ranked lexical search by MaxScore with bounds of term pairs.

An index holds, for every document, the terms it is asked for with their impacts, and lists for terms and for pairs of
terms: how much a term can add to a score at most, and how much two terms add together at most in any one document. A
document good in both is rarer than one good in either, so pair maxima are lower than sums of term maxima. Per query,
terms are lined up by what they can add; those whose bound together stays below a known threshold can't bring a document
into the result alone, and only documents with another term are scored. What bounds leave is scored exactly, block by
block of documents: a task keeps the best of each item alone, so no pairs of items and documents are shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import staged

TOP = 20
# Terms in this share of the documents or more have pair lists. At most its inverse times the mean number of terms can.
FREQUENT = 1 / 64
# Documents looked at for a first threshold: those with the rarest terms, as many terms as hold so few documents together.
FIRST_LOOK = 2000
# Cells of rows by frequent terms a task lays out at once.
CELLS = 1 << 21
# Terms of items, about, that are laid against all documents in one pass; more items take more passes.
AT_ONCE = 500_000
# Characters of terms, and of letters that are made lower case.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(UPPER, LOWER)


def terms(text: str | None) -> Counter:
    return Counter(TERM.findall((text or "").translate(_LOWERED)))


def term_rows(table: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, size, term, n) per term of a text; a term '' stands for the text itself. `row` tells repeated keys apart."""

    def run(batches):
        for batch in batches:
            found = [terms(x.as_py()) for x in batch.column(1)]
            sizes = pa.array([sum(c.values()) for c in found], pa.int64())
            words = pa.array([t for c in found for t in ("", *c)], pa.string())
            counts = pa.array([n for c in found for n in (1, *c.values())], pa.int64())
            starts = pa.array(np.cumsum([0, *(len(c) + 1 for c in found)]), pa.int32())
            lists = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays([words, counts], ["term", "n"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, lists], names=["key", "size", "terms"])

    rows = table.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(run, "key long, size long, terms array<struct<term: string, n: long>>")
    return rows.withColumn("row", F.monotonically_increasing_id()).select("key", "row", "size", F.inline("terms"))


def _entries(ids: pa.Array, adds: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the block, place in `known`, adds) of the entries whose id is in the sorted `known`."""
    row = np.repeat(np.arange(len(ids)), np.diff(ids.offsets.to_numpy()))
    ids, adds = ids.flatten().to_numpy(), adds.flatten().to_numpy()
    at = np.minimum(np.searchsorted(known, ids), max(len(known) - 1, 0))
    some = known[at] == ids if len(known) else np.zeros(len(ids), bool)
    return row[some], at[some], adds[some]


def weight(n_docs: int, df: Column) -> Column:
    return F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * df + 1))).cast("long")


class Index:
    """Tables of an index, each written once: `rows` (row, key, ids, adds), a row per document, and `terms` (term, id, df, most, is_frequent)."""

    def __init__(self, docs: DataFrame, wanted: DataFrame, key: str, text: str):
        """Index every row of `docs` for the terms `wanted` (term)."""
        every = wanted.select("term").union(wanted.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
        found = staged(term_rows(docs, key, text).join(every, "term"), "found")
        n_docs, total = found.where("term = '' AND size > 0").agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        found = found.where("term <> ''")
        # Written with their numbers, so that these stay as they are.
        df = staged(found.groupBy("term").agg(F.count("*").alias("df")).withColumn("id", F.monotonically_increasing_id()), "df")
        m = F.expr(f"75 + (25 * size * {n_docs}L) div {max(total, 1)}L")
        adds = F.col("w") * F.expr("(1000000000L * n) div (1000 * n + 12 * m)")
        weights = df.select("term", "id", weight(n_docs, F.col("df")).alias("w"))
        entry = F.struct("id", adds.alias("adds"))
        # A document's terms are at most those wanted, however long its text.
        rows = found.withColumn("m", m).join(weights, "term").groupBy("row", "key").agg(F.collect_list(entry).alias("entries"))
        self.rows = staged(rows.select("row", "key", F.col("entries.id").alias("ids"), F.col("entries.adds").alias("adds")), "rows")
        each = self.rows.select(F.inline(F.arrays_zip("ids", "adds"))).toDF("id", "adds")
        most = each.groupBy("id").agg(F.max("adds").alias("most"))
        self.terms = staged(most.join(df, "id").select("term", "id", "df", "most", (F.col("df") >= FREQUENT * n_docs).alias("is_frequent")), "terms")

    def pair_lists(self, pairs: DataFrame) -> DataFrame:
        """(a, b, both, joint) of pairs (a, b), a < b: documents with both terms, and the most the two add in any one of them.

        Only for frequent terms, whose number has a bound; so a row's terms that take part are few, however long its text.
        """
        frequent = self.terms.where("is_frequent")
        size = frequent.count()
        frequent = frequent.select("term", "id", (F.row_number().over(Window.orderBy("id")) - 1).alias("nr"))
        for side in ("a", "b"):
            pairs = pairs.join(frequent.select(F.col("nr").alias(f"nr_{side}"), F.col("term").alias(side)), side)
        # At most half the square of the number of frequent terms.
        wanted = pairs.select("nr_a", "nr_b").distinct().groupBy("nr_a").agg(F.collect_list("nr_b").alias("nr_b"))
        partners = {r.nr_a: np.array(sorted(r.nr_b)) for r in wanted.collect()}
        ids = np.array(sorted(r.id for r in frequent.select("id").collect()), np.int64)

        def joint(batches):
            for batch in batches:
                at_once = max(1, CELLS // max(size, 1))
                for start in range(0, batch.num_rows, at_once):
                    part = batch.slice(start, at_once)
                    row, at, adds = _entries(part.column(0), part.column(1), ids)
                    table = np.zeros((part.num_rows, size), np.int64)
                    present = np.zeros((part.num_rows, size), bool)
                    table[row, at] = adds
                    present[row, at] = True
                    for a in np.unique(at):
                        if a not in partners:
                            continue
                        some, others = np.flatnonzero(present[:, a]), partners[a]
                        with_b = present[np.ix_(some, others)]
                        sums = np.where(with_b, table[np.ix_(some, others)] + table[some, a][:, None], 0)
                        both = with_b.sum(axis=0)
                        found = np.flatnonzero(both)
                        columns = [np.full(len(found), a), others[found], both[found], sums.max(axis=0)[found]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["nr_a", "nr_b", "both", "joint"])

        if not partners:
            return pairs.select("a", "b", F.lit(0).cast("long").alias("both"), F.lit(0).cast("long").alias("joint"))
        lists = self.rows.select("ids", "adds").mapInArrow(joint, "nr_a long, nr_b long, both long, joint long")
        lists = lists.groupBy("nr_a", "nr_b").agg(F.sum("both").alias("both"), F.max("joint").alias("joint"))
        for side in ("a", "b"):
            lists = lists.join(frequent.select(F.col("nr").alias(f"nr_{side}"), F.col("term").alias(side)), f"nr_{side}")
        return lists.select("a", "b", "both", "joint")


def _ranked(scores: DataFrame) -> DataFrame:
    """The TOP highest scores of every item, by tasks first: a window over few rows of each."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("key"), F.asc("row"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def _candidates(lists, size: int, line, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the rows of a block that have a term marked as used and reach `least`.

    The other terms are looked up from the one with the highest bound down, and before each the rows that can't reach
    `least` with all that is left go.
    """
    at, times, bound, used = line
    part = np.zeros(size, np.int64)
    for k in np.flatnonzero(used):
        rows, adds = lists(at[k])
        part[rows] += times[k] * adds
    some = np.flatnonzero(part)
    for k in np.flatnonzero(~used)[::-1]:
        some = some[part[some] + bound[k] >= least]
        if not len(some):
            break
        rows, adds = lists(at[k])
        if 8 * len(some) < len(rows):
            place = np.minimum(np.searchsorted(rows, some), len(rows) - 1)
            hit = rows[place] == some
            part[some[hit]] += times[k] * adds[place[hit]]
        else:  # what rows that are out gain is never read
            part[rows] += times[k] * adds
    some = some[part[some] >= least]
    return some, part[some]


def _scorer(chosen, look_first: bool):
    """A function over blocks of an index's rows: the TOP rows of each of the items `chosen` in the task, scored exactly."""
    known = np.unique(np.array([t.id for c in chosen for t in c.line], np.int64))
    lines = [
        (
            np.searchsorted(known, [t.id for t in c.line]),
            np.array([t.times for t in c.line], np.int64),
            np.array([t.bound for t in c.line], np.int64),
            np.array([t.is_first for t in c.line], bool),
        )
        for c in chosen
    ]

    def run(batches):
        least = [max(c.least, 1) for c in chosen]
        best = [np.zeros((4, 0), np.int64) for _ in chosen]
        for batch in batches:
            row, at, adds = _entries(batch.column(2), batch.column(3), known)
            order = np.argsort(at, kind="stable")
            row, adds = row[order], adds[order]
            starts = np.searchsorted(at[order], np.arange(len(known) + 1))
            lists = lambda k: (row[starts[k] : starts[k + 1]], adds[starts[k] : starts[k + 1]])  # noqa: B023, E731
            has_key = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            keys, rows = batch.column(1).fill_null(0).to_numpy(), batch.column(0).to_numpy()
            for i, (places, times, bound, is_first) in enumerate(lines):
                used = is_first
                if not look_first:
                    # Terms up to the last one whose bound is below the threshold bring no row into the result alone.
                    low = np.flatnonzero(bound < least[i])
                    used = np.arange(len(bound)) > (low[-1] if len(low) else -1)
                some, scores = _candidates(lists, batch.num_rows, (places, times, bound, used), least[i])
                if not len(some):
                    continue
                found = np.hstack([best[i], [scores, has_key[some].astype(np.int64), keys[some], rows[some]]])
                best[i] = found[:, np.lexsort((found[3], found[2], found[1], -found[0]))[:TOP]]
                if best[i].shape[1] == TOP:
                    least[i] = max(least[i], int(best[i][0, -1]))
        item = np.repeat(np.array([c.item for c in chosen], np.int64), [b.shape[1] for b in best])
        score, has_key, keys, rows = np.hstack(best) if best else np.zeros((4, 0), np.int64)
        columns = [pa.array(item), pa.array(rows), pa.array(keys, mask=has_key == 0), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "row", "key", "score"])

    return run


def _best(rows: DataFrame, lined: DataFrame, look_first: bool) -> DataFrame:
    """(item, rank, row, key, score) of the TOP rows of every item of `lined` (item, id, times, nr, bound, is_first, least).

    Items are dealt by a hash into parts of about AT_ONCE terms, each laid against all rows in a pass of its own. With
    `look_first`, only rows that have a term marked `is_first` are scored.
    """
    parts = max(1, -(-lined.count() // AT_ONCE))
    entry = F.struct("nr", "id", "times", "bound", "is_first")
    by_item = lined.groupBy("item").agg(F.sort_array(F.collect_list(entry)).alias("line"), F.max("least").alias("least"))
    schema = "item long, row long, key long, score long"
    found = []
    for k in range(parts):
        chosen = by_item.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == k).collect()
        found.append(rows.select("row", "key", "ids", "adds").mapInArrow(_scorer(chosen, look_first), schema))
    return _ranked(reduce(DataFrame.union, found))


def bounds(asked: DataFrame, index: Index) -> DataFrame:
    """(item, term, id, times, df, nr, bound): terms from the one that can add least, and what all up to `nr` add at most together.

    The sum of the terms' own maxima is a bound. Over all pairs of k terms, every term is counted k - 1 times; so what
    the joint maxima of pairs are lower than sums of two, added up and divided by k - 1, comes off. Where fewer terms have
    a better bound, the maxima of the others are added to that. Terms that an item repeats count as often: a pair has its
    joint maximum for the times both are there. Frequent terms that no document holds together have the larger maximum
    as the joint one; pairs with a term that isn't frequent take nothing off.
    """
    line = Window.partitionBy("item").orderBy(F.col("times") * F.col("most"), "term")
    lined = asked.join(index.terms, "term").withColumn("nr", F.row_number().over(line).cast("long"))
    lined = staged(lined, "lined")
    frequent = lined.where("is_frequent")
    one, two = (frequent.select("item", *[F.col(c).alias(f"{c}_{k}") for c in ("term", "times", "most", "nr")]) for k in (1, 2))
    couples = one.join(two, "item").where("nr_1 < nr_2")
    couples = couples.withColumn("a", F.least("term_1", "term_2")).withColumn("b", F.greatest("term_1", "term_2"))
    couples = staged(couples, "couples")
    lists = index.pair_lists(couples.select("a", "b").distinct())
    joint = F.greatest("most_1", "most_2", F.coalesce("joint", F.lit(0)))
    off = F.least("times_1", "times_2") * (F.col("most_1") + F.col("most_2") - joint)
    offs = couples.join(lists, ["a", "b"], "left").groupBy("item", F.col("nr_2").alias("nr")).agg(F.sum(off).alias("off"))
    upto = Window.partitionBy("item").orderBy("nr").rowsBetween(Window.unboundedPreceding, 0)
    summed = lined.join(offs, ["item", "nr"], "left").select(
        "item",
        "term",
        "id",
        "times",
        "df",
        "nr",
        F.sum(F.col("times") * F.col("most")).over(upto).alias("alone"),
        F.sum(F.coalesce("off", F.lit(0))).over(upto).alias("off"),
    )
    return summed.withColumn("bound", F.col("alone") - F.max(F.expr("off div greatest(nr - 1, 1)")).over(upto)).drop("alone", "off")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """The TOP documents (item, rank, key, score) of every item, highest scores first and equal ones by key.

    A NULL or empty text has no terms, counts nowhere and is never found; an item without terms, or whose terms no
    document holds, has no rows, and neither has one without a number. Rows that repeat a key are documents of their own,
    and a NULL key comes before others; rows that repeat an item are one item with the terms of all. Very long texts are
    counted in tasks, and the terms that items ask for go on. Other columns are ignored, and an empty table gives an empty result.
    """
    asked = term_rows(items.where(F.col(item).isNotNull()), item, "text").where("term <> ''")
    asked = staged(asked.groupBy(F.col("key").alias("item"), "term").agg(F.sum("n").alias("times")), "asked")
    index = Index(docs, asked, key, text)
    lined = staged(bounds(asked, index), "bounds")

    # A first threshold: exact scores of documents with an item's rarest terms, enough of them to fill its result.
    rarest = Window.partitionBy("item").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, 0)
    look = lined.withColumn("upto", F.sum("df").over(rarest)).withColumn("is_first", F.expr(f"upto - df < {TOP} OR upto <= {FIRST_LOOK}"))
    look = staged(look.withColumn("least", F.lit(1).cast("long")), "look")
    first = _best(index.rows, look, True)
    least = first.where(F.col("rank") == TOP).select("item", F.col("score").alias("least"))
    lined = staged(look.drop("least").join(least, "item", "left").withColumn("least", F.coalesce("least", F.lit(1))), "thresholds")
    best = _best(index.rows, lined, False)
    return best.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = rf"regexp_extract_all(translate({{}}, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS.format("coalesce(text, '')")} AS ts FROM documents),
s AS (SELECT count(*) AS n, CAST(coalesce(sum(len(ts)), 0) AS BIGINT) AS l FROM d WHERE len(ts) > 0),
p AS (SELECT row, doc_id, size, term, count(*) AS tf FROM (SELECT row, doc_id, len(ts) AS size, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, s.n),
q AS (SELECT item_id, term, count(*) AS times FROM
  (SELECT item_id, unnest({_TERMS.format("coalesce(text, '')")}) AS term FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL),
r AS (SELECT q.item_id, p.row, p.doc_id,
    CAST(sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.size * s.n) // s.l)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, row) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {TOP}
"""
