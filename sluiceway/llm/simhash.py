"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits. For a radius r, every bit position gets a
non-zero vector of r + 1 bits, and every non-zero vector v of r + 1 bits gives
a mask that keeps the positions whose vectors have an odd product with v. Two
fingerprints that differ in at most r positions give at most r equations for
v, so some mask drops all of these positions: the pair shares that mask's key
for certain. 2^(r+1) - 1 keys per fingerprint find all pairs within the radius.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.shared import components, staged
from sluiceway.llm.words import word_lists

BITS = 64
# Fingerprints of one key that are compared inside one task; keys with more are dealt out by blocks of about this size.
BLOCK = 1024
SEED = 42


def fingerprint(text: bytes | None, width: int) -> int:
    """Signed 64-bit fingerprint over shingles of `width` words; 0 for a text without words."""
    import xxhash

    hashed, ones, total, few = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), 0, []
    for words in word_lists((text or b"").lower(), width):
        few = words
        rows = [hashed(b" ".join(x), SEED) for x in zip(*(words[k:] for k in range(width)))]
        for at in range(0, len(rows), 1 << 16):
            part = np.array(rows[at : at + (1 << 16)], dtype=">u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(part)
    if not total:
        if not few:
            return 0
        only = np.array([hashed(b" ".join(few), SEED)], dtype=">u8")
        ones, total = np.unpackbits(only.view(np.uint8)).astype(np.int64), 1
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(key, fp) for every row."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = pa.array([fingerprint(x.as_py(), width) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The masks of the lowest `bits` positions as signed longs, one for every non-zero vector of radius + 1 bits."""
    size = 1 << (radius + 1)
    vectors = [1 + (position * 7 + position // (size - 1)) % (size - 1) for position in range(bits)]
    masks = []
    for v in range(1, size):
        mask = sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _forest(fps: np.ndarray, radius: int, other: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join all fingerprints which pairs within the radius join; no more than needed."""
    rows = fps.view(np.uint64)
    near = np.bitwise_count(rows[:, None] ^ (rows if other is None else other.view(np.uint64))[None, :]) <= radius
    if other is None:
        near = np.triu(near, 1)
    found = np.argwhere(near)
    shift = 0 if other is None else len(fps)
    parent = list(range(len(fps) + (0 if other is None else len(other))))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i, j in found.tolist():
        a, b = top(i), top(j + shift)
        if a != b:
            parent[max(a, b)] = min(a, b)
            links.append((int(fps[i]), int((fps if other is None else other)[j])))
    return links


def _links_of_sorted(radius: int, block: int):
    """Over rows (bucket, fp) sorted by bucket: links (a, b, false), and (bucket, fp, true) for rows of larger buckets."""

    def out(links: list[tuple[int, int]], hot: list[np.ndarray], hot_buckets: list[int]) -> pa.RecordBatch:
        a = [np.array([x[0] for x in links], np.int64)] + [np.full(len(h), k, np.int64) for h, k in zip(hot, hot_buckets)]
        b = [np.array([x[1] for x in links], np.int64)] + hot
        is_hot = np.concatenate([np.zeros(len(links), bool), np.ones(sum(map(len, hot)), bool)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), pa.array(is_hot)], names=["a", "b", "hot"]
        )

    def run(batches):
        bucket, held, flooded = None, np.empty(0, np.int64), False
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            links, hot, hot_buckets = [], [], []
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[starts[1:], len(keys)]
            # Runs of one row that neither continue the bucket before nor may go on after are of no use.
            useful = np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(keys)))
            for s, e in zip(starts[useful].tolist(), ends[useful].tolist()):
                key = int(keys[s])
                if key != bucket:
                    if not flooded and len(held) > 1:
                        links += _forest(held, radius)
                    bucket, held, flooded = key, np.empty(0, np.int64), False
                held = np.concatenate([held, fps[s:e]])
                if flooded or len(held) > block:
                    hot.append(held)
                    hot_buckets.append(key)
                    held, flooded = np.empty(0, np.int64), True
            if links or hot:
                yield out(links, hot, hot_buckets)
        if not flooded and len(held) > 1 and (links := _forest(held, radius)):
            yield out(links, [], [])

    return run


def _block_links(radius: int):
    def run(pdf):
        import pandas as pd

        lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        fps, place = pdf["fp"].to_numpy(np.int64), pdf["place"].to_numpy()
        links = _forest(fps, radius) if lo == hi else _forest(fps[place == lo], radius, fps[place == hi])
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def near_links(spark: SparkSession, distinct: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join all fingerprints joined by pairs of at most `radius` differing bits.

    Rows of a bucket meet sorted; a bucket of up to `block` fingerprints is compared at once. A larger one is cut into
    blocks by hash, and every pair of blocks is a group of its own, so no task holds a whole bucket and no pair is
    left out. Only links of a spanning forest come out, never all pairs.
    """
    masks = F.array(*[F.lit(x) for x in covering_masks(radius)])
    buckets = distinct.select("fp", F.posexplode(masks).alias("nr", "mask")).select(
        F.xxhash64("nr", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"), "fp"
    )
    dealt = buckets.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    found = staged(dealt.mapInArrow(_links_of_sorted(radius, block), "a long, b long, hot boolean"), "near")
    links = found.where("not hot").select("a", "b")
    hot = found.where("hot").select(F.col("a").alias("bucket"), F.col("b").alias("fp"))
    if hot.isEmpty():
        return links
    blocks = hot.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    placed = hot.join(blocks, "bucket").withColumn("place", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    pairs = placed.select(
        "bucket", "fp", "place", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("bucket", "fp", "place", F.least("place", "other").alias("lo"), F.greatest("place", "other").alias("hi"))
    # Without this, groups would stay where the join left them: all of a bucket in one task.
    pairs = pairs.repartition("bucket", "lo", "hi")
    return links.union(pairs.groupBy("bucket", "lo", "hi").applyInPandas(_block_links(radius), "a long, b long"))


def simhash_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4, block: int = BLOCK
) -> DataFrame:
    """One row (key, fp, component_id) per row of `docs`, with component_id the smallest key reachable by links.

    NULL and empty texts, and texts of blanks only, have fingerprint 0, which links like any other. A text of fewer
    than `width` words is one shingle. Repeated rows and equal texts share a fingerprint and so a component. A NULL
    key stays NULL in its row and counts for no component; a component without any key has a NULL id. An empty table
    gives an empty result; other columns are ignored.
    """
    prints = staged(fingerprints(docs, key, text, width), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = components(near_links(docs.sparkSession, distinct.select("fp"), radius, block))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    groups = staged(named, "named")
    least = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = staged(groups.join(least, "root").select("fp", "component_id"), "groups")
    return prints.join(by_print, "fp").select(F.col("key").alias(key), "fp", "component_id")


def one_of_each(docs: DataFrame, groups: DataFrame, key: str, text: str) -> DataFrame:
    """One document of every component of `groups`, the one with the smallest key, with all columns of `docs`.

    Rows that share a key are one document: it goes only when all of them lie in components with a smaller key, and
    rows of it that repeat the same text stay once. Documents without a key stay.
    """
    per_key = staged(
        groups.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max("component_id").alias("_last"), F.count(F.lit(1)).alias("_rows")),
        "keys",
    )
    on = F.col(key) == F.col("_key")
    kept = docs.join(per_key.where("_last < _key"), on, "left_anti")
    again = per_key.where("_last = _key and _rows > 1")
    if again.isEmpty():
        return kept
    return kept.join(again, on, "left_anti").union(kept.join(again, on, "left_semi").dropDuplicates([key, text]))


def simhash_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, radius: int = 4) -> DataFrame:
    """One document of every component of fingerprints within the radius; see `one_of_each`."""
    return one_of_each(docs, simhash_groups(docs, key, text, width, radius), key, text)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
