import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import mixing

SF = "/root/testdata/sf0.001"


def brute_targets(sizes):
    """{source: target} by giving what lies above again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(sizes, 0.0), mixing.SHARE * sum(sizes.values()), set(sizes)
    while left > 1e-9 and open_:
        unit = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += unit * weight[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def check(rows, docs):
    sizes, taken = defaultdict(int), Counter()
    for r in rows:
        words = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in docs[r.key] or "").split(" ")
        assert r.size == sum(1 for w in words if w)
        assert r.taken in (0, r.size, 2 * r.size) and len(r.shards) * r.size == r.taken
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    target = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
    for s in sizes:
        largest = max(r.size for r in rows if r.source == s)
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], largest / 2)


def test_words_and_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix_plan(docs).collect()
    assert len(rows) == 200
    check(rows, {d.doc_id: d.text for d in docs.collect()})
    again = {r.key: (r.taken, r.shards) for r in mixing.mix_plan(docs.repartition(7)).collect()}
    assert again == {r.key: (r.taken, r.shards) for r in rows}


def test_quotas_are_split_exactly_and_fairly(spark):
    quotas = [0.0, 1.0, 37.0, 250.0, 900.0]
    root = spark.createDataFrame([(quotas,)], "quotas array<double>")
    rows = mixing.split_quotas(root, 11).collect()
    assert sorted(r.shard for r in rows) == list(range(11))
    assert [sum(r.quotas[i] for r in rows) for i in range(5)] == quotas
    assert all(q >= 0 and q == int(q) for r in rows for q in r.quotas)
    assert max(sum(r.quotas) for r in rows) - min(sum(r.quotas) for r in rows) <= 4


def test_draws_follow_the_distribution(spark):
    from math import comb

    units = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    drawn = units.select(mixing._hypergeometric(*[F.lit(float(x)) for x in (30, 12, 9)], F.col("u")).alias("x"))
    counts = {r.x: r["count"] for r in drawn.groupBy("x").count().collect()}
    for x in range(10):
        assert abs(counts.get(x, 0) - 4000 * comb(12, x) * comb(18, 9 - x) / comb(30, 9)) <= 1.5


def test_edges(spark):
    rows = [(1, None, "a", 1), (2, "", None, 1), (3, "x y", None, 1), (3, "x y", None, 1), (None, "p q r", "b", 1), (6, "w " * 50000, "b", 1), (7, "z", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int")
    got = mixing.mix_plan(docs).collect()
    assert len(got) == len(rows)
    assert {r.key: r.taken for r in got if not r.size} == {1: 0, 2: 0}
    assert len({(r.taken, tuple(r.shards)) for r in got if r.key == 3}) == 1
    mixed = mixing.mix(docs, shards=4)
    assert sorted(mixed.columns) == ["copy", "doc_id", "shard", "source", "text"]
    assert mixed.count() == sum(len(r.shards) for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix_plan(docs.limit(0)).count() == 0


def test_columns_named_like_the_operators_own(spark):
    rows = [(k, "x " * (k % 7 + 1), "ab"[k % 2], k, k, k, k) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, of int, at int, shards int, name int")
    docs = docs.withColumn("in", docs["of"])
    mixed = mixing.mix(docs, shards=4)
    assert sorted(mixed.columns) == sorted([*docs.columns, "copy", "shard"])
    assert mixed.where("of <> doc_id OR at <> doc_id OR `in` <> doc_id OR shards <> doc_id").count() == 0 < mixed.count()
    assert mixing.mix_plan(docs).count() == 40
