import math
import random

from oracle import compare, database
from pyspark.sql import functions as F

from sluiceway.llm import search

SF = "/root/testdata/sf0.001"


def plain(docs, items):
    """Every document scored for every item."""
    counted = [(d, search.terms(t)) for d, t, *_ in docs]
    n_docs, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = {}
    for _, c in counted:
        for t in c:
            df[t] = df.get(t, 0) + 1
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = {}
    for i, t, *_ in items:
        if i is not None:
            asked[i] = asked.get(i, search.terms("")) + search.terms(t)
    out = []
    for i, q in asked.items():
        found = []
        for d, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // max(total, 1)
            score = sum(k * w[x] * (10**9 * c[x] // (1000 * c[x] + 12 * m)) for x, k in q.items() if x in c)
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        out += [(i, nr, d, -s) for nr, (s, _, _, d) in enumerate(sorted(found, key=lambda f: f[:3])[: search.TOP], 1)]
    return sorted(out, key=str)


def got(spark, docs, items):
    docs = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, term string")
    items = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, row int")
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(docs, items).collect()], key=str)


def test_query_gives_what_sql_gives(spark):
    assert compare(search.op12_search(spark, SF), database(SF), search.OP12_SQL) is None


def _some(rng, n):
    words = [f"w{i}" for i in range(60)]
    pick = lambda: rng.choices(words, [1 / (i + 1) for i in range(60)])[0]
    docs = [(d, " ".join(pick() for _ in range(rng.randrange(3, 40)))) for d in range(n)]
    return docs, [(i, " ".join(pick() for _ in range(12)) + " w0 w1 w1 W59, nowhere") for i in range(8)]


def test_small_tables_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(search, "FIRST_LOOK", 40)
    rng = random.Random(5)
    docs, items = _some(rng, 400)
    docs += [(d, t) for d, t in docs[:30]] + [(1000, None), (1001, ""), (1002, "!?"), (None, "w3 w59 w59"), (1003, "w7 " * 30000), (1004, "ÄÖ w5"), (1005, "äö w5")]
    items += [(50, None), (51, "..."), (None, "w1 w2"), (8, "w5 w6"), (8, "w6 ÄÖ"), (9, "w0"), (10, "nowhere at all")]
    assert got(spark, docs, items) == plain(docs, items)


def test_bounds_hold_and_pairs_tighten_them(spark):
    docs, items = _some(random.Random(6), 500)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    asked = search.term_rows(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").where("term <> ''")
    asked = asked.groupBy(F.col("key").alias("item"), "term").agg(F.sum("n").alias("times"))
    index = search.Index(table, asked, "doc_id", "text")
    most = {r.term: r.most for r in index.terms.collect()}
    adds = {}
    name = {r.id: r.term for r in index.terms.collect()}
    for r in index.rows.collect():
        adds[r.row] = {name[i]: a for i, a in zip(r.ids, r.adds)}
    lines = {}
    for r in search.bounds(asked, index).collect():
        lines.setdefault(r.item, []).append(r)
    tighter = 0
    for line in lines.values():
        line.sort(key=lambda r: r.nr)
        for k in range(1, len(line) + 1):
            seen = max(sum(r.times * a.get(r.term, 0) for r in line[:k]) for a in adds.values())
            alone = sum(r.times * most[r.term] for r in line[:k])
            assert seen <= line[k - 1].bound <= alone
            tighter += line[k - 1].bound < alone
    assert tighter > len(lines)


def test_items_in_several_passes_and_docs_in_several_blocks(spark, monkeypatch):
    docs, items = _some(random.Random(7), 600)
    docs += [(None, "w1 w2 w3 w4"), (None, "w1 w2 w3 w4"), (3, "w1 w2 w3 w4")]
    monkeypatch.setattr(search, "AT_ONCE", 20)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert got(spark, docs, items) == plain(docs, items)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_edges(spark):
    assert got(spark, [], []) == got(spark, [], [(1, "a b")]) == got(spark, [(1, "a b")], []) == []
    assert got(spark, [(1, "a"), (2, "a"), (3, None)], [(1, "a a")]) == plain([(1, "a"), (2, "a"), (3, None)], [(1, "a a")])
