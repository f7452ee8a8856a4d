import zlib

import numpy as np

from sluiceway.llm import quality, words

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in quality.op5_quality(spark, SF).collect()}
    assert len(got) == 10_000
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= quality.ACCEPT) for r in got.values())
    labels = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r.doc_id].held_out]
    good = [r.score for r, q in labels if q == 1]
    bad = [r.score for r, q in labels if q == 0]
    above = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert above > 0.95
    assert np.mean([s >= quality.ACCEPT for s in good]) > 0.97 and np.mean([s < quality.ACCEPT for s in bad]) > 0.8


def test_attention_is_the_same_by_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(rng.integers(1, 9), quality.FEATURES)) for _ in range(60)]
    labels = np.array([float(b[:, 0].max() > 1) for b in bags])
    model = quality.fit(bags, labels, 0.5)
    whole = [model.logit(list(b)) for b in bags]
    for b, w in zip(bags, whole):
        h, a = model.encoded(b)
        p = np.exp(a) / np.exp(a).sum()
        assert abs(p @ h @ model.out + model.out_0 - w) < 1e-9
    assert np.mean((np.array(whole) > 0) == labels) > 0.9
    monkeypatch.setattr(quality, "_AT_ONCE", 2)
    assert np.allclose([model.logit(list(b)) for b in bags], whole)


def test_passages_hold_every_word(monkeypatch):
    text = " ".join(f"w{i}" for i in range(1234)).encode()
    whole = [f.tolist() for f in quality.document_features(text)]
    monkeypatch.setattr(words, "PIECE", 50)
    assert [f.tolist() for f in quality.document_features(text)] == whole and len(whole) == 13


def test_learning_reads_every_passage():
    rng = np.random.default_rng(3)
    for n in (1, 7, 8, 15, 16, 17, 40, 1000):
        bag = rng.normal(size=(n, quality.FEATURES))
        got = quality.pooled(iter(bag), 8)
        assert len(got) <= 16 and (n >= 16 or np.array_equal(got, bag))
        run = 1
        while -(-n // run) > len(got):
            run *= 2
        want = [bag[i : i + run].mean(axis=0) for i in range(0, n, run)]
        assert np.allclose(got, want)


def test_edges(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "good words here", 5), (3, "good words here", 5), (None, "!!! ###", 5), (4, "w " * 300000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(docs, empty).collect()} == {1.0}
    ids = [k for k in range(20, 200) if zlib.crc32(str(k).encode()) % 5][:80]
    more = docs.union(spark.createDataFrame([(k, "fine words in a row" if k % 2 else "#### !!!! ####", 5) for k in ids], docs.schema))
    labels = spark.createDataFrame([(k, k % 2) for k in ids] + [(None, 1), (ids[0], None), (10**6, 7)], "doc_id long, quality int")
    got = quality.quality_scores(more, labels).collect()
    assert len(got) == 86
    by_key = {r.doc_id: r for r in got}
    assert by_key[1].score == by_key[2].score and by_key[3].predicted == 1 and not by_key[None].held_out
    kept = quality.quality_filter(more, labels)
    assert kept.columns == docs.columns
    assert kept.where("doc_id >= 20").count() == sum(k % 2 for k in ids)
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
