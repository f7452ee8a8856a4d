import math
import re
import zlib

import numpy as np

from sluiceway.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in toxicity.op11_toxicity(spark, SF).collect()}
    assert len(got) == 10_000
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= toxicity.ACCEPT) for r in got.values())
    labels = [(got[r.doc_id], r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r.doc_id].held_out]
    bad = [r.score for r, t in labels if t == 1]
    clean = [r.score for r, t in labels if t == 0]
    assert np.mean([s >= toxicity.ACCEPT for s in bad]) > 0.85 and np.mean([s < toxicity.ACCEPT for s in clean]) > 0.97
    assert np.mean([[(b > c) + (b == c) / 2 for c in clean] for b in bad]) > 0.95


def test_scores_are_those_of_a_plain_noisy_or(spark):
    rng = np.random.default_rng(3)
    names = [f"w{i}" for i in range(30)] + ["abcd*"]
    model = toxicity.Model(-3.0, {n: float(x) for n, x in zip(names, rng.normal(0, 2, len(names)))})
    texts = [" ".join(rng.choice(["w1", "W2", "w3.", "w4!", "x\n", "abcdef", "w29?"], n)) for n in (0, 1, 5, 40, 400)]

    def plain(text):
        clean, worst, at = 1.0, None, 0
        for part in re.split(r"[.!?\n]", text):
            words = re.findall(r"[^\W_]+", part)
            for k in range(0, len(words), toxicity.LONGEST):
                some = {w.lower() for w in words[k : k + toxicity.LONGEST]}
                z = model.bias + sum(model.weights.get(f, 0) for w in some for f in [w] + [w[:n] + "*" for n in toxicity.PREFIXES if len(w) > n])
                p = 1 / (1 + math.exp(-z))
                clean *= 1 - p
                worst = p if worst is None else max(worst, p)
        return 1 - clean, worst

    for text in texts:
        score, n, start, end, p = model.document(text)
        want, worst = plain(text)
        assert abs(score - want) < 1e-9 and (p is None) == (worst is None) and (p is None or abs(p - worst) < 1e-9)
        if p is not None:
            assert abs(model.sentence([w.lower() for w in re.findall(r"[^\W_]+", text[start:end])]) - p) < 1e-9


def test_learning_follows_the_slope_of_the_loss(monkeypatch):
    bags, labels = [[[0], [1, 2], []], [[2]], [[], [0, 2]], [[]]], np.array([1, 0, 1, 0])
    weights = np.array([1.0, 2.0, 1.0, 1.0])

    def loss(b, w):
        total = 0.0
        for bag, y, k in zip(bags, labels, weights / weights.sum()):
            clean = math.prod(1 - 1 / (1 + math.exp(-(b + sum(w[f] for f in s)))) for s in bag)
            total -= k * math.log(1 - clean if y else clean)
        return total + toxicity.DECAY / 2 * float(np.square(w).sum())

    monkeypatch.setattr(toxicity, "EPOCHS", 4000)
    monkeypatch.setattr(toxicity, "RATE", 0.02)
    monkeypatch.setattr(toxicity, "DECAY", 0.01)
    b, w = toxicity.fit(bags, labels, weights, 3)
    for i in range(4):
        e = np.eye(4)[i] * 1e-4
        assert abs(loss(b + e[3], w + e[:3]) - loss(b - e[3], w - e[:3])) / 2e-4 < 2e-3


def _planted(spark, n=400):
    ids = [k for k in range(100, 100 + 2 * n) if zlib.crc32(str(k).encode()) % 5][:n]
    plain = "one quiet sentence here. another calm line follows! and a third"
    rows = [(k, f"{plain}. you awful thing. more calm words" if k % 4 == 0 else plain + f". number {k}", "x") for k in ids]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(
        [(k, int(k % 4 == 0)) for k in ids], "doc_id long, toxic int"
    )


def test_offending_sentences_are_found(spark):
    docs, labels = _planted(spark)
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic")
    new = spark.createDataFrame([(1, "Calm words. Oh, you AWFUL thing! Good day."), (2, "calm words here"), (3, None)], "doc_id long, text string")
    got = toxicity.toxic_sentences(new, model).collect()
    assert [(r.doc_id, r.start, r.end, r.sentence) for r in got] == [(1, 12, 31, "Oh, you AWFUL thing")]


def test_edges(spark):
    docs, labels = _planted(spark)
    rows = [(1, None, "a"), (2, "", "a"), (3, "you awful thing", "a"), (3, "you awful thing", "a"), (None, "calm", None), (4, "w " * 300000 + ". you awful thing", "b"), (5, "...!?", "")]
    more = docs.union(spark.createDataFrame(rows, docs.schema))
    known = labels.union(spark.createDataFrame([(None, 1), (105, None), (10**6, 7)], labels.schema))
    got = toxicity.toxicity_scores(more, known).collect()
    assert len(got) == docs.count() + 7
    by_key = {r.doc_id: r for r in got}
    assert by_key[1].score == by_key[2].score == by_key[5].score == 0 and by_key[1].n_sentences == 0 and by_key[1].worst_start is None
    assert by_key[3].predicted == by_key[4].predicted == 1 and by_key[None].predicted == 0 and not by_key[None].held_out
    assert by_key[4].n_sentences == 300000 // toxicity.LONGEST + 1
    assert {r.score for r in toxicity.toxicity_scores(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0
