"""Toxicity by multiple-instance learning: a document is a bag of sentences, and is toxic if any sentence is.

Every sentence gets a probability from its words; noisy-or combines them: a document is clean only if all its sentences
are. Only documents carry labels to learn from, yet what is learned tells sentences apart, so that the offending ones are
found. Learning uses all sentences of a bounded sample of labelled documents; scoring reads every sentence of all texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.quality import held_out
from sluiceway.llm.shared import staged

# The bound of what is learned from: documents of each label, with all their sentences.
SAMPLE = 1500
# Features are kept whose shares among documents of both labels differ by so many standard errors, and that so many hold.
APART, SUPPORT = 4.5, 4
# Words of a sentence; a longer stretch without an end of sentence is cut.
LONGEST = 60
PREFIXES = (4, 5, 6, 7)
EPOCHS, RATE, DECAY, FIRST_BIAS, SEED = 400, 0.1, 1e-5, -4.0, 11
ACCEPT = 0.5
# Words whose weights a task remembers.
_REMEMBERED = 500_000

_STRETCH = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start and end in characters, and words in lower case, of every sentence that has words."""
    for found in _STRETCH.finditer(text):
        places = [(m.start(), m.end()) for m in _WORD.finditer(text, found.start(), found.end())]
        for at in range(0, len(places), LONGEST):
            part = places[at : at + LONGEST]
            yield part[0][0], part[-1][1], [text[a:b].lower() for a, b in part]


def features(word: str) -> list[str]:
    """What a word says: itself, and how it begins."""
    return [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) > n]


@dataclass
class Model:
    """Weights of features; the score of a sentence without any known one is `bias`."""

    bias: float
    weights: dict[str, float]
    _words: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        found = self._words.get(word)
        if found is None:
            if len(self._words) >= _REMEMBERED:
                self._words.clear()
            found = self._words[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return found

    def sentence(self, words: list[str]) -> float:
        """Probability that a sentence is toxic; words count once."""
        z = self.bias + sum(map(self.word, sorted(set(words))))
        return math.exp(min(z, 30) - math.log1p(math.exp(min(z, 30)))) if z > -40 else 0.0

    def document(self, text: str | None) -> tuple[float, int, int | None, int | None, float | None]:
        """Noisy-or of all sentences, their number, and start, end and probability of the worst (the first of equals)."""
        clean, n, worst = 0.0, 0, (None, None, None)
        for start, end, words in sentences(text or ""):
            p = self.sentence(words)
            clean += math.log1p(-p)
            n += 1
            if worst[2] is None or p > worst[2]:
                worst = (start, end, p)
        return -math.expm1(clean), n, *worst


def fit(bags: list[list[list[int]]], labels: np.ndarray, weights: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Bias and weights of `size` features, from bags of sentences (lists of features) with a label and weight each.

    The loss is that of the noisy-or of every bag: with s the sum of -log(1 - p) over its sentences, s for label 0 and
    -log(1 - exp(-s)) for label 1.
    """
    flat = [(nr, s) for nr, bag in enumerate(bags) for s in bag if s]
    bag = np.array([nr for nr, _ in flat], np.int64)
    lengths = np.array([len(s) for _, s in flat], np.int64)
    of = np.fromiter((f for _, s in flat for f in s), np.int64, int(lengths.sum()))
    row = np.repeat(np.arange(len(flat)), lengths)
    plain = np.array([sum(not s for s in bag) for bag in bags])  # sentences without features are all alike
    w, b = np.zeros(size), FIRST_BIAS
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    weights = weights / weights.sum()
    for epoch in range(1, EPOCHS + 1):
        z = b + np.bincount(row, w[of], len(flat))
        p, p_plain = 1 / (1 + np.exp(-np.clip(z, -40, 40))), 1 / (1 + np.exp(-b))
        s = np.bincount(bag, np.logaddexp(0, z), len(bags)) + plain * np.logaddexp(0, b)
        d_bag = weights * np.where(labels == 1, -1 / np.maximum(np.expm1(np.minimum(s, 40)), 1e-9), 1.0)
        d = d_bag[bag] * p
        grad = np.append(np.bincount(of, d[row], size) + DECAY * w, d.sum() + (d_bag * plain).sum() * p_plain)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        step = RATE * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.999**epoch)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return float(b), w


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> Model | None:
    """Learn from at most `sample` documents of each label; None without both labels.

    Labels other than 0 and 1, and documents with both, are left out. The labels' shares among all rows to learn from
    weigh the sample, so that scores are probabilities for all of them.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
        .where("_label = _most")
    )
    totals = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if len(totals) < 2:
        return None
    drawn = [
        known.where(F.col("_label") == v).orderBy(F.xxhash64(F.lit(SEED), "_key"), "_key").limit(sample) for v in (0, 1)
    ]
    chosen = F.broadcast(drawn[0].union(drawn[1]).select("_key", F.col("_label").cast("int").alias("_label")))  # twice the sample at most

    def bags(batches):
        for batch in batches:
            cut = [[sorted({f for w in ws for f in features(w)}) for *_, ws in sentences(x.as_py() or "")] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(cut, pa.list_(pa.list_(pa.string())))], names=["key", "label", "bag"]
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.join(chosen, F.col("key") == F.col("_key")).select("key", "text", F.col("_label").alias("label"))
    # Rows that repeat a key are one document here, the first by its sentences.
    cut = rows.mapInArrow(bags, "key long, label int, bag array<array<string>>").groupBy("key", "label").agg(F.min("bag").alias("bag"))
    found = staged(cut, "bags")
    of_label = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if len(of_label) < 2:
        return None
    share = F.lit(float(sum(of_label.values())))
    counted = found.select("label", F.explode(F.array_distinct(F.flatten("bag"))).alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("ones"), F.count("*").alias("all")
    )
    apart = F.abs(F.col("ones") / of_label[1] - (F.col("all") - F.col("ones")) / of_label[0])
    spread = F.sqrt(F.col("all") / share * (1 - F.col("all") / share) * (1 / of_label[0] + 1 / of_label[1]))
    told = counted.where((F.col("all") >= SUPPORT) & (apart >= APART * spread) & (apart > 0))
    names = sorted(r.feature for r in told.select("feature").collect())
    place = {f: i for i, f in enumerate(names)}
    bag_rows = sorted(
        (r.key, r.label, [[place[f] for f in s if f in place] for s in r.bag] or [[]]) for r in found.toLocalIterator()
    )
    y = np.array([r[1] for r in bag_rows])
    weights = np.array([totals[v] / (y == v).sum() for v in y])
    bias, w = fit([r[2] for r in bag_rows], y, weights, len(names))
    return Model(bias, {f: float(x) for f, x in zip(names, w) if x})


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE
) -> DataFrame:
    """One row (key, held_out, score, predicted, n_sentences, worst_start, worst_end, worst_score) per document.

    `score` is the noisy-or of its sentences; the worst sentence is given by its characters, end exclusive. A NULL or
    empty text, or one without words, has no sentence: score 0 and no worst one. A NULL key is not held out. Equal
    texts get equal scores. Without labels of both kinds to learn from, every score is 0. Other columns are ignored, and
    an empty table gives an empty result.
    """
    model = train(docs, labels, key, text, label, sample) or Model(-math.inf, {})

    def run(batches):
        for batch in batches:
            found = [model.document(x.as_py()) for x in batch.column(1)]
            kinds = [pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            names = ["key", "score", "n_sentences", "worst_start", "worst_end", "worst_score"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    schema = "key long, score double, n_sentences long, worst_start long, worst_end long, worst_score double"
    return _rows(docs, key, text).mapInArrow(run, schema).select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"),
        "n_sentences",
        "worst_start",
        "worst_end",
        "worst_score",
    )


def toxic_sentences(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = ACCEPT) -> DataFrame:
    """Every sentence of probability `least` or more: (key, start, end, score, sentence), characters with end exclusive."""

    def run(batches):
        for batch in batches:
            found = []
            for k, x in zip(batch.column(0), batch.column(1)):
                body = x.as_py() or ""
                for start, end, words in sentences(body):
                    p = model.sentence(words)
                    if p >= least:
                        found.append({"key": k.as_py(), "start": start, "end": end, "score": p, "sentence": body[start:end]})
            schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("sentence", pa.string())])
            yield pa.RecordBatch.from_pylist(found, schema)

    return _rows(docs, key, text).mapInArrow(run, "key long, start long, end long, score double, sentence string").withColumnRenamed("key", key)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
