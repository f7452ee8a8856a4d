"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from how it is written (kinds of characters, repetition,
lengths of words); gated attention, learned from labels of whole documents, weighs the encoded passages; the weighted
sum is scored. Learning uses a bounded sample of labelled documents; scoring reads every passage of every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.words import word_lists

# Words of a passage.
PASSAGE = 100
# The bound of what is learned from: documents of each label. All their passages count.
SAMPLE = 1500
# From twice as many passages on, runs of neighbours are averaged for learning, so that a bag has a bounded size.
LONGEST = 1024
HIDDEN, GATE, EPOCHS, SEED = 16, 8, 250, 5
ACCEPT = 0.3
# Passages encoded at once.
_AT_ONCE = 8192

_KINDS = [
    range(ord("A"), ord("Z") + 1),
    range(ord("a"), ord("z") + 1),
    range(ord("0"), ord("9") + 1),
    [ord("!"), ord("?")],
    [ord("."), ord(",")],
    [ord("|"), ord("\t")],
    [ord(c) for c in "#$%&*@^~+=<>_\\"],
    [ord(c) for c in "\"'()-/:;[]{}`"],
    range(128, 256),
]
_MATRIX = np.zeros((256, len(_KINDS)))
for _i, _kind in enumerate(_KINDS):
    _MATRIX[list(_kind), _i] = 1
FEATURES = len(_KINDS) + 7


def passage_features(words: list[bytes]) -> np.ndarray:
    """How a passage is written; zeros for one without words."""
    out = np.zeros(FEATURES)
    if not words:
        return out
    joined = b" ".join(words)
    n, size = len(words), len(joined) - len(words) + 1
    counts = np.bincount(np.frombuffer(joined, np.uint8), minlength=256)
    out[: len(_KINDS)] = counts @ _MATRIX / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    rest = out[len(_KINDS) :]
    rest[0] = len(set(words)) / n
    rest[1] = sum(map(bytes.__eq__, words, words[1:])) / n
    rest[2] = np.log1p(size / n)
    rest[3] = np.log1p(lengths.std())
    rest[4] = np.count_nonzero(lengths <= 2) / n
    rest[5] = np.log1p(int(lengths.max()))
    rest[6] = n / PASSAGE
    return out


def document_features(text: bytes | None):
    """Features of every passage of a text, in order; one passage without words for a text without any."""
    left: list[bytes] = []
    some = False
    for words in word_lists(text or b""):
        left += words
        whole = len(left) // PASSAGE * PASSAGE
        for at in range(0, whole, PASSAGE):
            some = True
            yield passage_features(left[at : at + PASSAGE])
        left = left[whole:]
    if left or not some:
        yield passage_features(left)


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score."""

    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    encode_0: np.ndarray
    value: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    out_0: float

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoded passages and their attention before normalising."""
        h = np.tanh((x - self.mean) / self.scale @ self.encode + self.encode_0)
        return h, (np.tanh(h @ self.value) / (1 + np.exp(-(h @ self.gate)))) @ self.attend

    def logit(self, passages) -> float:
        """Score of a bag whose passages come one after another: memory doesn't grow with the bag."""
        top, weight, total, block = -np.inf, 0.0, np.zeros(len(self.out)), []

        def add() -> None:
            nonlocal top, weight, total
            h, a = self.encoded(np.array(block))
            new = max(top, float(a.max()))
            old = np.exp(top - new) if weight else 0.0
            e = np.exp(a - new)
            top, weight, total = new, weight * old + float(e.sum()), total * old + e @ h

        for x in passages:
            block.append(x)
            if len(block) == _AT_ONCE:
                add()
                block = []
        if block:
            add()
        return float(total / weight @ self.out + self.out_0)


def fit(bags: list[np.ndarray], labels: np.ndarray, prior: float) -> Model:
    """Learn from bags of passages with a label each. `prior` is the share of label 1 among all rows to learn from."""
    rng = np.random.default_rng(SEED)
    x = np.concatenate(bags)
    starts = np.cumsum([0] + [len(b) for b in bags])[:-1]
    bag_of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    w = {
        "encode": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)),
        "encode_0": np.zeros(HIDDEN),
        "value": rng.normal(0, 0.3, (HIDDEN, GATE)),
        "gate": rng.normal(0, 0.3, (HIDDEN, GATE)),
        "attend": rng.normal(0, 0.3, GATE),
        "out": rng.normal(0, 0.3, HIDDEN),
        "out_0": np.zeros(1),
    }
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    weights = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    for epoch in range(1, EPOCHS + 1):
        h = np.tanh(z @ w["encode"] + w["encode_0"])
        t, s = np.tanh(h @ w["value"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        a = (t * s) @ w["attend"]
        e = np.exp(a - np.maximum.reduceat(a, starts)[bag_of])
        p = e / np.add.reduceat(e, starts)[bag_of]
        bag = np.add.reduceat(p[:, None] * h, starts, axis=0)
        score = 1 / (1 + np.exp(-(bag @ w["out"] + w["out_0"])))
        d = (score - labels) * weights
        d_bag = d[:, None] * w["out"]
        d_p = (d_bag[bag_of] * h).sum(axis=1)
        d_a = p * (d_p - np.add.reduceat(p * d_p, starts)[bag_of])
        d_t, d_s = d_a[:, None] * w["attend"] * s * (1 - t * t), d_a[:, None] * w["attend"] * t * s * (1 - s)
        d_h = p[:, None] * d_bag[bag_of] + d_t @ w["value"].T + d_s @ w["gate"].T
        d_z = d_h * (1 - h * h)
        grads = {
            "encode": z.T @ d_z + 1e-4 * w["encode"],
            "encode_0": d_z.sum(axis=0),
            "value": h.T @ d_t,
            "gate": h.T @ d_s,
            "attend": (t * s).T @ d_a,
            "out": bag.T @ d + 1e-4 * w["out"],
            "out_0": np.array([d.sum()]),
        }
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - 0.02 * (first[k] / (1 - 0.9**epoch)) / (np.sqrt(second[k] / (1 - 0.999**epoch)) + 1e-8)
    # Both labels weighed the same; the score is to hold for the share of labels as it is.
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    out_0 = float(w.pop("out_0")[0] + np.log(prior / (1 - prior)))
    return Model(mean, scale, **w, out_0=out_0)


def pooled(passages, longest: int = LONGEST) -> np.ndarray:
    """A document's passages for learning: all of them, or at most twice `longest` means of runs, twice as long whenever too many."""
    rows, run, total, held = [], 1, np.zeros(FEATURES), 0
    for one in passages:
        total, held = total + one, held + 1
        if held < run:
            continue
        rows.append(total / held)
        total, held = np.zeros(FEATURES), 0
        if len(rows) == 2 * longest:
            rows, run = [(a + b) / 2 for a, b in zip(rows[::2], rows[1::2])], 2 * run
    if held:
        rows.append(total / held)
    return np.array(rows)


def held_out(key: Column) -> Column:
    """Rows never learned from: a checksum of the key as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> Model | None:
    """Learn from at most `sample` documents of each label; None without both labels.

    Labels other than 0 and 1, and documents with both, are left out.
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
    chosen = F.broadcast(drawn[0].union(drawn[1]).select("_key", "_label"))  # at most twice the sample

    def run(batches):
        for batch in batches:
            bags = []
            for one in batch.column(1).cast(pa.binary()):
                bags.append(pooled(document_features(one.as_py())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bags, pa.binary())], names=["key", "label", "bag"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.join(chosen, F.col("key") == F.col("_key")).select("key", "text", F.col("_label").cast("int").alias("label"))
    # Rows that repeat a key are one document here, the first by its features.
    found = rows.mapInArrow(run, "key long, label int, bag binary").groupBy("key", "label").agg(F.min("bag").alias("bag"))
    found = sorted(found.collect())
    if len({r.label for r in found}) < 2:
        return None
    bags = [np.frombuffer(bytes(r.bag), np.float32).reshape(-1, FEATURES).astype(float) for r in found]
    return fit(bags, np.array([r.label for r in found], float), totals[1] / (totals[0] + totals[1]))


def scored(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, from its text alone; 1 for all rows without a model."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            logits = [40.0 if model is None else model.logit(document_features(x.as_py())) for x in texts]
            scores = 1 / (1 + np.exp(-np.clip(np.array(logits, float), -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["key", "score"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, score double")


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> DataFrame:
    """One row (key, held_out, score, predicted) per document.

    A NULL or empty text is a bag of one passage without words, and gets that bag's score. A NULL key is not held out.
    Equal texts get equal scores. Without labels of both kinds to learn from, every score is 1. Other columns are
    ignored, and an empty table gives an empty result.
    """
    rows = scored(docs, train(docs, labels, key, text, label, sample), key, text)
    return rows.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"),
    )


def quality_filter(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of `docs` whose text is predicted 1, with all columns and in one pass; a NULL text is like an empty one."""
    model = train(docs, labels, key, text, label)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            good = [model is None or model.logit(document_features(x.as_py())) >= np.log(ACCEPT / (1 - ACCEPT)) for x in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
