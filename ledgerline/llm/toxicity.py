"""Toxicity classifier with counterfactual regularisation.

Features are the words of a text and their first and last letters (so that inflections of a
learned word count too), each counted once per text. A logistic model is trained on a
bounded sample of labelled rows. For sampled texts that name a group (identity terms), a
counterfactual copy with the terms swapped within their kind is scored as well, and the
squared change of the score is part of the loss: a term that only happens to occur beside
toxic words keeps no weight of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import crc_of_id, documents, save, tidy
from ledgerline.llm.licenses import WORDS

#: Labelled rows that the model is trained on, at most (about).
TRAIN_ROWS = 20_000
#: Features kept: those that differ most between the labels.
FEATURES, LEAST_DOCS, LEAST_Z = 20_000, 4, 4.5
#: Words whose features one task remembers.
MEMO = 400_000
#: Words whose feature lists are held while features are counted, between two sums.
COUNTED = 40_000
# Kinds of identity terms; a term is swapped for the next of its kind.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("black", "white", "asian", "latino", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist"), ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("old", "young"), ("immigrants", "natives", "refugees"),
    ("disabled", "deaf", "blind"),
)
SWAP = {a.encode(): b.encode() for kind in IDENTITY for a, b in zip(kind, (*kind[1:], kind[0]), strict=True)}


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(WORDS).split()


def features(word: bytes) -> list[int]:
    """Hashes of a word, its beginnings and its endings."""
    letters = word.decode("utf-8", "ignore")
    parts = [f"={letters}"]
    parts += [f"^{letters[:n]}" for n in (3, 4, 5, 6) if len(letters) > n]
    parts += [f"{letters[-n:]}$" for n in (4, 5) if len(letters) > n]
    return [xxhash.xxh64_intdigest(p) >> 1 for p in parts]


class Chosen(dict):
    """Word -> places of its features among the chosen ones; most words have none."""

    def __init__(self, chosen: dict[int, int]):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= MEMO:
            self.clear()
        self[word] = found = tuple(self.chosen[f] for f in features(word) if f in self.chosen)
        return found

    def of(self, words: list[bytes]) -> list[int]:
        return sorted({p for w in set(words) for p in self[w]})


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature and how many texts of each label have it, summed within a task."""
    memo: dict[bytes, list[int]] = {}
    held: list[np.ndarray] = []
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = {f for w in set(words_of(text or "")) for f in (memo.get(w) or memo.setdefault(w, features(w)))}
            held.append(np.fromiter(found, np.int64, len(found)) * 2 + label if found else np.zeros(0, np.int64))
        if sum(map(len, held)) > 1_000_000 or len(memo) > COUNTED:
            yield _counted(held)
            held, memo = [], {}
    if held:
        yield _counted(held)


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate(held), return_counts=True)
    one = (keys & 1).astype(bool)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys >> 1), pa.array(np.where(one, n, 0)), pa.array(np.where(one, 0, n))], names=["feature", "ones", "zeros"]
    )


def sampled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, label) of about ``most`` labelled documents at most, chosen by a hash of the id.

    Repeated label rows of a document count once: a document with both labels counts as 1.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marked = marked.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    n = marked.count()
    if n > most:
        marked = marked.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * most / n))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample is bounded by ``most`` rows of two numbers.
    joined = texts.join(F.broadcast(marked), "doc_id").select("text", "label")
    return save(joined.repartition(12), "labelled_sample")


def _rows(chosen: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Chosen(chosen)
        for batch in batches:
            own, swapped = [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text or "")
                own.append(known.of(words))
                named = any(w in SWAP for w in words)
                swapped.append(known.of([SWAP.get(w, w) for w in words]) if named else None)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(own, kind), pa.array(swapped, kind)], names=["label", "own", "swapped"]
            )

    return run


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(r) for r in rows]
    return np.repeat(np.arange(len(rows)), sizes), np.array([p for r in rows for p in r], dtype=np.int64)


def fit(labels, own, swapped, width: int, penalty: float = 2.0, ridge: float = 1e-4, steps: int = 800) -> tuple[np.ndarray, float]:
    """Weights and bias of the penalised logistic loss, by Adam on all rows.

    loss = mean log loss + penalty * mean over swapped rows of (logit change) ** 2
           + ridge / 2 * sum of squared weights
    """
    y = np.asarray(labels, float)
    r, c = _sparse(own)
    pairs = [k for k, s in enumerate(swapped) if s is not None]
    pr, pc = _sparse([own[k] for k in pairs])
    qr, qc = _sparse([swapped[k] for k in pairs])
    share = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
    w, b = np.zeros(width), float(np.log(share / (1 - share)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1 if len(y) else 0):
        logit = b + np.bincount(r, weights=w[c], minlength=len(y))
        error = (1 / (1 + np.exp(-logit)) - y) / len(y)
        g = np.bincount(c, weights=error[r], minlength=width) + ridge * w
        if pairs:
            change = np.bincount(pr, weights=w[pc], minlength=len(pairs)) - np.bincount(qr, weights=w[qc], minlength=len(pairs))
            pull = 2 * penalty * change / len(pairs)
            g += np.bincount(pc, weights=pull[pr], minlength=width) - np.bincount(qc, weights=pull[qr], minlength=width)
        g = np.r_[g, error.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


class Model:
    def __init__(self, chosen: dict[int, int], weights: np.ndarray, bias: float):
        self.chosen, self.weights, self.bias = chosen, weights, bias


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_ROWS, penalty: float = 2.0) -> Model:
    """Learns from documents (doc_id, text) and labels (doc_id, label 0/1, others ignored).

    Without labelled rows the model gives every text one half; with one label only, its share.
    """
    sample = sampled(docs, labels, label, most)
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    ones, zeros = n.get(1, 0), n.get(0, 0)
    if not ones or not zeros:
        return Model({}, np.zeros(0), 0.0 if ones == zeros else float(np.log((ones + 0.5) / (zeros + 0.5))))
    counts = sample.mapInArrow(tidy(_feature_counts), "feature long, ones long, zeros long").groupBy("feature")
    share = (F.col("ones") + F.col("zeros")) / float(ones + zeros)
    spread = F.sqrt(share * (1 - share) * (1 / ones + 1 / zeros))
    z = F.abs(F.col("ones") / float(ones) - F.col("zeros") / float(zeros)) / spread
    best = (
        counts.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        .where(F.col("ones") + F.col("zeros") >= LEAST_DOCS)
        .withColumn("z", z)
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "feature")
        .select("feature")
        .limit(FEATURES)
    )
    chosen = {r["feature"]: k for k, r in enumerate(best.collect())}
    kind = "label int, own array<int>, swapped array<int>"
    rows = sample.mapInArrow(tidy(_rows(chosen)), kind).collect()
    weights, bias = fit(
        [r["label"] for r in rows], [r["own"] for r in rows], [r["swapped"] for r in rows], len(chosen), penalty
    )
    return Model(chosen, weights, bias)


def scorer(model: Model):
    """Text column -> score from 0 to 1. Null and empty texts have the bias alone."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Chosen(model.chosen)
        for part in texts:
            logits = [model.bias + float(model.weights[known.of(words_of(x.as_py() or ""))].sum()) for x in part]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, float), -500, 500))))

    return F.arrow_udf(tidy(run), T.DoubleType())


def query(spark, sf_dir: str) -> DataFrame:
    held_out = crc_of_id() % 5 == 0
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    score = scorer(train(docs, labels.where(~held_out)))
    scored = docs.select("doc_id", held_out.alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
