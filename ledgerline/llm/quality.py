"""Quality classifier by hierarchical empirical Bayes.

A small logistic model on the shape of a text gives each document evidence of its own. Sites
(host) and their sections (path) get Beta posteriors from all their documents' evidence:
the global mean is the prior of a host, the host's posterior mean the prior of its paths. How
strongly a prior holds is estimated from the data (method of moments over hosts, and over
paths within hosts), so a site with few documents stays near the prior and a large one
speaks for itself. A document's score adds the log odds of its path to its own evidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import documents, save, tidy
from ledgerline.llm.toxicity import TRAIN_ROWS, sampled

#: Documents with a score below it are rejected.
THRESHOLD = 0.5
#: Bounds of the weight of a prior, in documents.
LEAST, MOST = 2.0, 10_000.0
_LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 or b > 127 for b in range(256)])
_SIGNS = np.array([33 <= b <= 126 and not chr(b).isalnum() for b in range(256)])


def shape(text: str) -> list[float]:
    """Numbers that describe a text's form, none of them its meaning or language."""
    raw = text.encode("utf-8", "surrogatepass")
    bytes_ = np.frombuffer(raw, np.uint8)
    seen = np.bincount(bytes_, minlength=256)
    words = raw.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    distinct = len(set(words))
    signs = seen[_SIGNS]
    ends = seen[46] + seen[33] + seen[63]
    after = sum(map(bytes.__eq__, words, words[1:]))
    lines = raw.split(b"\n")
    short = sum(map((4).__gt__, map(len, words)))
    tail = sum(map(_SIGNED, [w[-1] for w in words]))
    return [
        np.log1p(len(words)),
        distinct / n,
        np.log(distinct + 1) / np.log(n + 2),
        after / n,
        float(seen[_LETTERS].sum()) / size,
        float(signs.sum()) / size,
        float(signs.max(initial=0)) / size,
        ends / n,
        seen[44] / n,
        float(seen[124]) / n,
        min(size / n, 30.0),
        short / n,
        tail / n,
        len(set(lines)) / max(len(lines), 1),
        float(seen[65:91].sum()) / n,
        float(seen[48:58].sum()) / size,
    ]


_SIGNED = _SIGNS.tolist().__getitem__


class Evidence:
    """Logistic model on standardised shapes and their squares."""

    def __init__(self, middle: np.ndarray, spread: np.ndarray, weights: np.ndarray):
        self.middle, self.spread, self.weights = middle, spread, weights

    def columns(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.spread, -8, 8)
        return np.hstack([np.ones((len(x), 1)), z, z * z])

    def of(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.columns(x) @ self.weights, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> Evidence:
    """Ridge logistic regression by Newton steps."""
    model = Evidence(x.mean(axis=0), x.std(axis=0) + 1e-6, np.zeros(1 + 2 * x.shape[1]))
    c = model.columns(x)
    hold = ridge * np.eye(c.shape[1])
    hold[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(c @ model.weights, -30, 30)))
        step = np.linalg.solve(c.T @ (c * np.maximum(p * (1 - p), 1e-6)[:, None]) + hold, c.T @ (y - p) - hold @ model.weights)
        model.weights = model.weights + step
        if np.abs(step).max() < 1e-6:
            break
    return model


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [shape(x or "") for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["label", "shape"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_ROWS) -> Evidence | None:
    """Learns from documents (doc_id, text) and labels (doc_id, label 0/1); None without both labels."""
    rows = sampled(docs, labels, label, most).mapInArrow(tidy(_shapes), "label int, shape array<double>").collect()
    if len({r["label"] for r in rows}) < 2:
        return None
    return fit(np.array([r["shape"] for r in rows]), np.array([r["label"] for r in rows], float))


def evidence(model: Evidence | None):
    """Text column -> chance of good quality by the text alone; one half without a model."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            if not model or not len(part):
                yield pa.array(np.full(len(part), 0.5))
                continue
            yield pa.array(model.of(np.array([shape(x.as_py() or "") for x in part])))

    return F.arrow_udf(tidy(run), T.DoubleType())


def host_of(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path: of ``url`` if the table has one, else source and source/lang. Null is ''."""
    if "url" in docs.columns:
        host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/?#]*)", 1)
        first = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://[^/?#]*/([^/?#]*)", 1)
        return host, first
    return tuple(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("") for c in ("source", "lang"))


def _weight(between: Column, mean: Column) -> Column:
    """Weight of a Beta prior from the variance between groups: mean (1 - mean) / variance - 1."""
    weight = mean * (1 - mean) / F.greatest(between, F.lit(1e-12)) - 1
    return F.least(F.greatest(F.coalesce(weight, F.lit(MOST)), F.lit(LEAST)), F.lit(MOST))


def posteriors(marked: DataFrame) -> DataFrame:
    """(_host, _path, _p) of every document -> posterior mean per path, and the global mean.

    Documents are summed per path first, so that a host with a third of all rows is a few
    rows before it meets in one place. The variance between groups is what their means vary
    beyond chance: the sum of n (mean - m) ** 2, less the part expected from sampling.
    """
    paths = marked.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.sum("_p").alias("s"), F.sum(F.col("_p") * F.col("_p")).alias("q"))
    paths = save(paths, "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"))
    # one row each: totals, and moments of hosts around the global mean
    total = hosts.agg(F.sum("hn").alias("tn"), F.sum("hs").alias("ts"), F.sum("hq").alias("tq"), F.count(F.lit(1)).alias("hosts")).first()
    n = total["tn"] or 0
    mean = (total["ts"] + 0.5) / (n + 1) if n else 0.5
    noise = max(total["tq"] / n - (total["ts"] / n) ** 2, 0.0) if n else 0.0

    def between(rows: DataFrame, size: str, found: Column, centre: Column, groups: int) -> float:
        moment = rows.agg(F.sum(F.col(size) * (found - centre) ** 2), F.sum(size)).first()
        return max(((moment[0] or 0.0) - max(groups - 1, 0) * noise) / max(moment[1] or 1, 1), 0.0)

    host_weight = _weight(F.lit(between(hosts, "hn", F.col("hs") / F.col("hn"), F.lit(mean), total["hosts"])), F.lit(mean))
    hosts = hosts.withColumn("host_mean", (F.col("hs") + host_weight * mean) / (F.col("hn") + host_weight))
    joined = paths.join(hosts.select("_host", "host_mean"), "_host")
    path_spread = between(joined, "n", F.col("s") / F.col("n"), F.col("host_mean"), paths.count() - total["hosts"] + 1)
    path_weight = _weight(F.lit(path_spread), F.lit(mean))
    site = (F.col("s") + path_weight * F.col("host_mean")) / (F.col("n") + path_weight)
    return joined.select("_host", "_path", site.alias("_site"), F.lit(mean).alias("_global"))


def _odds(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


def scored(docs: DataFrame, model: Evidence | None) -> DataFrame:
    """Adds ``quality_evidence``, ``quality_site``, ``quality_score`` to (text, source, lang or url).

    A null text counts as empty, a null host or path as ''. Repeated rows each count. The
    evidence is computed for the sums and again for the scores: that costs less than
    storing the texts beside it.
    """
    own = {"quality_evidence", "quality_site", "quality_score", "_host", "_path", "_site", "_global"}
    kept = [c for c in docs.columns if c not in own]
    host, path = host_of(docs)
    marked = docs.select(
        *kept, host.alias("_host"), path.alias("_path"), evidence(model)(F.col("text").cast("string")).alias("quality_evidence")
    )
    sums = posteriors(marked.select("_host", "_path", F.col("quality_evidence").alias("_p")))
    both = marked.join(sums, ["_host", "_path"])
    logit = _odds(F.col("quality_evidence")) + _odds(F.col("_site")) - _odds(F.col("_global"))
    return both.select(*kept, "quality_evidence", F.col("_site").alias("quality_site"), (1 / (1 + F.exp(-logit))).alias("quality_score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = train(docs, labels)
    # the text itself is not carried along
    host, path = host_of(docs)
    narrow = save(docs.select("doc_id", host.alias("_host"), path.alias("_path"), evidence(model)(F.col("text")).alias("evidence")), "evidence")
    sums = posteriors(narrow.withColumnRenamed("evidence", "_p"))
    logit = _odds(F.col("evidence")) + _odds(F.col("_site")) - _odds(F.col("_global"))
    found = narrow.join(sums, ["_host", "_path"]).withColumn("score", 1 / (1 + F.exp(-logit)))
    return found.select("doc_id", "evidence", F.col("_site").alias("site"), "score", (F.col("score") >= THRESHOLD).alias("kept"))
