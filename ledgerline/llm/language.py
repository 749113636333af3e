"""Language identification with string kernels, Nystroem landmarks and kernel ridge regression.

The kernel is the blended spectrum: two texts are as alike as the share of character n-grams
(lengths 1 to 3, presence only) they have in common, |A & B| / sqrt(|A| |B|). N-grams are exact
64-bit keys, so neither a long text nor a large script makes different ones fall together. A
bounded set of landmark texts spans the feature space; one ridge regression per language
separates it from the rest. A batch of texts is scored by matrix products: with the landmarks'
n-grams, in blocks of the landmarks' vocabulary, and with the weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import batches_of, crc_of_id, documents

LENGTHS = (1, 2, 3)
#: N-grams of the landmarks' vocabulary that one matrix product covers.
BLOCK = 1 << 14
#: Rows trained on, at most (about), and landmarks among them; both per learned language.
TRAIN_ROWS, LANDMARKS = 1000, 32
RIDGE = 1e-3
NONE = "und"
LETTER = re.compile(r"[^\W\d_]")
#: ASCII code points that are no letters count as one blank.
CODES = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)], np.uint32)
FOUND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def ngrams(text: str) -> np.ndarray:
    """Sorted keys of the different n-grams of a text with three blanks on either side."""
    codes = np.frombuffer(f"   {text.lower()}   ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes < 128, CODES[np.minimum(codes, 127)], codes).astype(np.int64)
    found = []
    for n in LENGTHS:
        # The n-gram that ends at each place, as a number to the base 0x110000 that begins with n.
        gram = np.full(len(codes) - 3, n, np.int64)
        for k in range(n - 1, -1, -1):
            gram = gram * 0x110000 + codes[3 - k : len(codes) - k]
        found.append(np.unique(gram))
    return np.concatenate(found)


class Landmarks:
    """The n-grams of the landmark texts: their vocabulary, and who has which, a bit for each."""

    def __init__(self, texts: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in texts])
        self.vocabulary = np.unique(np.concatenate(texts))
        has = np.zeros((len(self.vocabulary), (len(texts) + 7) // 8), np.uint8)
        for k, x in enumerate(texts):
            has[np.searchsorted(self.vocabulary, x), k // 8] |= 128 >> k % 8
        self.has = has

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, landmarks): blended spectrum presence kernel of texts given by their n-grams."""
        shared = np.zeros((len(texts), len(self.sizes)))
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        keys = np.concatenate(texts)
        at = np.minimum(np.searchsorted(self.vocabulary, keys), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == keys
        at, owner = at[known], owner[known]
        for start in range(0, len(self.vocabulary), BLOCK):
            has = np.unpackbits(self.has[start : start + BLOCK], axis=1, count=len(self.sizes)).astype(np.float32)
            inside = (at >= start) & (at < start + len(has))
            present = np.zeros((len(texts), len(has)), np.float32)
            present[owner[inside], at[inside] - start] = 1
            shared += present @ has
        return shared / np.sqrt(np.outer([len(x) for x in texts], self.sizes))


class Model:
    def __init__(self, languages: list[str], landmarks: Landmarks, weights: np.ndarray):
        #: weights: (landmarks, languages) over the kernel with the landmarks
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    def margins(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): 1 is aimed at for the language, -1 for the rest."""
        return self.landmarks.kernel([ngrams(x) for x in texts]) @ self.weights


def fit(kernels: np.ndarray, languages: list[str], marks: list[np.ndarray], ridge: float = RIDGE) -> Model:
    """One-versus-rest ridge regression on Nystroem features.

    With K the kernel, L the landmarks and U = K(L, L) ** -1/2, texts have the features
    K(., L) U; the regression weights W on them fold into U W, applied to K(., L) itself.
    ``kernels`` is K(texts, L), ``languages`` those of the texts, ``marks`` the n-grams of L.
    """
    names = sorted(set(languages))
    of = np.array([names.index(x) for x in languages])
    landmarks = Landmarks(marks)
    values, vectors = np.linalg.eigh(landmarks.kernel(marks))
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = kernels @ root
    y = np.where(of[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = 1 / np.bincount(of)[of]  # each language counts alike
    left = (x * weight[:, None]).T @ x + ridge * np.eye(x.shape[1])
    return Model(names, landmarks, root @ np.linalg.solve(left, (x * weight[:, None]).T @ y))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [ngrams(x).tobytes() for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(keys, pa.binary())], names=["lang", "place", "keys"])


def _kernels(landmarks: Landmarks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, 1 << 20):
                rows = landmarks.kernel([ngrams(x) for x in part.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([r.tobytes() for r in rows], pa.binary())], names=["lang", "kernel"])

    return run


def train(docs: DataFrame, rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> Model | None:
    """Learns from (doc_id, text, lang); rows without language or letters are left out.

    About ``rows`` texts per language are used, chosen by a hash of the id; the first
    ``landmarks`` of them by a hash of the text are landmarks. The landmarks' n-grams and a row of
    the kernel for each text used come to the driver. Returns None without any.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows / n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000
    sample = usable.where(drawn).where(F.col("text").rlike(r"\p{L}")).select("text", "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))
    picked = sample.withColumn("place", place).where(F.col("place") <= landmarks)
    marks = picked.mapInArrow(_keys, "lang string, place int, keys binary").collect()
    if not marks:
        return None
    keys = [np.frombuffer(r["keys"], np.int64) for r in sorted(marks, key=lambda r: (r["lang"], r["place"]))]
    found = sample.mapInArrow(_kernels(Landmarks(keys)), "lang string, kernel binary").collect()
    found = sorted((r["lang"], bytes(r["kernel"])) for r in found)
    return fit(np.stack([np.frombuffer(k) for _, k in found]), [lang for lang, _ in found], keys)


def predictor(model: Model | None):
    """Text column -> struct of ``lang_pred`` and ``score``; ``und`` and 0 without letters."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            values = part.to_pylist()
            languages, scores = [NONE] * len(values), np.zeros(len(values))
            todo = [k for k, x in enumerate(values) if x and LETTER.search(x)] if model else []
            at = 0
            while at < len(todo):  # batches by rows and by letters: bounded matrices
                own, size = [], 0
                while at < len(todo) and len(own) < 128 and size < 1 << 20:
                    own.append(todo[at])
                    size += len(values[todo[at]])
                    at += 1
                margins = model.margins([values[k] for k in own])
                best = margins.argmax(axis=1)
                scores[own] = np.clip((margins[np.arange(len(own)), best] + 1) / 2, 0, 1)
                for k, b in zip(own, best.tolist(), strict=True):
                    languages[k] = model.languages[b]
            yield pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores)], names=FOUND.names)

    return F.arrow_udf(run, FOUND)


def query(spark, sf_dir: str) -> DataFrame:
    held_out = crc_of_id() % 4 == 2
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = predictor(train(docs.where(~held_out)))(F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("_found")).select("doc_id", "held_out", "_found.*")
