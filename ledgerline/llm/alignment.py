"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes. Merging the two sorted lists of byte ends visits every pair
of overlapping tokens; where both lists have the same end, a group closes. The merge is parted
by its path: a binary search on a diagonal finds how many ends of either list the first ``d``
steps take, so pieces of equal work begin anywhere without looking at what is before them. All
pieces advance step by step together and emit overlaps. A piece that begins between two equal
ends sees that the group has been closed already; groups are stitched from the closed ends.

Neither vocabulary joins words, so a batch's distinct chunks are aligned, once each, end to end
in one merge, and texts are sums over their chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import batches_of, documents, mix64, save
from ledgerline.llm.ngrams import Folder, summed
from ledgerline.llm.sentencepieces import SPACE, Encoder
from ledgerline.llm.vocab import TEXTS, ByteBpe, Chunks, between_words, bytes_of, column_of, ranks_of
from ledgerline.sources.layers import scratch_path

#: Steps of the merge that a piece takes; id pairs of a stored shard; bytes of groups in a batch.
WORK, SHARD, OUT = 64, 2_000_000, 8 << 20


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first ``d`` merged ends are a's (of equal ends a's come first), for each d."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        later = a[middle] <= b[diagonals[open_] - 1 - middle]
        low[open_[later]] = middle[later] + 1
        high[open_[~later]] = middle[~later]
    return low


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens (place in a, place in b) in order of the texts, and whether both end there.

    ``a`` and ``b`` are increasing byte ends of two cuts of the same bytes.
    """
    n = len(a) + len(b)
    begins = np.arange(0, n, work)
    i = crossings(a, b, begins)
    j = begins - i
    far = np.iinfo(np.int64).max
    padded_a, padded_b, before = np.r_[a, far], np.r_[b, far], np.r_[-1, a]
    left, right, kind = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int8)
    for step in range(work):
        live = len(begins) - (bool(len(begins)) and begins[-1] + step >= n)
        i, j, begins = i[:live], j[:live], begins[:live]
        x, y = padded_a[i], padded_b[j]
        takes = x <= y
        at = begins + step
        left[at], right[at] = i, j
        # 2: both end here; 1: one ends within the other; 0: the end that closed the group before
        kind[at] = np.where(x == y, 2, takes | (before[i] != y))
        i, j = i + takes, j + ~takes
    seen = kind > 0
    return left[seen], right[seen], kind[seen] == 2


class Aligner:
    """Both vocabularies; see ``Aligned``."""

    def __init__(self, ranks_path: str, encoder: Encoder):
        self.a, self.b = ByteBpe(ranks_path), encoder
        v = encoder.vocabulary
        raw_a = {k: t for t, k in ranks_of(ranks_path).items()}
        raw_b = {k: t.encode() for k, t in v.text.items()} | {k: bytes([b]) for k, b in v.byte.items()}
        self.raw_a = pa.array([raw_a.get(k, b"") for k in range(max(raw_a) + 1)], pa.binary())
        self.raw_b = pa.array([raw_b.get(k, b"") for k in range(v.size)], pa.binary())
        #: Ids as text with what follows them: another one of the group, the other side, the next group.
        size = max(len(self.raw_a), v.size)
        self.names = pa.array([b"%d%b" % (k, s) for s in (b",", b"|", b";") for k in range(size)], pa.binary())
        self.size = size


class Aligned:
    """A batch of texts with its distinct chunks aligned.

    A text has a blank put before it. One whose tokens of either side do not spell it (``apart``)
    has no tokens, as has an empty one.
    """

    def __init__(self, aligner: Aligner, texts: pa.Array):
        plain = column_of(texts)
        texts = pc.if_else(pc.equal(plain, ""), plain, column_of(texts, " "))
        cuts: Callable = between_words if aligner.b.vocabulary.cut else (lambda data: np.zeros(0, np.int64))
        self.aligner, self.chunks = aligner, Chunks(texts, cuts)
        distinct = self.chunks.distinct
        sign = distinct.cast(pa.string())
        ids_a, count_a = aligner.a.of_chunks(distinct)
        ids_b, count_b = aligner.b.of_chunks(pc.replace_substring(sign, SPACE, " "))
        good = self._spelled(aligner.raw_a, ids_a, count_a) & self._spelled(aligner.raw_b, ids_b, count_b)
        self.a, self.b = ids_a[np.repeat(good, count_a)].astype(np.int64), ids_b[np.repeat(good, count_b)].astype(np.int64)
        self.count_a, self.count_b = np.where(good, count_a, 0), np.where(good, count_b, 0)
        self.apart = self.chunks.per_text(~good) > 0
        self.ends_a, self.ends_b = (np.cumsum(self._widths(r)[x]) for r, x in ((aligner.raw_a, self.a), (aligner.raw_b, self.b)))
        self.left, self.right, self.closes = overlaps(self.ends_a, self.ends_b)
        #: Links: overlapping tokens that end together; how many each distinct chunk has.
        self.link_a, self.link_b = self.left[self.closes], self.right[self.closes]
        self.owner = np.repeat(np.arange(len(distinct)), self.count_a)[self.link_a] if len(distinct) else np.zeros(0, np.int64)
        self.links = np.bincount(self.owner, minlength=len(distinct))

    @staticmethod
    def _widths(raw: pa.Array) -> np.ndarray:
        return np.diff(bytes_of(raw)[1])

    def _spelled(self, raw: pa.Array, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Whether the tokens of each distinct chunk put together are its bytes."""
        data, at = bytes_of(self.chunks.distinct)
        found, places = bytes_of(raw.take(pa.array(ids)))
        bounds = places[np.r_[0, np.cumsum(count)]]
        if np.array_equal(at, bounds) and np.array_equal(data, found):
            return np.ones(len(count), bool)
        data, found = data.tobytes(), found.tobytes()
        return np.array([data[at[k] : at[k + 1]] == found[bounds[k] : bounds[k + 1]] for k in range(len(count))], bool)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.where(self.apart, 0, self.chunks.per_text(values))

    def keys(self) -> np.ndarray:
        """Id pair of each link, b's id above."""
        return self.b[self.link_b] << 32 | self.a[self.link_a]

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct id pairs of the links and how often texts have them."""
        used = np.repeat(~self.apart, np.diff(self.chunks.first))
        times = np.bincount(self.chunks.places[used], minlength=len(self.links))
        keys, n = summed(self.keys(), times[self.owner])
        return keys[n > 0], n[n > 0]

    def groups(self) -> list[str]:
        """Groups of each text: ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        group_a, group_b = np.searchsorted(self.link_a, np.arange(len(self.a))), np.searchsorted(self.link_b, np.arange(len(self.b)))
        before_a, before_b = np.r_[0, self.link_a + 1], np.r_[0, self.link_b + 1]
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[self.link_a], last_b[self.link_b] = True, True
        size = self.aligner.size
        codes = np.zeros(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + before_b[group_a]] = self.a + np.where(last_a, size, 0)
        codes[np.arange(len(self.b)) + before_a[group_b + 1]] = self.b + np.where(last_b, 2 * size, 0)
        data, places = bytes_of(self.aligner.names.take(pa.array(codes)))
        bounds = places[np.r_[0, np.cumsum(self.count_a + self.count_b)]].tolist()
        data = data.tobytes().decode()
        named = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        at, first = self.chunks.places.tolist(), self.chunks.first.tolist()
        return [
            "" if apart else "".join([named[k] for k in at[a:b]])[:-1]
            for a, b, apart in zip(first, first[1:], self.apart.tolist(), strict=False)
        ]


class Counts:
    """Counts of id pairs, and whether a pair's is the highest of its b: shards in a shared folder."""

    def __init__(self, folder: Folder, shards: int):
        self.folder, self.shards = folder, shards
        self.mapped: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        shard = shard_of(keys, self.shards)
        for k in np.unique(shard).tolist():
            if k not in self.mapped:
                self.mapped[k] = self.folder.get(f"pair.{k}"), self.folder.get(f"times.{k}")
            known, times = self.mapped[k]
            at = np.flatnonzero(shard == k)
            found = times[np.searchsorted(known, keys[at])]
            out[at], best[at] = np.abs(found), found < 0
        return out, best


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(keys.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch], aligner: Aligner) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    for batch in batches:
        for part in batches_of(batch, TEXTS // 2):
            yield part, Aligned(aligner, part.column(1))


def pair_table(docs: DataFrame, ranks_path: str, encoder: Encoder) -> DataFrame:
    """(doc_id, text) -> (a, b, n, best): how often ids end together, and whether b has none more often.

    A batch sends each pair once; pairs of one b id are no more than a's vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ranks_path, encoder)
        for _, batch in _batches(batches, aligner):
            keys, n = batch.pair_counts()
            columns = [pa.array(keys & 0xFFFFFFFF), pa.array(keys >> 32), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

    counts = _picked(docs).mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def stored(pairs: DataFrame) -> Counts:
    """``pair_table`` as sorted arrays in the shared folder; no pair passes through the driver."""
    pairs = save(pairs, "id_pairs")
    shards = 1 + pairs.count() // SHARD
    folder = Folder(scratch_path(pairs.sparkSession, "id_pair_arrays"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).to_numpy() << 32 | batch.column(0).to_numpy()
            signed = np.where(batch.column(3).to_numpy(zero_copy_only=False), -1, 1) * batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(key, shards)), pa.array(key), pa.array(signed)], names=["shard", "key", "n"])

    def store(key: tuple, rows: pa.Table) -> pa.Table:
        shard, pair = key[0].as_py(), rows.column("key").to_numpy()
        order = np.argsort(pair)
        folder.put(f"pair.{shard}", pair[order])
        folder.put(f"times.{shard}", rows.column("n").to_numpy()[order])
        return pa.table({"shard": [shard]})

    dealt = pairs.select("a", "b", "n", "best").mapInArrow(run, "shard long, key long, n long")
    dealt.groupBy("shard").applyInArrow(store, "shard long").count()
    return Counts(folder, shards)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def aligned(docs: DataFrame, ranks_path: str, model_path: str) -> DataFrame:
    """(doc_id, text) -> ``ALIGNED``: tokens of both sides, the groups they fall into, links and their counts.

    Side A is the byte-level vocabulary over a blank and the text, side B the piece model over
    the text. A null or empty text, and one that either side does not spell byte by byte (it
    has U+2581), has zeros and no groups. Null and repeated doc_ids and repeated rows are rows
    of their own, and all count. An empty table gives none.
    """
    encoder = Encoder(model_path)
    counts = stored(pair_table(docs, ranks_path, encoder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ranks_path, encoder)
        names = [c.split()[0] for c in ALIGNED.split(", ")]
        for part, batch in _batches(batches, aligner):
            distinct, place = np.unique(batch.keys(), return_inverse=True)
            times, best = (x[place] for x in counts.of(distinct))
            sums = np.zeros(len(batch.links), np.int64)
            np.add.at(sums, batch.owner, times)
            links = batch.per_text(batch.links)
            ups = np.bincount(batch.owner[best], minlength=len(batch.links))
            whole = (batch.count_a, batch.count_b, batch.links, batch.links, ups, sums)
            groups = pa.array(batch.groups(), pa.string())
            columns = [part.column(0), *[pa.array(batch.per_text(x)) for x in whole], groups]
            yield from batches_of(pa.RecordBatch.from_arrays(columns, names=names), OUT)

    return _picked(docs).mapInArrow(run, ALIGNED)


def overlapping(docs: DataFrame, ranks_path: str, model_path: str) -> DataFrame:
    """(doc_id, text) -> one row per distinct chunk of a batch and pair of overlapping tokens in it.

    chunk, times (how often the batch's texts have it), a, b (ids), start and stop (bytes of
    the overlap within the chunk), closes (both tokens end there).
    """
    encoder = Encoder(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ranks_path, encoder)
        for _, x in _batches(batches, aligner):
            owner = np.repeat(np.arange(len(x.links)), x.count_a)[x.left] if len(x.links) else x.left
            begins = np.r_[0, x.ends_a][np.r_[0, np.cumsum(x.count_a)]][:-1]
            start = np.maximum(np.r_[0, x.ends_a][x.left], np.r_[0, x.ends_b][x.right]) - begins[owner]
            stop = np.minimum(x.ends_a[x.left], x.ends_b[x.right]) - begins[owner]
            times = np.bincount(x.chunks.places, minlength=len(x.links))[owner]
            columns = [
                x.chunks.distinct.cast(pa.string()).take(pa.array(owner)),
                *[pa.array(c) for c in (times, x.a[x.left], x.b[x.right], start, stop, x.closes)],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "times", "a", "b", "start", "stop", "closes"])

    return _picked(docs).mapInArrow(run, "chunk string, times long, a long, b long, start long, stop long, closes boolean")


def query(spark, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    rows = aligned(documents(spark, sf_dir, "doc_id", "text"), path("byte_bpe_50k.tiktoken"), path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return rows.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256")
