"""Interpolated modified Kneser-Ney bigram model, counted in Spark, memory-mapped for scoring.

Words are 64-bit hashes. The hash space is cut into equal ranges ("shards"); a word's id is
its place in the sorted hashes of its shard plus the words in earlier shards. A pair's key is
(id of the first) << 32 | (id of the second). Three jobs over the texts:

1. word counts per shard, combined in the tasks before the shuffle, stored as sorted hashes;
2. pair counts, dealt by the first word's shard and, where that shard is heavy, also by
   ranges of the second word's id, stored as sorted keys. Each task also returns what it
   knows of contexts (how many followers were seen once, twice, more often) and of
   continuations (how many different words stand before a word), summed per shard;
3. scoring: workers map the arrays of the shared folder into memory and look words and
   pairs up by binary search in batches.

Rows of the shuffles are compressed arrays, not single n-grams. The driver holds a few
numbers per shard and the discounts.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import batches_of, crc_of_id, documents, word_hashes
from ledgerline.sources.layers import scratch_path

#: Hashes of the end token and of the start context (never a word's token).
END, START = np.uint64(0x0E4D0E4D0E4D0E4D), np.uint64(0x57A4757A4757A475)
#: Characters of training text per shard, and tokens that a task gathers before it sends them.
SHARD_CHARS, GATHER = 12_000_000, 3_000_000
SCORES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("perplexity", T.DoubleType()),
    ]
)


class Folder:
    """Arrays in a folder that all executors share; a remote one is copied before mapping."""

    def __init__(self, uri: str):
        self.uri = uri.rstrip("/")
        parsed = urlparse(self.uri)
        self.local = parsed.path if parsed.scheme in ("", "file") else None

    def put(self, name: str, array: np.ndarray) -> None:
        """Write under a name of its own, then rename: a repeated task leaves the same file."""
        if self.local:
            os.makedirs(self.local, exist_ok=True)
            handle, temporary = tempfile.mkstemp(dir=self.local)
            with os.fdopen(handle, "wb") as out:
                np.save(out, array)
            os.chmod(temporary, 0o644)
            os.replace(temporary, f"{self.local}/{name}.npy")
        else:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.uri)
            store.create_dir(path)
            temporary = f"{path}/{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as out:
                np.save(out, array)
            store.move(temporary, f"{path}/{name}.npy")

    def get(self, name: str) -> np.ndarray:
        if self.local:
            return np.load(f"{self.local}/{name}.npy", mmap_mode="r")
        from pyarrow import fs

        # The copy's folder is named by the whole address: folders of two runs have the same last part.
        own = f"{tempfile.gettempdir()}/arrays-{hashlib.sha256(self.uri.encode()).hexdigest()[:32]}"
        os.makedirs(own, exist_ok=True)
        if not os.path.exists(path := f"{own}/{name}.npy"):
            part = f"{path}.{uuid.uuid4().hex}"
            fs.copy_files(f"{self.uri}/{name}.npy", part)
            os.replace(part, path)
        return np.load(path, mmap_mode="r")


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as a compressed blob; the first is sorted and sent as differences."""
    first, *rest = arrays
    gaps = np.diff(first, prepend=first.dtype.type(0))
    planes = [x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in (gaps, *[np.ascontiguousarray(x) for x in rest])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(blob: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        plane = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += n * width
    return [np.cumsum(out[0], dtype=kinds[0]), *out[1:]]


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *[np.add.reduceat(v[order], starts) if len(keys) else v for v in values]


def token_stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end after each, and the text each belongs to."""
    hashes, text = word_hashes(texts)
    tokens = np.full(len(hashes) + len(texts), END, np.uint64)
    owner = np.zeros(len(tokens), np.int64)
    place = np.arange(len(hashes)) + text
    tokens[place], owner[place] = hashes, text
    ends = np.cumsum(np.bincount(text, minlength=len(texts))) + np.arange(len(texts))
    owner[ends] = np.arange(len(texts))
    return tokens, owner


def texts_of(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for part in batches_of(batch, 1 << 20):
            yield part, [x or "" for x in part.column(column).to_pylist()]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Range of the hash space, from the upper half of the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _ranges(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted array."""
    if len(shard):
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(shard)], strict=True):
            yield int(shard[a]), slice(a, b)


BLOB = "shard long, part long, kind int, n long, blob binary"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "part", "kind", "n", "blob"])


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            words, counts = np.unique(np.concatenate(held), return_counts=True)
            return _blobs([(s, 0, 0, r.stop - r.start, packed(words[r], counts[r].astype(np.uint32))) for s, r in _ranges(shard_of(words, shards))])

        for _, texts in texts_of(batches):
            tokens, _ = token_stream(texts)
            held.append(np.concatenate([tokens, np.full(len(texts), START, np.uint64)]))
            size += len(held[-1])
            if size > GATHER:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _store_words(folder: Folder):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """Sorted hashes and counts of a shard; returns its sizes."""
        shard = key[0].as_py()
        parts = [unpacked(b.as_py(), n.as_py(), np.uint64, np.uint32) for n, b in zip(group.column("n"), group.column("blob"), strict=True)]
        words, counts = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64))
        folder.put(f"hash.{shard}", words)
        folder.put(f"count.{shard}", counts)
        real = words != START
        return pa.table({"shard": [shard], "words": [len(words)], "types": [int(real.sum())], "tokens": [int(counts[real].sum())], "load": [int(counts.sum())]})

    return run


class Words:
    """Sorted hashes of all shards, mapped on first use."""

    def __init__(self, folder: Folder, sizes: np.ndarray):
        self.folder, self.shards = folder, len(sizes)
        self.first = np.r_[0, np.cumsum(sizes)]
        self.mapped: dict[tuple[str, int], np.ndarray] = {}

    def field(self, name: str, shard: int) -> np.ndarray:
        if (name, shard) not in self.mapped:
            self.mapped[name, shard] = self.folder.get(f"{name}.{shard}")
        return self.mapped[name, shard]

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes, -1 for unknown ones."""
        out = np.full(len(words), -1, np.int64)
        for shard, r in _ranges(shard_of(words, self.shards)):
            if self.first[shard + 1] > self.first[shard]:
                known = self.field("hash", shard)
                place = np.minimum(np.searchsorted(known, words[r]), len(known) - 1)
                out[r] = np.where(known[place] == words[r], place + self.first[shard], -1)
        return out

    def stats(self, name: str, ids: np.ndarray, shape: tuple = ()) -> np.ndarray:
        """A field of sorted ids; zero for -1."""
        shard = np.searchsorted(self.first, ids, "right") - 1
        out = np.zeros((len(ids), *shape), np.int64)
        for s, r in _ranges(shard):
            if s >= 0:
                out[r] = self.field(name, s)[ids[r] - self.first[s]]
        return out


def _keys(tokens: np.ndarray, owner: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes' ids, and per token the place of its own and of the previous one among them."""
    distinct, place = np.unique(np.r_[START, tokens], return_inverse=True)
    own = place[1:]
    new = np.r_[True, owner[1:] != owner[:-1]]
    return words.ids(distinct), own, np.where(new, place[0], np.r_[0, own[:-1]])


def _count_pairs(folder: Folder, sizes: np.ndarray, parts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(folder, sizes), int(sizes.sum())
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            pairs, counts = np.unique(np.concatenate(held), return_counts=True)
            a, b = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
            shard = np.searchsorted(words.first, a, "right") - 1
            part = b * parts[shard] // total
            order = np.lexsort((pairs, part, shard))
            where = (shard * (int(parts.max()) + 1) + part)[order]
            pairs, counts, shard, part = pairs[order], counts[order].astype(np.uint32), shard[order], part[order]
            return _blobs([(int(shard[r.start]), int(part[r.start]), 0, r.stop - r.start, packed(pairs[r], counts[r])) for _, r in _ranges(where)])

        for _, texts in texts_of(batches):
            ids, own, previous = _keys(*token_stream(texts), words)
            held.append(ids[previous].astype(np.uint64) << np.uint64(32) | ids[own].astype(np.uint64))
            size += len(own)
            if size > GATHER:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _store_pairs(folder: Folder, sizes: np.ndarray):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """Sorted keys and counts of a part; returns sums for contexts (1) and continuations (2)."""
        shard, part = (x.as_py() for x in key)
        parts = [unpacked(b.as_py(), n.as_py(), np.uint64, np.uint32) for n, b in zip(group.column("n"), group.column("blob"), strict=True)]
        keys, counts = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64))
        folder.put(f"pair.{shard}.{part}", keys)
        folder.put(f"times.{shard}.{part}", counts.astype(np.uint32 if counts.max() < 2**32 else np.int64))
        seen = np.bincount(np.minimum(counts, 5), minlength=6)[:6].astype(np.int64)
        rows = [(-1, 0, 0, 6, seen.tobytes())]
        a = keys >> np.uint64(32)
        once = [(np.minimum(counts, 3) == k).astype(np.uint32) for k in (1, 2, 3)]
        context, *followers = summed(a, *once)
        rows.append((shard, 0, 1, len(context), packed(context, *[x.astype(np.uint32) for x in followers])))
        after, before = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
        first = np.r_[0, np.cumsum(sizes)]
        for s, r in _ranges(np.searchsorted(first, after.astype(np.int64), "right") - 1):
            rows.append((s, 0, 2, r.stop - r.start, packed(after[r], before[r].astype(np.uint32))))
        return pa.Table.from_batches([_blobs(rows)])

    return run


def _store_stats(folder: Folder, sizes: np.ndarray):
    first = np.r_[0, np.cumsum(sizes)]

    def run(key: tuple, group: pa.Table) -> pa.Table:
        """Per word of a shard: followers seen once, twice, more often; words before it."""
        shard = key[0].as_py()
        if shard < 0:
            seen = sum(np.frombuffer(b.as_py(), np.int64) for b in group.column("blob"))
            return pa.table({"shard": [shard], "seen": [seen.tolist()], "pairs": [0]})
        out = np.zeros((int(sizes[shard]), 4), np.uint32)
        for kind, n, blob in zip(*(group.column(c) for c in ("kind", "n", "blob")), strict=True):
            if kind.as_py() == 1:
                ids, *followers = unpacked(blob.as_py(), n.as_py(), np.uint64, np.uint32, np.uint32, np.uint32)
                for k, x in enumerate(followers):
                    np.add.at(out[:, k], ids.astype(np.int64) - first[shard], x)
            else:
                ids, before = unpacked(blob.as_py(), n.as_py(), np.uint64, np.uint32)
                np.add.at(out[:, 3], ids.astype(np.int64) - first[shard], before)
        folder.put(f"stats.{shard}", out)
        seen = np.bincount(np.minimum(out[:, 3], 5), minlength=6)[:6]
        return pa.table({"shard": [shard], "seen": [seen.tolist()], "pairs": [int(out[:, 3].sum(dtype=np.int64))]})

    return run


def discounts(seen: np.ndarray) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more, from how many n-grams were seen 1 to 4 times.

    Where the counts of counts are too poor for the formula, k is discounted by k / 2.
    """
    n = np.asarray(seen, float)
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if n[1] > 0 and n[2] > 0:
        y = n[1] / (n[1] + 2 * n[2])
        for k in (1, 2, 3):
            d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0
            if 0 < d < k:
                out[k] = d
    return out


class Model:
    """Numbers of the model that are not arrays, and the folder of those."""

    def __init__(self, folder: Folder, sizes: np.ndarray, parts: np.ndarray, tokens: int, types: int, pairs: int, seen, before):
        self.folder, self.sizes, self.parts = folder, sizes, parts
        self.tokens, self.types, self.pairs = tokens, types, pairs
        self.pair_discounts, self.word_discounts = discounts(seen), discounts(before)
        spread = sum(self.word_discounts[min(k, 3)] * before[k] for k in range(1, 6))
        #: Probability of a word never seen, and what every word has at least.
        self.floor = spread / max(pairs, 1) / (types + 1) if pairs else 1.0


def train(docs: DataFrame) -> Model:
    """Counts all words and pairs of (text); a null text is empty. No rows: every word is unknown."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"))
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-chars // SHARD_CHARS))
    folder = Folder(scratch_path(spark, "ngrams"))
    made = (
        texts.mapInArrow(_count_words(shards), BLOB)
        .groupBy("shard")
        .applyInArrow(_store_words(folder), "shard long, words long, types long, tokens long, load long")
        .collect()
    )
    sizes, load = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
    for r in made:
        sizes[r["shard"]], load[r["shard"]] = r["words"], r["load"]
    if sizes.sum() >= 2**32:
        raise OverflowError("word ids take 32 bits")
    parts = np.maximum(1, -(-load // max(1, 2 * int(load.mean()))))
    if not sizes.sum():
        return Model(folder, sizes, parts, 0, 0, 0, np.zeros(6), np.zeros(6))
    stats = (
        texts.mapInArrow(_count_pairs(folder, sizes, parts), BLOB)
        .groupBy("shard", "part")
        .applyInArrow(_store_pairs(folder, sizes), BLOB)
        .groupBy("shard")
        .applyInArrow(_store_stats(folder, sizes), "shard long, seen array<long>, pairs long")
        .collect()
    )
    seen = next(np.array(r["seen"]) for r in stats if r["shard"] < 0)
    before = sum(np.array(r["seen"]) for r in stats if r["shard"] >= 0)
    return Model(
        folder, sizes, parts, sum(r["tokens"] for r in made), sum(r["types"] for r in made), sum(r["pairs"] for r in stats), seen, before
    )


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.words = Words(model.folder, model.sizes)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted pair keys."""
        out = np.zeros(len(keys), np.int64)
        a, b = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        shard = np.searchsorted(self.words.first, a, "right") - 1
        part = b * self.model.parts[shard] // int(self.model.sizes.sum())
        order = np.argsort(shard * (int(self.model.parts.max()) + 1) + part, kind="stable")
        for _, r in _ranges((shard * (int(self.model.parts.max()) + 1) + part)[order]):
            at = order[r]
            name = int(shard[at[0]]), int(part[at[0]])
            try:
                known = self.words.field(f"pair.{name[0]}", name[1])
            except FileNotFoundError:  # no pair was dealt there
                continue
            place = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
            hit = known[place] == keys[at]
            out[at[hit]] = self.words.field(f"times.{name[0]}", name[1])[place[hit]]
        return out

    def score(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base and model log10 probability."""
        m = self.model
        tokens, owner = token_stream(texts)
        ids, own, previous = _keys(tokens, owner, self.words)
        order = np.argsort(ids, kind="stable")
        back = np.argsort(order, kind="stable")
        count = self.words.stats("count", ids[order])[back]
        stats = self.words.stats("stats", ids[order], (4,))[back]
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
        before = stats[:, 3]
        single = np.maximum(before - m.word_discounts[np.minimum(before, 3)], 0) / max(m.pairs, 1) + m.floor
        freed = np.where(count > 0, stats[:, :3] @ m.pair_discounts[1:] / np.maximum(count, 1), 1.0)
        known = (ids[own] >= 0) & (ids[previous] >= 0)
        keys = (ids[previous[known]].astype(np.uint64) << np.uint64(32)) | ids[own[known]].astype(np.uint64)
        distinct, place = np.unique(keys, return_inverse=True)
        times = np.zeros(len(tokens), np.int64)
        times[known] = self.pair_counts(distinct)[place]
        direct = np.maximum(times - m.pair_discounts[np.minimum(times, 3)], 0) / np.maximum(count[previous], 1)
        score = np.log10(direct + freed[previous] * single[own])
        n = len(texts)
        return (
            np.bincount(owner, minlength=n),
            np.bincount(owner, weights=count[own] > 0, minlength=n).astype(np.int64),
            np.bincount(owner, weights=base[own], minlength=n),
            np.bincount(owner, weights=score, minlength=n),
        )


def score(docs: DataFrame, model: Model, held_out: str = "held_out") -> DataFrame:
    """(doc_id, text, held_out) -> ``SCORES``. A null or empty text is the end token alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part, texts in texts_of(batches, 2):
            n, known, base, value = scorer.score(texts)
            columns = [part.column(0), part.column(1), n, known, np.full(len(n), model.tokens), base, value, 10 ** (-value / n)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=SCORES.names)

    picked = docs.select(F.col("doc_id").cast("long"), F.col(held_out).alias("held_out"), F.col("text").cast("string"))
    return picked.mapInArrow(run, SCORES)


def query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("held_out", crc_of_id() % 5 == 1)
    return score(docs, train(docs.where("NOT held_out")))
