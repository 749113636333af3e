"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints within three bits share at least one of four blocks of 16 bits, so they meet in
a group keyed by (block number, block value). A group's members are sorted by Gray rank:
neighbours then differ in few bits, and runs of them agree on many. The index stores, level
by level, which bits a run agrees on and their values, leaving out what the level above has
already stated. A search carries the differences it has accumulated down the levels and
drops a whole run once they exceed the limit.

A group that is too large for one task is dealt out again by blocks of the bits that its
members do not share yet, as often as needed: distinct fingerprints part at last.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.collocations import _sent
from ledgerline.llm.common import FOLD, WHILE_SAVED, batches_of, discard, documents, give_back, mix64, save, settings, tidy, word_hashes
from ledgerline.llm.graph import components, spanning
from ledgerline.llm.ngrams import BLOB, Folder, _ranges, shard_of, summed, unpacked
from ledgerline.sources.layers import scratch_path

SEED, WORDS, BITS, LIMIT = 42, 3, 64, 3
#: Members of a group that one task compares; larger groups are dealt out again.
GROUP = 4096
#: Members of all groups that one task handles at a time.
BUCKET = 20_000
#: Bins of a shingle sketch (7 bits of a hash), the mark of an empty one, and the margin below the
#: similarity asked for that an estimate may have.
BINS, EMPTY, MARGIN = 128, 65535, 0.15
#: Runs of the index on its levels, finest last.
RUNS = (512, 64, 8)


def simhash(text: str) -> int:
    """Majority vote of the shingle hashes per bit; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").translate(FOLD).split()
    if len(words) < WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(b"%b %b %b" % x, SEED) for x in zip(words, words[1:], words[2:], strict=False)])
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8 << 14):  # long texts in steps
        rows = np.frombuffer(hashes[at : at + (8 << 14)], np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes) // 8).tobytes(), "big")


def _prints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in texts:
        values = np.array([simhash(x.as_py() or "") for x in part], dtype=np.uint64)
        yield pa.array(values.view(np.int64))


#: Text column -> fingerprint as a signed long. Null counts as empty.
fingerprint = F.arrow_udf(_prints, T.LongType())


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray code."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(k))
    return x


class GrayIndex:
    """Levels of runs over fingerprints in Gray order: bits a run agrees on, less those above."""

    def __init__(self, prints: np.ndarray):
        self.order = np.argsort(gray_rank(prints), kind="stable")
        self.prints = prints[self.order]
        n = len(prints)
        self.levels = []
        for run in (r for r in RUNS if r < n):
            starts = np.arange(0, n, run)
            ones = np.bitwise_and.reduceat(self.prints, starts)
            zeros = np.bitwise_and.reduceat(~self.prints, starts)
            mask = ones | zeros
            above = np.repeat(whole, ratio)[: len(starts)] if self.levels else np.zeros(len(starts), np.uint64)
            self.levels.append((run, mask & ~above, ones))
            whole = mask
            ratio = run // (smaller[0] if (smaller := [r for r in RUNS if r < run]) else 1)

    def pairs(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs i < j (places in Gray order) within the limit, in blocks of queries."""
        n = len(self.prints)
        for start in range(0, n, 512):
            query = np.arange(start, min(n, start + 512))
            # frontier: (query, run, differences so far); all runs of the coarsest level first
            if self.levels:
                q, node = (x.ravel() for x in np.meshgrid(query, np.arange(len(self.levels[0][1])), indexing="ij"))
            else:
                q, node = (x.ravel() for x in np.meshgrid(query, np.arange(n), indexing="ij"))
            gone = np.zeros(len(q), np.uint8)
            for k, (run, mask, ones) in enumerate(self.levels):
                ends = (node + 1) * run > q  # only later members: each pair once
                gone = gone + np.bitwise_count((self.prints[q] ^ ones[node]) & mask[node])
                keep = ends & (gone <= limit)
                q, node, gone = q[keep], node[keep], gone[keep]
                below = self.levels[k + 1][0] if k + 1 < len(self.levels) else 1
                ratio = run // below
                node = (node[:, None] * ratio + np.arange(ratio)).ravel()
                q, gone = np.repeat(q, ratio), np.repeat(gone, ratio)
                inside = node * below < n
                q, node, gone = q[inside], node[inside], gone[inside]
            near = (node > q) & (np.bitwise_count(self.prints[q] ^ self.prints[node]) <= limit)
            yield self.order[q[near]], self.order[node[near]]


def _dealt(prints: DataFrame, limit: int) -> list[DataFrame]:
    """(fp, id) -> tables of (bucket, key, fp, id).

    The groups of a key have at most ``GROUP`` members; a bucket holds whole groups with
    about ``BUCKET`` members in all, so that a task's work is bounded and not too small.
    """
    zero = F.lit(0).cast("long")
    rows = prints.select("fp", "id", zero.alias("_used"), zero.alias("_key"))
    done = []
    for level in range(BITS):
        rows = save(rows.select("fp", "id", F.inline(_blocks(limit))), f"groups{level}")
        counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        fits = F.col("_n") <= GROUP
        members, large = counts.agg(F.sum(F.when(fits, F.col("_n"))), F.count(F.when(~fits, 1))).first()
        bucket = F.pmod(F.xxhash64("_key"), F.lit(1 + (members or 0) // BUCKET))
        fit = rows.join(counts.where(fits).select("_key"), "_key", "left_semi")
        done.append(fit.select(bucket.alias("_bucket"), "_key", "fp", "id"))
        if not large:
            break
        rows = rows.join(counts.where(~fits).select("_key"), "_key", "left_semi")
    return done


def _blocks(limit: int):
    """The bits not shared yet in limit + 1 equal parts: one (mask, key) per part."""
    parts = limit + 1

    def masks(used: int) -> list[int]:
        free = [b for b in range(BITS - 1, -1, -1) if not used >> b & 1]
        return [sum(1 << int(b) for b in part) for part in np.array_split(free, parts)]

    def run(used: pa.Array, key: pa.Array, fp: pa.Array) -> pa.Array:
        seen: dict[int, list[int]] = {}
        new_used, new_key = [], []
        for u, k, f in zip(used.to_pylist(), key.to_pylist(), fp.to_pylist(), strict=True):
            u, f = u & (2**64 - 1), f & (2**64 - 1)
            if u not in seen:
                seen[u] = masks(u)
            for m in seen[u]:
                new_used.append(u | m)
                new_key.append(xxhash.xxh64_intdigest(b"%d %d %d" % (k, m, f & m)))
        flat = pa.StructArray.from_arrays(
            [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (new_used, new_key)], names=["_used", "_key"]
        )
        return pa.ListArray.from_arrays(np.arange(0, len(new_used) + 1, parts, dtype=np.int32), flat)

    return F.arrow_udf(run, "array<struct<_used:long,_key:long>>")("_used", "_key", "fp")


def _links(limit: int, least: float = 0.0):
    def run(rows: pa.Table) -> pa.Table:
        """Links within the groups of ``rows``: the closest ones that connect what is connected."""
        key, ids = rows.column("_key").to_numpy(), rows.column("id").to_numpy()
        prints = rows.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((gray_rank(prints), key))
        key, ids, prints = key[order], ids[order], prints[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        sketches = None
        if "sketch" in rows.column_names:
            blobs = rows.column("sketch").to_pylist()
            sketches = np.frombuffer(b"".join(blobs), np.uint16).reshape(len(blobs), BINS)[order]
        none = np.zeros(0, np.int64)
        a, b, held = none, none, 0
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def weight(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return np.bitwise_count(prints[i] ^ prints[j]) if sketches is None else 1 - estimated(sketches, i, j)

        def reduce() -> None:
            """A lightest forest of the links so far is all that later ones can add to."""
            nonlocal a, b, held
            i, j = (np.concatenate([x, *[w[k] for w in waiting]]) for k, x in enumerate((a, b)))
            kept = spanning(ids[i], ids[j], weight(i, j))
            a, b, held = i[kept], j[kept], 0
            waiting.clear()

        def add(i: np.ndarray, j: np.ndarray) -> None:
            nonlocal held
            if sketches is not None:
                alike = weight(i, j) <= 1 - least
                i, j = i[alike], j[alike]
            waiting.append((i, j))
            held += len(i)
            if held > 1 << 20:
                reduce()

        # Groups no larger than a few runs need no levels: members at each distance in Gray order.
        small = np.repeat(sizes <= RUNS[-2], sizes)
        for step in range(1, RUNS[-2]):
            i = np.flatnonzero(small[:-step] & (key[:-step] == key[step:]))
            if not len(i):
                break
            i = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= limit]
            add(i, i + step)
        for start, size in zip(starts[sizes > RUNS[-2]], sizes[sizes > RUNS[-2]], strict=True):
            for i, j in GrayIndex(prints[start : start + size]).pairs(limit):
                add(start + i, start + j)
        reduce()
        return pa.table({"a": ids[a], "b": ids[b]})

    return run


def near_links(
    prints: DataFrame, limit: int = LIMIT, sketches: DataFrame | None = None, least: float = 0.0
) -> DataFrame:
    """(fp, id) with distinct fp -> links (a, b) within the limit that connect what is connected.

    With ``sketches`` (id, sketch) only pairs estimated to be alike by ``least`` are links, and
    the most alike ones are taken.
    """
    dealt = _dealt(prints, limit)
    if sketches is not None:
        dealt = [t.join(sketches, "id") for t in dealt]
    edges = [t.groupBy("_bucket").applyInArrow(_links(limit, least), "a long, b long") for t in dealt]
    return functools.reduce(DataFrame.unionByName, edges)


def near_components(prints: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(fp, id) with distinct fp -> (id, component_id) of all ids with a link.

    The limit is 1 to 15 bits. Ids are longs.
    """
    return components(near_links(prints, limit))


def _word_prints(texts: pa.Array) -> pa.Array:
    values = np.zeros(len(texts), np.uint64)
    for k, text in enumerate(texts):
        hashes = np.unique(word_hashes([text.as_py() or ""])[0])
        votes = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), 1 << 14):
            rows = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
            votes += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
        values[k] = np.packbits(2 * votes > len(hashes)).view(np.uint64)[0]
    give_back()
    return pa.array(values.view(np.int64))


#: Text column -> fingerprint of its distinct words. An edit changes it less than it changes
#: a fingerprint of shingles, so it finds the candidates; shingles decide.
word_fingerprint = F.arrow_udf(_word_prints, T.LongType())


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole sequence if it is shorter."""
    hashes = word_hashes([text])[0]
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(hashes))):
        out = mix64(out * np.uint64(31) + hashes[k : k + n])
    return np.unique(out)


def _shingle_sets(words: int):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            yield pa.array([shingle_set(x.as_py() or "", words).tobytes() for x in part], pa.binary())

    return F.arrow_udf(tidy(run), T.BinaryType())


def sketch(shingles: np.ndarray, seed: int) -> bytes:
    """Per bin of the hash space 16 bits of its smallest hash; all ones where it is empty."""
    x = mix64(shingles ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 2**64 - 1))
    least = np.full(BINS, 2**64 - 1, np.uint64)
    np.minimum.at(least, (x >> np.uint64(57)).astype(np.int64), x & np.uint64(2**57 - 1))
    return np.where(least == np.uint64(2**64 - 1), EMPTY, least % np.uint64(EMPTY)).astype(np.uint16).tobytes()


def estimated(sketches: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of pairs; two empty sketches are equal."""
    out = np.ones(len(i))
    for at in range(0, len(i), 1 << 16):
        a, b = sketches[i[at : at + (1 << 16)]], sketches[j[at : at + (1 << 16)]]
        filled = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
        same = ((a == b) & (a != EMPTY)).sum(axis=1)
        out[at : at + (1 << 16)] = np.where(filled > 0, same / np.maximum(filled, 1), 1.0)
    return out


def _sketches(seed: int):
    def run(sets: pa.Array) -> pa.Array:
        return pa.array([sketch(np.frombuffer(x.as_py(), np.uint64), seed) for x in sets], pa.binary())

    return F.arrow_udf(run, T.BinaryType())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def _likeness(sets: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in sets:
        pairs = zip(left, right, strict=True)
        yield pa.array([likeness(*[np.frombuffer(x.as_py(), np.uint64) for x in p]) for p in pairs], pa.float64())


#: Share of the texts in which common shingles are counted, characters that are counted at least, and
#: how often one is seen there to count as common; members of a common shingle that one task compares
#: with as many others.
SHARE, SAMPLE, COMMON, BLOCK = 0.25, 24_000_000, 3, 2048
#: Characters of that sample per range of hashes, and shingles a task gathers before it sends them.
COUNTED, GATHERED = 4_000_000, 1_000_000
#: Bytes of a parity map, bands of four bins of a sketch (its seed, and the key of an empty one), and
#: the fields of a prefix row as they are stored.
PARITY = 64
BANDS, BAND_SEED, NO_BAND = 16, 3, -1
PREFIX = (("key", "<u8"), ("id", "<i8"), ("part", "<i8"), ("size", "<i4"), ("place", "<i4"), ("side", "<i1"))


class Rarity:
    """Order of shingles: those not seen often in the sample by hash, then the others by count.

    The counts lie in a shared folder by ranges of the hash, mapped on first use.
    """

    def __init__(self, folder: Folder, shards: int, share: float):
        self.folder, self.shards, self.share = folder, shards, share
        self.mapped: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """Counts of sorted shingles."""
        out = np.zeros(len(shingles), np.int64)
        for shard, r in _ranges(shard_of(shingles, self.shards)):
            if shard not in self.mapped:
                try:
                    known = self.folder.get(f"common.{shard}")
                except FileNotFoundError:  # nothing was dealt there
                    known = np.zeros((2, 0), np.int64)
                self.mapped[shard] = known[0].view(np.uint64), known[1]
            known, counts = self.mapped[shard]
            if len(known):
                at = np.minimum(np.searchsorted(known, shingles[r]), len(known) - 1)
                out[r] = np.where(known[at] == shingles[r], counts[at], 0)
        return out

    def prefix(self, shingles: np.ndarray, count: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
        """The rarest shingles, as many as one of them must be shared with any set alike by
        ``similarity`` (in whichever order, if it is the same for all sets), and the parts that
        each one's members are dealt to."""
        n = len(shingles)
        first = np.lexsort((shingles, count))[: n - math.ceil(similarity * n - 1e-6) + 1]
        return shingles[first], np.ceil(count[first] / self.share / BLOCK).astype(np.int64).clip(1)


def _rarity(texts: DataFrame, words: int, chars: int) -> Rarity:
    """Counts the shingles of a sample of (text, h): ``SHARE`` of the texts, so that a shingle which
    the sample does not show has no more members in a larger table."""
    spark = texts.sparkSession
    share = max(SHARE, min(1.0, SAMPLE / max(1, chars)))
    shards = max(1, math.ceil(share * chars / COUNTED))
    folder = Folder(scratch_path(spark, "rarity"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sent((shingle_set(x.as_py(), words) for batch in batches for x in batch.column(0)), shards, GATHERED)

    def kept(key: tuple, group: pa.Table) -> pa.Table:
        blobs = zip(group.column("blob"), group.column("n").to_pylist(), strict=True)
        parts = [unpacked(b.as_py(), n, np.uint64, np.uint32) for b, n in blobs]
        keys, counts = summed(*(np.concatenate([p[k] for p in parts]).astype(t) for k, t in enumerate((np.uint64, np.int64))))
        often = counts >= COMMON
        folder.put(f"common.{key[0].as_py()}", np.stack([keys[often].view(np.int64), counts[often]]))
        give_back()
        return pa.table({"kept": [int(often.sum())]})

    drawn = texts.where(F.pmod(F.xxhash64("h"), F.lit(1_000_000)) < share * 1_000_000).select("text")
    with settings(spark, WHILE_SAVED):
        drawn.mapInArrow(tidy(run), BLOB).groupBy("shard").applyInArrow(kept, "kept long").agg(F.sum("kept")).first()
    return Rarity(folder, shards, share)


def _prefixes(rarity: Rarity, words: int, similarity: float, buckets: int):
    """(text, id, part) -> (bucket, rows): prefix rows of many texts, a bucket's as columns in one array."""

    def packed(rows: list[tuple], held: int) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate([r[k] for r in rows]) for k in range(len(PREFIX))]
        bucket = (columns[0] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, columns = bucket[order], [c[order] for c in columns]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        blobs = [b"".join(c[x:y].tobytes() for c in columns) for x, y in zip(starts, [*starts[1:], held], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(blobs, pa.binary())], names=["bucket", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in (part for batch in batches for part in batches_of(batch)):
            sets = [shingle_set(text.as_py(), words) for text in batch.column(0)]
            distinct, at = np.unique(np.concatenate(sets), return_inverse=True)
            counts = np.split(rarity.of(distinct)[at], np.cumsum([len(x) for x in sets])[:-1])
            for shingles, count, id_, part in zip(sets, counts, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not len(shingles):
                    continue
                keys, parts = rarity.prefix(shingles, count, similarity)
                place = np.arange(1, len(keys) + 1)
                side = np.zeros(len(keys), np.int64)
                if parts.max() > 1:  # a row for each pair of parts that its own part is in
                    own = (mix64(np.array([id_]).view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
                    place, own, parts, keys = (np.repeat(x, parts) for x in (place, own, parts, keys))
                    other = np.arange(len(keys)) - np.repeat(np.flatnonzero(np.r_[True, place[1:] != place[:-1]]), np.bincount(place)[1:])
                    side = np.where(parts == 1, 0, np.sign(own - other))
                    pair = (np.minimum(own, other) << 32 | np.maximum(own, other)).astype(np.uint64)
                    keys = mix64(keys ^ mix64(pair + np.uint64(1)))
                else:
                    keys = mix64(keys ^ mix64(np.uint64([1])))
                n = len(keys)
                values = (keys, np.full(n, id_), np.full(n, part), np.full(n, len(shingles)), place, side)
                rows.append([v.astype(t) for v, (_, t) in zip(values, PREFIX, strict=True)])
                held += n
                if held > 1 << 18:
                    yield from packed(rows, held)
                    rows, held = [], 0
        if held:
            yield from packed(rows, held)

    return run


def _met(similarity: float):
    """Rows of a bucket -> pairs of different parts that may be alike by ``similarity``."""

    def pairs(rows: pa.Table) -> pa.Table:
        blobs = [x.as_py() for x in rows.column("rows")]
        width = sum(np.dtype(t).itemsize for _, t in PREFIX)
        columns, at = [], 0
        for _, t in PREFIX:
            columns.append(np.concatenate([np.frombuffer(x, t, len(x) // width, at * (len(x) // width)) for x in blobs]))
            at += np.dtype(t).itemsize
        del blobs
        order = np.lexsort((columns[3], columns[0]))
        key, id_, part, size, place, side = (c[order] for c in columns)
        del columns
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        mixed = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
        alive = np.flatnonzero(np.repeat(mixed, np.diff(np.r_[starts, len(key)])))
        found, waiting, held = np.zeros((0, 2), np.int64), [], 0
        step = 0
        while len(alive):
            step += 1
            alive = alive[alive + step < len(key)]
            there = alive + step
            # by size within a key: what is too long for a text stays so
            on = (key[alive] == key[there]) & (size[alive] >= similarity * size[there] - 1e-6)
            alive, there = alive[on], there[on]
            rest = np.minimum(size[alive] - place[alive], size[there] - place[there])
            # a pair's first shared shingle leaves enough behind it; other meetings add nothing
            enough = 1 + rest >= similarity / (1 + similarity) * (size[alive].astype(np.int64) + size[there]) - 1e-6
            ok = enough & (part[alive] != part[there]) & ((side[alive] == 0) | (side[alive] != side[there]))
            x, y = id_[alive[ok]], id_[there[ok]]
            waiting.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
            held += len(x)
            if held > 1 << 20:
                found, waiting, held = np.unique(np.concatenate([found, *waiting]), axis=0), [], 0
        found = np.unique(np.concatenate([found, *waiting]), axis=0)
        give_back()
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return pairs


def _marks(words: int):
    """Text -> the parity map of its shingles, and the bands of a sketch of them.

    Takes an array like ``word_fingerprint``, so that one worker computes both.
    """

    def run(texts: pa.Array) -> pa.Array:
        parity, bands = [], []
        for x in texts:
            s = shingle_set(x.as_py(), words)
            bits = np.bincount((mix64(s) >> np.uint64(55)).astype(np.int64), minlength=PARITY * 8) & 1
            parity.append(len(s).to_bytes(8, "little") + np.packbits(bits.astype(bool)).tobytes())
            bands.append(np.frombuffer(sketch(s, BAND_SEED), np.int64)[:BANDS])
        flat = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64))
        ends = np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)
        columns = [pa.array(parity, pa.binary()), pa.ListArray.from_arrays(ends, flat)]
        give_back()
        return pa.StructArray.from_arrays(columns, names=["parity", "bands"])

    return F.arrow_udf(run, "struct<parity:binary,bands:array<long>>")


def _possible(similarity: float):
    """Two parity maps differ in no more places than the sets in members: a bound, no estimate."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint64).reshape(len(x), -1) for x in (left, right))
        apart = np.bitwise_count(a[:, 1:] ^ b[:, 1:]).sum(axis=1)
        return pa.array(apart <= (1 - similarity) / (1 + similarity) * (a[:, 0] + b[:, 0]).astype(float) + 1e-6)

    return F.arrow_udf(run, T.BooleanType())


def _near(pairs: DataFrame, marks: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that the parity maps (id, parity) leave possible, once each."""
    return (
        pairs.join(marks.select(F.col("id").alias("a"), F.col("parity").alias("pa")), "a")
        .join(marks.select(F.col("id").alias("b"), F.col("parity").alias("pb")), "b")
        .where(_possible(similarity)("pa", "pb"))
        .select("a", "b")
        .distinct()
    )


def _band_links(texts: DataFrame) -> DataFrame:
    """(id, mark) -> pairs (a, b): of the texts with the same four bins of a sketch, each with the
    smallest id. Texts alike by 0.8 share one of the bands but for 2 pairs in 10 000."""
    banded = texts.select("id", F.posexplode("mark.bands").alias("band", "key")).where(F.col("key") != NO_BAND)
    hubs = banded.groupBy("band", "key").agg(F.min("id").alias("b"), F.max("id").alias("_last")).where("b <> _last")
    return banded.join(hubs.drop("_last"), ["band", "key"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) with whole sets (id, s) alike by ``similarity`` or more."""
    alike = F.arrow_udf(tidy(_likeness), T.DoubleType())("sa", "sb")
    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
        .select("a", "b", alike.alias("alike"))
        .where(F.col("alike") >= similarity)
        .select("a", "b")
    )


def _texts_of(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Text of each of ``keys`` (id, h, g, ...), once; the join's exchange serves both steps."""
    key = ["id", "h", "g"]
    return rows.join(keys, key).dropDuplicates(key)


def alike_links(rows: DataFrame, keys: DataFrame, chars: int, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, h, g, text) -> all links (a, b) between texts of ``keys`` (id, h, g, part, parity) alike
    by ``similarity`` or more that are not in one part yet. Exact.

    Two such texts share one of their rarest shingles (a prefix of each in one order of all
    shingles). Texts that share one and are of different parts are compared by length,
    place of the shingle, parity maps and at last whole sets. Shingles that a sample shows in
    many texts come last in the order, and their members are dealt to pairs of parts.
    """
    whole = save(_texts_of(rows, keys).select("id", "h", "part", "text", "parity"), "whole_texts")
    rarity = _rarity(whole.select("text", "h"), words, chars)
    buckets = max(1, chars // 2_000_000)
    dealt = whole.select("text", "id", "part").mapInArrow(tidy(_prefixes(rarity, words, similarity, buckets)), "bucket long, rows binary")
    met = save(dealt.groupBy("bucket").applyInArrow(_met(similarity), "a long, b long").distinct(), "met")
    near = save(_near(met, whole, similarity), "near")
    ends = save(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    sets = save(whole.join(ends, "id", "left_semi").select("id", _shingle_sets(words)("text").alias("s")), "near_shingles")
    discard(whole, met, ends)
    found = save(_alike(near, sets, similarity), "alike")
    discard(near, sets)
    return found


def deduplicated(docs: DataFrame, limit: int = 7, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """Documents (doc_id, text, ...) without near-duplicates; columns as before.

    Documents are near-duplicates if their ``words``-word shingles are alike by
    ``similarity`` or more. The Gray-order index on fingerprints of their words, ``limit``
    bits apart or less, joins most of them first: of its candidates the ones most alike by a
    sketch, and one per equal fingerprint, are verified on the whole sets. So is one per text
    and band of a sketch, which joins what is alike but has fingerprints far apart, as short
    texts do: a large group of near copies is one component before its pairs are listed. Then
    every pair that this has left in different components is found by ``alike_links``, which
    misses none. Of each component the rows with its smallest id stay, and of repeated
    rows one; texts with the same id are one document. Rows without id are looked at by
    their text only: one stays if no row with an id has it.
    """
    own = docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashes = F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("g")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).select("id", "text", *hashes)
    marked = word_fingerprint("text").alias("fp"), _marks(words)("text").alias("mark")
    prints = save(rows.select("id", "h", "g", F.length("text").alias("chars"), *marked), "fingerprints")
    classes = prints.groupBy("h", "g", "fp").agg(F.min("id").alias("id"), F.min("chars").alias("chars"), F.first("mark").alias("mark"))
    texts = save(classes.where("id IS NOT NULL"), "distinct_texts")
    leaders_table = leaders = save(texts.groupBy("fp").agg(F.min("id").alias("leader")), "distinct_fingerprints")
    same = texts.join(leaders, "fp").where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    leaders = leaders.select("fp", F.col("leader").alias("id"))
    banded = save(_near(_band_links(texts), texts.select("id", "mark.parity"), similarity), "banded")
    ends = functools.reduce(DataFrame.unionByName, [near_links(leaders, limit), same, banded])
    wanted = save(ends.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    # A text is that of its class's smallest id; its hashes tell it from the id's other texts.
    keys = texts.select("id", "h", "g")
    chosen = _texts_of(rows, keys.join(wanted, "id", "left_semi"))
    sets = save(chosen.select("id", _shingle_sets(words)("text").alias("s")), "shingles")
    # Of all candidates of a text the most alike is verified, by two independent estimates.
    leaders = leaders.join(wanted, "id", "left_semi")
    estimates = [sets.select("id", _sketches(seed)("s").alias("sketch")) for seed in (1, 2)]
    near = [near_links(leaders, limit, e, similarity - MARGIN) for e in estimates]
    pairs = save(functools.reduce(DataFrame.unionByName, [*near, same, banded]).where("a <> b").distinct(), "candidates")
    links = save(_alike(pairs, sets, similarity), "links")
    known = save(components(links), "joined")
    discard(sets, pairs, leaders_table, wanted, banded)
    chars = texts.agg(F.sum("chars")).first()[0] or 0
    marks = texts.select(*keys.columns, "mark.parity")
    parts = marks.join(known, "id", "left").select(*marks.columns, F.coalesce("component_id", "id").alias("part"))
    found = components(links.unionByName(alike_links(rows, parts, chars, words, similarity)))
    dropped = found.where("id <> component_id").select(F.col("id").alias("_id"))
    stay = texts.select(F.col("id").alias("_id")).distinct().join(dropped, "_id", "left_anti")
    named = docs.where("doc_id IS NOT NULL").join(stay, F.col("doc_id").cast("long") == F.col("_id"), "left_semi")
    nameless = prints.groupBy("h", "g").agg(F.min("id").alias("id")).where("id IS NULL").select(F.col("h").alias("_h"), F.col("g").alias("_g"))
    alone = docs.where("doc_id IS NULL").withColumns({"_h": F.xxhash64(text), "_g": F.crc32(text.cast("binary"))})
    alone = alone.join(nameless, ["_h", "_g"], "left_semi").dropDuplicates(["_h", "_g"])
    return named.dropDuplicates(["doc_id"]).select(*own).unionByName(alone.select(*own))


def near_duplicates(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, text) -> doc_id, fingerprint (hex), component_id: the smallest id reachable.

    Copies share a fingerprint and so a component without any comparison. Null and empty
    texts have fingerprint zero and are linked like any other. A null id is returned with
    the component of its fingerprint and never names one (null if all are null). Repeated
    rows are returned as often as they come.
    """
    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = save(picked.select("doc_id", fingerprint("text").alias("fp")), "fingerprints")
    distinct = save(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct_fingerprints")
    found = near_components(distinct.where("id IS NOT NULL"), limit)
    named = distinct.join(found, "id", "left").select("fp", F.coalesce("component_id", "id").alias("component_id"))
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
