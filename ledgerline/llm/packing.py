"""Best-fit packing of tokenized documents into fixed-length sequences by bin completion.

Documents become pieces: whole sequences of ``capacity`` tokens plus one remainder. Only
remainders need packing, and for packing a remainder is nothing but its length, so the
problem is a histogram with at most ``capacity`` counters, whatever the size of the input.
``complete_bins`` solves it on the driver; the assignment of pieces to bins is a distributed
ranking within each length and a join on (length, group of ranks).
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import batches_of, documents, save, tidy
from ledgerline.llm.vocab import TEXTS, ByteBpe, Chunks, between_words, column_of

END = 2
PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class Encoder:
    """Ids of texts by a tokenizer file, those of ordinary text by the same vocabulary as ranks.

    Texts are cut at single blanks between two visible characters: the vocabulary's split
    pattern always starts a token there. Distinct chunks are tokenized once a batch; those
    that hold a special token's string go through the tokenizer file itself, as all do
    without ranks.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = ByteBpe(ranks_path) if ranks_path else None

    def slowly(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin (and the last one's end)."""
        chunks = Chunks(column_of(texts), between_words)
        if self.ranks:
            odd = np.zeros(len(chunks.distinct), bool)
            for s in self.special:
                odd |= pc.match_substring(chunks.distinct, s).to_numpy(zero_copy_only=False)
            return chunks.gather(*self.ranks.of_chunks(chunks.distinct, self.slowly, odd))
        ids = [self.slowly(x.decode()) for x in chunks.distinct.to_pylist()]
        lengths = np.array([len(x) for x in ids], np.int64)
        return chunks.gather(np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths)

    def text(self, text: str) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit numbers."""
        return self.texts(pa.array([text], pa.string()))[0].astype("<u4").tobytes()


def tokenized(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = 1024, with_ids: bool = True
) -> DataFrame:
    """(doc_id, text) -> one row per piece, ``PIECES``; the ids themselves only if asked for.

    A null text is empty, an empty one is the single end token. Repeated rows give repeated
    pieces. Of a longer document the first piece is the remainder, all others are full.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path, ranks_path)
        for batch in batches:
            for part in batches_of(batch, TEXTS):
                ids, at = encoder.texts(part.column(1))
                yield cut(part.column(0), np.insert(ids, at[1:], END), at + np.arange(len(at)))

    def cut(doc_ids: pa.Array, ids: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        n = np.diff(at)
        first = (n - 1) % capacity + 1
        count = (n - 1) // capacity + 1
        text = np.repeat(np.arange(len(n)), count)
        piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        length = np.where(piece == 0, first[text], capacity)
        start = np.where(piece == 0, 0, first[text] + (piece - 1) * capacity)
        data = memoryview(ids.astype("<u4").tobytes())
        spans = [data[4 * a : 4 * b] for a, b in zip((at[text] + start).tolist(), (at[text] + start + length).tolist(), strict=True)]
        columns = [
            doc_ids.take(pa.array(text)),
            pa.array(piece.astype(np.int32)),
            pa.array(start),
            pa.array(length),
            pa.array([zlib.crc32(x) for x in spans], pa.int64()),
            pa.array([bytes(x) for x in spans] if with_ids else [None] * len(spans), pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=PIECES.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(pieces), PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: (lengths of a bin, how many such bins)."""
    left = Counter(counts)
    rooms: dict[tuple[int, ...], int] = {}
    by_room: dict[int, list[tuple[int, ...]]] = {}
    for size in sorted(left, reverse=True):
        todo = left[size]
        for room in sorted(r for r in by_room if r >= size):
            for filling in by_room.pop(room):
                have = rooms.pop(filling)
                each = room // size
                full = min(have, todo // each)
                todo -= full * each
                rest = min(have - full, 1 if todo else 0)
                for n, put in ((full, each), (rest, min(todo, each))):
                    if n:
                        _put(rooms, by_room, filling + (size,) * put, n, capacity)
                todo -= min(todo, each) if rest else 0
                if have - full - rest:
                    _put(rooms, by_room, filling, have - full - rest, capacity)
        each = capacity // size
        if todo // each:
            _put(rooms, by_room, (size,) * each, todo // each, capacity)
        if todo % each:
            _put(rooms, by_room, (size,) * (todo % each), 1, capacity)
    return list(rooms.items())


def _put(rooms: dict, by_room: dict, filling: tuple[int, ...], n: int, capacity: int) -> None:
    if filling not in rooms:
        by_room.setdefault(capacity - sum(filling), []).append(filling)
    rooms[filling] = rooms.get(filling, 0) + n


def fillings(sizes: list[int], left: Counter, room: int, most_waste: int, tries: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from ``sizes`` (decreasing), least waste first.

    A filling that wastes more than ``most_waste`` is pruned. One filling dominates another
    if it has the same first item and leaves less room; a filling that could still take a
    remaining item is dominated by the one that does. ``tries`` bounds the nodes visited; if
    they end without a filling, the fullest one is returned, unless it wastes too much too.
    """
    found: dict[tuple[int, ...], int] = {}
    visited = 0

    def walk(start: int, room: int, chosen: tuple[int, ...]) -> bool:
        """True to stop: nothing beats a filling without waste."""
        nonlocal visited
        visited += 1
        fits = bisect.bisect_left(sizes, -room, lo=start, key=lambda s: -s)
        for i in range(fits, len(sizes)):
            size = sizes[i]
            for copies in range(min(left[size], room // size), 0, -1):
                if walk(i + 1, room - copies * size, chosen + (size,) * copies) or visited > tries:
                    return True
        if room <= most_waste and not any(left[s] > chosen.count(s) for s in reversed(sizes) if s <= room):
            found[chosen] = room
            return room == 0
        return False

    walk(0, room, ())
    if not found and visited > tries:
        chosen = fullest(sizes, left, room)
        if (lost := room - sum(chosen)) <= most_waste:
            found[chosen] = lost
    return sorted(found, key=lambda f: (found[f], len(f)))


def fullest(sizes: list[int], left: Counter, room: int) -> tuple[int, ...]:
    """A filling of ``room`` with the least waste, of large items where it can be: exact, by the
    sums that can be reached with the first sizes (decreasing), as bits."""
    reached, all_ = [1], (1 << room + 1) - 1
    for size in sizes:
        now = reached[-1]
        for _ in range(min(left[size], room // size)):
            if (more := (now | now << size) & all_) == now:
                break
            now = more
        reached.append(now)
    total = reached[-1].bit_length() - 1
    chosen: list[int] = []
    for size, before in zip(reversed(sizes), reversed(reached[:-1]), strict=True):
        while not before >> total & 1:
            chosen.append(size)
            total -= size
    return tuple(reversed(chosen))


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = 4000, tries: int = 4000) -> list[tuple[tuple[int, ...], int]]:
    """Packs a histogram of lengths (1..capacity) into as few bins as it can.

    Bin completion: take the largest length left, enumerate the undominated fillings beside
    it, follow the least wasteful one first. A filling is used for as many bins at once as
    the counters allow. The four least wasteful fillings of a node are followed; where the
    enumeration ends without one, the fullest. A branch is pruned when the waste it has accumulated exceeds what an
    improvement on the best packing known may waste. The first best packing known is
    best-fit decreasing; later ones are the search's own, each completed by best fit when
    the search stops early. ``nodes`` and ``tries`` bound the search, not the input.
    """
    counts = {s: n for s, n in counts.items() if n > 0}
    total = sum(s * n for s, n in counts.items())
    least = -(-total // capacity)
    best = best_fit(counts, capacity)
    used = sum(n for _, n in best)
    visited = 0

    def search(left: Counter, done: list, bins: int, waste: int) -> bool:
        """True when the lower bound is met or the nodes are used up."""
        nonlocal best, used, visited
        depth: list[tuple[Counter, list, int, int]] = [(left, done, bins, waste)]
        while depth:
            left, done, bins, waste = depth.pop()
            visited += 1
            allowed = (used - 1) * capacity - total
            if waste > allowed:
                continue
            if not left:
                best, used = done, bins
                if used <= least:
                    return True
                continue
            if visited > nodes or not visited % 256:
                rest = best_fit(left, capacity)
                if (n := bins + sum(m for _, m in rest)) < used:
                    best, used = done + rest, n
                if visited > nodes or used <= least:
                    return True
                allowed = (used - 1) * capacity - total
            top = max(left)
            others = Counter(left)
            others[top] -= 1
            sizes = sorted((s for s, n in others.items() if n), reverse=True)
            options = fillings(sizes, others, capacity - top, allowed - waste, tries)[:4]
            branches = []
            for filling in options:
                need = Counter((top, *filling))
                times = min(left[s] // n for s, n in need.items())
                lost = capacity - top - sum(filling)
                if lost:
                    times = min(times, max(1, (allowed - waste) // lost))
                after = Counter({s: m for s, n in left.items() if (m := n - times * need.get(s, 0))})
                branches.append((after, [*done, ((top, *filling), times)], bins + times, waste + times * lost))
            depth += reversed(branches)
        return False

    if used > least:
        search(Counter(counts), [], 0, 0)
    return best


def packed(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1..capacity.

    Full pieces are sequences of their own. Of the others only the counts per length reach
    the driver (at most ``capacity`` rows). Ranks within a length come from counts per
    (length, slice of the rows): no length, however common, meets in one task. Repeated rows
    are ranked as separate rows. An empty input gives an empty result.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    # A stored table: the same rows have the same slice each time it is read.
    key = F.struct(*[F.col(c) for c in columns])
    rows = pieces.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(1 << 20)))
    short = rows.where(F.col("length") < capacity)
    per_slice = short.groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in per_slice.collect()}
    slices = {s: max(1, n // 2000) for s, n in histogram.items()}
    plan = complete_bins(histogram, capacity)

    # For each length: runs of ranks and where their bin and place begin.
    places: list[tuple[int, int, int, int, int]] = []
    next_rank: Counter = Counter()
    first_bin = 0
    for filling, times in plan:
        at = 0
        for size in filling:
            # rank r in [from, from + times) goes to bin first_bin + (r - from)
            places.append((size, next_rank[size], next_rank[size] + times, first_bin, at))
            next_rank[size] += times
            at += size
        first_bin += times
    runs: dict[int, list] = {}
    for size, lo, hi, bin_, at in places:
        runs.setdefault(size, []).append((lo, hi, bin_, at))
    run_type = "array<struct<lo:long,hi:long,bin:long,at:long>>"
    lengths = spark.createDataFrame(
        [(s, slices[s], r) for s, r in runs.items()], f"_length long, _slices long, _runs {run_type}"
    )
    ranked = _ranked(short.join(F.broadcast(lengths), F.col("length") == F.col("_length")))
    run = F.element_at(F.filter("_runs", lambda r: (r["lo"] <= F.col("_rank")) & (F.col("_rank") < r["hi"])), 1)
    placed = ranked.withColumn("_run", run).select(
        *columns,
        (F.col("_run")["bin"] + F.col("_rank") - F.col("_run")["lo"]).alias("sequence_id"),
        F.col("_run")["at"].alias("offset"),
    )
    full = rows.where(F.col("length") == capacity).select(
        *columns, (F.monotonically_increasing_id() + F.lit(first_bin)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return placed.unionByName(full)


def _ranked(short: DataFrame) -> DataFrame:
    """Adds ``_rank`` from 0 within each length, by (length, slice) groups of about 2000 rows."""
    short = short.withColumn("_part", F.pmod("_slice", "_slices"))
    ordered = Window.partitionBy("length", "_part").orderBy("_slice", "doc_id", "piece")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        short.groupBy("length", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inner = short.withColumn("_inner", F.row_number().over(ordered) - 1)
    return inner.join(parts, ["length", "_part"]).withColumn("_rank", F.col("_before") + F.col("_inner"))


def pack_documents(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = 1024) -> DataFrame:
    """Documents to placed pieces. The pieces are stored first, as two passes read them."""
    return packed(save(tokenized(docs, tokenizer_path, ranks_path, capacity), "pieces"), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path
    pieces = tokenized(documents(spark, sf_dir, "doc_id", "text"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), with_ids=False)
    return packed(save(pieces.drop("ids"), "pieces"))
