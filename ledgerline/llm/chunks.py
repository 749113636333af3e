"""Document fingerprints by content-defined chunking.

A gear hash of the last 32 bytes decides where a chunk may end, so boundaries move with the
text when something is inserted before them. Chunking is normalised: below the normal size
a boundary needs more zero bits than above it, which narrows the spread of chunk sizes. A
fingerprint is the set of chunk digests, each weighted with the chunk's length in bytes.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import discard, documents, save

#: Bytes that the gear hash sees; no chunk is shorter, so a hash never spans two boundaries.
WINDOW = 32
NORMAL, LONGEST = 64, 512
#: Zero bits asked of the hash up to the normal size and above it.
STRICT, LOOSE = np.uint32(0x7F000000), np.uint32(0x0F000000)
#: One random 32-bit number per byte value.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint32)

EDITED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``, the last one at its end; none if it is empty."""
    n = len(data)
    if n <= WINDOW:
        return [n] if n else []
    h = GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < WINDOW:  # h[i] = sum of gear[data[i - k]] << k for k below width, doubled
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    loose = np.flatnonzero((h & LOOSE) == 0) + 1
    strict = loose[(h[loose - 1] & STRICT) == 0]
    # A sentinel past the end keeps the walk free of bounds checks.
    loose_at, strict_at = [*loose.tolist(), n + LONGEST], [*strict.tolist(), n + LONGEST]
    ends, start, i, j = [], 0, 0, 0
    while start < n:
        least = start + WINDOW
        while strict_at[j] < least:
            j += 1
        end = strict_at[j]
        if end > start + NORMAL:
            normal = start + NORMAL
            while loose_at[i] < normal:
                i += 1
            end = min(loose_at[i], start + LONGEST, n)
        start = min(end, n)
        ends.append(start)
    return ends


def fingerprint(text: str) -> dict[int, int]:
    """Chunk digest -> length in bytes; equal chunks count once."""
    data = text.encode("utf-8", "surrogatepass")
    start, found = 0, {}
    for end in boundaries(data):
        part = data[start:end]
        found[xxhash.xxh64_intdigest(part)] = end - start
        start = end
    return found


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's weight whose chunks are in b. Two empty fingerprints are equal: 1."""
    if not a:
        return 0.0 if b else 1.0
    return sum(a[k] for k in a.keys() & b.keys()) / sum(a.values())


def written(found: dict[int, int]) -> str:
    """The fingerprint as text: ``digest:length`` in order of digests."""
    return ",".join([f"{k:016x}:{found[k]}" for k in sorted(found)])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_chars, fingerprint. A null text is empty (fingerprint '')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([written(fingerprint(x)) for x in texts], pa.string()),
                ],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def cut_points(keys: DataFrame, pieces: int) -> list[tuple[int, int]]:
    """First key (``_down``, ``_tie``) of each of about ``pieces`` ranges of the keys, in order."""
    dealt = keys.repartitionByRange(pieces, "_down", "_tie").groupBy(F.spark_partition_id())
    found = dealt.agg(F.min("_down"), F.min_by("_tie", F.struct("_down", "_tie"))).collect()
    return sorted({(r[1], r[2]) for r in found})


def _place_of(cuts: list[tuple[int, int]]):
    """Key columns -> struct of the ``range`` a key is in and whether the range begins with it."""

    def run(down: pa.Array, tie: pa.Array) -> pa.Array:
        keys = list(zip(down.to_pylist(), tie.to_pylist(), strict=True))
        at = [bisect.bisect_right(cuts, k) - 1 for k in keys]
        first = [cuts[r] == k for r, k in zip(at, keys, strict=True)]
        return pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(first, pa.bool_())], names=["range", "first"])

    return F.arrow_udf(run, "range int, first boolean")


def in_ranges(docs: DataFrame, rows_per_range: int = 1000, bytes_per_range: int = 128 << 20) -> DataFrame:
    """Rows by descending ``doc_id`` in ranges, each followed by the first row after it.

    Columns ``_range``, ``_guest``, doc_id, text; sorted within ``_range`` by descending id, the
    guest (the next range's first row; after the last range the first of all) at the end. Rows
    without an id come last of all; equal ids, and rows without one, are in order of a hash of
    their texts, so that they too are cut into ranges. Rows equal in id and text stay in one.

    The keys of all rows are stored, 20 bytes each; Spark's range exchange cuts them. A range has
    about ``bytes_per_range`` of text, less in a small table, so that all cores have some. The
    driver holds one key per range. A text moves once, and one row per range a second time.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).select(
        F.bitwise_not(F.coalesce("doc_id", F.lit(-(2**63)))).alias("_down"), F.xxhash64("text").alias("_tie"), "doc_id", "text"
    )
    keys = save(rows.select("_down", "_tie", F.octet_length("text").alias("size")), "order")
    n, size = keys.agg(F.count("*"), F.sum(F.col("size").cast("long"))).first()
    if not n:
        return rows.select(F.lit(0).alias("_range"), F.lit(False).alias("_guest"), "doc_id", "text")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    cuts = cut_points(keys, max(1, min(n // rows_per_range, 16 * cores), size // bytes_per_range))
    discard(keys)
    rows = rows.withColumn("_at", _place_of(cuts)("_down", "_tie"))
    hosted = rows.select(F.col("_at.range").alias("_range"), F.lit(False).alias("_guest"), "_down", "_tie", "doc_id", "text")
    above = F.pmod(F.col("_range") - 1, F.lit(len(cuts)))
    guests = (
        rows.where("_at.first")
        .groupBy(F.col("_at.range").alias("_range"), "_down", "_tie")
        .agg(F.min_by("doc_id", "text").alias("doc_id"), F.min("text").alias("text"))
        .select(above.alias("_range"), F.lit(True).alias("_guest"), "_down", "_tie", "doc_id", "text")
    )
    dealt = hosted.unionByName(guests).repartition(len(cuts), "_range")
    return dealt.sortWithinPartitions("_range", "_guest", "_down", "_tie", "text").select("_range", "_guest", "doc_id", "text")


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness, ``EDITED``.

    The edited text has its last third replaced by as many leading code points of the next
    document (or all of it, if that is shorter) by descending id; after the last comes the
    first. A single document is its own next one. A null text is empty. Repeated ids are
    separate documents, in order of a hash of their texts. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out, size = [], 0
            columns = (batch.column(k) for k in range(4))
            for where, guest, doc_id, text in zip(*columns, strict=True):
                now = (where.as_py(), guest.as_py(), doc_id.as_py(), text.as_py())
                prints = fingerprint(now[3])
                if held and held[0][0] == now[0]:
                    out.append(_compare(*held, now[3], prints))
                    size += len(out[-1][3]) + len(out[-1][4])
                held = None if now[1] else (now, prints)
                if size > 8 << 20:
                    yield _edited_rows(out)
                    out, size = [], 0
            if out:
                yield _edited_rows(out)

    return in_ranges(docs).mapInArrow(run, EDITED)


def _compare(row: tuple, prints: dict[int, int], next_text: str, next_prints: dict[int, int]) -> tuple:
    _, _, doc_id, text = row
    n = len(text)
    changed = text[: n - n // 3] + next_text[: n // 3]
    after = fingerprint(changed)
    return (
        doc_id,
        n,
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        written(prints),
        written(after),
        containment(prints, after),
        containment(prints, next_prints),
    )


def _edited_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=EDITED.names)


def query(spark, sf_dir: str) -> DataFrame:
    return edited(documents(spark, sf_dir, "doc_id", "text"))
