"""Helpers shared by the operators: input tables, stored intermediates, hashing, splits."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.layers import scratch_path

#: What separates words unless a contract says otherwise: blank, tab, line feed .. carriage return.
SPACES = b" \t\n\x0b\x0c\r"
#: Byte table: A-Z to a-z, every separator to a blank.
FOLD = bytes(32 if b in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


#: While a table is stored: its shuffle files go when it is written, and the batches that
#: Python is given are small enough for several tasks of a machine.
WHILE_SAVED = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, WHILE_SAVED):
        df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*saved: DataFrame) -> None:
    """Removes tables of ``save`` that nothing will read any more, also no plan made of them."""
    for df in saved:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def tidy(run: Callable) -> Callable:
    """A function over batches that, at the end of a task, gives freed memory back to the machine.

    Workers are used again by the tasks of later stages, and would keep it.
    """

    @functools.wraps(run)
    def wrapped(*args):
        try:
            yield from run(*args)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def crc_of_id(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as 0."""
    id_ = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")), F.lit(0))


def batches_of(batch: pa.RecordBatch, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``max_bytes`` each, so that working arrays stay bounded.

    A single longer row is a slice of its own: texts are never cut.
    """
    rows = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit hashes (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Multiplier of the rolling word hash, its inverse modulo 2 ** 64, and a random number per byte.
_M = np.uint64(0x9E3779B97F4A7C15)
_M_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, all at once: the hash of a span is a difference of prefix
    sums of byte * M ** place, divided by M ** start."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_M, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers(_M_INVERSE, len(data))[starts]
    return mix64(hashes + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the folded words of all texts, and the text each belongs to."""
    raw = [x.encode("utf-8", "surrogatepass") for x in texts]
    data = np.frombuffer((b" ".join(raw) + b" ").translate(FOLD), np.uint8)
    if not raw:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.r_[False, data != 32]
    edges = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    text_starts = np.cumsum([0, *[len(x) + 1 for x in raw[:-1]]])
    return span_hashes(data, starts, ends), np.searchsorted(text_starts, starts, "right") - 1
