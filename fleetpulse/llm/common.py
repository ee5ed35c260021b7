"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.session import scratch_dir

#: Rows and bytes of one Arrow batch, so that a batch of very long texts still fits a worker.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20
#: Bytes of text that operators with several numbers for each byte work on at a time.
SLICE_BYTES = 1 << 20
#: Stretches of values that are counted at once when a percentile is looked for.
STRETCHES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read back: a cut lineage that outlives executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def percentiles(values: DataFrame, shares: list[float]) -> list[float] | None:
    """Exact percentiles of a column of numbers as ``F.percentile`` has them; None without rows.

    Counts of STRETCHES equal stretches say in which one a rank falls, and only that one is divided again: no
    task holds all values, and each round brings STRETCHES rows to the driver at most.
    """
    values = values.toDF("v").where("v IS NOT NULL")
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    places = [share * (n - 1) for share in shares]
    found: dict[int, float] = {}
    left = [(low, high, 0, {r for p in places for r in (math.floor(p), math.ceil(p))})]
    while left:
        low, high, before, ranks = left.pop()
        if low == high:
            found |= dict.fromkeys(ranks, low)
            continue
        stretch = F.least(F.floor((F.col("v") - low) / (high - low) * STRETCHES), F.lit(STRETCHES - 1))
        counts = values.where(F.col("v").between(low, high)).groupBy(stretch.alias("at")).agg(F.count("v").alias("n"), F.min("v"), F.max("v"))
        for _, size, first, last in sorted(counts.collect()):
            if inside := {r for r in ranks if before <= r < before + size}:
                left.append((first, last, before, inside))
            before += size
    pairs = [(p, math.floor(p), math.ceil(p)) for p in places]
    return [found[a] if found[a] == found[b] else (b - p) * found[a] + (p - a) * found[b] for p, a, b in pairs]


def release() -> None:
    """Give a worker's free memory back at the end of a task: workers live on, and the next operator's find none left."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only some C libraries have it
        pass


def small(batch: pa.RecordBatch, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """A batch in slices, so that neither side holds a second copy of all of it."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def sliced(rows: pa.StructArray, name: str, size: int) -> Iterator[pa.StructArray]:
    """The rows in order, in slices with at most ``size`` bytes of a text column; a longer text has a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(rows.field(name)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(total, total[at] + size, side="right")) - 1)
        yield rows.slice(at, end - at)
        at = end


def carry(df: DataFrame, new: str, work: Callable[[Iterator[pa.StructArray]], Iterator[list[pa.Array]]], keep: list[str] | None = None, by: str | None = None) -> DataFrame:
    """Columns ``__row`` (the input row as a struct) and those of ``new`` (DDL), whatever the input's columns are called.

    ``work`` gets an iterator of struct arrays and yields for each the list of its new columns. ``keep`` names
    the fields that ``__row`` brings back (all if None), so that texts need not return from the workers. With ``by``,
    a text column, ``work`` gets slices of SLICE_BYTES of its texts, so that its arrays are a few times as large.
    """
    added = T.StructType.fromDDL(new)
    row = df.schema if keep is None else T.StructType([df.schema[k] for k in keep])
    schema = T.StructType([T.StructField("__row", row), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.StructArray] = []

        def rows() -> Iterator[pa.StructArray]:
            for batch in batches:
                for whole in (sliced(batch.column(0), by, SLICE_BYTES) if by else [batch.column(0)]) if batch.num_rows else []:
                    held.append(whole if keep is None else pa.StructArray.from_arrays([whole.field(k) for k in keep], names=keep))
                    yield whole

        for arrays in work(rows()):
            yield pa.RecordBatch.from_arrays([held.pop(0), *arrays], names=["__row", *added.names])
        release()

    bounded_batches(df.sparkSession)
    return df.select(F.struct("*").alias("__row")).mapInArrow(run, schema)


def binaries(rows: pa.StructArray, name: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    column = rows.field(rows.type.get_field_index(name))
    if rows.null_count:
        column = rows.flatten()[rows.type.get_field_index(name)]
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def portions(texts: list[bytes], size: int) -> Iterator[list[bytes]]:
    """The texts in order, in lists of at most ``size`` bytes; a longer text has a list of its own."""
    held, total = [], 0
    for t in texts:
        if held and total + len(t) > size:
            yield held
            held, total = [], 0
        held.append(t)
        total += len(t)
    if held:
        yield held


def flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes one after another, and where each text starts (one more than texts)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts), np.uint8), starts


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each stretch; empty stretches give 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def gram_bins(data: np.ndarray, starts: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash bins of the byte n-grams (n up to 4) that start at each byte, and whether one lies within its text."""
    padded = np.concatenate([data, np.zeros(n, np.uint8)]).astype(np.uint32)
    code = np.zeros(len(data), np.uint32)
    for k in range(n):
        code = (code << np.uint32(8)) | padded[k:k + len(data)]
    whole = np.ones(len(data) + 1, bool)
    for k in range(1, n):
        whole[np.maximum(starts[1:] - k, starts[:-1])] = False
    return (code * np.uint32(2_654_435_761)) >> np.uint32(32 - bits), whole[:-1]


#: ASCII letters lower-cased, other ASCII that is no digit turned to blanks: what is left are words.
WORD_TABLE = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Words of letters, digits and all that is not ASCII, ASCII letters lower-cased."""
    return text.translate(WORD_TABLE).split()
