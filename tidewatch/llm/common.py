"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidewatch.session import scratch_path

TAKE_BYTES = 8 << 20  # text handled at a time inside a task


# Freed blocks of 4 MB and more go back to the system at once, so a worker that later stages use again
# doesn't keep the largest stage's memory.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files find the package (a cluster gets it by --py-files)
    and give freed memory back."""
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    for k, v in WORKER_MEMORY.items():
        env.setdefault(k, v)
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (home, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


FREE_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, kind: str, codec: str = "zstd") -> DataFrame:
    """``df`` written as Parquet into the shared scratch folder and read back: lineage ends there.

    The write's shuffle files, which nothing reads again, are freed at its end and not at some later garbage collection."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    before = spark.conf.get(FREE_SHUFFLE, None)
    spark.conf.set(FREE_SHUFFLE, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLE, before) if before is not None else spark.conf.unset(FREE_SHUFFLE)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterable[pa.RecordBatch], col: str, most: int = TAKE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about ``most`` bytes of ``col``, at least one row each."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(col)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // most
        cut = np.flatnonzero(np.diff(part)) + 1
        for s, e in zip([0, *cut], [*cut, b.num_rows]):
            yield b.slice(int(s), int(e - s))


def give_back() -> None:
    """Return freed memory of this worker to the system, also where it lies between blocks in use (glibc; else nothing).

    For the end of a task: the next one, maybe of another stage, takes other blocks."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts_of(batch: pa.RecordBatch, col: str = "text") -> pa.Array:
    """The text column with null read as empty."""
    return pc.fill_null(batch.column(col).cast(pa.string()), "")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of non-null texts: (code of each word, distinct words, offset of each text).

    Empty pieces at the ends of a text are taken out."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat, off = lists.flatten(), np.asarray(lists.offsets.to_numpy()).astype(np.int64)
    off = off - off[0]
    some = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not some.all():
        kept = np.concatenate([[0], np.cumsum(some)])
        off, flat = kept[off], flat.filter(pa.array(some))
    d = flat.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary, off


def ragged(starts: np.ndarray, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of ``values[starts[c]:starts[c + 1]]`` over the codes, and the offset of each code."""
    n = np.diff(starts)[codes]
    off = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    if not len(codes):
        return values[:0], off
    at = np.repeat(starts[codes] - off[:-1], n) + np.arange(off[-1])
    return values[at], off


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit numbers (xor-shift and odd multipliers)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
