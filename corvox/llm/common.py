"""What the operators share: written intermediate tables, UTF-8 columns as numpy arrays, rolling hashes."""

from __future__ import annotations

import atexit
import ctypes
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd base of the polynomial hashes; 3 mod 8, so that differences of its powers keep few factors of two.
BASE = 0x9E3779B97F4A7C1B
#: A random 64-bit value for each byte value.
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: all but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_made: list[tuple[SparkSession, str]] = []
_paths: dict[int, tuple[DataFrame, str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, one is made here if all of
    Spark runs on this machine; on a cluster that is an error, as executors could not read it."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The rows of df, written once to the shared folder and read again: later stages neither repeat its work nor
    depend on what lost executors held. The files are removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/corvox-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", codec).parquet(path)
    _made.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = (out, path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() returned and that nothing will read again."""
    for df in tables:
        _, path = _paths.pop(id(df))
        _delete(df.sparkSession, path)
        _made.remove((df.sparkSession, path))


@atexit.register
def _remove() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended already
            return


def in_small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Lets texts go to Python and back in batches of a few MB, which are outside of the heap in the JVM and in Python at
    once. A session that has its own setting keeps it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which gives memory that it has freed back to the system when it ends: Python workers are used again."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that the operators read, so that other columns can't clash with theirs."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets at which its values begin and end; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(at: np.ndarray, most: int):
    """Ranges of documents of about `most` bytes; a longer document is a range of its own."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
KEPT_POWERS = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n. Those of usual lengths are kept."""
    if n <= len(_powers[0]):
        return _powers[0][:n], _powers[1][:n]
    size, out = max(n, min(2 * n, KEPT_POWERS)), []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    if size <= KEPT_POWERS:
        _powers[:] = out
    return out[0][:n], out[1][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.multiply(values, powers(len(values))[0], out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of values start..end-1 of what prefix_hash() was taken of."""
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def fixed_hash(prefix: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hashes of all runs of `length` values."""
    n = max(0, len(prefix) - length)
    return (prefix[length : length + n] - prefix[:n]) * powers(len(prefix))[1][:n]


def words(raw: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes within documents, and each document's first word (one entry more)."""
    inside = is_word[raw]
    before, after = np.zeros(len(raw), dtype=bool), np.zeros(len(raw), dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[at[:-1][at[:-1] < len(raw)]] = False
    after[at[1:][at[1:] > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, at)


def crc_mod(column: str, modulus: int):
    """crc32 of the id's decimal text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
