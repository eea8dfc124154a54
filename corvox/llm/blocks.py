"""A corpus as blocks of a few MB: rows of a written table that later stages find again by number. Arrays of numbers
go through shuffles as compressed columns of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, utf8, written

BLOCK_BYTES = 1 << 22
SCHEMA = "block long, ids array<long>, sizes array<int>, n_bytes long, data binary"


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, each with its bytes ordered by significance, compressed."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, out, at = len(raw) // sum(widths), [], 0
    for kind, width in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).reshape(-1).view(kind))
        at += n * width
    return out


def unpacked_all(datas: list[bytes], *kinds: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Several packed tables as one, and which of them each row comes from."""
    every = [unpacked(x, *kinds) for x in datas] or [[np.empty(0, dtype=k) for k in kinds]]
    return [np.concatenate(c) for c in zip(*every, strict=True)], np.repeat(np.arange(len(every)), [len(x[0]) for x in every])


def to_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents of each partition in blocks of about block_bytes, a longer one in a block of its own; within a
    block by id, null first. Null texts count as empty. Each row keeps its own place, repeated ids too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def row() -> pa.RecordBatch:
            ordered = sorted(held, key=lambda x: (x[0] is not None, x[0] or 0))
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(x[1] for x in ordered))
            columns = [[block], [[x[0] for x in ordered]], [[len(x[1]) for x in ordered]], [size], [data]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "ids", "sizes", "n_bytes", "data"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, at = utf8(batch.column(1))
            raw, at = raw.tobytes(), at.tolist()
            for k, doc_id in enumerate(ids):
                n = at[k + 1] - at[k]
                if held and size + n > block_bytes:
                    yield row()
                    block, held, size = block + 1, [], 0
                held.append((doc_id, raw[at[k] : at[k + 1]]))
                size += n
        if held:
            yield row()

    return written(id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA), "blocks", codec="none")


def opened(row: dict) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Of a block: its documents' ids, all bytes, and where each document begins and ends."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), dtype=np.uint8)
    return row["ids"], raw, np.cumsum([0, *row["sizes"]])


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def total_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).head()[0]


def bucket_bounds(h: np.ndarray, buckets: int) -> np.ndarray:
    """Of sorted 64-bit hashes, where each bucket's range begins; one more at the end."""
    limits = (np.arange(1, buckets, dtype=np.float64) / buckets * 2.0**64).astype(np.uint64)
    return np.r_[0, np.searchsorted(h, limits), len(h)]


def covered(start: np.ndarray, length, n: int) -> np.ndarray:
    """Which of n places lie in a run that begins at one of start and has the given length."""
    steps = np.zeros(n + 1, dtype=np.int32)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:n]) > 0
