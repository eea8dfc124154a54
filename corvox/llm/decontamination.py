"""Benchmark decontamination: windows of training words looked up in a broadcast hash set of benchmark n-grams."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BYTE_VALUES, LOWER, chunks, fixed_hash, id_and_text, in_small_batches, lean, mix, prefix_hash, span_hash, utf8, words, written

#: Bytes of words: digits, letters and all beyond ASCII, which in UTF-8 are the bytes from 0x80.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
FILTER_BITS = 22
SCANNED = "n_words long, hits binary, items array<string>"


def _hashed(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts, ends and first words as words(), and the prefix hash over word hashes."""
    raw = LOWER[raw]
    start, end, first = words(raw, at, IS_WORD)
    return raw, start, end, first, prefix_hash(mix(span_hash(prefix_hash(BYTE_VALUES[raw]), start, end)))


class NgramSet:
    """The windows of some benchmark items: sorted hashes, the places they come from, and the items' words."""

    def __init__(self, items: list[tuple[str, str]], n: int) -> None:
        self.names, self.words = [], []
        found: dict[int, list[tuple[int, int, int]]] = {}
        for name, text in items:
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            raw, start, end, _, prefix = _hashed(raw, np.array([0, len(raw)]))
            if len(start):
                length, data, k = min(n, len(start)), raw.tobytes(), len(self.names)
                self.names.append(name)
                self.words.append([data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
                for i, h in enumerate(mix(fixed_hash(prefix, length)).tolist()):
                    found.setdefault(h ^ length, []).append((k, i, length))
        self.lengths = sorted({x[2] for places in found.values() for x in places})
        self.hashes = np.array(sorted(found), dtype=np.uint64)
        self.places = [found[h] for h in self.hashes.tolist()]
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def scan(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """Of each document: words, verified occurrences as ranges of words, names of the items they come from."""
        raw, start, end, first, prefix = _hashed(raw, at)
        n = len(at) - 1
        hits, items = [[] for _ in range(n)], [set() for _ in range(n)]
        for length in self.lengths if len(self.hashes) else ():
            h = mix(fixed_hash(prefix, length)) ^ np.uint64(length)
            near = np.flatnonzero(self.filter[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            slot = np.minimum(np.searchsorted(self.hashes, h[near]), len(self.hashes) - 1)
            same = self.hashes[slot] == h[near]
            near, slot = near[same], slot[same]
            doc = np.searchsorted(first, near, side="right") - 1
            within = near + length <= first[doc + 1]
            for i, k, d in zip(near[within].tolist(), slot[within].tolist(), doc[within].tolist(), strict=True):
                own = [raw[a:b].tobytes() for a, b in zip(start[i : i + length].tolist(), end[i : i + length].tolist(), strict=True)]
                names = {self.names[x] for x, j, m in self.places[k] if m == length and self.words[x][j : j + m] == own}
                if names:
                    items[d] |= names
                    hits[d].append((i - int(first[d]), i - int(first[d]) + length))
        return np.diff(first), hits, items


def benchmark_blocks(benchmark: DataFrame, n: int, most_bytes: int, id_col: str, text_col: str) -> Iterator[NgramSet]:
    """N-gram sets of items that together have at most most_bytes of text (a longer item is a set of its own), so
    that what is broadcast at once is bounded however many items there are."""
    items = benchmark.select(benchmark[id_col].cast("string").alias("id"), benchmark[text_col].cast("string").alias("text")).where("id is not null and text is not null")
    block, size = [], 0
    for row in items.orderBy("id", "text").toLocalIterator():
        if block and size + len(row.text) > most_bytes:
            yield NgramSet(block, n)
            block, size = [], 0
        block.append((row.id, row.text))
        size += len(row.text)
    if block:
        yield NgramSet(block, n)


def _scanned(rows: DataFrame, benchmark: DataFrame, n: int, most_bytes: int, item_col: str, item_text_col: str, finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """rows (text and any other columns) with n_words, hits and items: what all blocks of the benchmark find in the
    texts as they are. One block after another is built, sent, looked for in all rows and dropped again. finish makes
    rows as they were of the last block's batches, by the same worker."""
    blocks = benchmark_blocks(benchmark, n, most_bytes, item_col, item_text_col)
    ahead, out, names = next(blocks, None) or NgramSet([], n), rows, rows.columns
    schema = T.StructType(rows.schema.fields + T.StructType.fromDDL(SCANNED).fields)
    while ahead is not None:
        sent, ahead = rows.sparkSession.sparkContext.broadcast(ahead), next(blocks, None)

        last = finish if ahead is None else None

        def run(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw, at = utf8(batch.column("text"))
                for a, b in chunks(at, 1 << 18):
                    part = batch.slice(a, b - a)
                    n_words, hits, items = sent.value.scan(raw[at[a] : at[b]], at[a : b + 1] - at[a])
                    hits = [np.array(x, dtype="<i4").tobytes() for x in hits]
                    if "hits" in batch.schema.names:
                        hits = [x + y for x, y in zip(part.column("hits").to_pylist(), hits, strict=True)]
                        items = [x | {*y} for x, y in zip(items, part.column("items").to_pylist(), strict=True)]
                    columns = [*(part.column(c) for c in names), pa.array(n_words, pa.int64()), pa.array(hits, pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                    made = pa.RecordBatch.from_arrays(columns, [*names, "n_words", "hits", "items"])
                    yield last(made) if last else made

        out = out.mapInArrow(lean(run), rows.schema if last else schema)
        if ahead is not None:
            out = written(out, "scanned")
            sent.destroy()
    return out


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, most_bytes: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, text, n_words, hits (ranges of words within occurring windows, pairs of
    little-endian 32-bit numbers: first word, word after the last) and items (ids of the items they come from).

    Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. A window is n consecutive words
    of an item, or all words of a shorter one; a hit is found by its Rabin-Karp hash in the broadcast set and then
    compared word for word. Documents aren't shuffled. If the benchmark has more than most_bytes of text, block after
    block of it goes over all documents. Null texts have no words, null or wordless items no windows; items of the
    same id count as one item; repeated documents each get their row; an empty table on either side gives no hits."""
    return _scanned(id_and_text(docs, id_col, text_col), benchmark, n, most_bytes, item_col, item_text_col)


def _covered(hits: bytes) -> list[list[int]]:
    """Maximal ranges of hit words."""
    out: list[list[int]] = []
    for a, b in sorted(np.frombuffer(hits, dtype="<i4").reshape(-1, 2).tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def contamination(scanned: DataFrame) -> DataFrame:
    """Of what scan() returns, the counts by document: doc_id, n_words, n_hit (words inside an occurrence), n_items,
    items_sha256 (of their ids, sorted as strings and joined by commas), contaminated (n_hit > 0). Repeated rows each get
    their row; overlapping hits count a word once; no rows: no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit = [sum(b - a for a, b in _covered(x)) for x in batch.column("hits").to_pylist()]
            items = batch.column("items").to_pylist()
            columns = [
                batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    columns = scanned.select("doc_id", "n_words", "hits", "items")
    return columns.mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, most_bytes: int = 8_000_000, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs with the hit ranges cut out of its texts: all of a range from its first word to its last. Ranges are those
    that scan() finds in the texts as they are, by all of the benchmark, so they don't depend on its blocks. Rows
    without hits, null and empty texts among them, and other columns stay as they are; repeated rows and ids are cut
    each for itself; an empty table on either side changes nothing."""
    in_small_batches(docs.sparkSession)
    names = docs.columns
    row = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*(F.col(f"`{x}`") for x in names if x != text_col), F.lit(0).alias("_")).alias("kept"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, hits in enumerate(batch.column("hits").to_pylist()):
                if hits:
                    own = texts[k].encode()
                    start, end, _ = words(np.frombuffer(own, dtype=np.uint8), np.array([0, len(own)]), IS_WORD)
                    left, done = [], 0
                    for x, y in _covered(hits):
                        left.append(own[done : start[x]])
                        done = int(end[y - 1])
                    texts[k] = b"".join([*left, own[done:]]).decode()
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("kept")], names=["text", "kept"])

    cut_rows = _scanned(row, benchmark, n, most_bytes, item_col, item_text_col).select("text", "hits", "kept").mapInArrow(lean(cut), row.schema)
    return cut_rows.select(*(F.col("text").cast(docs.schema[x].dataType).alias(x) if x == text_col else F.col(f"kept.`{x}`").alias(x) for x in names))
