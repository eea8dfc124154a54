"""Substring dedup by Rabin-Karp hashes of every window of words, counted in Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import bucket_bounds, covered, each, opened, packed, to_blocks, total_bytes, unpacked, unpacked_all
from .common import BYTE_VALUES, NOT_SPACE, chunks, fixed_hash, mix, partitions, prefix_hash, span_hash, words

#: Bytes of text whose windows one bucket has, on average.
BUCKET_BYTES = 1 << 24


def _windows(raw: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Of a block: starts and ends of words, each document's first word; hash, further hash bits, document and first
    word of each window."""
    starts, ends, counts, hashes, more, firsts, before = [], [], [], [], [], [], 0
    for a, b in chunks(at, 1 << 20):
        start, end, first = words(raw[at[a] : at[b]], at[a : b + 1] - at[a], NOT_SPACE)
        w = mix(span_hash(prefix_hash(BYTE_VALUES[raw[at[a] : at[b]]]), start, end))
        h = mix(fixed_hash(prefix_hash(w), n))
        doc = np.searchsorted(first, np.arange(len(h)), side="right") - 1
        inside = np.flatnonzero(np.arange(len(h)) + n <= first[doc + 1])
        starts.append(start + at[a])
        ends.append(end + at[a])
        counts.append(np.diff(first))
        hashes.append(h[inside])
        more.append((mix(fixed_hash(prefix_hash(mix(~w)), n))[inside] >> np.uint64(48)).astype(np.uint16))
        firsts.append(inside + before)
        before += len(start)
    join = lambda x: np.concatenate(x) if x else np.empty(0, dtype=np.int64)
    first, g = np.r_[0, np.cumsum(join(counts))].astype(np.int64), join(firsts).astype(np.int64)
    return join(starts), join(ends), first, join(hashes).astype(np.uint64), join(more).astype(np.uint16), np.searchsorted(first, g, side="right") - 1, g


def _distinct(h: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of windows by hash, then by place, and which of that order are the first of their hash."""
    order = np.lexsort((more, h))  # stable: of equal ones the first comes first
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (more[order][1:] != more[order][:-1])
    return order, new


def _order(doc_id: int | None) -> int:
    return -(1 << 63) if doc_id is None else doc_id


def remove_repeats(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """For each row: doc_id, n_words, n_removed, n_spans (maximal runs of removed words), kept_sha256 (of the kept
    words, joined by one space). A word goes if it is in a window of n words whose words also begin earlier: in a
    document of smaller id, or earlier in the same one. Windows are judged on the input.

    Words are runs of anything but ASCII white space. Of windows that are equal within a block only the first is
    sent on, with its document; buckets by hash then find the first of all, and what else has its hash is removed.
    Hashes have 80 bits and are not compared word by word afterwards. Null ids come before all others; among rows of
    the same id one (by its place in the input) comes first; null, empty and shorter texts have no windows; an empty
    table gives no rows; other columns are ignored. with_text adds the kept words themselves (kept_text)."""
    blocks = to_blocks(docs, id_col, text_col)
    buckets = max(partitions(docs.sparkSession), total_bytes(blocks) // BUCKET_BYTES)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            ids, raw, at = opened(row)
            _, _, _, h, more, doc, _ = _windows(raw, at, n)
            order, new = _distinct(h, more)
            h, more, doc = h[order[new]], more[order[new]], doc[order[new]]
            bounds = bucket_bounds(h, buckets)
            some, docs_, data = np.flatnonzero(np.diff(bounds)), [], []
            ordered = np.array([_order(x) for x in ids], dtype=np.int64)
            for a, b in zip(bounds[some].tolist(), bounds[some + 1].tolist(), strict=True):
                # only the documents that these windows are from: never more than there are windows
                own, of = np.unique(doc[a:b], return_inverse=True)
                docs_.append(packed(np.diff(ordered[own], prepend=0)))
                data.append(packed(h[a:b], more[a:b], of.astype(np.uint32)))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([row["block"]] * len(some), pa.int64()), pa.array(docs_, pa.binary()), pa.array(data, pa.binary())], ["bucket", "block", "docs", "data"])

    def later(table: pa.Table) -> pa.Table:
        """For each block, the places among its windows of this bucket of those that aren't the first of all."""
        owner, bucket = table.column("block").to_numpy(), table.column("bucket")[0].as_py()
        (h, more, doc), of = unpacked_all(table.column("data").to_pylist(), "u8", "u2", "u4")
        ends = np.searchsorted(of, np.arange(len(owner) + 1))
        ids = np.empty(len(h), dtype=np.int64)
        for k, x in enumerate(table.column("docs").to_pylist()):
            ids[ends[k] : ends[k + 1]] = np.cumsum(unpacked(x, "i8")[0])[doc[ends[k] : ends[k + 1]]]
        order = np.lexsort((owner[of], ids, more, h))
        again = np.zeros(len(h), dtype=bool)
        again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (more[order[1:]] == more[order[:-1]])
        place, of = (np.arange(len(h)) - ends[of])[again], of[again]  # still by row
        first = np.flatnonzero(np.diff(of, prepend=-1))
        found = [(int(owner[of[a]]), bucket, packed(place[a:b].astype(np.uint32))) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(of)], strict=False)]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({"block": pa.array(columns[0], pa.int64()), "bucket": pa.array(columns[1], pa.int32()), "data": pa.array(columns[2], pa.binary())})

    def cut(key, block: pa.Table, found: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], []]
        for row in block.to_pylist():
            ids, raw, at = opened(row)
            start, end, first, h, more, _, g = _windows(raw, at, n)
            order, new = _distinct(h, more)
            sent, bounds = g[order[new]], bucket_bounds(h[order[new]], buckets)
            elsewhere = [sent[unpacked(x, "u4")[0] + bounds[k]] for k, x in zip(found.column("bucket").to_pylist(), found.column("data").to_pylist(), strict=True)]
            hit = np.r_[g[order[~new]], *elsewhere].astype(np.int64)
            gone, data = covered(hit, n, len(start)), raw.tobytes()
            for k, doc_id in enumerate(ids):
                a, b = int(first[k]), int(first[k + 1])
                own = gone[a:b]
                if own.any():
                    left = np.flatnonzero(~own) + a
                    kept = b" ".join([data[x:y] for x, y in zip(start[left].tolist(), end[left].tolist(), strict=True)])
                else:
                    kept = b" ".join(data[at[k] : at[k + 1]].split())
                row_out = (doc_id, b - a, int(own.sum()), int((np.diff(np.r_[0, own.astype(np.int8)]) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None)
                for column, value in zip(out, row_out, strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        arrays = [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)]
        return pa.table(arrays[: 5 + with_text], ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", "kept_text"][: 5 + with_text])

    sent = blocks.mapInArrow(send, "bucket int, block long, docs binary, data binary")
    repeated = sent.groupBy("bucket").applyInArrow(later, "block long, bucket int, data binary")
    schema = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    return blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(cut, schema)
