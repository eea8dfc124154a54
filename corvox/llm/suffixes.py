"""Substring dedup by suffix sorting: byte strings that occur more than once are removed wherever they are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import bucket_bounds, covered, each, opened, packed, to_blocks, total_bytes, unpacked, unpacked_all
from .common import BYTE_VALUES, chunks, fixed_hash, mix, partitions, prefix_hash, span_hash, written
from .grouping import suffix_array

#: Starts from which strings choose among their anchors: longer makes fewer anchors and longer contexts.
SPREAD = 65
#: Bytes of text whose anchors one bucket has, on average; contexts that are suffix-sorted at once, in whole keys.
BUCKET_BYTES, BATCH_CONTEXTS = 1 << 23, 1 << 11
#: A key that has more contexts is sliced.
KEY_CONTEXTS = 1 << 11
ANCHOR = ("u8", "u8", "u4", "u1", "u1")


def anchors(raw: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Every string of `length` bytes within a document chooses as its anchor the gram of length - SPREAD + 1 bytes in
    it that has the least hash, the first of several. So equal strings choose equal grams at the same place in them.
    Strings that follow each other share most anchors; of each run: the gram's hash, a hash of all bytes that the
    run's strings cover and of the anchor's place in them, the anchor's first byte, and the bytes covered before and
    after the gram."""
    gram, out = length - SPREAD + 1, []
    for a, b in chunks(at, 1 << 20):
        own, to = raw[at[a] : at[b]], at[a : b + 1] - at[a]
        n = len(own) - length + 1
        if n <= 0:
            continue
        prefix = prefix_hash(BYTE_VALUES[own])
        h = mix(fixed_hash(prefix, gram))
        # least of each window of SPREAD: of the end of one block of SPREAD and the beginning of the next
        ranked = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        rows = np.concatenate([ranked, np.full(-len(h) % SPREAD, 2**64 - 1, dtype=np.uint64)]).reshape(-1, SPREAD)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        chosen = (np.minimum(back[:n], ahead[SPREAD - 1 : SPREAD - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.ones(n, dtype=bool)
        ends = to[1:-1]
        for k in ends[(ends > 0) & (ends < len(own))].tolist():
            inside[max(0, k - length + 1) : k] = False
        start = np.flatnonzero(inside)
        if not len(start):
            continue
        chosen = chosen[start]
        new = np.flatnonzero(np.r_[True, (np.diff(chosen) != 0) | (np.diff(start) != 1)])
        first, last, place = start[new], start[np.r_[new[1:], len(start)] - 1], chosen[new]
        variant = mix(span_hash(prefix, first, last + length) ^ (place - first).astype(np.uint64))
        # least hashes are small ones: mixed again, they spread over all buckets
        out.append((mix(~h[place]), variant, (place + at[a]).astype(np.uint32), (place - first).astype(np.uint8), (last + length - place - gram).astype(np.uint8)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.empty(0, dtype=k) for k in ANCHOR)


def _common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of text, how many symbols its suffix shares with the one that shares most: a neighbour in order."""
    n, shared = len(text), np.zeros(len(order) - 1, dtype=np.int64)
    alive, k = np.arange(len(order) - 1), 0
    while len(alive):
        x, y = order[alive] + k, order[alive + 1] + k
        inside = (x < n) & (y < n)
        alive = alive[inside]
        alive = alive[(text[x[inside]] == text[y[inside]]) & (text[x[inside]] > 1)]  # separators agree with nothing
        k += 1
        shared[alive] = k
    out = np.zeros(n, dtype=np.int64)
    out[order] = np.maximum(np.r_[0, shared], np.r_[shared, 0])
    return out


def _sorted_batch(contexts: list[tuple[int, int, bytes, bytes]], need: int) -> tuple[np.ndarray, np.ndarray]:
    """contexts: (key, weight, bytes before the gram, bytes after it), those of a key together. Which of them, and at
    which places in them, a string begins that occurs more than once.

    Contexts of a key are aligned at their gram, so what all of them agree in tells no string from another and is
    left out: the text holds, for each context, its bytes in the columns in which its key's contexts differ, and one
    symbol for the gram. A string is repeated if its context is, or if the suffix that begins with its first symbol
    shares all of its symbols with a neighbour in suffix order."""
    wide, n = need - 1, len(contexts)
    left, right = (np.array([len(c[k]) for c in contexts]) for k in (2, 3))
    cells = np.zeros((n, 2 * wide + 2), dtype=np.int32)  # bytes before, gram, bytes after, end; 0: none
    column = np.arange(wide)
    cells[:, :wide][column >= (wide - left)[:, None]] = np.frombuffer(b"".join(c[2] for c in contexts), dtype=np.uint8).astype(np.int32) + 2
    cells[:, wide + 1 : -1][column < right[:, None]] = np.frombuffer(b"".join(c[3] for c in contexts), dtype=np.uint8).astype(np.int32) + 2
    key = np.array([c[0] for c in contexts])
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    of = np.cumsum(np.r_[0, key[1:] != key[:-1]])
    differ = np.logical_or.reduceat(cells != cells[first][of], first, axis=0)[of]
    cells[:, wide], cells[:, -1] = 258 + of, 1
    kept = differ & (cells > 0)
    kept[:, wide] = kept[:, -1] = True
    text = np.r_[cells[kept], 0]
    before = np.zeros((n, 2 * wide + 3), dtype=np.int64)
    np.cumsum(kept, axis=1, out=before[:, 1:])
    begins = np.r_[0, np.cumsum(before[:, -1])[:-1]]
    shared = _common_prefixes(text, suffix_array(text))
    # a string that begins in column s ends in column s + need - 1
    start = np.arange(need)
    symbols = before[:, need : 2 * need] - before[:, :need]
    often = (shared[begins[:, None] + before[:, :need]] >= symbols) | (np.array([c[1] for c in contexts]) > 1)[:, None]
    often &= (start >= (wide - left)[:, None]) & (start <= right[:, None])
    context, at = np.nonzero(often)
    return context, at - (wide - left)[context]


def _slices(contexts: list[tuple[int, int, bytes, bytes]], members: list[int], need: int, low: int, high: int) -> Iterator[list[tuple[int, bytes, bytes, list[int]]]]:
    """A key's contexts in smaller groups, for strings that begin low to high - 1 places before the gram. They all hold
    the columns from `low` places before it to `need - high` after it, so only contexts that agree there can have
    equal ones; of each its part that matters is kept, equal parts as one (weight, before, after, members). Groups
    that are still large are cut in halves; a single place leaves one part."""
    groups: dict[tuple[bytes, bytes], dict[tuple[bytes, bytes], list]] = {}
    for k in members:
        _, weight, left, right = contexts[k]
        if max(low, need - 1 - len(right)) > min(high - 1, len(left)):
            continue
        core = left[len(left) - low :], right[: need - high]
        part = left[max(0, len(left) - high + 1) :], right[: need - 1 - low]
        found = groups.setdefault(core, {}).setdefault(part, [0, []])
        found[0] += weight
        found[1].append(k)
    for parts in groups.values():
        if sum(w for w, _ in parts.values()) > 1:
            if len(parts) <= KEY_CONTEXTS or high - low == 1:
                yield [(w, *part, ks) for part, (w, ks) in parts.items()]
            else:
                middle, own = (low + high) // 2, [k for _, ks in parts.values() for k in ks]
                yield from _slices(contexts, own, need, low, middle)
                yield from _slices(contexts, own, need, middle, high)


def repeated_starts(contexts: list[tuple[int, int, bytes, bytes]], need: int) -> list[list[tuple[int, int]]]:
    """Of each context, the ranges of places (first, last) at which a string begins that occurs more than once: in
    contexts of the same key, each as often as its weight says. Contexts are sorted in batches of whole keys; a key
    with many contexts is sliced first."""
    by_key: dict[int, list[int]] = {}
    for k, c in enumerate(contexts):
        by_key.setdefault(c[0], []).append(k)
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    held: list[tuple[int, int, bytes, bytes]] = []
    owners: list[list[int]] = []

    def settle() -> None:
        of, place = _sorted_batch(held, need)  # sorted by both
        new = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(place, prepend=-2) != 1))
        last = place[np.r_[new[1:], len(of)] - 1] if len(of) else place
        for k, x, y in zip(of[new].tolist(), place[new].tolist(), last.tolist(), strict=True):
            for owner in owners[k]:
                shift = len(contexts[owner][2]) - len(held[k][2])
                out[owner].append((x + shift, y + shift))
        held.clear()
        owners.clear()

    number, size = 0, 0
    for members in by_key.values():
        if len(members) <= KEY_CONTEXTS:
            groups = iter([[(*contexts[k][1:], [k]) for k in members]])
        else:
            groups = _slices(contexts, members, need, 0, need)
        for group in groups:
            for weight, left, right, ks in group:
                held.append((number, weight, left, right))
                owners.append(ks)
            size += len(group)
            number += 1
            if size >= BATCH_CONTEXTS:
                settle()
                size = 0
    if held:
        settle()
    return out


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = False) -> DataFrame:
    """For each row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes that stay).
    A byte of a text's UTF-8 goes if it is in a string of `length` bytes that also begins anywhere else, in the same
    document or another; strings are judged on the input and never go beyond a document.

    Equal strings have equal anchors, so candidates meet in buckets by their anchor's hash. A block sends each context
    once, however often it holds it. Contexts of anchors that occur more than once are gathered, equal ones (by two
    64-bit hashes, the anchor's and the context's) as one with a weight, and suffix-sorted; the order shows which
    strings are equal. Null texts are empty; shorter texts stay whole; repeated rows remove each other's bytes; an
    empty table gives no rows; other columns are ignored. with_bytes adds the bytes that stay (kept)."""
    if length < 2 * SPREAD:
        raise ValueError(f"length must be {2 * SPREAD} or more")
    gram = length - SPREAD + 1
    blocks = to_blocks(docs, id_col, text_col)
    buckets = max(partitions(docs.sparkSession), total_bytes(blocks) // BUCKET_BYTES)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            _, raw, at = opened(row)
            found = anchors(raw, at, length)
            order = np.lexsort((found[1], found[0]))
            found = [x[order] for x in found]
            # what a block holds of one context goes as one entry; its strings occur more than once here already
            new = np.ones(len(order), dtype=bool)
            new[1:] = (found[0][1:] != found[0][:-1]) | (found[1][1:] != found[1][:-1])
            n = np.diff(np.r_[np.flatnonzero(new), len(new)])
            if len(n) < len(new):
                _, _, place, left, right = (x[np.repeat(n, n) > 1] for x in found)
                own = packed(place - left, left.astype(np.uint32) + right + np.uint32(gram))
                yield pa.RecordBatch.from_arrays([pa.array([-1 - row["block"] % buckets], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([own], pa.binary())], ["bucket", "block", "data"])
            found = [*(x[new] for x in found), (n > 1).astype(np.uint8)]
            bounds = bucket_bounds(found[0], buckets)
            some = np.flatnonzero(np.diff(bounds))
            data = [packed(*(x[a:b] for x in found)) for a, b in zip(bounds[some].tolist(), bounds[some + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([row["block"]] * len(some), pa.int64()), pa.array(data, pa.binary())], ["bucket", "block", "data"])

    def classify(table: pa.Table) -> pa.Table:
        """Anchors that occur more than once, numbered by key and context; for each number one that stands for it. A
        negative bucket holds what blocks have found by themselves."""
        owner, bucket = table.column("block").to_numpy(), table.column("bucket")[0].as_py()
        if bucket < 0:
            return pa.table([table.column("bucket"), table.column("block"), table.column("data"), pa.nulls(len(table), pa.binary())], ["bucket", "block", "all", "first"])
        (h, variant, place, left, right, again), of = unpacked_all(table.column("data").to_pylist(), *ANCHOR, "u1")
        order = np.lexsort((place, of, variant, h))
        h, variant, place, left, right, again, of = (x[order] for x in (h, variant, place, left, right, again, of))
        new_key = np.r_[True, h[1:] != h[:-1]] if len(h) else np.empty(0, dtype=bool)
        key = np.cumsum(new_key) - 1
        often = np.bincount(key, weights=1 + again)[key] > 1
        h, variant, key, place, left, right, again, of = (x[often] for x in (h, variant, key, place, left, right, again, of))
        new = np.r_[True, (variant[1:] != variant[:-1]) | (h[1:] != h[:-1])] if len(h) else np.empty(0, dtype=bool)
        number = np.cumsum(new) - 1
        weight = np.bincount(number, weights=1 + again)[number].astype(np.int64) if len(number) else number
        out, by_row = [], np.argsort(of, kind="stable")
        begins = np.flatnonzero(np.diff(of[by_row], prepend=-1))
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(of)], strict=False):
            own = by_row[a:b]
            first = own[new[own]]
            out.append((bucket, int(owner[of[own[0]]]), packed(number[own].astype("u4"), place[own], left[own]), packed(number[first].astype("u4"), key[first].astype("u4"), weight[first].astype("u4"), place[first], left[first], right[first])))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "block", "all", "first"])

    def gather(key, block: pa.Table, wanted: pa.Table) -> pa.Table:
        buckets_, data = [], []
        for row in block.to_pylist():
            raw = opened(row)[1].tobytes()
            for bucket, first in zip(wanted.column("bucket").to_pylist(), wanted.column("first").to_pylist(), strict=True):
                number, of_key, weight, place, left, right = unpacked(first, "u4", "u4", "u4", "u4", "u1", "u1")
                bytes_ = b"".join(raw[p - a : p] + raw[p + gram : p + gram + b] for p, a, b in zip(place.tolist(), left.tolist(), right.tolist(), strict=True))
                head = packed(number, of_key, weight, left, right)
                buckets_.append(bucket)
                data.append(len(head).to_bytes(4, "little") + head + zstandard.ZstdCompressor(level=1).compress(bytes_))
        return pa.table([pa.array(buckets_, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

    def sort(key, contexts: pa.Table, members: pa.Table) -> pa.Table:
        numbers, every = [], []
        for x in contexts.column("data").to_pylist():
            n = 4 + int.from_bytes(x[:4], "little")
            number, of_key, weight, left, right = unpacked(x[4:n], "u4", "u4", "u4", "u1", "u1")
            text, at = zstandard.ZstdDecompressor().decompress(x[n:]), 0
            numbers.append(number)
            for k, w, a, b in zip(of_key.tolist(), weight.tolist(), left.tolist(), right.tolist(), strict=True):
                every.append((k, w, text[at : at + a], text[at + a : at + a + b]))
                at += a + b
        found = repeated_starts(every, SPREAD)
        number = np.concatenate(numbers).tolist() if numbers else []
        ranges = sorted((n, x, y) for n, r in zip(number, found, strict=True) for x, y in r)
        number, x, y = (np.array(c, dtype=np.int64) for c in (zip(*ranges, strict=True) if ranges else ([], [], [])))
        owner, all_ = members.column("block").to_pylist(), members.column("all").to_pylist()
        out = []
        for block, data in zip(owner, all_, strict=True):
            of, place, left = unpacked(data, "u4", "u4", "u1")
            low, high = np.searchsorted(number, of), np.searchsorted(number, of, side="right")
            n = high - low
            k = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            begin = np.repeat(place.astype(np.int64) - left, n)
            out.append((block, packed((begin + x[k]).astype("u4"), (y[k] - x[k] + length).astype("u4"))))
        return pa.table([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["block", "data"])

    def cut(key, block: pa.Table, found: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], []]
        for row in block.to_pylist():
            ids, raw, at = opened(row)
            (start, size), _ = unpacked_all(found.column("data").to_pylist(), "u4", "u4")
            gone = covered(start.astype(np.int64), size.astype(np.int64), len(raw))
            for k, doc_id in enumerate(ids):
                own, text = gone[at[k] : at[k + 1]], raw[at[k] : at[k + 1]]
                kept = text[~own].tobytes()
                row_out = (doc_id, len(text), int(own.sum()), int((np.diff(np.r_[0, own.astype(np.int8)]) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept)
                for column, value in zip(out, row_out, strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        arrays = [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)]
        return pa.table(arrays[: 5 + with_bytes], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_bytes])

    sent = blocks.mapInArrow(send, "bucket int, block long, data binary")
    classes = written(sent.groupBy("bucket").applyInArrow(classify, "bucket int, block long, all binary, first binary"), "classes", codec="none")
    alone, classes = classes.where("bucket < 0").select("block", F.col("all").alias("data")), classes.where("bucket >= 0")
    contexts = blocks.groupBy("block").cogroup(classes.select("block", "bucket", "first").groupBy("block")).applyInArrow(gather, "bucket int, data binary")
    # a bucket is little data and much work: as many tasks as buckets, which small sizes don't merge
    contexts, members = contexts.repartition(buckets, "bucket"), classes.select("bucket", "block", "all").repartition(buckets, "bucket")
    spans = contexts.groupBy("bucket").cogroup(members.groupBy("bucket")).applyInArrow(sort, "block long, data binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return blocks.groupBy("block").cogroup(spans.union(alone).groupBy("block")).applyInArrow(cut, schema)
