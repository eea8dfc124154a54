"""Order-preserving packing of tokenised documents into windows, by dynamic programming over cuts."""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import id_and_text, lean, utf8

END = 1
ENDOFTEXT, ENDOFTEXT_ID = "<|endoftext|>", 50256
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoder(vocabulary: str, pattern: str) -> Callable[[str], np.ndarray]:
    """The vocabulary's ids of a text. The file has the same vocabulary as ranks; a text with the string of the
    special token gets that token's id, as the tokenizer file has it."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={ENDOFTEXT: ENDOFTEXT_ID})

    def ids(text: str) -> np.ndarray:
        return plain.encode_to_numpy(text, allowed_special={ENDOFTEXT} if ENDOFTEXT in text else set(), disallowed_special=())

    ids.ends = np.zeros(max(ENDOFTEXT_ID, max(ranks.values())) + 1, dtype=bool)
    for token, k in ranks.items():
        ids.ends[k] = token.rstrip(b" \"')")[-1:] in (b".", b"!", b"?", b"\n")
    return ids


def cuts(at: list[int], cost: list[float], window: int) -> list[int]:
    """Of the increasing candidates at (from 0), those that end windows in the cheapest way: padding and the cut's
    cost. best[i] = cost[i] + window - at[i] + min(best[j] + at[j] for at[i] - at[j] <= window): the minimum slides,
    and a queue whose values increase holds what may still become it. The last window costs nothing: more tokens
    follow, or it is cut so that it needs no padding. Else its padding would be spread over the others."""
    best, came, queue = [0.0] * len(at), [0] * len(at), deque([(0.0, 0, 0)])
    pop, popleft, push = queue.pop, queue.popleft, queue.append
    for i in range(1, len(at)):
        here = at[i]
        low = here - window
        while queue[0][1] < low:
            popleft()
        least, _, j = queue[0]
        came[i] = j
        value = least + window - here + cost[i]
        best[i] = value
        value += here
        while queue and queue[-1][0] >= value:
            pop()
        push((value, here, i))
    i = len(at) - 1
    if i:
        low = bisect_left(at, at[i] - window)
        came[i] = min(range(low, i), key=best.__getitem__)
    out = []
    while i:
        out.append(at[i])
        i = came[i]
    return out[::-1]


class _Stream:
    """A stream of tokens with their documents; it settles windows as soon as what follows can hardly change them."""

    def __init__(self, window: int, grid: int, sentence: float, hard: float, ends: np.ndarray) -> None:
        self.window, self.grid, self.sentence, self.hard, self.ends = window, grid, sentence, hard, ends
        self.ids, self.docs, self.size, self.sequence = [], [], 0, TaskContext.get().partitionId() << 33

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, len(ids), len(ids)))
        self.ids.append(ids)
        self.size += len(ids)

    def candidates(self, ids: np.ndarray) -> tuple[list[int], list[float]]:
        cost = np.full(len(ids) + 1, np.inf)
        cost[1:][self.ends[ids]] = self.sentence
        cost[np.cumsum([0] + [n for _, _, n, _ in self.docs])] = 0
        marks = np.flatnonzero(np.isfinite(cost))
        gaps = np.diff(marks)
        for k in np.flatnonzero(gaps > self.grid):
            cost[marks[k] + self.grid : marks[k + 1] : self.grid] = self.hard
        at = np.flatnonzero(np.isfinite(cost))
        return at.tolist(), cost[at].tolist()

    def settle(self, last: bool, with_ids: bool) -> list[tuple]:
        if not self.size:
            return []
        ids = np.concatenate(self.ids)
        ends = cuts(*self.candidates(ids), self.window)
        if not last:
            ends = [x for x in ends if x <= self.size - 4 * self.window]
        else:  # a power of two needs no padding: so ends the last window
            tail = ends.pop()
            at = ends[-1] if ends else 0
            while at < tail:
                at += 1 << (tail - at).bit_length() - 1
                ends.append(at)
        out, done, k, used = [], 0, 0, 0
        for end in ends:
            begin = done
            while done < end:
                doc_id, start, left, total = self.docs[k]
                take = min(left - used, end - done)
                piece = ids[done : done + take]
                row = (doc_id, start + used, take, zlib.crc32(piece.tobytes()), total, self.sequence, done - begin)
                out.append((*row, piece) if with_ids else row)
                done, used = done + take, used + take
                if used == left:
                    k, used = k + 1, 0
            self.sequence += 1
        if k < len(self.docs):
            doc_id, start, left, total = self.docs[k]
            self.docs = [(doc_id, start + used, left - used, total), *self.docs[k + 1 :]]
        else:
            self.docs = []
        self.ids, self.size = [ids[done:]], self.size - done
        return out


def pack(
    docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, window: int = 2048, sentence_cost: float = 1.0,
    hard_cost: float = 8.0, grid: int = 16, settle_at: int = 1 << 19, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Each partition of docs, in its order, as one stream of tokens (each document's ids, then id 1) cut into windows
    of at most `window` tokens: a row for each piece of a document in a window. Cuts lie at the ends of documents
    (free), of sentences (sentence_cost) or, in longer sentences, at every grid-th token (hard_cost), whichever make
    padding plus costs least. Only the partition's last window is shorter than it need be; it is cut into powers of
    two, which need no padding. A task holds settle_at tokens and its longest document; nothing is shuffled, and a
    task that is run again gives the same rows.

    Null and empty texts are one token (id 1). Repeated rows are packed as often as they occur; an empty table gives
    no rows; other columns are ignored. with_ids adds the pieces' token ids (array<int>).
    vocabulary, pattern: the tokenizer's ranks and its splitting pattern; the public 50k byte-level one by default."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = public_tokenizers.PATTERN
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern)
        stream = _Stream(window, grid, sentence_cost, hard_cost, encode.ends)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [[]] * (len(names) + with_ids)
            arrays = [pa.array(c, pa.int64()) for c in columns[: len(names)]]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in columns[-1]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            raw, at = utf8(batch.column(1))
            raw = raw.tobytes()
            for k, doc_id in enumerate(keys):
                found = encode(raw[at[k] : at[k + 1]].decode())
                stream.add(doc_id, np.append(found, np.uint32(END)).astype("<u4"))
                if stream.size >= settle_at:
                    yield rows(stream.settle(False, with_ids))
        yield rows(stream.settle(True, with_ids))

    return id_and_text(docs, id_col, text_col).mapInArrow(lean(run), PIECES + ", ids array<int>" * with_ids)
