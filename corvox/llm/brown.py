"""Brown's class-based n-grams: words in classes by exchange clustering; class transitions and word emissions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, bucket_bounds, each, packed, unpacked, unpacked_all
from .common import BYTE_VALUES, LOWER, NOT_SPACE, chunks, id_and_text, mix, partitions, prefix_hash, span_hash, utf8, words, written

#: Stands for the end of a text among word hashes.
END = np.uint64(0x2545F4914F6CDD1D)
CODED = "block long, ids array<long>, held array<boolean>, sizes array<int>, n_bytes long, tokens binary, vocabulary binary"
BUCKET_BYTES = 1 << 23
#: Words that are clustered one by one, at most: their table of pairs has that many rows and columns.
MOST_FREQUENT = 4096


def _held_out(doc_id: int | None, folds: int, fold: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def code(docs: DataFrame, folds: int, fold: int, id_col: str, text_col: str) -> DataFrame:
    """Documents in blocks of about 4 MB of text: each block's distinct words as sorted 64-bit hashes, and for each
    token its place among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, at = utf8(batch.column(1))
            for first, last in chunks(at, BLOCK_BYTES):
                hashes, sizes = [], []
                for a, b in chunks(at[first : last + 1], 1 << 20):
                    a, b = a + first, b + first
                    own = LOWER[raw[at[a] : at[b]]]
                    start, end, word = words(own, at[a : b + 1] - at[a], NOT_SPACE)
                    h = mix(span_hash(prefix_hash(BYTE_VALUES[own]), start, end))
                    hashes.append(np.insert(h, word[1:], END))
                    sizes.append(np.diff(word) + 1)
                vocabulary, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
                own = ids[first:last]
                columns = [[block], [own], [[_held_out(x, folds, fold) for x in own]], [np.concatenate(sizes)], [int(at[last] - at[first])], [packed(tokens.astype(np.uint32))], [packed(vocabulary)]]
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in CODED.split(", ")])
                block += 1

    return written(id_and_text(docs, id_col, text_col).mapInArrow(run, CODED), "coded", codec="none")


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, vocabulary, which tokens are for training, and which begin a document."""
    tokens, vocabulary = unpacked(row["tokens"], "u4")[0], unpacked(row["vocabulary"], "u8")[0]
    sizes = np.array(row["sizes"])
    begins = np.zeros(len(tokens), dtype=bool)
    begins[np.cumsum(sizes) - sizes] = True
    return tokens, vocabulary, ~np.repeat(np.array(row["held"], dtype=bool), sizes), begins


def exchange(pairs: np.ndarray, classes: int, rounds: int = 6) -> np.ndarray:
    """A class for each word (0 the most frequent) from the counts of word pairs: each word in turn goes to the class
    that raises the likelihood of the class bigrams most, until none moves."""
    k = len(pairs)
    own = np.arange(k) % classes
    member = np.zeros((k, classes))
    member[np.arange(k), own] = 1
    table = member.T @ pairs @ member
    xlogx = lambda x: x * np.log(np.maximum(x, 1))

    for _ in range(rounds):
        moved = 0
        for w in range(k):
            after, before, twice = pairs[w] @ member, pairs[:, w] @ member, pairs[w, w]
            old = own[w]
            after[old] -= twice
            before[old] -= twice
            table[old, :] -= after
            table[:, old] -= before
            table[old, old] -= twice
            left, right = table.sum(1), table.sum(0)
            gain = (xlogx(table + after) - xlogx(table)).sum(1) + (xlogx(table.T + before) - xlogx(table.T)).sum(1)
            same = np.diagonal(table)
            gain -= xlogx(same + after) - xlogx(same) + xlogx(same + before) - xlogx(same)
            gain += xlogx(same + after + before + twice) - xlogx(same)
            gain -= xlogx(left + after.sum() + twice) - xlogx(left) + xlogx(right + before.sum() + twice) - xlogx(right)
            new = int(gain.argmax()) if gain.max() > gain[old] + 1e-9 else old
            moved += new != old
            member[w, old], member[w, new], own[w] = 0, 1, new
            table[new, :] += after
            table[:, new] += before
            table[new, new] += twice
        if not moved:
            break
    return own


def sizes(vocabulary: int) -> tuple[int, int]:
    """Numbers of classes and of words that are clustered one by one, by the number of distinct words: classes as its
    cube root, words as four times its square root. MOST_FREQUENT words and 240 classes fit the driver's table; the
    rest of the vocabulary is assigned on Spark, however large it is."""
    return min(240, max(48, round(vocabulary ** (1 / 3)))), min(MOST_FREQUENT, max(768, round(4 * vocabulary**0.5)))


def _sum_pairs(table: pa.Table) -> pa.Table:
    (code_, n), _ = unpacked_all(table.column("data").to_pylist(), "u4", "u4")
    code_, at = np.unique(code_, return_inverse=True)
    return pa.table({"code": pa.array(code_, pa.int64()), "n": pa.array(np.bincount(at, weights=n).astype(np.int64))})


def score(
    docs: DataFrame, folds: int = 5, fold: int = 1, classes: int | None = None, frequent: int | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """For each row: doc_id, held_out (crc32 of the id's text modulo folds is `fold`), n_tokens, n_known (tokens that
    training texts have), train_tokens, base_score (add-half unigram log10 probability), score (log10 probability by
    the class model), perplexity (10 ** (-score / n_tokens)).

    Tokens are lower-cased (A-Z) words and one end for each text. All words of the training texts are counted. The
    `frequent` most frequent ones are clustered by exchange into `classes`; both numbers follow the vocabulary unless
    they are given (sizes()). Every other word that occurs twice or more then goes to the class that its neighbours on
    both sides favour most, one exchange step over all of the corpus. Words that occur once share a class with the unknown word, whose probability is Good and Turing's; they have no left-context of their
    own. A token's probability is that of its class after the class before it (after the end's at a text's start),
    interpolated with the class's own, times that of the word in its class. For any history the probabilities of all
    known words and the unknown one add up to 1.

    Only the tables of frequent words and classes reach the driver; all else is counted in buckets by hash. Null and
    empty texts are one token; repeated rows count as often as they occur; an empty table gives no rows; a corpus
    without training texts scores by the unknown word alone; other columns are ignored."""
    spark = docs.sparkSession
    coded = code(docs, folds, fold, id_col, text_col)
    n_bytes = coded.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).head()[0]
    buckets = max(partitions(spark), n_bytes // BUCKET_BYTES)
    given = frequent

    def by_bucket(block: int, h: np.ndarray, pack) -> pa.RecordBatch:
        bounds = bucket_bounds(h, buckets)
        some = np.flatnonzero(np.diff(bounds))
        data = [pack(a, b) for a, b in zip(bounds[some].tolist(), bounds[some + 1].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([block] * len(some), pa.int64()), pa.array(data, pa.binary())], ["bucket", "block", "data"])

    def send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            tokens, h, train, _ = _opened(row)
            n = np.bincount(tokens[train], minlength=len(h)).astype(np.uint32)
            yield by_bucket(row["block"], h, lambda a, b, h=h, n=n: packed(h[a:b], n[a:b]))

    def count(table: pa.Table) -> pa.Table:
        owner, bucket = table.column("block").to_pylist(), table.column("bucket")[0].as_py()
        (h, n), of = unpacked_all(table.column("data").to_pylist(), "u8", "u4")
        h, at = np.unique(h, return_inverse=True)
        c = np.bincount(at, weights=n).astype(np.int64)
        top = np.argsort(-c, kind="stable")[: given or MOST_FREQUENT]
        top = top[c[top] > 0]
        facts = dict(n=int(c.sum()), v=int((c > 0).sum()), v1=int((c == 1).sum()), v2=int((c == 2).sum()), top=[dict(h=int(x), c=int(y)) for x, y in zip(h[top].view(np.int64), c[top], strict=True)])
        rows = [dict(bucket=bucket, block=b, data=packed(c[at[of == k]]), facts=facts if k == 0 else None) for k, b in enumerate(owner)]
        return pa.Table.from_pylist(rows, schema=counted_schema)

    facts_type = "struct<n: bigint, v: bigint, v1: bigint, v2: bigint, top: array<struct<h: bigint, c: bigint>>>"
    pair_type = pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64())]))
    counted_schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("data", pa.binary()), ("facts", pa.struct([("n", pa.int64()), ("v", pa.int64()), ("v1", pa.int64()), ("v2", pa.int64()), ("top", pair_type)]))])
    sent = coded.mapInArrow(send_words, "bucket int, block long, data binary")
    counted = written(sent.groupBy("bucket").applyInArrow(count, f"bucket int, block long, data binary, facts {facts_type}"), "counted", codec="none")
    known = counted.where("facts is not null")
    total, v, v1, v2 = (x or 0 for x in known.agg(*(F.sum(f"facts.{x}") for x in ("n", "v", "v1", "v2"))).head())
    classes, frequent = (x or y for x, y in zip((classes, frequent), sizes(v), strict=True))
    rare = classes
    top = known.select(F.explode("facts.top").alias("w")).select("w.h", "w.c").where("c > 1").orderBy(F.desc("c"), "h").limit(frequent).collect()
    top_hash = np.array([r.h for r in top], dtype=np.int64).view(np.uint64)
    if END not in top_hash:
        top_hash = np.append(top_hash, END)
    by_hash = np.argsort(top_hash)
    sorted_top, k_top = top_hash[by_hash], len(top_hash)

    def top_of(h: np.ndarray) -> np.ndarray:
        """The rank of each word among the frequent ones, or -1."""
        at = np.minimum(np.searchsorted(sorted_top, h), k_top - 1)
        return np.where(sorted_top[at] == h, by_hash[at], -1)

    end_rank = int(np.flatnonzero(top_hash == END)[0])

    def send_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in each(batches):
            tokens, h, train, begins = _opened(row)
            own = top_of(h)[tokens]
            before = np.where(begins, end_rank, np.r_[end_rank, own[:-1]])
            some = train & (own >= 0) & (before >= 0)
            code_, n = np.unique(before[some] * k_top + own[some], return_counts=True)
            part = code_ // k_top % 16
            parts = np.unique(part)
            data = [packed(code_[part == p].astype(np.uint32), n[part == p].astype(np.uint32)) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(data, pa.binary())], ["part", "data"])

    pairs = np.zeros((k_top, k_top))
    for r in coded.mapInArrow(send_pairs, "part int, data binary").groupBy("part").applyInArrow(_sum_pairs, "code long, n long").toLocalIterator():
        pairs[r.code // k_top, r.code % k_top] = r.n
    top_class = exchange(pairs, classes)
    member = np.zeros((k_top, classes))
    member[np.arange(k_top), top_class] = 1
    smooth = member.T @ pairs @ member + 0.1
    # what each class of the word before, then of the word after, tells about the word's own class
    joint = np.log(smooth / smooth.sum())
    favour = joint - np.log(smooth.sum(1, keepdims=True) / smooth.sum()) - np.log(smooth.sum(0) / smooth.sum())
    favour = np.concatenate([favour, favour.T]).astype(np.float32)

    def send_contexts(key, block: pa.Table, counts: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist():
            tokens, h, train, begins = _opened(row)
            c = _joined(counts, "i8")
            top = top_of(h)
            asked = np.flatnonzero((top < 0) & (c > 1))
            place = np.full(len(h), -1)
            place[asked] = np.arange(len(asked))
            # the nearest frequent word before each token, of the same text or its start
            seen = np.where(begins, end_rank, np.r_[-1, top[tokens[:-1]]])
            context = top_class[seen[np.maximum.accumulate(np.where(seen >= 0, np.arange(len(seen)), 0))]]
            # and the nearest one after it: every text has its end
            own, last = top[tokens], len(tokens) - 1
            ahead = np.minimum.accumulate(np.where(own >= 0, np.arange(len(own)), last)[::-1])[::-1]
            after = top_class[own[ahead[np.minimum(np.arange(len(own)) + 1, last)]]]
            some = train & (place[tokens] >= 0)
            of = place[tokens[some]] * 2 * classes
            code_, n = np.unique(np.concatenate([of + context[some], of + classes + after[some]]), return_counts=True)
            word = code_ // (2 * classes)

            def pack(a: int, b: int, asked=asked, h=h, code_=code_, n=n, word=word) -> bytes:
                x, y = np.searchsorted(word, (a, b))
                head = packed(h[asked[a:b]])
                return len(head).to_bytes(4, "little") + head + packed((code_[x:y] - a * 2 * classes).astype(np.uint32), n[x:y].astype(np.uint32))

            out.append(by_bucket(row["block"], h[asked], pack))
        return pa.Table.from_batches(out) if out else pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})

    def classify(table: pa.Table) -> pa.Table:
        owner, bucket = table.column("block").to_pylist(), table.column("bucket")[0].as_py()
        hashes, codes = [], []
        for x in table.column("data").to_pylist():
            n = 4 + int.from_bytes(x[:4], "little")
            hashes.append(unpacked(x[4:n], "u8")[0])
            codes.append(unpacked(x[n:], "u4", "u4"))
        distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
        ends = np.cumsum([len(x) for x in hashes])
        counts = np.zeros((len(distinct), 2 * classes), dtype=np.float32)
        for x, end, (code_, n) in zip(hashes, ends, codes, strict=True):
            own = at[end - len(x) : end]
            np.add.at(counts, (own[code_ // (2 * classes)], code_ % (2 * classes)), n)
        chosen = (counts @ favour).argmax(1)
        totals = np.bincount(chosen, weights=counts[:, :classes].sum(1), minlength=classes).astype(np.int64).tolist()
        data = [packed(chosen[at[end - len(x) : end]].astype(np.uint8)) for x, end in zip(hashes, ends, strict=True)]
        return pa.table({"bucket": pa.array([bucket] * len(owner), pa.int32()), "block": pa.array(owner, pa.int64()), "data": pa.array(data, pa.binary()), "totals": pa.array([totals if k == 0 else None for k in range(len(owner))], pa.list_(pa.int64()))})

    asked = coded.groupBy("block").cogroup(counted.select("block", "bucket", "data").groupBy("block")).applyInArrow(send_contexts, "bucket int, block long, data binary")
    classed = written(asked.groupBy("bucket").applyInArrow(classify, "bucket int, block long, data binary, totals array<long>"), "classed", codec="none")
    class_total = np.zeros(classes, dtype=np.int64)
    for r in classed.where("totals is not null").select(F.posexplode("totals").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        class_total[r.k] += r.n
    for r in top:
        class_total[top_class[int(np.flatnonzero(top_hash == np.array([r.h], dtype=np.int64).view(np.uint64))[0])]] += r.c
    # Good and Turing: what occurs once foretells the unknown, what occurs twice foretells what occurs once
    unknown, once = v1 + 0.5, (2 * v2 + 0.5) * (v1 > 0)
    log_unknown, log_once = np.log10(unknown / (unknown + once)), np.log10(once / (unknown + once) / max(v1, 1)) if v1 else 0.0
    end_class = int(top_class[end_rank])
    base_rest = np.log10(total + 0.5 * (v + 1))

    def weigh(key, block: pa.Table, facts: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist():
            tokens, h, train, begins = _opened(row)
            c = _joined(facts.filter(pa.compute.equal(facts.column("kind"), 0)), "i8")
            top = top_of(h)
            own = np.where(top >= 0, top_class[top], rare)
            own[(top < 0) & (c > 1)] = _joined(facts.filter(pa.compute.equal(facts.column("kind"), 1)), "u1")
            own[(c <= 1)] = rare
            emission = np.where(c > 1, np.log10(np.maximum(c, 1)) - np.log10(np.maximum(np.r_[class_total, 1][own], 1)), np.where(c == 1, log_once, log_unknown))
            starts = np.flatnonzero(begins)
            sums = [np.add.reduceat(x[tokens], starts).tolist() for x in (np.log10(c + 0.5) - base_rest, emission, (c > 0).astype(np.int64))]
            sequence, ends = own[tokens].astype(np.uint8), np.r_[starts[1:], len(tokens)]
            for k, doc_id in enumerate(row["ids"]):
                out.append(dict(doc_id=doc_id, held_out=row["held"][k], n_tokens=row["sizes"][k], n_known=sums[2][k], base_score=sums[0][k], emission=sums[1][k], classes=sequence[starts[k] : ends[k]].tobytes()))
        return pa.Table.from_pylist(out, schema=pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("emission", pa.float64()), ("classes", pa.binary())]))

    facts = counted.select("block", "bucket", F.lit(0).alias("kind"), "data").unionByName(classed.select("block", "bucket", F.lit(1).alias("kind"), "data"))
    weighed = coded.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(weigh, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emission double, classes binary")
    weighed = written(weighed, "weighed")
    width = classes + 1

    def steps(data: bytes) -> np.ndarray:
        own = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
        return np.r_[end_class, own[:-1]] * width + own

    def transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(width * width, dtype=np.int64)
        for batch in batches:
            for x in batch.column("classes").to_pylist():
                n += np.bincount(steps(x), minlength=width * width)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["step", "n"])

    n = np.zeros(width * width)
    for r in weighed.where("not held_out").select("classes").mapInArrow(transitions, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect():
        n[r.step] = r.n
    n = n.reshape(width, width)
    n[:, rare] *= (unknown + once) / unknown
    overall = n.sum(0) + 0.5
    log_step = np.log10((n + 8 * overall / overall.sum()) / (n.sum(1, keepdims=True) + 8)).ravel()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [float(log_step[steps(x)].sum()) + e for x, e in zip(batch.column("classes").to_pylist(), batch.column("emission").to_pylist(), strict=True)]
            length = batch.column("n_tokens").to_pylist()
            columns = [*(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")), pa.array([total] * len(own), pa.int64()), batch.column("base_score"), pa.array(own, pa.float64()), pa.array([10 ** (-s / m) for s, m in zip(own, length, strict=True)], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return weighed.mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def _joined(table: pa.Table, kind: str) -> np.ndarray:
    """A block's numbers from all buckets, in the order of its vocabulary."""
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("data").to_pylist(), strict=True))
    return np.concatenate([unpacked(x, kind)[0] for _, x in rows]) if rows else np.empty(0, dtype=kind)
