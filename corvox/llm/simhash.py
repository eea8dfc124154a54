"""SimHash near-duplicates by multi-index hashing over fingerprint segments."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, id_and_text, in_small_batches, lean, mix, partitions, written
from .components import components

SEED = 42
SEGMENTS, WIDTH = 4, 16
#: Links held before a task hands on what they connect.
HELD_LINKS, GATHERED_LINKS = 200_000, 400_000


def shingle_digests(text: bytes, shingle: int) -> list[bytes]:
    """XXH64 digests (big-endian) of the shingles of lower-cased (A-Z) words, repeats included; a text of fewer words
    is one shingle, one without words has none."""
    own = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not own:
        return []
    if len(own) <= shingle:
        return [xxhash.xxh64_digest(b" ".join(own), SEED)]
    return list(map(xxhash.xxh64_digest, map(b" ".join, zip(*(own[k:] for k in range(shingle)), strict=False)), repeat(SEED)))


def majority(digests: bytes, counts: np.ndarray) -> np.ndarray:
    """A fingerprint for each document: the bits that are set in more than half of its digests (none: zero)."""
    out, some = np.zeros(len(counts), dtype=np.uint64), counts > 0
    if some.any():
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * sums > counts[some][:, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the 64-bit SimHash fp (long) of each row; null, empty and blank texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, held, size, counts = [], [], 0, []
            for text in batch.column("text"):
                own = shingle_digests((text.as_py() or "").encode(), shingle)
                held.append(b"".join(own))
                counts.append(len(own))
                size += len(own)
                if size >= 1 << 17:
                    done.append(majority(b"".join(held), np.array(counts)))
                    held, size, counts = [], 0, []
            done.append(majority(b"".join(held), np.array(counts, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(done).view(np.int64))], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, fp long")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Table and probe entries of each fingerprint. A table entry's key has one segment blanked. Two fingerprints
    with at most two differing bits have these in one segment (then their keys without that segment are equal) or
    one each in two; for that case probes clear each set bit of the later of the two and blank the earlier: of two
    fingerprints that differ in a bit, one has it set."""
    blank = [np.uint64(~(0xFFFF << WIDTH * s) & 0xFFFFFFFFFFFFFFFF) for s in range(SEGMENTS)]
    for batch in batches:
        fp = np.asarray(batch.column("fp")).view(np.uint64)
        for a in range(0, len(fp), 1024):
            own, keys, whose, segments, probes = fp[a : a + 1024], [], [], [], []
            for s in range(SEGMENTS):
                keys.append(own & blank[s])
                whose.append(own)
                for bit in range(WIDTH * (s + 1), WIDTH * SEGMENTS):
                    some = own[own & np.uint64(1 << bit) != 0]
                    keys.append((some ^ np.uint64(1 << bit)) & blank[s])
                    whose.append(some)
                n = 1 + WIDTH * (SEGMENTS - s - 1)
                segments += [s] * n
                probes += [False] + [True] * (n - 1)
            sizes = [len(x) for x in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(segments, dtype=np.int32), sizes)), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(whose).view(np.int64)), pa.array(np.repeat(np.array(probes), sizes))],
                ["segment", "key", "fp", "probe"],
            )


def _matches(low: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the entries with one key, pairs that link, by what the blanked segment holds: table entries within two bits
    of each other, probes within one bit of a table entry. Large groups look up small Hamming balls in a table of
    all 2**16 values, so that the work follows the number of entries."""
    table = np.flatnonzero(~probe)
    if len(table) * len(low) <= 1 << 14:
        apart = np.bitwise_count(low[:, None] ^ low[table][None, :])
        x, y = np.nonzero(apart <= np.where(probe, 1, 2)[:, None])
        return x, table[y]
    holder = np.full(1 << WIDTH, -1, dtype=np.int64)
    holder[low[table]] = table
    ones = [1 << i for i in range(WIDTH)]
    twos = [a | b for k, a in enumerate(ones) for b in ones[k + 1 :]]
    xs, ys = [], []
    for mask, of in [(0, np.arange(len(low))), *((m, np.arange(len(low))) for m in ones), *((m, table) for m in twos)]:
        at = holder[low[of] ^ mask]
        xs.append(of[at >= 0])
        ys.append(at[at >= 0])
    return np.concatenate(xs), np.concatenate(ys)


def _forest(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[int]]:
    """Links that connect the same fingerprints as the pairs do, one for each fingerprint at most."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for x, y in pairs:
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    return nodes, [root(x) for x in nodes]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by key: the links among each key's entries, as a forest."""
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    held, rest = 0, None
    names = ["segment", "key", "fp", "probe"]

    def forest() -> pa.RecordBatch:
        a, b = _forest(pairs)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def groups(segment, key, fp, probe) -> None:
        nonlocal held
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (segment[1:] != segment[:-1])])
        last = np.r_[first[1:], len(key)]
        tables = np.add.reduceat(~probe, first, dtype=np.int64)
        for a, b in zip(first[(last - first > 1) & (tables > 0)].tolist(), last[(last - first > 1) & (tables > 0)].tolist(), strict=True):
            low = ((fp[a:b].view(np.uint64) >> np.uint64(WIDTH * int(segment[a]))) & np.uint64(0xFFFF)).astype(np.int64)
            x, y = _matches(low, probe[a:b])
            x, y = fp[a:b][x], fp[a:b][y]
            if (x != y).any():
                pairs.append((x[x != y], y[x != y]))
                held += len(pairs[-1][0])

    for batch in batches:
        own = [np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in names]
        if rest is not None:
            own = [np.concatenate(x) for x in zip(rest, own, strict=True)]
        if not len(own[0]):
            continue
        segment, key = own[0], own[1]
        same = (key == key[-1]) & (segment == segment[-1])
        cut = len(key) - int(same[::-1].argmin() if not same.all() else len(key))
        rest = [x[cut:] for x in own]
        if cut:
            groups(*(x[:cut] for x in own))
        if held >= HELD_LINKS:
            yield forest()
            pairs, held = [], 0
    if rest is not None:
        groups(*rest)
    yield forest()


def links(distinct: DataFrame) -> DataFrame:
    """distinct: fp (long), no fp twice. Links a, b that connect what differs in two bits at most: not all such
    pairs, but enough of them that components are the same. A key's entries share 48 bits, so at most 2**16 of them
    are table entries, however many fingerprints there are."""
    n = partitions(distinct.sparkSession)
    entries = distinct.select("fp").mapInArrow(lean(_entries), "segment int, key long, fp long, probe boolean")
    by_key = entries.repartition(n, "segment", "key").sortWithinPartitions("segment", "key")
    return by_key.mapInArrow(lean(_linked), "a long, b long")


def thinned(found: DataFrame) -> DataFrame:
    """Links that connect the same nodes as found (a, b) does, as a task finds them among at most about GATHERED_LINKS:
    tasks whose keys held the same close copies have each connected them in their own way."""
    found = written(found, "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _forest([(np.asarray(x.column("a")), np.asarray(x.column("b"))) for x in batches])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return found.coalesce(1 + found.count() // GATHERED_LINKS).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, fp (64-bit SimHash of its word shingles) and component_id, the smallest doc_id among the
    documents that links of two differing bits or fewer reach from it, itself included.

    Rows of one fingerprint are one node, so copies are never paired. Null, empty and blank texts have fingerprint 0
    and link like any other; a null doc_id counts only where a component has no other (component_id is then null);
    repeated rows each get their row; an empty table gives none."""
    prints = written(fingerprints(docs, shingle, id_col, text_col), "prints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    found = components(thinned(links(nodes))).withColumnRenamed("node", "fp")
    rooted = nodes.join(found, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(roots, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


#: Five-word shingles that are put last when prefixes are taken: at most so many, from a sample of so many texts.
COMMON, SAMPLED = 1 << 18, 10_000
#: Texts of which a task remembers that it has sent their entries.
REMEMBERED = 1 << 16
#: Rounds of stars before all pairs are compared; entries that are compared at once.
STARS, GROUP = 1, 1 << 15
#: Texts of a key from which on a star's middle is looked for.
MANY = 8
#: Bytes of text in a block of nodes whose pairs are verified together.
BLOCK_BYTES = 1 << 22
#: Pairs that a cell has on average at most.
CELL_PAIRS = 1 << 14
#: Of 128 bits: texts of a similarity of 0.75 or more differ in 24 on average, unlike ones in 64.
FAR = 50
ENTRY = "key long, node long, size int, at int"
#: First keys of a node by which a pair that another key has already is known.
LEADS = 8


def shingle_set(text: str | None, shingle: int) -> set[bytes]:
    """Shingles of lower-cased words; a text of fewer words is one shingle, one without words has none."""
    own = (text or "").lower().encode().split()
    if len(own) <= shingle:
        return {b" ".join(own)} if own else set()
    return set(map(b" ".join, zip(*(own[k:] for k in range(shingle)), strict=False)))


def _hashed(text: str | None, shingle: int) -> np.ndarray:
    return np.unique(np.array([xxhash.xxh64_intdigest(x, SEED) for x in shingle_set(text, shingle)], dtype=np.uint64).view(np.int64))


def _set_prints(texts: DataFrame, shingle: int) -> DataFrame:
    """node, fp, more: a SimHash of 128 bits over each text's set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = []
            held, size, counts = [], 0, []
            for text in batch.column("text"):
                held.append(_hashed(text.as_py(), shingle).view(np.uint64))
                counts.append(len(held[-1]))
                size += counts[-1]
                if size >= 1 << 17:
                    out.append(_two_prints(held, counts))
                    held, size, counts = [], 0, []
            out.append(_two_prints(held, counts))
            both = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["node", "fp", "more"])

    return texts.select("node", "text").mapInArrow(lean(run), "node long, fp long, more long")


def _two_prints(hashes: list[np.ndarray], counts: list[int]) -> np.ndarray:
    own, n = np.concatenate([*hashes, np.empty(0, dtype=np.uint64)]), np.array(counts, dtype=np.int64)
    return np.column_stack([majority(x.astype(">u8").tobytes(), n).view(np.int64) for x in (own, mix(~own))])


def _common(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the shingles that are in four or more texts of a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(_hashed(text.as_py(), shingle))], ["key"])

    share = min(1.0, SAMPLED / max(1, texts.count()))
    some = texts.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1))
    top = some.select("text").mapInArrow(lean(run), "key long").groupBy("key").count().where("count > 3").orderBy(F.desc("count"), "key").limit(COMMON).toArrow()
    key, count = top.column("key").to_numpy(), top.column("count").to_numpy()
    return key[np.argsort(key)], count[np.argsort(key)]


def _prefix_entries(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """texts: node, text. The first shingles of each text, as many as two texts of that similarity must share one of,
    with the size of its set and their places. Any order that is the same for all texts will do: with the shingles
    that are common in a sample last, few texts meet that aren't alike. often: the shingle is among these."""
    sent = texts.sparkSession.sparkContext.broadcast(_common(texts, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (common, count), seen = sent.value, set()
        for batch in batches:
            keys, often, nodes, sizes, held = [], [], [], [], 0

            def entries() -> pa.RecordBatch:
                n = np.array([len(k) for k in keys])
                at = [np.arange(len(k), dtype=np.int32) for k in keys]
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(nodes, dtype=np.int64), n)), pa.array(np.repeat(np.array(sizes, dtype=np.int32), n)), pa.array(np.concatenate(at)), pa.array(np.concatenate(often))], ["key", "node", "size", "at", "often"])

            for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                if node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                own = _hashed(text.as_py(), shingle)
                if not len(own):
                    continue
                where = np.searchsorted(common, own)
                rank = np.zeros(len(own), dtype=np.int64)
                known = where < len(common)
                known[known] = common[where[known]] == own[known]
                rank[known] = count[where[known]]
                first = np.lexsort((own, rank))[: len(own) - math.ceil(similarity * len(own) - 1e-9) + 1]
                keys.append(own[first])
                often.append(known[first])
                nodes.append(node)
                sizes.append(len(own))
                held += len(keys[-1])
                if held >= 1 << 17:
                    yield entries()
                    keys, often, nodes, sizes, held = [], [], [], [], 0
            if keys:
                yield entries()

    return texts.select("node", "text").mapInArrow(lean(run), f"{ENTRY}, often boolean")


def _by_key(entries: DataFrame, of_group, columns: list[str], schema: str) -> DataFrame:
    """What of_group yields for the columns (numpy) of each key's entries, one a node, where it has two or more.

    Entries with a column often are dealt out by key and node where it is true: so many texts have that key that they
    aren't brought to one task. of_group gets them in parts, also in parts of one."""
    names = entries.columns

    def groups(own: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        new = np.r_[True, (own[0][1:] != own[0][:-1]) | (own[1][1:] != own[1][:-1])]
        own = [c[new] for c in own]
        first = np.flatnonzero(np.r_[True, own[0][1:] != own[0][:-1]])
        last = np.r_[first[1:], len(own[0])]
        due = last - first > 1
        if "often" in names:
            due |= own[names.index("often")][first]
        for a, b in zip(first[due].tolist(), last[due].tolist(), strict=True):
            yield from of_group([c[a:b] for c in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list[np.ndarray]] = []
        held: list[list[np.ndarray]] = []
        size = 0

        def settled(own: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal size
            for found in groups(own) if len(own[0]) else ():
                held.append(found)
                size += len(found[0])
                if size >= 1 << 16:
                    yield out()
                    size = 0
            if last and held:
                yield out()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], columns)
            held.clear()
            return made

        for batch in batches:
            own = [np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in names]
            if not len(own[0]):
                continue
            if rest and rest[0][0][0] == own[0][-1]:
                rest.append(own)  # all of one key so far
                continue
            whole = [np.concatenate(c) for c in zip(*rest, own, strict=True)]
            cut = len(whole[0]) - int((whole[0][::-1] != whole[0][-1]).argmax()) if (whole[0] != whole[0][-1]).any() else 0
            rest = [[c[cut:] for c in whole]]
            yield from settled([c[:cut] for c in whole], False)
        if rest:
            yield from settled([np.concatenate(c) for c in zip(*rest, strict=True)], True)

    n = partitions(entries.sparkSession)
    dealt = F.when(F.col("often"), F.xxhash64("key", "node")).otherwise(F.col("key")) if "often" in names else F.col("key")
    return entries.repartition(n, dealt).sortWithinPartitions("key", "node").mapInArrow(lean(run), schema)


def _shared(group: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    yield group[:4]


def _middle(group: list[np.ndarray], rows: np.ndarray) -> int:
    """Which of these rows of a group has the fingerprint (columns 5 and 6) nearest to the majority of each bit."""
    bits = np.unpackbits(np.column_stack([group[5][rows], group[6][rows]]).astype(np.int64).view(np.uint8).reshape(len(rows), 16), axis=1)
    return int((bits != (2 * bits.sum(0, dtype=np.int64) > len(rows))).sum(1).argmin())


def _paired(similarity: float, star: int | None = None):
    """Of one group's entries, the pairs (a, b) of nodes of different roots that can be similar by sizes and by what
    can follow the key in both. star: not all pairs, but each node with one of those that its size allows; which one
    depends on the number, so that rounds differ. Without it, entries have their key (column 5) and their nodes' leads
    (columns 6 on): two texts share many keys, and a key at which the leads of both have an earlier one yields no pair,
    as that one does; of two shared keys the earlier is earlier in both, and passes if the later does."""

    def pairs(group: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        order = np.argsort(group[2], kind="stable")
        node, size, at, root = group[1][order], group[2][order].astype(np.int64), group[3][order].astype(np.int64), group[4][order]
        if (root == root[0]).all():
            return
        if star is None:
            of, leads = group[5][order], np.column_stack([c[order] for c in group[6:]])
        ends = np.searchsorted(size, size / similarity + 1e-6, side="right")
        k = 0
        while k < len(node):
            end = int(ends[k])
            if star is None:
                one, among = k, slice(k + 1, end)
            else:
                one, among = k + (star * 7919 % (end - k) if end - k < MANY else _middle(group, order[k:end])), slice(k, end)
            most = np.minimum(size[one] - at[one], size[among] - at[among])
            due = similarity / (1 + similarity) * (size[one] + size[among]) - 1e-6
            able = (most >= due) & (root[among] != root[one])
            if star is None and able.any():
                own = leads[one]
                before = own[: int((own == of[one]).argmax()) if (own == of[one]).any() else len(own)]
                able &= ~(leads[among][:, :, None] == before).any((1, 2))
            to = node[among][able]
            if len(to):
                yield [np.minimum(to, node[one]), np.maximum(to, node[one])]
            k = k + 1 if star is None else end

    return pairs


def _mixed(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries with their nodes' roots, of keys whose nodes have different ones; n: how many entries the key has."""
    live = shared.join(roots, "node").select("key", "node", "size", "at", *roots.columns[1:])
    keys = live.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return live.join(keys.select("key", "n"), "key")


def _star_groups(mixed: DataFrame, number: int) -> DataFrame:
    """Groups of about GROUP entries at most: those of a key with more are dealt out anew in each round."""
    part = F.pmod(F.xxhash64(F.lit(number), "node"), F.ceil(F.col("n") / GROUP))
    key = F.when(F.col("n") > GROUP, F.xxhash64("key", part)).otherwise(F.col("key"))
    return mixed.select(key.alias("key"), "node", "size", "at", "root", "fp", "more")


def _all_groups(mixed: DataFrame) -> DataFrame:
    """Groups in which every two entries of a key that have different roots meet. Of a key with more than GROUP of
    them, entries of the root that has most are dealt out in parts, which need not meet each other; each other entry
    goes to all parts if these are few, else every two parts make a group. Groups stay bounded, no pair is lost."""
    sizes = mixed.where(F.col("n") > GROUP).groupBy("key", "root").agg(F.count("*").alias("m"))
    main = sizes.groupBy("key").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("most"))
    rows = mixed.join(main, "key", "left")
    parts = F.ceil(F.col("n") / GROUP)
    own = F.pmod(F.xxhash64("node"), parts)
    every = F.sequence(F.lit(0).cast("long"), parts - 1)
    with_each = F.transform(F.filter(every, lambda p: p != own), lambda p: F.xxhash64(F.col("key"), F.least(own, p), F.greatest(own, p)))
    with_main = F.transform(F.when(F.col("root") == F.col("main"), F.array(own)).otherwise(every), lambda p: F.xxhash64("key", p))
    key = F.when(F.col("main").isNull(), F.array("key")).when(F.col("n") - F.col("most") <= GROUP, with_main).otherwise(with_each)
    return rows.select(F.explode(key).alias("key"), "node", "size", "at", "root", F.col("key").alias("of"), *(f"lead_{k}" for k in range(LEADS)))


def _with_leads(mixed: DataFrame) -> DataFrame:
    """Entries with the first LEADS keys of their nodes, in the order of all prefixes; the first again where there are fewer."""
    first = F.slice(F.sort_array(F.collect_list(F.struct("at", "key"))), 1, LEADS)["key"]
    leads = mixed.groupBy("node").agg(first.alias("own")).select("node", *(F.coalesce(F.get("own", F.lit(k)), F.col("own")[0]).alias(f"lead_{k}") for k in range(LEADS)))
    return mixed.join(leads, "node")


def _similar(pairs: DataFrame, prints: DataFrame, texts: DataFrame, shingle: int, similarity: float, mean_bytes: float, far: int = FAR) -> DataFrame:
    """pairs (a, b) of nodes, written: those whose texts' shingle sets have that Jaccard similarity.

    The complete distance of the fingerprints leaves out what is further apart than far. Other nodes are in blocks of
    about BLOCK_BYTES of text at most, more of them where short texts have many pairs, so that a cell of two blocks has
    about CELL_PAIRS at most; a pair is verified in the cell of its two blocks, to which each text that has pairs there
    goes once, however many they are. Sets are compared by 64-bit hashes of shingles."""
    of = lambda x: prints.toDF(x, f"fp_{x}", f"more_{x}")
    apart = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ("fp", "more")), F.lit(0))
    pairs = written(pairs.join(of("a"), "a").join(of("b"), "b").where(apart <= far).select("a", "b"), "near")
    met = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "met")
    blocks = max(1, math.ceil(met.count() * mean_bytes / BLOCK_BYTES), math.ceil(math.sqrt(2 * pairs.count() / CELL_PAIRS)))
    block = lambda c: F.pmod(F.xxhash64(F.lit(5), c), F.lit(blocks))
    low, high = F.least(block("a"), block("b")), F.greatest(block("a"), block("b"))
    placed = written(pairs.select((low * blocks + high).alias("cell"), "a", "b"), "placed")
    wanted = written(placed.select("cell", F.col("a").alias("node")).union(placed.select("cell", "b")).distinct(), "wanted")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            keys = list(zip(batch.column("cell").to_pylist(), batch.column("node").to_pylist(), strict=True))
            new = []
            for k in keys:
                new.append(k not in seen)
                seen.add(k)
            if len(seen) > REMEMBERED:
                seen.clear()
            yield batch.filter(pa.array(new, pa.bool_()))

    sent = texts.join(wanted, "node").select("cell", "node", "text").mapInArrow(lean(once), "cell long, node long, text string")
    every = sent.select("cell", F.lit(0).alias("kind"), F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "text").union(placed.select("cell", F.lit(1), "a", "b", F.lit(None).cast("string")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sets = None, {}
        for batch in batches:
            out: list[tuple[int, int]] = []
            for of, kind, x, y, text in zip(*(batch.column(c) if c == "text" else batch.column(c).to_pylist() for c in ("cell", "kind", "a", "b", "text")), strict=True):
                if of != cell:
                    cell, sets = of, {}
                if not kind:
                    if x not in sets:
                        sets[x] = _hashed(text.as_py(), shingle)
                else:
                    one, two = sets[x], sets[y]
                    if len(one) > len(two):
                        one, two = two, one
                    same = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum()) if len(one) else 0
                    if same >= similarity * (len(one) + len(two) - same):
                        out.append((x, y))
            columns = list(zip(*out, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    n = partitions(texts.sparkSession)
    found = written(every.repartition(n, "cell").sortWithinPartitions("cell", "kind").mapInArrow(lean(run), "a long, b long"), "similar")
    dropped(pairs, met, placed, wanted)
    return found


def _node(text: Column, unlike: list[int] | None = None) -> Column:
    """What stands for a text: 0 for blank ones, else a hash; another one if the first is among unlike."""
    own = F.xxhash64(text)
    if unlike:
        own = F.when(own.isin(unlike), F.xxhash64(F.lit(7), text)).otherwise(own)
    return F.when(text.isNull() | text.rlike(r"^[ \t\n\x0B\f\r]*$"), F.lit(0).cast("long")).otherwise(own)


def _ids(rows: DataFrame) -> tuple[DataFrame, list[int]]:
    """node, doc_id, n of rows (node, doc_id, text), written, and the nodes that stand for texts whose second hashes
    differ. Of 10**10 texts three such nodes are to be expected, of 10**9 hardly one."""
    second = F.when(F.col("node") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(11), "text"))
    found = written(rows.groupBy("node", "doc_id", second.alias("second")).agg(F.count("*").alias("n")), "ids")
    unlike = found.groupBy("node").agg(F.min("second").alias("x"), F.max("second").alias("y")).where("x <> y").select("node")
    return found, [r.node for r in unlike.toLocalIterator()]


def without_near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.75, id_col: str = "doc_id", text_col: str = "text", far: int = FAR) -> DataFrame:
    """docs with one row of each group of near copies: the one with the least id (null last).

    Texts link if their sets of five-word shingles have a Jaccard similarity of at least `similarity`, groups are what
    links connect. Candidates are first the links of SimHash fingerprints by multi-index hashing; then, in rounds,
    stars among texts that share a shingle of their prefixes and aren't connected yet; at last all such pairs, which
    leaves out none. Of these the complete distance of 128-bit fingerprints is verified (`far` or less, which a link
    exceeds less than once in 10**6 times at 50; with 128 all candidates go on, and the search is exact) and then the
    similarity itself, on the texts. Texts, not ids, are grouped: rows of one id or none whose texts differ stay unless
    another text is like them; texts are told apart by two 64-bit hashes. All blank texts are copies of each other, of which one row stays; of rows that repeat
    an id with its text one stays; an empty table stays empty; other columns stay as they are."""
    in_small_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    ids, unlike = _ids(rows.withColumn("node", _node(F.col("text"))))
    rows = rows.withColumn("node", _node(F.col("text"), unlike))
    if unlike:
        dropped(ids)
        ids, _ = _ids(rows)
    texts = rows.where("node <> 0").select("node", "text")
    nodes = ids.select("node").distinct()
    # equal fingerprints and links between fingerprints, each by its least node
    prints = written(_set_prints(texts, shingle).dropDuplicates(["node"]), "prints")
    least = written(prints.groupBy("fp").agg(F.min("node").alias("least")), "least")
    close = thinned(links(least)).join(least.toDF("a", "x"), "a").join(least.toDF("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = written(close.union(prints.join(least, "fp").where("least <> node").select("least", "node")).distinct(), "pairs")
    shared = written(_by_key(_prefix_entries(texts, shingle, similarity), _shared, ENTRY.replace(" long", "").replace(" int", "").split(", "), ENTRY), "shared")
    n_rows, n_bytes = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()
    tested, similar, roots = [], [], None
    for number in range(STARS + 2):
        if number:
            # keys all of whose nodes are connected stay so
            facts = roots.join(prints, "node").select("node", "root", "fp", "more") if number <= STARS else roots.select("node", "root")
            mixed = written(_mixed(shared.select("key", "node", "size", "at"), facts), "mixed")
            dropped(shared, roots)
            shared = mixed
            groups, star = (_star_groups(mixed, number), number) if number <= STARS else (_all_groups(_with_leads(mixed)), None)
            pairs = _by_key(groups, _paired(similarity, star), ["a", "b"], "a long, b long").distinct()
            pairs = written(pairs.join(reduce(DataFrame.union, tested), ["a", "b"], "left_anti"), "pairs")
        similar.append(_similar(pairs, prints, texts, shingle, similarity, n_bytes / max(1, n_rows), far))
        tested.append(pairs)
        roots = written(nodes.join(components(reduce(DataFrame.union, similar)), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")
    dropped(shared, prints, least, *tested, *similar)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("kept")
    kept = roots.join(ids, "node").groupBy("root").agg(first).select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.node").alias("kept_node"))
    kept, key = written(kept, "kept"), (docs[id_col].cast("long"), _node(docs[text_col].cast("string"), unlike))
    own = docs.join(kept, key[0].eqNullSafe(kept["kept_id"]) & (key[1] == kept["kept_node"]), "left_semi")
    if ids.where("n > 1").isEmpty():
        return own
    # of rows that have both id and text in common one stays
    keyed = own.select(key[0].alias("id"), key[1].alias("node"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return keyed.dropDuplicates(["id", "node"]).select("row.*")
