"""Personal data: patterns, and a skip-chain conditional random field that gives repeated or similar tokens of a document
the same label by loopy message passing."""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, chunks, id_and_text, in_small_batches, lean, utf8, words

KINDS = ("email", "ip", "card", "phone")
#: Labels: 0 is none of the kinds.
LABELS = 1 + len(KINDS)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried at its start alone: if that fails, so do all places within it
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
LETTERS = re.compile(r"[^\W\d_]+")
#: What may stand around a token without being part of it.
EDGES = ".,;:!?\"'()[]{}<>|*«»„“”…"
#: Bytes that make a token one of the field's nodes; all other tokens are observed as none of the kinds.
MARKS = np.zeros(256, dtype=bool)
MARKS[[*range(0x30, 0x3A), 0x40]] = True
#: Rows of the node weights; features' names are hashed to them.
FEATURES = 1 << 12
#: Links between tokens: neighbours; equal tokens; equal last digits; the part of an address before its @.
CHAIN, SAME, SUFFIX, NAME = range(4)
#: Characters that a token has at least to be linked to equal ones, and digits that must agree at the end.
LEAST_SAME, LEAST_SUFFIX, LEAST_NAME = 7, 7, 5
#: Pairs of one label, and of two, that count as seen before any text has been: seven equal digits or characters hardly
#: meet by chance. Of neighbours, pairs of any labels.
AGREEING, DIFFERING, ANY = 20.0, 0.005, 0.5
#: Share of tokens that the patterns may have missed: a token's own look never rules a label out, however large the
#: corpus that it was learnt from.
MISSED = 0.01
#: Digits that an added span of a kind has at least.
LEAST_DIGITS = {3: 12, 4: 7}
ROUNDS, DAMPING, STILL = 40, 0.5, 1e-4
CLAMPED = -60.0
CHUNK, CACHE, HELD = 1 << 22, 200_000, 1 << 16


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to the left, as far as characters of the first part go: no run of them is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of what the patterns find, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def shape(token: str) -> str:
    return DIGITS.sub(lambda m: f"d{min(len(m[0]), 20)}", LETTERS.sub("a", token))[:32]


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


@dataclass
class Token:
    """What is known of a token wherever it stands."""

    left: int
    size: int
    shape: str
    own: tuple[int, ...]
    keys: tuple[tuple[int, str], ...]
    numerals: str


def read(token: str) -> Token:
    core = token.strip(EDGES)
    left = len(token) - len(token.lstrip(EDGES)) if core else 0
    core = core or token
    digits, low, form = "".join(DIGITS.findall(core)), core.lower(), shape(token)
    # what all tokens share, the token's form, and its form whatever the lengths of numbers
    names = ["any", f"shape {form}", f"form {re.sub('d[0-9]+', 'd', form)}"]
    names += ["at"] * ("@" in core) + ["plus"] * token.startswith("+") + ["luhn"] * (14 <= len(digits) <= 19 and luhn(digits))
    keys = [(SAME, low)] if len(core) >= LEAST_SAME else []
    if len(digits) >= LEAST_SUFFIX:
        keys.append((SUFFIX, digits[-LEAST_SUFFIX:]))
    name = low.split("@")[0].strip(EDGES)
    if len(name) >= LEAST_NAME and not name.isalpha() and not name.replace(".", "").isdigit():
        keys.append((NAME, name))
    return Token(left, len(core), form, tuple(map(_bucket, names)), tuple(keys), "" if LETTERS.search(core) else digits)


@dataclass
class Field:
    """The nodes of some documents and what links them."""

    doc: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    digits: list[int] = field(default_factory=list)
    place: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    features: list[tuple[int, ...]] = field(default_factory=list)
    links: list[tuple[int, int, int]] = field(default_factory=list)


def linked(groups: dict[tuple[int, str], list[tuple[int, ...]]], label: list[int]) -> list[tuple[int, int, int]]:
    """Links among the nodes of each key: each to the one before it, and one that no pattern found to the nearest on
    either side that a pattern did. So links are three a node and key at most, however often a token comes. A number in
    several tokens is linked by its last one and by what else has the digits that agree."""
    out: dict[tuple[int, int], int] = {}
    for (kind, _), members in groups.items():
        if len(members) < 2:
            continue
        pairs = list(zip(members, members[1:], strict=False))
        for way in (members, members[::-1]):
            last = None
            for x in way:
                if label[x[0]]:
                    last = x
                elif last is not None:
                    pairs.append((last, x))
        for x, y in pairs:
            for a, b in [(x[0], z) for z in y] + [(z, y[0]) for z in x[1:]]:
                if a != b:
                    out.setdefault((min(a, b), max(a, b)), kind)
    return [(a, b, kind) for (a, b), kind in out.items()]


class Reader:
    """Texts to fields. Tokens are cached, as most are met again."""

    def __init__(self) -> None:
        self.cache: dict[str, Token] = {}

    def token(self, text: str) -> Token:
        found = self.cache.get(text)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = self.cache[text] = read(text)
        return found

    def field(self, texts: list[str], raw: np.ndarray, at: np.ndarray, base: list[list[tuple[int, int, int]]]) -> Field:
        """Nodes are tokens with a digit or @, and those that equal the first part of an address that the patterns
        found in the same document."""
        start, end, first = words(raw, at, NOT_SPACE)
        marked = np.concatenate([[0], np.cumsum(MARKS[raw])])
        chosen = marked[end] > marked[start]
        points = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])
        data, out = raw.tobytes(), Field()
        word = lambda w: data[start[w] : end[w]].decode()
        for d, spans in enumerate(base):
            own = np.flatnonzero(chosen[first[d] : first[d + 1]]) + first[d]
            names = {texts[d][a:b].lower().split("@")[0].strip(EDGES) for a, k, b in spans if k == 0}
            names = {n for n in names if len(n) >= LEAST_NAME and not n.isalpha()}
            if names:
                more = [w for w in range(first[d], first[d + 1]) if not chosen[w] and word(w).strip(EDGES).lower() in names]
                own = np.sort(np.concatenate([own, np.array(more, dtype=own.dtype)]))
            groups: dict[tuple[int, str], list[tuple[int, ...]]] = {}
            run: list[tuple[int, str]] = []
            of_kind = [(y + 1, [x[0] for x in own_], [x[2] for x in own_]) for y in range(len(KINDS)) if (own_ := [x for x in spans if x[1] == y])]
            before, zero = -2, int(points[at[d]])
            for w in own.tolist():
                text = word(w)
                t, node = self.token(text), len(out.doc)
                a = int(points[start[w]]) - zero
                b = a + len(text)
                # spans of one kind are disjoint, so the last that starts before the token's end decides
                label = next((y for y, starts, ends in of_kind if (i := bisect_left(starts, b)) and ends[i - 1] > a), 0)
                around = [("w" if v < first[d] or v >= first[d + 1] or not chosen[v] else self.token(word(v)).shape) for v in (w - 1, w + 1)]
                out.doc.append(d)
                out.start.append(a + t.left)
                out.end.append(a + t.left + t.size)
                out.digits.append(sum(c.isdigit() for c in text))
                out.place.append(w)
                out.label.append(label)
                out.features.append((*t.own, _bucket(f"before {around[0]}"), _bucket(f"after {around[1]}")))
                if before == w - 1:
                    out.links.append((node - 1, node, CHAIN))
                # digits of a number that white space parts are its neighbours' too
                run = [*(run if before == w - 1 else []), (node, t.numerals)][-LEAST_SUFFIX:] if t.numerals else []
                whole = {key: (node,) for key in t.keys}
                if len(t.numerals) < LEAST_SUFFIX <= sum(len(x) for _, x in run):
                    size, part = 0, []
                    for n, x in reversed(run):
                        if size < LEAST_SUFFIX:
                            part.append(n)
                            size += len(x)
                    whole[SUFFIX, "".join(x for _, x in run)[-LEAST_SUFFIX:]] = tuple(part)
                for key, own_ in whole.items():
                    groups.setdefault(key, []).append(own_)
                before = w
            out.links += linked(groups, out.label)
        return out

    def fields(self, column: pa.Array) -> Iterator[tuple[int, list[list[tuple[int, int, int]]], Field]]:
        """(first row, base spans of each row, field) for parts of a column of bounded size."""
        raw, at = utf8(column)
        for a, b in chunks(at, CHUNK):
            texts = [t.as_py() or "" for t in column[a:b]]
            base = [base_spans(t) for t in texts]
            yield a, base, self.field(texts, raw[at[a] : at[b]], at[a : b + 1] - at[a], base)


def unsure(f: Field) -> set[int]:
    """Nodes that no pattern found but that are linked to one that a pattern did: they teach nothing."""
    return {x for a, b, kind in f.links if kind != CHAIN and (f.label[a] > 0) != (f.label[b] > 0) for x in (a, b) if not f.label[x]}


def _lone(f: Field) -> tuple[np.ndarray, np.ndarray]:
    """Whether the word before, after a node is no node: it is observed as none of the kinds."""
    n = len(f.doc)
    left, right = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    for a, b, kind in f.links:
        if kind == CHAIN:
            right[a] = left[b] = False
    return left, right


class Model:
    """Node weights and, for each kind of link, by how much a pair of labels is likelier than by chance."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray) -> None:
        self.weights, self.pairs = weights, pairs

    def nodes(self, f: Field) -> np.ndarray:
        """Log-potentials of the nodes by themselves. What the patterns found is given."""
        n = len(f.doc)
        flat = np.array([k for x in f.features for k in x], dtype=np.int64)
        of = np.repeat(np.arange(n), [len(x) for x in f.features])
        out = np.stack([np.bincount(of, weights=self.weights[flat, y], minlength=n) for y in range(LABELS)], 1)
        out = np.log((1 - MISSED) * np.exp(out - np.logaddexp.reduce(out, 1, keepdims=True)) + MISSED / LABELS)
        left, right = _lone(f)
        out += left[:, None] * self.pairs[CHAIN][0] + right[:, None] * self.pairs[CHAIN][:, 0]
        given = np.array(f.label) > 0
        out[given] = CLAMPED
        out[given, np.array(f.label)[given]] = 0.0
        return out

    def marginals(self, f: Field) -> np.ndarray:
        """Each node's probabilities by loopy sum-product over all links, chain and skip alike, until messages rest."""
        return propagated(self.nodes(f), f.links, self.pairs)


def propagated(nodes: np.ndarray, links: list[tuple[int, int, int]], pairs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of a pairwise field: nodes (n, labels) and pairs (kind, labels, labels) are log-potentials; links are
    (node, node, kind). Exact where links form no loop and rounds are as many as the longest path."""
    n, labels = nodes.shape
    if links:
        a, b, kind = np.array(links, dtype=np.int64).T
        m = len(a)
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        # potentials from the source's label to the target's
        table = np.concatenate([pairs[kind], pairs[kind].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        messages = np.zeros((2 * m, labels))
        for _ in range(rounds):
            belief = nodes + np.stack([np.bincount(target, weights=messages[:, y], minlength=n) for y in range(labels)], 1)
            out = np.logaddexp.reduce((belief[source] - messages[back])[:, :, None] + table, 1)
            out -= np.logaddexp.reduce(out, 1, keepdims=True)
            change = np.abs(out - messages).max()
            messages += (1 - DAMPING) * (out - messages)
            if change < STILL:
                break
        nodes = nodes + np.stack([np.bincount(target, weights=messages[:, y], minlength=n) for y in range(labels)], 1)
    return np.exp(nodes - np.logaddexp.reduce(nodes, 1, keepdims=True))


def fit_nodes(features: list[list[int]], label: np.ndarray, n: np.ndarray, rounds: int = 150, ridge: float = 1.0) -> np.ndarray:
    """Weights of a multinomial ridge regression of labels on sets of features, by accelerated gradient steps. n: how
    often each example was seen; it counts by its root, as equal tokens are no independent witnesses."""
    weights = np.zeros((FEATURES, LABELS))
    if not len(label):
        return weights
    flat, of = np.array([k for x in features for k in x], dtype=np.int64), np.repeat(np.arange(len(label)), [len(x) for x in features])
    weight, wide = np.sqrt(n.astype(np.float64)), max(map(len, features))
    goal = np.eye(LABELS)[label]
    rate = (1 / (ridge + 0.5 * wide * np.bincount(flat, weights=weight[of], minlength=FEATURES)))[:, None]
    ahead = weights.copy()
    for k in range(rounds):
        z = np.stack([np.bincount(of, weights=ahead[flat, y], minlength=len(label)) for y in range(LABELS)], 1)
        error = (np.exp(z - np.logaddexp.reduce(z, 1, keepdims=True)) - goal) * weight[:, None]
        slope = np.stack([np.bincount(flat, weights=error[of, y], minlength=FEATURES) for y in range(LABELS)], 1) + ridge * ahead
        new = ahead - rate * slope
        ahead, weights = new + k / (k + 3) * (new - weights), new
    return weights


def train(docs: DataFrame, most_examples: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Trained in pieces. Pairs of labels at the two ends of each kind of link are counted in all documents; their
    potentials are what they are likelier than by chance. Node weights are fitted on the distinct examples (features
    and label) of all documents, of which most_examples at most, chosen by hash, reach the driver.

    Labels are what the patterns found. As they miss what the field is for, a token that they didn't find but that is
    linked to one that they did is left out, neither counted nor fitted on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Reader(), Counter()

        def tally() -> pa.RecordBatch:
            keys = list(seen)
            made = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([list(k[1]) for k in keys], pa.list_(pa.int32())), pa.array([seen[k] for k in keys], pa.int64())], ["kind", "what", "n"])
            seen.clear()
            return made

        for batch in batches:
            for _, _, f in reader.fields(batch.column("text")):
                open_ = unsure(f)
                left, right = _lone(f)
                for k, (y, own) in enumerate(zip(f.label, f.features, strict=True)):
                    if k not in open_:
                        seen[-1, (y, *own)] += 1
                        if left[k]:
                            seen[CHAIN, (0, y)] += 1
                        if right[k]:
                            seen[CHAIN, (y, 0)] += 1
                for a, b, kind in f.links:
                    if a not in open_ and b not in open_:
                        seen[kind, (f.label[a], f.label[b])] += 1
                if len(seen) > HELD:
                    yield tally()
        yield tally()

    own = id_and_text(docs, id_col, text_col).select("text")
    counted = own.mapInArrow(lean(count), "kind int, what array<int>, n long").groupBy("kind", "what").agg(F.sum("n").alias("n"))
    counted = counted.orderBy(F.col("kind") < 0, F.xxhash64("what"), "what").limit(4 * LABELS**2 + most_examples)
    rows = counted.collect()  # pairs of labels, and most_examples rows or a few more
    pairs = np.zeros((4, LABELS, LABELS))
    for r in rows:
        if r.kind >= 0:
            pairs[r.kind][tuple(r.what)] += r.n
    examples = [r for r in rows if r.kind < 0]
    chance = (pairs[CHAIN] + ANY) / (pairs[CHAIN] + ANY).sum()
    tables = [np.log(chance / np.outer(chance.sum(1), chance.sum(0)))]
    for kind in (SAME, SUFFIX, NAME):
        n = (pairs[kind] + pairs[kind].T) / 2 + np.where(np.eye(LABELS, dtype=bool), AGREEING, DIFFERING)
        n /= n.sum()
        tables.append(np.log(n / np.outer(n.sum(1), n.sum(0))))
    weights = fit_nodes([r.what[1:] for r in examples], np.array([r.what[0] for r in examples], dtype=np.int64), np.array([r.n for r in examples]))
    return Model(weights, np.stack(tables))


def backed(f: Field) -> list[set[int]]:
    """For each node, the labels of what the patterns found among the tokens that skip links connect it with."""
    parent = list(range(len(f.doc)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a, b, kind in f.links:
        if kind != CHAIN:
            parent[root(b)] = root(a)
    of: dict[int, set[int]] = {}
    for k, y in enumerate(f.label):
        of.setdefault(root(k), set()).update([y] if y else [])
    return [of[root(k)] for k in range(len(f.doc))]


def added(f: Field, p: np.ndarray, least: float) -> list[tuple[int, int, int, int]]:
    """(row, start, kind, end) of nodes that no pattern found, whose label is one of the kinds with a probability of
    `least` or more, and which skip links connect with what the patterns found of that kind: a token's look alone adds
    nothing. Neighbours that are both card or both phone are one span."""
    best = p.argmax(1)
    out: list[list[int]] = []
    last, of = -2, backed(f)
    for k in np.flatnonzero((best > 0) & (p[np.arange(len(best)), best] >= least)).tolist():
        y = int(best[k])
        if f.label[k] or y not in of[k]:
            continue
        if y in LEAST_DIGITS and last == k - 1 and out[-1][4] == y and f.doc[k] == out[-1][0] and f.place[k] == f.place[k - 1] + 1:
            out[-1][2], out[-1][3] = f.end[k], out[-1][3] + f.digits[k]
        else:
            out.append([f.doc[k], f.start[k], f.end[k], f.digits[k], y])
        last = k
    return [(d, a, y - 1, b) for d, a, b, digits, y in out if digits >= LEAST_DIGITS.get(y, 0)]


def _found(docs: DataFrame, model: Model, least: float):
    """A function from a column of texts to each row's base spans and all spans."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES rows of weights

    def make():
        reader, model = Reader(), sent.value

        def find(column: pa.Array) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
            for _, base, f in reader.fields(column):
                every = [set(spans) for spans in base]
                if f.doc:
                    for d, a, kind, b in added(f, model.marginals(f), least):
                        every[d].add((a, kind, b))
                yield from zip(base, map(sorted, every), strict=True)

        return find

    return make


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, least: float = 0.5, most_examples: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n_email, n_ip, n_card, n_phone (base spans of each kind), base_sha256 (of the base spans,
    kind:start:end in code points, by start and kind, joined by commas), spans (all spans, written likewise).

    Base spans are what the patterns find. The field adds tokens that they miss: a number or name that the document
    has elsewhere as part of a base span, in another writing. Null and empty texts
    have none; texts of any length are read whole; of spans at one place, the kinds' order decides. Repeated rows each
    get their row; an empty table gives none; other columns are ignored. Texts aren't shuffled."""
    in_small_batches(docs.sparkSession)
    make = _found(docs, train(docs, most_examples, id_col, text_col), least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for base, every in find(batch.column("text")):
                for k in range(4):
                    out[k].append(sum(x[1] == k for x in base))
                out[4].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out[5].append(_joined(every))
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in out[:4]), *(pa.array(x, pa.string()) for x in out[4:])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[personal]", least: float = 0.5, most_examples: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each maximal run of span characters, base or added, replaced by mark. Null and empty texts, texts
    without spans and other columns stay as they are; repeated rows each stay; an empty table stays empty."""
    in_small_batches(docs.sparkSession)
    make = _found(docs, train(docs, most_examples, id_col, text_col), least)
    names, kind = docs.columns, docs.schema[text_col].dataType
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in names if c != text_col), F.lit(0).alias("_")).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = make()
        for batch in batches:
            texts = []
            for text, (_, every) in zip(batch.column("text").to_pylist(), find(batch.column("text")), strict=True):
                out, done = [], 0
                for a, _, b in every:
                    if b > done:
                        if a >= done:
                            out += [text[done:a], mark]
                        done = b
                texts.append("".join([*out, text[done:]]) if every else text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("kept")], names=["text", "kept"])

    out = rows.mapInArrow(lean(run), rows.schema)
    return out.select(*(F.col("text").cast(kind).alias(c) if c == text_col else F.col(f"kept.`{c}`").alias(c) for c in names))
