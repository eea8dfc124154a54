"""Toxicity: a noisy-channel decoder restores disguised words, and a classifier scores the restored text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, id_and_text, in_small_batches, lean

LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"
#: Character codes: 0 is a word's border (anything but letters), the last all other letters.
CODE = {c: k + 1 for k, c in enumerate(LETTERS)}
OTHER, SIZE = len(LETTERS) + 1, len(LETTERS) + 2
#: Codes of code points; the last entry stands for all beyond Latin letters.
POINTS = np.array([CODE.get(chr(k), OTHER if chr(k).isalpha() else 0) for k in range(0x250)] + [OTHER], dtype=np.int64)
#: What each sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
#: What a star may stand for: the first letters of LETTERS.
WILDCARD = LETTERS[:26]
SEPARATORS = " .-_*'~/\\"
#: Log-probabilities of what the channel does: a sign for a letter, any of the letters a wildcard may be, a stretched
#: letter, a separator put into a word; and of a sign that is no letter at all.
SIGN, WILD, STRETCH, SPLIT, KEEP = -1.5, -3.0, -1.0, -1.0, -4.0
#: What a token with a letter is decoded for: a sign, separators between letters or digits, a stretched letter.
NOISE = re.compile(r"[0-9@$!|+€£(*]|[^\W_][.\-_'~/\\]+[^\W_]|([^\W\d_])\1\1")
LETTER = re.compile(r"[^\W\d_]")
#: Letters, digits and signs that stand alone; a long run is decoded in windows that overlap.
SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|+€£(])(?:[ .\-_*]{1,3}(?:[^\W_]|[@$!|+€£(])){2,}(?![^\W_])")
WINDOW, OVERLAP = 256, 96
GAP = re.compile(r"[ .\-_*]+")
WORD = re.compile(r"[^\W\d_]+")
STRETCHED = re.compile(r"(.)\1\1")
PUNCTUATION = ".,;:!?\"'()[]{}«»„“”…"
BEGINNINGS = (3, 4, 5, 6)
CACHE = 100_000
#: Tables of a few letters (some 0.4 MB each) that a model keeps.
PARTS = 64
#: Ends of tokens, from the first star on, that a model keeps what follows a state for: how long, after how many states
#: at most, and how many of them.
SHORT_TAIL, FEW_STATES, TAILS = 16, 8, 50_000
#: Features' names that a task counts before it hands them on.
HELD_NAMES = 1 << 17
#: Less than any path's log-probability.
NEVER = np.float32(-1e30)
#: Log-odds of every text where labels of one kind or none teach nothing.
UNTAUGHT = -4.0


class CharacterModel:
    """Trigrams of letters within words, from all documents."""

    def __init__(self, counts: np.ndarray) -> None:
        n = counts.reshape(SIZE, SIZE, SIZE)
        # two letters' context falls back on one letter's, that on no context
        one = n.sum((0, 1)) + 0.5
        one /= one.sum()
        two = n.sum(0)
        two = (two + 20 * one) / (two.sum(1, keepdims=True) + 20)
        three = (n + 10 * two) / (n.sum(2, keepdims=True) + 10)
        self._take(np.log(three).astype(np.float32))

    def _take(self, table: np.ndarray) -> None:
        self.table = table
        self.log = self.table.reshape(SIZE * SIZE, SIZE).tolist()
        self.tails: dict[tuple, tuple[float, list[str]]] = {}
        self._parts: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def part(self, codes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-probabilities among these codes (0 and the stars' letters first), of words that end, and of stars."""
        found = self._parts.get(codes)
        if found is None:
            if len(self._parts) >= PARTS:
                self._parts.clear()
            table = self.table[np.ix_(codes, codes, codes)].astype(np.float64)
            ends = np.where(np.arange(len(codes)) > 0, table[:, :, 0], 0.0)
            found = self._parts[codes] = table, ends, np.ascontiguousarray(table[:, :, 1 : len(WILDCARD) + 1].transpose(1, 2, 0))
        return found

    def __getstate__(self) -> np.ndarray:
        return self.table

    def __setstate__(self, table: np.ndarray) -> None:
        self._take(table)


def trigrams(text: str, counts: np.ndarray) -> None:
    """Adds the trigrams within the words of a lower-case text; before a word stand two borders, after it one."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    own = np.r_[0, 0, POINTS[np.minimum(points, len(POINTS) - 1)], 0]
    b, c = own[1:-1], own[2:]
    a = np.where(b > 0, own[:-2], 0)
    counts += np.bincount(((a * SIZE + b) * SIZE + c)[(b > 0) | (c > 0)], minlength=len(counts))


def runs(text: str) -> list[int]:
    """For each place, where the run of its character ends."""
    out = list(range(1, len(text) + 1))
    for i in range(len(text) - 2, -1, -1):
        if text[i] == text[i + 1]:
            out[i] = out[i + 1]
    return out


def _code(c: str) -> int:
    return CODE.get(c) or (OTHER if c.isalpha() else 0)


class Sparse:
    """The best path to each state (the last two letters) at every place of a token without stars: a few states a
    place, from a * SIZE + b to (value, way)."""

    def __init__(self, model: CharacterModel, places: int) -> None:
        self.log, self.states = model.log, [{} for _ in range(places)]
        self.states[0][0] = (0.0, None)

    def _reach(self, to: int, key: int, value: float, way: tuple | None) -> None:
        old = self.states[to].get(key)
        if old is None or old[0] < value:
            self.states[to][key] = (value, way)

    def letters(self, at: int, to: int, text: str, codes: tuple[int, ...], cost: float) -> None:
        for key, (value, way) in self.states[at].items():
            value += cost
            for k in codes:
                value += self.log[key][k]
                key = key % SIZE * SIZE + k
            self._reach(to, key, value, (way, text))

    def skip(self, at: int, to: int, cost: float) -> None:
        for key, (value, way) in self.states[at].items():
            self._reach(to, key, value + cost, way)

    def _ended(self, at: int) -> tuple[float, tuple | None]:
        return max(((v + (self.log[key][0] if key % SIZE else 0.0), w) for key, (v, w) in self.states[at].items()), key=lambda s: s[0])

    def border(self, at: int, to: int, cost: float) -> None:
        value, way = self._ended(at)
        self._reach(to, 0, value + cost, (way, " "))

    def leave(self, at: int) -> None:
        """Nothing begins at this place any more."""
        self.states[at] = {}

    def reached(self, at: int) -> bool:
        return bool(self.states[at])

    def read(self) -> str:
        return "".join(_said(self._ended(len(self.states) - 1)[1]))


def _said(way: tuple | None) -> list[str]:
    """The texts of a way, first to last."""
    out = []
    while way:
        way, text = way
        out.append(text)
    return out[::-1]


class Dense:
    """The same where stars make every pair of letters a state: one table of values a place, into which each arc that
    ends there is merged at once, and for each state the arc it came by and the state before. So work is a table an
    arc and memory a table a place, whatever the order of stars and separators. Only letters that the token may hold
    are in the tables."""

    def __init__(self, model: CharacterModel, text: str, prefix: dict[int, tuple[float, tuple | None]]) -> None:
        """text: from the first star on. prefix: the states that what comes ahead of it reaches."""
        self.prefix = prefix
        meant = {CODE[x] for c in set(text) for x in SIGNS.get(c, "")}
        reached = {k for key in self.prefix for k in divmod(key, SIZE)}
        self.codes = tuple(sorted({0, *range(1, len(WILDCARD) + 1), *map(_code, text), *meant, *reached}))
        self.place = {k: i for i, k in enumerate(self.codes)}
        self.table, self.ends, self.wild = model.part(self.codes)
        m, places = len(self.codes), len(text) + 1
        self.rows, self.stars = np.arange(m), np.arange(len(WILDCARD))
        self.values: list[np.ndarray | None] = [None] * places
        self.before: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * places
        #: of each place, the arcs that end there: where they begin, and their text (None: the letter of the state)
        self.arcs: list[list[tuple[int, str | None]]] = [[] for _ in range(places)]
        start = self._open(0)
        for key, (value, _) in self.prefix.items():
            start[self.place[key // SIZE], self.place[key % SIZE]] = value

    def _open(self, to: int) -> np.ndarray:
        if self.values[to] is None:
            m = len(self.codes)
            self.values[to] = np.full((m, m), float(NEVER))
            self.before[to] = (np.zeros((m, m), dtype=np.uint8), np.zeros((m, m), dtype=np.uint8), np.zeros((m, m), dtype=np.int32))
        return self.values[to]

    def _merge(self, at: int, to: int, text: str | None, part: tuple, value, a, b) -> None:
        """part: which states of the place get value, if it is more than theirs, from the states (a, b)."""
        if self.values[to] is None:
            # the first arc to a place needs no comparison
            self._open(to)[part] = value
            rows, columns, arc = self.before[to]
            rows[part], columns[part] = a, b
        else:
            own = self.values[to][part]
            better = value > own
            if not np.any(better):
                return
            for table, new in zip((self.values[to], *self.before[to]), (value, a, b, len(self.arcs[to])), strict=True):
                table[part] = np.where(better, new, table[part])
        self.arcs[to].append((at, text))

    def letters(self, at: int, to: int, text: str, codes: tuple[int, ...], cost: float) -> None:
        k = self.place[codes[0]]
        every = self.values[at] + self.table[:, :, k]
        best = every.argmax(0)
        value = every[best, self.rows] + cost
        if len(codes) == 1:
            self._merge(at, to, text, (slice(None), k), value, best, self.rows)
        else:
            value = value + self.table[:, k, self.place[codes[1]]]
            b = int(value.argmax())
            self._merge(at, to, text, (k, self.place[codes[1]]), value[b], best[b], b)

    def star(self, at: int, to: int) -> None:
        own = self.values[at]
        # behind the first stars only few letters stand two places back
        live = np.flatnonzero(own.max(1) > NEVER / 2)
        ends = np.flatnonzero(own[live].max(0) > NEVER / 2)
        every = own[np.ix_(live, ends)].T[:, None, :] + self.wild[np.ix_(ends, self.stars, live)]
        best = every.argmax(2)
        self._merge(at, to, None, np.ix_(ends, self.stars + 1), every.max(2) + WILD, live[best], ends[:, None])

    def skip(self, at: int, to: int, cost: float) -> None:
        self._merge(at, to, "", (slice(None), slice(None)), self.values[at] + cost, self.rows[:, None], self.rows)

    def _ended(self, at: int) -> tuple[int, int, float]:
        every = self.values[at] + self.ends
        a, b = divmod(int(every.argmax()), len(self.codes))
        return a, b, float(every[a, b])

    def border(self, at: int, to: int, cost: float) -> None:
        a, b, value = self._ended(at)
        self._merge(at, to, " ", (0, 0), value + cost, a, b)

    def leave(self, at: int) -> None:
        """Nothing begins at this place any more."""
        self.values[at] = None

    def reached(self, at: int) -> bool:
        return self.values[at] is not None

    def read(self) -> tuple[float, list[str]]:
        """The best value at the end and the texts of its path, those of its prefix included."""
        at, out = len(self.values) - 1, []
        a, b, value = self._ended(at)
        while at:
            rows, columns, arc = self.before[at]
            start, text = self.arcs[at][arc[a, b]]
            out.append(WILDCARD[b - 1] if text is None else text)
            at, a, b = start, int(rows[a, b]), int(columns[a, b])
        return value, [*_said(self.prefix[self.codes[a] * SIZE + self.codes[b]][1]), *reversed(out)]


def decode(observed: str, model: CharacterModel) -> str:
    """Viterbi over the lattice of what the characters may stand for: the likeliest text by channel and model. States
    are the last two letters; none is left out, so the path is the best there is."""
    # between letters that all stand alone, separators are likelier to be noise
    split, keep = (-0.1, -2.0) if SPACED.fullmatch(observed) else (SPLIT, -0.5)
    star = observed.find("*")
    few = Sparse(model, (star if star >= 0 else len(observed)) + 1)
    _walked(few, observed if star < 0 else observed[:star], True, split, keep)
    if star < 0:
        return few.read()
    tail, reached = observed[star:], few.states[-1]
    if len(tail) > SHORT_TAIL or len(reached) > FEW_STATES:
        return "".join(_starred(model, tail, not star, split, keep, reached)[1])
    # what follows depends on the state alone, and the same ends are met again and again
    ways = []
    for key, (value, way) in reached.items():
        at = (key, tail, not star, split)
        if at not in model.tails:
            if len(model.tails) >= TAILS:
                model.tails.clear()
            model.tails[at] = _starred(model, tail, not star, split, keep, {key: (0.0, None)})
        more, texts = model.tails[at]
        ways.append((value + more, way, texts))
    _, way, texts = max(ways, key=lambda x: x[0])
    return "".join([*_said(way), *texts])


def _starred(model: CharacterModel, tail: str, begins: bool, split: float, keep: float, reached: dict) -> tuple[float, list[str]]:
    paths = Dense(model, tail, reached)
    _walked(paths, tail, begins, split, keep)
    return paths.read()


def _walked(paths: Sparse | Dense, text: str, begins: bool, split: float, keep: float) -> None:
    """All arcs of a text, which is a token or begins at its first star; begins: nothing comes before it. No run of one
    character goes beyond the text."""
    for at, (c, run) in enumerate(zip(text, runs(text), strict=True)):
        if not paths.reached(at):
            continue
        k = _code(c)
        if k:
            paths.letters(at, at + 1, c, (k,), 0.0)
            if run - at >= 3:
                paths.letters(at, run, c, (k,), STRETCH)
                paths.letters(at, run, c + c, (k, k), STRETCH - 1.0)
        else:
            if c == "*":
                paths.star(at, at + 1)
            for x in SIGNS.get(c, ""):
                paths.letters(at, at + 1, x, (CODE[x],), SIGN)
            if c in SEPARATORS and (at or not begins):
                paths.skip(at, run, split)
            paths.border(at, at + 1, keep if c in SEPARATORS else KEEP)
        paths.leave(at)


def parts(word: str) -> list[str]:
    """A word's features: itself and its beginnings."""
    return [word + "$", *(word[:k] for k in BEGINNINGS if len(word) > k)]


def windows(run: str) -> Iterator[str]:
    """A run of letters that stand alone, in windows: no word of up to OVERLAP signs and gaps is cut in all of them. Where
    gaps differ, what the wider ones part is given too."""
    for a in range(0, max(1, len(run) - OVERLAP), WINDOW - OVERLAP):
        yield run[a : a + WINDOW].strip(SEPARATORS)
    gaps = [len(g) for g in GAP.findall(run)]
    if min(gaps) < max(gaps):
        for part in re.split(r"[ .\-_*]{%d,}" % (min(gaps) + 1), run):
            if len(part) > 4:
                for a in range(0, max(1, len(part) - OVERLAP), WINDOW - OVERLAP):
                    yield part[a : a + WINDOW].strip(SEPARATORS)


class Reader:
    """The features of texts: words as written, and what tokens with signs, separators or stretched letters, and runs
    of spaced letters, are restored to. Tokens are cached, as most are met again."""

    def __init__(self, model: CharacterModel, chosen: dict[str, int] | None) -> None:
        self.model, self.chosen, self.cache = model, chosen, {}

    def token(self, token: str) -> tuple:
        """The features of a token that isn't in the cache."""
        core = token.strip(PUNCTUATION)
        if core.isalpha() and not STRETCHED.search(core) and not NOISE.search(token):
            own = [core]
        else:
            own = WORD.findall(token)
            if LETTER.search(token):
                # closing and opening punctuation may be letters' signs ('naz!') or not ('hat3!')
                for seen in {token, core}:
                    if NOISE.search(seen) or SPACED.fullmatch(seen):
                        own += WORD.findall(decode(seen, self.model))
        if self.chosen is None:
            found = tuple({p for w in own for p in parts(w)})
        else:
            get = self.chosen.get
            found = tuple({k for w in own for k in (get(w + "$"), *(get(w[:n]) for n in BEGINNINGS if len(w) > n)) if k is not None})
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[token] = found
        return found

    def features(self, text: str) -> set:
        text = text.lower()
        tokens = set(text.split())
        for m in SPACED.finditer(text):
            tokens.update(windows(m[0]))
        out: set = set()
        get, update = self.cache.get, out.update
        for t in tokens:
            found = get(t)
            if found is None:
                found = self.token(t)
            if found:
                update(found)
        return out


class Scorer:
    def __init__(self, model: CharacterModel, chosen: dict[str, int], weights: np.ndarray, intercept: float) -> None:
        self.reader, self.weights, self.intercept = Reader(model, chosen), weights, intercept

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = [self.intercept + sum(self.weights[k] for k in sorted(self.reader.features(t.as_py() or ""))) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(z, dtype=np.float64), -500, 500)))


def fit_logistic(indices: list[list[int]], y: np.ndarray, size: int, rounds: int = 400, ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression on sets of features, by accelerated gradient steps."""
    flat = np.array([k for x in indices for k in x], dtype=np.int64)
    of = np.repeat(np.arange(len(y)), [len(x) for x in indices])
    most = max(1, max((len(x) for x in indices), default=1)) + 1
    w, b = np.zeros(size), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    rate = 4 / np.maximum(np.bincount(flat, minlength=size) * min(most, 12), 1) + 0.0
    rate_b, v, vb = 4 / (len(y) * 12), w.copy(), b
    for k in range(rounds):
        z = np.bincount(of, weights=v[flat], minlength=len(y)) + vb
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        new = v - rate * (np.bincount(flat, weights=error[of], minlength=size) + ridge * v)
        new_b = vb - rate_b * error.sum()
        m = k / (k + 3)
        v, vb, w, b = new + m * (new - w), new_b + m * (new_b - b), new, new_b
    return w, b


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, most_features: int = 3_000, folds: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> tuple[CharacterModel, dict[str, int], np.ndarray, float]:
    """The character model, from all documents; the chosen features, their weights and the intercept, from labelled
    rows whose crc32(id) modulo folds isn't `fold`: about most_labelled of these at most, chosen by hash of the id. A
    feature is chosen by how unlikely its numbers of toxic and other texts are if it had nothing to do with labels."""
    spark = docs.sparkSession
    in_small_batches(spark)
    own = id_and_text(docs, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE**3, dtype=np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column("text"):
                held.append((text.as_py() or "").lower())
                size += len(held[-1])
                if size > 1 << 18:
                    trigrams(" ".join(held), counts)
                    held, size = [], 0
            trigrams(" ".join(held), counts)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], ["k", "n"])

    rows = own.mapInArrow(lean(count), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()  # SIZE ** 3 at most
    counts = np.zeros(SIZE**3)
    counts[[r.k for r in rows]] = [r.n for r in rows]
    model = CharacterModel(counts)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(crc_mod("doc_id", folds) != fold)
    n = known.count()
    share = min(1.0, most_labelled / max(n, 1))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1)).limit(2 * most_labelled)
    # at most twice most_labelled rows are sent to all executors
    texts = own.where(crc_mod("doc_id", folds) != fold).join(F.broadcast(known), "doc_id").select("text", "toxic")
    sent = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, tallies = Reader(sent.value, None), (Counter(), Counter())

        def tally() -> pa.RecordBatch:
            names = list(tallies[0].keys() | tallies[1].keys())
            made = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([t[x] for x in names], pa.int64()) for t in tallies)], ["name", "clean", "toxic"])
            for t in tallies:
                t.clear()
            return made

        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                tallies[int(y > 0)].update(reader.features(text.as_py() or ""))
                if len(tallies[0]) + len(tallies[1]) > HELD_NAMES:
                    yield tally()
        yield tally()

    totals = texts.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).head()
    bad, good = totals[0], totals[1]
    if not bad or not good:
        return model, {}, np.zeros(0), UNTAUGHT
    p = bad / (bad + good)
    tally = texts.mapInArrow(lean(features), "name string, clean long, toxic long").groupBy("name").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both = F.col("clean") + F.col("toxic")
    part = lambda x, q: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / (both * q))).otherwise(0.0)
    ranked = tally.where(both >= 4).withColumn("gain", part("toxic", p) + part("clean", 1 - p)).where("gain > 8")
    chosen = {r.name: k for k, r in enumerate(ranked.orderBy(F.desc("gain"), "name").limit(most_features).select("name").collect())}

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value, chosen)
        for batch in batches:
            found = [sorted(reader.features(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column("toxic")], ["found", "toxic"])

    fit = texts.mapInArrow(lean(sets), "found array<int>, toxic int").toArrow()
    w, b = fit_logistic(fit.column("found").to_pylist(), (fit.column("toxic").to_numpy() > 0).astype(float), len(chosen))
    return model, chosen, w, b


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """For each row: doc_id, held_out (crc32 of the id's text modulo folds is `fold`), score (0 to 1, the probability
    of the label toxic), predicted (1 from threshold up). Only texts are inputs; labels of held-out rows aren't used.

    Null and empty texts get the score of a text without features. Several labels of one id count as the greatest;
    null ids and null labels teach nothing; without labels of both kinds nothing is learned and all rows score 0.018.
    Repeated rows each get their row; an empty table gives none; other columns are ignored. Texts aren't shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds=folds, fold=fold, id_col=id_col, text_col=text_col, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            p = scorer.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    own = id_and_text(docs, id_col, text_col).withColumn("held_out", crc_mod("doc_id", folds) == fold)
    return own.mapInArrow(lean(run), "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all their columns, that score() predicts 0 for; those at the threshold go. Null and empty
    texts are scored as texts without features, repeated rows and ids each by their own text; an empty table stays
    empty; without labels of both kinds all rows stay."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch.column(text_col)) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)
