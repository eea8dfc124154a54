"""Fill-in-middle: texts are cut at two ranks of units, found in an indexable skip list, and their parts are put in
another order between sentinels, from which the text can be rebuilt."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, id_and_text, in_small_batches, mix, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: One node in so many of a lane is on the lane above it too.
SPARSE = 4


class SkipList:
    """An indexable skip list over the units of one text. Each lane's link carries two widths, how many units and how
    many code points it passes, so that a walk down the lanes that adds widths up ends at a rank of units and knows
    its place in code points. Which nodes are on a lane is decided by a hash of their rank: the same list every time."""

    def __init__(self, points: np.ndarray) -> None:
        """points: code points of each unit, in order."""
        ranks, units, points = np.arange(len(points)), np.ones(len(points), dtype=np.int64), points.astype(np.int64)
        #: of each lane, from the lowest: widths of the links into its nodes, and where each node is on the lane below
        self.lanes: list[tuple[list[int], list[int], list[int]]] = []
        below = ranks
        while len(ranks):
            self.lanes.append((units.tolist(), points.tolist(), below.tolist()))
            below = np.flatnonzero(mix((ranks + (len(self.lanes) << 40)).astype(np.uint64)) % np.uint64(SPARSE) == 0)
            if not len(below):
                break
            # a link of the next lane passes what the links of this one pass up to its node
            first, end = np.concatenate([[0], below[:-1] + 1]), below[-1] + 1
            units, points, ranks = np.add.reduceat(units[:end], first), np.add.reduceat(points[:end], first), ranks[below]

    def locate(self, rank: int) -> int:
        """Code points of the first `rank` units."""
        at, passed, place = -1, 0, 0
        for k in range(len(self.lanes) - 1, -1, -1):
            units, points, below = self.lanes[k]
            while at + 1 < len(units) and passed + units[at + 1] <= rank:
                at += 1
                passed += units[at]
                place += points[at]
            if k and at >= 0:
                at = below[at]
        return place


def units(raw: np.ndarray) -> np.ndarray:
    """Code points of each unit of UTF-8 bytes: white space with the word after it; white space at the end is one too."""
    word = NOT_SPACE[raw]
    last = np.flatnonzero(word & ~np.append(word[1:], False))
    if len(raw) and not word[-1]:
        last = np.append(last, len(raw) - 1)
    if not len(last):
        return np.zeros(0, dtype=np.int64)
    return np.add.reduceat((raw & 0xC0 != 0x80).astype(np.int64), np.concatenate([[0], last[:-1] + 1]))


def form(parts: tuple[str, str, str], how: str) -> str:
    """prefix, middle and suffix in the order of a form."""
    prefix, middle, suffix = parts
    if how == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def transform(docs: DataFrame, percent: int = 50, spm_percent: int = 80, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (code points; null if plain),
    output (the text in its new order).

    Numbers h1 to h4 are the first four groups of eight hex digits of the sha256 of "seed:id". The text is cut after
    the smaller and the larger of h1 % (n + 1) and h2 % (n + 1) units; it stays plain for h3 % 100 >= percent, else it
    is spm for h4 % 100 < spm_percent. Cuts at one rank leave an empty middle.

    Null and empty texts have no units and stay plain (null as empty), as do texts that hold a sentinel. A null id
    counts as the empty text after "seed:". Repeated rows each get their row, equal ids the same numbers; an empty
    table gives none; other columns are ignored. Texts of any length are cut whole; nothing is shuffled."""
    in_small_batches(docs.sparkSession)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = F.array(*(F.conv(F.substring("hash_", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)))
    own = id_and_text(docs, id_col, text_col).withColumn("hash_", hashed).select("doc_id", "text", numbers.alias("numbers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8(batch.column("text"))
            draws = np.asarray(batch.column("numbers").flatten()).reshape(-1, 4).tolist()
            out: list[list] = [[], [], [], [], []]
            for k, (text, (h1, h2, h3, h4)) in enumerate(zip(batch.column("text"), draws, strict=True)):
                text, widths = text.as_py() or "", units(raw[at[k] : at[k + 1]])
                n = len(widths)
                if not text or h3 % 100 >= percent or any(s in text for s in SENTINELS):
                    row = (n, "plain", None, None, text)
                else:
                    list_, (low, high) = SkipList(widths), sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = list_.locate(low), list_.locate(high)
                    how = "spm" if h4 % 100 < spm_percent else "psm"
                    row = (n, how, a, b - a, form((text[:a], text[a:b], text[b:]), how))
                for x, v in zip(out, row, strict=True):
                    x.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return own.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, how: Column) -> Column:
    """The text that transform() made output from. No sentinel is in the parts, and none can come about where parts
    meet, so each one's first place is where transform() put it."""
    part = lambda a, b: F.substring(output, a, b - a)
    p, s, m = (F.instr(output, x) for x in SENTINELS)
    psm = F.concat(part(p + 3, s), F.substring(output, m + 3, F.length(output)), part(s + 3, m))
    spm = F.concat(part(p + 3, m), F.substring(output, m + 3, F.length(output)), part(s + 3, p))
    return F.when(how == "psm", psm).when(how == "spm", spm).otherwise(output)
