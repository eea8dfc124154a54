"""Secret scans: patterns over each text and, by a worklist, over every layer that decoding its parts reveals."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, in_small_batches, lean

KINDS = ("assign", "access", "hex")
KEYWORDS = ("pass", "secret", "token", "api")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
URL_CODE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_CODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Text characters that a decoded layer may consist of; parts of what decodes only in parts have LEAST of them.
PRINTABLE = re.compile(r"[^\x00-\x08\x0e-\x1f\x7f-\x9f\ud800-\udfff\ufffd]+")
LEAST = 12
PARTS = re.compile(PRINTABLE.pattern[:-1] + "{%d,}" % LEAST)
#: What isn't text, where a layer keeps a place for it.
UNREADABLE = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f\ud800-\udfff]")
#: Where a gzip or zlib stream may begin.
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
#: Inflated layers are scanned in pieces of so many bytes, each with the last bytes of the one before it.
PIECE, OVERLAP = 1 << 20, 1 << 16
#: Bytes of a stream that are read at once, so that what only looks like a stream costs no more.
FEED = 1 << 14

#: A part of a code: its start and end there, the text that it stands for, and where each character comes from.
Part = tuple[int, int, str, list[int], list[int]]


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of what the patterns find, sorted."""
    low = text.lower()
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12] if any(k in low for k in KEYWORDS) else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _inflated(data: bytes | memoryview) -> Iterator[str]:
    """What the gzip or zlib streams at the start of data hold, one after another, as texts of bounded size. A stream
    that breaks off gives what comes before."""
    kept, some, view, at = b"", False, memoryview(data), 0
    while at < len(view):
        worker, got, rest = zlib.decompressobj(wbits=47), False, b""
        while worker is not None and not worker.eof:
            if not rest:
                rest = bytes(view[at : at + FEED])
                at += len(rest)
            if not rest:
                break
            try:
                new = worker.decompress(rest, PIECE)
                rest = worker.unconsumed_tail
            except zlib.error:
                new, worker = b"", None
            if new:
                got = some = True
                kept += new
                if len(kept) >= PIECE:
                    yield UNREADABLE.sub("\ufffd", kept.decode(errors="replace"))
                    kept, some = kept[-OVERLAP:], False
        if worker is None or not worker.eof or not got:
            break
        at -= len(worker.unused_data)
        while at < len(view) and not view[at]:  # gzip pads with zeros
            at += 1
    if some:
        yield UNREADABLE.sub("\ufffd", kept.decode(errors="replace"))


def _placed(text: str, start: int, end: int) -> Part:
    """A text of which each character comes from all of the code."""
    return start, end, text, [0] * len(text), [end - start] * len(text)


def _from_base64(code: str) -> tuple[list[Part], list[tuple[int, int, Iterator[str]]]]:
    """Parts that are text: all of the code if that decodes, else what is readable at any of the four alignments; and
    further pieces of streams, with the place of their code."""
    core = code.rstrip("=").translate({45: 43, 95: 47})
    parts: list[Part] = []
    more: list[tuple[int, int, Iterator[str]]] = []
    for k in range(4):
        own = core[k:]
        own = own[: len(own) - (len(own) % 4 == 1)]
        data = base64.b64decode(own + "=" * (-len(own) % 4))
        text = data.decode(errors="surrogateescape")
        if k == 0 and len(core) % 4 != 1 and PRINTABLE.fullmatch(text):
            found = [(0, len(text))]
        else:
            found = [m.span() for m in PARTS.finditer(text)]
        done, at = 0, 0
        for a, b in found:
            at += len(text[done:a].encode(errors="surrogateescape"))
            start, low, high = k + at * 4 // 3, [], []
            for c in text[a:b]:
                end = at + len(c.encode())
                low.append(k + at * 4 // 3 - start)
                high.append(min(len(code), k - (-end * 4 // 3)) - start)
                at = end
            whole = len(found) == 1 and b - a == len(text) and k == 0
            parts.append((start, len(code) if whole else start + high[-1], text[a:b], low, high))
            done = b
        if found and k == 0 and found[0] == (0, len(text)):
            break
        end = 0
        for m in PACKED.finditer(data):
            if m.start() < end:
                continue
            pieces = _inflated(memoryview(data)[m.start() :])
            first = next(pieces, None)
            if first is not None and PARTS.search(first):
                start = k + m.start() * 4 // 3
                parts.append(_placed(first, start, len(code)))
                end = len(data)  # its streams have been followed to their end
                more.append((start, len(code), pieces))
            elif first is not None:
                more.append((k + m.start() * 4 // 3, len(code), pieces))
    return parts, more


def _from_url(code: str) -> tuple[list[Part], list]:
    """What isn't text has a place of its own in the layer."""
    text = bytes.fromhex(code.replace("%", "")).decode(errors="surrogateescape")
    if not PRINTABLE.search(text):
        return [], []
    ends = np.cumsum([3 * len(c.encode(errors="surrogateescape")) for c in text]).tolist()
    return [(0, len(code), UNREADABLE.sub("\ufffd", text), [0, *ends[:-1]], ends)], []


def _from_unicode(code: str) -> tuple[list[Part], list]:
    width = 6 if code[1] == "u" else 4
    units = "".join(chr(int(code[i + 2 : i + width], 16)) for i in range(0, len(code), width))
    text = re.sub("[\ud800-\udbff][\udc00-\udfff]", lambda m: m[0].encode("utf-16", "surrogatepass").decode("utf-16"), units)
    ends = np.cumsum([width * (2 if ord(c) > 0xFFFF else 1) for c in text]).tolist()
    return [(0, len(code), UNREADABLE.sub("\ufffd", text), [0, *ends[:-1]], ends)], []


DECODERS = ((URL_CODE, "%", _from_url), (UNICODE_CODE, "\\", _from_unicode), (BASE64, "", _from_base64))


def _digest(text: str) -> bytes:
    return hashlib.sha1(text.encode(errors="surrogatepass")).digest()


def layers(text: str) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Every layer below text, with the places in text that its characters come from. A layer is its parent with all
    parts of one coding decoded in place, so that what stands around them is still there; parts that overlap others
    and further pieces of large streams are layers by themselves. Each new layer is put on the worklist; one that has
    been seen, at any depth, isn't, so cycles end and the fixpoint is reached."""
    seen = {_digest(text)}
    work: list[tuple[Iterator[str], np.ndarray | None, np.ndarray | None]] = [(iter([text]), None, None)]
    while work:
        texts, low, high = work[-1]
        own = next(texts, None)
        if own is None:
            work.pop()
            continue
        if len(work) > 1:
            if _digest(own) in seen:
                continue
            seen.add(_digest(own))
            if len(low) != len(own):  # a piece: all of it comes from all of the code
                low, high = np.full(len(own), low[0]), np.full(len(own), high[0])
            yield own, low, high
        new: list[tuple[Iterator[str], np.ndarray, np.ndarray]] = []
        for pattern, mark, decode in DECODERS:
            if mark and mark not in own:
                continue
            parts, lows, highs, done = [], [], [], 0
            for m in pattern.finditer(own):
                found, more = decode(m[0])
                for start, end, t, a, b in sorted(found, key=lambda x: (x[0], -x[1])):
                    x, y = m.start() + start, m.start() + end
                    first, last = np.array(a, dtype=np.int64) + x, np.array(b, dtype=np.int64) + x - 1
                    if x < done:
                        new.append((iter([t]), *_up(first, last, low, high)))
                        continue
                    parts += [own[done:x], t]
                    lows += [np.arange(done, x), first]
                    highs += [np.arange(done, x), last]
                    done = y
                for start, end, pieces in more:
                    new.append((pieces, *_up(np.array([m.start() + start]), np.array([m.start() + end - 1]), low, high)))
            if parts:
                first, last = (np.concatenate([*x, np.arange(done, len(own))]).astype(np.int64) for x in (lows, highs))
                new.append((iter(["".join([*parts, own[done:]])]), *_up(first, last, low, high)))
        work += new


def _up(first: np.ndarray, last: np.ndarray, low: np.ndarray | None, high: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of the text that each comes from, by those of the parent."""
    return (first, last) if low is None else (low[first], high[last])


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans of text, and all spans: those and what its layers add, mapped to text."""
    base = spans(text)
    found = set(base)
    # base spans of a kind are disjoint, so the last one that begins early enough is the only one that may hold a find
    starts, ends = ([[x[i] for x in base if x[1] == k] for k in range(len(KINDS))] for i in (0, 2))
    for own, low, high in layers(text):
        for start, kind, end in spans(own):
            a, b = int(low[start]), int(high[end - 1]) + 1
            # the undecoded surroundings give the same finds again; a find within a base span of its kind is no news
            i = bisect_right(starts[kind], a)
            if not i or ends[kind][i - 1] < b:
                found.add((a, kind, b))
    return base, sorted(found)


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n_assign, n_access, n_hex (base spans of each kind), base_sha256 (of the base spans,
    kind:start:end in code points, by start and kind, joined by commas), spans (all spans, written likewise).

    Base spans are what the patterns find in the text itself; further ones come from nested layers: URL escapes,
    Unicode escapes, base64 and, within it, gzip or zlib. Null and empty texts have none; texts of any length are read
    whole; of spans at one place, the kinds' order decides. Repeated rows each get their row; an empty table gives
    none; other columns are ignored; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column("text"):
                base, every = find(text.as_py() or "")
                for k in range(3):
                    out[k].append(sum(x[1] == k for x in base))
                out[3].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out[4].append(_joined(every))
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in out[:3]), *(pa.array(x, pa.string()) for x in out[3:])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[secret]", text_col: str = "text") -> DataFrame:
    """docs with each maximal run of span characters, base or from a layer, replaced by mark. Nulls, texts without
    spans and other columns stay as they are; texts of any length are read whole; spans that overlap are one run.
    Repeated rows each stay; an empty table stays empty."""

    def cut(text: str) -> str:
        out, done = [], 0
        for a, _, b in find(text)[1]:
            if b > done:
                if a >= done:
                    out += [text[done:a], mark]
                done = b
        return "".join([*out, text[done:]])

    in_small_batches(docs.sparkSession)
    names, kind = docs.columns, docs.schema[text_col].dataType
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in names if c != text_col), F.lit(0).alias("_")).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else cut(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("kept")], names=["text", "kept"])

    out = rows.mapInArrow(lean(run), rows.schema)
    return out.select(*(F.col("text").cast(kind).alias(c) if c == text_col else F.col(f"kept.`{c}`").alias(c) for c in names))
