"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. Runs of one symbol become one symbol; then
deterministic coin tossing gives each symbol a label of its left neighbour's
and its own name (the lowest bit in which they differ, and its value there),
four times over, which leaves six labels. A phrase starts at every local
maximum, so it has two to eleven symbols, and its name, a hash of the names
inside, is a symbol of the next level. Where a phrase starts depends on five
symbols before it and one behind, so equal substrings get the same names
inside, whatever stands around them.

A fingerprint holds the ``KEPT`` smallest ranks of a text's names on levels 1
to ``LEVELS``; a rank is a hash divided by the phrase's length and its level's
weight, so that the share of ranks that two texts have in common estimates the
share of text. A text's fingerprint depends on the text alone.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayline.llm.common import materialize, small, tidy

KEPT = 64
LEVELS = 5
WEIGHTS = (0, 1, 2, 4, 4, 4)   # by level: short phrases are common to many texts
BATCH = 1 << 16                # characters parsed at once, one text at least
WINDOW = 1 << 20               # symbols labelled at once
MARGIN = 16                    # more than a label depends on
CHARS = 1 << 22                # characters of a part of the id range, about
PARTS = 8192                   # at most; a task reads its part as a stream
SAMPLE = 32                    # sampled ids per part, for the parts' bounds
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd factors by place in a phrase, which holds eleven symbols at most.
_FACTORS = mix(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


def _toss_table() -> np.ndarray:
    """Label of (own, left) for labels below 64."""
    own, left = np.meshgrid(np.arange(64), np.arange(64), indexing="ij")
    differ = own ^ left
    at = np.bitwise_count((differ & -differ) - 1).astype(np.int64)
    return np.where(differ == 0, 0, 2 * at + ((own >> np.minimum(at, 5)) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def _before(x: np.ndarray, heads: np.ndarray, at_heads) -> np.ndarray:
    """Each symbol's left neighbour; the first of a text has none."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[heads] = at_heads
    return out


def _starts(sym: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases start; neighbours of one text are different symbols."""
    heads = np.flatnonzero(first)
    heads = heads if len(heads) and heads[0] == 0 else np.r_[0, heads]  # a window may start inside a text
    low = sym.astype(np.uint32)
    differ = low ^ _before(low, heads, low[heads] ^ np.uint32(1))
    differ &= ~differ + np.uint32(1)
    label = np.minimum(np.bitwise_count(differ - np.uint32(1)), 31).astype(np.uint8)
    label = 2 * label + ((low & differ) != 0)
    for _ in range(3):
        label = _TOSS[(label.astype(np.uint16) << 6) | _before(label, heads, label[heads] ^ 1)]
    label += 1
    after = np.empty_like(label)
    after[:-1] = label[1:]
    after[heads - 1] = 0  # the last of a text; of all, at -1
    top = (label > _before(label, heads, 0)) & (label > after)
    top[np.minimum(heads + 1, len(top) - 1)] = False  # no phrase of the first symbol alone
    return top | first


def starts(sym: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``_starts`` in windows, so that memory beside the symbols is bounded."""
    if len(sym) <= WINDOW:
        return _starts(sym, first)
    out = np.zeros(len(sym), bool)
    for a in range(0, len(sym), WINDOW):
        low, b = max(0, a - MARGIN), min(len(sym), a + WINDOW)
        high = min(len(sym), b + MARGIN)
        out[a:b] = _starts(sym[low:high], first[low:high])[a - low:b - low]
    return out


def phrases(codes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple]:
    """(level, text, name, length) arrays of the phrases of texts given as
    code points in a row."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    sym, pos = codes.astype(np.uint64), np.arange(len(codes))
    ends = np.cumsum(lengths)
    for level in range(1, LEVELS + 1):
        # Runs of one symbol.
        new = np.flatnonzero(np.r_[True, (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])]) if len(sym) else np.zeros(0, int)
        times = np.diff(np.r_[new, len(sym)]).astype(np.uint64)
        sym, doc, pos = sym[new], doc[new], pos[new]
        long = np.flatnonzero(times > 1)
        sym[long] = mix(sym[long] * _ODD + times[long])
        first = np.r_[True, doc[1:] != doc[:-1]] if len(sym) else np.zeros(0, bool)
        alone = first & np.roll(first, -1)
        if level == 1 and alone.any():
            yield 1, doc[alone], mix(sym[alone]), (ends[doc] - pos)[alone]
        sym, doc, pos, first = (x[~alone] for x in (sym, doc, pos, first))
        if not len(sym):
            return
        at = np.flatnonzero(starts(sym, first))
        held = np.diff(np.r_[at, len(sym)])
        sym = (sym + _ODD) * _FACTORS[(np.arange(len(sym)) - np.repeat(at, held)) % len(_FACTORS)]
        sym ^= sym >> np.uint64(32)
        sym *= _ODD
        name = mix(np.add.reduceat(sym, at) + np.uint64(level))
        sym, doc, pos = name, doc[at], pos[at]
        end = np.where(np.r_[doc[1:] != doc[:-1], True], ends[doc], np.r_[pos[1:], 0])
        yield level, doc, sym, end - pos


def fingerprints(texts: list[str]) -> list[bytes]:
    """The fingerprint of each text: ascending big-endian 32-bit ranks."""
    out: list[bytes] = []
    k = 0
    while k < len(texts):
        held, to = len(texts[k]), k + 1
        while to < len(texts) and held + len(texts[to]) <= BATCH:
            held, to = held + len(texts[to]), to + 1
        out += _fingerprints(texts[k:to])
        k = to
    return out


def _fingerprints(texts: list[str]) -> list[bytes]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    keys = []
    for level, doc, name, length in phrases(codes, lengths):
        rank = (mix(name) >> np.uint64(11)) // (length * WEIGHTS[level]).astype(np.uint64) + np.uint64(1)
        bits = rank.astype(np.float32).view(np.uint32)  # rounds, and keeps the order
        keys.append((doc.astype(np.uint64) << np.uint64(32)) | bits)
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    at = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    ranks = (keys & np.uint64(0xFFFFFFFF)).astype(">u4")
    return [ranks[a:min(b, a + KEPT)].tobytes() for a, b in zip(at[:-1], at[1:])]


def likeness(x: bytes, y: bytes) -> float:
    """Estimated share of text that two texts have in common, 2 J / (1 + J)
    for the weighted Jaccard similarity J of their names; 1 for two empty
    texts, 0 for one."""
    if x == y:
        return 1.0
    a, b = np.frombuffer(x, ">u4"), np.frombuffer(y, ">u4")
    union = np.union1d(a, b)[:KEPT]
    same = len(np.intersect1d(np.intersect1d(a, b, True), union, True))
    return 2 * same / (len(union) + same)


def _place(doc_id, h, bounds: list) -> int:
    return bisect_right(bounds, (doc_id is not None, doc_id or 0, h))


def _neighbours(docs: DataFrame) -> DataFrame:
    """Rows dealt to parts of the id range, each part with the first row of
    the next one (the last: of the first) as a guest: ``(part, guest, doc_id,
    h, text)``, texts compressed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    keys = materialize(rows.select("doc_id", "h", F.char_length("text").cast("long").alias("n")), "names-keys")
    chars = keys.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = int(min(PARTS, 1 + chars // CHARS))
    sample = keys.orderBy(F.xxhash64("doc_id", "h")).limit(SAMPLE * parts).select("doc_id", "h").collect()
    sample = sorted({(r.doc_id is not None, r.doc_id or 0, r.h) for r in sample})
    bounds = [sample[len(sample) * k // parts] for k in range(1, parts)] if sample else []

    def lowest(batches):
        low: dict = {}
        for batch in batches:
            for doc_id, h in zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist()):
                part, key = _place(doc_id, h, bounds), (doc_id is not None, doc_id or 0, h)
                low[part] = min(key, low.get(part, key))
        yield pa.RecordBatch.from_pylist(
            [{"part": p, "known": k[0], "id": k[1], "h": k[2]} for p, k in low.items()],
            schema=pa.schema([("part", pa.int32()), ("known", pa.bool_()), ("id", pa.int64()), ("h", pa.int64())]))

    least = keys.mapInArrow(lowest, "part int, known boolean, id long, h long").groupBy("part").agg(
        F.min(F.struct("known", "id", "h")).alias("key")).orderBy("part").collect()  # PARTS rows at most
    held = [r.part for r in least]
    guests = {tuple(r.key): held[k - 1] for k, r in enumerate(least)}
    schema = pa.schema([("part", pa.int32()), ("guest", pa.bool_()), ("doc_id", pa.int64()), ("h", pa.int64()),
                        ("text", pa.binary())])

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for piece in small(batch):
                cols = [[], [], [], [], []]
                for doc_id, h, text in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "h", "text"))):
                    short = pack.compress(text)
                    to = [(_place(doc_id, h, bounds), False)]
                    if (guest := guests.get((doc_id is not None, doc_id or 0, h))) is not None:
                        to.append((guest, True))
                    for part, is_guest in to:
                        for c, v in zip(cols, (part, is_guest, doc_id, h, short)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    dealt = rows.select("doc_id", "h", F.col("text").cast("binary").alias("text")).mapInArrow(
        deal, "part int, guest boolean, doc_id long, h long, text binary")
    return dealt.repartition("part").sortWithinPartitions("part", "guest", F.asc_nulls_first("doc_id"), "h")


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
           " near_edited double, near_next double")


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Runs of rows (doc_id, text, is a row of its own) of one part, each run
    but a part's first starting with the last row of the one before."""
    unpack = zstandard.ZstdDecompressor()
    run, held, at = [], 0, None
    for batch in batches:
        for part, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))):
            if part != at:
                if len(run) > 1:
                    yield run
                run, held, at = [], 0, part
            if run and not run[-1][2]:
                continue  # one guest is enough
            text = unpack.decompress(text).decode("utf-8", "replace") if len(text) else ""
            run.append((doc_id, text, not guest))
            held += len(text)
            if held >= BATCH and len(run) > 1:
                yield run
                run, held = run[-1:], len(run[-1][1])
    if len(run) > 1:
        yield run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _followed(batches):
        texts = [text for _, text, _ in run]
        edited = []
        for text, after in zip(texts, texts[1:]):
            cut = len(text) // 4
            edited.append(text[:len(text) - cut] + after[:cut])
        own, other = fingerprints(texts), fingerprints(edited)
        m = len(edited)
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in run[:m]], pa.int64()),
            pa.array([len(t) for t in texts[:m]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            pa.array([x.hex() for x in own[:m]], pa.string()),
            pa.array([x.hex() for x in other], pa.string()),
            pa.array([likeness(x, y) for x, y in zip(own, other)], pa.float64()),
            pa.array([likeness(x, y) for x, y in zip(own, own[1:])], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


@tidy
def compare(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` to a row per row: its fingerprint, that of its text
    with the last quarter replaced by the start of the next row's, and the
    likeness of its fingerprint to that and to the next row's.

    The next row is that of the next larger id, after the last the first. Rows
    without id come first; rows of one id go by a hash of the text, so
    repeated rows follow each other. A null text is empty: its fingerprint is
    empty, alike to another empty text's and to no other's. A single row is
    its own next. Other columns are ignored; no rows give no rows.
    """
    return _neighbours(docs).mapInArrow(_compared, _RESULT)
