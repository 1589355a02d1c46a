"""Personal data: exact base patterns, and a semi-Markov conditional random
field that adds spans.

The field labels whole segments of a tokenised text: a segment of one of the
kinds scores the weights of its features, which see the whole span (its
shape, digit count, checksum, octets, neighbours); a token outside scores 0.
Segments hold MAX_TOKENS tokens and MAX_CHARS characters at most, so decoding
by dynamic programming is linear in the text, and chooses boundaries and
kinds jointly. Only segments with a digit or ``@`` are candidates; between
such places every token is outside, so decoding them one by one gives the
same path as decoding the whole text.

The weights are trained by the gradient of the log-likelihood on places from
a bounded sample of the documents, labelled by the base patterns.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayline.llm.common import map_rows

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MAX_CHARS = 24, 64
CHUNK = 4096  # segments that are scored at once
FEATURES = 1 << 12
#: The sample that the weights are fitted on: so many documents, and so many
#: places in them, by the hash of the id.
SAMPLE_DOCS, SAMPLE_PLACES, EPOCHS = 4000, 500, 5

# -- base patterns -----------------------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A run of digits either starts a match or holds none: no retries inside it.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if at % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _octets(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isdecimal() and p.isascii() and int(p[-9:]) <= 255 and not p[:-9].strip("0")
                                   for p in parts)


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            free = end.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) in the order of the kinds, then of starts."""
    found = [(0, s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
        found += [(2, *m.span()) for m in _CARD.finditer(text)
                  if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# -- the field -----------------------------------------------------------------
_SEED = re.compile(r"[0-9@]\S*")
_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|.", re.DOTALL)
_SHAPE = [(re.compile(r"[0-9]+"), "9"), (re.compile(r"[A-Za-z]+"), "a")]


def places(text: str) -> list[tuple[int, int]]:
    """(start, end) of runs of words with a digit or ``@``, one white space
    character between them; context to the left of a word is MAX_CHARS."""
    out: list[tuple[int, int]] = []
    for m in _SEED.finditer(text):
        start, least = m.start(), max(0, m.start() - MAX_CHARS)
        while start > least and not text[start - 1].isspace():
            start -= 1
        if out and start <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], m.end())
        else:
            out.append((start, m.end()))
    return out


def _class(c: str) -> str:
    return "^" if not c else "9" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() else c


def features(text: str, start: int, end: int) -> list[int]:
    span = text[start:end]
    digits, shape = _digits(span), span
    for pattern, mark in _SHAPE:
        shape = pattern.sub(mark, shape)
    n = len(digits)
    name, _, host = span.partition("@")
    on = ["bias", f"n{min(n, 24)}", f"s{shape[:24]}", f"f{_class(span[0])}", f"l{_class(span[-1])}",
          f"L{_class(text[start - 1:start])}", f"R{_class(text[end:end + 1])}",
          f"c{''.join(sorted(set(shape)))[:12]}", f"@{span.count('@')}{'.' in host}{bool(name)}",
          f"o{_octets(span)}", f"u{n >= 12 and luhn(digits)}{16 <= n <= 19}", f"+{span[0] == '+'}{8 <= n <= 15}"]
    return [zlib.crc32(x.encode()) % FEATURES for x in on]


def segments(text: str, start: int, end: int, edges: array) -> Iterator[tuple[int, int, int, int]]:
    """The candidate segments of a place as (first token, token after, start,
    end), by first token and then by length. ``edges`` takes the tokens' ends;
    tokens lie side by side from ``start`` on."""
    tokens, ahead, i = _TOKEN.finditer(text, start, end), deque(), 0
    while True:
        for m in islice(tokens, MAX_TOKENS - len(ahead)):
            ahead.append(m.end())
            edges.append(m.end())
        if not ahead:
            return
        if not text[start].isspace():
            for k, e in enumerate(ahead, 1):
                if e - start > MAX_CHARS:
                    break
                if not text[e - 1].isspace() and _MARK.search(text, start, e):
                    yield i, i + k, start, e
        start = ahead.popleft()
        i += 1


def decode(text: str, start: int, end: int, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The best path's segments of a place: (kind index, start, end). The
    forward pass holds MAX_TOKENS positions and scores CHUNK segments at a
    time; of each token stay its end, and the length and kind of the segment
    that the best path to it ends with."""
    edges, back, kinds = array("q", [start]), bytearray(1), bytearray(1)
    value, ahead = 0.0, deque([(-np.inf, 0, 0)] * MAX_TOKENS)  # of the positions after the last

    def move(to: int) -> None:
        nonlocal value
        while len(back) <= to:
            score, length, kind = ahead.popleft()
            ahead.append((-np.inf, 0, 0))
            if score > value:
                value = score
            else:
                length = kind = 0
            back.append(length)
            kinds.append(kind)

    found = segments(text, start, end, edges)
    while part := list(islice(found, CHUNK)):
        scores = weights[:, np.array([features(text, s, e) for _, _, s, e in part])].sum(axis=2)
        for (i, j, _, _), kind, top in zip(part, scores.argmax(axis=0).tolist(), scores.max(axis=0).tolist()):
            move(i)
            if value + top > ahead[j - i - 1][0]:
                ahead[j - i - 1] = value + top, j - i, kind
    j = len(edges) - 1
    move(j)
    path = []
    while j > 0:
        if back[j]:
            path.append((kinds[j], edges[j - back[j]], edges[j]))
        j -= back[j] or 1
    return path[::-1]


class Lattice:
    """The candidate segments of one short place: token bounds and features."""

    def __init__(self, text: str, start: int, end: int):
        edges = array("q")
        self.bounds = list(segments(text, start, end, edges))
        self.n = len(edges)
        rows = [features(text, s, e) for _, _, s, e in self.bounds]
        self.features = np.array(rows, dtype=np.int64).reshape(len(rows), -1)
        self.ending: list[list[int]] = [[] for _ in range(self.n + 1)]
        for k, (_, j, _, _) in enumerate(self.bounds):
            self.ending[j].append(k)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return weights[:, self.features].sum(axis=2) if len(self.bounds) else np.zeros((len(weights), 0))

    def decode(self, weights: np.ndarray) -> list[tuple[int, int, int]]:
        """The best path's segments: (kind index, start, end)."""
        scores = self.scores(weights)
        kind, top = scores.argmax(axis=0), scores.max(axis=0) if scores.size else scores.sum(axis=0)
        best, back = [0.0] * (self.n + 1), [-1] * (self.n + 1)
        for j in range(1, self.n + 1):
            best[j] = best[j - 1]
            for k in self.ending[j]:
                score = best[self.bounds[k][0]] + top[k]
                if score > best[j]:
                    best[j], back[j] = score, k
        found, j = [], self.n
        while j > 0:
            k = back[j]
            if k < 0:
                j -= 1
            else:
                j, _, s, e = self.bounds[k]
                found.append((int(kind[k]), s, e))
        return found[::-1]

    def expected(self, weights: np.ndarray) -> np.ndarray:
        """The probability of every (kind, segment), by forward and backward sums."""
        scores = self.scores(weights)
        total = np.logaddexp.reduce(scores, axis=0) if len(self.bounds) else np.zeros(0)
        ahead, behind = np.zeros(self.n + 1), np.zeros(self.n + 1)
        for j in range(1, self.n + 1):
            ks = self.ending[j]
            ahead[j] = np.logaddexp.reduce([ahead[j - 1]] + [ahead[self.bounds[k][0]] + total[k] for k in ks])
        rest: list[list[float]] = [[] for _ in range(self.n + 1)]
        for j in range(self.n, 0, -1):
            behind[j] = np.logaddexp.reduce(rest[j]) if j < self.n else 0.0
            rest[j - 1].append(behind[j])
            for k in self.ending[j]:
                rest[self.bounds[k][0]].append(behind[j] + total[k])
        i, j = np.array([b[:2] for b in self.bounds]).reshape(-1, 2).T.astype(np.int64)
        return np.exp(scores + ahead[i] + behind[j] - ahead[self.n])


def train(samples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (kind, feature) from texts of one place each and their true
    spans. Without samples no segment scores above 0."""
    weights = np.zeros((len(KINDS), FEATURES))
    weights[:, zlib.crc32(b"bias") % FEATURES] = -4.0
    squares = np.full_like(weights, 1e-2)
    ready = []
    for text, spans in samples:
        lattice = Lattice(text, 0, len(text))
        if lattice.bounds:
            wanted = np.zeros((len(KINDS), len(lattice.bounds)))
            place = {(s, e): k for k, (_, _, s, e) in enumerate(lattice.bounds)}
            for kind, s, e in spans:
                if (s, e) in place:
                    wanted[kind, place[s, e]] = 1
            ready.append((lattice, wanted))
    for _ in range(epochs):
        for lattice, wanted in ready:
            push = wanted - lattice.expected(weights)
            for kind in range(len(KINDS)):
                step = np.zeros(FEATURES)
                np.add.at(step, lattice.features, push[kind][:, None])
                squares[kind] += step * step
                weights[kind] += 0.5 * step / np.sqrt(squares[kind])
    return weights


def fit(docs: DataFrame) -> np.ndarray:
    """Weights from the places of SAMPLE_DOCS documents; on the driver comes
    a bounded number of short strings."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)

    def make():
        def step(cols):
            out = {"mark": [], "place": [], "spans": []}
            for text in cols["text"]:
                text = text or ""
                true = base_spans(text)
                for start, end in places(text):
                    lo, hi = max(0, start - 1), min(end + 1, start + 4 * MAX_CHARS)
                    own = [(k, s - lo, e - lo) for k, s, e in true if lo <= s and e <= hi]
                    if end <= hi:
                        out["place"].append(text[lo:hi])
                        out["mark"].append(zlib.crc32(text[lo:hi].encode("utf-8", "replace")))
                        out["spans"].append([x for span in own for x in span])
            return out
        return step

    found = map_rows(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"),
                     "mark long, place string, spans array<int>", make)
    rows = found.orderBy("mark", "place").limit(SAMPLE_PLACES).collect()
    return train([(r.place, list(zip(*[iter(r.spans)] * 3))) for r in rows])


def find(text: str, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """Base spans, and the field's segments that touch none of them; in the
    order of the kinds, then of starts."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    starts, ends = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    found = list(base)
    for start, end in places(text):
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue  # nothing is left to add
        for kind, s, e in decode(text, start, end, weights):
            at = bisect_left(starts, e)  # spans that start before e; the last end of theirs
            if not at or ends[at - 1] <= s:
                found.append((kind, s, e))
    return sorted(found)


def find_documents(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, kinds, starts, ends, base)``: the
    spans of every whole text in code points, end exclusive, by kind and then
    start; ``base`` says which the patterns found.

    Null and empty texts have none; repeated rows give repeated rows; other
    columns are ignored. The weights (128 kB) go to the tasks by value.
    """
    weights = fit(docs) if weights is None else weights

    def make():
        def step(cols):
            got = [(find(x, weights), set(base_spans(x))) if x else ([], ()) for x in cols["text"]]
            return {"doc_id": cols["doc_id"], "kinds": [[KINDS[k] for k, _, _ in x] for x, _ in got],
                    "starts": [[s for _, s, _ in x] for x, _ in got], "ends": [[e for _, _, e in x] for x, _ in got],
                    "base": [[y in b for y in x] for x, b in got]}
        return step

    return map_rows(docs.select("doc_id", "text"),
                    "doc_id long, kinds array<string>, starts array<int>, ends array<int>, base array<boolean>", make)


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns from ``find_documents``."""
    def make():
        def step(cols):
            rows = [[(f"{k}:{s}:{e}", k, b) for k, s, e, b in zip(*x)]
                    for x in zip(cols["kinds"], cols["starts"], cols["ends"], cols["base"])]
            base = [[x for x in row if x[2]] for row in rows]
            return {f"n_{k}": [sum(x[1] == k for x in row) for row in base] for k in KINDS} | {
                "doc_id": cols["doc_id"], "spans": [",".join(x[0] for x in row) for row in rows],
                "base_sha256": [hashlib.sha256(",".join(x[0] for x in row).encode()).hexdigest() for row in base]}
        return step

    return map_rows(find_documents(docs), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                          "base_sha256 string, spans string", make)
