"""Secret scans: one deterministic automaton for all rules.

Rule expressions are parsed to one nondeterministic automaton, made
deterministic by subset construction, minimised by partition refinement and
laid out as transition rows. A text's UTF-8 bytes are read once for all rules.
Whenever a rule stops accepting, the start of its match is found by running
the rule's reversed automaton backwards from that end.

Semantics, per rule: leftmost, longest, non-overlapping matches. Rules must
keep accepting once they accept until their last character class ends (they
end in ``class+`` or ``class{n,}``) or accept one position only. A match that
fails the rule's check is dropped and not retried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame

from relayline.llm.common import map_rows


class Rule(NamedTuple):
    kind: str
    pattern: str
    check: Callable[[bytes], bool] | None = None


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


def _assigned(match: bytes) -> bool:
    """The assigned value has 6 characters or more."""
    at = min(i for i in (match.find(b"="), match.find(b":")) if i >= 0)
    return len(match[at + 1:].lstrip(b" ").lstrip(b"\"'")) >= 6


_KEYWORDS = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])

#: The first three are the contract's; a run of hexadecimal digits is consumed
#: whole either way, so its least length can be part of the expression.
RULES = [
    Rule("assign", rf"({_KEYWORDS})[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=\-]+", _assigned),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m) >= 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", lambda m: len(m) >= 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]+", lambda m: len(m) >= 20),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
BASE = ("assign", "access", "hex")


# -- expressions ------------------------------------------------------------

def parse(pattern: str):
    """A tree of ('set', bytes) | ('cat', parts) | ('alt', parts) |
    ('rep', part, least, most or None) from literals, ``[...]``, ``(...|...)``
    and the postfixes ``? * + {n} {n,} {n,m}``."""
    at = 0

    def peek() -> str:
        return pattern[at] if at < len(pattern) else ""

    def char() -> int:
        nonlocal at
        at += pattern[at] == "\\"
        at += 1
        return ord(pattern[at - 1])

    def atom():
        nonlocal at
        if peek() == "(":
            at += 1
            node = alternatives()
            at += 1
            return node
        if peek() == "[":
            at += 1
            found = set()
            while peek() != "]":
                low = char()
                if peek() == "-" and pattern[at + 1] != "]":
                    at += 1
                    found.update(range(low, char() + 1))
                else:
                    found.add(low)
            at += 1
            return "set", frozenset(found)
        return "set", frozenset([char()])

    def postfix(node):
        nonlocal at
        while peek() and peek() in "?*+{":
            mark = pattern[at]
            at += 1
            if mark == "{":
                end = pattern.index("}", at)
                low, comma, high = pattern[at:end].partition(",")
                at = end + 1
                node = "rep", node, int(low), int(high) if high else None if comma else int(low)
            else:
                node = "rep", node, int(mark == "+"), 1 if mark == "?" else None
        return node

    def sequence():
        parts = []
        while peek() and peek() not in "|)":
            parts.append(postfix(atom()))
        return "cat", parts

    def alternatives():
        nonlocal at
        parts = [sequence()]
        while peek() == "|":
            at += 1
            parts.append(sequence())
        return "alt", parts

    return alternatives()


def reverse(node):
    if node[0] == "cat":
        return "cat", [reverse(x) for x in reversed(node[1])]
    if node[0] == "alt":
        return "alt", [reverse(x) for x in node[1]]
    if node[0] == "rep":
        return "rep", reverse(node[1]), *node[2:]
    return node


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []              # moves without a byte
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, node, start: int) -> int:
        """Adds what ``node`` reads from ``start``; the state it ends in."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        end = self.state()
        if kind == "alt":
            for part in node[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        self.free[start].append(end)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            back = self.add(part, loop)
            self.free[back] += [loop, end]
        else:
            for _ in range(most - least):
                start = self.add(part, start)
                self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


class Automaton(NamedTuple):
    """``rows[s][b]`` is the next state; ``accepts[s]`` has a bit per rule;
    state 0 starts; ``dead`` is the state that nothing leaves, or -1."""
    rows: list[list[int]]
    accepts: list[int]
    dead: int


def build(trees: list, anywhere: bool) -> Automaton:
    """Subset construction over all trees, then minimisation. ``anywhere``:
    a match may begin at any byte."""
    nfa = _Nfa()
    first = nfa.state()
    ends = {nfa.add(tree, first): 1 << i for i, tree in enumerate(trees)}
    start = nfa.closure([first])
    number, todo, rows = {start: 0}, [start], []
    alike, sets = {}, {on for moves in nfa.moves for on, _ in moves}
    for b in range(256):  # bytes that no expression tells apart move alike
        alike.setdefault(tuple(b in s for s in sets), []).append(b)
    for subset in todo:
        row = [0] * 256
        for same in alike.values():
            found = {end for s in subset for on, end in nfa.moves[s] if same[0] in on}
            to = nfa.closure(found | ({first} if anywhere else set()))
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            for b in same:
                row[b] = number[to]
        rows.append(row)
    accepts = [sum({ends[s] for s in subset if s in ends}) for subset in todo]
    return _minimise(rows, accepts)


def _minimise(rows: list[list[int]], accepts: list[int]) -> Automaton:
    """Partition refinement until no class splits; class 0 holds the start."""
    group, count = accepts, 0
    while True:
        seen: dict = {}
        group = [seen.setdefault((group[s], *[group[t] for t in row]), len(seen)) for s, row in enumerate(rows)]
        if len(seen) == count:
            break
        count = len(seen)
    one = {g: s for s, g in reversed(list(enumerate(group)))}
    small = [[group[t] for t in rows[one[g]]] for g in range(count)]
    marks = [accepts[one[g]] for g in range(count)]
    dead = next((g for g in range(count) if not marks[g] and set(small[g]) == {g}), -1)
    return Automaton(small, marks, dead)


class Scanner:
    """Compiled rules. ``scan(bytes)`` gives (rule index, start, end) in byte
    offsets, by start, then rule."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        trees = [parse(r.pattern) for r in rules]
        self.forward = build(trees, anywhere=True)
        self.back = [build([reverse(t)], anywhere=False) for t in trees]
        # A row is a list of 257: the next rows by byte, then the accept bits.
        self.rows = [[None] * 256 + [m] for m in self.forward.accepts]
        for row, to in zip(self.rows, self.forward.rows):
            row[:256] = [self.rows[t] for t in to]

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        row, on, ends = self.rows[0], 0, []
        for at, b in enumerate(data):
            row = row[b]
            if row[256] != on:
                stopped = on & ~row[256]
                if stopped:
                    ends += [(i, at) for i in range(len(self.rules)) if stopped >> i & 1]
                on = row[256]
        ends += [(i, len(data)) for i in range(len(self.rules)) if on >> i & 1]
        found, free = [], [0] * len(self.rules)
        for i, end in ends:
            start = self._start(i, data, free[i], end)
            if start is not None:
                free[i] = end
                check = self.rules[i].check
                if check is None or check(data[start:end]):
                    found.append((start, i, end))
        return [(i, s, e) for s, i, e in sorted(found)]

    def _start(self, i: int, data: bytes, least: int, end: int) -> int | None:
        """The smallest start from ``least`` on of a match of rule i to ``end``."""
        rows, accepts, dead = self.back[i]
        s, start = 0, None
        for at in range(end - 1, least - 1, -1):
            s = rows[s][data[at]]
            if s == dead:
                break
            if accepts[s]:
                start = at
        return start


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner(RULES)


def points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets to code points."""
    if len(data) and not data.isascii():
        edges = sorted({x for _, s, e in spans for x in (s, e)})
        place, at, n = {}, 0, 0
        for x in edges:
            n += len(data[at:x].decode("utf-8", "replace"))
            at, place[x] = x, n
        return [(i, place[s], place[e]) for i, s, e in spans]
    return spans


def scan_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, kinds, starts, ends)``: the secrets of
    every whole text in code points, end exclusive, by start and then rule.

    Null and empty texts have none; repeated rows give repeated rows; other
    columns are ignored. One row is one text, whatever its length.
    """
    def make():
        scan, rules = scanner().scan, RULES

        def step(cols):
            found = []
            for text in cols["text"]:
                data = (text or "").encode("utf-8", "replace")
                found.append(points(data, scan(data)))
            return {"doc_id": cols["doc_id"], "kinds": [[rules[i].kind for i, _, _ in x] for x in found],
                    "starts": [[s for _, s, _ in x] for x in found], "ends": [[e for _, _, e in x] for x in found]}
        return step

    return map_rows(docs.select("doc_id", "text"),
                    "doc_id long, kinds array<string>, starts array<int>, ends array<int>", make)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[kind]``;
    overlapping secrets become one mark of the first. A null text stays null,
    ``n_chars`` (if any) follows the new text, other columns stay."""
    schema = docs.schema

    def make():
        scan, rules = scanner().scan, RULES

        def clean(text):
            if not text:
                return text
            data, out, at = text.encode("utf-8", "replace"), [], 0
            for i, s, e in scan(data):
                if s >= at:
                    out += [data[at:s], b"[%s]" % rules[i].kind.encode()]
                at = max(at, e)
            return (b"".join(out) + data[at:]).decode("utf-8") if at else text

        def step(cols):
            cols["text"] = [clean(x) for x in cols["text"]]
            if "n_chars" in cols:
                cols["n_chars"] = [n if x is None else len(x) for x, n in zip(cols["text"], cols["n_chars"])]
            return cols
        return step

    return map_rows(docs, schema, make)


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_documents``."""
    def make():
        def text(x):
            return ",".join(f"{k}:{s}:{e}" for k, s, e in x)

        def step(cols):
            spans = [list(zip(k, s, e)) for k, s, e in zip(cols["kinds"], cols["starts"], cols["ends"])]
            base = [[x for x in row if x[0] in BASE] for row in spans]
            out = {f"n_{k}": [sum(x[0] == k for x in row) for row in base] for k in BASE}
            return out | {"doc_id": cols["doc_id"], "spans": [text(x) for x in spans],
                          "base_sha256": [hashlib.sha256(text(x).encode()).hexdigest() for x in base]}
        return step

    return map_rows(scan_documents(docs), "doc_id long, n_assign long, n_access long, n_hex long, "
                                          "base_sha256 string, spans string", make)
