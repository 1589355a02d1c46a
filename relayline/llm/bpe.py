"""BPE encoding and decoding with a ``tokenizers`` vocabulary file.

A text is cut at the file's added tokens, normalised (NFC, runs of white
space to one space, lower case), split into words, and mapped byte by byte to
the vocabulary's printable alphabet. A word's symbols form a doubly linked
list; a heap holds the mergeable neighbours by (merge rank, position), and an
entry is skipped when the list has changed under it. Decoding concatenates
the vocabulary strings; as the file names no decoder, they are joined by one
space.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from relayline.llm.common import map_rows

#: Words whose ids a worker keeps; beyond it the memory starts anew, so it is
#: bounded. It only saves time.
CACHED_WORDS = 300_000

_SPACE = regex.compile(r"\p{White_Space}+")


def _alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the rest for code points from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.ids.items(), *self.added.items()]}
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b])
                       for rank, (a, b) in enumerate(model["merges"])}
        self.word = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                                       if p["type"] == "Split").replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.alphabet = _alphabet()
        self.known: dict[str, list[int]] = {}

    def merge(self, word: str) -> list[int]:
        """The ids of one word."""
        chars = [self.alphabet[b] for b in word.encode("utf-8", "replace")]
        if chars:
            chars[-1] += self.suffix
        ids = [self.ids[c] for c in chars if c in self.ids]
        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(*merges[pair], at) for at, pair in enumerate(zip(ids, ids[1:])) if pair in merges]
        heap = [(rank, at, new) for rank, new, at in heap]
        heapq.heapify(heap)
        while heap:
            rank, at, new = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right < 0 or merges.get((ids[at], ids[right])) != (rank, new):
                continue  # stale: one of the two symbols has been merged since
            ids[at], ids[right] = new, -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0:
                    found = merges.get((ids[left], ids[after[left]]))
                    if found:
                        heapq.heappush(heap, (found[0], left, found[1]))
        return [i for i in ids if i >= 0]

    def normalise(self, text: str) -> str:
        # Lower case is per character: a final sigma is not treated apart.
        return _SPACE.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.added:
                out.append(self.added[part])
                continue
            for word in self.word.findall(self.normalise(part)):
                ids = self.known.get(word)
                if ids is None:
                    if len(self.known) >= CACHED_WORDS:
                        self.known.clear()
                    ids = self.merge(word)
                    if len(word) <= 64:
                        self.known[word] = ids
                out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """Ids without a vocabulary string are left out."""
        strings = self.strings
        return " ".join([strings[i] for i in ids if i in strings])


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, ids)``. A null text is an empty one and
    has no ids; repeated rows give repeated rows; other columns are ignored.
    ``path`` is the vocabulary file on every executor, by default that of the
    ``public_tokenizers`` package installed there."""
    def make():
        bpe = load(path or default_path())
        return lambda cols: {"doc_id": cols["doc_id"], "ids": [bpe.encode(x or "") for x in cols["text"]]}

    return map_rows(docs.select("doc_id", "text"), "doc_id long, ids array<int>", make)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, ids)`` to ``(doc_id, text)``; null ids give an empty text."""
    def make():
        bpe = load(path or default_path())
        return lambda cols: {"doc_id": cols["doc_id"], "text": [bpe.decode(x or []) for x in cols["ids"]]}

    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, text string", make)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's columns: every text is encoded, and its ids decoded."""
    def make():
        bpe = load(path or default_path())
        decimal = {i: str(i) for i in bpe.strings}

        def step(cols):
            ids = [bpe.encode(x or "") for x in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_tokens": [len(x) for x in ids],
                    "ids_sha256": [hashlib.sha256(" ".join([decimal[i] for i in x]).encode()).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode("utf-8", "replace")).hexdigest() for x in ids]}
        return step

    return map_rows(docs.select("doc_id", "text"),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)


def tokenise(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, n_tokens, ids, decoded_sha256)``, a row
    per row; the digest is of the text that the ids decode to."""
    def make():
        bpe = load(path or default_path())

        def step(cols):
            ids = [bpe.encode(x or "") for x in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_tokens": [len(x) for x in ids], "ids": ids,
                    "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode("utf-8", "replace")).hexdigest() for x in ids]}
        return step

    return map_rows(docs.select("doc_id", "text"),
                    "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string", make)
