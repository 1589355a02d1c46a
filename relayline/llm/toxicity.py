"""Toxicity: a bidirectional gated recurrent network with attention pooling
over word and character inputs, trained in numpy, scoring every overlapping
window of a text. A text's score is that of its most toxic window.

A word's input is a hashed word vector beside the scaled sum of hashed
character n-gram vectors. Before training, one coordinate of each vector is
set to the log-odds of its bucket in the training texts; all vectors and
weights are then trained by back-propagation. A training text teaches through
its highest-scoring window, as labels mark whole texts.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayline.llm.common import map_rows

WINDOW, STRIDE = 48, 36              # words
DIM, HIDDEN = 8, 8
WORD_BUCKETS, GRAM_BUCKETS = 1 << 14, 1 << 15
GRAMS = (3, 4, 5)
#: The bounded training sample: texts of each class at most, of so many words
#: at most, by the hash of the id.
SAMPLE_TEXTS, SAMPLE_WORDS, EPOCHS = 2000, 600, 6
LEAST_STEPS = 300                    # few texts are gone through more often
THRESHOLD = 0.3
AT_ONCE = 512                        # windows scored together
CACHED_WORDS = 200_000               # a worker's memory of word inputs; it only saves time
_WORD = re.compile(r"\w+")


def split(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def windows(n: int) -> list[tuple[int, int]]:
    """(start, end) of the overlapping windows over n words; together they
    hold every word, and all but a shorter text's only one are full."""
    if n <= WINDOW:
        return [(0, n)]
    starts = [*range(0, n - WINDOW, STRIDE), n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93],
                    np.uint64)


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words: each one's bucket, the buckets of all character n-grams of
    ``<word>`` one word after another, and how many each word has."""
    code = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(code))  # characters up to the word's end
    of, gram = [], []
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), np.uint64(n))
        for k in range(n):
            h += code[at + k] * _FACTORS[k]
        of.append(word[at])
        gram.append((((h ^ (h >> np.uint64(32))) * _FACTORS[0]) >> np.uint64(20)) % np.uint64(GRAM_BUCKETS))
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return (np.array([_hash(w) % WORD_BUCKETS for w in words], np.int64),
            np.concatenate(gram)[order].astype(np.int64), np.bincount(of, minlength=len(words)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Model:
    """``p`` holds the arrays: word and gram vectors, and for each direction
    input weights W, recurrent weights U, bias b; attention a, output o, c."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) * 0.1).astype(np.float32)
        self.p = {"word": draw(WORD_BUCKETS, DIM), "gram": draw(GRAM_BUCKETS, DIM),
                  "W": draw(2, 2 * DIM, 3 * HIDDEN) * 3, "U": draw(2, HIDDEN, 3 * HIDDEN) * 3,
                  "b": np.zeros((2, 3 * HIDDEN), np.float32), "a": draw(2, HIDDEN), "o": draw(2, HIDDEN),
                  "c": np.zeros(1, np.float32)}

    def inputs(self, words: list[str]) -> np.ndarray:
        """The input vectors of words, one row each."""
        if not words:
            return np.zeros((0, 2 * DIM), np.float32)
        word, flat, counts = buckets(words)
        sums = np.add.reduceat(self.p["gram"][flat], np.r_[0, counts.cumsum()[:-1]], axis=0)
        return np.hstack([self.p["word"][word], sums / np.sqrt(counts)[:, None].astype(np.float32)])

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What the inputs add to the gates: rows of both directions."""
        return np.hstack([x @ self.p["W"][d] + self.p["b"][d] for d in (0, 1)])

    def run(self, gates: np.ndarray, ids: np.ndarray, length: np.ndarray, keep: bool = False):
        """Logits of windows: ``ids`` (windows, steps) are rows of ``gates``,
        ``length`` the words of each. ``keep``: also what training needs."""
        n, steps = ids.shape
        heat, value = np.zeros((n, steps), np.float32), np.zeros((n, steps), np.float32)
        kept = [[], []]
        full = bool((length == steps).all())
        for d in (0, 1):
            h, U = np.zeros((n, HIDDEN), np.float32), self.p["U"][d]
            own = gates[:, d * 3 * HIDDEN:(d + 1) * 3 * HIDDEN]
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, hu = own[ids[:, t]], h @ U
                zr = _sigmoid(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
                after = new + z * (h - new)
                if not full:
                    after = np.where((t < length)[:, None], after, h)
                if keep:
                    kept[d].append((t, h, z, r, new, hu[:, 2 * HIDDEN:], after))
                h = after
                heat[:, t] += h @ self.p["a"][d]
                value[:, t] += h @ self.p["o"][d]
        if not full:
            heat[np.arange(steps) >= length[:, None]] = -1e9
        share = np.exp(heat - heat.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        if not full:
            share[np.arange(steps) >= length[:, None]] = 0
        logits = (share * value).sum(axis=1) + self.p["c"][0]
        return (logits, share, value, kept) if keep else logits

    def score(self, gates: np.ndarray, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        """``run``'s logits for scoring: both directions at once, one row per
        unit and one column per window, in place. Steps behind a window's end
        count for nothing: the backward state starts at its last word."""
        n, steps = ids.shape
        half = np.ones((6 * HIDDEN, 1), np.float32)  # a sigmoid is a tanh of half its argument
        half[:2 * HIDDEN] = half[3 * HIDDEN:5 * HIDDEN] = 0.5
        x = np.ascontiguousarray(gates[ids].transpose(1, 2, 0)) * half
        U = np.ascontiguousarray(self.p["U"].transpose(0, 2, 1)) * half[None, :3 * HIDDEN]
        a, o = self.p["a"], self.p["o"]
        h = np.zeros((2, HIDDEN, n), np.float32)
        hu, new = np.empty((2, 3 * HIDDEN, n), np.float32), np.empty((2, HIDDEN, n), np.float32)
        heat, value = np.zeros((steps, n), np.float32), np.zeros((steps, n), np.float32)
        full = bool((length == steps).all())
        for t in range(steps):
            u = steps - 1 - t
            np.matmul(U, h, out=hu)
            zr = hu[:, :2 * HIDDEN]
            zr[0] += x[t, :2 * HIDDEN]
            zr[1] += x[u, 3 * HIDDEN:5 * HIDDEN]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            np.multiply(zr[:, HIDDEN:], hu[:, 2 * HIDDEN:], out=new)
            new[0] += x[t, 2 * HIDDEN:3 * HIDDEN]
            new[1] += x[u, 5 * HIDDEN:]
            np.tanh(new, out=new)
            h -= new
            h *= zr[:, :HIDDEN]
            h += new
            if not full:
                h[1] *= u < length
            heat[t] += a[0] @ h[0]
            heat[u] += a[1] @ h[1]
            value[t] += o[0] @ h[0]
            value[u] += o[1] @ h[1]
        if not full:
            heat[np.arange(steps)[:, None] >= length] = -1e9
        share = np.exp(heat - heat.max(axis=0))
        share /= share.sum(axis=0)
        if not full:
            share[np.arange(steps)[:, None] >= length] = 0
        return (share * value).sum(axis=0) + self.p["c"][0]

    def back(self, push: np.ndarray, ids, length, share, value, kept, gates_rows: int):
        """Gradients from ``push`` (of the logits); also that of the gates' rows."""
        p, g = self.p, {k: np.zeros_like(self.p[k]) for k in ("U", "a", "o", "c")}
        pooled = (share * value).sum(axis=1, keepdims=True)
        d_value, d_heat = push[:, None] * share, push[:, None] * share * (value - pooled)
        g["c"][0] = push.sum()
        d_gates = np.zeros((gates_rows, 6 * HIDDEN), np.float32)
        for d in (0, 1):
            U, dh = p["U"][d], 0.0
            for t, h, z, r, new, hn, after in reversed(kept[d]):
                on = (t < length)[:, None]
                g["a"][d] += (d_heat[:, t, None] * after).sum(axis=0)
                g["o"][d] += (d_value[:, t, None] * after).sum(axis=0)
                dh = dh + d_heat[:, t, None] * p["a"][d] + d_value[:, t, None] * p["o"][d]
                live = dh * on
                d_new = live * (1 - z) * (1 - new * new)
                d_z, d_r = live * (h - new) * z * (1 - z), d_new * hn * r * (1 - r)
                d_x = np.hstack([d_z, d_r, d_new])
                d_hu = np.hstack([d_z, d_r, d_new * r])
                g["U"][d] += h.T @ d_hu
                np.add.at(d_gates[:, d * 3 * HIDDEN:(d + 1) * 3 * HIDDEN], ids[:, t], d_x)
                dh = dh * ~on + live * z + d_hu @ U.T
        return g, d_gates


def train(texts: list[list[str]], labels: list[int], weights: list[float], epochs: int = EPOCHS) -> Model:
    """A model from tokenised texts. Without both classes, or without words, it
    is untrained and scores every text by the share of toxic weight."""
    model, labels, weights = Model(), np.array(labels, np.float32), np.array(weights, np.float32)
    total = max(float(weights.sum()), 1e-9)
    rate = min(max(float((weights * labels).sum()) / total, 0.01), 0.99)
    model.p["c"][0] = np.log(rate / (1 - rate))
    if not len(labels) or labels.min() == labels.max():
        model.p["o"][:] = 0
        return model
    vocabulary: dict[str, int] = {}
    rows = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t], np.int64) for t in texts]
    if not vocabulary:
        model.p["o"][:] = 0
        return model
    word_of, flat, counts = buckets(list(vocabulary))
    starts = np.r_[0, counts.cumsum()[:-1]]
    scale = np.sqrt(counts)[:, None].astype(np.float32)
    for name, size, of in (("word", WORD_BUCKETS, lambda k: word_of[k:k + 1]),
                           ("gram", GRAM_BUCKETS, lambda k: flat[starts[k]:starts[k] + counts[k]])):
        seen = np.ones((2, size))
        for row, label in zip(rows, labels):
            if len(row):
                seen[int(label), np.unique(np.concatenate([of(k) for k in set(row.tolist())]))] += 1
        odds = np.log(seen[1] / (labels.sum() + 2)) - np.log(seen[0] / (len(labels) - labels.sum() + 2))
        model.p[name][:, 0] = np.clip(odds, -4, 4) / 2

    def embed() -> np.ndarray:
        return np.hstack([model.p["word"][word_of], np.add.reduceat(model.p["gram"][flat], starts, axis=0) / scale])

    spans = [(k, s, e) for k, row in enumerate(rows) for s, e in windows(len(row))]
    of, length = np.array([k for k, _, _ in spans]), np.array([e - s for _, s, e in spans])
    ids = np.zeros((len(spans), WINDOW), np.int64)
    for i, (k, s, e) in enumerate(spans):
        ids[i, :e - s] = rows[k][s:e]
    epochs = max(epochs, -(-64 * LEAST_STEPS // len(rows)))
    memory = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    r, step = np.random.default_rng(7), 0
    for epoch in range(epochs):
        x = embed()
        if epoch == 0:
            score = np.where(np.arange(WINDOW) < length[:, None], (x[:, 0] + x[:, DIM])[ids], -9).max(axis=1)
        else:
            gates = model.gates(x)
            score = np.concatenate([model.run(gates, ids[i:i + 4096], length[i:i + 4096])
                                    for i in range(0, len(ids), 4096)])
        order = np.lexsort((score, of))
        best = order[np.r_[of[order][1:] != of[order][:-1], True]]
        best = best[r.permutation(len(best))]
        for i in range(0, len(best), 64):
            pick = best[i:i + 64]
            used, local = np.unique(ids[pick], return_inverse=True)
            local = local.reshape(len(pick), WINDOW)
            n = [counts[u] for u in used]
            grams = np.concatenate(
                [flat[starts[u]:starts[u] + counts[u]] for u in used])
            first = np.r_[0, np.cumsum(n)[:-1]]
            xs = np.hstack([model.p["word"][word_of[used]],
                            np.add.reduceat(model.p["gram"][grams], first, axis=0) / scale[used]])
            logits, share, value, kept = model.run(model.gates(xs), local, length[pick], keep=True)
            push = (_sigmoid(logits) - labels[of[pick]]) * weights[of[pick]] / len(pick)
            g, dg = model.back(push.astype(np.float32), local, length[pick], share, value, kept, len(used))
            halves = [dg[:, d * 3 * HIDDEN:(d + 1) * 3 * HIDDEN] for d in (0, 1)]
            g["W"], g["b"] = np.stack([xs.T @ h for h in halves]), np.stack([h.sum(axis=0) for h in halves])
            dx = sum(h @ model.p["W"][d].T for d, h in enumerate(halves))
            step += 1
            for k, v in g.items():  # Adam
                m, s = memory[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                model.p[k] -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
            for k, rows_of, dv in (("word", word_of[used], dx[:, :DIM]),
                                   ("gram", grams, np.repeat(dx[:, DIM:] / scale[used], n, axis=0))):
                np.add.at(memory[k][1], rows_of, dv * dv)  # Adagrad on the rows that occur
                np.subtract.at(model.p[k], rows_of, 0.02 * dv / (np.sqrt(memory[k][1][rows_of]) + 1e-3))
    return model


class Scorer:
    def __init__(self, params: dict[str, np.ndarray]):
        self.model = Model()
        self.model.p = params
        self.place: dict[str, int] = {}
        self.table = np.zeros((4096, 6 * HIDDEN), np.float32)

    def _ids(self, words: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self.place))
        if new:
            at = len(self.place)
            need = at + len(new)
            if need > len(self.table):
                self.table = np.vstack([self.table, np.zeros((max(need, 2 * at) - len(self.table), 6 * HIDDEN), np.float32)])
            self.table[at:need] = self.model.gates(self.model.inputs(new))
            self.place.update(zip(new, range(at, need)))
        place = self.place
        return np.fromiter((place[w] for w in words), np.int64, len(words))

    def scores(self, texts: list[str | None]) -> list[float]:
        if len(self.place) > CACHED_WORDS:
            self.place.clear()
            self.table = np.zeros((4096, 6 * HIDDEN), np.float32)
        rows = [self._ids(split(x)) for x in texts]
        top = np.full(len(rows), -np.inf)
        whole = [(k, s) for k, row in enumerate(rows) if len(row) >= WINDOW for s, _ in windows(len(row))]
        for i in range(0, len(whole), AT_ONCE):
            part = whole[i:i + AT_ONCE]
            ids = np.stack([rows[k][s:s + WINDOW] for k, s in part])
            logits = self.model.score(self.table, ids, np.full(len(part), WINDOW))
            np.maximum.at(top, [k for k, _ in part], logits)
        short = sorted((k for k, row in enumerate(rows) if len(row) < WINDOW), key=lambda k: len(rows[k]))
        for i in range(0, len(short), AT_ONCE):  # of about one length, so few steps are idle
            part = short[i:i + AT_ONCE]
            length = np.array([len(rows[k]) for k in part])
            ids = np.zeros((len(part), max(1, length[-1])), np.int64)
            for at, k in enumerate(part):
                ids[at, :length[at]] = rows[k]
            top[part] = self.model.score(self.table, ids, length)
        return _sigmoid(top).tolist()


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the rows of ``labels`` that are not held out. SAMPLE_TEXTS
    texts of each class come to the driver, weighted to the classes' shares."""
    rows = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(
        ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    texts, marks, weights = [], [], []
    for toxic in share:
        ids = rows.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_TEXTS)
        got = docs.join(F.broadcast(ids), "doc_id").where(
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")) <= SAMPLE_WORDS).select(
            "doc_id", "text").limit(2 * SAMPLE_TEXTS).collect()
        got = {(r.doc_id, r.text) for r in got}
        for _, text in sorted(got, key=lambda x: (x[0], x[1] or "")):
            texts.append(split(text))
            marks.append(int(toxic))
            weights.append(share[toxic] / sum(share.values()) / len(got))
    mean = sum(weights) / max(1, len(weights))
    return train(texts, marks, [w / mean for w in weights])


def score_documents(docs: DataFrame, labels: DataFrame | None = None, model: Model | None = None) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, held_out, score, predicted)``.

    Null and empty texts, and texts without words, get the score of no word.
    A null id counts as not held out and teaches nothing; repeated rows give
    repeated rows. Other columns, and the labels, are no input of a score.
    """
    params = (model or fit(docs, labels)).p

    def make():
        scorer = Scorer(params)
        return lambda cols: {"doc_id": cols["doc_id"], "score": scorer.scores(cols["text"])}

    return map_rows(docs.select("doc_id", "text"), "doc_id long, score double", make).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
