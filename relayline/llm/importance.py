"""Quality by importance resampling.

Texts are bags of hashed n-grams (words, marks, pairs of neighbours, and one
gram for a word that repeats its neighbour). Two generative models are bags of
gram probabilities: the target's from documents labelled good, the raw one
from all documents. A document's importance weight is the ratio of its
probabilities under both; documents are sampled without replacement in
proportion to weight ** (1 / temperature), by taking the k highest of
log weight / temperature + Gumbel noise.

How many to take is read off the labels: k is the number of documents on the
good side of the cut that parts the labelled documents best.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayline.llm.common import arrow_schema, map_arrow, map_rows, materialize, set_aside, small

BUCKETS = 1 << 14
#: The bounded sample of labelled documents, by the hash of the id.
SAMPLE_LABELS = 20_000
TEMPERATURE = 0.1
#: A good document lost counts as so many bad ones kept when the cut is set.
LOST = 3
#: Words whose hash a task keeps; beyond it the memory starts anew. It only saves time.
CACHED_WORDS = 50_000
_GRAM = re.compile(r"\w+|[^\w\s]+")
_REPEAT = zlib.crc32(b"<repeat>") % BUCKETS


class Grams:
    def __init__(self):
        self.known: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        h = zlib.crc32(word.encode("utf-8", "replace"))
        if len(self.known) >= CACHED_WORDS:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = h
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        """The buckets of all n-grams of a text."""
        known = self.known
        h = np.array([known[w] if w in known else self._hash(w) for w in _GRAM.findall(text or "")], dtype=np.int64)
        repeats = int((h[1:] == h[:-1]).sum())
        return np.concatenate([h, h[:-1] * 31 + h[1:], np.full(repeats, _REPEAT)]) % BUCKETS


def _labelled(labels: DataFrame) -> DataFrame:
    """At most SAMPLE_LABELS ``(doc_id, good)``; conflicting labels are left out."""
    rows = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("good"), F.max("quality").alias("most")).where("good = most")
    return rows.select("doc_id", "good").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_LABELS)


def fit(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """The log ratio of target to raw per bucket. Counts are over all
    documents; BUCKETS rows come to the driver."""
    schema = T._parse_datatype_string("bucket int, every long, target long")
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = Grams(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in small(batch):
                for text, good in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = np.bincount(grams(text), minlength=BUCKETS)
                    counts[0] += found
                    if good == 1:
                        counts[1] += found
        on = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(
            (on, counts[0][on], counts[1][on]), out)], schema=out)

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "good")
    total = map_arrow(rows, run, schema).groupBy("bucket").agg(F.sum("every"), F.sum("target")).collect()
    counts = np.ones((2, BUCKETS))
    for bucket, every, target in total:
        counts[:, bucket] += every, target
    if counts[1].sum() == BUCKETS:  # no good document is known
        return np.zeros(BUCKETS)
    share = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return share[1] - share[0]


def gumbel(doc_id: Column, seed: int) -> Column:
    share = (F.shiftright(F.xxhash64(F.lit(seed), doc_id), 11) + F.lit(1 << 52) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(share))


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with ``n_grams`` and ``log_weight`` (names that ``docs`` has
    already are not allowed here; callers select)."""
    schema = T.StructType([*docs.schema.fields, T.StructField("n_grams", T.LongType()),
                           T.StructField("log_weight", T.DoubleType())])

    def make():
        grams = Grams()

        def step(cols):
            found = [grams(x) for x in cols["text"]]
            cols["n_grams"] = [len(x) for x in found]
            cols["log_weight"] = [float(ratio[x].sum()) for x in found]
            return cols
        return step

    return map_rows(docs, schema, make)


def cut(scored: list[tuple[float, int]]) -> float:
    """The log weight that parts (log weight, good) pairs at the least cost;
    of equal cuts the one in the widest gap. Without both classes, no cut."""
    scored = sorted(scored)
    x, good = np.array([s for s, _ in scored]), np.array([g for _, g in scored])
    if not len(x) or good.min() == good.max():
        return -np.inf
    cost = LOST * np.r_[0, np.cumsum(good)] + np.r_[np.cumsum((1 - good)[::-1])[::-1], 0]
    gap = np.r_[0.0, np.diff(x), 0.0]
    at = max(np.flatnonzero(cost == cost.min()), key=lambda i: gap[i])
    return -np.inf if at == 0 else float(x[-1]) + 1 if at == len(x) else float(x[at - 1] + x[at]) / 2


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value of a column without nulls, from counts in ever
    narrower ranges; ``bins`` rows come to the driver each time."""
    rows = df.select(F.col(column).alias("x"))
    low, high = rows.agg(F.min("x"), F.max("x")).first()
    while low < high:
        place = F.least(F.floor((F.col("x") - low) / F.lit(high - low) * bins), F.lit(bins - 1)).cast("int")
        found = rows.where(F.col("x").between(low, high)).groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        for r in sorted(found, key=lambda r: -r.bin):
            if k <= r.n:
                low, high = r.low, r.high
                break
            k -= r.n
        if k == 1:
            return high
        if len(found) == 1:  # neighbours in floating point
            break
    return low


def sample(docs: DataFrame, labels: DataFrame, temperature: float = TEMPERATURE, seed: int = 11):
    """The scored documents ``(doc_id, n_grams, log_weight, noisy)``, the
    model, and the value of ``noisy`` from which on documents are taken."""
    docs, known = docs.select("doc_id", "text"), materialize(_labelled(labels), "quality-labels")
    ratio = fit(docs, known)
    scored = materialize(weigh(docs, ratio).select(
        "doc_id", "n_grams", "log_weight", noisy(temperature, seed).alias("noisy")), "quality-weights")
    pairs = scored.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(
        F.avg("log_weight").alias("x"), F.first("good").alias("good")).collect()
    border = cut([(r.x, r.good) for r in pairs])
    k = scored.where(F.col("log_weight") >= F.lit(border)).count()
    least = kth_largest(scored, "noisy", k) if k else float("inf")
    return scored, ratio, least


def noisy(temperature: float, seed: int) -> Column:
    return F.col("log_weight") / temperature + gumbel(F.col("doc_id"), seed)


def resample(docs: DataFrame, labels: DataFrame, temperature: float = TEMPERATURE, seed: int = 11) -> DataFrame:
    """``doc_id, n_grams, log_weight, noisy, kept`` for every row.

    Null and empty texts have no n-grams and weight 1. Ties at the last place
    all stay, so repeated rows go together; reruns agree. Without labels of
    both kinds every document stays. Other columns are ignored."""
    scored, _, least = sample(docs, labels, temperature, seed)
    return scored.withColumn("kept", F.col("noisy") >= F.lit(least))


def keep(docs: DataFrame, labels: DataFrame, temperature: float = TEMPERATURE, seed: int = 11) -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, with their columns. They
    are weighed again as they pass, which no shuffle of the texts matches."""
    _, ratio, least = sample(docs, labels, temperature, seed)
    rows, back = set_aside(docs, "doc_id", "text")
    return weigh(rows, ratio).where(noisy(temperature, seed) >= F.lit(least)).select(*back)
