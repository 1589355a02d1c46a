"""Embedding near-duplicates by iterative quantisation.

Rotations learned on a bounded, centred sample turn vectors into balanced
binary codes; substrings of the codes are the keys of several Hamming tables.
The tables hold packed codes only: of the vectors that share a key, pairs whose
codes differ in few bits are candidates, in the first table that brings them
together. Rows with candidates then get their vectors and are compared by their
cosine in double precision. Equal vectors are one class with a weight before
anything else, so copies cost one row. A bucket of more than BLOCK vectors is split
into blocks, and pairs of blocks are compared in separate groups: all of its
pairs are looked at, none is written out, and no group holds more than two blocks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayline.llm.common import components, grouped, map_rows, materialize, spread, tidy

COSINE = 0.95
SAMPLE = 4000      # distinct vectors that the rotations are learned on
MISS = 0.002       # share of pairs at COSINE exactly that no table finds
BLOCK = 512
MOST = 24          # bits of a key
BITS = 4096        # bits of a code
NEAR = 256         # bits by which candidates are told
SIZED = 16         # one id in so many sizes the buckets


def normal(vector) -> bytes | None:
    """Float64 bytes of the unit vector; None if it takes no part."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    v = np.asarray(vector, dtype=np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()
    return (v / np.sqrt(v @ v)).tobytes()


def raw(vector) -> bytes:
    """The components of a vector that takes part: single precision where that
    is exact, marked by the first byte."""
    v = np.asarray(vector, dtype=np.float64)
    with np.errstate(over="ignore"):
        short = v.astype(np.float32)
    return b"f" + short.tobytes() if (short == v).all() else b"d" + v.tobytes()


def unit(data: bytes) -> np.ndarray:
    """The unit vector of ``raw``'s bytes."""
    kind = np.float32 if data[:1] == b"f" else np.float64
    return np.frombuffer(normal(np.frombuffer(data, dtype=kind, offset=1)))


def itq(x: np.ndarray, seed: int, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """A rotation and a threshold per bit: principal axes of the centred rows,
    turned so that the signs are close to the values; thresholds are medians,
    so bits balance."""
    d, r = x.shape[1], np.random.default_rng(seed)
    turn = np.linalg.qr(r.standard_normal((d, d)))[0]
    if len(x) >= 2 * d:
        c = x - x.mean(axis=0)
        axes = np.linalg.svd(c, full_matrices=True)[2].T if len(c) <= 8 * d else np.linalg.eigh(c.T @ c)[1]
        y = c @ axes
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(y @ turn >= 0, 1.0, -1.0).T @ y)
            turn = (left @ right).T
        turn = axes @ turn
        return turn, np.median(x @ turn, axis=0)
    return turn, np.zeros(d)


def moved(x: np.ndarray, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """The unit vectors of x, and the same turned to cosine COSINE exactly: towards random
    directions, and towards other vectors of x."""
    r = np.random.default_rng(seed)
    out = []
    for to in (r.standard_normal(x.shape), x[r.permutation(len(x))]):
        for _ in range(2):  # twice, as the first leaves rounding errors
            to = to - (to * x).sum(axis=1)[:, None] * x
        size = np.sqrt((to * to).sum(axis=1))
        on = size > 1e-6    # others are copies or opposites
        out.append((x[on], COSINE * x[on] + math.sqrt(1 - COSINE ** 2) * to[on] / size[on, None]))
    return [(a, b) for a, b in out if len(a)]


class Plan:
    """Bits and tables for vectors of length d. Where the rotations are
    learned, the chance that keys agree depends on the data: it is measured on
    sampled vectors moved to COSINE, and the cheapest bits whose tables miss at
    most MISS of them are taken; so is the number of bits by which codes of
    such pairs differ."""

    def __init__(self, d: int, n: int, x: np.ndarray):
        self.d, self.x, self.turns, self.near = d, x, [], 0
        top = min(MOST, max(6, round(math.log2(max(n, 1) / 8 + 1))))
        if d < 2 or len(x) < 2 * d:
            # Random cuts through the origin: a bit differs with chance angle / pi.
            same = (1 - math.acos(COSINE) / math.pi) ** top
            self.bits, self.tables = top, math.ceil(math.log(MISS) / math.log(1 - same))
            self._learn(self.bits * self.tables)
            self.apart = self.bits * self.tables
        else:
            self._measure(n, top)
        del self.x

    def _learn(self, bits: int) -> None:
        while len(self.turns) * self.d < bits:
            self.turns.append(itq(self.x, len(self.turns)))

    def _cost(self, n: int, bits: int, tables: float) -> float:
        """Seconds per vector, about: rows that are shuffled, pairs of codes
        compared. Small tables are planned as larger ones."""
        meet, size = max(n, 1 << 15) / 2 ** bits, bits * tables
        return tables * (max(1.0, meet / BLOCK) * (5e-6 + 1e-8 * (40 + size / 8)) + meet * math.ceil(min(size, NEAR) / 64) * 2e-9)

    def _measure(self, n: int, top: int) -> None:
        pairs, same, best = moved(self.x), [], math.inf
        self.bits = self.tables = 1
        for bits in range(1, top + 1):
            tables = 8
            while tables * bits <= BITS:
                self._learn(bits * tables)
                for turn, at in self.turns[len(same):]:
                    same.append([(a @ turn > at) == (b @ turn > at) for a, b in pairs])
                need, least = 0, 0.0
                for k in range(len(pairs)):
                    agree = np.hstack([s[k] for s in same])[:, :bits * tables]
                    agree = agree.reshape(len(agree), tables, bits).all(axis=2)
                    # The first table that finds each pair, in order.
                    first = np.sort(np.where(agree.any(axis=1), agree.argmax(axis=1), tables))
                    need = max(need, int(first[math.ceil((1 - MISS) * len(first)) - 1]) + 1)
                    # Every further table finds a smaller share of the rest.
                    share = (first == tables).mean()
                    least = max(least, tables * math.log(MISS) / math.log(share) if 0 < share < 1 else share * BITS)
                if need <= tables and self._cost(n, bits, need) < best:
                    self.bits, self.tables, best = bits, need, self._cost(n, bits, need)
                if need <= tables or self._cost(n, bits, least) >= best:
                    break
                tables = max(tables + 8, math.ceil(1.1 * min(least, BITS / bits / 1.1)))
        self.turns = self.turns[:math.ceil(self.bits * self.tables / self.d)]
        self.near = min(self.bits * self.tables, NEAR)
        self.apart = max((int(np.quantile((~np.hstack([s[k] for s in same[:len(self.turns)]])[:, :self.near]).sum(axis=1),
                                          1 - MISS, method="higher")) for k in range(len(pairs))), default=self.near)


class Coder:
    """Codes and keys of vectors. What a length needs is planned once; lengths
    outside the sample get random cuts."""

    def __init__(self, n: int, samples: dict[int, np.ndarray]):
        self.n = n
        self.plans = {d: Plan(d, n, x) for d, x in samples.items()}

    def plan(self, d: int) -> Plan:
        if d not in self.plans:
            self.plans[d] = Plan(d, self.n, np.zeros((0, d)))
        return self.plans[d]

    def bits(self, x: np.ndarray) -> np.ndarray:
        plan = self.plan(x.shape[1])
        return np.hstack([x @ turn > at for turn, at in plan.turns])[:, :plan.tables * plan.bits]

    def keys(self, x: np.ndarray, bits: np.ndarray | None = None) -> np.ndarray:
        """One key per table for each row of x."""
        d, plan = x.shape[1], self.plan(x.shape[1])
        bits = self.bits(x) if bits is None else bits
        place = (1 << np.arange(plan.bits, dtype=np.int64))
        return (bits.reshape(len(x), plan.tables, plan.bits) * place).sum(axis=2) + (d << 32)


def _place(group: str) -> tuple[int, int, int, int]:
    """Table, length of the vectors, and the two blocks that a group compares."""
    nth, key, low, high = map(int, group.split(":"))
    return nth, key >> 32, low, high


def _sides(rows: pa.Table, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    block = rows.column("block").to_numpy()
    return np.flatnonzero(block == low), np.flatnonzero(block == high)


def _codes(rows: pa.Table, size: int) -> np.ndarray:
    data = np.frombuffer(b"".join(rows.column("code").to_pylist()), dtype=np.uint8).reshape(len(rows), -1)
    return np.unpackbits(data, axis=1, count=size)


def _first(codes: np.ndarray, a: np.ndarray, b: np.ndarray, nth: int, bits: int) -> np.ndarray:
    """Whether no table before the nth brings the rows a and b together."""
    if not nth:
        return np.ones(len(a), bool)
    equal = (codes[a, :nth * bits] == codes[b, :nth * bits]).reshape(len(a), nth, bits)
    return ~equal.all(axis=2).any(axis=1)


def _candidates(coder: Coder):
    """Rows of a group that have a partner by their codes."""
    def make():
        def step(rows: pa.Table) -> dict:
            ids = rows.column("id").to_numpy()
            nth, d, low, high = _place(rows.column("group")[0].as_py())
            plan = coder.plan(d)
            left, right = _sides(rows, low, high)
            on = np.zeros(len(ids), bool)
            if len(left) and len(right) and len(ids) > 1:
                codes = _codes(rows, plan.bits * plan.tables)
                near = np.packbits(codes[:, :plan.near or 1], axis=1)
                near = np.pad(near, ((0, 0), (0, -near.shape[1] % 8))).view(np.uint64)
                most = max(1, (1 << 18) // len(right))
                for at in range(0, len(left), most):
                    part = left[at:at + most]
                    if plan.near:
                        apart = np.zeros((len(part), len(right)), np.uint16)
                        for w in range(near.shape[1]):
                            apart += np.bitwise_count(near[part, w][:, None] ^ near[right, w][None, :])
                        close = apart <= plan.apart
                    else:
                        close = np.ones((len(part), len(right)), bool)
                    if low == high:
                        close &= part[:, None] < right[None, :]
                    i, j = np.nonzero(close)
                    for k in range(0, len(i), 1 << 13):
                        a, b = part[i[k:k + (1 << 13)]], right[j[k:k + (1 << 13)]]
                        first = _first(codes, a, b, nth, plan.bits)
                        on[a[first]] = on[b[first]] = True
            at = np.flatnonzero(on)
            return {"id": ids[at].tolist(), "group": [rows.column("group")[0].as_py()] * len(at),
                    "block": rows.column("block").to_numpy()[at].tolist()}
        return step
    return make


def _compare(coder: Coder):
    """Links and labels within a group, by cosine; a pair counts in the first
    table that brings it together."""
    def make():
        def step(rows: pa.Table) -> dict:
            ids, weight = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
            nth, d, low, high = _place(rows.column("group")[0].as_py())
            plan = coder.plan(d)
            left, right = _sides(rows, low, high)
            x = np.array([unit(v) for v in rows.column("vec").to_pylist()])
            codes = _codes(rows, plan.bits * plan.tables)
            close = x[left] @ x[right].T >= COSINE
            if low == high:
                close = np.triu(close, 1)
            i, j = np.nonzero(close)
            first = np.concatenate([np.zeros(0, bool)] + [
                _first(codes, left[i[k:k + (1 << 13)]], right[j[k:k + (1 << 13)]], nth, plan.bits)
                for k in range(0, len(i), 1 << 13)])
            a, b = left[i][first], right[j][first]
            links = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
            label = spread(ids, a, b)
            on = np.flatnonzero(links)
            return {"id": ids[on].tolist(), "links": links[on].astype(np.int64).tolist(), "label": label[on].tolist()}
        return step
    return make


@tidy
def near_vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` to ``(vec_id, n_links, component_id, kept)``,
    one row per row.

    Vectors that are null, empty, zero, or hold null or non-finite components,
    and rows without id, link with nothing; so do vectors of different
    lengths. Repeated rows count as so many vectors. Links below COSINE are
    never made; above it the tables, and the bits by which candidates are told,
    each miss about MISS of the pairs at exactly COSINE, as measured on the sample, and fewer beyond. Other columns are ignored.
    """
    def clean():
        def step(cols):
            vec, name = [], []
            for k, v in zip(cols["vec_id"], cols["embedding"]):
                part = None if k is None else normal(v)
                vec.append(None if part is None else raw(v))
                name.append(None if part is None else hashlib.sha256(part).digest())
            return {"vec_id": cols["vec_id"], "vec": vec, "of": name}
        return step

    # ``of`` names the unit vector: SHA-256 of its bytes
    all_rows = materialize(map_rows(rows.select("vec_id", "embedding"), "vec_id long, vec binary, of binary", clean),
                           "vectors")
    classes = materialize(all_rows.where("vec IS NOT NULL").groupBy("of").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("vec").alias("vec")), "vector-classes")
    n = classes.count()
    sample = classes.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    lengths: dict[int, list] = {}
    for r in sample:
        x = unit(bytes(r.vec))
        lengths.setdefault(len(x), []).append(x)
    coder = Coder(n, {d: np.array(x) for d, x in lengths.items()})

    def encode():
        def step(cols):
            codes, keys = [None] * len(cols["id"]), [None] * len(cols["id"])
            units = [unit(v) for v in cols["vec"]]
            sizes: dict[int, list[int]] = {}
            for k, v in enumerate(units):
                sizes.setdefault(len(v), []).append(k)
            for part in sizes.values():
                x = np.array([units[k] for k in part])
                bits = coder.bits(x)
                for k, code, key in zip(part, np.packbits(bits, axis=1), coder.keys(x, bits).tolist()):
                    codes[k], keys[k] = code.tobytes(), key
            return {"id": cols["id"], "vec": cols["vec"], "copies": cols["copies"], "code": codes, "keys": keys}
        return step

    coded = materialize(map_rows(classes.select("id", "vec", "copies"),
                                 "id long, vec binary, copies long, code binary, keys array<long>", encode), "vector-codes")
    keyed = coded.select("id", "code", F.posexplode("keys").alias("nth", "key"))
    # Sizes are estimated: they only say in how many blocks a bucket is compared.
    sizes = keyed.where(F.pmod(F.xxhash64("id"), F.lit(SIZED)) == 0).groupBy("nth", "key").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK / SIZED).select(
        "nth", "key", F.ceil(F.col("n") * SIZED / BLOCK).cast("int").alias("blocks"))
    placed = keyed.join(sizes, ["nth", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("id", "block", "code", F.concat_ws(
        ":", "nth", "key", F.least("block", "other"), F.greatest("block", "other")).alias("group"))
    found = materialize(grouped(placed, "group", "id long, group string, block int", _candidates(coder)), "vector-candidates")
    linked = found.join(coded.select("id", "vec", "copies", "code"), "id")
    links_of = materialize(grouped(linked, "group", "id long, links long, label long", _compare(coder)), "vector-links")
    links = links_of.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(links_of.select(F.col("id").alias("a"), F.col("label").alias("b")), "vector-components")
    per_class = classes.select("of", "id", "copies").join(links, "id", "left").join(
        labels.withColumnRenamed("node", "id"), "id", "left").select(
        "of", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("label", "id").alias("label"))
    return all_rows.select("vec_id", "of").join(per_class, "of", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("label", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("label"), F.lit(True)).alias("kept"))
