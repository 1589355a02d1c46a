"""N-gram Jaccard join by parity sketches.

A document is its set of word n-grams. Each n-gram flips one bit of a sketch,
so the Hamming distance of two sketches is at most the symmetric difference
of the sets. Documents of about one size (a band: sizes from 2^k up to
2^(k+1); the larger document of a pair decides) have sketches of one length,
cut into parts. At similarity J, sets of a and b differ by
d <= (1 - J) / (1 + J) * (a + b) n-grams, so at most d parts differ, and with
more than d parts that hold n-grams some part is equal (pigeonhole). By the
prefix argument it is enough to sign, in one order for all, the first d + 1
of a document's parts that hold n-grams; parts that hold many come first, as
few other documents share them. A small document whose n-grams fall in too
few parts is short: it is signed by single n-grams as well (each its own
part, so that enough are there), and one more pass signs the documents that
share them the same way. Documents that share a signature are compared
by sketch, in blocks, and what the bound leaves is verified on the n-grams.

The result is exact but for collisions of 64-bit hashes. Copies are one class
before signing. Groups of near copies are not expanded into all pairs: two
rounds verify spanning forests of the buckets, closest pairs first, and a
last round compares what is left between components inside its blocks, n-grams
at hand, and hands over a forest of links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayline.llm.common import components, grouped, map_rows, materialize, tidy

BLOCK = 1024          # documents of a bucket that meet another block at once
HOT = 64              # in the first round, larger buckets are taken by one in SHARE
SHARE = 4
WINDOW = 1 << 16      # signatures of a task that are matched before any is sent
GRAMS = 1 << 22       # n-grams of a block's documents in the last round, about
SHORT_BITS = 1 << 23
BROADCAST_IDS = 500_000
_MASK = np.uint64(31)
_ALONE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of ``size`` words; a shorter
    text is one n-gram, a text without words has none."""
    from pandas.util import hash_array
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = hash_array(np.array(words, dtype=object), categorize=False)
    width = min(size, len(h))
    total = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i]
    return np.unique(mix(total))


class Sketcher:
    """Similarity ``percent`` / 100 or more."""

    def __init__(self, percent: int):
        self.percent = percent

    def differ(self, a, b):
        """The most n-grams that sets of a and b may differ by."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def largest(self, n: int) -> int:
        return 100 * n // self.percent

    def bands(self, n: int) -> list[int]:
        """The band of size n, and the next if a partner may lie in it."""
        own = n.bit_length() - 1
        return [own, own + 1] if self.largest(n) >> (own + 1) else [own]

    def sign(self, h: np.ndarray, band: int):
        """(signatures, sketch, short) in a band; ``short``: too few parts
        hold n-grams for the pigeonhole."""
        bits, parts = max(8, 3 + band), 5
        while 1 << parts < 1.3 * self.differ(2 << band, self.largest(2 << band)):
            parts += 1
        at = (mix(h) & np.uint64((1 << bits) - 1)).astype(np.int64)
        order = np.argsort(at >> (bits - parts), kind="stable")
        part = (at >> (bits - parts))[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        held = np.diff(np.r_[starts, len(part)])
        value = mix(np.bitwise_xor.reduceat(h[order], starts) + part[starts].astype(np.uint64))
        need = self.need(h)
        first = np.lexsort((value, -held))[:need]
        sketch = np.packbits((np.bincount(at, minlength=1 << bits) & 1).astype(np.uint8)).tobytes()
        return self._in_band(value[first], band), sketch, len(first) < need

    def need(self, h: np.ndarray) -> int:
        return int(self.differ(len(h), self.largest(len(h)))) + 1

    def sign_grams(self, h: np.ndarray, band: int) -> np.ndarray:
        """Signatures with a part for every n-gram: always as many as needed."""
        return self._in_band(np.sort(mix(h ^ _ALONE))[:self.need(h)], band)

    def _in_band(self, value: np.ndarray, band: int) -> np.ndarray:
        return ((value & ~_MASK) | np.uint64(band)).view(np.int64)


def class_key(h: np.ndarray) -> int:
    """One key per set of n-grams; positive."""
    with np.errstate(over="ignore"):
        key = mix(np.array([np.bitwise_xor.reduce(mix(h)) + h.sum() * np.uint64(3) + np.uint64(len(h))]))
    return int(key[0] >> np.uint64(1))


def _sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """A row per document (``own``), and one per further band. A class is
    signed at its first document in a task only."""
    def make():
        sketcher, seen = Sketcher(percent), set()

        def step(cols):
            out = {c: [] for c in ("doc_id", "n", "key", "own", "band", "sigs", "sketch", "short")}

            def add(*row):
                for c, v in zip(out.values(), row):
                    c.append(v)

            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                h = shingles(text, size)
                if not len(h) or doc_id is None:
                    add(doc_id, len(h), None, True, None, None, None, False)
                    continue
                key = class_key(h)
                if key in seen:
                    add(doc_id, len(h), key, True, None, None, None, False)
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(key)
                for i, band in enumerate(sketcher.bands(len(h))):
                    sigs, sketch, short = sketcher.sign(h, band)
                    if short:
                        sigs = np.r_[sigs, sketcher.sign_grams(h, band)]
                    add(doc_id, len(h), key, i == 0, band, sigs, sketch, short)
            return out
        return step

    return map_rows(docs.select("doc_id", "text"), "doc_id long, n int, key long, own boolean, band int, "
                                                   "sigs array<long>, sketch binary, short boolean", make)


def _sign_short(docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame | None:
    """``(key, sigs)``: the signatures by single n-grams that documents have in
    common with short ones, as a bitmap of a fixed size tells; None without
    short ones. One pass, whatever their number."""
    short = rows.where("short").select(F.explode("sigs").alias("sig"))
    if short.isEmpty():
        return None
    place = F.pmod(F.xxhash64("sig"), F.lit(SHORT_BITS)) + 1
    bits = np.zeros(SHORT_BITS // 8, np.uint8)
    for r in short.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect():
        part = np.frombuffer(r.bits, np.uint8)
        bits[(r.bucket - 1) * len(part):r.bucket * len(part)] = part
    bits = bits.tobytes()

    def make():
        sketcher = Sketcher(percent)

        def step(cols):
            out = {"key": [], "sigs": []}
            for text in cols["text"]:
                h = shingles(text, size)
                for band in sketcher.bands(len(h)) if len(h) else ():
                    out["key"].append(class_key(h))
                    out["sigs"].append(sketcher.sign_grams(h, band))
            return out
        return step

    signed = map_rows(docs.where("doc_id IS NOT NULL").select("text"), "key long, sigs array<long>", make)
    signed = signed.select("key", F.explode("sigs").alias("sig"))
    place = F.pmod(F.xxhash64("sig"), F.lit(SHORT_BITS))
    byte = F.conv(F.hex(F.substring(F.lit(bits), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    hit = F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1
    return materialize(signed.where(hit).groupBy("key").agg(F.collect_set("sig").alias("sigs")), "join-short")


def _deal(batches):
    """Of (key, sig) rows, (sig, key, shared, done): signatures that two
    classes of a WINDOW share are done but for one, which goes to meet
    other tasks' like those not shared yet. So a signature that very many
    documents have comes to its meeting once per window."""
    def window(keys, sigs):
        key, sig = np.concatenate(keys), np.concatenate(sigs)
        order = np.lexsort((key, sig))
        key, sig = key[order], sig[order]
        new = np.r_[True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])]
        key, sig = key[new], sig[new]  # a class once
        first = np.r_[True, sig[1:] != sig[:-1]]
        at = np.flatnonzero(first)
        shared = np.repeat(np.diff(np.r_[at, len(sig)]) > 1, np.diff(np.r_[at, len(sig)]))
        rows = pa.RecordBatch.from_arrays([pa.array(sig), pa.array(key), pa.array(shared), pa.array(~first)],
                                          names=["sig", "key", "shared", "done"])
        for at in range(0, len(sig), 1 << 14):  # small batches keep the JVM's buffers small
            yield rows.slice(at, 1 << 14)

    keys, sigs, held = [], [], 0
    for batch in batches:
        sigs.append(batch.column("sig").to_numpy().copy())
        keys.append(batch.column("key").to_numpy().copy())
        held += batch.num_rows
        if held >= WINDOW:
            yield from window(keys, sigs)
            keys, sigs, held = [], [], 0
    if held:
        yield from window(keys, sigs)
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def _met(batches):
    """Of rows sorted by signature, those whose signature two classes have."""
    rest = None
    for batch in _and_end(batches):
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "key", "shared", "done")} if batch else None
        if rest is not None:
            rows = {c: np.r_[rest[c], rows[c]] for c in rest} if rows else rest
        if rows is None or not len(rows["sig"]):
            continue
        start = np.flatnonzero(np.r_[True, rows["sig"][1:] != rows["sig"][:-1]])
        if batch:  # the last signature may go on
            rest, rows, start = {c: v[start[-1]:] for c, v in rows.items()}, {c: v[:start[-1]] for c, v in rows.items()}, start[:-1]
            if not len(start):
                continue
        size = np.diff(np.r_[start, len(rows["sig"])])
        met = np.logical_or.reduceat(rows["shared"], start)
        met |= np.minimum.reduceat(rows["key"], start) != np.maximum.reduceat(rows["key"], start)
        keep = np.repeat(met, size) | rows["done"]
        yield pa.RecordBatch.from_arrays([pa.array(rows["sig"][keep]), pa.array(rows["key"][keep])], names=["sig", "key"])


def _and_end(batches):
    yield from (b for b in batches if b.num_rows)
    yield None


def _buckets(signed: DataFrame) -> DataFrame:
    """``(sig, key)`` of the signatures that two classes share, in one shuffle."""
    dealt = signed.select("key", F.explode("sigs").alias("sig")).mapInArrow(_deal, "sig long, key long, shared boolean, done boolean")
    place = F.when(F.col("done"), F.xxhash64("sig", "key")).otherwise(F.col("sig"))
    met = dealt.repartition(place).sortWithinPartitions("sig").mapInArrow(_met, "sig long, key long")
    return _once(materialize(met, "join-met").distinct())


def _once(members: DataFrame) -> DataFrame:
    """``members`` with one of the buckets of a band that have the same keys."""
    sizes = members.groupBy("sig").agg(
        F.count(F.lit(1)).alias("count"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"))
    chosen = sizes.groupBy("count", "sum", F.col("sig").bitwiseAND(31).alias("band")).agg(F.min("sig").alias("sig"))
    return members.join(chosen.select("sig"), "sig", "left_semi").select("sig", "key")


def _left_in_block(percent: int):
    """Keys of the documents that sketches leave a pair of."""
    def make():
        inside = _pairs_in_block(percent, None)()

        def step(rows):
            found = inside(rows)
            key = sorted({*found["a"], *found["b"]})
            return {"sig": [rows["sig"][0].as_py()] * len(key), "key": key}
        return step
    return make


def _links_in_block(percent: int):
    """A forest of links between components of a group's rows (two blocks of a
    bucket), verified on their n-grams as it grows: pairs inside a component
    need no verification any more."""
    def make():
        inside = _pairs_in_block(percent, None)()

        def step(rows: pa.Table) -> dict:
            found = inside(rows)
            keys = rows["key"].to_pylist()
            label = dict(zip(keys, rows["label"].to_pylist()))
            held = {k: np.frombuffer(x, np.uint64) for k, x in zip(keys, rows["set"].to_pylist())}
            up: dict = {}

            def top(x):
                while x in up:
                    x = up[x]
                return x
            links = [], []
            for a, b in zip(found["a"], found["b"]):
                x, y = top(label[a]), top(label[b])
                if x != y and _similar(held[a], held[b], percent):
                    up[max(x, y)] = min(x, y)
                    links[0].append(a)
                    links[1].append(b)
            return {"a": links[0], "b": links[1]}
        return step
    return make


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    same = len(np.intersect1d(x, y, True))
    return 100 * same >= percent * (len(x) + len(y) - same)


def _pairs_in_block(percent: int, forest: bool | None):
    """Of a group's rows (two blocks of a bucket), pairs of different
    components that the sketches leave: all, or a spanning forest that takes
    the closest first."""
    def make():
        sketcher = Sketcher(percent)

        def step(rows: pa.Table) -> dict:
            key, n = rows["key"].to_numpy(), rows["n"].to_numpy().astype(np.int64)
            block, label = rows["block"].to_numpy(), rows["label"].to_numpy()
            words = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(len(key), -1)
            pad = -words.shape[1] % 8
            words = np.ascontiguousarray(np.pad(words, ((0, 0), (0, pad)))).view(np.uint64)
            low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
            left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
            a, b, far = [], [], []
            for i in left:
                to = right[right > i] if low == high else right
                bound = sketcher.differ(n[i], n[to])
                to = to[(label[to] != label[i]) & (np.abs(n[to] - n[i]) <= bound)]
                if len(to):
                    d = np.bitwise_count(words[to] ^ words[i]).sum(axis=1, dtype=np.int64)
                    on = d <= sketcher.differ(n[i], n[to])
                    a.append(np.full(on.sum(), i))
                    b.append(to[on])
                    far.append(d[on])
            if not a:
                return {"sig": [], "a": [], "b": []}
            a, b, far = map(np.concatenate, (a, b, far))
            if forest:
                a, b = _forest(a, b, far, np.unique(label, return_inverse=True)[1])
            x, y = key[a], key[b]
            return {"sig": [rows["sig"][0].as_py()] * len(x), "a": np.minimum(x, y).tolist(),
                    "b": np.maximum(x, y).tolist()}
        return step
    return make


def _forest(a, b, far, group):
    """Edges of a spanning forest, the closest out of each component at a time."""
    taken = []
    order = np.argsort(far, kind="stable")
    a, b = a[order], b[order]
    alive = np.arange(len(a))
    while True:
        alive = alive[group[a[alive]] != group[b[alive]]]
        if not len(alive):
            taken = np.unique(np.concatenate(taken)) if taken else np.zeros(0, np.int64)
            return a[taken], b[taken]
        best = np.full(len(group), len(a))
        np.minimum.at(best, group[a[alive]], alive)
        np.minimum.at(best, group[b[alive]], alive)
        edges = np.unique(best[best < len(a)])
        taken.append(edges)
        while True:  # union of the components that the edges join
            x, y = group[a[edges]], group[b[edges]]
            if (x == y).all():
                break
            low = np.minimum(x, y)
            to = np.arange(len(group))
            np.minimum.at(to, x, low)
            np.minimum.at(to, y, low)
            group = to[group]


def _in_first_round():
    return (F.col("count") <= HOT) | (F.pmod(F.xxhash64("sig"), F.lit(SHARE)) == 0)


def _groups(members: DataFrame, sketches: DataFrame, labels: DataFrame, first: bool = False) -> DataFrame:
    """Rows of ``(sig, key)`` whose buckets hold two labels, dealt to groups of
    two blocks of a bucket, with label, size and sketch."""
    rows = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    sizes = rows.groupBy("sig").agg(
        F.count(F.lit(1)).alias("count"), F.min("label").alias("first"),
        F.max("label").alias("last")).where("first <> last")
    if first:
        sizes = sizes.where(_in_first_round())
    # In the last round, fewer long documents to a block: their n-grams come along.
    block = F.lit(BLOCK) if "set" not in sketches.columns else F.least(F.lit(BLOCK), F.greatest(F.lit(2), F.lit(
        GRAMS) / F.pow(F.lit(2), F.col("sig").bitwiseAND(31) + 1)))
    rows = rows.join(sizes.select("sig", "count"), "sig").withColumn(
        "blocks", F.ceil(F.col("count") / block).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", "label", "block", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high"), "sig",
                       F.col("sig").bitwiseAND(31).cast("int").alias("band"))
    rows = rows.withColumn("group", F.concat_ws(":", "sig", "low", "high"))
    return rows.join(sketches, ["key", "band"])


def _candidates(members: DataFrame, sketches: DataFrame, labels: DataFrame, percent: int, first: bool,
                name: str) -> DataFrame:
    """``(sig, a, b)``: pairs of classes to verify, spanning forests of the buckets."""
    found = grouped(_groups(members, sketches, labels, first), "group", "sig long, a long, b long",
                    _pairs_in_block(percent, True))
    return materialize(found, name)


def _open(members: DataFrame, found: DataFrame, checked: DataFrame, name: str, skipped: bool = False) -> DataFrame:
    """The ``members`` of buckets that may hold links still unseen. A bucket
    whose forest was verified in full is done: what its sketches left is in
    one component. So those stay with a pair that failed, and those that the
    first round ``skipped``."""
    sigs = found.join(checked.where("NOT linked").select("a", "b"), ["a", "b"], "left_semi").select("sig")
    if skipped:
        sizes = members.groupBy("sig").agg(F.count(F.lit(1)).alias("count"))
        sigs = sigs.unionByName(sizes.where(~_in_first_round()).select("sig"))
    return materialize(members.join(sigs.distinct(), "sig", "left_semi").select("sig", "key"), name)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    left = sets.select(F.col("key").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("set").alias("y"))

    def make():
        def step(cols):
            linked = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                      for x, y in zip(cols["x"], cols["y"])]
            return {"a": cols["a"], "b": cols["b"], "linked": linked}
        return step

    return materialize(map_rows(pairs.join(left, "a").join(right, "b"), "a long, b long, linked boolean", make), name)


def _sets(docs: DataFrame, keys: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """The n-gram sets of the classes in ``keys``, from one document each."""
    wanted = materialize(classes.join(keys, "key").select("key", F.col("first_id").alias("doc_id")), "join-wanted")
    few = wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, "doc_id")

    def make():
        def step(cols):
            sets = [shingles(x, size) for x in cols["text"]]
            on = [i for i, h in enumerate(sets) if len(h) and class_key(h) == cols["key"][i]]
            return {"key": [cols["key"][i] for i in on], "set": [sets[i].tobytes() for i in on]}
        return step

    return materialize(map_rows(rows.select("key", "text"), "key long, set binary", make), "join-sets")


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, n_shingles, component_id)``, one row
    per row; documents link at 100 * intersection >= percent * union.

    Words are runs of anything but ASCII white space, A-Z in lower case. A
    null or empty text, or one without words, has no n-grams and is alone in
    its component; so is a row without id, whose component is null. Repeated
    rows are copies. Other columns are ignored.
    """
    return keyed_components(docs, size, percent).drop("key")


@tidy
def keyed_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``jaccard_components`` with the ``key`` of each row's set of n-grams."""
    docs = docs.select("doc_id", "text")
    rows = materialize(_sketches(docs, size, percent), "join-sketches")
    members = rows.where("own").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "key")
    classes = materialize(members.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first_id")),
                          "join-classes")
    signed = rows.where("sigs IS NOT NULL").select("key", "sigs")
    if (more := _sign_short(docs, rows, size, percent)) is not None:
        signed = signed.unionByName(more)
    buckets = materialize(_buckets(signed), "join-buckets")
    sketches = rows.where("sketch IS NOT NULL").select("key", "n", "band", "sketch").join(
        buckets.select("key").distinct(), "key", "left_semi").groupBy("key", "band").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sketches = materialize(sketches, "join-bands")
    none = classes.select("key", F.col("key").alias("label")).limit(0)
    found = _candidates(buckets, sketches, none, percent, True, "join-forest")
    pairs = materialize(found.select("a", "b").distinct(), "join-pairs")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    sets = _sets(docs, keys, classes, size)
    checked = _verify(pairs, sets, percent, "join-first")
    links = checked.where("linked").select("a", "b")
    labels = components(links, "join-components").withColumnRenamed("node", "key")
    labels = materialize(labels, "join-labels")
    buckets = _open(buckets, found, checked, "join-open", skipped=True)
    found = _candidates(buckets, sketches, labels, percent, False, "join-again")
    more = materialize(found.select("a", "b").distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti"),
                       "join-more")
    if not more.isEmpty():
        new = more.select(F.col("a").alias("key")).union(more.select("b")).distinct().join(keys, "key", "left_anti")
        sets = sets if new.isEmpty() else sets.unionByName(_sets(docs, new, classes, size))
        again = _verify(more, sets, percent, "join-second")
        checked = checked.unionByName(again)
        links = links.unionByName(again.where("linked").select("a", "b"))
        labels = materialize(components(links, "join-components").withColumnRenamed("node", "key"), "join-labels")
    buckets = _open(buckets, found, checked, "join-open")
    if not buckets.isEmpty():
        # What two forests left: no pair is written but links.
        left = materialize(grouped(_groups(buckets, sketches, labels), "group", "sig long, key long",
                                   _left_in_block(percent)).distinct(), "join-left")
        if not left.isEmpty():
            whole = sketches.join(_sets(docs, left.select("key").distinct(), classes, size), "key")
            linked = grouped(_groups(_once(left), whole, labels), "group", "a long, b long",
                             _links_in_block(percent))
            links = links.unionByName(materialize(linked.distinct(), "join-last"))
            labels = components(links, "join-components").withColumnRenamed("node", "key")
    labelled = classes.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    lowest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    ids = labelled.join(lowest, "label").select("key", "component_id")
    return members.join(ids, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "key")


def _texts(docs: DataFrame, gone: DataFrame, size: int) -> DataFrame:
    """``(_id, _sha)`` of the documents with the ids and keys in ``gone``."""
    def make():
        def step(cols):
            sets = [shingles(x, size) for x in cols["text"]]
            return {"doc_id": cols["doc_id"], "key": [class_key(h) if len(h) else None for h in sets], "_sha": cols["_sha"]}
        return step

    rows = docs.select("doc_id", "text").join(gone.select("doc_id").distinct(), "doc_id", "left_semi").withColumn(
        "_sha", F.sha2("text", 256))
    found = map_rows(rows, "doc_id long, key long, _sha string", make).join(gone, ["doc_id", "key"], "left_semi")
    return materialize(found.select(F.col("doc_id").alias("_id"), "_sha").distinct(), "join-gone")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id.
    Rows that repeat an id and text are one document. Documents without words
    or id link with nothing and stay."""
    own = keyed_components(docs, size, percent)
    gone = own.where((F.col("doc_id") != F.col("component_id")) & (F.col("n_shingles") > 0)).select(
        "doc_id", "key").distinct()
    again = own.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return _without(docs, gone.select("doc_id"), lambda left, right: "doc_id")
    left = _without(docs, gone.select("doc_id").join(again, "doc_id", "left_anti"), lambda left, right: "doc_id")
    # An id with several texts: those go that are in another's component.
    texts = _texts(docs, gone.join(again, "doc_id", "left_semi"), size)
    left = _without(left, texts, lambda left, right: (left["doc_id"] == right["_id"]) & (
        F.sha2(left["text"], 256) == right["_sha"]))
    alone = left.where("doc_id IS NULL")
    return left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).unionByName(alone)


def _without(docs: DataFrame, gone: DataFrame, on) -> DataFrame:
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, on(docs, gone), "left_anti").select(*docs.columns)
