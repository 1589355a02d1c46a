"""Phrase collocations from depth-truncated suffix subtrees.

The suffixes of all pieces of text, cut after three words, form one tree per
language; its nodes are the phrases, and a node's count is the total of the
leaves below it. The tree is never built whole: word prefixes are counted
first, a prefix of more than ``BUDGET`` suffixes is extended by a word (as in
ERA's vertical partitioning), and the prefixes that result are packed into
groups of about ``BUDGET`` suffixes. A task builds the subtrees of a group
from its suffixes alone: it sorts them, finds with how many words neighbours
agree, and adds up leaves and then inner nodes. A suffix ends before a word
that occurs less often than a phrase has to, as no such phrase holds it.

Which group a suffix belongs to is a function of its words and of a plan of
fixed size: 2^16 slices of a hash with their groups, and bitmaps of the words
that are frequent and of the prefixes that are extended. A word or prefix that
shares another's bit is kept or extended too, which changes no count.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from relayline.llm.common import arrow_schema, grouped, materialize, small, tidy

#: A-Z in lower case, ends of pieces as line feeds, tabs as blanks.
WORDS = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
BUDGET = 1 << 20      # suffixes of a group, as counted
FLUSH = 1 << 20       # words that a task codes before it hands their phrases over
SLICES = 1 << 16
BITS = 1 << 23        # of a bitmap
SALT = 64
PARTS = 1_000_000     # of a score


def pieces(text: bytes | None) -> Iterator[list[bytes]]:
    for piece in (text or b"").translate(WORDS).split(b"\n"):
        if words := piece.split():
            yield words


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words, pieces one after another as numbers of the words,
    each closed by two -1) for FLUSH words or the end of the task. A longer
    piece comes in parts; the two words behind a part follow it as -3 - number."""
    state: dict[str, tuple[dict, array]] = {}
    held = 0

    def out():
        for lang, (number, ids) in state.items():
            yield lang, list(number), np.frombuffer(ids, np.int32)

    for batch in batches:
        for part in small(batch, 1 << 20):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                for words in pieces(text):
                    for at in range(0, len(words), FLUSH):
                        if lang not in state:
                            number: dict = defaultdict()
                            number.default_factory = number.__len__
                            state[lang] = number, array("i")
                        number, ids = state[lang]
                        ids.extend(map(number.__getitem__, words[at:at + FLUSH]))
                        # Words behind a part are there to end its suffixes, and start none.
                        ids.extend(-3 - number[w] for w in words[at + FLUSH:at + FLUSH + 2])
                        ids.extend((-1, -1))
                        held += len(words[at:at + FLUSH])
                        if held >= FLUSH:
                            yield from out()
                            state, held = {}, 0
    yield from out()


def _tally(rows: DataFrame, schema: str, make) -> DataFrame:
    """``make()``'s Arrow columns of every coded stretch of a task."""
    out = arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        step = make()
        for lang, words, ids in _coded(batches):
            cols = step(lang, words, ids)
            if len(cols[-1]):
                cols = [pa.array([lang]).take(pa.array(np.zeros(len(cols[-1]), np.int32))), *cols]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, out)], schema=out)

    return rows.mapInArrow(run, schema)


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def keys_of(lang: str, phrases) -> np.ndarray:
    """A number of 32 bits per phrase, given as words."""
    head = lang.encode()
    return np.array([zlib.crc32(b"\n".join((head, *p))) for p in phrases], np.int64)


def _key(*columns: str) -> Column:
    """``keys_of`` of columns."""
    return F.crc32(F.concat_ws("\n", "lang", *columns).cast("binary"))


def _bit(*columns: str) -> Column:
    return F.pmod(_key(*columns), F.lit(BITS)).alias("bit")


def _bitmap(bits: DataFrame) -> np.ndarray:
    """The bitmap of a column ``bit``; BITS bits reach the driver."""
    out = np.zeros(BITS // 8, np.uint8)
    place = F.col("bit") + 1
    for r in bits.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect():
        part = np.frombuffer(r.bits, np.uint8)
        at = (r.bucket - 1) * len(part)
        out[at:at + len(part)] = part[:len(out) - at]
    return out


def _is_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    keys = keys % BITS
    return (bitmap[keys >> 3] >> (keys & 7) & 1).astype(bool)


def packed(totals: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For each slice its first group and the number of its groups: slices in
    a row share a group while they fit the budget, a larger one has several."""
    first, parts = np.zeros(len(totals), np.int64), np.ones(len(totals), np.int64)
    group, held = 0, 0
    for i, n in enumerate(totals.tolist()):
        if held and held + n > budget:
            group, held = group + 1, 0
        first[i] = group
        if n > budget:
            parts[i] = -(-n // budget)
            group, held = group + int(parts[i]), 0
        else:
            held += n
    return first, parts


def _subtrees(least: int):
    """Nodes of two and three words that occur ``least`` times, from all
    suffixes of a group."""
    def make():
        def step(rows: pa.Table) -> dict:
            tails = pc.split_pattern(rows["tails"].combine_chunks(), "\n")
            held = pc.list_value_length(tails).to_numpy()
            tail = pc.split_pattern(tails.flatten(), " ")
            at, length = tail.offsets.to_numpy()[:-1], pc.list_value_length(tail).to_numpy()
            coded = pa.concat_arrays([rows["w1"].combine_chunks(), tail.flatten()]).dictionary_encode()
            words, size = coded.dictionary, len(coded.dictionary) + 1
            code = coded.indices.to_numpy().astype(np.int64)
            a, rest = np.repeat(code[:len(held)], held), code[len(held):]
            b, c = rest[at], np.where(length > 1, rest[np.minimum(at + 1, len(rest) - 1)], -1)
            lang = rows["lang"].combine_chunks().dictionary_encode()
            top = np.repeat(lang.indices.to_numpy().astype(np.int64), held) * size + a
            order = np.lexsort((b * size + c, top))
            top, b, c = top[order], b[order], c[order]
            n = rows["n"].combine_chunks().flatten().to_numpy()[order].astype(np.int64)
            whole = np.repeat(rows["whole"].to_numpy(), held)[order]
            new = np.r_[True, (top[1:] != top[:-1]) | (b[1:] != b[:-1])]
            leaf = np.flatnonzero(np.r_[True, new[1:] | (c[1:] != c[:-1])])
            totals = np.add.reduceat(n, leaf)
            inner = np.flatnonzero(new[leaf])
            found = np.add.reduceat(totals, inner)
            two = (found >= least) & whole[leaf[inner]]  # else other groups hold more of it
            three = (totals >= least) & (c[leaf] >= 0)
            at = np.r_[leaf[inner][two], leaf[three]]

            def take(codes):
                return words.take(pa.array(codes, pa.int32())).to_pylist()
            return {"lang": lang.dictionary.take(pa.array(top[at] // size)).to_pylist(),
                    "w1": take(top[at] % size), "w2": take(b[at]),
                    "w3": [None] * int(two.sum()) + take(c[leaf[three]]),
                    "f": np.r_[found[two], totals[three]].tolist()}
        return step
    return make


def _score(a: str, first: str, rest: str) -> Column:
    """floor(10^6 a^2 / (l r)); products may pass 64 bits."""
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"cast({wide(a)} * {wide(a)} as decimal(31,0)) * cast({PARTS} as decimal(7,0))"
                  f" div cast({wide(first)} * {wide(rest)} as decimal(38,0))")


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, w1, f)`` of all words, and ``(lang, w1, w2, w3, f)`` of phrases
    of two (``w3`` null) and three words that occur ``least`` times."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))

    def words():
        return lambda lang, words, ids: [_strings(words), pa.array(np.bincount(ids[ids >= 0], minlength=len(words)))]
    one = _tally(rows, "lang string, w1 string, n long", words)
    one = materialize(one.groupBy("lang", "w1").agg(F.sum("n").alias("f")), "phrases-one")
    frequent = _bitmap(one.where(F.col("f") >= least).select(_bit("w1")))

    # Vertical partitioning: extend prefixes until each fits the budget.
    hot_bits = one.where(F.col("f") > BUDGET).select(_bit("w1")).distinct()
    hot, hotter = _bitmap(hot_bits), np.zeros(BITS // 8, np.uint8)
    units = one.where(F.col("f") >= least).join(hot_bits, _bit("w1") == hot_bits["bit"], "left_anti").select(
        _key("w1").alias("key"), "f")
    rest, extended = 0, None
    if hot.any():
        def heads():
            def step(lang, words, ids):
                keys = keys_of(lang, zip(words))
                pair, n = _phrases(ids, _is_set(frequent, keys), 2, starts=_is_set(hot, keys))
                text = _strings(words)
                return [text.take(pa.array(pair[0])), text.take(pa.array(pair[1])), pa.array(n)]
            return step
        two = _tally(rows, "lang string, w1 string, w2 string, n long", heads)
        two = materialize(two.groupBy("lang", "w1", "w2").agg(F.sum("n").alias("f")), "phrases-two")
        bits = two.where(F.col("f") > BUDGET).select(_bit("w1", "w2")).distinct()
        hotter, on = _bitmap(bits), _bit("w1", "w2") == bits["bit"]
        units = units.unionByName(two.join(bits, on, "left_anti").select(_key("w1", "w2").alias("key"), "f"))
        extended = two.join(bits, on, "left_semi")
        rest = extended.agg(F.sum("f")).first()[0] or 0
    totals = np.full(SLICES, rest // SLICES, np.int64)
    for r in units.groupBy(F.shiftright("key", 16).cast("int").alias("slice")).agg(F.sum("f").alias("f")).collect():
        totals[r.slice] += r.f  # SLICES rows at most
    first, parts = packed(totals, BUDGET)

    def suffixes():
        def step(lang, words, ids):
            keys = keys_of(lang, zip(words))
            (a, b, c), n = _phrases(ids, _is_set(frequent, keys), 3)
            unit, whole = keys[a], np.ones(len(a), bool)
            more = np.flatnonzero(_is_set(hot, unit)) if len(a) else np.zeros(0, int)
            if len(more):
                unit[more] = keys_of(lang, ((words[x], words[y]) for x, y in zip(a[more], b[more])))
                more = more[_is_set(hotter, unit[more])]
                whole[more] = False
                unit[more] = keys_of(lang, ((words[x], words[y], words[z] if z >= 0 else b"")
                                            for x, y, z in zip(a[more], b[more], c[more])))
            group = first[unit >> 16] + (unit & 0xFFFF) % parts[unit >> 16]
            # One row per first word and group; suffixes come sorted by word.
            order = np.lexsort((group, whole, a))
            a, b, c, n, group, whole = (x[order] for x in (a, b, c, n, group, whole))
            start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (group[1:] != group[:-1]) | (whole[1:] != whole[:-1])][:len(a)])
            cuts = pa.array(np.r_[start, len(a)].astype(np.int32))
            text = _strings(words)
            tails = pc.binary_join_element_wise(text.take(pa.array(b)), text.take(pa.array(c, mask=c < 0)), " ",
                                                null_handling="skip")
            tails = pc.binary_join(pa.ListArray.from_arrays(cuts, tails), "\n")
            return [text.take(pa.array(a[start])), tails, pa.array(whole[start]), pa.array(group[start]),
                    pa.ListArray.from_arrays(cuts, pa.array(n))]
        return step

    dealt = _tally(rows, "lang string, w1 string, tails string, whole boolean, grp int, n array<int>", suffixes)
    nodes = grouped(dealt, "grp", "lang string, w1 string, w2 string, w3 string, f long", _subtrees(least))
    if extended is not None:
        nodes = nodes.unionByName(extended.where(F.col("f") >= least).withColumn("w3", F.lit(None).cast("string")))
    return one, materialize(nodes, "phrases-nodes")


def _phrases(ids: np.ndarray, frequent: np.ndarray, size: int, starts: np.ndarray | None = None):
    """The distinct phrases of two words or suffixes of two or three (the
    third -1 if there is none) of frequent words in coded pieces, as arrays of
    word numbers, and their counts; ``starts`` restricts first words."""
    word = np.where(ids < -2, -3 - ids, ids)  # of a word that starts no suffix too
    word = np.where((word >= 0) & np.r_[frequent, False][word], word, -1)
    a = np.where(ids >= 0, word, -1)[:-2]
    b, c = word[1:-1], word[2:]
    on = (a >= 0) & (b >= 0)
    if starts is not None:
        on &= np.r_[starts, False][a]
    a, b, c = a[on].astype(np.int64), b[on].astype(np.int64), c[on].astype(np.int64)
    code = a << 42 | b << 21 | (c + 1 if size == 3 else 0)  # FLUSH words and a few have numbers below 2^21
    code, n = np.unique(code, return_counts=True)
    return (code >> 42, code >> 21 & 0x1FFFFF, (code & 0x1FFFFF) - 1)[:size], n


@tidy
def collocations(docs: DataFrame, least: int = 10, inside: int = 50, first: int = 2000) -> DataFrame:
    """``(lang, text)`` to ``(lang, rank, phrase, a, l, r, n, score)``: the
    ``first`` phrases of two and three words per language.

    A phrase that occurs a >= ``least`` times scores floor(10^6 a^2 / (l r)) at
    its weakest cut into a first part of l and a rest of r occurrences. It is
    left out where 100 times the count of a longer phrase around it reaches
    ``inside`` times its own. Ties go by a, then by phrase in UTF-8 order. A null
    language is ``und``, a null text empty; repeated rows count as often as
    they occur; other columns are ignored; no rows give no rows.
    """
    one, nodes = phrase_counts(docs.select("lang", "text"), least)
    words = one.where(F.col("f") >= least)
    two, three = nodes.where("w3 IS NULL").drop("w3"), nodes.where("w3 IS NOT NULL")

    def single(word, count):
        return words.select("lang", F.col("w1").alias(word), F.col("f").alias(count))

    def double(v, w, count):
        return two.select("lang", F.col("w1").alias(v), F.col("w2").alias(w), F.col("f").alias(count))

    around = three.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(
        F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("in"), "f").groupBy("lang", "in.w1", "in.w2").agg(
        F.max("f").alias("longer"))
    pairs = two.withColumnRenamed("f", "a").join(around, ["lang", "w1", "w2"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).join(
        single("w1", "l"), ["lang", "w1"]).join(single("w2", "r"), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    cut = three.withColumnRenamed("f", "a").join(single("w1", "l1"), ["lang", "w1"]).join(
        double("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(double("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(
        single("w3", "r2"), ["lang", "w3"]).withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    triples = cut.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                         *[F.when(F.col("s1") <= F.col("s2"), F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(o)
                           for c, o in (("l", "l"), ("r", "r"), ("s", "score"))])
    # Best of each of SALT parts first, so that no task ranks a language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    ranked = pairs.unionByName(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALT)))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(
        F.col("rank") <= first).drop("salt")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= first)
    counts = one.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(counts, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
