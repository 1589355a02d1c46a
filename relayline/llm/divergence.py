"""Source divergence audit with a translate-table tokenizer.

One pass of ``bytes.translate`` lowers A-Z and blanks every separator of a
text; ``bytes.split`` gives its terms and a ``Counter`` of the document their
frequencies, whose keys count it once for each term. Tasks add the counters of
a (lang, source) group up and hand over sparse rows.

A group's share of a term is p = 1 + floor(10^9 (count + 1) / (N + V)) over
the V terms of its lang that occur in ``least`` documents; a term's part of the
divergence from q is floor((p - q)^2 / q). For two sources only the terms that
one of them has are visited: the others all add the same. Sums are exact in 64
bits, as all parts of a pair add up to at most (10^9 + V)^2.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relayline.llm.common import grouped, materialize, small, tidy

#: Letters in lower case and bytes of other characters stay, the rest parts terms.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
UNIT = 1_000_000_000
FLUSH = 1 << 18       # terms that a task adds up before it hands them over
PIECE = 1 << 22       # bytes of a text that are split at once
SOURCES = 256         # sources of a block, on average
ROWS = 1 << 18        # rows of a cell, on average
PAIRS = 1 << 20       # pairs of rows of one term in memory at once


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in pieces of bounded size."""
    text = (text or b"").translate(TERMS)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def rows():
        cols = [[], [], [], [], []]
        for (lang, source), (n, docs) in tally.items():
            for c, values in zip(cols, ([lang] * len(n), [source] * len(n), n, n.values(), docs.values())):
                c.extend(values)
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        cols = [pa.array(c, k) for c, k in zip(cols, kinds)]
        cols[2] = cols[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part in small(batch):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, docs = tally.setdefault((lang, source), (Counter(), Counter()))
                document: Counter = Counter()
                for found in terms(text):
                    document.update(found)
                size -= len(n)
                n.update(document)
                docs.update(document.keys())
                size += len(n)
                if size >= FLUSH:
                    yield rows()
                    tally, size = {}, 0
    if size:
        yield rows()


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """``(lang, source, term, n, whole)``: occurrences in a group and in its
    lang of terms that ``least`` documents of the lang have. One shuffle, by
    lang and term; a term has a row per group and task before it, and per
    group after it."""
    rows = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    rows = rows.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    rows = rows.withColumns({"whole": F.sum("n").over(over), "docs": F.sum("docs").over(over)})
    return rows.where(F.col("docs") >= least).drop("docs")


def _share(n: str, total: str, size: str):
    """1 + floor(10^9 (n + 1) / (total + size)); products may pass 64 bits."""
    return F.expr(f"1L + cast({n} + 1 as decimal(20,0)) * cast({UNIT} as decimal(10,0))"
                  f" div cast({total} + {size} as decimal(20,0))")


def _part(p: str, q: str):
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _part_np(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _excess():
    """Of a cell (some terms; a block of sources against a block), for each
    pair of sources the sum over the terms of what they add beyond the part
    of a term that neither has."""
    def step(rows: pa.Table) -> dict:
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        block, p = rows["block"].to_numpy(), rows["p"].to_numpy()
        name = rows["source"].combine_chunks().dictionary_encode()
        names, source = name.dictionary.to_pylist(), name.indices.to_numpy()
        term = rows["term"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        roster = term < 0
        sides = []
        for side in (low, high):  # positions of the block's sources; their share of an absent term
            on = np.flatnonzero(roster & (block == side))
            at = np.full(len(names), -1)
            at[source[on]] = np.arange(len(on))
            seen = np.flatnonzero(~roster & (block == side))
            seen = seen[np.argsort(term[seen], kind="stable")]
            sides.append((source[on], p[on], term[seen], at[source[seen]], p[seen]))
        (who, p0, t_left, s, ps), (whom, q0, t_right, t, qt) = sides
        none = _part_np(p0[:, None], q0[None, :])
        total = np.zeros((len(p0), len(q0)), np.int64)
        (one, many), times = np.unique(np.stack([s, ps]), axis=1, return_counts=True)
        for k in range(0, len(one), 4096):
            i, v = one[k:k + 4096], many[k:k + 4096]
            np.add.at(total, i, times[k:k + 4096, None] * (_part_np(v[:, None], q0[None, :]) - none[i]))
        (one, many), times = np.unique(np.stack([t, qt]), axis=1, return_counts=True)
        for k in range(0, len(one), 4096):
            i, v = one[k:k + 4096], many[k:k + 4096]
            np.add.at(total.T, i, times[k:k + 4096, None] * (_part_np(p0[None, :], v[:, None]) - none.T[i]))
        # Terms that both have: every left row against the right rows of its term.
        start, end = np.searchsorted(t_right, t_left), np.searchsorted(t_right, t_left, "right")
        upto = np.cumsum(end - start)
        k = 0
        while k < len(t_left):
            to = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PAIRS)))
            width = (end - start)[k:to]
            left = np.repeat(np.arange(k, to), width)
            right = np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start[k:to], width)
            i, j = s[left], t[right]
            both = (_part_np(ps[left], qt[right]) - _part_np(ps[left], q0[j])
                    - _part_np(p0[i], qt[right]) + none[i, j])
            np.add.at(total.reshape(-1), i * len(q0) + j, both)
            k = to
        i, j = np.nonzero(who[:, None] != whom[None, :])
        return {"lang": [rows["lang"][0].as_py()] * len(i), "source": [names[x] for x in who[i]],
                "item": [names[x] for x in whom[j]], "excess": total[i, j].tolist()}
    return step


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for all ordered pairs of a lang's
    sources. ``rows``: (lang, source, term, p, blocks, buckets) of the terms
    that a group has."""
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    has = rows.select("lang", "source", "term", "p", "blocks", block,
                      F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"))
    roster = groups.where("size > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), _share("0", "total", "size").alias("p"), "blocks",
        block, F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    # A block meets every block from either side; with one block, a row goes to one cell.
    meets = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.array(
        F.struct(F.col("block").alias("low"), o.alias("high")), F.struct(o.alias("low"), F.col("block").alias("high"))))))
    dealt = has.unionByName(roster).withColumn("meet", F.explode(meets)).select(
        "lang", "source", "term", "p", "block", "meet.low", "meet.high",
        F.to_json(F.struct("lang", "meet.low", "meet.high", "bucket")).alias("cell"))
    found = grouped(dealt, "cell", "lang string, source string, item string, excess long", _excess)
    found = found.groupBy("lang", "source", "item").agg(F.sum("excess").alias("excess"))
    whole = groups.select("lang", "source", "size", F.when(F.col("size") > 0, _share("0", "total", "size")).alias("p"))
    every = whole.join(whole.select("lang", F.col("source").alias("item"), F.col("p").alias("q")), "lang").where(
        "source <> item")
    return every.join(found, ["lang", "source", "item"], "left").select(
        "lang", "source", "item",
        F.coalesce(F.col("size") * _part("p", "q") + F.coalesce("excess", F.lit(0)), F.lit(0)).cast("long").alias("value"))


@tidy
def divergence(docs: DataFrame, least: int = 3, first: int = 200) -> DataFrame:
    """``(lang, source, text)`` to ``(lang, source, part, item, value, rank)``.

    Part ``pair``: the divergence of a (lang, source) group from each other
    source of its lang; part ``term``: the ``first`` terms that set it most
    apart from its lang. Ranks go by value, ties by item in UTF-8 order.
    Null lang, source and text are empty; a row is a document, so repeated
    rows count as often as they occur; a group without terms has pairs only,
    of value 0 where its lang keeps no term. Other columns are ignored; no
    rows give no rows.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.col("text").cast("binary").alias("text"))
    rows = materialize(kept_terms(docs, least), "divergence-kept")
    langs = rows.groupBy("lang", "term").agg(F.first("whole").alias("whole")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("size"), F.sum("whole").alias("words"))
    sums = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SOURCES).cast("int").alias("blocks"),
                                       F.ceil((F.coalesce(F.sum("rows"), F.lit(0)) + 1) / ROWS).cast("int").alias("buckets"))
    groups = groups.join(langs, "lang", "left").join(sizes, "lang").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "size", "words")], "blocks", "buckets")
    groups = materialize(groups, "divergence-groups")
    rows = rows.join(groups, ["lang", "source"]).withColumns({
        "p": _share("n", "total", "size"), "q": _share("whole", "words", "size")})
    pairs = _pairs(rows, groups).withColumn("part", F.lit("pair"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    single = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), _part("p", "q").alias("value"))
    single = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first).withColumn(
        "part", F.lit("term"))
    return pairs.unionByName(single).select("lang", "source", "part", "item", "value", "rank")
