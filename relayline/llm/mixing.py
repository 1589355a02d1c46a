"""Mixing sources to target weights by weighted fair queueing, with DataFrame
functions only.

Each source queues its documents in shuffled order, once per epoch. A queued
document's virtual finish time is its source's tokens so far, itself
included, divided by the source's target; documents leave in the order of
their finish times over all sources until the total budget is spent.

No step ranks a whole source or the whole mix in one task: running sums are
taken over value ranges first, then inside one range, and the number of
ranges follows the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relayline.llm.common import WORD, materialize, running, set_aside

#: Weights of the sources by code point, repeating; null comes last.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5       # of all words
EPOCHS = 2         # a source gives its documents at most so often
RANGE_ROWS = 512   # documents of a source, or of the queue, to a range of a running sum


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """``(source, size)`` rows to ``(source, source_size, source_rows, weight, target)``.

    The budget is shared by weight; a target stops at ``epochs`` times its
    source's size and the excess is shared again until none is above. That
    fixed point is found at once: with sources in the order of size / weight,
    those that stop are a prefix. The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    place = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    every = Window.partitionBy(F.lit(0))
    by_fill = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    per = per.withColumn("level", (F.sum("source_size").over(every) * F.lit(budget)
                                   - F.coalesce(F.sum("cap").over(before), zero))
                         / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero)))
    # The level is the share per weight if no source from here on stops.
    final = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("weight")).alias("fill"), F.col("level")))).over(every)["level"]
    return per.withColumn("target", F.least(F.col("cap"), F.coalesce(final * F.col("weight"), F.col("cap")))) \
        .select("source", "source_size", "source_rows", "weight", "target")


def key(seed: int, doc_id: Column, source: Column, text: Column) -> Column:
    """SHA-256, in hex, of a document's id, source and text with ``seed``: the
    place in the shuffle. Only rows equal in all three share it."""
    return F.sha2(F.concat(
        F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("|"),
        F.coalesce(F.length(source).cast("string"), F.lit("-")), F.lit("|"), F.coalesce(source, F.lit("")),
        F.when(text.isNull(), F.lit("|-")).otherwise(F.concat(F.lit("|+"), text))), 256)


def _range_of(share: Column, ranges: Column) -> Column:
    """Which of ``ranges`` equal parts of [0, 1) ``share`` lies in."""
    return F.least(F.floor(share * ranges), ranges - 1).cast("long")


def _ranges(rows: Column) -> Column:
    """About the square root of ``rows``, with RANGE_ROWS to a range at least:
    neither a range nor the table of ranges grows as fast as the input."""
    return F.greatest(F.lit(1), F.floor(rows / F.greatest(F.lit(RANGE_ROWS), F.sqrt(rows)))).cast("long")


def queue(docs: DataFrame, seed: int = 17, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """One row per document with its source's figures and, in ``through``, the
    words of its source up to and with it in shuffled order.

    Documents are shuffled by ``key``, so reruns agree; ``row`` tells equal
    rows apart."""
    sized = materialize(docs.select(
        "doc_id", "source", words(F.col("text")).alias("size"),
        key(seed, F.col("doc_id"), F.col("source"), F.col("text")).alias("key")).withColumn(
        "row", F.monotonically_increasing_id()), "mix-sizes")
    goals = materialize(targets(sized, budget=budget, epochs=epochs), "mix-targets")
    goal = goals.select(F.col("source").alias("of"), "source_size", "source_rows", "target")
    goal = F.broadcast(goal) if _few(goals) else goal
    rows = sized.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    share = F.conv(F.substring("key", 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    rows = rows.withColumn("bucket", _range_of(share, _ranges(F.col("source_rows")))).drop("source_rows")
    return running(rows, ["source"], ["key", "row"], "size", "bucket", "through").drop("bucket")


def _few(goals: DataFrame, most: int = 1_000) -> bool:
    """Sources are broadcast up to a checked number only."""
    return goals.limit(most + 1).count() <= most


def _copies(docs: DataFrame, seed: int, budget: float, epochs: int) -> DataFrame:
    queued = materialize(queue(docs, seed, budget, epochs), "mix-queue")
    rows, total = queued.agg(F.count(F.lit(1)), F.sum("size")).first()
    runs = queued.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn(
        "finish", (F.col("epoch") * F.col("source_size") + F.col("through")) / F.col("target"))
    # The budget ends near time 1; f / (1 + f) spreads all times over [0, 1).
    runs = runs.withColumn("bucket", _range_of(F.col("finish") / (1 + F.col("finish")),
                                               _ranges(F.lit(float(rows * epochs))))).withColumn("all", F.lit(0))
    spent = running(runs, ["all"], ["finish", "source", "key", "row", "epoch"], "size", "bucket", "spent")
    taken = spent.where(F.col("spent") <= F.lit(int((total or 0) * budget))).groupBy("row").agg(
        F.count(F.lit(1)).alias("copies"))
    return queued.join(taken, "row", "left").withColumn("copies", F.coalesce("copies", F.lit(0)))


def mix(docs: DataFrame, seed: int = 17, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every
    row of ``docs``: ``copies`` is how often the mix takes it (0 to
    ``epochs``) and ``taken`` the words that makes.

    Null text counts 0 words, and documents without words are not taken. Null
    sources form one source, in last place. Repeated rows count as so many
    documents. An empty table takes nothing.
    """
    return _copies(docs, seed, budget, epochs).select(
        "doc_id", "source", "size", "source_size", "target", "copies").withColumn(
        "taken", F.col("copies") * F.col("size"))


def take(docs: DataFrame, seed: int = 17, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """The mixed documents: rows of ``docs``, each as often as ``mix`` takes
    it, null ids and repeated rows included.

    Rows equal in id, source and text are neighbours in their source's queue,
    so they differ in copies only where the budget ends: in at most one such
    group per source and epoch. The rows of those groups are numbered (by
    their other columns) and the first ones get a copy more. An empty table
    gives none.
    """
    per = materialize(_copies(docs, seed, budget, epochs).groupBy("key").agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).where("_copies > 0").select(
        F.col("key").alias("_key"), F.expr("cast(_copies div _rows as int)").alias("_each"),
        F.expr("cast(_copies % _rows as int)").alias("_more")), "mix-copies")
    rows, back = set_aside(docs, "doc_id", "source", "text")
    rows = rows.withColumn("_key", key(seed, F.col("doc_id"), F.col("source"), F.col("text"))).drop(
        "doc_id", "source", "text")
    every = rows.join(per.where("_more = 0"), "_key")
    others = F.to_json(F.struct(*[c for c in rows.columns if c != "_key"]))
    some = rows.join(per.where("_more > 0"), "_key").withColumn(
        "_nth", F.row_number().over(Window.partitionBy("_key").orderBy(others))).withColumn(
        "_each", F.col("_each") + (F.col("_nth") <= F.col("_more")).cast("int")).drop("_nth")
    return every.unionByName(some).where("_each > 0").withColumn(
        "_n", F.explode(F.sequence(F.lit(1), F.col("_each")))).select(*back)
