"""Applying, inverting and composing change feeds.

A feed (``control.changes``) is a signed multiset of rows: inserts and update
post-images count +1, deletes and update pre-images -1. Adding two feeds row
by row gives the feed over both steps, negating one undoes it, and adding one
to a table gives the table after it. Every operator is one aggregation by all
columns, combined map-side, so repeated rows cost one row per task; rows come
back with their multiplicity in chunks of bounded size. Keys may be null.

What a change is called depends on whether its key exists before and after the
step. A feed tells that for every key it mentions: a row that was there, or a
post-image, says that the key existed before; a row that is there now, or a
pre-image, that it exists after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CONTROL_COLUMNS, KEY, SEND_RESULT_COLUMNS
from . import control as ctl

GONE = ["delete", "update_preimage"]
MADE = ["insert", "update_postimage"]
INVERSE = {"insert": "delete", "delete": "insert", "update_preimage": "update_postimage",
           "update_postimage": "update_preimage"}


def _sign():
    kind = F.col("_change_type")
    return (F.when(kind.isin(*MADE), F.lit(1)).when(kind.isin(*GONE), F.lit(-1))
             .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("NULL"))))))


def _copies(rows: DataFrame, count: str, *keep) -> DataFrame:
    """``count`` copies of each row, generated in chunks."""
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / ctl.COPIES)))
    inside = F.sequence(F.col("_chunk") * ctl.COPIES, F.least(F.col(count), (F.col("_chunk") + 1) * ctl.COPIES) - 1)
    return (rows.withColumn("_chunk", chunk).withColumn("_copy", F.explode(inside))
            .select(*CONTROL_COLUMNS, *keep))


def apply(before: DataFrame, feed: DataFrame) -> DataFrame:
    """The table after the feed: ``apply(a, changes(a, b))`` is ``b``. A feed
    that takes a row that is not there fails the job."""
    rows = ctl.conform(before).withColumn("_n", F.lit(1)).unionByName(
        ctl.conform(feed.drop("_change_type")).withColumn("_n", F.lit(0)).limit(0)).unionByName(
        feed.select(*CONTROL_COLUMNS, _sign().alias("_n")))
    net = rows.groupBy(*CONTROL_COLUMNS).agg(F.sum("_n").alias("_n"))
    fits = F.when(F.col("_n") < 0, F.raise_error(F.lit("the feed takes a row that the table has not"))).otherwise(F.col("_n") > 0)
    return _copies(net.where(fits), "_n")


def invert(feed: DataFrame) -> DataFrame:
    """The feed of the step back: ``apply(b, invert(changes(a, b)))`` is ``a``."""
    kinds = F.create_map(*[F.lit(x) for pair in INVERSE.items() for x in pair])
    return feed.withColumn("_change_type", kinds[F.col("_change_type")])


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """The feed over two steps: of ``changes(a, b)`` and ``changes(b, c)``,
    ``changes(a, c)``. Rows made by the first step and taken by the second
    cancel out."""
    both = first.select(*CONTROL_COLUMNS, "_change_type", F.lit(1).alias("_step")).unionByName(
        second.select(*CONTROL_COLUMNS, "_change_type", F.lit(2).alias("_step")))
    net = both.groupBy(*CONTROL_COLUMNS).agg(F.sum(_sign()).alias("_net")).where("_net <> 0")
    existed = F.col("_change_type").isin(*GONE, "update_postimage")
    exists = F.col("_change_type").isin(*MADE, "update_preimage")

    def of(step: int, said):
        return F.max(F.when(F.col("_step") == step, said.cast("int")))
    # A key that one step does not mention is before and after it what the other says.
    keys = both.groupBy(*[F.col(k).alias(f"_k_{k}") for k in KEY]).agg(
        F.coalesce(of(1, existed), of(2, existed)).alias("_before"),
        F.coalesce(of(2, exists), of(1, exists)).alias("_after"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in KEY]
    kind = (F.when((F.col("_net") < 0) & (F.col("_after") == 1), F.lit("update_preimage"))
             .when(F.col("_net") < 0, F.lit("delete"))
             .when(F.col("_before") == 1, F.lit("update_postimage")).otherwise(F.lit("insert")))
    rows = net.join(keys, on).withColumn("_change_type", kind).withColumn("_n", F.abs("_net"))
    return _copies(rows, "_n", "_change_type")


def merge_feed(target: DataFrame, batch: DataFrame, now) -> DataFrame:
    """``changes(target, upsert(target, batch))`` from the keys that the batch
    changes alone: rows of other keys are neither aggregated nor compared."""
    src = ctl.refuse_null_keys(batch.select(*SEND_RESULT_COLUMNS))
    before = ctl.conform(target).join(src.select(*KEY).distinct(), KEY, "left_semi").select(*CONTROL_COLUMNS)
    return ctl.changes(before, ctl.upsert(before, src, now))
