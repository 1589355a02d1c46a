"""Request bodies with a byte limit (P6): next-fit packing in parallel.

Events of a (plataforma, bucket) come in the order of ``assign_batches``. An
event joins the open body while the body's bytes stay within the limit, else it
opens the next one, so where a body starts depends on all events before it.

Events are dealt out once, by batch, and a batch is cut into blocks of at most
one limit of bytes. A block is then a function from the bytes of the body that
is open before it to (bodies opened, bytes of the body open after it), which has
few values: it depends on the first event that overflows only. The functions of
a batch's blocks are composed into the batch's, those of FAN neighbouring
batches into one, level by level; going down again, every batch and block learns
the body that is open before it, and its events their body by a projection.
Equal neighbouring values are one step, so a function has at most as many steps
as a body has events. Levels are LEVELS at any size, so no job counts blocks
first: above them the rest of a (plataforma, bucket), a function per
FAN ** LEVELS batches, is composed in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .envelopes import BUCKET_SPAN, EnvelopeConfig, request_body
from .payloads import with_events

FAN_BITS, LEVELS = 8, 3     # FAN = 1 << FAN_BITS neighbouring functions are composed in one task
PART = ["plataforma", "bucket"]
BATCH = ["_n", "_p", "_b"]  # batch and (plataforma, bucket) without nulls: equal keys are dealt out alike to joins too


def _dealt(sized: DataFrame) -> DataFrame:
    """Rows dealt out by batch, with its key. What is made of them afterwards
    reads this one shuffle: rows and functions need the same columns of it."""
    absent = F.concat(*[F.when(F.col(c).isNull(), "-").otherwise("+") for c in PART])
    return sized.select(
        "*", F.coalesce(F.col("batch_id").cast("long"), F.lit(-(1 << 63))).alias("_n"),  # first, as a null is sorted
        F.concat(absent, F.coalesce(F.col("plataforma").cast("string"), F.lit(""))).alias("_p"),
        F.coalesce(F.col("bucket").cast("long"), F.lit(0).cast("long")).alias("_b")).repartition(*BATCH)


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` made once: an expression that a lambda
    names several times is evaluated each time."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _value(total: Column, steps: Column, fill: Column, cap: Column) -> Column:
    """The function at ``fill``: ``(bodies, fill)``."""
    step = F.get(F.filter(steps, lambda s: s["upto"] >= fill), 0)
    opens = _let(step, lambda s: F.struct(s["bodies"].alias("bodies"), s["fill"].alias("fill")))
    return F.when(fill + total <= cap, F.struct(F.lit(0).cast("long").alias("bodies"), (fill + total).alias("fill"))
                  ).otherwise(opens)


def _then(one: Column, two: Column, cap: Column) -> Column:
    """The function of two neighbours from the functions of each."""
    later = F.filter(F.transform(two["steps"], lambda s: F.struct(
        (s["upto"] - one["total"]).alias("upto"), s["bodies"].alias("bodies"), s["fill"].alias("fill"))),
        lambda s: s["upto"] >= 0)

    def on(s):
        return _let(_value(two["total"], two["steps"], s["fill"], cap), lambda v: F.struct(
            s["upto"].alias("upto"), (s["bodies"] + v["bodies"]).alias("bodies"), v["fill"].alias("fill")))
    steps = F.concat(later, F.transform(one["steps"], on))
    return F.struct((one["total"] + two["total"]).alias("total"), _let(steps, _distinct_steps).alias("steps"))


def _distinct_steps(steps: Column) -> Column:
    """Neighbouring steps of one value become the highest of them."""
    def last(s, i):
        return _let(F.get(steps, i + 1), lambda after: after.isNull() | (after["bodies"] != s["bodies"])
                    | (after["fill"] != s["fill"]))
    return F.filter(steps, last)


def _blocks(events: DataFrame) -> DataFrame:
    """One function per block, side by side in a batch. A block's events fit in
    one body, so the first event that overflows opens the only new one, and all after it are in it."""
    # the key's columns come along, so that nothing else is read of the shuffle than the rows' own plan reads
    of = events.where("_size > 0").groupBy(*BATCH, *PART, "batch_id", "_cap", "_block").agg(
        F.min("_at").alias("_from"), F.max(F.col("_at") + F.col("_size")).alias("_to"),
        F.sort_array(F.collect_list("_at"), asc=False).alias("_starts"))
    total = F.col("_to") - F.col("_from")
    steps = F.transform("_starts", lambda at: F.struct(
        (F.col("_cap") - (at - F.col("_from"))).alias("upto"), F.lit(1).cast("long").alias("bodies"),
        (F.col("_to") - at).alias("fill")))
    leaf = F.struct(F.col("_block").alias("_id"), total.alias("total"), steps.alias("steps"), F.col("_from"))
    return of.groupBy(*BATCH, "_cap").agg(F.sort_array(F.collect_list(leaf)).alias("_fs"))


def _composed(grouped: DataFrame) -> DataFrame:
    """The function of every group."""
    one = lambda f: F.struct(f["total"].alias("total"), f["steps"].alias("steps"))
    whole = F.aggregate(F.slice("_fs", F.lit(2), F.size("_fs")), one(F.get("_fs", F.lit(0))),
                        lambda acc, f: _then(acc, f, F.col("_cap")))
    return grouped.select(*BATCH, "_cap", whole.alias("_f"))


def _grouped(functions: DataFrame, above: Column) -> DataFrame:
    """Neighbours side by side, in order, with the number of the group that ``above`` gives."""
    leaf = F.struct(F.col("_n").alias("_id"), F.col("_f.total"), F.col("_f.steps"))
    return functions.groupBy(above.alias("_n"), "_p", "_b", "_cap").agg(F.sort_array(F.collect_list(leaf)).alias("_fs"))


def _opened(grouped: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """``_os``: what is open before every function of a group, from what is
    open before the group (``starts``; nothing, if there are none)."""
    zero = F.lit(0).cast("long")
    if starts is None:
        rows = grouped.withColumn("_bodies", zero).withColumn("_fill", zero)
    else:
        rows = grouped.join(starts, BATCH)
    begin = F.struct(F.col("_bodies").alias("bodies"), F.col("_fill").alias("fill"),
                     F.array().cast("array<struct<_id:bigint,bodies:bigint,fill:bigint>>").alias("out"))

    def step(acc, f):
        seen = F.struct(f["_id"].alias("_id"), acc["bodies"].alias("bodies"), acc["fill"].alias("fill"))
        return _let(_value(f["total"], f["steps"], acc["fill"], F.col("_cap")), lambda v: F.struct(
            (acc["bodies"] + v["bodies"]).alias("bodies"), v["fill"].alias("fill"),
            F.concat(acc["out"], F.array(seen)).alias("out")))
    return rows.withColumn("_os", F.aggregate(F.col("_fs"), begin, step, lambda acc: acc["out"]))


def pack(batched: DataFrame, size: Column, cap: Column | int) -> DataFrame:
    """Rows of ``assign_batches`` plus ``size`` and ``corpo``, the 0-based body
    of the row in its (plataforma, bucket) by next fit in batch order.

    ``size`` (bytes; null or less counts as 1) is evaluated per row, ``cap`` is
    the bytes a body may hold, constant in a (plataforma, bucket). An event of
    more than ``cap`` bytes fits in no body: its ``corpo`` is null and it takes no
    room. The result does not depend on how the rows were batched as long as
    their order is the same.
    """
    cap = F.lit(cap) if isinstance(cap, int) else cap
    cols = batched.columns
    dealt = _dealt(batched.withColumn("size", F.greatest(size.cast("long"), F.lit(1).cast("long"))).withColumn(
        "_cap", cap.cast("long")))
    before = Window.partitionBy(*BATCH).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    half = F.greatest(F.floor(F.col("_cap") / 2), F.lit(1))
    # An event of over half a limit is the last that starts in its half, and is a block of its own.
    big = F.when(F.col("_size") > half, 1).otherwise(0)
    events = dealt.withColumn(
        "_size", F.when(F.col("size") <= F.col("_cap"), F.col("size")).otherwise(F.lit(0).cast("long"))).withColumn(
        "_at", F.coalesce(F.sum("_size").over(before), F.lit(0).cast("long"))).withColumn(
        "_block", (F.floor(F.col("_at") / half) * 2 + big).cast("long"))
    blocks = _blocks(events)
    levels, functions = [], _composed(blocks)
    for level in range(1, LEVELS + 1):
        levels.append(_grouped(functions, F.shiftright("_n", FAN_BITS)))
        functions = _composed(levels[-1])
    levels.append(_grouped(functions, F.lit(0).cast("long")))
    starts = None
    for level in reversed(levels):
        starts = _opened(level, starts).select("_p", "_b", F.explode("_os").alias("_o")).select(
            F.col("_o._id").alias("_n"), "_p", "_b", F.col("_o.bodies").alias("_bodies"), F.col("_o.fill").alias("_fill"))
    # of every block: its number, the bodies before it, and the bytes that it finds in the open body less those before it in the batch
    opened = _opened(blocks, starts).select(
        *BATCH, F.col("_os._id").alias("_ids"), F.col("_os.bodies").alias("_opens"),
        F.zip_with("_os", "_fs", lambda o, f: o["fill"] - f["_from"]).alias("_holds"))
    here = F.array_position("_ids", F.col("_block")).cast("int") - 1
    over = F.get("_holds", here) + F.col("_at") + F.col("_size") > F.col("_cap")
    body = F.when(F.col("_size") > 0, F.get("_opens", here) + over.cast("long"))
    return events.join(opened, BATCH, "left").select(*cols, "size", body.alias("corpo"))


def limit_bytes(batched: DataFrame, max_bytes: int, cfg: EnvelopeConfig | None = None,
                goal_name: str | None = None) -> DataFrame:
    """Rows of ``assign_batches`` batched anew, so that no request body of
    ``envelopes`` (same ``cfg``) has more than ``max_bytes`` bytes of UTF-8.

    An event too large for a body of its own gets no batch: ``batch_id``,
    ``position`` and ``batch_events`` are null, for the caller to set aside.
    """
    cfg = cfg or EnvelopeConfig()
    events = with_events(batched, goal_name)
    one = {c: F.array(F.col(c)) for c in ("meta_event", "google_event", "bing_event")}
    none = {c: F.slice(a, 1, 0) for c, a in one.items()}
    empty = F.octet_length(request_body(cfg, F.col("etapa_funil"), *none.values()))
    event = F.coalesce(F.to_json("meta_event"), F.to_json("google_event"), F.to_json("bing_event"))
    # n events are parted by n - 1 commas
    packed = pack(events.withColumn("_bytes", F.octet_length(event) + 1).withColumn("_room", max_bytes - empty + 1),
                  F.col("_bytes"), F.col("_room"))
    body = Window.partitionBy(*PART, "corpo")
    cols = [c for c in batched.columns if c not in ("batch_id", "position", "batch_events")]
    kept = F.col("corpo").isNotNull()
    number = F.row_number().over(body.orderBy("batch_id", "position")) - 1
    fits = packed.where(kept).select(
        *cols, (F.col("bucket") * F.lit(BUCKET_SPAN) + F.col("corpo")).alias("_id"), number.cast("int").alias("position"),
        F.count(F.lit(1)).over(body).cast("int").alias("batch_events")).withColumnRenamed("_id", "batch_id")
    rest = packed.where(~kept).select(*cols, F.lit(None).cast("long").alias("batch_id"),
                                      F.lit(None).cast("int").alias("position"), F.lit(None).cast("int").alias("batch_events"))
    return fits.unionByName(rest)
