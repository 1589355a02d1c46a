"""Request envelopes with an exact batch cap.

Batches are cut in parallel. The events of a platform are ranked by a hash of
event id and conversion time, and ``floor(rank / batch_size)`` numbers the
batches. No task ranks a platform: events are counted per slice of the hash
range, the counts of the slices before are added up, and rows are ranked
inside their slice only. The number of slices is the caller's and changes no
batch. Every batch holds ``batch_size`` events but the last of its platform
(for Google, of its stage); the only collect is of one batch, bounded by that
cap. Rows that are exact copies are counted once before ranking (map-side) and
expanded afterwards, so a key repeated millions of times is never sorted in one
task.

The hash is the first 32 bits of SHA-256(event id | conversion time in epoch
microseconds), which any SQL engine can recompute, so batch numbers are
checkable.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cache import expression_cache
from ..functions.timefmt import days_before, ts_lit
from ..schemas import GOOGLE_ENCODING, GOOGLE_PRODUCT, RULE_BY_PLATFORM, STAGES
from .payloads import event_id, with_events

BUCKET_SPAN = 1 << 32  # batch_id = bucket * BUCKET_SPAN + batch number inside the bucket
SLICES_PER_PARTITION = 8  # default slices of the hash range per shuffle partition
EXPAND_CHUNK = 4096  # copies of one collapsed row generated per array


@dataclass
class EnvelopeConfig:
    """Account settings that go into request bodies (never secrets)."""
    meta_test_event_code: str | None = None
    google_operating_account: str = ""
    google_destination_by_stage: dict = field(default_factory=dict)
    google_default_destination: str = ""


def hash32(key: Column) -> Column:
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")


@expression_cache
def window_ok(as_of) -> Column:
    """M7: still inside the platform window when the batch is frozen."""
    p, ts = F.col("plataforma"), F.col("data_hora_conversao")
    cond = None
    for name, rule in RULE_BY_PLATFORM.items():
        c = (p == name) & (ts >= days_before(as_of, rule.window_days))
        cond = c if cond is None else (cond | c)
    return cond


def assign_batches(routed: DataFrame, batch_size: int = 500, n_buckets: int | None = None,
                   as_of=None, recheck_window: bool = True, future_guard: bool = False) -> DataFrame:
    """Routed rows plus ``bucket`` (Google's stage, else 0), ``batch_id``,
    0-based ``position`` and ``batch_events`` (the size of the row's batch).

    With ``recheck_window`` rows that fell out of their platform window since
    eligibility are dropped before batching (one stale Meta event fails the
    whole request); ``future_guard`` drops events after ``as_of``.
    ``n_buckets`` is the number of slices that are ranked apart, by default
    SLICES_PER_PARTITION times the session's shuffle partitions.
    """
    if n_buckets is None:
        n_buckets = SLICES_PER_PARTITION * int(routed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if batch_size < 1 or n_buckets < 1:
        raise ValueError("batch_size and n_buckets must be positive")
    df = routed
    if recheck_window and as_of is not None:
        df = df.where(window_ok(as_of))
    if future_guard and as_of is not None:
        df = df.where(F.col("data_hora_conversao") <= ts_lit(as_of))
    eid = event_id()
    # Google takes one destination (conversion action) per stage, so its
    # batches never mix stages: the stage is the bucket number.
    stage_slot = F.when(F.col("plataforma") == "google",
                        F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("etapa_funil"))).otherwise(F.lit(0))
    # with the conversion time, rows that share an event id spread too
    spread = F.concat(eid, F.lit("|"), F.unix_micros(F.col("data_hora_conversao").cast("timestamp")).cast("string"))
    cols = [*df.columns, "event_id", "bucket"]
    # Identical rows (one key copied a million times) collapse map-side into
    # one row with a multiplicity, so no task ever sorts a hot group. What
    # follows from their columns is made afterwards.
    distinct = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_m"))
                  .withColumn("event_id", eid).withColumn("bucket", stage_slot.cast("bigint"))
                  .withColumn("_h", hash32(spread))
                  .withColumn("_slice", F.shiftright(F.col("_h") * F.lit(n_buckets), 32)))
    part = Window.partitionBy("plataforma", "bucket")
    before = part.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    first = ["_h", "event_id", "lead_id", "etapa_funil"]
    order = first + [c for c in cols if c not in first + ["plataforma", "bucket"]]  # a total order
    running = (Window.partitionBy("plataforma", "bucket", "_slice").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = distinct.withColumn("_in_slice", F.sum("_m").over(running))
    # a slice's last rank is its sum: counts come from the shuffle that rows are ranked by, so that they are made once
    slices = (ranked.groupBy("plataforma", "bucket", "_slice").agg(F.max("_in_slice").alias("_sum"))
              .select(F.col("plataforma").alias("_p"), F.col("bucket").alias("_b"), F.col("_slice").alias("_s"),
                      F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
                      F.sum("_sum").over(part).alias("_n")))
    here = (F.col("plataforma").eqNullSafe(F.col("_p")) & F.col("bucket").eqNullSafe(F.col("_b"))
            & F.col("_slice").eqNullSafe(F.col("_s")))
    # a row per slice, of which the caller sets the number: broadcast, so that events are not dealt out again
    distinct = (ranked.join(F.broadcast(slices), here)
                      .withColumn("_end", F.col("_start") + F.col("_in_slice")))
    # back to one row per copy, generated in chunks of at most EXPAND_CHUNK
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_m") - 1) / F.lit(EXPAND_CHUNK)).cast("bigint"))
    copies = F.sequence(F.col("_c") * EXPAND_CHUNK,
                        F.least(F.col("_m"), (F.col("_c") + 1) * EXPAND_CHUNK) - 1)
    expanded = (distinct.withColumn("_c", F.explode(chunks))
                        .withColumn("_i", F.explode(copies)))
    rn = F.col("_end") - F.col("_m") + F.col("_i")  # 0-based rank inside (plataforma, bucket)
    batch_no = F.floor(rn / F.lit(batch_size)).cast("bigint")
    in_batch = F.least(F.lit(batch_size).cast("bigint"), F.col("_n") - batch_no * F.lit(batch_size))
    return expanded.select(
        *cols,
        (F.col("bucket") * F.lit(BUCKET_SPAN) + batch_no).alias("batch_id"),
        F.pmod(rn, F.lit(batch_size)).cast("int").alias("position"),
        in_batch.cast("int").alias("batch_events"))


def _google_destinations(cfg: EnvelopeConfig, stage: Column) -> Column:
    dest = F.lit(cfg.google_default_destination)
    for st, d in cfg.google_destination_by_stage.items():
        dest = F.when(stage == st, F.lit(d)).otherwise(dest)
    return F.array(F.struct(
        F.struct(F.lit(GOOGLE_PRODUCT).alias("product"),
                 F.lit(cfg.google_operating_account).alias("accountId")).alias("operatingAccount"),
        dest.alias("productDestinationId")))


@expression_cache
def _events_of(c: str) -> Column:
    """The batch's events of one platform in position order (NULLs skipped)."""
    return F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("position", F.col(c).alias("e")))))


def request_body(cfg: EnvelopeConfig, stage: Column, meta: Column, google: Column, bing: Column) -> Column:
    """JSON text of one request from the platform's array of events."""
    p = F.col("plataforma")
    test_code = F.lit(cfg.meta_test_event_code).cast("string")
    body = (F.when(p == "meta", F.to_json(F.struct(meta.alias("data"), test_code.alias("test_event_code"))))
             .when(p == "google", F.to_json(F.struct(_google_destinations(cfg, stage).alias("destinations"),
                                                     F.lit(GOOGLE_ENCODING).alias("encoding"),
                                                     google.alias("events"))))
             .when(p == "bing", F.to_json(F.struct(bing.alias("OfflineConversions")))))
    return body.otherwise(F.raise_error(F.concat(F.lit("unknown platform: "), F.coalesce(p, F.lit("NULL")))))


def envelopes(batched: DataFrame, cfg: EnvelopeConfig | None = None, goal_name: str | None = None) -> DataFrame:
    """One request body per (plataforma, batch_id).

    meta: {data, test_event_code}; google: {destinations, encoding, events};
    bing: {OfflineConversions}. Events are ordered by ``position``.
    Google destinations are per conversion stage; Google batches never mix
    stages (see ``assign_batches``), so the batch's stage picks it.
    """
    cfg = cfg or EnvelopeConfig()
    ev = with_events(batched, goal_name)
    agg = (ev.groupBy("plataforma", "bucket", "batch_id")
             .agg(F.count("*").alias("n_events"),
                  F.min("etapa_funil").alias("first_stage"),
                  _events_of("meta_event").alias("m"),
                  _events_of("google_event").alias("g"),
                  _events_of("bing_event").alias("b")))
    events = lambda c: F.transform(F.col(c), lambda x: x["e"])
    body = request_body(cfg, F.col("first_stage"), events("m"), events("g"), events("b"))
    return agg.select("plataforma", "batch_id", "n_events", body.alias("body"))


def write_envelopes(env: DataFrame, path: str) -> None:
    """JSON text files, one folder per platform, one line per request:
    ``{"batch_id": ..., "body": "..."}``, so that an answer can name its batch."""
    line = F.to_json(F.struct("batch_id", "body"))
    env.select("plataforma", line.alias("value")).write.mode("overwrite").partitionBy("plataforma").text(path)


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """The requests of ``write_envelopes`` read back: ``(plataforma, batch_id, body)``."""
    lines = spark.read.schema("value string, plataforma string").text(path)
    line = F.from_json("value", "batch_id long, body string")
    return lines.select("plataforma", line.alias("l")).select("plataforma", "l.batch_id", "l.body")
