"""Eligibility and upsert over tables bucketed by (lead_id, etapa_funil).

Gold has no platform column and control's key has one, so the joins use what
both are bucketed by and keep the platforms of a (lead, stage) together: at
most one entry per platform of the CHECK rule (and of whatever breaks it).
Neither gold nor control is shuffled; only the batch is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CONTROL_COLUMNS, GOLD_KEY, KEY, PLATFORM_RULES, SEND_RESULT_COLUMNS
from . import control as ctl
from .eligibility import CANDIDATE_COLUMNS, platform_predicate


def eligible(gold: DataFrame, control: DataFrame, as_of, windowed: bool = True, future_guard: bool = False,
             block_dead_letter: bool = False, carry: bool = False, rules=PLATFORM_RULES) -> DataFrame:
    """``eligibility.eligible`` without a shuffle of gold or control: the
    platforms that block a (lead, stage) are collected in its bucket, joined
    to its gold row, and left out when the row is fanned out."""
    statuses = ["aceito"] + (["dead_letter"] if block_dead_letter else [])
    blocked = control.where(F.col("status_envio").isin(*statuses)).groupBy(*GOLD_KEY).agg(
        F.collect_set("plataforma").alias("_blocked"))
    preds = [(r.name, platform_predicate(r, as_of, windowed, future_guard)) for r in rules]
    signals = gold.where(reduce(lambda a, b: a | b, [p for _, p in preds])).withColumn(
        "_platforms", F.filter(F.array(*[F.when(p, F.lit(name)) for name, p in preds]), lambda x: x.isNotNull()))
    open_ = F.when(F.col("_blocked").isNull(), F.col("_platforms")).otherwise(
        F.array_except("_platforms", "_blocked"))
    out = signals.join(blocked, GOLD_KEY, "left").withColumn("plataforma", F.explode(open_))
    return out.select(*gold.columns, "plataforma") if carry else out.select(*CANDIDATE_COLUMNS)


def upsert(target: DataFrame, batch: DataFrame, now) -> DataFrame:
    """``control.upsert`` without a shuffle of the target: the batch, one row
    per key, is gathered per (lead, stage) as a map from platform to row; the
    target's rows look theirs up, and what its bucket lacks is inserted."""
    rest = [c for c in SEND_RESULT_COLUMNS if c not in KEY]
    src = ctl.dedupe_batch(ctl.refuse_null_keys(batch.select(*SEND_RESULT_COLUMNS)))
    row = F.struct(*KEY, *rest, F.lit(True).alias("_s"))
    per_lead = src.groupBy(*GOLD_KEY).agg(F.map_from_entries(F.collect_list(F.struct("plataforma", row))).alias("_rows"))
    whole = ctl.conform(target)
    found = whole.join(per_lead, GOLD_KEY, "left").select(
        F.struct(*CONTROL_COLUMNS).alias("t"), F.try_element_at("_rows", F.col("plataforma")).alias("s"))
    updated = found.select(*ctl._updated_exprs(str(now)))
    have = whole.groupBy(*GOLD_KEY).agg(F.collect_set("plataforma").alias("_have"))
    new = per_lead.join(have, GOLD_KEY, "left").select(F.explode(F.map_filter(
        "_rows", lambda k, _: ~F.array_contains(F.coalesce("_have", F.array().cast("array<string>")), k))).alias("_k", "s"))
    return updated.unionByName(new.select("s.*").select(*ctl._inserted_exprs(str(now))))
