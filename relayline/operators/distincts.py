"""Exact distinct leads from mergeable bitmaps (A2, A3, A4).

Leads are dealt to slices by a hash and numbered inside their slice, so every
lead has one bit and no task numbers them all. A cell (platform, stage, day)
holds bitmaps of 32,768 leads; cells merge with a bitwise OR, and the count of
set bits is the exact number of distinct leads of any roll-up. Gold is read
once; every roll-up reads bitmaps only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL = ["plataforma", "etapa_funil", "dia"]


def lead_bitmaps(candidates: DataFrame, slices: int | None = None) -> DataFrame:
    """``(plataforma, etapa_funil, dia, fatia, bloco, leads)`` from candidates
    (lead_id, etapa_funil, data_hora_conversao, plataforma). Numbers hold for one
    table of bitmaps; merge bitmaps of one run only."""
    slices = slices or 8 * int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = candidates.where(F.col("lead_id").isNotNull()).select(
        "plataforma", "etapa_funil", F.to_date("data_hora_conversao").alias("dia"), "lead_id",
        F.pmod(F.xxhash64("lead_id"), F.lit(slices)).cast("int").alias("fatia"))
    # one shuffle by slice serves the distinct, the numbering and the bitmaps
    rows = rows.distinct().repartition("fatia")
    numbered = rows.withColumn("_n", F.dense_rank().over(Window.partitionBy("fatia").orderBy("lead_id")))
    return numbered.groupBy("fatia", *CELL, F.bitmap_bucket_number("_n").alias("bloco")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("leads"))


def distinct_leads(bitmaps: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Distinct leads of every grouping in ``sets``, with ``nivel``, the
    grouping id over platform, stage and day (one Expand over the bitmaps)."""
    cols = [F.col(c) for c in CELL]
    merged = bitmaps.groupingSets(
        [[F.col(c) for c in s] + [F.col("fatia"), F.col("bloco")] for s in sets], *cols, "fatia", "bloco").agg(
        F.grouping_id().alias("_id"), F.bitmap_or_agg("leads").alias("leads"))
    return merged.groupBy(*CELL, F.shiftright("_id", 2).cast("int").alias("nivel")).agg(
        F.sum(F.bitmap_count("leads")).alias("leads"))
