"""Routing (J2, R2-R4): pick the identifier each eligible row travels with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import expression_cache
from ..schemas import GOLD_KEY, PLATFORM_RULES

ROUTED_COLUMNS = [
    "lead_id", "etapa_funil", "plataforma", "data_hora_conversao",
    "email_hashed", "phone_hashed", "gclid", "fbclid", "msclkid",
    "campaign_id", "vl_faturamento_estimado", "identificador_usado", "qualidade_match",
]


@expression_cache
def identifier_used(platform: str = "plataforma") -> Column:
    """Own click ID, else e-mail hash, else phone hash, else none.

    No ELSE for an unknown platform: the result is NULL there.
    """
    p = F.col(platform)
    out = None
    for r in PLATFORM_RULES:
        inner = (F.when(F.col(r.click_col).isNotNull(), F.lit(r.click_col))
                  .when(F.col("email_hashed").isNotNull(), F.lit("email_hash"))
                  .when(F.col("phone_hashed").isNotNull(), F.lit("phone_hash"))
                  .otherwise(F.lit("sem_identificador")))
        out = F.when(p == r.name, inner) if out is None else out.when(p == r.name, inner)
    return out


@expression_cache
def match_quality(platform: str = "plataforma") -> Column:
    """Deterministic with the platform's own click ID, probabilistic with any hash."""
    p = F.col(platform)
    own_click = None
    for r in PLATFORM_RULES:
        c = (p == r.name) & F.col(r.click_col).isNotNull()
        own_click = c if own_click is None else (own_click | c)
    return (F.when(own_click, F.lit("deterministico"))
             .when(F.col("email_hashed").isNotNull() | F.col("phone_hashed").isNotNull(), F.lit("probabilistico"))
             .otherwise(F.lit("sem_identificador")))


def classify(df: DataFrame) -> DataFrame:
    """Add the two routing columns to rows that already carry gold fields."""
    return df.withColumn("identificador_usado", identifier_used()).withColumn("qualidade_match", match_quality())


def route(eligible_carried: DataFrame) -> DataFrame:
    """R2, one pass: eligible rows that carry their gold columns (built with
    ``eligibility.eligible(..., carry=True)``) get their identifier and quality.

    No second join: each gold row yields at most one routed row per platform,
    so the output is linear in gold even when (lead_id, etapa_funil) repeats.
    Rows without lead or stage match nothing, as in a join on these keys.
    """
    keyed = eligible_carried.where(F.col("lead_id").isNotNull() & F.col("etapa_funil").isNotNull())
    return classify(keyed).select(*ROUTED_COLUMNS)


def route_by_join(eligible: DataFrame, gold: DataFrame, whole=None) -> DataFrame:
    """R2 as a join of the eligible keys with gold on (lead, stage), without
    the time: a gold key that occurs n times gives n x n routed rows (trap 7),
    as the original does. For parity checks; ``route`` is linear. ``whole``
    makes the rows' other columns once they are joined, from those of ``gold``,
    which the join then moves alone."""
    fields = gold.drop("data_hora_conversao")
    joined = eligible.join(fields, GOLD_KEY)
    return classify(joined if whole is None else whole(joined)).select(*ROUTED_COLUMNS)
