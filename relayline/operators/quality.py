"""QA aggregates (A1-A8c) and data-quality audits.

Every measure is an aggregation with map-side partial aggregation; grouping
keys are either low-cardinality labels (tiny final stage) or the lead key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import hash_email, hash_phone
from ..functions.timefmt import date_days_before, ts_lit
from ..schemas import AGE_REGIME_BOUNDS_DAYS, AGE_REGIMES, GOLD_KEY, ORIGINS, STAGES


def eligible_total(eligible: DataFrame) -> DataFrame:
    """A1."""
    return eligible.agg(F.count("*").alias("total"))


def by_platform(df: DataFrame) -> DataFrame:
    """A2."""
    return df.groupBy("plataforma").agg(F.count("*").alias("qtd"))


def routed_quality_counts(routed: DataFrame) -> DataFrame:
    """A3 (ordered by platform, then quality, for a stable display)."""
    return (routed.groupBy("plataforma", "qualidade_match").agg(F.count("*").alias("qtd"))
                  .orderBy("plataforma", "qualidade_match"))


def lead_counts(gold: DataFrame) -> DataFrame:
    """A4: distinct leads and rows."""
    return gold.agg(F.countDistinct("lead_id").alias("leads"), F.count("*").alias("linhas"))


def multi_stage_top(gold: DataFrame, n: int = 5) -> DataFrame:
    """A5/O1: leads with more than one stage row, most first (lead id breaks ties)."""
    return (gold.groupBy("lead_id").agg(F.count("*").alias("etapas"))
                .where(F.col("etapas") > 1)
                .orderBy(F.desc("etapas"), F.asc("lead_id")).limit(n))


def hash_length(gold: DataFrame) -> DataFrame:
    """Length histogram of the e-mail hash (64 expected; NULL is its own group)."""
    return gold.groupBy(F.length("email_hashed").alias("tam")).agg(F.count("*").alias("qtd"))


def age_regime(gold: DataFrame, as_of) -> DataFrame:
    """Three age regimes measured from the as-of *date* (midnight)."""
    ts = F.col("data_hora_conversao")
    d7, d63 = AGE_REGIME_BOUNDS_DAYS
    regime = (F.when(ts >= date_days_before(as_of, d7), F.lit(AGE_REGIMES[0]))
               .when(ts >= date_days_before(as_of, d63), F.lit(AGE_REGIMES[1]))
               .otherwise(F.lit(AGE_REGIMES[2])))
    return gold.groupBy(regime.alias("regime")).agg(F.count("*").alias("qtd"))


def origin_rollup(gold: DataFrame) -> DataFrame:
    """Rows and estimated value per media origin, most rows first."""
    return (gold.groupBy("origem_midia")
                .agg(F.count("*").alias("qtd"), F.sum("vl_faturamento_estimado").alias("valor_estimado"))
                .orderBy(F.desc("qtd"), F.asc("origem_midia")))


def stage_counts(gold: DataFrame) -> DataFrame:
    """A8b."""
    return gold.groupBy("etapa_funil").agg(F.count("*").alias("qtd")).orderBy("etapa_funil")


def identifier_coverage(gold: DataFrame) -> DataFrame:
    """Six measures in one row ("total_leads" counts rows, as in the original)."""
    g, f, m = (F.col(c).isNotNull() for c in ("gclid", "fbclid", "msclkid"))
    no_click = ~g & ~f & ~m
    pii = F.col("email_hashed").isNotNull() | F.col("phone_hashed").isNotNull()
    n = lambda cond: F.count(F.when(cond, 1))
    return gold.agg(
        F.count("*").alias("total_leads"),
        n(g).alias("com_gclid"), n(f).alias("com_fbclid"), n(m).alias("com_msclkid"),
        n(no_click & pii).alias("sem_click_id_com_pii"),
        n(no_click & ~pii).alias("sem_identificador"))


def gold_key_duplicates(gold: DataFrame) -> DataFrame:
    """Gold rows sharing (lead_id, etapa_funil): each multiplies routed rows n x n."""
    return (gold.groupBy(*GOLD_KEY).agg(F.count("*").alias("qtd")).where(F.col("qtd") > 1))


# ---------------------------------------------------------------- audits

def _field_status(gold_hash: str, recomputed) -> F.Column:
    g = F.col(gold_hash)
    return (F.when(g.isNull(), F.lit("sem_hash"))
             .when(recomputed.isNull(), F.lit("nao_normalizavel"))
             .when(g == recomputed, F.lit("ok"))
             .otherwise(F.lit("divergente")))


def audit_hash(raw: DataFrame, gold: DataFrame) -> DataFrame:
    """Recompute the hashes from raw staging and compare with gold, per lead."""
    hashes = gold.select("lead_id", "email_hashed", "phone_hashed").distinct()
    j = raw.join(hashes, "lead_id", "inner")
    return j.select("lead_id",
                    _field_status("email_hashed", hash_email("email_raw")).alias("email_status"),
                    _field_status("phone_hashed", hash_phone("phone_raw")).alias("phone_status"))


def audit_hash_summary(raw: DataFrame, gold: DataFrame) -> DataFrame:
    return (audit_hash(raw, gold).groupBy("email_status", "phone_status")
            .agg(F.count("*").alias("leads")))


def _click_count():
    return sum(F.col(c).isNotNull().cast("int") for c in ("gclid", "fbclid", "msclkid"))


def audit_multitouch(gold: DataFrame) -> DataFrame:
    """Q10: leads with more than one click ID."""
    return (gold.where(_click_count() > 1).groupBy("lead_id")
                .agg(F.max(_click_count()).alias("click_ids")))


def audit_paid_no_click(gold: DataFrame) -> DataFrame:
    """Q11: paid origin but all three click IDs NULL."""
    paid = F.col("origem_midia").isin(*ORIGINS[:3])
    return gold.where(paid & (_click_count() == 0)).select("lead_id").distinct()


def audit_no_click_origin(gold: DataFrame) -> DataFrame:
    """Q12: origins that never produce a click ID."""
    return gold.where(F.col("origem_midia").isin(*ORIGINS[3:])).select("lead_id").distinct()


def audit_future(gold: DataFrame, as_of) -> DataFrame:
    """Q14: conversions stamped after ``as_of``."""
    return (gold.where(F.col("data_hora_conversao") > ts_lit(as_of))
                .select("lead_id", "etapa_funil", "data_hora_conversao"))


def audit_stage_order(gold: DataFrame) -> DataFrame:
    """Q15: a later funnel stage stamped before the previous stage of the same lead.

    Row-level meaning: order a lead's rows by (stage rank, time) and flag a
    row earlier than the row before it. Inside one stage rows are in time
    order, so only the first row of a stage can be flagged, against the last
    row of the previous stage present. Hence: aggregate (lead, stage) to its
    first and last time (map-side), then ``lag`` over at most four rows per
    lead, so a lead with millions of repeated rows is still a tiny window.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("etapa_funil"))
    per_stage = (gold.groupBy("lead_id", "etapa_funil")
                     .agg(F.min("data_hora_conversao").alias("data_hora_conversao"),
                          F.max("data_hora_conversao").alias("_last"))
                     .withColumn("_rank", rank))
    w = Window.partitionBy("lead_id").orderBy("_rank")
    return (per_stage
            .withColumn("etapa_anterior", F.lag("etapa_funil").over(w))
            .withColumn("ts_etapa_anterior", F.lag("_last").over(w))
            .where(F.col("data_hora_conversao") < F.col("ts_etapa_anterior"))
            .select("lead_id", "etapa_funil", "data_hora_conversao", "etapa_anterior", "ts_etapa_anterior"))


def audit_stage_order_rows(gold: DataFrame) -> DataFrame:
    """Q15 by a row-level ``lag`` (reference form; one task sorts a whole lead)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("etapa_funil"))
    w = Window.partitionBy("lead_id").orderBy(rank, F.col("data_hora_conversao"))
    return (gold.select("lead_id", "etapa_funil", "data_hora_conversao")
                .withColumn("etapa_anterior", F.lag("etapa_funil").over(w))
                .withColumn("ts_etapa_anterior", F.lag("data_hora_conversao").over(w))
                .where(F.col("data_hora_conversao") < F.col("ts_etapa_anterior")))


def detections(raw: DataFrame, gold: DataFrame) -> DataFrame:
    """(lead_id, tipo_defeito) flagged by the detectors, one row per pair.

    The phone comparison is the exact detector of badly normalised hashes;
    the e-mail one also flags addresses that were never normalisable. The
    three click-ID detectors come from one aggregation of gold by lead
    (combined map-side) instead of one scan and shuffle each.
    """
    bad_hash = (audit_hash(raw, gold).where(F.col("phone_status") == "divergente")
                .select("lead_id", F.lit("hash_mal_normalizado").alias("tipo_defeito")))
    clicks = _click_count()
    per_lead = gold.groupBy("lead_id").agg(
        F.max((clicks > 1).cast("int")).alias("multitouch"),
        F.max((F.col("origem_midia").isin(*ORIGINS[:3]) & (clicks == 0)).cast("int")).alias("pago_sem_clickid"),
        F.max(F.col("origem_midia").isin(*ORIGINS[3:]).cast("int")).alias("sem_click_id"))
    flags = F.array(*[F.when(F.col(t) == 1, F.lit(t)) for t in ("multitouch", "pago_sem_clickid", "sem_click_id")])
    flagged = per_lead.select("lead_id", F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("tipo_defeito"))
    return bad_hash.unionByName(flagged)


def audit_score(raw: DataFrame, gold: DataFrame, manifest: DataFrame) -> DataFrame:
    """Q13: precision and recall of each detector against the planted manifest."""
    det = detections(raw, gold).distinct().withColumn("_d", F.lit(1))
    lab = manifest.select("lead_id", "tipo_defeito").distinct().withColumn("_l", F.lit(1))
    j = det.join(lab, ["lead_id", "tipo_defeito"], "full_outer")
    s = j.groupBy("tipo_defeito").agg(
        F.count(F.when(F.col("_d").isNotNull() & F.col("_l").isNotNull(), 1)).alias("tp"),
        F.count(F.when(F.col("_d").isNotNull() & F.col("_l").isNull(), 1)).alias("fp"),
        F.count(F.when(F.col("_d").isNull() & F.col("_l").isNotNull(), 1)).alias("fn"))
    return s.select("*",
                    F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precisao"),
                    F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).alias("recall"))
