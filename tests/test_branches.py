"""Every branch that a query stands for has rows in the test tables."""

import pytest
from pyspark.sql import functions as F

from relayline.plans.catalog import ONE_LEAD, QUERIES

SF = "/root/testdata/sf0.01"

BRANCHES = [
    ("responses_classified", "plataforma = 'bing' AND codigo_erro = 'InvalidClickId'"),
    ("responses_classified", "plataforma = 'bing' AND status_envio = 'aceito'"),
    ("responses_classified", "plataforma = 'google' AND codigo_erro = 'HTTP_400'"),
    ("responses_classified", "plataforma = 'google' AND status_envio = 'aceito'"),
    ("responses_classified", "plataforma = 'meta' AND codigo_erro = 'EVENTS_RECEIVED_MISMATCH'"),
    ("control_violations", "regra = 'not_null:identificador_usado'"),
    ("control_violations", "regra = 'check:status_envio'"),
    ("control_violations", "regra = 'pk_duplicate'"),
    ("control_changes", "_change_type = 'delete'"),
    ("control_changes", "_change_type = 'insert'"),
    ("control_changes", "_change_type = 'update_postimage'"),
    ("phone_normalized", "phone_normalizado IS NULL AND phone_raw IS NOT NULL"),
    ("phone_normalized", "phone_raw LIKE '00%' AND phone_normalizado LIKE '+55%'"),
    ("phone_normalized", "phone_raw IS NULL"),
    ("email_normalized", "email_normalizado IS NULL AND email_raw <> ''"),
    ("payload_bing", "ConversionTime NOT LIKE '%.%'"),
    ("payload_bing", "ConversionTime LIKE '%.%'"),
    ("routed", "gclid = ''"),
    ("payload_google", "gclid IS NULL"),
    ("eligible_one_lead", f"lead_id = '{ONE_LEAD}'"),
    ("control_summary_one_lead", "total > 0"),
    ("document_contacts", "tipo = 'email' AND normalizado IS NOT NULL"),
    ("document_contacts", "tipo = 'fone'"),
    ("retry_state", "status_envio = 'dead_letter'"),
]


@pytest.mark.parametrize("name,condition", BRANCHES)
def test_branch_has_rows(spark, name, condition):
    assert not QUERIES[name](spark, SF).where(condition).isEmpty()


def test_freezing_later_drops_rows(spark):
    assert QUERIES["envelope_batches"](spark, SF).count() < QUERIES["routed"](spark, SF).count()


def test_gold_holds_every_line(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))).first()[0]
    assert QUERIES["gold_conversions"](spark, SF).agg(F.sum("vl_faturamento_estimado")).first()[0] == lines
