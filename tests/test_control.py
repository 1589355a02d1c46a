"""Control-table operations: MERGE vectors, validation, change feed, retry."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from relayline.operators import control as ctl
from relayline.schemas import CONTROL, SEND_RESULT

D = dt.datetime


def target_row(lead, stage, plat, status, tries, first):
    return (lead, stage, plat, D(2023, 12, 1), "camp", Decimal("10.00"), "gclid", status, 200, None, "OK",
            tries, first, first, None, None, first)


def batch_row(lead, stage, plat, status, sent, value="20.00"):
    return (lead, stage, plat, D(2023, 12, 2), "camp2", Decimal(value), "email_hash", status,
            200 if status == "aceito" else 400, None if status == "aceito" else "E", "msg", sent)


@pytest.fixture
def vectors(spark):
    t = spark.createDataFrame([
        target_row("a", "MQL", "google", "erro", 1, D(2024, 1, 1)),
        target_row("b", "MQL", "google", "aceito", 2, D(2024, 1, 1)),
        target_row("d", "MQL", "meta", "erro", 1, D(2024, 1, 1)),
        target_row("d", "MQL", "meta", "erro", 1, D(2024, 1, 2)),
    ], CONTROL)
    b = spark.createDataFrame([
        batch_row("a", "MQL", "google", "aceito", D(2024, 2, 1)),
        batch_row("c", "SQL", "bing", "erro", D(2024, 2, 1)),
        batch_row("d", "MQL", "meta", "aceito", D(2024, 2, 1)),
    ], SEND_RESULT)
    return t, b


def _rows(df):
    return sorted((r["lead_id"], r["status_envio"], r["tentativas"], r["ts_primeiro_envio"], r["ts_ultimo_envio"])
                  for r in df.collect())


def test_upsert_vectors(spark, vectors):
    t, b = vectors
    out = ctl.upsert(t, b, now=D(2024, 2, 1, 12))
    assert _rows(out) == [
        ("a", "aceito", 2, D(2024, 1, 1), D(2024, 2, 1)),
        ("b", "aceito", 2, D(2024, 1, 1), D(2024, 1, 1)),
        ("c", "erro", 1, D(2024, 2, 1), D(2024, 2, 1)),
        ("d", "aceito", 2, D(2024, 1, 1), D(2024, 2, 1)),
        ("d", "aceito", 2, D(2024, 1, 2), D(2024, 2, 1)),
    ]
    a = out.where("lead_id = 'a'").collect()[0]
    # matched rows keep conversion time and campaign, take value and identifier from the batch
    assert a["data_hora_conversao"] == D(2023, 12, 1) and a["campaign_id"] == "camp"
    assert a["valor_enviado"] == Decimal("20.00") and a["identificador_usado"] == "email_hash"
    assert a["dt_atualizacao"] == D(2024, 2, 1, 12)
    c = out.where("lead_id = 'c'").collect()[0]
    assert c["status_match"] is None and c["campaign_id"] == "camp2"
    assert out.schema == CONTROL or [f.dataType for f in out.schema] == [f.dataType for f in CONTROL]


def test_upsert_twice_same_rows_more_attempts(spark, vectors):
    t, b = vectors
    once = ctl.upsert(t, b, now=D(2024, 2, 1))
    twice = ctl.upsert(once, b, now=D(2024, 2, 1))
    assert twice.count() == once.count() == 5
    got = {(r["lead_id"], r["ts_primeiro_envio"]): r["tentativas"] for r in twice.collect()}
    assert got[("c", D(2024, 2, 1))] == 2 and got[("a", D(2024, 1, 1))] == 3


def test_duplicate_batch_keys_deduped_to_latest(spark, vectors):
    t, _ = vectors
    b = spark.createDataFrame([
        batch_row("e", "MQL", "google", "erro", D(2024, 2, 1)),
        batch_row("e", "MQL", "google", "aceito", D(2024, 2, 3)),
        batch_row("e", "MQL", "google", "erro", D(2024, 2, 2)),
    ], SEND_RESULT)
    out = ctl.upsert(t, b, now=D(2024, 3, 1)).where("lead_id = 'e'").collect()
    assert len(out) == 1 and out[0]["status_envio"] == "aceito" and out[0]["ts_ultimo_envio"] == D(2024, 2, 3)


def test_null_key_refused(spark, vectors):
    t, _ = vectors
    b = spark.createDataFrame([batch_row(None, "MQL", "google", "aceito", D(2024, 2, 1))], SEND_RESULT)
    with pytest.raises(Exception, match="NULL key"):
        ctl.upsert(t, b, now=D(2024, 3, 1)).collect()


def test_empty_batch_changes_nothing(spark, vectors):
    t, _ = vectors
    empty = spark.createDataFrame([], SEND_RESULT)
    out = ctl.upsert(t, empty, now=D(2024, 3, 1))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, t.collect()))


def test_erro_over_aceito_reopens(spark, vectors):
    t, _ = vectors
    b = spark.createDataFrame([batch_row("b", "MQL", "google", "erro", D(2024, 2, 1))], SEND_RESULT)
    r = ctl.upsert(t, b, now=D(2024, 3, 1)).where("lead_id = 'b'").collect()[0]
    assert r["status_envio"] == "erro" and r["tentativas"] == 3


def test_append_delete_duplicates_violations(spark, vectors):
    t, _ = vectors
    extra = spark.createDataFrame([("a", "MQL", "google", "aceito")],
                                  "lead_id string, etapa_funil string, plataforma string, status_envio string")
    appended = ctl.append(t, extra)
    assert appended.count() == 5
    new = appended.where("status_envio = 'aceito' and lead_id = 'a'").collect()[0]
    assert new["tentativas"] is None and new["campaign_id"] is None
    dups = {(r["lead_id"], r["qtd"]) for r in ctl.duplicates(appended).collect()}
    assert dups == {("a", 2), ("d", 2)}
    rules = {(r["lead_id"], r["regra"]) for r in ctl.violations(appended).collect()}
    assert ("a", "not_null:tentativas") in rules and ("a", "pk_duplicate") in rules
    assert ("a", "not_null:data_hora_conversao") in rules
    bad = ctl.append(t, spark.createDataFrame([("z", "Lead", "tiktok", "sent")],
                                              "lead_id string, etapa_funil string, plataforma string, status_envio string"))
    rules = {r["regra"] for r in ctl.violations(bad).where("lead_id = 'z'").collect()}
    assert {"check:etapa_funil", "check:plataforma", "check:status_envio"} <= rules
    # DELETE keeps rows where the predicate is NULL
    assert ctl.delete_where(appended, F.col("tentativas") > 1).count() == 4
    assert ctl.delete_where(appended, F.col("lead_id") == "d").count() == 3


def test_change_feed(spark, vectors):
    t, b = vectors
    after = ctl.upsert(t, b, now=D(2024, 2, 1))
    ch = ctl.changes(t, after)
    kinds = sorted((r["lead_id"], r["_change_type"]) for r in ch.collect())
    assert kinds == [("a", "update_postimage"), ("a", "update_preimage"), ("c", "insert"),
                     ("d", "update_postimage"), ("d", "update_postimage"),
                     ("d", "update_preimage"), ("d", "update_preimage")]
    deleted = ctl.changes(t, ctl.delete_where(t, F.col("lead_id") == "b"))
    assert [(r["lead_id"], r["_change_type"]) for r in deleted.collect()] == [("b", "delete")]


def test_retry_policy(spark, vectors):
    t, _ = vectors
    t2 = t.withColumn("tentativas", F.when(F.col("lead_id") == "a", 3).otherwise(F.col("tentativas")))
    got = {(r["lead_id"], r["status_envio"]) for r in ctl.apply_retry_policy(t2, 3).collect()}
    assert ("a", "dead_letter") in got and ("d", "erro") in got and ("b", "aceito") in got


def test_upsert_equals_full_outer_join_semantics(spark, vectors):
    """The left-join + anti-join plan gives the full outer join's rows, hot keys included."""
    t, b = vectors
    hot = t.where("lead_id = 'a'")
    for _ in range(6):
        hot = hot.unionByName(hot)
    big = t.unionByName(hot)  # key a repeated 65 times
    out = ctl.upsert(big, b, now=D(2024, 2, 1))
    assert out.count() == big.count() + 1  # one insert (c)
    a_rows = out.where("lead_id = 'a'").collect()
    assert len(a_rows) == 65 and {r["tentativas"] for r in a_rows} == {2}
    assert {r["status_envio"] for r in a_rows} == {"aceito"}
