"""Idempotent loop (M2): eligibility after recording outcomes."""

import datetime as dt

from pyspark.sql import functions as F

from relayline.operators import control as ctl
from relayline.operators.eligibility import candidates, eligible
from relayline.operators.routing import route
from relayline.sources import fixtures as fx
from relayline.schemas import SEND_RESULT_COLUMNS

AS_OF = "2024-04-09 00:00:00"


def test_loop_converges(spark):
    li = fx.table(spark, "/root/testdata/sf0.001", "lineitem")
    gold = fx.gold(li).cache()
    empty = ctl.conform(spark.createDataFrame([], "lead_id string"))
    first = route(eligible(gold, empty, AS_OF, carry=True))
    joined = eligible(gold, empty, AS_OF).join(gold, ["lead_id", "etapa_funil"])  # keys of this gold are unique
    assert first.count() == joined.count()
    n0 = first.count()
    assert n0 > 0
    sent = first.select("lead_id", "etapa_funil", "plataforma", "data_hora_conversao", "campaign_id",
                        F.col("vl_faturamento_estimado").cast("decimal(18,2)").alias("valor_enviado"),
                        "identificador_usado", F.lit("aceito").alias("status_envio"),
                        F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("codigo_erro"),
                        F.lit("OK").alias("mensagem_resposta"),
                        F.lit(AS_OF).cast("timestamp_ntz").alias("ts_envio")).select(*SEND_RESULT_COLUMNS)
    control = ctl.upsert(empty, sent, now=AS_OF).cache()
    assert control.count() == n0
    # everything accepted -> nothing eligible
    assert eligible(gold, control, AS_OF).count() == 0
    # an error does not block: flip some rows to erro, they come back
    errs = sent.where(F.col("lead_id").endswith("1")).withColumn("status_envio", F.lit("erro"))
    control2 = ctl.upsert(control, errs, now=AS_OF)
    back = eligible(gold, control2, AS_OF)
    assert back.count() == errs.count() > 0
    # dead letters come back too, unless blocked
    dead = ctl.apply_retry_policy(control2.withColumn("tentativas", F.lit(9)), 3)
    assert eligible(gold, dead, AS_OF).count() == errs.count()
    assert eligible(gold, dead, AS_OF, block_dead_letter=True).count() == 0
    # a new lead shows up as eligible
    new = gold.limit(1).withColumn("lead_id", F.lit("lead_new")).withColumn(
        "data_hora_conversao", F.lit("2024-04-08 00:00:00").cast("timestamp_ntz")).withColumn("gclid", F.lit("g"))
    got = eligible(gold.unionByName(new), control, AS_OF).select("lead_id", "plataforma").collect()
    assert ("lead_new", "google") in {(r[0], r[1]) for r in got}


def test_null_key_stays_eligible_and_drops_in_routing(spark):
    schema = ("lead_id string, email_hashed string, phone_hashed string, data_hora_conversao timestamp_ntz, "
              "etapa_funil string, vl_faturamento_estimado decimal(18,2), gclid string, fbclid string, "
              "msclkid string, origem_midia string, campaign_id string, produto string, porte_cliente string")
    ts = dt.datetime(2024, 4, 8)
    gold = spark.createDataFrame([(None, None, None, ts, "MQL", None, "g", None, None, "google_ads", None, None, None),
                                  ("x", None, None, ts, "MQL", None, "g", None, None, "google_ads", None, None, None)],
                                 schema)
    control = ctl.conform(spark.createDataFrame([(None, "MQL", "google", "aceito")],
                                                "lead_id string, etapa_funil string, plataforma string, status_envio string"))
    e = eligible(gold, control, AS_OF)
    assert e.count() == 2
    assert [r.lead_id for r in route(eligible(gold, control, AS_OF, carry=True)).collect()] == ["x"]


def test_duplicate_gold_keys_stay_linear(spark):
    schema = ("lead_id string, email_hashed string, phone_hashed string, data_hora_conversao timestamp_ntz, "
              "etapa_funil string, vl_faturamento_estimado decimal(18,2), gclid string, fbclid string, "
              "msclkid string, origem_midia string, campaign_id string, produto string, porte_cliente string")
    ts = dt.datetime(2024, 4, 8)
    rows = [("x", None, None, ts, "MQL", None, "g", None, None, "google_ads", None, None, None)] * 3
    gold = spark.createDataFrame(rows, schema)
    empty = ctl.conform(spark.createDataFrame([], "lead_id string"))
    assert route(eligible(gold, empty, AS_OF, carry=True)).count() == 3  # one per gold row


def test_one_scan_equals_union(spark):
    li = fx.table(spark, "/root/testdata/sf0.001", "lineitem")
    gold = fx.gold(li)
    for windowed in (True, False):
        a = candidates(gold, AS_OF, windowed=windowed, one_scan=True)
        b = candidates(gold, AS_OF, windowed=windowed, one_scan=False)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stage_order_aggregated_equals_row_level(spark):
    from relayline.operators.quality import audit_stage_order, audit_stage_order_rows
    li = fx.table(spark, "/root/testdata/sf0.01", "lineitem")
    for gold in (fx.gold(li), fx.gold_with_duplicates(li)):
        a, b = audit_stage_order(gold), audit_stage_order_rows(gold)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
