"""Batching, envelopes (P5, P6, M7) and response classification."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from relayline.operators import envelopes as env
from relayline.operators import responses as resp
from relayline.schemas import RESPONSE

SCHEMA = ("lead_id string, etapa_funil string, plataforma string, data_hora_conversao timestamp_ntz, "
          "email_hashed string, phone_hashed string, gclid string, fbclid string, msclkid string, "
          "campaign_id string, vl_faturamento_estimado decimal(18,2), identificador_usado string, "
          "qualidade_match string")
AS_OF = "2024-04-09 00:00:00"


def routed(spark, n, platform="bing", stage=None, ts=dt.datetime(2024, 4, 8)):
    stages = ["MQL", "SQL", "Proposta", "Venda"]
    rows = [(f"lead_{i}", stage or stages[i % 4], platform, ts, "e", None, None, None, f"m{i}", "c",
             Decimal("1.00"), "msclkid", "deterministico") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_batches_capped_and_positions_contiguous(spark):
    b = env.assign_batches(routed(spark, 503), batch_size=10, n_buckets=4, as_of=AS_OF)
    sizes = b.groupBy("batch_id").agg(F.count("*").alias("n"), F.min("position").alias("lo"),
                                      F.max("position").alias("hi")).collect()
    assert sum(r["n"] for r in sizes) == 503
    assert all(r["n"] <= 10 and r["lo"] == 0 and r["hi"] == r["n"] - 1 for r in sizes)
    assert b.select("lead_id").distinct().count() == 503


def test_window_recheck_drops_stale(spark):
    old = routed(spark, 5, platform="meta", ts=dt.datetime(2024, 3, 1))
    fresh = routed(spark, 3, platform="meta")
    b = env.assign_batches(old.unionByName(fresh), batch_size=10, n_buckets=2, as_of=AS_OF)
    assert b.count() == 3
    assert env.assign_batches(old, batch_size=10, n_buckets=2, as_of=AS_OF, recheck_window=False).count() == 5


def test_google_batches_never_mix_stages(spark):
    b = env.assign_batches(routed(spark, 200, platform="google"), batch_size=7, n_buckets=3, as_of=AS_OF)
    mixed = b.groupBy("batch_id").agg(F.countDistinct("etapa_funil").alias("s")).where("s > 1").count()
    assert mixed == 0


def test_envelope_bodies(spark):
    data = routed(spark, 12, platform="meta").unionByName(routed(spark, 5, platform="google", stage="Venda")) \
        .unionByName(routed(spark, 4, platform="bing"))
    b = env.assign_batches(data, batch_size=5, n_buckets=1, as_of=AS_OF)
    cfg = env.EnvelopeConfig(meta_test_event_code="T1", google_operating_account="123",
                             google_destination_by_stage={"Venda": "999"}, google_default_destination="0")
    rows = env.envelopes(b, cfg).collect()
    by = {}
    for r in rows:
        body = json.loads(r["body"])
        by.setdefault(r["plataforma"], []).append((r["n_events"], body))
    meta = by["meta"]
    assert sorted(n for n, _ in meta) == [2, 5, 5]
    assert all(body["test_event_code"] == "T1" and len(body["data"]) == n for n, body in meta)
    [(n, g)] = by["google"]
    assert n == 5 and g["encoding"] == "HEX" and len(g["events"]) == 5
    assert g["destinations"] == [{"operatingAccount": {"product": "GOOGLE_ADS", "accountId": "123"},
                                  "productDestinationId": "999"}]
    [(n, bing)] = by["bing"]
    order = [r["msclkid"] for r in b.where("plataforma = 'bing'").orderBy("position").collect()]
    assert [e["MicrosoftClickId"] for e in bing["OfflineConversions"]] == order


def test_write_envelopes(spark, tmp_path):
    b = env.assign_batches(routed(spark, 9), batch_size=4, n_buckets=1, as_of=AS_OF)
    out = str(tmp_path / "env")
    env.write_envelopes(env.envelopes(b), out)
    back = spark.read.text(out)
    assert back.count() == 3 and set(back.columns) == {"value", "plataforma"}
    named = {json.loads(r["value"])["batch_id"] for r in back.collect()}
    assert named == {r["batch_id"] for r in b.select("batch_id").distinct().collect()}


def test_classification(spark):
    data = routed(spark, 6, platform="bing").unionByName(routed(spark, 4, platform="meta")) \
        .unionByName(routed(spark, 3, platform="google", stage="SQL"))
    b = env.assign_batches(data, batch_size=100, n_buckets=1, as_of=AS_OF).cache()
    ids = {r["plataforma"]: r["batch_id"] for r in b.select("plataforma", "batch_id").distinct().collect()}
    pos0 = b.where("plataforma = 'bing' and position = 2").select("lead_id").collect()[0][0]
    t = dt.datetime(2024, 4, 9, 0, 1)
    responses = spark.createDataFrame([
        ("bing", ids["bing"], 200, json.dumps({"PartialErrors": [
            {"Index": 2, "Code": 1, "ErrorCode": "InvalidClickId", "Message": "bad"}, None]}), t),
        ("meta", ids["meta"], 200, json.dumps({"events_received": 3, "messages": [], "fbtrace_id": "x"}), t),
    ], RESPONSE)
    out = resp.classify(b, responses, sent_at=AS_OF).collect()
    st = {(r["plataforma"], r["lead_id"]): (r["status_envio"], r["codigo_erro"]) for r in out}
    assert st[("bing", pos0)] == ("erro", "InvalidClickId")
    assert sum(1 for (p, _), v in st.items() if p == "bing" and v[0] == "aceito") == 5
    assert all(v == ("erro", "EVENTS_RECEIVED_MISMATCH") for (p, _), v in st.items() if p == "meta")
    assert all(v == ("erro", "NO_RESPONSE") for (p, _), v in st.items() if p == "google")
    assert all(r["ts_envio"] is not None for r in out)
    # a full Meta count and a 2xx Google answer accept their batches
    ok = spark.createDataFrame([
        ("meta", ids["meta"], 200, json.dumps({"events_received": 4, "messages": [], "fbtrace_id": "x"}), t),
        ("google", ids["google"], 204, "{}", t)], RESPONSE)
    out = resp.classify(b.where("plataforma != 'bing'"), ok).collect()
    assert {r["status_envio"] for r in out} == {"aceito"} and len(out) == 7


def test_batches_with_many_identical_rows(spark):
    hot = routed(spark, 1, platform="bing")
    hot = hot.select("*", F.explode(F.array_repeat(F.lit(1), 10001)).alias("_x")).drop("_x")
    data = hot.unionByName(routed(spark, 37, platform="bing"))
    b = env.assign_batches(data, batch_size=500, n_buckets=4, as_of=AS_OF).cache()
    assert b.count() == 10038
    assert b.where("lead_id = 'lead_0'").count() == 10002  # the hot copies plus the distinct lead_0 row
    slots = b.groupBy("batch_id", "position").count().where("count > 1").count()
    assert slots == 0
    sizes = b.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("position").alias("hi"),
                                      F.first("batch_events").alias("declared")).collect()
    assert all(r["n"] <= 500 and r["hi"] == r["n"] - 1 and r["declared"] == r["n"] for r in sizes)
