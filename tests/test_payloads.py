"""Golden payloads (P1-P4), compared as parsed JSON, plus the edge cases."""

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest

from relayline.operators import payloads as pay
from relayline.operators.routing import ROUTED_COLUMNS

SCHEMA = ("lead_id string, etapa_funil string, plataforma string, data_hora_conversao timestamp_ntz, "
          "email_hashed string, phone_hashed string, gclid string, fbclid string, msclkid string, "
          "campaign_id string, vl_faturamento_estimado decimal(18,2), identificador_usado string, "
          "qualidade_match string")

# ---- Sample rows of this suite's own; field names and formats are what counts.

def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


EM, PM = hashed("ana@exemplo.example"), hashed("+5541900000001")
EG, PG = hashed("bia@exemplo.example"), hashed("+5541900000002")
EB, PB = hashed("caio@exemplo.example"), hashed("+5541900000003")
ED, PD = hashed("davi@exemplo.example"), hashed("+5541900000004")


def row(lead, stage, platform, ts, email=None, phone=None, gclid=None, fbclid=None, msclkid=None, value=None):
    return (lead, stage, platform, ts, email, phone, gclid, fbclid, msclkid, "c_001",
            None if value is None else Decimal(value), None, None)


def payloads(spark, rows, goal_name=None):
    df = spark.createDataFrame(rows, SCHEMA)
    out = pay.build(df, goal_name=goal_name).orderBy("lead_id", "etapa_funil", "plataforma").collect()
    return [json.loads(r["payload"]) if r["payload"] is not None else None for r in out]


def test_meta_golden(spark):
    ts = dt.datetime(2024, 3, 2, 10, 20, 30, 400000)
    [got] = payloads(spark, [row("lead_m1", "Venda", "meta", ts, EM, PM, fbclid="fbclid_m1", value="123.40")])
    assert got == {
        "event_name": "Lead_Venda", "event_time": 1709374830, "action_source": "system_generated",
        "event_id": "lead_m1_Venda",
        "user_data": {"em": [EM], "ph": [PM], "fbc": "fb.1.1709374830400.fbclid_m1"},
        "custom_data": {"value": 123.4, "currency": "BRL"},
    }


def test_google_golden(spark):
    ts = dt.datetime(2024, 2, 29, 23, 59, 58, 123)
    [got] = payloads(spark, [row("lead_g1", "Venda", "google", ts, EG, PG, gclid="gclid_g1", value="88.25")])
    assert got == {
        "transactionId": "lead_g1_Venda", "eventTimestamp": "2024-02-29T23:59:58.000123Z",
        "eventSource": "OTHER", "conversionValue": 88.25, "currency": "BRL",
        "userData": {"userIdentifiers": [{"emailAddress": EG}, {"phoneNumber": PG}]},
        "adIdentifiers": {"gclid": "gclid_g1"},
    }


def test_bing_golden_both_branches(spark):
    rows = [row("lead_b2", "Venda", "bing", dt.datetime(2024, 1, 31, 6, 7, 8, 90000), EB, PB,
                msclkid="msclkid_b2", value="77.10"),
            row("lead_b1", "MQL", "bing", dt.datetime(2024, 3, 31, 11, 12, 13, 14015), ED, PD, value="9.99")]
    a, b = payloads(spark, rows)
    assert b == {"ConversionName": "Lead_Venda", "ConversionTime": "2024-01-31T06:07:08.090000Z",
                 "ConversionValue": 77.1, "ConversionCurrencyCode": "BRL", "MicrosoftClickId": "msclkid_b2",
                 "HashedEmailAddress": EB, "HashedPhoneNumber": PB}
    assert a == {"ConversionName": "Lead_MQL", "ConversionTime": "2024-03-31T11:12:13.014015Z",
                 "ConversionValue": 9.99, "ConversionCurrencyCode": "BRL",
                 "HashedEmailAddress": ED, "HashedPhoneNumber": PD}


def test_bing_goal_name(spark):
    [got] = payloads(spark, [row("l", "SQL", "bing", dt.datetime(2024, 1, 1), msclkid="m")], goal_name="Goal X")
    assert got["ConversionName"] == "Goal X"


def test_edge_cases(spark):
    midnight = dt.datetime(2024, 3, 1, 0, 0, 0)
    rows = [
        # micros = 0 -> no fraction; NULL value -> 0.0; no identifier -> empty list, no adIdentifiers
        row("a", "MQL", "google", midnight),
        # empty-string click ID is absent from the payload
        row("b", "MQL", "meta", midnight, email="", fbclid=""),
        row("c", "MQL", "bing", midnight, msclkid="", phone="p"),
    ]
    g, m, b = payloads(spark, rows)
    assert g["eventTimestamp"] == "2024-03-01T00:00:00Z"
    assert g["conversionValue"] == 0.0
    assert g["userData"] == {"userIdentifiers": []}
    assert "adIdentifiers" not in g
    assert m["user_data"] == {}
    assert m["custom_data"]["value"] == 0.0
    assert b == {"ConversionName": "Lead_MQL", "ConversionTime": "2024-03-01T00:00:00Z", "ConversionValue": 0.0,
                 "ConversionCurrencyCode": "BRL", "HashedPhoneNumber": "p"}


def test_unknown_platform(spark):
    df = spark.createDataFrame([row("x", "MQL", "tiktok", dt.datetime(2024, 1, 1), email="e")], SCHEMA)
    r = pay.build(df, strict=False).collect()[0]
    assert r["payload"] is None and r["known_platform"] is False
    with pytest.raises(Exception, match="unknown platform"):
        pay.build(df).collect()


def test_sendable_flag(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([row("a", "MQL", "google", ts), row("b", "MQL", "google", ts, gclid="g"),
                                row("c", "MQL", "meta", ts, gclid="g"), row("d", "MQL", "bing", ts, phone="p")], SCHEMA)
    got = {r["lead_id"]: r["sendable"] for r in pay.build(df).collect()}
    assert got == {"a": False, "b": True, "c": False, "d": True}


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([row("a", "MQL", "google", dt.datetime(2024, 1, 1))], SCHEMA)
    plan = pay.build(df)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_routed_columns_order():
    assert ROUTED_COLUMNS[:4] == ["lead_id", "etapa_funil", "plataforma", "data_hora_conversao"]
