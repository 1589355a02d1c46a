"""Answers of unknown shape, and request bodies with a byte limit."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from relayline.operators import answers as ans
from relayline.operators import byte_bodies as bb
from relayline.operators import envelopes as env
from relayline.plans.catalog import AS_OF, _routed
from relayline.schemas import RESPONSE, SEND_RESULT

SF = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 4, 9)


def next_fit(sizes, cap):
    """Bodies one event at a time."""
    out, body, fill = [], 0, 0
    for s in sizes:
        if s > cap:
            out.append(None)
            continue
        if fill + s > cap:
            body, fill = body + 1, 0
        fill += s
        out.append(body)
    return out


def events(spark, parts, per_batch):
    rows = [(p, b, i // per_batch, i % per_batch, s) for (p, b), sizes in parts.items() for i, s in enumerate(sizes)]
    return spark.createDataFrame(rows, "plataforma string, bucket long, batch_id long, position int, bytes int")


def packed(spark, parts, per_batch, cap):
    got = {k: {} for k in parts}
    for r in bb.pack(events(spark, parts, per_batch), F.col("bytes"), cap).collect():
        got[(r.plataforma, r.bucket)][r.batch_id * per_batch + r.position] = r.corpo
    return {k: [v[i] for i in range(len(parts[k]))] for k, v in got.items()}


@pytest.mark.parametrize("per_batch", [7, 50, 5000])
def test_bodies_are_next_fit_however_rows_were_batched(spark, per_batch):
    r = random.Random(5)
    parts = {
        ("meta", 0): [r.randint(1, 40) for _ in range(3000)],
        ("meta", 1): [30] * 1500,                                           # phases that never meet
        ("bing", 0): [r.choice([1, 49, 50, 51, 99, 100]) for _ in range(900)],  # halves and whole limits
        ("bing", 1): [r.choice([5, 60, 101, 500]) for _ in range(700)],      # some fit in no body
        (None, 0): [100],
        ("google", 2): [101, 200],
    }
    assert packed(spark, parts, per_batch, 100) == {k: next_fit(v, 100) for k, v in parts.items()}


def test_limit_of_one_byte_null_sizes_and_no_rows(spark):
    parts = {("meta", 0): [1, None, 1, 0, 2]}
    assert packed(spark, parts, 2, 1) == {("meta", 0): [0, 1, 2, 3, None]}
    assert bb.pack(events(spark, parts, 2).limit(0), F.col("bytes"), 10).count() == 0


def test_bodies_of_missing_platforms_buckets_and_batches(spark):
    r = random.Random(7)
    parts = {(p, b): [r.randint(1, 60) for _ in range(40)] for p in ("meta", "", None) for b in (0, 1, None)}
    assert packed(spark, parts, 9, 100) == {k: next_fit(v, 100) for k, v in parts.items()}
    # a missing batch comes first
    rows = [("meta", 0, None, i, 60) for i in range(3)] + [("meta", 0, 0, i, 40) for i in range(3)]
    df = spark.createDataFrame(rows, "plataforma string, bucket long, batch_id long, position int, bytes int")
    got = {(x.batch_id, x.position): x.corpo for x in bb.pack(df, F.col("bytes"), 100).collect()}
    assert got == {(None, 0): 0, (None, 1): 1, (None, 2): 2, (0, 0): 2, (0, 1): 3, (0, 2): 3}


@pytest.mark.parametrize("bits, levels", [(1, 2), (1, 0), (2, 6)])
def test_bodies_do_not_depend_on_levels(spark, monkeypatch, bits, levels):
    """FINDINGS_r04 F1: levels do not follow the input, the top one composes what is left."""
    monkeypatch.setattr(bb, "FAN_BITS", bits)
    monkeypatch.setattr(bb, "LEVELS", levels)
    r = random.Random(9)
    parts = {("meta", 0): [r.randint(1, 40) for _ in range(300)], ("bing", 0): [30] * 200, ("google", 3): [101] * 20 + [1]}
    assert packed(spark, parts, 7, 100) == {k: next_fit(v, 100) for k, v in parts.items()}


def test_functions_are_composed_from_parts_made_once(spark):
    """FINDINGS_r04 F1: a part that a lambda names again is made again for each step."""
    steps = str(bb._then(F.col("one"), F.col("two"), F.col("cap")))
    assert steps.count("concat(") == 1 and steps.count("filter(") == 3  # steps of the second kept, looked up, made distinct


def test_no_request_body_exceeds_the_limit(spark):
    cfg = env.EnvelopeConfig(meta_test_event_code="TÉST", google_operating_account="12", google_default_destination="9")
    batched = env.assign_batches(_routed(spark, SF), batch_size=64)
    limit = 3000
    again = bb.limit_bytes(batched, limit, cfg)
    assert sorted(again.columns) == sorted(batched.columns)
    key = ["plataforma", "lead_id", "etapa_funil"]
    assert again.groupBy(*key).count().exceptAll(batched.groupBy(*key).count()).count() == 0
    assert again.count() == batched.count() and again.where("batch_id IS NULL").count() == 0
    bodies = env.envelopes(again, cfg).select("plataforma", "batch_id", "n_events", F.octet_length("body").alias("n")).collect()
    assert max(b.n for b in bodies) <= limit
    # a body is closed only because the next event did not fit: an event has at most some 600 bytes
    last = {}
    for b in bodies:
        last[(b.plataforma, b.batch_id >> 32)] = max(last.get((b.plataforma, b.batch_id >> 32), 0), b.batch_id)
    assert all(b.n > limit - 600 for b in bodies if b.batch_id != last[(b.plataforma, b.batch_id >> 32)])
    sizes = {(r.plataforma, r.batch_id): (r.n, r.m, r.top) for r in again.groupBy("plataforma", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("batch_events").alias("m"), F.max("position").alias("top")).collect()}
    assert all(n == m == top + 1 for n, m, top in sizes.values())


def test_events_too_large_for_a_body_are_set_aside(spark):
    batched = env.assign_batches(_routed(spark, SF), batch_size=64)
    again = bb.limit_bytes(batched, 120)
    assert again.count() == batched.count()
    assert again.where("batch_id IS NULL").count() == batched.count()


# ----------------------------------------------------------------- answers

SHAPES = [
    ("meta", 0, 200, '{"events_received": 3}', None),
    ("meta", 1, 200, '{"events_received": 3', "nao_json"),
    ("meta", 2, 200, '{"events_received": "three"}', "campo"),
    ("meta", 3, 200, '{}', "campo"),
    ("meta", 4, 200, '[3]', "campo"),
    ("meta", 5, 200, 'null', "campo"),
    ("meta", 6, 200, ' ', "vazio"),
    ("meta", 7, 503, '<html>busy</html>', "nao_json"),
    ("bing", 0, 200, '{"PartialErrors": []}', None),
    ("bing", 1, 200, '{"PartialErrors": [null, {"Index": 1, "ErrorCode": "E", "Message": "m"}, {"ErrorCode": "X"}]}', None),
    ("bing", 2, 200, '{"PartialErrors": null}', "campo"),
    ("bing", 3, 200, '{"PartialErrors": "none"}', "campo"),
    ("google", 0, 200, '{"requestId": "r"}', None),
    ("google", 1, 400, '{"error": {"code": 400, "details": [{"reason": "R"}, {"fieldViolations": ['
                       '{"field": "events.events[2].currency", "reason": "BAD", "description": "d"},'
                       '{"field": "encoding"}]}]}}', None),
    ("google", 2, 400, '{"error": "quota"}', "campo"),
    ("google", 3, 400, '{"error": {"code": 400, "details": {"a": 1}}}', None),
    ("google", 4, None, None, "vazio"),
]


@pytest.fixture
def shapes(spark):
    rows = [(p, b, h, body, AT) for p, b, h, body, _ in SHAPES]
    return ans.read(spark.createDataFrame(rows, RESPONSE))


def test_every_answer_is_read_or_in_quarantine(shapes):
    got = {(r.plataforma, r.batch_id): r.motivo for r in shapes.collect()}
    assert got == {(p, b): why for p, b, _, _, why in SHAPES}
    kept = {(r.plataforma, r.batch_id): r.raw_body for r in ans.quarantine(shapes).collect()}
    assert kept == {(p, b): body for p, b, _, body, why in SHAPES if why}


def test_errors_of_single_records(shapes):
    got = {(r.plataforma, r.batch_id, r.posicao, r.codigo_erro, r.mensagem) for r in ans.record_errors(shapes).collect()}
    assert got == {("bing", 1, 1, "E", "m"), ("bing", 1, None, "X", None),
                   ("google", 1, 2, "BAD", "d"), ("google", 1, None, None, None)}


def test_each_event_has_one_result(spark, shapes):
    rows = [(f"lead_{p}_{b}_{i}", "venda", p, AT, "c", 1.0, "email", b, i, 3)
            for p, b in [(p, b) for p, b, *_ in SHAPES] + [("bing", 9)] for i in range(3)]
    batched = spark.createDataFrame(rows, "lead_id string, etapa_funil string, plataforma string, data_hora_conversao timestamp_ntz, "
                                          "campaign_id string, vl_faturamento_estimado double, identificador_usado string, "
                                          "batch_id long, position int, batch_events int")
    out = ans.classify(batched, shapes, sent_at=AS_OF)
    assert [f.name for f in out.schema.fields] == [f.name for f in SEND_RESULT.fields]
    got = {r.lead_id: r.codigo_erro for r in out.collect()}
    assert len(got) == len(rows) == out.count()
    whole = {("meta", 0): None, ("meta", 1): "BODY_NAO_JSON", ("meta", 2): "BODY_CAMPO", ("meta", 3): "BODY_CAMPO",
             ("meta", 4): "BODY_CAMPO", ("meta", 5): "BODY_CAMPO", ("meta", 6): "BODY_VAZIO", ("meta", 7): "HTTP_503",
             ("bing", 0): None, ("bing", 1): None, ("bing", 2): "BODY_CAMPO", ("bing", 3): "BODY_CAMPO",
             ("google", 0): None, ("google", 1): "HTTP_400", ("google", 2): "HTTP_400", ("google", 3): "HTTP_400",
             ("google", 4): "HTTP_NULL", ("bing", 9): "NO_RESPONSE"}
    own = {"lead_bing_1_1": "E", "lead_google_1_2": "BAD"}
    assert got == {lead: own.get(lead, whole[(p, b)]) for lead, _, p, _, _, _, _, b, _, _ in rows}
    states = {r.lead_id: r.status_envio for r in out.collect()}
    assert all((states[k] == "aceito") == (v is None) for k, v in got.items())


def test_no_answers_at_all(spark):
    assert ans.read(spark.createDataFrame([], RESPONSE)).count() == 0
