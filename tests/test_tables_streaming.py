"""Snapshot tables (S6, S7, S11, S12) and the streamed outcome loop."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from relayline.operators import control as ctl
from relayline.operators import responses as resp
from relayline.plans.catalog import AS_OF, BATCH_SIZE, N_BUCKETS
from relayline.schemas import KEY
from relayline.sources.store import Fixtures
from relayline.sources.tables import ControlTable, SnapshotTable
from relayline.streaming.outcomes import start_outcome_stream

SF = "/root/testdata/sf0.001"


def test_snapshot_versions_and_views(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), cluster=["id"])
    assert t.latest() is None
    v0 = t.write(spark.range(5).withColumnRenamed("id", "id"))
    v1 = t.write(t.read().where("id > 1"))
    assert (v0, v1) == (0, 1) and t.versions() == [0, 1]
    assert t.read().count() == 3 and t.read(0).count() == 5
    t.publish("snap_view")
    assert spark.sql("select count(*) from snap_view").first()[0] == 3
    # a half-written version (no _SUCCESS) is invisible, and so is one aside
    os.makedirs(tmp_path / "t" / "v=7")
    assert t.latest() == 1
    with pytest.raises(ValueError):
        t.write(spark.createDataFrame([(1,), (1,)], "id long"), unique_key=["id"])
    assert t.latest() == 1


def test_namespaced_table_moves_between_versions(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.write(spark.range(5))
    t.write(spark.range(2))
    t.publish_table("relayline_ns", "ids")
    assert spark.table("relayline_ns.ids").count() == 2
    t.publish_table("relayline_ns", "ids", 0)
    spark.sql("USE relayline_ns")
    try:
        assert spark.table("ids").count() == 5
    finally:
        spark.sql("USE default")
    assert t.read().count() == 2


def test_control_table_round_trip(spark, tmp_path):
    f = Fixtures(spark, SF)
    table = ControlTable(spark, str(tmp_path / "control"))
    assert table.read().count() == 0
    table.write(f.control())
    n0 = table.read().count()
    v = table.upsert(f.send_results(), now=AS_OF)
    assert table.read().count() == ctl.upsert(f.control(), f.send_results(), AS_OF).count()
    changes = table.changes_since(0).groupBy("_change_type").count().collect()
    assert {r[0] for r in changes} <= {"insert", "update_preimage", "update_postimage"}
    table.delete_where(F.col("status_envio") == "dead_letter")
    assert table.read().where("status_envio = 'dead_letter'").count() == 0
    assert table.read(v).count() >= n0


def test_outcome_stream_exactly_once(spark, tmp_path):
    f = Fixtures(spark, SF, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS)
    batched = f.batched_sends()
    responses = f.responses()
    rdir = str(tmp_path / "responses")
    # two deliveries: one file per platform group
    responses.where("plataforma = 'bing'").coalesce(1).write.parquet(rdir + "/part1")
    responses.where("plataforma != 'bing'").coalesce(1).write.parquet(rdir + "/part2")
    table = ControlTable(spark, str(tmp_path / "control"))
    table.write(f.control())
    ckpt = str(tmp_path / "ckpt")
    q = start_outcome_stream(spark, rdir + "/*", batched, table, ckpt, files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    assert len(table.versions()) == 3  # base + one per epoch
    expected = ctl.apply_retry_policy(ctl.upsert(f.control(), resp.classify(batched, responses),
                                                 now=dt.datetime(2024, 4, 9, 0, 1)))
    got = table.read()
    assert got.count() == expected.count()
    assert got.select(*KEY, "status_envio", "tentativas").exceptAll(
        expected.select(*KEY, "status_envio", "tentativas")).count() == 0
    # restart: nothing new, nothing applied twice
    q = start_outcome_stream(spark, rdir + "/*", batched, table, ckpt, files_per_trigger=1)
    q.awaitTermination(300)
    assert len(table.versions()) == 3


def test_bucketed_upsert_rewrites_touched_buckets_once(spark, tmp_path):
    from relayline.sources.tables import BucketedControlTable
    f = Fixtures(spark, SF)
    table = BucketedControlTable(spark, str(tmp_path / "ctl"), str(tmp_path / "staging"), n_buckets=16)
    table.write_all(f.control())

    def listing():
        out = {}
        for d in sorted(os.listdir(tmp_path / "ctl")):
            if d.startswith("bucket="):
                out[d] = sorted(os.listdir(tmp_path / "ctl" / d))
        return out

    before = listing()
    batch = f.send_results().where(F.col("lead_id").isin("lead_1", "lead_2", "lead_3", "lead_4", "lead_5", "lead_7"))
    touched = table.upsert(batch, now=AS_OF, tag="b1")
    after = listing()
    assert 0 < len(touched) < 16
    for d, files in before.items():
        b = int(d.split("=")[1])
        if b not in touched:
            assert after[d] == files  # untouched buckets keep their files
    expected = ctl.upsert(f.control(), batch, AS_OF)
    got = table.read().drop("bucket")
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    # a retry of the same batch re-copies the staged result: nothing applied twice
    table.upsert(batch, now=AS_OF, tag="b1")
    again = table.read().drop("bucket")
    assert again.exceptAll(expected).count() == 0 and again.count() == expected.count()


def test_outcome_stream_into_bucketed_table(spark, tmp_path):
    from relayline.sources.tables import BucketedControlTable
    f = Fixtures(spark, SF, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS)
    batched, responses = f.batched_sends(), f.responses()
    rdir = str(tmp_path / "responses")
    responses.where("plataforma = 'bing'").coalesce(1).write.parquet(rdir + "/part1")
    responses.where("plataforma != 'bing'").coalesce(1).write.parquet(rdir + "/part2")
    table = BucketedControlTable(spark, str(tmp_path / "ctl"), str(tmp_path / "staging"), n_buckets=8)
    table.write_all(f.control())
    q = start_outcome_stream(spark, rdir + "/*", batched, table, str(tmp_path / "ckpt"), files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    expected = ctl.apply_retry_policy(ctl.upsert(f.control(), resp.classify(batched, responses),
                                                 now=dt.datetime(2024, 4, 9, 0, 1)))
    got = table.read().drop("bucket")
    assert got.count() == expected.count()
    assert got.select(*KEY, "status_envio", "tentativas").exceptAll(
        expected.select(*KEY, "status_envio", "tentativas")).count() == 0


def test_daily_job_writes_batches_and_envelopes(spark, tmp_path):
    import json as _json

    from relayline.operators.eligibility import eligible as _eligible
    from relayline.plans import daily

    f = Fixtures(spark, SF)
    gold_path = str(tmp_path / "gold")
    f.gold().write.parquet(gold_path)
    table = ControlTable(spark, str(tmp_path / "control"))
    table.write(f.control())
    out = daily.run(spark, gold_path, table.root, AS_OF, str(tmp_path / "out"), batch_size=40, n_buckets=4)
    batches = spark.read.parquet(out["batches"])
    expected = _eligible(f.gold(), f.control(), AS_OF, future_guard=True).count()
    assert batches.count() == expected > 0
    bodies = spark.read.text(out["envelopes"]).collect()
    n_events = 0
    for r in bodies:
        body = _json.loads(_json.loads(r["value"])["body"])
        events = body.get("data") or body.get("events") or body.get("OfflineConversions")
        assert 0 < len(events) <= 40
        n_events += len(events)
    assert n_events == expected


def _stream(spark, tmp_path, table, batched, responses, name):
    folder = str(tmp_path / f"responses-{name}")
    responses.coalesce(1).write.parquet(folder)
    q = start_outcome_stream(spark, folder, batched, table, str(tmp_path / f"ckpt-{name}"))
    q.awaitTermination(300)
    assert q.exception() is None


def _tables(spark, tmp_path, control):
    from relayline.sources.tables import BucketedControlTable
    one = ControlTable(spark, str(tmp_path / "snapshots"))
    one.write(control)
    two = BucketedControlTable(spark, str(tmp_path / "buckets"), str(tmp_path / "staging"), n_buckets=8)
    two.write_all(control)
    return [one, two]


def _state(table):
    return sorted((r.lead_id, r.etapa_funil, r.plataforma, r.status_envio, r.tentativas) for r in table.read().collect())


def test_two_streams_on_one_table_both_apply(spark, tmp_path):
    f = Fixtures(spark, SF, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS)
    batched, responses, control = f.batched_sends(), f.responses(), f.control()
    for k, table in enumerate(_tables(spark, tmp_path, control)):
        for platform in ("bing", "meta"):  # each stream numbers its epochs from 0
            part = responses.where(F.col("plataforma") == platform)
            _stream(spark, tmp_path, table, batched, part, f"{platform}-{k}")
        both = responses.where("plataforma IN ('bing', 'meta')")
        expected = ctl.apply_retry_policy(ctl.upsert(control, resp.classify(batched, both, answered_only=True), now=AS_OF))
        assert _state(table) == sorted((r.lead_id, r.etapa_funil, r.plataforma, r.status_envio, r.tentativas)
                                       for r in expected.collect())


def test_answers_without_a_time_are_applied(spark, tmp_path):
    f = Fixtures(spark, SF, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS)
    late = f.responses().withColumn("ts_resposta", F.lit(None).cast("timestamp_ntz"))
    for k, table in enumerate(_tables(spark, tmp_path, f.control())):
        n = table.read().count()
        _stream(spark, tmp_path, table, f.batched_sends(), late, f"untimed-{k}")
        assert table.read().count() > n
        assert table.read().where("ts_ultimo_envio IS NULL").isEmpty()


def test_killed_write_applies_once(spark, tmp_path, monkeypatch):
    """A job lost before the rename (snapshots) or in the copy (buckets) leaves
    no half-applied batch; its retry raises the attempts once."""
    from relayline.sources.tables import BucketedControlTable
    f = Fixtures(spark, SF)
    batch, later = f.send_results().where("plataforma = 'bing'"), f.send_results().where("plataforma = 'meta'")
    one, two = _tables(spark, tmp_path, f.control())
    expected = ctl.upsert(ctl.upsert(f.control(), batch, AS_OF), later, AS_OF)
    expected = sorted((r.lead_id, r.etapa_funil, r.plataforma, r.status_envio, r.tentativas) for r in expected.collect())

    def lost(*_):
        raise RuntimeError("lost")
    before = _state(one)
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_rename", lost)
        with pytest.raises(RuntimeError):
            one.upsert(batch, now=AS_OF, tag="a")
    assert _state(one) == before and one.tagged("a") is None
    one.upsert(batch, now=AS_OF, tag="a")
    assert one.tagged("a") is not None
    one.upsert(later, now=AS_OF, tag="b")
    assert _state(one) == expected
    with monkeypatch.context() as m:
        m.setattr(BucketedControlTable, "_copy", lost)
        with pytest.raises(RuntimeError):
            two.upsert(batch, now=AS_OF, tag="a")
    two.upsert(later, now=AS_OF, tag="b")  # finishes the copy of a first
    assert two.upsert(batch, now=AS_OF, tag="a") == []  # an applied tag is not copied again
    assert _state(two) == expected


def test_broken_rows_are_not_published(spark, tmp_path):
    f = Fixtures(spark, SF)
    table = ControlTable(spark, str(tmp_path / "control"))
    table.write(f.control())
    bad = f.send_results().withColumn("status_envio", F.lit("enviado"))
    with pytest.raises(ValueError, match="check:status_envio"):
        table.upsert(bad, now=AS_OF)
    assert table.versions() == [0]


def test_outcome_job_closes_the_loop(spark, tmp_path):
    from relayline.operators.reconcile import reconcile, valid_reports
    from relayline.plans import daily, outcome
    f = Fixtures(spark, SF, as_of=AS_OF)
    f.gold().write.parquet(str(tmp_path / "gold"))
    table = ControlTable(spark, str(tmp_path / "control"))
    table.write(f.control())
    made = daily.run(spark, str(tmp_path / "gold"), table.root, AS_OF, str(tmp_path / "out"), batch_size=40)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):  # a run is written once
        daily.run(spark, str(tmp_path / "gold"), table.root, AS_OF, str(tmp_path / "out"), batch_size=40)
    batches = spark.read.parquet(made["batches"])
    answers = batches.groupBy("plataforma", "batch_id").agg(F.count(F.lit(1)).alias("n")).select(
        "plataforma", "batch_id", F.when(F.col("plataforma") == "google", 500).otherwise(200).alias("http_status"),
        F.when(F.col("plataforma") == "meta", F.to_json(F.struct(F.col("n").cast("int").alias("events_received"))))
         .otherwise(F.lit('{"PartialErrors": []}')).alias("body"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("ts_resposta"))
    answers.write.parquet(str(tmp_path / "answers"))
    f.platform_report().write.parquet(str(tmp_path / "report"))
    run_dir = made["batches"].rpartition("/")[0]
    args = (spark, run_dir, str(tmp_path / "answers"), table.root, AS_OF, str(tmp_path / "report"))
    version = outcome.run(*args)
    after = table.read().cache()
    assert outcome.run(*args) == version and table.versions() == [0, version]  # applied once
    sent = batches.select(*KEY)
    now = after.join(sent, KEY)
    assert now.count() == sent.count()
    assert now.where("plataforma = 'google' AND status_envio = 'aceito'").isEmpty()
    assert now.where("plataforma <> 'google' AND status_envio <> 'aceito'").isEmpty()
    assert after.where("status_envio = 'erro' AND tentativas >= 3").isEmpty()  # M5
    assert not after.where("status_match = 'casado'").isEmpty()                # M6
    assert after.where("status_envio = 'aceito' AND ts_reconciliacao IS NULL").isEmpty()
    assert reconcile(after, valid_reports(f.platform_report(), AS_OF), AS_OF, 3).exceptAll(after).isEmpty()


def test_slices_change_no_batch(spark):
    from relayline.operators.envelopes import assign_batches
    from relayline.plans.catalog import QUERIES
    routed = QUERIES["routed"](spark, SF)
    a, b = (assign_batches(routed, batch_size=7, n_buckets=n).select("plataforma", "batch_id", "position", *KEY[:2])
            for n in (1, 333))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count() > 0


def test_job_and_stream_leave_equal_tables(spark, tmp_path):
    """The same answers and reports, by the outcome job, into snapshots and
    into buckets; the stream settles as the job does."""
    from relayline.plans import outcome
    f = Fixtures(spark, SF, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS)
    batched, responses, control, report = f.batched_sends(), f.responses(), f.control(), f.report_history()
    now = responses.agg(F.max("ts_resposta")).first()[0]
    want = outcome.next_control(control, batched, responses, now, report)

    def whole(df):
        return sorted(map(str, df.select(*control.columns).collect()))
    want = whole(want)
    assert any("dead_letter" in r for r in want) and any("nao_casado" in r for r in want)
    folder = str(tmp_path / "answers")
    responses.coalesce(1).write.parquet(folder)
    for k, table in enumerate(_tables(spark, tmp_path, control)):
        q = start_outcome_stream(spark, folder, batched, table, str(tmp_path / f"ckpt-{k}"), report=report)
        q.awaitTermination(300)
        assert q.exception() is None
        assert whole(table.read()) == want


def test_stream_scans_the_answered_batches_only(spark):
    from relayline.streaming.outcomes import answered
    f = Fixtures(spark, SF, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS)
    some = f.responses().where("plataforma = 'meta'").limit(1)
    plan = answered(f.batched_sends(), some)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(batch_id" in plan and "EqualTo(plataforma,meta)" in plan
    assert answered(f.batched_sends(), some.limit(0)).count() == 0
