"""Partitioned and bucketed layouts, change-feed algebra, compaction, mergeable
counts and sketches, and as-of reports."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from relayline.operators import colocated, distincts, feed
from relayline.operators import control as ctl
from relayline.operators import reconcile as rec
from relayline.operators.compaction import Compaction, file_groups, files_of
from relayline.operators.eligibility import candidates, eligible
from relayline.plans.catalog import AS_OF, GRACE_DAYS, LEAD_ROLLUPS, QUERIES
from relayline.schemas import CONTROL, CONTROL_COLUMNS, KEY
from relayline.sources.layout import DAY
from relayline.sources.store import Fixtures

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*CONTROL_COLUMNS).collect())


@pytest.fixture
def static_sort_merge(spark):
    """Plans as for tables too large to broadcast."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("false", "-1")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


# ------------------------------------------------------------- gold by day

def partition_filters(plan):
    return [line.split("PartitionFilters: [", 1)[1].split("], PushedFilters", 1)[0]
            for line in plan.splitlines() if "PartitionFilters: [" in line]


def test_windows_prune_days(spark):
    f = Fixtures(spark, SF)
    gold = f.gold_by_day()
    found = [x for x in partition_filters(plan_of(eligible(gold, f.control(), AS_OF, day=DAY))) if x]
    assert len(found) == 1
    for day in ("2024-02-06", "2024-04-02", "2024-01-10"):  # 63, 7 and 90 days before
        assert day in found[0]
    kept = candidates(gold, AS_OF, day=DAY).where("plataforma = 'meta'")
    assert kept.select(F.min("data_hora_conversao")).first()[0] >= dt.datetime(2024, 4, 2)


def test_window_opens_its_folders_only(spark, tmp_path):
    """A day outside the window is not even readable here."""
    from relayline.sources.layout import read_by_day, write_by_day
    from relayline.schemas import GOLD
    f = Fixtures(spark, SF)
    write_by_day(f.gold(), str(tmp_path / "g"))
    gold = read_by_day(spark, str(tmp_path / "g"), GOLD)
    want = candidates(f.gold(), "2024-06-25 00:00:00").count()
    old = [d for d in os.listdir(tmp_path / "g") if d.startswith("dia=") and d < "dia=2024-03-27"]
    assert old and want
    for d in old:
        for name in os.listdir(tmp_path / "g" / d):
            if name.endswith(".parquet"):
                (tmp_path / "g" / d / name).write_bytes(b"not parquet")
    assert candidates(gold, "2024-06-25 00:00:00", day=DAY).count() == want
    with pytest.raises(Exception):
        candidates(gold, "2024-06-25 00:00:00").count()


def test_open_sends_prune_gold_at_run_time(spark):
    f = Fixtures(spark, SF)
    df = rec.open_sends(f.control(), f.gold_by_day(), AS_OF, GRACE_DAYS, DAY)
    assert "dynamicpruning" in plan_of(df)


def test_future_guard_with_days(spark):
    f = Fixtures(spark, SF)
    a = eligible(f.gold(), f.control(), AS_OF, future_guard=True)
    b = eligible(f.gold_by_day(), f.control(), AS_OF, future_guard=True, day=DAY)
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


# ------------------------------------------------------- co-located tables

def shuffled(plan):
    """Scans under an exchange."""
    lines, out = plan.splitlines(), []
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    for i, line in enumerate(lines):
        if "Exchange " in line:
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                if "FileScan" in lines[j]:
                    out.append(lines[j])
    return out


def test_colocated_tables_are_not_shuffled(spark, static_sort_merge):
    f = Fixtures(spark, SF)
    gold, control = f.gold_colocated(), f.control_colocated()
    plan = plan_of(colocated.eligible(gold, control, AS_OF))
    assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
    plan = plan_of(colocated.upsert(control, f.send_results(), AS_OF))
    assert plan.count("Bucketed: true") == 2
    assert shuffled(plan) and not any("Bucketed: true" in x for x in shuffled(plan))
    assert shuffled(plan_of(eligible(f.gold(), f.control(), AS_OF)))  # what it saves


def test_colocated_equals_plain(spark):
    f = Fixtures(spark, SF)
    for kw in ({}, {"windowed": False}, {"block_dead_letter": True}, {"carry": True}):
        a = eligible(f.gold(), f.control(), AS_OF, **kw)
        b = colocated.eligible(f.gold_colocated(), f.control_colocated(), AS_OF, **kw)
        assert sorted(a.columns) == sorted(b.columns)
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(*a.columns).collect()))


def test_colocated_upsert_of_odd_rows(spark):
    f = Fixtures(spark, SF)
    base = f.control().limit(40).collect()
    target = spark.createDataFrame(base + base[:3], CONTROL)  # repeated target keys
    batch = f.send_results().limit(30)
    batch = batch.unionByName(batch.limit(5))  # repeated batch keys
    assert rows_of(colocated.upsert(target, batch, AS_OF)) == rows_of(ctl.upsert(target, batch, AS_OF))
    empty = target.limit(0)
    assert rows_of(colocated.upsert(empty, batch, AS_OF)) == rows_of(ctl.upsert(empty, batch, AS_OF))
    with pytest.raises(Exception, match="NULL key"):
        colocated.upsert(target, batch.withColumn("lead_id", F.lit(None).cast("string")), AS_OF).collect()


# ------------------------------------------------------------------- feeds

NULLABLE = CONTROL.simpleString()


def versions(spark, seed):
    """Three versions of a table with repeated rows and null keys."""
    r = random.Random(seed)
    t = dt.datetime(2024, 1, 1)

    def row():
        lead = r.choice(["a", "b", "c", None])
        return (lead, r.choice(["MQL", None]), r.choice(["meta", "bing"]), t, None, None, "x", r.choice(["aceito", "erro"]),
                r.choice([200, None]), None, None, r.randrange(3), None, t, None, None, t)
    base = [row() for _ in range(20)]
    out = []
    for _ in range(3):
        base = [x for x in base if r.random() < 0.6] + [row() for _ in range(8)]
        base += r.choices(base, k=6)
        out.append(spark.createDataFrame(base, NULLABLE))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_feed_algebra(spark, seed):
    a, b, c = versions(spark, seed)
    ab, bc = ctl.changes(a, b), ctl.changes(b, c)
    assert rows_of(feed.apply(a, ab)) == rows_of(b)
    assert rows_of(feed.apply(b, feed.invert(ab))) == rows_of(a)
    assert rows_of(feed.apply(a, feed.compose(ab, bc))) == rows_of(c)

    def full(df):
        return Counter(tuple(r) for r in df.select(*CONTROL_COLUMNS, "_change_type").collect())
    assert full(feed.compose(ab, bc)) == full(ctl.changes(a, c))
    assert full(feed.invert(ab)) == full(ctl.changes(b, a))
    assert full(feed.compose(ab, feed.invert(ab))) == Counter()
    nothing = ab.limit(0)
    assert full(feed.compose(ab, nothing)) == full(ab) == full(feed.compose(nothing, ab))


def test_feed_that_does_not_fit_fails(spark):
    a, b, c = versions(spark, 9)
    with pytest.raises(Exception, match="takes a row"):
        feed.apply(a.limit(0), ctl.changes(b, c)).collect()
    with pytest.raises(Exception, match="unknown change"):
        feed.apply(a, ctl.changes(a, b).withColumn("_change_type", F.lit("moved"))).collect()


def test_merge_feed_equals_changes(spark):
    f = Fixtures(spark, SF)
    base = f.control().limit(60).collect()
    target = spark.createDataFrame(base + base[:4], CONTROL)
    batch = f.send_results().limit(50).unionByName(
        target.limit(9).selectExpr(*KEY, "data_hora_conversao", "campaign_id", "valor_enviado", "identificador_usado",
                                   "status_envio", "http_status", "codigo_erro", "mensagem_resposta", "ts_ultimo_envio AS ts_envio"))

    def full(df):
        return Counter(tuple(r) for r in df.select(*CONTROL_COLUMNS, "_change_type").collect())
    want = full(ctl.changes(target, ctl.upsert(target, batch, AS_OF)))
    assert full(feed.merge_feed(target, batch, AS_OF)) == want and {k[-1] for k in want} >= {"insert", "update_postimage"}


# -------------------------------------------------------------- compaction

def fragments(spark, root, batches=6):
    for k in range(batches):
        part = spark.range(k * 100, k * 100 + 100).selectExpr("id", "cast(id % 3 as int) AS p", "repeat(cast(id as string), 5) AS v")
        part.repartition(2).write.mode("append").partitionBy("p").parquet(root)
    spark.range(5000, 60000, 1, 1).selectExpr("id", "0 AS p", "uuid() AS v").write.mode("append").partitionBy("p").parquet(root)


def table_files(root):
    return {os.path.join(d, x) for d, _, names in os.walk(root) for x in names if x.endswith(".parquet")}


def test_compaction_rewrites_fragments_only(spark, tmp_path):
    root, staging = str(tmp_path / "t"), str(tmp_path / "s")
    fragments(spark, root)
    before = spark.read.parquet(root)
    want = Counter(map(tuple, before.select("id", "p", "v").collect()))
    files, target = table_files(root), 6000
    large = {x for x in files if os.path.getsize(x) >= target}
    groups = file_groups(files_of(spark, root), ["dir"], "path", "bytes", target).where("arquivos > 1").select("dir", "grupo").distinct().count()
    job = Compaction(spark, root, staging)
    replaced = job.run(target)
    after = table_files(root)
    assert large and large <= after
    assert len(after) == len(files) - replaced + groups and len(after & files) == len(files) - replaced
    assert Counter(map(tuple, spark.read.parquet(root).select("id", "p", "v").collect())) == want
    assert job.finish()


def test_lost_compaction_is_finished(spark, tmp_path, monkeypatch):
    root, staging = str(tmp_path / "t"), str(tmp_path / "s")
    fragments(spark, root, 3)
    want = Counter(map(tuple, spark.read.parquet(root).select("id", "p", "v").collect()))
    job = Compaction(spark, root, staging)
    real, calls = Compaction.finish, []

    def once(self):
        calls.append(1)
        return True if len(calls) < 3 and len(calls) != 1 else real(self)
    monkeypatch.setattr(Compaction, "finish", once)
    job.run(6000)  # the journal is written, nothing is moved
    monkeypatch.setattr(Compaction, "finish", real)
    assert Counter(map(tuple, spark.read.parquet(root).select("id", "p", "v").collect())) == want
    assert Compaction(spark, root, staging).finish()
    assert Counter(map(tuple, spark.read.parquet(root).select("id", "p", "v").collect())) == want
    assert Compaction(spark, root, staging).run(1) == 0  # nothing is smaller than a byte


def test_groups_hold_less_than_two_targets(spark):
    r = random.Random(1)
    files = spark.createDataFrame([(f"d{k % 3}", f"f{k}", r.randrange(1, 120)) for k in range(300)], "dir string, path string, bytes long")
    got = file_groups(files, ["dir"], "path", "bytes", 100).collect()
    assert len(got) == files.where("bytes < 100").count()
    total = Counter()
    for x in got:
        total[x.dir, x.grupo] += x.bytes
    assert all(total[x.dir, x.grupo] == x.total < 200 for x in got)
    last = {d: max(g for e, g in total if e == d) for d, _ in total}
    assert all(n > 1 for (d, g), n in total.items() if g < last[d])


# ------------------------------------------------- mergeable distincts, sketches

def test_bitmaps_of_any_roll_up(spark):
    f = Fixtures(spark, SF)
    cand = candidates(f.gold(), windowed=False).unionByName(candidates(f.gold(), windowed=False))
    cand = cand.withColumn("lead_id", F.when(F.col("lead_id") != "lead_1", F.col("lead_id")))  # null leads count nowhere
    maps = distincts.lead_bitmaps(cand, slices=5).cache()
    got = {(r.plataforma, r.etapa_funil, r.dia, r.nivel): r.leads for r in distincts.distinct_leads(maps, LEAD_ROLLUPS).collect()}
    day = cand.withColumn("dia", F.to_date("data_hora_conversao"))
    for cols, level in ((["plataforma", "etapa_funil"], 1), (["plataforma"], 3), (["etapa_funil"], 5), (["dia"], 6), ([], 7)):
        for r in day.groupBy(*cols).agg(F.countDistinct("lead_id").alias("n")).collect():
            key = tuple(getattr(r, c) if c in cols else None for c in distincts.CELL)
            assert got[(*key, level)] == r.n
    maps.unpersist()


def test_bitmaps_read_gold_once(spark):
    f = Fixtures(spark, SF)
    plan = plan_of(distincts.distinct_leads(distincts.lead_bitmaps(candidates(f.gold(), windowed=False)), LEAD_ROLLUPS))
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1


def test_sketches_stay_within_their_bound(spark):
    """Rank error against exact ranks, on heavy ties and on merged days."""
    rows = spark.range(40_000).selectExpr(
        "'meta' AS plataforma", "timestamp_ntz'2024-01-01' AS data_hora_conversao",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(pmod(xxhash64(id), 30000) as int), 0) AS ts_primeiro_envio")
    rows = rows.unionByName(rows.limit(1000).withColumn("ts_primeiro_envio", F.lit(None).cast("timestamp_ntz")))
    sketches = rec.latency_sketches(rows)
    assert sketches.count() == 21
    got = rec.sketch_check(rows, rec.sketched_latency(sketches)).first()
    assert got.envios == 40_000 and got.p50_no_limite and got.p95_no_limite
    off = rec.sketched_latency(sketches).withColumn("latencia_p50_min", F.lit(20_000).cast("long"))
    assert not rec.sketch_check(rows, off).first().p50_no_limite


def test_totals_take_one_expand(spark, static_sort_merge):
    f = Fixtures(spark, SF)
    plan = plan_of(rec.business_totals(f.control(), f.gold()))
    assert plan.count("Expand ") == 1


# ------------------------------------------------------------ as-of reports

@pytest.mark.parametrize("slices", ["hour", "day", "month"])
def test_reports_as_of_equal_brute_force(spark, slices):
    r = random.Random(3)
    t0 = dt.datetime(2024, 3, 30)

    def when():
        return t0 + dt.timedelta(hours=r.randrange(0, 100, 5))
    reports = [("meta", r.choice(["hot"] * 8 + ["x", "y", None]), r.random() < 0.5, when()) for _ in range(300)]
    moments = [("meta", r.choice(["hot", "x", "z", None]), when(), k) for k in range(80)]
    df = spark.createDataFrame(moments + moments[:5], "plataforma string, event_id string, ts timestamp_ntz, own int")
    rep = spark.createDataFrame(reports, "plataforma string, event_id string, matched boolean, reported_at timestamp_ntz")
    got = Counter(tuple(x) for x in rec.reports_as_of(df, rep, slices).collect())
    want = Counter()
    for p, e, t, own in moments + moments[:5]:
        found = max(((at, m) for q, f, m, at in reports if (q, f) == (p, e) and e is not None and at <= t), default=(None, None))
        want[p, e, t, own, found[1], found[0]] += 1
    assert got == want


def test_correction_flips_the_next_run(spark):
    t = dt.datetime(2024, 4, 1)
    one = spark.createDataFrame([("a", "MQL", "meta", t, None, None, "x", "aceito", 200, None, None, 1, t, t, None, None, t)], CONTROL)
    reports = spark.createDataFrame([("meta", "a_MQL", True, t + dt.timedelta(days=1)), ("meta", "a_MQL", False, t + dt.timedelta(days=3))],
                                    "plataforma string, event_id string, matched boolean, reported_at timestamp_ntz")
    seen = []
    for day in (1, 2, 3, 4):
        as_of = str(t + dt.timedelta(days=day))
        seen.append(rec.reconcile(one, rec.valid_reports(reports, as_of), as_of).first().status_match)
    assert seen == ["casado", "casado", "nao_casado", "nao_casado"]


# ---------------------------------------------------------------- paths

def test_inputs_by_uri(spark):
    """A URI is read as it stands, and names the same tables as the plain path."""
    plain, uri = Fixtures(spark, SF), Fixtures(spark, "file://" + SF)
    assert plain.sf_dir == uri.sf_dir and plain._identity() == uri._identity()
    assert QUERIES["stage_counts"](spark, "file://" + SF).collect() == QUERIES["stage_counts"](spark, SF).collect()
    assert Fixtures(spark, "file:///somewhere/else/").sf_dir == "file:/somewhere/else"
