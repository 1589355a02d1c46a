"""Physical-plan properties: pushdown, pruning, no Python in the hot path."""


from relayline.operators.control import upsert
from relayline.operators.eligibility import candidates, eligible
from relayline.plans.catalog import QUERIES
from relayline.sources.store import Fixtures

SF = "/root/testdata/sf0.001"
AS_OF = "2024-04-09 00:00:00"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_candidates_push_filter_and_prune_columns(spark):
    gold = Fixtures(spark, SF).gold()
    plan = _plan(candidates(gold, AS_OF))
    assert "PushedFilters: [Or(" in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1  # one scan, not one per platform
    [schema] = [line for line in _formatted(candidates(gold, AS_OF)).splitlines() if line.startswith("ReadSchema")]
    for col in ("lead_id", "etapa_funil", "data_hora_conversao", "gclid", "fbclid", "msclkid", "origem_midia"):
        assert col in schema
    for col in ("email_hashed", "phone_hashed", "vl_faturamento_estimado", "campaign_id", "produto"):
        assert col not in schema


def test_union_variant_scans_three_times(spark):
    gold = Fixtures(spark, SF).gold()
    plan = _plan(candidates(gold, AS_OF, one_scan=False))
    assert len([line for line in plan.splitlines() if "FileScan parquet" in line]) == 3


def test_accepted_filter_reaches_control_scan(spark):
    f = Fixtures(spark, SF)
    plan = _plan(eligible(f.gold(), f.control(), AS_OF))
    assert "EqualTo(status_envio,aceito)" in plan


def test_point_lookup_pushed(spark):
    plan = _plan(QUERIES["eligible_one_lead"](spark, SF))
    assert "EqualTo(lead_id,lead_22)" in plan


def test_no_python_udfs_or_cross_joins_anywhere(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF))
        assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_batching_window_never_spans_a_platform(spark):
    text = _formatted(QUERIES["envelope_batches"](spark, SF))
    specs = [line for line in text.splitlines() if line.startswith("Arguments:") and "windowspecdefinition" in line]
    assert specs and all("bucket" in line for line in specs)


def test_upsert_shuffles_twice(spark):
    """One shuffle of batch rows and target keys together, one of the target;
    the second use of the first is a reused exchange."""
    f = Fixtures(spark, SF)
    target, batch = f.control(), f.send_results()
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(upsert(target, batch, AS_OF))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lines = plan.splitlines()
    assert len([x for x in lines if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]) <= 3
