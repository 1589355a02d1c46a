"""What is shuffled and written per row: narrow rows, each once (FINDINGS_r03)."""

import re
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from relayline.operators import control as ctl
from relayline.operators.eligibility import eligible
from relayline.operators.envelopes import assign_batches
from relayline.operators.routing import route, route_by_join
from relayline.plans.catalog import AS_OF, QUERIES
from relayline.sources import fixtures as fx
from relayline.sources import store
from relayline.sources.layout import read_by_day, write_by_day
from relayline.schemas import GOLD
from relayline.sources.store import Fixtures

SF = "/root/testdata/sf0.001"


@pytest.fixture
def static_sort_merge(spark):
    """Plans as for tables too large to broadcast."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("false", "-1")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffled_columns(df):
    """The input columns of every exchange."""
    nodes = re.split(r"\n\n+", formatted(df))
    return [re.search(r"Input \[\d+\]: \[(.*?)\]", n).group(1) for n in nodes if re.match(r"\(\d+\) Exchange", n)]


def lineitem(spark):
    return fx.table(spark, SF, "lineitem")


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_gold_is_sorted_before_its_texts_are_made(spark, static_sort_merge):
    """F1, F9"""
    laid = fx.gold(lineitem(spark), laid=True)
    found = shuffled_columns(laid)
    assert len(found) == 1 and "email" not in found[0] and "lead_id" not in found[0]
    assert rows(laid) == rows(fx.gold(lineitem(spark)))


def test_gold_keys_are_unique_without_line_numbers(spark):
    """a line without number falls into a stage before lines are grouped."""
    li = spark.createDataFrame([(1, 4, 7, "1995-02-01 00:00:00", 10.0), (1, None, 8, "1995-03-01 00:00:00", 5.0),
                                (2, None, 9, None, None)],
                               "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate string, l_extendedprice double")
    for laid in (False, True):
        keys = fx.gold(li, laid=laid).groupBy("lead_id", "etapa_funil").count()
        assert keys.where("count > 1").count() == 0


def test_send_results_shuffle_no_hashes(spark, static_sort_merge):
    """F1, F3, F9"""
    f = Fixtures(spark, SF)
    found = shuffled_columns(fx.send_results(f.gold(), f.control(), AS_OF))
    assert found and not any("hashed" in x or "clid" in x for x in found)


def test_gold_by_day_deals_out_narrow_rows(spark, tmp_path):
    """F2"""
    g = fx.gold(lineitem(spark))
    write_by_day(g, str(tmp_path / "a"))
    write_by_day(fx.gold_core(g), str(tmp_path / "b"), whole=fx.gold_columns)
    assert rows(read_by_day(spark, str(tmp_path / "a"), GOLD)) == rows(read_by_day(spark, str(tmp_path / "b"), GOLD))


def test_summary_moves_no_column_of_the_batch(spark, static_sort_merge):
    """only keys, flags and attempts."""
    f = Fixtures(spark, SF)
    found = shuffled_columns(ctl.summary(ctl.upsert(f.control(), f.send_results(), AS_OF)))
    assert found and not any("_r" in x or "max" in x and "struct" in x for x in found)


def test_upsert_moves_each_batch_row_once(spark, static_sort_merge):
    """one struct per key, not a row and its order."""
    f = Fixtures(spark, SF)
    assert "max_by" not in formatted(ctl.upsert(f.control(), f.send_results(), AS_OF))


def test_duplicate_gold_is_dealt_out_narrow(spark):
    """F4, F7"""
    laid = fx.gold_with_duplicates(lineitem(spark), laid=True)
    found = shuffled_columns(laid)
    assert len(found) == 1 and "email" not in found[0]
    assert rows(laid) == rows(fx.gold_with_duplicates(lineitem(spark)))


def test_batches_are_not_dealt_out_again_for_their_slices(spark, static_sort_merge):
    """the join with the slices' counts broadcasts them, at any number of slices."""
    f = Fixtures(spark, SF)
    routed = QUERIES["routed"](spark, SF)
    plan = formatted(assign_batches(routed, 50, n_buckets=4000, as_of=AS_OF))
    assert "BroadcastHashJoin" in plan
    assert rows(assign_batches(routed, 50, n_buckets=4000, as_of=AS_OF)) == rows(
        assign_batches(routed, 50, n_buckets=3, as_of=AS_OF))
    assert f.batched_sends().count() > 0


def test_answered_sends_are_batched_once(spark):
    """the batches that were answered are read, not made anew."""
    for name in ("control_after_responses", "responses_classified", "answers_classified"):
        assert "Window" not in formatted(QUERIES[name](spark, SF)), name


def test_composed_feed_reads_written_feeds(spark):
    """F8: neither the versions nor the feeds between them are made again."""
    plan = formatted(QUERIES["control_feed_composed"](spark, SF))
    assert "/feed_upserted]" in plan and "/feed_cleaned]" in plan and "Join LeftOuter" not in plan
    assert "max(_r" not in plan and "max_by" not in plan


def test_copies_collapse_before_ids_and_hashes_are_made(spark, static_sort_merge):
    """F10"""
    plan = formatted(assign_batches(QUERIES["routed"](spark, SF), 50, n_buckets=8, as_of=AS_OF))
    keys = [x for x in re.findall(r"Keys \[\d+\]: \[(.*?)\]", plan) if "email_hashed" in x]
    assert keys and not any("event_id" in x or "_h#" in x for x in keys)


def test_buckets_grow_with_the_input(spark, tmp_path, monkeypatch):
    """F11"""
    small = Fixtures(spark, SF)
    assert small._buckets() == store.LEAST_BUCKETS
    shutil.copy(f"{SF}/lineitem.parquet", tmp_path / "lineitem.parquet")
    size = (tmp_path / "lineitem.parquet").stat().st_size
    monkeypatch.setattr(store, "INPUT_PER_BUCKET", size // 40)
    f = Fixtures(spark, str(tmp_path))
    assert 40 <= f._buckets() <= 42
    got = f.gold_colocated()
    assert len({x.rsplit("_", 1)[-1].split(".")[0] for x in got.inputFiles()}) > store.LEAST_BUCKETS
    assert rows(got) == rows(f.gold().select(*got.columns))


@pytest.mark.parametrize("name", ["routed_duplicate_gold", "routed_by_join", "routed"])
def test_routing_joins_move_no_hashes(spark, static_sort_merge, name):
    """gold's texts are made after the joins."""
    found = shuffled_columns(QUERIES[name](spark, SF))
    assert found and not any("hashed" in x or "clid" in x or "campaign" in x for x in found)


def test_duplicate_gold_is_not_written(spark):
    """no second copy of the lines; repeated keys, null keys and null values included."""
    assert all(x.endswith("/lineitem.parquet") for x in Fixtures(spark, SF).gold_with_duplicates().inputFiles())


def test_routing_from_narrow_rows_gives_gold_s_rows(spark):
    """as when the joins carry gold whole, on repeated and null keys too."""
    lines = [(k, n, 7 + i, day, price) for i, (k, n, day, price) in enumerate(
        [(k, n, "1995-04-05 00:00:00", 10.0 * k) for k in range(1, 40) for n in (1, 2)]
        + [(22, 1, "1995-04-06 00:00:00", 5.0), (22, 1, "1995-04-06 00:00:00", 5.0), (22, 5, "1995-04-07 00:00:00", None),
           (None, 1, "1995-04-05 00:00:00", 1.0), (25, None, "1995-04-05 00:00:00", 1.0), (26, 1, None, 1.0)])]
    li = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate string, l_extendedprice double")
    g = fx.gold_with_duplicates(li)
    control = fx.control(fx.gold(li))
    want = rows(route(eligible(g, control, AS_OF, carry=True)))
    assert max(want.values()) == 1 < len(want) and rows(fx.routed(g, control, AS_OF)) == want
    want = rows(route_by_join(eligible(g, control, AS_OF), g))
    assert max(want.values()) > 1 and rows(fx.routed_by_join(g, control, AS_OF)) == want


def test_bodies_are_packed_from_rows_made_once(spark, static_sort_merge):
    """FINDINGS_r04 F1: gold and control are read once, for functions and rows alike, and batches ranked once."""
    text = formatted(QUERIES["envelope_byte_bodies"](spark, SF))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2
    by_batch = [x for x in shuffled_columns(QUERIES["envelope_byte_bodies"](spark, SF)) if "position" in x]
    assert len(by_batch) == 1 and "hashed" not in by_batch[0]


def test_batches_are_counted_from_the_ranked_rows(spark, static_sort_merge):
    """FINDINGS_r04 F1"""
    f = Fixtures(spark, SF)
    text = formatted(assign_batches(fx.routed(f.gold(), f.control(), AS_OF), batch_size=50, as_of=AS_OF))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) SortMergeJoin", text, re.M)) == 1
