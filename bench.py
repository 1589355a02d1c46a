"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is run once to warm up, then timed
$BENCH_RUNS times (median reported); results go to Spark's ``noop`` sink, so
the whole plan executes but nothing is shipped to Python. The one-off write
of the derived fixture tables is timed separately ("fixtures_sec"); when an
earlier run left identical tables under spark.checkpoint.dir they are reused
and "fixtures_reused" says so.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "candidates_windowed", "eligible", "eligible_by_platform", "routed", "routed_quality_counts",
    "routed_duplicate_gold", "pii_hashes", "payload_json", "envelopes", "control_upsert",
    "control_upsert_twice", "control_changes", "eligible_after_upsert", "responses_classified",
    "reconciled", "business_cuts", "audit_hash_summary", "audit_score", "audit_stage_order",
    "identifier_coverage", "control_after_responses", "control_summary", "document_contacts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from relayline.session import build_session
    spark = build_session(f"local[{cpus}]", app="relayline-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="relayline-bench-"))

    from relayline.plans.catalog import AS_OF, BATCH_SIZE, FROZEN_AT, N_BUCKETS, QUERIES
    from relayline.sources.store import Fixtures

    from relayline.sources.store import _exists

    t0 = time.time()
    f = Fixtures(spark, sf_dir, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS, frozen_at=FROZEN_AT)
    reused = _exists(spark, f"{f._root()}/gold/_SUCCESS")
    for table in ("gold", "gold_with_duplicates", "raw", "manifest", "control", "send_results",
                  "platform_report", "responses"):
        getattr(f, table)()
    fixtures_sec = time.time() - t0

    timings = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.time() - t)
        timings[name] = round(statistics.median(samples), 3)

    from relayline.operators.eligibility import eligible
    from relayline.operators.quality import routed_quality_counts
    from relayline.operators.routing import route

    lazy = Fixtures(spark, sf_dir, materialize=False, as_of=AS_OF)
    t = time.time()
    routed_quality_counts(route(eligible(lazy.gold(), lazy.control(), AS_OF, carry=True))).collect()
    end_to_end = time.time() - t

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "end_to_end_sec": round(end_to_end, 3),
        "fixtures_sec": round(fixtures_sec, 3),
        "fixtures_reused": reused,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "sink": "noop",
        "spark": spark.version,
        "machine": {"cpus_visible": os.cpu_count(), "platform": platform.platform(),
                    "python": platform.python_version()},
        "settings": {k: spark.conf.get(k) for k in (
            "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
            "spark.sql.adaptive.skewJoin.enabled", "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.files.maxPartitionBytes", "spark.driver.memory")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
