"""The daily send preparation as one job.

gold + latest control version -> eligible -> routed -> exact-cap batches ->
request bodies written as JSON text, one folder per platform (S16). The
frozen batches are written too, so the responses can later be classified
against exactly what was sent (``responses.classify``) and merged into the
control table (``ControlTable.upsert`` / ``BucketedControlTable.upsert``).

    python -m relayline.plans.daily --gold PATH --control ROOT --as-of "2024-04-09 00:00:00" --out DIR
"""

from __future__ import annotations

import argparse
import json
import re

from pyspark.sql import DataFrame, SparkSession

from ..operators.eligibility import eligible
from ..operators.envelopes import EnvelopeConfig, assign_batches, envelopes, write_envelopes
from ..operators.routing import route
from ..sources.tables import ControlTable


def prepare(gold: DataFrame, control: DataFrame, as_of, batch_size: int = 500, n_buckets: int | None = None,
            future_guard: bool = True, block_dead_letter: bool = False) -> DataFrame:
    """Batched, routed events ready to send (``future_guard`` drops events after ``as_of``)."""
    routed = route(eligible(gold, control, as_of, future_guard=future_guard,
                            block_dead_letter=block_dead_letter, carry=True))
    return assign_batches(routed, batch_size=batch_size, n_buckets=n_buckets, as_of=as_of,
                          future_guard=future_guard)


def run(spark: SparkSession, gold_path: str, control_root: str, as_of, out_dir: str,
        cfg: EnvelopeConfig | None = None, batch_size: int = 500, n_buckets: int | None = None,
        run_id: str | None = None) -> dict:
    """Write ``batches`` (Parquet) and ``envelopes`` (JSON text) under
    ``out_dir/run=<run_id>``. Batch numbers start anew in every run, so answers
    belong to a run's folder; a run that exists already is refused. ``run_id``
    is the reference time by default."""
    run_id = run_id or re.sub("[^0-9A-Za-z]+", "-", str(as_of))
    out_dir = f"{out_dir}/run={run_id}"
    gold = spark.read.parquet(gold_path)
    control = ControlTable(spark, control_root).read()
    batches = prepare(gold, control, as_of, batch_size, n_buckets)
    batches.write.mode("errorifexists").parquet(f"{out_dir}/batches")
    frozen = spark.read.parquet(f"{out_dir}/batches")  # envelopes come from exactly what was written
    write_envelopes(envelopes(frozen, cfg), f"{out_dir}/envelopes")
    return {"run_id": run_id, "batches": f"{out_dir}/batches", "envelopes": f"{out_dir}/envelopes"}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--gold", required=True)
    ap.add_argument("--control", required=True, help="root of the control table snapshots")
    ap.add_argument("--as-of", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--batch-size", type=int, default=500)
    ap.add_argument("--buckets", type=int, default=None, help="slices ranked apart; changes no batch")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--config", default=None, help="JSON with EnvelopeConfig fields (no secrets)")
    a = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session(app="relayline-daily")
    cfg = EnvelopeConfig(**json.loads(open(a.config).read())) if a.config else None
    print(json.dumps(run(spark, a.gold, a.control, a.as_of, a.out, cfg, a.batch_size, a.buckets, a.run_id)))


if __name__ == "__main__":
    main()
