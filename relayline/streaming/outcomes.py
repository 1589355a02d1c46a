"""Send outcomes delivered as a stream into the control table.

Response files land in a folder as the sends complete; a Structured
Streaming query picks them up, and ``foreachBatch`` classifies each
micro-batch against the frozen request batches that it answers
(``responses.classify``), MERGEs the result into the control table and settles
it as the outcome job does (``plans.outcome.settle``: retry policy,
reconciliation).

Applied once: every micro-batch writes one control version tagged with its
stream and epoch; a version appears with its tag by one rename, and a retried
epoch finds the tag and is skipped, so ``tentativas`` is raised once. Source progress lives in the query's checkpoint
folder, which must sit on shared storage (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime
import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.responses import classify
from ..plans.outcome import settle
from ..schemas import RESPONSE
from ..sources.tables import BucketedControlTable, ControlTable


def stream_id(checkpoint: str) -> str:
    """One name per stream: epochs are numbered anew under each checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def answered(batched: DataFrame, responses: DataFrame) -> DataFrame:
    """The batched events between the first and last batch that a platform
    answers: bounds that reach the scan of the run's batches."""
    spans = responses.groupBy("plataforma").agg(F.min("batch_id").alias("a"), F.max("batch_id").alias("b")).where(
        "plataforma IS NOT NULL AND a IS NOT NULL").collect()  # a row per platform
    inside = [(F.col("plataforma") == r.plataforma) & F.col("batch_id").between(r.a, r.b) for r in spans]
    return batched.where(reduce(lambda x, y: x | y, inside, F.lit(False)))


def apply_outcomes(batched: DataFrame, control: ControlTable | BucketedControlTable, stream: str,
                   check_unique: bool = True, report: DataFrame | None = None, max_attempts: int = 3,
                   grace_days: int = 3):
    """The ``foreachBatch`` function: classify, upsert and settle once per
    epoch of ``stream``. Answers without a time are stamped with the batch's
    latest answer time, or the present when no answer has one. With a
    ``report`` every epoch reconciles the whole table."""

    def run(responses: DataFrame, epoch_id: int) -> None:
        tag = f"{stream}-epoch-{epoch_id}"
        if control.tagged(tag) is not None:
            return
        n, now = responses.agg(F.count(F.lit(1)), F.max("ts_resposta")).first()
        if n == 0:
            return
        now = now or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        results = classify(answered(batched, responses), responses, sent_at=now, answered_only=True)

        def then(merged: DataFrame) -> DataFrame:
            return settle(merged, now, report, max_attempts, grace_days)
        if isinstance(control, BucketedControlTable):
            control.upsert(results, now=now, tag=tag, then=then, everywhere=report is not None)
        else:
            control.upsert(results, now=now, check_unique=check_unique, tag=tag, then=then)

    return run


def start_outcome_stream(spark: SparkSession, responses_dir: str, batched: DataFrame,
                         control: ControlTable | BucketedControlTable, checkpoint: str, files_per_trigger: int | None = None,
                         available_now: bool = True, check_unique: bool = True, report: DataFrame | None = None,
                         max_attempts: int = 3, grace_days: int = 3) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what is there and stops."""
    reader = spark.readStream.schema(RESPONSE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    writer = (reader.parquet(responses_dir).writeStream
              .foreachBatch(apply_outcomes(batched, control, stream_id(checkpoint), check_unique, report,
                                           max_attempts, grace_days))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
