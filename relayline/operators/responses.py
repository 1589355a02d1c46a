"""Response ingestion and classification.

Input: the batched events (``envelopes.assign_batches``) and one response
row per (plataforma, batch_id). Output: one send result per event, the
MERGE source of ``control.upsert``.

* Meta: HTTP 200 and ``events_received`` equal to the batch size -> all
  accepted, otherwise every event of the batch is an error.
* Bing: HTTP 200 is "batch processed"; each ``PartialErrors`` entry marks the
  event at ``Index`` (0-based position) as an error, the rest are accepted.
* Google: any 2xx accepts the batch.
* A batch without a response is an error for all its events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import ts_lit
from ..schemas import BING_RESPONSE, META_RESPONSE, SEND_RESULT


def batch_verdicts(responses: DataFrame) -> DataFrame:
    """One row per answered batch (the latest answer if there are several):
    HTTP status, raw body, Meta's ``events_received`` and Bing's per-record
    errors as an array, bounded by the request size.
    """
    latest = (responses.groupBy("plataforma", "batch_id")
              .agg(F.max_by(F.struct("http_status", "body", "ts_resposta"),
                            F.struct("ts_resposta", "http_status", "body")).alias("_r"))
              .select("plataforma", "batch_id", "_r.*"))
    p, http = F.col("plataforma"), F.col("http_status")
    bing_errors = F.filter(F.from_json("body", BING_RESPONSE)["PartialErrors"],
                           lambda e: e.isNotNull() & e["Index"].isNotNull())
    return latest.select(
        "plataforma", "batch_id", "http_status", "ts_resposta", F.col("body").alias("raw_body"),
        F.when(p == "meta", F.from_json("body", META_RESPONSE)["events_received"]).alias("events_received"),
        F.when((p == "bing") & (http == 200), bing_errors).alias("record_errors"))


def classify(batched: DataFrame, responses: DataFrame, sent_at=None, answered_only: bool = False) -> DataFrame:
    """Send results (SEND_RESULT schema) for every batched event.

    One join of events with batch verdicts on (plataforma, batch_id); a Bing
    event's own error is looked up by position in its batch's error array.
    ``sent_at`` stamps events whose batch got no response; with
    ``answered_only`` events of unanswered batches are left out (a streamed
    micro-batch holds some answers, not all).
    """
    v = batch_verdicts(responses)
    j = batched.join(v, ["plataforma", "batch_id"], "inner" if answered_only else "left")
    p, http = F.col("plataforma"), F.col("http_status")
    answered = F.col("ts_resposta").isNotNull() | http.isNotNull() | F.col("raw_body").isNotNull()
    batch_ok = (F.when(p == "meta", (http == 200) & (F.col("events_received") == F.col("batch_events")))
                 .when(p == "bing", http == 200)
                 .when(p == "google", http.between(200, 299))
                 .otherwise(F.lit(False)))
    batch_ok = F.coalesce(batch_ok, F.lit(False))
    own = F.get(F.filter(F.col("record_errors"), lambda e: e["Index"] == F.col("position")), 0)
    batch_error = (F.when((p == "meta") & (http == 200), F.lit("EVENTS_RECEIVED_MISMATCH"))
                    .otherwise(F.concat(F.lit("HTTP_"), F.coalesce(http.cast("string"), F.lit("NULL")))))
    accepted = answered & batch_ok & own.isNull()
    code = (F.when(~answered, F.lit("NO_RESPONSE"))
             .when(~batch_ok, batch_error)
             .when(own.isNotNull(), own["ErrorCode"]))
    message = F.when(own.isNotNull(), own["Message"]).otherwise(F.col("raw_body"))
    stamp = ts_lit(sent_at) if sent_at is not None else F.lit(None).cast("timestamp_ntz")
    out = j.select(
        "lead_id", "etapa_funil", "plataforma", "data_hora_conversao", "campaign_id",
        F.col("vl_faturamento_estimado").alias("valor_enviado"),
        "identificador_usado",
        F.when(accepted, F.lit("aceito")).otherwise(F.lit("erro")).alias("status_envio"),
        http.alias("http_status"),
        code.alias("codigo_erro"),
        message.alias("mensagem_resposta"),
        F.coalesce(F.col("ts_resposta"), stamp).alias("ts_envio"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SEND_RESULT.fields])
