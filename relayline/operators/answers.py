"""Answers of unknown shape (E14, M4b): bodies read as VARIANT.

``responses.classify`` reads bodies by a fixed schema, where a body that is cut
off or has another type gives nulls. Here every body is parsed as it is, what
does not parse or breaks the expected types goes to a quarantine with the
reason, and errors of single records are read from Bing's ``PartialErrors`` and
from Google's ``error.details[].fieldViolations[]``, whose ``field`` names the
event by position (``events[3].…``).

Reasons: ``vazio`` (no body), ``nao_json`` (does not parse), ``campo`` (no
object, or an expected field is absent or of another type). Expected are, with
HTTP 200, Meta's integer ``events_received`` and Bing's array ``PartialErrors``;
from Google an object, with an object ``error`` unless the status is 2xx.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import ts_lit
from ..schemas import SEND_RESULT

FIELD_POSITION = r"events\[([0-9]{1,9})\]"
ERROR = "array<struct<Index:int,ErrorCode:string,Message:string>>"


def _list(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _object(value: Column, path: str = "$") -> Column:
    """Whether there is an object at the path."""
    return F.coalesce(F.schema_of_variant(F.try_variant_get(value, path, "variant")).startswith("OBJECT"), F.lit(False))


def read(responses: DataFrame) -> DataFrame:
    """One row per answered batch (the latest answer if there are several):
    status, raw body, ``motivo`` (why the body cannot be used, else null),
    Meta's ``events_received``, and ``record_errors`` with position, code and
    message (empty if none; entries without a position have a null ``Index``)."""
    latest = (responses.groupBy("plataforma", "batch_id")
              .agg(F.max_by(F.struct("http_status", "body", "ts_resposta"),
                            F.struct("ts_resposta", "http_status", "body")).alias("_r"))
              .select("plataforma", "batch_id", "_r.*"))
    parsed = latest.withColumn("_v", F.try_parse_json("body"))
    p, http, v = F.col("plataforma"), F.col("http_status"), F.col("_v")
    received = F.try_variant_get(v, "$.events_received", "int")
    partial, details = _list(v, "$.PartialErrors"), _list(v, "$.error.details")
    expected = (F.when((p == "meta") & (http == 200), received.isNotNull())
                 .when((p == "bing") & (http == 200), partial.isNotNull())
                 .when((p == "google") & ~http.between(200, 299), _object(v, "$.error"))
                 .otherwise(F.lit(True)))
    reason = (F.when(F.col("body").isNull() | (F.trim("body") == ""), "vazio")
               .when(v.isNull(), "nao_json")
               .when(~_object(v) | ~F.coalesce(expected, F.lit(True)), "campo"))
    bing = F.transform(F.filter(partial, lambda e: ~F.is_variant_null(e)), lambda e: F.struct(
        F.try_variant_get(e, "$.Index", "int").alias("Index"), _text(e, "$.ErrorCode").alias("ErrorCode"),
        _text(e, "$.Message").alias("Message")))
    # details hold entries of several kinds; those without violations add none
    violations = F.flatten(F.transform(details, lambda d: F.coalesce(
        _list(d, "$.fieldViolations"), F.array().cast("array<variant>"))))
    google = F.transform(violations, lambda e: F.struct(
        F.nullif(F.regexp_extract(_text(e, "$.field"), FIELD_POSITION, 1), F.lit("")).cast("int").alias("Index"),
        _text(e, "$.reason").alias("ErrorCode"), _text(e, "$.description").alias("Message")))
    errors = F.when((p == "bing") & (http == 200), bing.cast(ERROR)).when(p == "google", google.cast(ERROR))
    return parsed.select(
        "plataforma", "batch_id", "http_status", "ts_resposta", F.col("body").alias("raw_body"), reason.alias("motivo"),
        F.when(p == "meta", received).alias("events_received"),
        F.when(reason.isNull(), F.coalesce(errors, F.array().cast(ERROR))).otherwise(F.array().cast(ERROR)).alias("record_errors"))


def quarantine(answers: DataFrame) -> DataFrame:
    """Answers whose body cannot be used, whole, with the reason. None is lost:
    they and the others are all answers."""
    return answers.where("motivo IS NOT NULL").select(
        "plataforma", "batch_id", "http_status", "motivo", "raw_body", "ts_resposta")


def record_errors(answers: DataFrame) -> DataFrame:
    """One row per error of a single record; ``posicao`` is null where the
    answer names none."""
    return answers.select("plataforma", "batch_id", F.explode("record_errors").alias("e")).select(
        "plataforma", "batch_id", F.col("e.Index").alias("posicao"), F.col("e.ErrorCode").alias("codigo_erro"),
        F.col("e.Message").alias("mensagem"))


def classify(batched: DataFrame, answers: DataFrame, sent_at=None) -> DataFrame:
    """Send results (SEND_RESULT schema) for every batched event from ``read``.

    An HTTP error is the batch's; a body in quarantine under a good status
    (``BODY_`` and the reason) accepts nothing, as nobody has read what became
    of the records. A record named by position has its own code, under a good
    status and in a refused request alike. Several errors of a record: the
    first in the answer. Batches without answer: ``NO_RESPONSE``.
    """
    j = batched.join(answers, ["plataforma", "batch_id"], "left")
    p, http, reason = F.col("plataforma"), F.col("http_status"), F.col("motivo")
    answered = F.col("record_errors").isNotNull()
    good = F.when(p == "google", http.between(200, 299)).when(p.isin("meta", "bing"), http == 200)
    good = F.coalesce(good, F.lit(False))
    own = F.get(F.filter("record_errors", lambda e: e["Index"] == F.col("position")), 0)
    whole = (p != "meta") | (F.col("events_received") == F.col("batch_events"))
    code = (F.when(~answered, "NO_RESPONSE")
             .when(own.isNotNull(), F.coalesce(own["ErrorCode"], F.lit("RECORD_ERROR")))
             .when(~good, F.concat(F.lit("HTTP_"), F.coalesce(http.cast("string"), F.lit("NULL"))))
             .when(reason.isNotNull(), F.concat(F.lit("BODY_"), F.upper(reason)))
             .when(~whole, "EVENTS_RECEIVED_MISMATCH"))
    stamp = ts_lit(sent_at) if sent_at is not None else F.lit(None).cast("timestamp_ntz")
    out = j.select(
        "lead_id", "etapa_funil", "plataforma", "data_hora_conversao", "campaign_id",
        F.col("vl_faturamento_estimado").alias("valor_enviado"), "identificador_usado",
        F.when(code.isNull(), "aceito").otherwise("erro").alias("status_envio"),
        "http_status", code.alias("codigo_erro"),
        F.when(own.isNotNull(), own["Message"]).otherwise(F.col("raw_body")).alias("mensagem_resposta"),
        F.coalesce(F.col("ts_resposta"), stamp).alias("ts_envio"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SEND_RESULT.fields])
