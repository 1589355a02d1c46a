"""Platform payloads (P1-P4, E9-E13) as struct columns serialised by ``to_json``.

Optional keys are NULL struct fields, which ``to_json`` drops, so a payload
carries exactly the keys whose source value is present. "Present" is the
truthiness test of the payload layer: NULL *and* empty text are absent
(routing, in contrast, tests only IS NOT NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import expression_cache
from ..functions.identity import nonblank
from ..functions.timefmt import iso_z, unix_millis, unix_seconds
from ..schemas import (CURRENCY, EVENT_NAME_PREFIX, GOOGLE_EVENT_SOURCE, META_ACTION_SOURCE,
                       META_FBC_PREFIX, PLATFORMS)

TS = "data_hora_conversao"


@expression_cache
def value_double() -> Column:
    """``float(value or 0)``."""
    return F.coalesce(F.col("vl_faturamento_estimado").cast("double"), F.lit(0.0))


@expression_cache
def event_id() -> Column:
    return F.concat(F.col("lead_id"), F.lit("_"), F.col("etapa_funil"))


@expression_cache
def event_name() -> Column:
    return F.concat(F.lit(EVENT_NAME_PREFIX), F.col("etapa_funil"))


@expression_cache
def meta_event() -> Column:
    """Conversions API event."""
    email, phone, fbclid = nonblank("email_hashed"), nonblank("phone_hashed"), nonblank("fbclid")
    user_data = F.struct(
        F.when(email.isNotNull(), F.array(email)).alias("em"),
        F.when(phone.isNotNull(), F.array(phone)).alias("ph"),
        # fbc is built from the conversion time, not the click time
        F.when(fbclid.isNotNull(), F.concat(F.lit(META_FBC_PREFIX), unix_millis(TS).cast("string"),
                                            F.lit("."), fbclid)).alias("fbc"),
    )
    return F.struct(
        event_name().alias("event_name"),
        unix_seconds(TS).alias("event_time"),
        F.lit(META_ACTION_SOURCE).alias("action_source"),
        event_id().alias("event_id"),
        user_data.alias("user_data"),
        F.struct(value_double().alias("value"), F.lit(CURRENCY).alias("currency")).alias("custom_data"),
    )


@expression_cache
def google_user_identifiers() -> Column:
    email, phone = nonblank("email_hashed"), nonblank("phone_hashed")
    none = F.lit(None).cast("string")
    ids = F.array(
        F.when(email.isNotNull(), F.struct(email.alias("emailAddress"), none.alias("phoneNumber"))),
        F.when(phone.isNotNull(), F.struct(none.alias("emailAddress"), phone.alias("phoneNumber"))),
    )
    return F.filter(ids, lambda x: x.isNotNull())


@expression_cache
def google_event() -> Column:
    """Data Manager event; the identifier list may be empty."""
    gclid = nonblank("gclid")
    return F.struct(
        event_id().alias("transactionId"),
        iso_z(TS).alias("eventTimestamp"),
        F.lit(GOOGLE_EVENT_SOURCE).alias("eventSource"),
        value_double().alias("conversionValue"),
        F.lit(CURRENCY).alias("currency"),
        F.struct(google_user_identifiers().alias("userIdentifiers")).alias("userData"),
        F.when(gclid.isNotNull(), F.struct(gclid.alias("gclid"))).alias("adIdentifiers"),
    )


@expression_cache
def bing_event(goal_name: str | None = None) -> Column:
    """Offline conversion; ``goal_name`` overrides the conversion name."""
    name = F.lit(goal_name) if goal_name else event_name()
    return F.struct(
        name.alias("ConversionName"),
        iso_z(TS).alias("ConversionTime"),
        value_double().alias("ConversionValue"),
        F.lit(CURRENCY).alias("ConversionCurrencyCode"),
        nonblank("msclkid").alias("MicrosoftClickId"),
        nonblank("email_hashed").alias("HashedEmailAddress"),
        nonblank("phone_hashed").alias("HashedPhoneNumber"),
    )


EVENT_BUILDERS = {"meta": meta_event, "google": google_event, "bing": bing_event}


@expression_cache
def sendable() -> Column:
    """The payload carries at least one identifier the platform can match on."""
    p = F.col("plataforma")
    own = (F.when(p == "google", nonblank("gclid"))
            .when(p == "meta", nonblank("fbclid"))
            .when(p == "bing", nonblank("msclkid")))
    return own.isNotNull() | nonblank("email_hashed").isNotNull() | nonblank("phone_hashed").isNotNull()


@expression_cache
def _event_columns(goal_name: str | None = None) -> list:
    p = F.col("plataforma")
    return [F.when(p == "meta", meta_event()).alias("meta_event"),
            F.when(p == "google", google_event()).alias("google_event"),
            F.when(p == "bing", bing_event(goal_name)).alias("bing_event")]


def with_events(routed: DataFrame, goal_name: str | None = None) -> DataFrame:
    """Routed rows plus one event struct column per platform (NULL for the others)."""
    return routed.select("*", *_event_columns(goal_name))


@expression_cache
def payload_json(strict: bool = True, goal_name: str | None = None) -> Column:
    """P4 dispatcher: JSON text of the row's platform payload.

    An unknown platform fails the job, or gives NULL when not ``strict``.
    """
    p = F.col("plataforma")
    out = (F.when(p == "meta", F.to_json(meta_event()))
            .when(p == "google", F.to_json(google_event()))
            .when(p == "bing", F.to_json(bing_event(goal_name))))
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("unknown platform: "), F.coalesce(p, F.lit("NULL")))))
    return out


def build(routed: DataFrame, strict: bool = True, goal_name: str | None = None) -> DataFrame:
    """Key, platform, JSON payload and a ``sendable`` flag per routed row."""
    return routed.select(
        "lead_id", "etapa_funil", "plataforma",
        event_id().alias("event_id"),
        payload_json(strict, goal_name).alias("payload"),
        sendable().alias("sendable"),
        F.col("plataforma").isin(*PLATFORMS).alias("known_platform"),
    )


# Flat views (one column per payload field) for engine-independent comparison.

def meta_flat(routed: DataFrame) -> DataFrame:
    e = meta_event()
    return routed.where(F.col("plataforma") == "meta").select(
        "lead_id", "etapa_funil", e.alias("e")).select(
        "lead_id", "etapa_funil", "e.event_name", "e.event_time", "e.action_source", "e.event_id",
        F.get(F.col("e.user_data.em"), 0).alias("em"), F.get(F.col("e.user_data.ph"), 0).alias("ph"),
        F.col("e.user_data.fbc").alias("fbc"), F.col("e.custom_data.value").alias("value"),
        F.col("e.custom_data.currency").alias("currency"))


def google_flat(routed: DataFrame) -> DataFrame:
    e = google_event()
    return routed.where(F.col("plataforma") == "google").select(
        "lead_id", "etapa_funil", e.alias("e")).select(
        "lead_id", "etapa_funil", "e.transactionId", "e.eventTimestamp", "e.eventSource",
        "e.conversionValue", "e.currency",
        F.size("e.userData.userIdentifiers").alias("n_user_identifiers"),
        F.col("e.adIdentifiers.gclid").alias("gclid"))


def bing_flat(routed: DataFrame, goal_name: str | None = None) -> DataFrame:
    e = bing_event(goal_name)
    return routed.where(F.col("plataforma") == "bing").select(
        "lead_id", "etapa_funil", e.alias("e")).select(
        "lead_id", "etapa_funil", "e.*")


# The fields of a payload read back from its JSON text, under one set of names.

_META = ("event_name string, event_time bigint, event_id string, custom_data struct<value: double>, "
         "user_data struct<em: array<string>, ph: array<string>, fbc: string>")
_GOOGLE = ("transactionId string, eventTimestamp string, conversionValue double, adIdentifiers struct<gclid: string>, "
           "userData struct<userIdentifiers: array<struct<emailAddress: string, phoneNumber: string>>>")
_BING = ("ConversionName string, ConversionTime string, ConversionValue double, MicrosoftClickId string, "
         "HashedEmailAddress string, HashedPhoneNumber string")


def _fields(name: Column, when: Column, value: Column, email: Column, phone: Column, click: Column) -> Column:
    return F.struct(name.alias("nome"), when.cast("string").alias("quando"), value.alias("valor"),
                    email.alias("email"), phone.alias("fone"), click.alias("clique"))


def meta_fields(e: Column) -> Column:
    user = e["user_data"]
    return _fields(e["event_name"], e["event_time"], e["custom_data"]["value"],
                   F.get(user["em"], 0), F.get(user["ph"], 0), user["fbc"])


def google_fields(e: Column) -> Column:
    def of(key: str) -> Column:
        ids = F.transform(e["userData"]["userIdentifiers"], lambda x: x[key])
        return F.get(F.filter(ids, lambda x: x.isNotNull()), 0)
    return _fields(e["transactionId"], e["eventTimestamp"], e["conversionValue"],
                   of("emailAddress"), of("phoneNumber"), e["adIdentifiers"]["gclid"])


def bing_fields(e: Column) -> Column:
    return _fields(e["ConversionName"], e["ConversionTime"], e["ConversionValue"],
                   e["HashedEmailAddress"], e["HashedPhoneNumber"], e["MicrosoftClickId"])


_READERS = {"meta": (_META, "data", meta_fields), "google": (_GOOGLE, "events", google_fields),
            "bing": (_BING, "OfflineConversions", bing_fields)}


def read_payloads(built: DataFrame) -> DataFrame:
    """``build`` rows with the fields parsed back from the JSON text."""
    out = None
    for platform, (schema, _, fields) in _READERS.items():
        arm = fields(F.from_json("payload", schema))
        here = F.col("plataforma") == platform
        out = F.when(here, arm) if out is None else out.when(here, arm)
    return built.withColumn("_f", out).select("lead_id", "etapa_funil", "plataforma", "event_id", "sendable", "_f.*")


def read_envelopes(env: DataFrame) -> DataFrame:
    """One row per event parsed back from the request bodies: batch, position,
    the request's own setting (test code or encoding) and the event's fields."""
    out = None
    for platform, (schema, key, fields) in _READERS.items():
        events = F.from_json("body", f"{key} array<struct<{schema}>>")[key]
        arm = F.transform(events, fields)
        here = F.col("plataforma") == platform
        out = F.when(here, arm) if out is None else out.when(here, arm)
    setting = F.coalesce(F.get_json_object("body", "$.test_event_code"), F.get_json_object("body", "$.encoding"))
    return env.select("plataforma", "batch_id", "n_events", setting.alias("ajuste"),
                      F.posexplode(out).alias("position", "_f")).select(
        "plataforma", "batch_id", "n_events", "ajuste", "position", "_f.*")
