"""Table schemas, enumerations and per-platform rules.

Every table is a fixed ``StructType``; constraints that the storage layer
cannot enforce (primary key, CHECK, NOT NULL) are validation queries in
``operators.control``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values the original pipeline uses, so
# they are written out plainly, in their natural order.
# ---------------------------------------------------------------------------
STAGES = ["MQL", "SQL", "Proposta", "Venda"]
PLATFORMS = ["google", "meta", "bing"]
SEND_STATUSES = ["aceito", "erro", "dead_letter"]
ORIGINS = ["google_ads", "meta_ads", "bing_ads", "organico", "crm_import"]
# platform -> (own click-ID column, paid origin, window in days)
PLATFORM_RULES_FIXED = {
    "google": ("gclid", "google_ads", 63),
    "meta": ("fbclid", "meta_ads", 7),
    "bing": ("msclkid", "bing_ads", 90),
}
# age-regime labels of the QA histogram and the day bounds they use
AGE_REGIMES = ["0-7d (todas)", "8-63d (google/bing)", "64d+ (só bing ou nada)"]
AGE_REGIME_BOUNDS_DAYS = [7, 63]
DEFAULT_DDI = "55"
CURRENCY = "BRL"
EVENT_NAME_PREFIX = "Lead_"
META_ACTION_SOURCE = "system_generated"
META_FBC_PREFIX = "fb.1."
GOOGLE_EVENT_SOURCE = "OTHER"
GOOGLE_ENCODING = "HEX"
GOOGLE_PRODUCT = "GOOGLE_ADS"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
# ---------------------------------------------------------------------------

# Names of the test tables' own making; they need not match anything.
PRODUCTS = ["agenda", "cofre", "planilha"]
CLIENT_SIZES = ["ate_9", "10_a_99", "100_a_999", "1000_ou_mais"]
CAMPAIGNS_BY_ORIGIN = {origin: [f"{origin}_{theme}" for theme in ("aurora", "brisa", "cedro")] for origin in ORIGINS}

KEY = ["lead_id", "etapa_funil", "plataforma"]
GOLD_KEY = ["lead_id", "etapa_funil"]


@dataclass(frozen=True)
class PlatformRule:
    name: str
    click_col: str
    paid_origin: str
    window_days: int


PLATFORM_RULES = [PlatformRule(p, *PLATFORM_RULES_FIXED[p]) for p in PLATFORMS]
RULE_BY_PLATFORM = {r.name: r for r in PLATFORM_RULES}


def _f(name, dtype, nullable=True, comment=None):
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, meta)


TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)

GOLD = T.StructType([
    _f("lead_id", T.StringType(), False, "CRM lead id"),
    _f("email_hashed", T.StringType(), comment="normalised e-mail, SHA-256 hex"),
    _f("phone_hashed", T.StringType(), comment="normalised E.164 phone, SHA-256 hex"),
    _f("data_hora_conversao", TS, False, "when the funnel stage happened"),
    _f("etapa_funil", T.StringType(), False, "MQL | SQL | Proposta | Venda"),
    _f("vl_faturamento_estimado", MONEY, comment="estimated value of the conversion"),
    _f("gclid", T.StringType()),
    _f("fbclid", T.StringType()),
    _f("msclkid", T.StringType()),
    _f("origem_midia", T.StringType()),
    _f("campaign_id", T.StringType()),
    _f("produto", T.StringType()),
    _f("porte_cliente", T.StringType()),
])

RAW = T.StructType([
    _f("lead_id", T.StringType()),
    _f("email_raw", T.StringType()),
    _f("phone_raw", T.StringType()),
])

MANIFEST = T.StructType([
    _f("lead_id", T.StringType()),
    _f("tipo_defeito", T.StringType()),
    _f("descricao", T.StringType()),
])

CONTROL = T.StructType([
    _f("lead_id", T.StringType(), False),
    _f("etapa_funil", T.StringType(), False),
    _f("plataforma", T.StringType(), False),
    _f("data_hora_conversao", TS, False, "base of latency and window checks"),
    _f("campaign_id", T.StringType()),
    _f("valor_enviado", MONEY, comment="value actually sent"),
    _f("identificador_usado", T.StringType(), False),
    _f("status_envio", T.StringType(), False, "aceito | erro | dead_letter"),
    _f("http_status", T.IntegerType()),
    _f("codigo_erro", T.StringType()),
    _f("mensagem_resposta", T.StringType()),
    _f("tentativas", T.IntegerType(), False),
    _f("ts_primeiro_envio", TS),
    _f("ts_ultimo_envio", TS, False),
    _f("status_match", T.StringType(), comment="casado | nao_casado | pendente; NULL before reconciliation"),
    _f("ts_reconciliacao", TS),
    _f("dt_atualizacao", TS, False),
])
CONTROL_COLUMNS = [f.name for f in CONTROL.fields]
CONTROL_NOT_NULL = [f.name for f in CONTROL.fields if not f.nullable]

SEND_RESULT = T.StructType([
    _f("lead_id", T.StringType()),
    _f("etapa_funil", T.StringType()),
    _f("plataforma", T.StringType()),
    _f("data_hora_conversao", TS),
    _f("campaign_id", T.StringType()),
    _f("valor_enviado", MONEY),
    _f("identificador_usado", T.StringType()),
    _f("status_envio", T.StringType()),
    _f("http_status", T.IntegerType()),
    _f("codigo_erro", T.StringType()),
    _f("mensagem_resposta", T.StringType()),
    _f("ts_envio", TS),
])
SEND_RESULT_COLUMNS = [f.name for f in SEND_RESULT.fields]

# Response bodies. Meta's shape is documented by the original; Bing's
# PartialErrors entry fields are an assumption of this build.
META_RESPONSE = T.StructType([
    _f("events_received", T.IntegerType()),
    _f("messages", T.ArrayType(T.StringType())),
    _f("fbtrace_id", T.StringType()),
])
BING_PARTIAL_ERROR = T.StructType([
    _f("Index", T.IntegerType()),
    _f("Code", T.IntegerType()),
    _f("ErrorCode", T.StringType()),
    _f("Message", T.StringType()),
])
BING_RESPONSE = T.StructType([_f("PartialErrors", T.ArrayType(BING_PARTIAL_ERROR))])

RESPONSE = T.StructType([
    _f("plataforma", T.StringType()),
    _f("batch_id", T.LongType()),
    _f("http_status", T.IntegerType()),
    _f("body", T.StringType()),
    _f("ts_resposta", TS),
])

PLATFORM_REPORT = T.StructType([
    _f("plataforma", T.StringType()),
    _f("event_id", T.StringType()),
    _f("matched", T.BooleanType()),
    _f("reported_at", TS),
])
