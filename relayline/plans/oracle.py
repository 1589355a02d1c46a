"""DuckDB SQL for every comparable query in ``catalog.QUERIES``.

The fixtures are rebuilt from the registered ``lineitem`` view with the same
rules as ``sources.fixtures``, as a chain of CTEs; each query then reads
those CTEs. Column names match the Spark results one for one.
"""

from __future__ import annotations

import re

from ..functions.identity import EMAIL_IN_TEXT, PHONE_IN_TEXT
from ..schemas import (CAMPAIGNS_BY_ORIGIN, CLIENT_SIZES, CONTROL_COLUMNS, ORIGINS, PLATFORM_RULES,
                       PRODUCTS, STAGES)
from .catalog import (AS_OF, BATCH_SIZE, BODY_BYTES, COMPACT_ROWS, FROZEN_AT, GRACE_DAYS, LEAD_ROLLUPS, MAX_ATTEMPTS, NEXT_RUN,
                      ONE_LEAD, ROWS_ONLY)

TS_AS_OF = f"TIMESTAMP '{AS_OF}'"
TS_FROZEN = f"TIMESTAMP '{FROZEN_AT}'"


def _lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pm(x: str, n: int) -> str:
    return f"((({x}) % {n} + {n}) % {n})"


def _pick(values, idx0: str) -> str:
    return f"({_lst(values)})[{idx0} + 1]"


_EMAIL = "('pessoa.' || CAST(k AS VARCHAR) || '@correio.example')"
RAW_EMAIL = (f"CASE {_pm('k', 8)} WHEN 1 THEN chr(9) || {_EMAIL} || chr(10) "
             f"WHEN 2 THEN replace({_EMAIL}, 'correio', 'CORREIO') WHEN 3 THEN replace({_EMAIL}, '.example', '') "
             f"WHEN 4 THEN '' WHEN 5 THEN NULL ELSE {_EMAIL} END")
_NUM = f"CAST(900000000 + {_pm('k', 100000000)} AS VARCHAR)"
RAW_PHONE = (f"CASE {_pm('k', 7)} WHEN 0 THEN '0055/41/' || {_NUM} WHEN 1 THEN '+55[41]' || {_NUM} "
             f"WHEN 2 THEN concat_ws('.', '41', substr({_NUM}, 1, 3), substr({_NUM}, 4, 3), substr({_NUM}, 7, 3)) "
             f"WHEN 3 THEN '041-' || {_NUM} WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'cel. 41' || {_NUM} END")


def _campaign() -> str:
    arms = " ".join(
        f"WHEN '{o}' THEN {_pick(CAMPAIGNS_BY_ORIGIN[o], _pm(_pm('k', 9), len(CAMPAIGNS_BY_ORIGIN[o])))}"
        for o in ORIGINS)
    return f"(CASE origem_midia {arms} END) || '_' || lpad(CAST({_pm('k', 9)} + 1 AS VARCHAR), 3, '0')"


_DAYS = "date_diff('day', DATE '1995-01-01', CAST(d AS DATE))"
_MICROS = (f"{_pm(_DAYS, 105)} * 86400000000 "
           f"+ {_pm('p', 86400)} * 1000000 + CASE WHEN {_pm('k', 4)} = 0 THEN 0 ELSE {_pm('k * 37', 1000000)} END")

GOLD_SELECT = f"""
  lead_id,
  CASE WHEN {_pm('k', 11)} = 0 THEN NULL WHEN {_pm('k', 10)} = 3 THEN sha256(email_raw)
       ELSE sha256({_EMAIL}) END AS email_hashed,
  CASE WHEN {_pm('k', 11)} = 0 THEN NULL WHEN {_pm('k', 10)} = 3 THEN sha256(phone_raw)
       ELSE sha256('+5541' || {_NUM}) END AS phone_hashed,
  make_timestamp(epoch_us(TIMESTAMP '2024-01-01 00:00:00') + {_MICROS}) AS data_hora_conversao,
  etapa_funil,
  CAST(v AS DECIMAL(18,2)) AS vl_faturamento_estimado,
  CASE WHEN {_pm('k', 7)} = 0 THEN NULL WHEN {_pm('k', 5)} = 0 AND {_pm('k', 17)} = 0 THEN ''
       WHEN {_pm('k', 5)} = 0 THEN 'gclid_' || CAST(k AS VARCHAR)
       WHEN {_pm('k', 13)} = 0 AND {_pm('k', 5)} IN (1, 2) THEN 'gclid_mt_' || CAST(k AS VARCHAR) END AS gclid,
  CASE WHEN {_pm('k', 7)} = 0 THEN NULL WHEN {_pm('k', 5)} = 1 THEN 'fbclid_' || CAST(k AS VARCHAR)
       WHEN {_pm('k', 13)} = 0 AND {_pm('k', 5)} = 0 THEN 'fbclid_mt_' || CAST(k AS VARCHAR) END AS fbclid,
  CASE WHEN {_pm('k', 7)} = 0 THEN NULL WHEN {_pm('k', 5)} = 2 THEN 'msclkid_' || CAST(k AS VARCHAR) END AS msclkid,
  origem_midia,
  {_campaign()} AS campaign_id,
  {_pick(PRODUCTS, _pm('k', 3))} AS produto,
  {_pick(CLIENT_SIZES, _pm('k', 4))} AS porte_cliente"""

KK = "CAST(substr(lead_id, 6) AS BIGINT)"


def _ident(prefix: str = "") -> str:
    arms = []
    for r in PLATFORM_RULES:
        arms.append(f"WHEN '{r.name}' THEN CASE WHEN {prefix}{r.click_col} IS NOT NULL THEN '{r.click_col}' "
                    f"WHEN {prefix}email_hashed IS NOT NULL THEN 'email_hash' "
                    f"WHEN {prefix}phone_hashed IS NOT NULL THEN 'phone_hash' ELSE 'sem_identificador' END")
    return f"CASE plataforma {' '.join(arms)} END"


def _quality(prefix: str = "") -> str:
    det = " OR ".join(f"(plataforma = '{r.name}' AND {prefix}{r.click_col} IS NOT NULL)" for r in PLATFORM_RULES)
    return (f"CASE WHEN {det} THEN 'deterministico' "
            f"WHEN {prefix}email_hashed IS NOT NULL OR {prefix}phone_hashed IS NOT NULL THEN 'probabilistico' "
            f"ELSE 'sem_identificador' END")


def _candidates(gold: str, windowed: bool, future_guard: bool = False, cols: str = "lead_id, etapa_funil, data_hora_conversao") -> str:
    arms = []
    for r in PLATFORM_RULES:
        cond = f"({r.click_col} IS NOT NULL OR origem_midia = '{r.paid_origin}')"
        if windowed:
            cond += f" AND data_hora_conversao >= {TS_AS_OF} - INTERVAL {r.window_days} DAY"
        if future_guard:
            cond += f" AND data_hora_conversao <= {TS_AS_OF}"
        arms.append(f"SELECT {cols}, '{r.name}' AS plataforma FROM {gold} WHERE {cond}")
    return "\n  UNION ALL ".join(arms)


def _anti(cand: str, control: str, statuses=("aceito",)) -> str:
    st = ", ".join(f"'{s}'" for s in statuses)
    return (f"SELECT c.* FROM ({cand}) c WHERE NOT EXISTS (SELECT 1 FROM {control} x "
            f"WHERE x.lead_id = c.lead_id AND x.etapa_funil = c.etapa_funil AND x.plataforma = c.plataforma "
            f"AND x.status_envio IN ({st}))")


def _route(eligible: str, gold: str) -> str:
    return f"""SELECT e.lead_id, e.etapa_funil, e.plataforma, e.data_hora_conversao,
    g.email_hashed, g.phone_hashed, g.gclid, g.fbclid, g.msclkid, g.campaign_id, g.vl_faturamento_estimado,
    {_ident('g.')} AS identificador_usado, {_quality('g.')} AS qualidade_match
  FROM ({eligible}) e JOIN {gold} g ON e.lead_id = g.lead_id AND e.etapa_funil = g.etapa_funil"""


def _route_carried(eligible: str) -> str:
    return f"""SELECT lead_id, etapa_funil, plataforma, data_hora_conversao, email_hashed, phone_hashed,
    gclid, fbclid, msclkid, campaign_id, vl_faturamento_estimado,
    {_ident()} AS identificador_usado, {_quality()} AS qualidade_match
  FROM ({eligible})"""


def _upsert(target: str, source: str) -> str:
    t_first = ["lead_id", "etapa_funil", "plataforma", "data_hora_conversao", "campaign_id"]
    s_first = ["valor_enviado", "identificador_usado", "status_envio", "http_status", "codigo_erro", "mensagem_resposta"]
    exprs = {c: f"CASE WHEN t._t THEN t.{c} ELSE s.{c} END" for c in t_first}
    exprs.update({c: f"CASE WHEN s._s THEN s.{c} ELSE t.{c} END" for c in s_first})
    both = "(t._t AND s._s)"
    only_s = "(s._s AND t._t IS NULL)"
    exprs["tentativas"] = f"CAST(CASE WHEN {both} THEN t.tentativas + 1 WHEN {only_s} THEN 1 ELSE t.tentativas END AS INTEGER)"
    exprs["ts_primeiro_envio"] = f"CASE WHEN {only_s} THEN s.ts_envio ELSE t.ts_primeiro_envio END"
    exprs["ts_ultimo_envio"] = "CASE WHEN s._s THEN s.ts_envio ELSE t.ts_ultimo_envio END"
    exprs["status_match"] = f"CASE WHEN {only_s} THEN NULL ELSE t.status_match END"
    exprs["ts_reconciliacao"] = f"CASE WHEN {only_s} THEN NULL ELSE t.ts_reconciliacao END"
    exprs["dt_atualizacao"] = f"CASE WHEN s._s THEN {TS_AS_OF} ELSE t.dt_atualizacao END"
    sel = ",\n    ".join(f"{exprs[c]} AS {c}" for c in CONTROL_COLUMNS)
    return f"""SELECT {sel}
  FROM (SELECT *, TRUE AS _t FROM {target}) t
  FULL OUTER JOIN (SELECT *, TRUE AS _s FROM {source}) s
    ON t.lead_id = s.lead_id AND t.etapa_funil = s.etapa_funil AND t.plataforma = s.plataforma"""


def _normalize_email(c: str) -> str:
    e = f"lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"
    return f"CASE WHEN regexp_matches({e}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') THEN {e} END"


def _normalize_phone(c: str) -> str:
    d = f"regexp_replace(regexp_replace({c}, '[^0-9]', '', 'g'), '^00', '')"
    return (f"CASE WHEN starts_with({d}, '55') AND length({d}) >= 12 THEN '+' || {d} "
            f"WHEN length({d}) IN (10, 11) THEN '+55' || {d} END")


def _iso_z(c: str) -> str:
    return (f"strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({c}) % 1000000 <> 0 "
            f"THEN '.' || strftime({c}, '%f') ELSE '' END || 'Z'")


def _field_status(gold_col: str, recomputed: str) -> str:
    return (f"CASE WHEN {gold_col} IS NULL THEN 'sem_hash' WHEN {recomputed} IS NULL THEN 'nao_normalizavel' "
            f"WHEN {gold_col} = {recomputed} THEN 'ok' ELSE 'divergente' END")


_window_ok = " OR ".join(
    f"(plataforma = '{r.name}' AND data_hora_conversao >= {TS_FROZEN} - INTERVAL {r.window_days} DAY)"
    for r in PLATFORM_RULES)

_manifest_rules = [
    ("pago_sem_clickid", f"{_pm('k', 7)} = 0 AND {_pm('k', 5)} IN (0, 1, 2)"),
    ("hash_mal_normalizado", f"{_pm('k', 10)} = 3 AND {_pm('k', 11)} <> 0"),
    ("multitouch", f"{_pm('k', 13)} = 0 AND {_pm('k', 5)} IN (0, 1, 2)"),
    ("sem_click_id", f"{_pm('k', 5)} IN (3, 4)"),
]

PREAMBLE = f"""WITH
stage_lines AS (
  SELECT 'lead_' || CAST(l_orderkey AS VARCHAR) AS lead_id,
         {_pick(STAGES, _pm('l_linenumber - 1', len(STAGES)))} AS etapa_funil,
         l_orderkey AS k, l_shipdate AS d, l_partkey AS p, CAST(l_extendedprice AS DECIMAL(18,2)) AS v
  FROM lineitem),
gold_agg AS (SELECT lead_id, etapa_funil, max(k) AS k, max(d) AS d, min(p) AS p, sum(v) AS v
             FROM stage_lines GROUP BY lead_id, etapa_funil),
gold_k AS (SELECT *, {RAW_EMAIL} AS email_raw, {RAW_PHONE} AS phone_raw,
                  {_pick(ORIGINS, _pm('k', 5))} AS origem_midia FROM gold_agg),
gold AS (SELECT {GOLD_SELECT} FROM gold_k),
gold_dup_k AS (SELECT *, {RAW_EMAIL} AS email_raw, {RAW_PHONE} AS phone_raw,
                      {_pick(ORIGINS, _pm('k', 5))} AS origem_midia FROM stage_lines),
gold_dup AS (SELECT {GOLD_SELECT} FROM gold_dup_k),
leads AS (SELECT DISTINCT l_orderkey AS k FROM lineitem),
raw AS (SELECT 'lead_' || CAST(k AS VARCHAR) AS lead_id, {RAW_EMAIL} AS email_raw, {RAW_PHONE} AS phone_raw FROM leads),
manifest AS ({" UNION ALL ".join(f"SELECT 'lead_' || CAST(k AS VARCHAR) AS lead_id, '{t}' AS tipo_defeito FROM leads WHERE {c}" for t, c in _manifest_rules)}),
cand_all AS ({_candidates('gold', False, cols='*')}),
control AS (
  SELECT lead_id, etapa_funil, plataforma, data_hora_conversao, campaign_id,
         CAST(vl_faturamento_estimado AS DECIMAL(18,2)) AS valor_enviado,
         {_ident()} AS identificador_usado, status_envio,
         CAST(CASE status_envio WHEN 'aceito' THEN 200 WHEN 'erro' THEN 400 ELSE 500 END AS INTEGER) AS http_status,
         CASE status_envio WHEN 'erro' THEN 'INVALID_ARGUMENT' WHEN 'dead_letter' THEN 'MAX_RETRIES' END AS codigo_erro,
         CASE status_envio WHEN 'aceito' THEN 'OK' WHEN 'erro' THEN 'invalid event' ELSE 'gave up after retries' END AS mensagem_resposta,
         CAST({_pm('kk', 4)} + 1 AS INTEGER) AS tentativas,
         first_ts AS ts_primeiro_envio,
         first_ts + to_hours(CAST({_pm('kk', 4)} AS BIGINT)) AS ts_ultimo_envio,
         CAST(NULL AS VARCHAR) AS status_match,
         CAST(NULL AS TIMESTAMP) AS ts_reconciliacao,
         first_ts + to_hours(CAST({_pm('kk', 4)} AS BIGINT)) AS dt_atualizacao
  FROM (SELECT *, data_hora_conversao + INTERVAL 2 HOUR + to_minutes(CAST({_pm('kk', 60)} AS BIGINT)) AS first_ts,
               CASE WHEN {_pm('kk', 3)} = 0 THEN 'aceito'
                    WHEN {_pm('kk', 3)} = 1 AND {_pm('kk', 17)} = 0 THEN 'erro'
                    WHEN {_pm('kk', 3)} = 1 AND {_pm('kk', 19)} = 0 THEN 'dead_letter' END AS status_envio
        FROM (SELECT *, {KK} AS kk FROM cand_all))
  WHERE status_envio IS NOT NULL),
cand_win AS ({_candidates('gold', True)}),
eligible AS ({_anti('SELECT * FROM cand_win', 'control')}),
routed AS ({_route('SELECT * FROM eligible', 'gold')}),
send_results AS (
  SELECT lead_id, etapa_funil, plataforma, data_hora_conversao, campaign_id,
         CAST(vl_faturamento_estimado AS DECIMAL(18,2)) AS valor_enviado, identificador_usado,
         CASE WHEN {_pm(KK, 4)} = 1 THEN 'erro' ELSE 'aceito' END AS status_envio,
         CAST(CASE WHEN {_pm(KK, 4)} = 1 THEN 400 ELSE 200 END AS INTEGER) AS http_status,
         CASE WHEN {_pm(KK, 4)} = 1 THEN 'INVALID_ARGUMENT' END AS codigo_erro,
         CASE WHEN {_pm(KK, 4)} = 1 THEN 'invalid event' ELSE 'OK' END AS mensagem_resposta,
         {TS_AS_OF} AS ts_envio
  FROM routed),
upserted AS ({_upsert('control', 'send_results')}),
upserted_twice AS ({_upsert('upserted', 'send_results')}),
appended AS (
  SELECT * FROM control
  UNION ALL
  SELECT lead_id, etapa_funil, plataforma, data_hora_conversao, CAST(NULL AS VARCHAR), CAST(NULL AS DECIMAL(18,2)),
         CASE WHEN {_pm(KK, 9)} <> 1 THEN identificador_usado END,
         CASE WHEN {_pm(KK, 9)} = 2 THEN 'enviado' ELSE status_envio END, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         CAST(1 AS INTEGER), CAST(NULL AS TIMESTAMP), ts_envio, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), ts_envio
  FROM send_results),
report AS (
  SELECT plataforma, lead_id || '_' || etapa_funil AS event_id, {_pm(KK, 5)} <> 4 AS matched,
         ts_ultimo_envio + INTERVAL 1 DAY AS reported_at
  FROM control WHERE status_envio = 'aceito' AND {_pm(KK, 7)} <> 6),
report_history AS (
  SELECT plataforma, event_id, matched, reported_at FROM report
  UNION ALL SELECT plataforma, event_id, NOT matched, reported_at + INTERVAL 2 DAY FROM report
  WHERE CAST(regexp_extract(event_id, '^lead_([0-9]+)_', 1) AS BIGINT) % 4 = 2
  UNION ALL SELECT plataforma, event_id, matched, reported_at + INTERVAL 3 DAY FROM report
  WHERE CAST(regexp_extract(event_id, '^lead_([0-9]+)_', 1) AS BIGINT) % 8 = 2),
rep AS (SELECT plataforma, event_id, max(CAST(matched AS INTEGER)) AS _matched FROM report GROUP BY plataforma, event_id),
reconciled AS (
  SELECT {", ".join(
      ("CASE WHEN c.status_envio = 'aceito' THEN CASE WHEN r._matched = 1 THEN 'casado' "
       f"WHEN r._matched = 0 OR (r._matched IS NULL AND c.ts_ultimo_envio < {TS_AS_OF} - INTERVAL {GRACE_DAYS} DAY) "
       "THEN 'nao_casado' ELSE 'pendente' END ELSE c.status_match END AS status_match") if col == "status_match"
      else (f"CASE WHEN c.status_envio = 'aceito' THEN {TS_AS_OF} ELSE c.ts_reconciliacao END AS ts_reconciliacao")
      if col == "ts_reconciliacao" else f"c.{col}"
      for col in CONTROL_COLUMNS)}
  FROM upserted c LEFT JOIN rep r
    ON r.plataforma = c.plataforma AND r.event_id = c.lead_id || '_' || c.etapa_funil),
batched AS (
  SELECT *, bucket * 4294967296 + CAST(floor(rn / {BATCH_SIZE}) AS BIGINT) AS batch_id,
         CAST(rn % {BATCH_SIZE} AS INTEGER) AS position
  FROM (SELECT *, row_number() OVER (PARTITION BY plataforma, bucket ORDER BY h, event_id, lead_id, etapa_funil) - 1 AS rn
        FROM (SELECT *, lead_id || '_' || etapa_funil AS event_id,
                     ('0x' || substr(sha256(lead_id || '_' || etapa_funil || '|' || CAST(epoch_us(data_hora_conversao) AS VARCHAR)), 1, 8))::BIGINT AS h,
                     CASE WHEN plataforma = 'google' THEN list_position({_lst(STAGES)}, etapa_funil) ELSE 0 END AS bucket
              FROM routed WHERE {_window_ok}))),
classified AS (SELECT lead_id, etapa_funil, plataforma, data_hora_conversao, campaign_id,
    CAST(vl_faturamento_estimado AS DECIMAL(18,2)) AS valor_enviado, identificador_usado,
    CASE WHEN err IS NULL THEN 'aceito' ELSE 'erro' END AS status_envio,
    CAST(CASE WHEN plataforma = 'google' AND (bucket + batch_id) % 4 = 3 THEN 400 ELSE 200 END AS INTEGER) AS http_status,
    err AS codigo_erro, CAST(NULL AS VARCHAR) AS mensagem_resposta,
    {TS_AS_OF} + INTERVAL 1 MINUTE AS ts_envio
  FROM (SELECT *, CASE WHEN plataforma = 'meta' AND batch_id % 5 = 0 THEN 'EVENTS_RECEIVED_MISMATCH'
                       WHEN plataforma = 'google' AND (bucket + batch_id) % 4 = 3 THEN 'HTTP_400'
                       WHEN plataforma = 'bing' AND {_pm(KK, 8)} = 1 THEN 'InvalidClickId' END AS err
        FROM batched)),
odd AS (SELECT *, n % 6 AS kind, CASE WHEN plataforma = 'google' AND (n % 6 IN (1, 3) OR (bucket + batch_id) % 4 = 3)
                                      THEN 400 ELSE 200 END AS status,
    CASE n % 6 WHEN 0 THEN 'nao_json' WHEN 1 THEN 'campo' WHEN 2 THEN 'vazio' END AS motivo
  FROM (SELECT *, batch_id % 4294967296 AS n FROM batched)),
hash_audit AS (
  SELECT r.lead_id,
         {_field_status('g.email_hashed', 'sha256(' + _normalize_email('r.email_raw') + ')')} AS email_status,
         {_field_status('g.phone_hashed', 'sha256(' + _normalize_phone('r.phone_raw') + ')')} AS phone_status
  FROM raw r JOIN (SELECT DISTINCT lead_id, email_hashed, phone_hashed FROM gold) g ON r.lead_id = g.lead_id),
multitouch AS (
  SELECT lead_id, max(n) AS click_ids FROM (
    SELECT lead_id, CAST(gclid IS NOT NULL AS INTEGER) + CAST(fbclid IS NOT NULL AS INTEGER)
                    + CAST(msclkid IS NOT NULL AS INTEGER) AS n FROM gold) WHERE n > 1 GROUP BY lead_id),
paid_no_click AS (
  SELECT DISTINCT lead_id FROM gold WHERE origem_midia IN ({", ".join(f"'{o}'" for o in ORIGINS[:3])})
    AND gclid IS NULL AND fbclid IS NULL AND msclkid IS NULL),
no_click_origin AS (SELECT DISTINCT lead_id FROM gold WHERE origem_midia IN ({", ".join(f"'{o}'" for o in ORIGINS[3:])}))
"""


def _violations(table: str) -> str:
    from ..schemas import CONTROL_NOT_NULL, PLATFORMS, SEND_STATUSES
    arms = [f"SELECT lead_id, etapa_funil, plataforma, 'not_null:{c}' AS regra FROM {table} WHERE {c} IS NULL"
            for c in CONTROL_NOT_NULL]
    for col, dom in (("etapa_funil", STAGES), ("plataforma", PLATFORMS), ("status_envio", SEND_STATUSES)):
        arms.append(f"SELECT lead_id, etapa_funil, plataforma, 'check:{col}' FROM {table} "
                    f"WHERE NOT ({col} IN ({', '.join(repr(v) for v in dom)}))")
    arms.append(f"SELECT lead_id, etapa_funil, plataforma, 'pk_duplicate' FROM {table} "
                "GROUP BY lead_id, etapa_funil, plataforma HAVING count(*) > 1")
    return "\nUNION ALL ".join(arms)


def _changes(before: str, after: str) -> str:
    on = "y.lead_id = x.lead_id AND y.etapa_funil = x.etapa_funil AND y.plataforma = x.plataforma"
    cols = ", ".join(CONTROL_COLUMNS)
    return f"""SELECT x.*, CASE WHEN EXISTS (SELECT 1 FROM {after} y WHERE {on}) THEN 'update_preimage' ELSE 'delete' END AS _change_type
FROM (SELECT {cols} FROM {before} EXCEPT ALL SELECT {cols} FROM {after}) x
UNION ALL
SELECT x.*, CASE WHEN EXISTS (SELECT 1 FROM {before} y WHERE {on}) THEN 'update_postimage' ELSE 'insert' END
FROM (SELECT {cols} FROM {after} EXCEPT ALL SELECT {cols} FROM {before}) x"""


def _retry(table: str) -> str:
    cols = [f"CASE WHEN status_envio = 'erro' AND tentativas >= {MAX_ATTEMPTS} THEN 'dead_letter' "
            "ELSE status_envio END AS status_envio" if c == "status_envio" else c for c in CONTROL_COLUMNS]
    return f"SELECT {', '.join(cols)} FROM {table}"


def _run(number: int, as_of: str) -> str:
    return f"""SELECT c.lead_id, c.etapa_funil, c.plataforma, CAST({number} AS INTEGER) AS rodada,
    CASE WHEN c.status_envio <> 'aceito' THEN c.status_match WHEN r.matched THEN 'casado'
         WHEN r.matched IS NOT NULL OR c.ts_ultimo_envio < TIMESTAMP '{as_of}' - INTERVAL {GRACE_DAYS} DAY
         THEN 'nao_casado' ELSE 'pendente' END AS status_match
  FROM upserted c LEFT JOIN (
    SELECT plataforma, event_id, arg_max(matched, reported_at) AS matched FROM report_history
    WHERE reported_at <= TIMESTAMP '{as_of}' GROUP BY plataforma, event_id) r
  ON r.plataforma = c.plataforma AND r.event_id = c.lead_id || '_' || c.etapa_funil"""


_CUT = """FROM (SELECT c.*, g.produto, g.porte_cliente FROM reconciled c
        LEFT JOIN (SELECT lead_id, etapa_funil, max(produto) AS produto, max(porte_cliente) AS porte_cliente
                   FROM gold GROUP BY lead_id, etapa_funil) g USING (lead_id, etapa_funil))"""

_VALUE = "coalesce(CAST(vl_faturamento_estimado AS DOUBLE), 0.0)"
_CLICK = ("CASE plataforma WHEN 'meta' THEN nullif(fbclid, '') WHEN 'google' THEN nullif(gclid, '') "
          "ELSE nullif(msclkid, '') END")
_SENDABLE = f"({_CLICK} IS NOT NULL OR nullif(email_hashed, '') IS NOT NULL OR nullif(phone_hashed, '') IS NOT NULL)"
_FIELDS = f"""CASE plataforma WHEN 'google' THEN lead_id || '_' || etapa_funil ELSE 'Lead_' || etapa_funil END AS nome,
    CASE plataforma WHEN 'meta' THEN CAST(epoch_us(data_hora_conversao) // 1000000 AS VARCHAR)
         ELSE {_iso_z('data_hora_conversao')} END AS quando,
    {_VALUE} AS valor, nullif(email_hashed, '') AS email, nullif(phone_hashed, '') AS fone,
    CASE WHEN plataforma = 'meta' AND nullif(fbclid, '') IS NOT NULL
         THEN 'fb.1.' || CAST(epoch_us(data_hora_conversao) // 1000 AS VARCHAR) || '.' || fbclid
         ELSE {_CLICK} END AS clique"""

_BODIES = {
    "gold_conversions": "SELECT * FROM gold",
    "control_table": "SELECT * FROM control",
    "candidates_windowed": "SELECT * FROM cand_win",
    "candidates_unwindowed": "SELECT lead_id, etapa_funil, data_hora_conversao, plataforma FROM cand_all",
    "eligible": "SELECT * FROM eligible",
    "eligible_future_guard": _anti(_candidates('gold', True, True), 'control'),
    "eligible_block_dead_letter": _anti('SELECT * FROM cand_win', 'control', ("aceito", "dead_letter")),
    "eligible_total": "SELECT count(*) AS total FROM eligible",
    "eligible_by_platform": "SELECT plataforma, count(*) AS qtd FROM eligible GROUP BY plataforma",
    "eligible_one_lead": (f"SELECT lead_id, plataforma FROM ({_anti(_candidates('gold', False), 'control')}) "
                          f"WHERE lead_id = '{ONE_LEAD}'"),
    "routed": "SELECT * FROM routed",
    "routed_quality_counts": ("SELECT plataforma, qualidade_match, count(*) AS qtd FROM routed "
                              "GROUP BY plataforma, qualidade_match ORDER BY plataforma, qualidade_match"),
    "routed_duplicate_gold": _route_carried(_anti(_candidates('gold_dup', True, cols='*'), 'control')),
    "routed_by_join": _route(_anti(_candidates('gold_dup', True), 'control'), 'gold_dup'),
    "gold_key_duplicates": ("SELECT lead_id, etapa_funil, count(*) AS qtd FROM gold_dup "
                            "GROUP BY lead_id, etapa_funil HAVING count(*) > 1"),
    "email_normalized": f"SELECT lead_id, email_raw, {_normalize_email('email_raw')} AS email_normalizado FROM raw",
    "phone_normalized": f"SELECT lead_id, phone_raw, {_normalize_phone('phone_raw')} AS phone_normalizado FROM raw",
    "pii_hashes": (f"SELECT lead_id, sha256({_normalize_email('email_raw')}) AS email_hashed, "
                   f"sha256({_normalize_phone('phone_raw')}) AS phone_hashed FROM raw"),
    "payload_meta": f"""SELECT lead_id, etapa_funil, 'Lead_' || etapa_funil AS event_name,
    epoch_us(data_hora_conversao) // 1000000 AS event_time, 'system_generated' AS action_source,
    lead_id || '_' || etapa_funil AS event_id, nullif(email_hashed, '') AS em, nullif(phone_hashed, '') AS ph,
    CASE WHEN nullif(fbclid, '') IS NOT NULL THEN 'fb.1.' || CAST(epoch_us(data_hora_conversao) // 1000 AS VARCHAR) || '.' || fbclid END AS fbc,
    {_VALUE} AS value, 'BRL' AS currency
  FROM routed WHERE plataforma = 'meta'""",
    "payload_google": f"""SELECT lead_id, etapa_funil, lead_id || '_' || etapa_funil AS transactionId,
    {_iso_z('data_hora_conversao')} AS eventTimestamp, 'OTHER' AS eventSource, {_VALUE} AS conversionValue,
    'BRL' AS currency,
    CAST(nullif(email_hashed, '') IS NOT NULL AS INTEGER) + CAST(nullif(phone_hashed, '') IS NOT NULL AS INTEGER) AS n_user_identifiers,
    nullif(gclid, '') AS gclid
  FROM routed WHERE plataforma = 'google'""",
    "payload_bing": f"""SELECT lead_id, etapa_funil, 'Lead_' || etapa_funil AS ConversionName,
    {_iso_z('data_hora_conversao')} AS ConversionTime, {_VALUE} AS ConversionValue, 'BRL' AS ConversionCurrencyCode,
    nullif(msclkid, '') AS MicrosoftClickId, nullif(email_hashed, '') AS HashedEmailAddress,
    nullif(phone_hashed, '') AS HashedPhoneNumber
  FROM routed WHERE plataforma = 'bing'""",
    "payload_json": f"SELECT lead_id, etapa_funil, plataforma, lead_id || '_' || etapa_funil AS event_id, {_SENDABLE} AS sendable, {_FIELDS} FROM routed",
    "envelopes": f"""SELECT plataforma, batch_id, count(*) OVER (PARTITION BY plataforma, batch_id) AS n_events,
    CASE plataforma WHEN 'meta' THEN 'TEST123' WHEN 'google' THEN 'HEX' END AS ajuste, position, {_FIELDS}
  FROM batched""",
    "envelope_files": f"""SELECT plataforma, batch_id,
    CASE plataforma WHEN 'meta' THEN 'TEST123' WHEN 'google' THEN 'HEX' END AS ajuste, position, {_FIELDS}
  FROM batched""",
    "document_contacts": f"""SELECT doc_id, tipo, bruto, normalizado, sha256(normalizado) AS hash
  FROM (SELECT *, CASE tipo WHEN 'email' THEN {_normalize_email('bruto')} ELSE {_normalize_phone('bruto')} END AS normalizado
        FROM (SELECT doc_id, 'email' AS tipo, unnest(regexp_extract_all(text, '{EMAIL_IN_TEXT}')) AS bruto FROM documents
              UNION ALL SELECT doc_id, 'fone', unnest(regexp_extract_all(text, '{PHONE_IN_TEXT}')) FROM documents))""",
    "send_latency_quantiles": """SELECT plataforma, min(minuto) FILTER (upto * 100 >= total * 50) AS latencia_p50_min,
    min(minuto) FILTER (upto * 100 >= total * 95) AS latencia_p95_min
  FROM (SELECT plataforma, minuto, count(*) OVER (PARTITION BY plataforma) AS total,
               count(*) OVER (PARTITION BY plataforma ORDER BY minuto) AS upto
        FROM (SELECT plataforma, CAST(floor(floor((epoch_us(ts_primeiro_envio) - epoch_us(data_hora_conversao)) / 1000) / 60000) AS BIGINT) AS minuto
              FROM control WHERE ts_primeiro_envio IS NOT NULL)) GROUP BY plataforma""",
    "envelope_batches": "SELECT plataforma, batch_id, position, lead_id, etapa_funil FROM batched",
    "envelope_sizes": "SELECT plataforma, batch_id, count(*) AS n_events FROM batched GROUP BY plataforma, batch_id",
    "lead_counts": "SELECT count(DISTINCT lead_id) AS leads, count(*) AS linhas FROM gold",
    "multi_stage_top5": ("SELECT lead_id, count(*) AS etapas FROM gold GROUP BY lead_id HAVING count(*) > 1 "
                         "ORDER BY etapas DESC, lead_id LIMIT 5"),
    "hash_length": "SELECT CAST(length(email_hashed) AS INTEGER) AS tam, count(*) AS qtd FROM gold GROUP BY 1",
    "age_regime": f"""SELECT CASE
        WHEN data_hora_conversao >= CAST({TS_AS_OF} AS DATE) - INTERVAL 7 DAY THEN '0-7d (todas)'
        WHEN data_hora_conversao >= CAST({TS_AS_OF} AS DATE) - INTERVAL 63 DAY THEN '8-63d (google/bing)'
        ELSE '64d+ (só bing ou nada)' END AS regime, count(*) AS qtd
  FROM gold GROUP BY 1""",
    "origin_rollup": ("SELECT origem_midia, count(*) AS qtd, CAST(sum(vl_faturamento_estimado) AS DECIMAL(28,2)) AS valor_estimado "
                      "FROM gold GROUP BY origem_midia ORDER BY qtd DESC, origem_midia"),
    "stage_counts": "SELECT etapa_funil, count(*) AS qtd FROM gold GROUP BY etapa_funil ORDER BY etapa_funil",
    "identifier_coverage": """SELECT count(*) AS total_leads,
    count(CASE WHEN gclid IS NOT NULL THEN 1 END) AS com_gclid,
    count(CASE WHEN fbclid IS NOT NULL THEN 1 END) AS com_fbclid,
    count(CASE WHEN msclkid IS NOT NULL THEN 1 END) AS com_msclkid,
    count(CASE WHEN gclid IS NULL AND fbclid IS NULL AND msclkid IS NULL
                AND (email_hashed IS NOT NULL OR phone_hashed IS NOT NULL) THEN 1 END) AS sem_click_id_com_pii,
    count(CASE WHEN gclid IS NULL AND fbclid IS NULL AND msclkid IS NULL
                AND email_hashed IS NULL AND phone_hashed IS NULL THEN 1 END) AS sem_identificador
  FROM gold""",
    "control_published": "SELECT * FROM upserted WHERE status_envio <> 'dead_letter'",
    "control_append": "SELECT * FROM appended",
    "control_duplicates": ("SELECT lead_id, etapa_funil, plataforma, count(*) AS qtd FROM appended "
                           "GROUP BY lead_id, etapa_funil, plataforma HAVING count(*) > 1"),
    "control_violations": _violations("appended"),
    "control_delete": "SELECT * FROM control WHERE NOT coalesce(status_envio = 'dead_letter', FALSE)",
    "control_upsert": "SELECT * FROM upserted",
    "control_upsert_twice": "SELECT * FROM upserted_twice",
    "control_summary": "SELECT count(*) AS total, max(tentativas) AS tentativas_max FROM upserted_twice",
    "control_summary_one_lead": (f"SELECT count(*) AS total, max(tentativas) AS tentativas_max FROM upserted_twice "
                                 f"WHERE lead_id = '{ONE_LEAD}'"),
    "control_changes": _changes("control", "(SELECT * FROM upserted WHERE status_envio <> 'dead_letter')"),
    # What is eligible is not accepted yet, so only this batch's acceptances block it.
    "eligible_after_upsert": _anti('SELECT * FROM eligible', 'send_results'),
    "eligible_by_day": "SELECT * FROM eligible",
    "eligible_colocated": "SELECT * FROM eligible",
    "control_upsert_colocated": "SELECT * FROM upserted",
    "control_merge_feed": _changes("control", "upserted"),
    "control_feed_applied": "SELECT * FROM upserted WHERE status_envio <> 'dead_letter'",
    "control_feed_reverted": "SELECT * FROM control",
    "control_feed_composed": _changes("control", "(SELECT * FROM upserted_twice WHERE status_envio <> 'dead_letter')"),
    "compaction_groups": f"""SELECT *, count(*) OVER (PARTITION BY plataforma, grupo) AS arquivos,
    CAST(sum(linhas) OVER (PARTITION BY plataforma, grupo) AS BIGINT) AS total
  FROM (SELECT *, CAST(coalesce(sum(linhas) OVER (PARTITION BY plataforma ORDER BY linhas, fragmento
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {COMPACT_ROWS} AS BIGINT) AS grupo
        FROM (SELECT plataforma, CAST(ts_ultimo_envio AS DATE) AS fragmento, count(*) AS linhas
              FROM control GROUP BY ALL) WHERE linhas < {COMPACT_ROWS})""",
    "lead_distincts": f"""SELECT plataforma, etapa_funil, dia, CAST(GROUPING(plataforma, etapa_funil, dia) AS INTEGER) AS nivel,
    count(DISTINCT lead_id) AS leads
  FROM (SELECT *, CAST(data_hora_conversao AS DATE) AS dia FROM cand_all)
  GROUP BY GROUPING SETS ({", ".join("(" + ", ".join(x) + ")" for x in LEAD_ROLLUPS)})""",
    "send_latency_sketched": """SELECT plataforma, count(*) AS envios, true AS p50_no_limite, true AS p95_no_limite
  FROM control WHERE ts_primeiro_envio IS NOT NULL GROUP BY plataforma""",
    "open_sends": f"""SELECT c.lead_id, c.etapa_funil, plataforma, ts_ultimo_envio, g.produto, g.porte_cliente
  FROM control c LEFT JOIN gold g ON g.lead_id = c.lead_id AND g.etapa_funil = c.etapa_funil
  WHERE status_envio = 'aceito' AND ts_ultimo_envio >= {TS_AS_OF} - INTERVAL {GRACE_DAYS} DAY""",
    "reports_as_of": f"""SELECT m.plataforma, m.event_id, m.ts, r.matched, r.reported_at
  FROM (SELECT plataforma, lead_id || '_' || etapa_funil AS event_id, ts_ultimo_envio + INTERVAL {GRACE_DAYS} DAY AS ts
        FROM control WHERE status_envio = 'aceito') m
  ASOF LEFT JOIN report_history r
  ON r.plataforma = m.plataforma AND r.event_id = m.event_id AND m.ts >= r.reported_at""",
    "reconciled_corrected": f"{_run(1, AS_OF)} UNION ALL {_run(2, NEXT_RUN)}",
    "business_totals": f"""SELECT plataforma, produto, porte_cliente,
    CAST(GROUPING(plataforma, produto, porte_cliente) AS INTEGER) AS nivel, count(*) AS envios,
    count(CASE WHEN status_envio = 'aceito' THEN 1 END) AS aceitos,
    count(CASE WHEN status_match = 'casado' THEN 1 END) AS casados,
    count(status_match) AS reconciliados,
    CAST(sum(CASE WHEN status_envio = 'aceito' THEN valor_enviado END) AS DECIMAL(28,2)) AS valor_aceito
  {_CUT} GROUP BY GROUPING SETS ((plataforma, produto, porte_cliente), (plataforma, produto), (plataforma), ())""",
    "retry_state": _retry("upserted"),
    "responses_classified": "SELECT * EXCLUDE (mensagem_resposta) FROM classified",
    "answers_quarantined": ("SELECT DISTINCT plataforma, batch_id, CAST(status AS INTEGER) AS http_status, motivo FROM odd "
                            "WHERE motivo IS NOT NULL"),
    "answers_record_errors": f"""SELECT plataforma, batch_id, position AS posicao,
    CASE plataforma WHEN 'google' THEN 'INVALID_FIELD' ELSE 'InvalidClickId' END AS codigo_erro,
    CASE plataforma WHEN 'google' THEN 'timestamp out of range' ELSE 'click id not found' END AS mensagem
  FROM odd WHERE motivo IS NULL AND ((plataforma = 'bing' AND {_pm(KK, 8)} = 1)
                                     OR (plataforma = 'google' AND kind = 3 AND position % 8 = 1))""",
    "answers_classified": f"""SELECT lead_id, etapa_funil, plataforma, data_hora_conversao, campaign_id,
    CAST(vl_faturamento_estimado AS DECIMAL(18,2)) AS valor_enviado, identificador_usado,
    CASE WHEN err IS NULL THEN 'aceito' ELSE 'erro' END AS status_envio,
    CAST(status AS INTEGER) AS http_status, err AS codigo_erro, {TS_AS_OF} + INTERVAL 1 MINUTE AS ts_envio
  FROM (SELECT *, CASE WHEN plataforma = 'google' AND kind = 3 AND position % 8 = 1 THEN 'INVALID_FIELD'
                       WHEN status = 400 THEN 'HTTP_400' WHEN motivo IS NOT NULL THEN 'BODY_' || upper(motivo)
                       WHEN plataforma = 'meta' AND batch_id % 5 = 0 THEN 'EVENTS_RECEIVED_MISMATCH'
                       WHEN plataforma = 'bing' AND {_pm(KK, 8)} = 1 THEN 'InvalidClickId' END AS err FROM odd)""",
    "envelope_byte_bodies": f"""SELECT * FROM (WITH RECURSIVE sized AS (
    SELECT plataforma, bucket, batch_id, position, size, rn,
           sum(size) OVER (PARTITION BY plataforma, bucket ORDER BY rn) AS upto
    FROM (SELECT *, octet_length(encode(concat(lead_id, etapa_funil, email_hashed, phone_hashed, gclid, fbclid, msclkid)))
                    + 60 AS size FROM batched)),
  bodies AS (
    SELECT plataforma, bucket, 0 AS corpo, min(rn) AS starts, CAST(0 AS HUGEINT) AS before FROM sized GROUP BY ALL
    UNION ALL
    SELECT b.plataforma, b.bucket, b.corpo + 1, min(s.rn), min(s.upto - s.size)
    FROM bodies b JOIN sized s ON s.plataforma = b.plataforma AND s.bucket = b.bucket AND s.upto - b.before > {BODY_BYTES}
    GROUP BY b.plataforma, b.bucket, b.corpo)
  SELECT s.plataforma, CAST(s.bucket AS BIGINT) AS bucket, batch_id, position, CAST(size AS BIGINT) AS size,
    CAST(b.corpo AS BIGINT) AS corpo
  FROM sized s ASOF JOIN bodies b ON s.plataforma = b.plataforma AND s.bucket = b.bucket AND s.rn >= b.starts)""",
    "control_after_responses": (
        "SELECT * EXCLUDE (mensagem_resposta) FROM ("
        + _retry(f"({_upsert('control', 'classified')})") + ")"),
    "reconciled": "SELECT * FROM reconciled",
    "send_latency": """SELECT plataforma, count(lat) AS envios, avg(lat) AS latencia_media_ms,
    min(lat) AS latencia_min_ms, max(lat) AS latencia_max_ms
  FROM (SELECT plataforma, CAST(floor((epoch_us(ts_primeiro_envio) - epoch_us(data_hora_conversao)) / 1000) AS BIGINT) AS lat
        FROM control WHERE ts_primeiro_envio IS NOT NULL) GROUP BY plataforma""",
    "business_cuts": """SELECT plataforma, produto, porte_cliente, envios, aceitos, casados, reconciliados,
    aceitos / envios AS taxa_aceite, CASE WHEN reconciliados > 0 THEN casados / reconciliados END AS taxa_match
  FROM (SELECT c.plataforma, g.produto, g.porte_cliente, count(*) AS envios,
               count(CASE WHEN c.status_envio = 'aceito' THEN 1 END) AS aceitos,
               count(CASE WHEN c.status_match = 'casado' THEN 1 END) AS casados,
               count(CASE WHEN c.status_match IS NOT NULL THEN 1 END) AS reconciliados
        FROM reconciled c LEFT JOIN (SELECT lead_id, etapa_funil, max(produto) AS produto,
                                            max(porte_cliente) AS porte_cliente
                                     FROM gold GROUP BY lead_id, etapa_funil) g
          ON c.lead_id = g.lead_id AND c.etapa_funil = g.etapa_funil
        GROUP BY c.plataforma, g.produto, g.porte_cliente)""",
    "audit_hash": "SELECT * FROM hash_audit",
    "audit_hash_summary": ("SELECT email_status, phone_status, count(*) AS leads FROM hash_audit "
                           "GROUP BY email_status, phone_status"),
    "audit_multitouch": "SELECT * FROM multitouch",
    "audit_paid_no_click": "SELECT * FROM paid_no_click",
    "audit_no_click_origin": "SELECT * FROM no_click_origin",
    "audit_future": f"SELECT lead_id, etapa_funil, data_hora_conversao FROM gold WHERE data_hora_conversao > {TS_AS_OF}",
    "audit_stage_order": f"""SELECT * FROM (
    SELECT lead_id, etapa_funil, data_hora_conversao,
           lag(etapa_funil) OVER w AS etapa_anterior, lag(data_hora_conversao) OVER w AS ts_etapa_anterior
    FROM gold WINDOW w AS (PARTITION BY lead_id ORDER BY list_position({_lst(STAGES)}, etapa_funil), data_hora_conversao))
  WHERE data_hora_conversao < ts_etapa_anterior""",
    "audit_score": """SELECT tipo_defeito, tp, fp, fn,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precisao,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall
  FROM (SELECT coalesce(d.tipo_defeito, l.tipo_defeito) AS tipo_defeito,
               count(CASE WHEN d.lead_id IS NOT NULL AND l.lead_id IS NOT NULL THEN 1 END) AS tp,
               count(CASE WHEN d.lead_id IS NOT NULL AND l.lead_id IS NULL THEN 1 END) AS fp,
               count(CASE WHEN d.lead_id IS NULL AND l.lead_id IS NOT NULL THEN 1 END) AS fn
        FROM (SELECT DISTINCT lead_id, tipo_defeito FROM (
                SELECT lead_id, 'hash_mal_normalizado' AS tipo_defeito FROM hash_audit WHERE phone_status = 'divergente'
                UNION ALL SELECT lead_id, 'multitouch' FROM multitouch
                UNION ALL SELECT lead_id, 'pago_sem_clickid' FROM paid_no_click
                UNION ALL SELECT lead_id, 'sem_click_id' FROM no_click_origin)) d
        FULL OUTER JOIN (SELECT DISTINCT lead_id, tipo_defeito FROM manifest) l
          ON d.lead_id = l.lead_id AND d.tipo_defeito = l.tipo_defeito
        GROUP BY 1)""",
}


_CTES = dict(re.findall(r"^(\w+) AS \((.*?)\)(?:,\n(?=\w+ AS \()|\n\Z)", PREAMBLE.removeprefix("WITH\n"), re.M | re.S))


def _with(body: str) -> str:
    """The CTEs that ``body`` reads, directly or not, each computed at most once."""
    needed, todo = set(), [body]
    while todo:
        text = todo.pop()
        found = {name for name in _CTES if re.search(rf"\b{name}\b", text)} - needed
        needed |= found
        todo += [_CTES[name] for name in found]
    texts = [body, *(_CTES[name] for name in needed)]

    def kept(name):  # what is read once need not be kept
        return "MATERIALIZED " if sum(len(re.findall(rf"\b{name}\b", t)) for t in texts) > 1 else ""
    ctes = ",\n".join(f"{name} AS {kept(name)}({sql})" for name, sql in _CTES.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _BODIES.items() if name not in ROWS_ONLY}
