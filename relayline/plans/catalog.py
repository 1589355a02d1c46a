"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Parameters are fixed here so that every run (tests, oracle check, bench)
sees the same plan: ``AS_OF`` replaces ``current_timestamp()``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import contacts, hash_email, hash_phone, normalize_email, normalize_phone
from ..functions.timefmt import DEFAULT_AS_OF
from ..operators import answers as ans
from ..operators import byte_bodies as bb
from ..operators import colocated
from ..operators import compaction
from ..operators import control as ctl
from ..operators import distincts
from ..operators import envelopes as env
from ..operators import feed
from ..operators import payloads as pay
from ..operators import quality as qa
from ..operators import reconcile as rec
from ..operators import responses as resp
from ..operators.eligibility import candidates, eligible
from ..schemas import CONTROL
from ..sources.fixtures import lead_number, odd_answers, routed, routed_by_join, table
from ..sources.layout import DAY
from ..sources.store import Fixtures
from ..sources.tables import SnapshotTable

AS_OF = DEFAULT_AS_OF
FROZEN_AT = "2024-04-10 00:00:00"  # a day later: rows on the edge of a window fall out
ONE_LEAD = "lead_22"  # present at every scale
BATCH_SIZE = 50
N_BUCKETS = None  # slices follow the session; they change no batch
MAX_ATTEMPTS = 3
GRACE_DAYS = 3
NEXT_RUN = "2024-04-11 00:00:00"  # some reports were corrected by then
COMPACT_ROWS = 500  # fragments of fewer rows are grouped
BODY_BYTES = 4000
LEAD_ROLLUPS = [["plataforma", "etapa_funil"], ["plataforma"], ["etapa_funil"], ["dia"], []]

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------ building blocks

def _fx(s, d) -> Fixtures:
    return Fixtures(s, d, as_of=AS_OF, batch_size=BATCH_SIZE, n_buckets=N_BUCKETS, frozen_at=FROZEN_AT)


def _gold(s, d):
    return _fx(s, d).gold()


def _control(s, d):
    return _fx(s, d).control()


def _eligible(s, d, **kw):
    f = _fx(s, d)
    return eligible(f.gold(), f.control(), AS_OF, **kw)


def _routed(s, d):
    f = _fx(s, d)
    return routed(f.gold(), f.control(), AS_OF)


def _appended(s, d):
    f = _fx(s, d)
    # some rows break a NOT NULL and some a CHECK rule
    k9 = F.pmod(lead_number(), F.lit(9))
    listed = f.send_results().select(
        "lead_id", "etapa_funil", "plataforma", "data_hora_conversao",
        F.when(k9 != 1, F.col("identificador_usado")).alias("identificador_usado"),
        F.when(k9 == 2, F.lit("enviado")).otherwise(F.col("status_envio")).alias("status_envio"),
        F.lit(1).alias("tentativas"), F.col("ts_envio").alias("ts_ultimo_envio"),
        F.col("ts_envio").alias("dt_atualizacao"))
    return ctl.append(f.control(), listed)


def _upserted(s, d):
    f = _fx(s, d)
    return ctl.upsert(f.control(), f.send_results(), now=AS_OF)


def _upserted_twice(s, d):
    f = _fx(s, d)
    batch = f.send_results()
    return ctl.upsert(ctl.upsert(f.control(), batch, now=AS_OF), batch, now=AS_OF)


def _batched(s, d):
    return env.assign_batches(_routed(s, d), batch_size=BATCH_SIZE, n_buckets=N_BUCKETS, as_of=FROZEN_AT)


def _batched_sends(s, d):
    """The same batches as written, from which the answers are made too."""
    return _fx(s, d).batched_sends()


def _reconciled(s, d):
    return rec.reconcile(_upserted(s, d), _fx(s, d).platform_report(), AS_OF, GRACE_DAYS)


def _after_cleaning(s, d):
    """The upserted table without its dead letters."""
    return ctl.delete_where(_upserted(s, d), F.col("status_envio") == "dead_letter")


def _composed(s, d):
    """The middle version and the feeds of both steps are read several times, so
    each is written once, as the next snapshot and its feed would be."""
    f = _fx(s, d)
    a, b = f.control(), f.version("upserted", lambda: _upserted(s, d))
    c = ctl.delete_where(ctl.upsert(b, f.send_results(), now=AS_OF), F.col("status_envio") == "dead_letter")
    return feed.compose(f.feed("feed_upserted", lambda: ctl.changes(a, b)),
                        f.feed("feed_cleaned", lambda: ctl.changes(b, c)))


def _fragments(s, d):
    """Rows that each day's sends appended per platform, as one file each."""
    return _control(s, d).groupBy("plataforma", F.to_date("ts_ultimo_envio").alias("fragmento")).agg(
        F.count(F.lit(1)).alias("linhas"))


def _moments(s, d):
    return _control(s, d).where("status_envio = 'aceito'").select(
        "plataforma", F.concat_ws("_", "lead_id", "etapa_funil").alias("event_id"),
        (F.col("ts_ultimo_envio") + F.expr(f"INTERVAL {GRACE_DAYS} DAYS")).alias("ts"))


def _envelopes(s, d):
    return env.envelopes(_batched(s, d), env.EnvelopeConfig(
        meta_test_event_code="TEST123", google_operating_account="1234567890", google_default_destination="0"))


def _envelope_files(s, d):
    """Requests written as text (S16), read back and parsed."""
    path = _fx(s, d).folder("envelope_files", lambda p: env.write_envelopes(_envelopes(s, d), p))
    read = env.read_written(s, path).withColumn("n_events", F.lit(0).cast("long"))
    return pay.read_envelopes(read).drop("n_events")


def _published(s, d):
    """Two full versions written one after the other, the second one
    published under a name in a namespace, and the name read."""
    f = _fx(s, d)
    table = SnapshotTable(s, f"{f._root()}/published", CONTROL, ["lead_id"])
    for tag, rows in (("first", f.control()), ("second", _after_cleaning(s, d))):
        if table.tagged(tag) is None:
            table.write(rows, tag=tag)
    name = f"control_{f._identity()}"
    table.publish_table("relayline", name)
    return s.table(f"relayline.{name}")


def _event_bytes():
    """Bytes of an event's texts and a fixed part, as any SQL engine counts them."""
    texts = ["lead_id", "etapa_funil", "email_hashed", "phone_hashed", "gclid", "fbclid", "msclkid"]
    return F.octet_length(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in texts])) + 60


def _read_answers(s, d):
    return ans.read(odd_answers(_fx(s, d).responses(), _fx(s, d).batched_sends()))


def _two_runs(s, d):
    reports, control, out = _fx(s, d).report_history(), _upserted(s, d), None
    for number, as_of in enumerate((AS_OF, NEXT_RUN), 1):
        control = rec.reconcile(control, rec.valid_reports(reports, as_of), as_of, GRACE_DAYS)
        rows = control.select("lead_id", "etapa_funil", "plataforma", F.lit(number).alias("rodada"), "status_match")
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------- queries

QUERIES: dict[str, Query] = {
    # sources and eligibility
    "gold_conversions": lambda s, d: _gold(s, d),
    "control_table": _control,
    "candidates_windowed": lambda s, d: candidates(_gold(s, d), AS_OF),
    "candidates_unwindowed": lambda s, d: candidates(_gold(s, d), AS_OF, windowed=False),
    "eligible": lambda s, d: _eligible(s, d),
    "eligible_future_guard": lambda s, d: _eligible(s, d, future_guard=True),
    "eligible_block_dead_letter": lambda s, d: _eligible(s, d, block_dead_letter=True),
    "eligible_total": lambda s, d: qa.eligible_total(_eligible(s, d)),
    "eligible_by_platform": lambda s, d: qa.by_platform(_eligible(s, d)),
    "eligible_one_lead": lambda s, d: (_eligible(s, d, windowed=False)
                                       .where(F.col("lead_id") == ONE_LEAD).select("lead_id", "plataforma")),
    "eligible_by_day": lambda s, d: eligible(_fx(s, d).gold_by_day(), _control(s, d), AS_OF, day=DAY),
    "eligible_colocated": lambda s, d: colocated.eligible(
        _fx(s, d).gold_colocated(), _fx(s, d).control_colocated(), AS_OF),
    # routing
    "routed": _routed,
    "routed_quality_counts": lambda s, d: qa.routed_quality_counts(_routed(s, d)),
    "routed_duplicate_gold": lambda s, d: routed(_fx(s, d).gold_with_duplicates(), _control(s, d), AS_OF),
    "routed_by_join": lambda s, d: routed_by_join(_fx(s, d).gold_with_duplicates(), _control(s, d), AS_OF),
    "gold_key_duplicates": lambda s, d: qa.gold_key_duplicates(_fx(s, d).gold_with_duplicates()),
    # identity
    "email_normalized": lambda s, d: _fx(s, d).raw().select(
        "lead_id", "email_raw", normalize_email("email_raw").alias("email_normalizado")),
    "phone_normalized": lambda s, d: _fx(s, d).raw().select(
        "lead_id", "phone_raw", normalize_phone("phone_raw").alias("phone_normalizado")),
    "pii_hashes": lambda s, d: _fx(s, d).raw().select(
        "lead_id", hash_email("email_raw").alias("email_hashed"), hash_phone("phone_raw").alias("phone_hashed")),
    "document_contacts": lambda s, d: contacts(table(s, d, "documents")),
    # payloads and envelopes
    "payload_meta": lambda s, d: pay.meta_flat(_routed(s, d)),
    "payload_google": lambda s, d: pay.google_flat(_routed(s, d)),
    "payload_bing": lambda s, d: pay.bing_flat(_routed(s, d)),
    "payload_json": lambda s, d: pay.read_payloads(pay.build(_routed(s, d))),
    "envelope_batches": lambda s, d: _batched(s, d).select(
        "plataforma", "batch_id", "position", "lead_id", "etapa_funil"),
    "envelope_sizes": lambda s, d: env.envelopes(_batched(s, d)).select("plataforma", "batch_id", "n_events"),
    "envelopes": lambda s, d: pay.read_envelopes(_envelopes(s, d)),
    "envelope_files": _envelope_files,
    "envelope_byte_bodies": lambda s, d: bb.pack(_batched(s, d), _event_bytes(), BODY_BYTES).select(
        "plataforma", "bucket", "batch_id", "position", "size", "corpo"),
    # QA aggregates
    "lead_counts": lambda s, d: qa.lead_counts(_gold(s, d)),
    "multi_stage_top5": lambda s, d: qa.multi_stage_top(_gold(s, d), 5),
    "hash_length": lambda s, d: qa.hash_length(_gold(s, d)),
    "age_regime": lambda s, d: qa.age_regime(_gold(s, d), AS_OF),
    "origin_rollup": lambda s, d: qa.origin_rollup(_gold(s, d)),
    "stage_counts": lambda s, d: qa.stage_counts(_gold(s, d)),
    "identifier_coverage": lambda s, d: qa.identifier_coverage(_gold(s, d)),
    "lead_distincts": lambda s, d: distincts.distinct_leads(
        distincts.lead_bitmaps(candidates(_gold(s, d), windowed=False)), LEAD_ROLLUPS),
    # control table
    "control_published": _published,
    "control_append": _appended,
    "control_duplicates": lambda s, d: ctl.duplicates(_appended(s, d)),
    "control_violations": lambda s, d: ctl.violations(_appended(s, d)),
    "control_delete": lambda s, d: ctl.delete_where(_control(s, d), F.col("status_envio") == "dead_letter"),
    "control_upsert": _upserted,
    "control_upsert_twice": _upserted_twice,
    "control_summary": lambda s, d: ctl.summary(_upserted_twice(s, d)),
    "control_summary_one_lead": lambda s, d: ctl.summary(_upserted_twice(s, d), ONE_LEAD),
    "control_changes": lambda s, d: ctl.changes(_control(s, d), ctl.delete_where(
        _upserted(s, d), F.col("status_envio") == "dead_letter")),
    "control_upsert_colocated": lambda s, d: colocated.upsert(
        _fx(s, d).control_colocated(), _fx(s, d).send_results(), now=AS_OF),
    "control_merge_feed": lambda s, d: feed.merge_feed(_control(s, d), _fx(s, d).send_results(), AS_OF),
    "control_feed_applied": lambda s, d: feed.apply(_control(s, d), ctl.changes(_control(s, d), _after_cleaning(s, d))),
    "control_feed_reverted": lambda s, d: feed.apply(
        _after_cleaning(s, d), feed.invert(ctl.changes(_control(s, d), _after_cleaning(s, d)))),
    "control_feed_composed": _composed,
    "compaction_groups": lambda s, d: compaction.file_groups(
        _fragments(s, d), ["plataforma"], "fragmento", "linhas", COMPACT_ROWS),
    "eligible_after_upsert": lambda s, d: eligible(_gold(s, d), _upserted(s, d), AS_OF),
    "retry_state": lambda s, d: ctl.apply_retry_policy(_upserted(s, d), MAX_ATTEMPTS),
    # responses, reconciliation, monitoring
    "responses_classified": lambda s, d: resp.classify(
        _batched_sends(s, d), _fx(s, d).responses()).drop("mensagem_resposta"),
    "answers_quarantined": lambda s, d: ans.quarantine(_read_answers(s, d)).select(
        "plataforma", "batch_id", "http_status", "motivo"),
    "answers_record_errors": lambda s, d: ans.record_errors(_read_answers(s, d)),
    "answers_classified": lambda s, d: ans.classify(_batched_sends(s, d), _read_answers(s, d)).drop("mensagem_resposta"),
    "control_after_responses": lambda s, d: ctl.apply_retry_policy(ctl.upsert(
        _control(s, d), resp.classify(_batched_sends(s, d), _fx(s, d).responses()), now=AS_OF),
        MAX_ATTEMPTS).drop("mensagem_resposta"),
    "reconciled": _reconciled,
    "send_latency": lambda s, d: rec.send_latency(_control(s, d)),
    "send_latency_quantiles": lambda s, d: rec.send_latency_quantiles(_control(s, d)),
    "send_latency_sketched": lambda s, d: rec.sketch_check(
        _control(s, d), rec.sketched_latency(rec.latency_sketches(_control(s, d)))),
    "open_sends": lambda s, d: rec.open_sends(_control(s, d), _fx(s, d).gold_by_day(), AS_OF, GRACE_DAYS, DAY),
    "reports_as_of": lambda s, d: rec.reports_as_of(_moments(s, d), _fx(s, d).report_history()),
    "reconciled_corrected": _two_runs,
    "business_totals": lambda s, d: rec.business_totals(_reconciled(s, d), _gold(s, d)),
    "business_cuts": lambda s, d: rec.business_cuts(_reconciled(s, d), _gold(s, d)),
    # audits
    "audit_hash": lambda s, d: qa.audit_hash(_fx(s, d).raw(), _gold(s, d)),
    "audit_hash_summary": lambda s, d: qa.audit_hash_summary(_fx(s, d).raw(), _gold(s, d)),
    "audit_multitouch": lambda s, d: qa.audit_multitouch(_gold(s, d)),
    "audit_paid_no_click": lambda s, d: qa.audit_paid_no_click(_gold(s, d)),
    "audit_no_click_origin": lambda s, d: qa.audit_no_click_origin(_gold(s, d)),
    "audit_future": lambda s, d: qa.audit_future(_gold(s, d), AS_OF),
    "audit_stage_order": lambda s, d: qa.audit_stage_order(_gold(s, d)),
    "audit_score": lambda s, d: qa.audit_score(_fx(s, d).raw(), _gold(s, d), _fx(s, d).manifest()),
}

# Queries that SQL cannot express: none.
ROWS_ONLY: set[str] = set()
