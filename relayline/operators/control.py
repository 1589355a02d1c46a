"""Control-table operations.

There is no transactional table format on the classpath, so every change is
a DataFrame that describes the *next* version of the table; the caller
writes it as a new snapshot (``sources.tables.SnapshotTable``) and swaps the
view. The upsert joins on the three-part key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cache import expression_cache
from ..functions.timefmt import ts_lit
from ..schemas import (CONTROL, CONTROL_COLUMNS, CONTROL_NOT_NULL, KEY, PLATFORMS, SEND_RESULT_COLUMNS,
                       SEND_STATUSES, STAGES)


COPIES = 4096  # copies of one changed row generated per array


@expression_cache
def _conform_exprs(present: frozenset) -> list:
    return [(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CONTROL.fields]


def conform(df: DataFrame) -> DataFrame:
    """Cast to the control schema; missing columns become NULL."""
    return df.select(*_conform_exprs(frozenset(df.columns)))


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT with an explicit column list: unlisted columns are NULL."""
    return conform(target).unionByName(conform(rows))


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """DELETE ... WHERE predicate: rows where it is NULL are kept."""
    return target.where(~F.coalesce(predicate, F.lit(False)))


@expression_cache
def _key_guard(what: str):
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in KEY])
    return F.when(null_key, F.raise_error(F.lit(f"NULL key in {what}"))).otherwise(F.lit(True))


def refuse_null_keys(df: DataFrame, what: str = "MERGE source") -> DataFrame:
    """Fail the job (at execution, not on the driver) if a key column is NULL."""
    return df.where(_key_guard(what))


def dedupe_batch(batch: DataFrame) -> DataFrame:
    """One source row per key: the latest ``ts_envio``, ties broken by every column.

    An aggregation (``max_by``) with map-side partial aggregation, not a sort.
    """
    others = [c for c in SEND_RESULT_COLUMNS if c not in KEY and c != "ts_envio"]
    order = F.struct(F.col("ts_envio"), *[F.col(c) for c in others])
    row = F.struct(*[F.col(c) for c in SEND_RESULT_COLUMNS])
    rest = [c for c in SEND_RESULT_COLUMNS if c not in KEY]
    # keys come from the grouping output, not the struct, so the result keeps
    # its hash partitioning on KEY and the upsert join does not shuffle it again
    return (batch.groupBy(*KEY).agg(F.max_by(row, order).alias("_r"))
                 .select(*KEY, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def upsert(target: DataFrame, batch: DataFrame, now) -> DataFrame:
    """M1: MERGE the send results into the control table.

    Matched rows take status, HTTP code, error, message, value and identifier
    from the batch, ``tentativas + 1``, ``ts_ultimo_envio = ts_envio`` and
    ``dt_atualizacao = now``; they keep conversion time, campaign, first send
    and reconciliation columns. Unmatched batch rows are inserted with one
    attempt and both send times equal to ``ts_envio``. Duplicate target keys
    are each updated; duplicate batch keys are reduced to the latest row, NULL
    batch keys fail the job.

    Plan: batch rows and target keys are aggregated together by key (partial
    aggregates first), which reduces the batch to one row per key and says
    which keys the target has; the target then takes its updates from that
    table in a left join, and its other rows are the inserts. Two shuffles.
    The join buffers one row per key on its build side, so a key repeated
    millions of times in the target streams through (a full outer sort-merge
    join would buffer all of them, and AQE cannot split it).
    """
    src = refuse_null_keys(batch.select(*SEND_RESULT_COLUMNS))
    # the sending time first: the greatest struct is the latest row, and the row is moved once
    rest = ["ts_envio", *[c for c in SEND_RESULT_COLUMNS if c not in KEY and c != "ts_envio"]]
    rows = src.select(*KEY, F.struct(*rest).alias("_r"), F.lit(True).alias("_s"))
    keys = conform(target).select(*KEY, F.lit(True).alias("_in"))
    # _s apart from _r: a reader that needs no column of the batch moves none
    per_key = (rows.unionByName(keys, allowMissingColumns=True).groupBy(*KEY)
                   .agg(F.max("_r").alias("_r"), F.max("_in").alias("_in"), F.max("_s").alias("_s"))
                   .where(F.col("_s")))
    s = per_key.select(*KEY, *[F.col(f"_r.{c}").alias(c) for c in rest], "_in", "_s")
    updated = conform(target).alias("t").join(s.alias("s"), _join_on_key(), "left").select(*_updated_exprs(str(now)))
    inserted = s.where(F.col("_in").isNull()).select(*_inserted_exprs(str(now)))
    return updated.unionByName(inserted)


@expression_cache
def _join_on_key() -> list:
    return [F.col(f"t.{k}") == F.col(f"s.{k}") for k in KEY]


def _updated_exprs(now: str) -> list:
    """Target row after a left join with the batch (aliases ``t`` and ``s``)."""
    hit = F.col("s._s").isNotNull()

    def tv(c):
        return F.col(f"t.{c}")

    def sv(c):
        return F.col(f"s.{c}")

    upd = {c: tv(c) for c in CONTROL_COLUMNS}
    for c in _FROM_BATCH:
        upd[c] = F.when(hit, sv(c)).otherwise(tv(c))
    upd["tentativas"] = F.when(hit, tv("tentativas") + 1).otherwise(tv("tentativas"))
    upd["ts_ultimo_envio"] = F.when(hit, sv("ts_envio")).otherwise(tv("ts_ultimo_envio"))
    upd["dt_atualizacao"] = F.when(hit, ts_lit(now)).otherwise(tv("dt_atualizacao"))
    return [upd[f.name].cast(f.dataType).alias(f.name) for f in CONTROL.fields]


def _inserted_exprs(now: str) -> list:
    """A batch row inserted as a new control row."""
    ins = {c: F.col(c) for c in ["lead_id", "etapa_funil", "plataforma", "data_hora_conversao", "campaign_id",
                                  *_FROM_BATCH]}
    ins.update({"tentativas": F.lit(1), "ts_primeiro_envio": F.col("ts_envio"), "ts_ultimo_envio": F.col("ts_envio"),
                "status_match": F.lit(None), "ts_reconciliacao": F.lit(None), "dt_atualizacao": ts_lit(now)})
    return [ins[f.name].cast(f.dataType).alias(f.name) for f in CONTROL.fields]


_FROM_BATCH = ["valor_enviado", "identificador_usado", "status_envio", "http_status", "codigo_erro",
               "mensagem_resposta"]


def key_counts(control: DataFrame) -> DataFrame:
    """Rows per three-part key."""
    return control.groupBy(*KEY).agg(F.count("*").alias("qtd"))


def duplicates(control: DataFrame) -> DataFrame:
    """Keys held by more than one row (the primary key is informational)."""
    return key_counts(control).where(F.col("qtd") > 1)


def row_rules() -> dict[str, Column]:
    """NOT NULL and CHECK rules by name: a predicate that holds for broken rows."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in CONTROL_NOT_NULL}
    for column, domain in (("etapa_funil", STAGES), ("plataforma", PLATFORMS), ("status_envio", SEND_STATUSES)):
        rules[f"check:{column}"] = F.coalesce(~F.col(column).isin(*domain), F.lit(False))
    return rules


def violations(control: DataFrame) -> DataFrame:
    """One row per broken rule: NOT NULL, CHECK domains, duplicate key.

    A NULL passes a CHECK, as in SQL; NOT NULL is its own rule.
    """
    rules = F.array(*[F.when(cond, F.lit(name)) for name, cond in row_rules().items()])
    per_row = (control.select(*KEY, F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("regra")))
    dup = duplicates(control).select(*KEY, F.lit("pk_duplicate").alias("regra"))
    return per_row.unionByName(dup)


def summary(control: DataFrame, lead_id: str | None = None) -> DataFrame:
    """A10: row count and highest attempt count, optionally for one lead."""
    df = control if lead_id is None else control.where(F.col("lead_id") == lead_id)
    return df.agg(F.count("*").alias("total"), F.max("tentativas").alias("tentativas_max"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row-level change feed between two versions of the table.

    Rows only in ``after`` are inserts or update post-images (when their key
    existed before); rows only in ``before`` are deletes or update pre-images;
    repeated rows count with their multiplicity. Two aggregations over the
    union of both versions (signed row counts by all columns; key presence by
    key), both combined map-side, and one join on the key (NULL-safe, since
    a NULL key is still a key here). No pairing of rows inside a key.
    """
    e = _change_exprs()
    u = (conform(before).withColumn("_side", F.lit(-1))
         .unionByName(conform(after).withColumn("_side", F.lit(1))))
    net = u.groupBy(*CONTROL_COLUMNS).agg(e["net"]).where(e["changed"])
    presence = u.groupBy(*KEY).agg(*e["presence"]).select(*e["presence_cols"])
    j = net.join(presence, e["on"], "inner")
    # one row per copy, generated in chunks: no array holds more than COPIES
    return (j.select(*CONTROL_COLUMNS, e["kind"], e["copies"], e["chunk"])
             .withColumn("_copy", F.explode(e["in_chunk"])).drop("_copies", "_chunk", "_copy"))


@expression_cache
def _change_exprs() -> dict:
    side = F.col("_side")
    return {
        "net": F.sum(side).alias("_net"),
        "changed": F.col("_net") != 0,
        "presence": [F.max((side < 0).cast("int")).alias("_in_before"),
                     F.max((side > 0).cast("int")).alias("_in_after")],
        "presence_cols": [*[F.col(k).alias(f"_p_{k}") for k in KEY], "_in_before", "_in_after"],
        "on": [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in KEY],
        "kind": (F.when((F.col("_net") < 0) & (F.col("_in_after") == 1), F.lit("update_preimage"))
                  .when(F.col("_net") < 0, F.lit("delete"))
                  .when(F.col("_in_before") == 1, F.lit("update_postimage"))
                  .otherwise(F.lit("insert"))).alias("_change_type"),
        "copies": F.abs(F.col("_net")).alias("_copies"),
        "chunk": F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.abs(F.col("_net")) - 1) / COPIES))).alias("_chunk"),
        "in_chunk": F.sequence(F.col("_chunk") * COPIES,
                               F.least(F.col("_copies"), (F.col("_chunk") + 1) * COPIES) - 1),
    }


def apply_retry_policy(control: DataFrame, max_attempts: int = 3) -> DataFrame:
    """M5: an error after ``max_attempts`` tries becomes a dead letter."""
    dead = (F.col("status_envio") == "erro") & (F.col("tentativas") >= max_attempts)
    return control.withColumn("status_envio", F.when(dead, F.lit("dead_letter")).otherwise(F.col("status_envio")))


__all__ = ["append", "apply_retry_policy", "changes", "conform", "CONTROL_COLUMNS", "dedupe_batch",
           "delete_where", "duplicates", "key_counts", "refuse_null_keys", "summary", "upsert", "violations"]
