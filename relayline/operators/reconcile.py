"""Reconciliation (M6, J5), latency (A11) and business cuts.

Reconciliation semantics are this build's own (the original only declares
the columns): accepted sends are crossed with the platform's report on
(plataforma, event_id); a matched report -> ``casado``; a report that says
unmatched, or no report once ``grace_days`` have passed since the last send
-> ``nao_casado``; otherwise ``pendente``. Rows that were not accepted keep
their reconciliation columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import days_before, ts_lit
from ..schemas import CONTROL, GOLD_KEY


def reconcile(control: DataFrame, report: DataFrame, as_of, grace_days: int = 3) -> DataFrame:
    rep = (report.groupBy("plataforma", "event_id")
                 .agg(F.max(F.col("matched").cast("int")).alias("_matched"),
                      F.max("reported_at").alias("_reported_at")))
    c = control.withColumn("event_id", F.concat(F.col("lead_id"), F.lit("_"), F.col("etapa_funil")))
    j = c.join(rep, ["plataforma", "event_id"], "left")
    accepted = F.col("status_envio") == "aceito"
    overdue = F.col("ts_ultimo_envio") < days_before(as_of, grace_days)
    status = (F.when(F.col("_matched") == 1, F.lit("casado"))
               .when((F.col("_matched") == 0) | (F.col("_matched").isNull() & overdue), F.lit("nao_casado"))
               .otherwise(F.lit("pendente")))
    return j.select(*[
        (F.when(accepted, status).otherwise(F.col("status_match")) if f.name == "status_match"
         else F.when(accepted, ts_lit(as_of)).otherwise(F.col("ts_reconciliacao")) if f.name == "ts_reconciliacao"
         else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in CONTROL.fields])


def valid_reports(reports: DataFrame, as_of) -> DataFrame:
    """The report of each event that holds at ``as_of``: its last one so far
    (a match wins a tie). One aggregation, combined map-side, so an event that
    is reported millions of times costs a row per task. What ``reconcile``
    makes of it follows later corrections in the next run."""
    return reports.where(F.col("reported_at") <= ts_lit(as_of)).groupBy("plataforma", "event_id").agg(
        F.max_by("matched", F.struct("reported_at", "matched")).alias("matched"), F.max("reported_at").alias("reported_at"))


def reports_as_of(moments: DataFrame, reports: DataFrame, slices: str = "day") -> DataFrame:
    """As-of join: every row of ``moments`` (plataforma, event_id, ts, ...)
    with ``matched`` and ``reported_at`` of the last report of its event up to
    ``ts``, or nulls.

    No range join: moments and reports are put in one sequence per event and
    the last report is carried along it. The sequence is cut into ``slices``
    of time (a ``date_trunc`` unit): the last report of each slice is found
    first (combined map-side) and carried over the slices, so that tasks hold
    a slice of an event and not a hot event.
    """
    key = ["plataforma", "event_id"]
    report = F.struct("reported_at", "matched")
    cut = lambda c: F.date_trunc(slices, c)
    left = moments.withColumn("_slice", cut("ts"))
    right = reports.where("plataforma IS NOT NULL AND event_id IS NOT NULL AND reported_at IS NOT NULL").select(
        *key, cut("reported_at").alias("_slice"), F.col("reported_at").alias("ts"), report.alias("_r"))
    ends = right.groupBy(*key, "_slice").agg(F.max("_r").alias("_last"))
    marks = ends.unionByName(left.select(*key, "_slice").distinct().withColumn(
        "_last", F.lit(None).cast(ends.schema["_last"].dataType))).groupBy(*key, "_slice").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select(*key, "_slice", F.last("_last", True).over(before).alias("_carried"))
    rows = left.select(*key, "_slice", "ts", F.struct(*moments.columns).alias("_m")).unionByName(
        right.withColumn("_m", F.lit(None)), allowMissingColumns=True)
    # reports go before moments of the same time; of equal times the largest report is last
    order = Window.partitionBy(*key, "_slice").orderBy(
        "ts", F.col("_m").isNotNull(), "_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("_seen", F.last("_r", True).over(order)).where("_m IS NOT NULL")
    on = [seen[c].eqNullSafe(carried[c]) for c in [*key, "_slice"]]
    found = seen.join(carried, on, "left").withColumn("_found", F.coalesce("_seen", "_carried"))
    return found.select("_m.*", "_found.matched", "_found.reported_at")


def latency_ms():
    """Milliseconds from the conversion to the first send attempt."""
    a = F.unix_micros(F.col("ts_primeiro_envio").cast("timestamp"))
    b = F.unix_micros(F.col("data_hora_conversao").cast("timestamp"))
    return F.floor((a - b) / F.lit(1000)).cast("bigint")


def send_latency(control: DataFrame) -> DataFrame:
    """Exact, mergeable latency aggregates per platform."""
    lat = control.where(F.col("ts_primeiro_envio").isNotNull()).withColumn("lat", latency_ms())
    return lat.groupBy("plataforma").agg(
        F.count("lat").alias("envios"),
        F.avg("lat").alias("latencia_media_ms"),
        F.min("lat").alias("latencia_min_ms"),
        F.max("lat").alias("latencia_max_ms"))


def send_latency_quantiles(control: DataFrame) -> DataFrame:
    """Median and p95 of the latency in whole minutes per platform: the
    smallest value that so many of the rows do not exceed. Exact, from counts
    per minute that combine map-side; the window sees one row per distinct
    minute, not per send."""
    minutes = control.where(F.col("ts_primeiro_envio").isNotNull()).select(
        "plataforma", F.floor(latency_ms() / F.lit(60_000)).cast("bigint").alias("minuto"))
    counts = minutes.groupBy("plataforma", "minuto").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("plataforma")
    upto = whole.orderBy("minuto").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))

    def quantile(hundredths: int):
        enough = F.col("upto") * 100 >= F.col("total") * hundredths
        return F.min(F.when(enough, F.col("minuto"))).alias(f"latencia_p{hundredths}_min")
    return placed.groupBy("plataforma").agg(quantile(50), quantile(95))


def business_cuts(control: DataFrame, gold: DataFrame) -> DataFrame:
    """Send, acceptance and match rates per platform, product and client size.

    The business attributes come from gold (J4: left join on lead and stage).
    """
    # one attribute row per key (aggregated map-side), so repeated gold keys
    # neither multiply the counts nor pile up on one task
    g = gold.groupBy(*GOLD_KEY).agg(F.max("produto").alias("produto"),
                                    F.max("porte_cliente").alias("porte_cliente"))
    j = control.join(g, GOLD_KEY, "left")
    acc = F.col("status_envio") == "aceito"
    return j.groupBy("plataforma", "produto", "porte_cliente").agg(
        F.count("*").alias("envios"),
        F.count(F.when(acc, 1)).alias("aceitos"),
        F.count(F.when(F.col("status_match") == "casado", 1)).alias("casados"),
        F.count(F.when(F.col("status_match").isNotNull(), 1)).alias("reconciliados"),
    ).select("*",
             (F.col("aceitos") / F.col("envios")).alias("taxa_aceite"),
             F.when(F.col("reconciliados") > 0, F.col("casados") / F.col("reconciliados")).alias("taxa_match"))


def business_totals(control: DataFrame, gold: DataFrame) -> DataFrame:
    """A12 with totals: the measures of ``business_cuts`` per platform, product
    and client size, per platform and product, per platform, and over all.

    One Expand and one aggregation (partial first): ``nivel`` is the grouping
    id (0 for the finest cut, 7 for the grand total), which tells a total from
    a group whose attribute is missing.
    """
    g = gold.groupBy(*GOLD_KEY).agg(F.max("produto").alias("produto"),
                                    F.max("porte_cliente").alias("porte_cliente"))
    cols = [F.col(c) for c in ("plataforma", "produto", "porte_cliente")]
    sets = [cols, cols[:2], cols[:1], []]
    acc = F.col("status_envio") == "aceito"
    return control.join(g, GOLD_KEY, "left").groupingSets(sets, *cols).agg(
        F.grouping_id().cast("int").alias("nivel"),
        F.count("*").alias("envios"),
        F.count(F.when(acc, 1)).alias("aceitos"),
        F.count(F.when(F.col("status_match") == "casado", 1)).alias("casados"),
        F.count(F.when(F.col("status_match").isNotNull(), 1)).alias("reconciliados"),
        F.sum(F.when(acc, F.col("valor_enviado"))).cast("decimal(28,2)").alias("valor_aceito"))


def open_sends(control: DataFrame, gold_by_day: DataFrame, as_of, grace_days: int, day: str) -> DataFrame:
    """Accepted sends still inside the grace of M6 with product and client
    size, from gold partitioned by ``day``: the days of the open sends' conversions,
    a list as short as the grace and the windows, prune gold's folders at run time."""
    sends = control.where((F.col("status_envio") == "aceito") & (F.col("ts_ultimo_envio") >= days_before(as_of, grace_days)))
    days = sends.select(F.to_date("data_hora_conversao").alias(day)).distinct()
    attributes = gold_by_day.join(F.broadcast(days), day, "left_semi").groupBy(*GOLD_KEY).agg(
        F.max("produto").alias("produto"), F.max("porte_cliente").alias("porte_cliente"))
    return sends.join(attributes, GOLD_KEY, "left").select(
        *GOLD_KEY, "plataforma", "ts_ultimo_envio", "produto", "porte_cliente")


def latency_sketches(control: DataFrame, k: int = 200) -> DataFrame:
    """One KLL sketch of the latency in whole minutes per platform and
    day of the first send; sketches of days merge into any longer span."""
    sends = control.where(F.col("ts_primeiro_envio").isNotNull())
    return sends.groupBy("plataforma", F.to_date("ts_primeiro_envio").alias("dia")).agg(
        F.kll_sketch_agg_bigint(F.floor(latency_ms() / F.lit(60_000)).cast("bigint"), k).alias("esboco"))


def sketched_latency(sketches: DataFrame, hundredths=(50, 95)) -> DataFrame:
    """Quantiles per platform from the daily sketches, merged."""
    merged = sketches.groupBy("plataforma").agg(F.kll_merge_agg_bigint("esboco").alias("esboco"))
    return merged.select("plataforma", F.kll_sketch_get_n_bigint("esboco").alias("envios"), *[
        F.kll_sketch_get_quantile_bigint("esboco", F.lit(q / 100)).alias(f"latencia_p{q}_min") for q in hundredths])


def sketch_check(control: DataFrame, sketched: DataFrame, hundredths=(50, 95), error: float = 0.02) -> DataFrame:
    """Per platform, whether the sketched quantiles lie within ``error`` of
    their rank among the exact latencies."""
    minutes = control.where(F.col("ts_primeiro_envio").isNotNull()).select(
        "plataforma", F.floor(latency_ms() / F.lit(60_000)).cast("bigint").alias("minuto"))
    counts = minutes.groupBy("plataforma", "minuto").agg(F.count(F.lit(1)).alias("n"))
    j = counts.join(sketched, "plataforma")
    exact = j.groupBy("plataforma").agg(F.first("envios").alias("envios"), F.sum("n").alias("_all"), *[
        F.sum(F.when(F.col("minuto") < F.col(f"latencia_p{q}_min"), F.col("n")).otherwise(0)).alias(f"_below{q}")
        for q in hundredths], *[
        F.sum(F.when(F.col("minuto") <= F.col(f"latencia_p{q}_min"), F.col("n")).otherwise(0)).alias(f"_upto{q}")
        for q in hundredths])
    return exact.select("plataforma", "envios", *[
        ((F.col(f"_below{q}") <= (q / 100 + error) * F.col("_all")) & (F.col(f"_upto{q}") >= (q / 100 - error) * F.col("_all")))
        .alias(f"p{q}_no_limite") for q in hundredths])
