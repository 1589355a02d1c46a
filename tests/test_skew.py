"""One key holding a third of all rows: results stay linear, plans stay skew-safe."""

from pyspark.sql import functions as F

from relayline.operators import control as ctl
from relayline.operators import quality as qa
from relayline.operators import reconcile as rec
from relayline.operators.eligibility import eligible
from relayline.operators.envelopes import assign_batches
from relayline.operators.routing import route
from relayline.sources import fixtures as fx

AS_OF = "2024-04-09 00:00:00"


def _hot_gold(spark):
    """Gold plus as many copies of one eligible key as there are other rows."""
    li = fx.table(spark, "/root/testdata/sf0.001", "lineitem")
    gold = fx.gold(li).cache()
    control = fx.control(gold)
    n = gold.count()
    key = (route(eligible(gold, control, AS_OF, carry=True))
           .orderBy("lead_id", "etapa_funil", "plataforma").select("lead_id", "etapa_funil").first())
    hot_row = gold.where((F.col("lead_id") == key[0]) & (F.col("etapa_funil") == key[1]))
    hot = (hot_row.select("*", F.explode(F.array_repeat(F.lit(1), n)).alias("_copy"))
                  .drop("_copy").repartition(4))
    return gold.unionByName(hot).cache(), control, n, key


def test_pipeline_linear_under_hot_key(spark):
    gold, control, n, key = _hot_gold(spark)
    is_hot = (F.col("lead_id") == key[0]) & (F.col("etapa_funil") == key[1])
    base = route(eligible(fx.gold(fx.table(spark, "/root/testdata/sf0.001", "lineitem")), control, AS_OF, carry=True))
    per_row = base.where(is_hot).count()  # platforms this key is routed to
    routed = route(eligible(gold, control, AS_OF, carry=True))
    assert routed.where(is_hot).count() == (n + 1) * per_row  # linear, not (n+1)^2
    assert routed.where(~is_hot).count() == base.where(~is_hot).count()
    sent = routed.select("lead_id", "etapa_funil", "plataforma", "data_hora_conversao", "campaign_id",
                         F.col("vl_faturamento_estimado").cast("decimal(18,2)").alias("valor_enviado"),
                         "identificador_usado", F.lit("aceito").alias("status_envio"),
                         F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("codigo_erro"),
                         F.lit("OK").alias("mensagem_resposta"),
                         F.lit(AS_OF).cast("timestamp_ntz").alias("ts_envio"))
    # the batch is deduplicated to one row per key; the hot target key is updated row by row
    hot_target = ctl.conform(sent.where(is_hot))
    hot_target = hot_target.withColumn("tentativas", F.lit(1)).withColumn("ts_ultimo_envio", F.col("data_hora_conversao")) \
        .withColumn("dt_atualizacao", F.col("data_hora_conversao"))
    merged = ctl.upsert(hot_target, sent, now=AS_OF)
    assert merged.where(is_hot).count() == (n + 1) * per_row
    assert merged.where(is_hot).agg(F.min("tentativas"), F.max("tentativas")).first() == (2, 2)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
    batches = assign_batches(routed, batch_size=100, n_buckets=8, as_of=AS_OF)
    assert batches.groupBy("plataforma", "batch_id").count().where("count > 100").count() == 0
    # audits aggregate before windows and look-ups
    assert qa.audit_stage_order(gold).where(F.col("lead_id") == key[0]).count() <= 3
    cuts = rec.business_cuts(merged, gold)
    assert cuts.agg(F.sum("envios")).first()[0] == merged.count()


def test_change_feed_under_hot_key(spark):
    gold, _, n, _ = _hot_gold(spark)
    before = ctl.conform(gold.select("lead_id", "etapa_funil", F.lit("google").alias("plataforma"),
                                     "data_hora_conversao", F.lit("gclid").alias("identificador_usado"),
                                     F.lit("erro").alias("status_envio"), F.lit(1).alias("tentativas"),
                                     F.col("data_hora_conversao").alias("ts_ultimo_envio"),
                                     F.col("data_hora_conversao").alias("dt_atualizacao")))
    after = ctl.apply_retry_policy(before.withColumn("tentativas", F.lit(5)), 3)
    ch = ctl.changes(before, after)
    counts = {r[0]: r[1] for r in ch.groupBy("_change_type").count().collect()}
    total = before.count()
    assert counts == {"update_preimage": total, "update_postimage": total}
