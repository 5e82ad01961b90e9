"""Streaming: R1-R5. Each stream runs over the whole given table to its end,
into a scratch folder, and the folder is read back."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from anamnesis.session import materialize, scratch_path
from anamnesis.sources.artifacts import write_model
from anamnesis.sources.store import Store
from anamnesis.streaming import arrivals, inputs, jobs, sinks

from .modeling import trained
from .registry import query
from .replies import _LEVEL


def log_stream(t):
    """The whole log in four files, dealt by a hash, one per micro-batch: so most rows
    of a batch are older than some of the batch before."""
    folder = scratch_path(t.spark, "log")
    t.state_log.repartition(4, F.xxhash64("seq")).write.parquet(folder)
    return inputs.parquet_stream(t.spark, folder, maxFilesPerTrigger=1)


def upserted(t, df, keys):
    path = scratch_path(t.spark, "stream")
    sinks.upsert_to(df, path, f"{path}-checkpoint").awaitTermination()
    return sinks.read_upserts(t.spark, path, keys)


@query("r1_score_stream", f"""SELECT guid, CASE doc_id % 41 WHEN 0 THEN 'blank' WHEN 1 THEN 'missing' ELSE 'ok' END AS outcome,
  CASE WHEN doc_id % 41 > 1 THEN {_LEVEL} ELSE -9 END AS level, doc_id % 41 > 1 AS in_scale FROM interviews""")
def r1_score_stream(t):
    """All texts arriving, some of them blank or missing, scored with the newest forest."""
    _, forest = trained(t)
    arrived = scratch_path(t.spark, "arrived")
    odd = F.col("doc_id") % 41
    text = F.when(odd == 0, " \n").when(odd > 1, F.col("texto"))
    t.planted.select("guid", F.col("nombre_fichero").alias("filename"), text.alias("texto")).write.parquet(arrived)
    scored = jobs.score_stream(inputs.parquet_stream(t.spark, arrived), forest)
    path = scratch_path(t.spark, "stream")
    sinks.append_to(scored, path, f"{path}-checkpoint").awaitTermination()
    return t.spark.read.parquet(path).select(
        "guid", F.coalesce("entrada_error", F.lit("ok")).alias("outcome"),
        F.coalesce("nivel_triaje_llm", F.lit(-9)).alias("level"),
        F.coalesce(F.col("nivel_triaje_predicho").between(1, 5), F.lit(False)).alias("in_scale"))


@query("r1_store_stream", f"""SELECT guid, 'COMPLETADA' AS estado, {_LEVEL} AS level, 1 AS n_predictions, true AS in_scale, true AS rated
  FROM interviews WHERE doc_id % 41 > 1""")
def r1_store_stream(t):
    """Arriving texts, some blank or missing, over four micro-batches into the store's tables; every
    micro-batch then runs again, as it may after a crash."""
    _, forest = trained(t)
    store = Store(t.spark, scratch_path(t.spark, "store")).prepare()
    write_model(t.spark, forest, store.models, datetime(2024, 1, 1, tzinfo=timezone.utc))
    arrived = scratch_path(t.spark, "arrived")
    odd = F.col("doc_id") % 41
    text = F.when(odd == 0, " \n").when(odd > 1, F.col("texto"))
    t.planted.select("guid", F.col("nombre_fichero").alias("filename"), text.alias("texto")).repartition(
        4, "guid").write.parquet(arrived)
    for _ in range(2):
        stream = inputs.parquet_stream(t.spark, arrived, maxFilesPerTrigger=1)
        sinks.scores_to_store(stream, store, "desk", scratch_path(t.spark, "checkpoint")).awaitTermination()
    predictions = store.read("predictions")
    told = predictions.groupBy("guid").agg(
        F.count("*").cast("int").alias("n_predictions"), F.min("prediccion_modelo").alias("p"), F.min("confianza").alias("c"), F.min("valoracion").alias("v"))
    results = store.read("annotations").select("guid", F.col("nivel_triaje").alias("level"))
    due = F.round(F.greatest(F.lit(0).cast("decimal(20,15)"), F.col("c").cast("decimal(20,15)") - F.abs(F.col("p") - F.col("level")) * F.lit(0.25).cast("decimal(3,2)")) * 10, 1)
    return store.cases([]).join(results, "guid").join(told, "guid").select(
        "guid", "estado", "level", "n_predictions", F.col("p").between(1, 5).alias("in_scale"),
        (due.cast("double") == F.col("v")).alias("rated"))


@query("r2_running_state_counts", "SELECT estado, count(*) AS n FROM state_log GROUP BY estado")
def r2_running_state_counts(t):
    return upserted(t, jobs.running_state_counts(log_stream(t)), ["estado"])


_WINDOW = "epoch_us(ts) // 10800000000 * 10800000000"


@query("r3_tumbling_throughput", f"""SELECT {_WINDOW} AS window_start, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us
  FROM state_log WHERE event_type IN ('view', 'click') GROUP BY 1""")
def r3_tumbling_throughput(t):
    ended = log_stream(t).where("event_type IN ('view', 'click')")
    rows = upserted(t, jobs.windowed_throughput(ended, late="400 days"), ["window_start"])
    return rows.select(F.unix_micros("window_start").alias("window_start"), "n",
                       F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"))


@query("r3_sliding_throughput", """WITH s AS (SELECT epoch_us(ts) // 3600000000 * 3600000000 - h * 3600000000 AS window_start
  FROM state_log, (SELECT unnest([0, 1, 2]) AS h) WHERE event_type IN ('view', 'click'))
SELECT window_start, count(*) AS n FROM s GROUP BY 1""")
def r3_sliding_throughput(t):
    ended = log_stream(t).where("event_type IN ('view', 'click')")
    rows = upserted(t, jobs.windowed_throughput(ended, slide="1 hour", late="400 days"), ["window_start"])
    return rows.select(F.unix_micros("window_start").alias("window_start"), "n")


@query("r4_first_arrivals", """SELECT concat('CAS', user_id, '.txt') AS nombre_fichero, epoch_us(min(ts)) AS at,
  arg_min(seq, row(ts, seq)) AS arrival FROM state_log GROUP BY user_id""")
def r4_first_arrivals(t):
    """The earliest arrival of each file name. Files come one per micro-batch, dealt
    by a hash, so a name's arrivals come in no order; the watermark spans the table,
    and a last arrival far behind lets it pass."""
    folder = scratch_path(t.spark, "files")
    name = F.concat(F.lit("CAS"), F.col("user_id").cast("string"), F.lit(".txt"))
    files = t.state_log.select(name.alias("nombre_fichero"), "ts", F.col("seq").cast("long").alias("arrival"))
    files.repartition(3, F.xxhash64("arrival")).write.parquet(folder)
    last = t.state_log.agg(F.max("ts").alias("ts")).select(
        F.lit("closing").alias("nombre_fichero"), F.expr("ts + INTERVAL 400 DAYS").alias("ts"), F.lit(-1).cast("long").alias("arrival"))
    last.coalesce(1).write.mode("append").parquet(folder)
    path = scratch_path(t.spark, "stream")
    stream = inputs.parquet_stream(t.spark, folder, maxFilesPerTrigger=1, latestFirst=False)
    sinks.append_to(arrivals.first_arrivals(stream, "180 days"), path, f"{path}-checkpoint", rocksdb=True).awaitTermination()
    return t.spark.read.parquet(path).where("nombre_fichero <> 'closing'").select(
        "nombre_fichero", F.unix_micros("ts").alias("at"), "arrival")


@query("r5_paired_latencies", """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS guid, event_type, ts FROM state_log
  WHERE event_type IN ('view', 'purchase')),
f AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY guid ORDER BY ts) < INTERVAL 1 DAY THEN 0 ELSE 1 END AS fresh FROM e),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY guid ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM f),
c AS (SELECT guid, n, min(ts) FILTER (WHERE event_type = 'view') AS a, max(ts) FILTER (WHERE event_type = 'purchase') AS b
  FROM s GROUP BY guid, n)
SELECT guid, epoch_us(a) AS started_us, epoch_us(b) AS ended_us, (epoch_us(b) - epoch_us(a)) / 1000000 AS seconds FROM c WHERE b >= a""")
def r5_paired_latencies(t):
    """Cases run over days and midnights; their events come in several batches.

    A last event far behind all others lets the watermark pass every session.
    """
    folder = scratch_path(t.spark, "log")
    log = t.state_log.withColumn("guid", F.col("user_id").cast("string"))
    log.repartition(4, "seq").write.parquet(folder)
    closing = log.agg(F.max("ts").alias("ts")).select(
        F.lit("").alias("guid"), F.lit("ENRICHED").alias("estado"), F.expr("ts + INTERVAL 400 DAYS").alias("ts"))
    t.spark.createDataFrame([], log.schema).unionByName(closing, allowMissingColumns=True).write.mode("append").parquet(folder)
    stream = inputs.parquet_stream(t.spark, folder, maxFilesPerTrigger=1)
    path = scratch_path(t.spark, "stream")
    pairs = jobs.paired_latencies(stream, "ENRICHED", "COMPLETADA", late="180 days")
    sinks.append_to(pairs, path, f"{path}-checkpoint").awaitTermination()
    return t.spark.read.parquet(path).select(
        "guid", F.unix_micros("started_at").alias("started_us"), F.unix_micros("ended_at").alias("ended_us"), "seconds")
