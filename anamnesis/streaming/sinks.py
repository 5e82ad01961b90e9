"""Running a stream to a folder or into the store, and reading back what it said last."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.annotate import Client
from ..plans.learn import require_model
from ..plans.score import score_batch
from ..session import materialize
from ..sources.artifacts import latest_model
from ..sources.store import Store
from .jobs import text_error


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append_to(df: DataFrame, path: str, checkpoint: str, rocksdb: bool = False, **trigger) -> StreamingQuery:
    """Append-mode stream to Parquet; exactly once through the sink's own log.

    A stream takes its state store from the session as it starts; ``rocksdb`` sets
    the one that timers need for this stream alone.
    """
    conf = df.sparkSession.conf
    before = conf.get(STATE_STORE)
    if rocksdb:
        conf.set(STATE_STORE, ROCKSDB)
    try:
        return (
            df.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )
    finally:
        conf.set(STATE_STORE, before)


def upsert_to(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Update-mode stream: each batch writes the rows that changed, into a
    folder of its own. A batch that is run again replaces its folder, so a lost
    driver or executor leaves no doubles."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return (
        df.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_upserts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last row written per key."""
    rows = spark.read.option("basePath", path).parquet(path)
    values = [name for name in rows.columns if name not in (*keys, "batch_id")]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return picked.select(*keys, "_last.*")


def scores_to_store(
    arrivals: DataFrame, store: Store, name: str, checkpoint: str,
    connect: Callable[[], Client] | None = None, partitions: int | None = None, trigger: dict | None = None, **request,
) -> StreamingQuery:
    """Stream of (guid, filename, texto) into the store's tables, with the newest model.

    Each micro-batch is one batch of the store, named by the stream and its number.
    A micro-batch that runs twice adds its rows once: one case, one prediction, one
    completion. Missing and blank texts are refused; they end in the table
    ``refused`` below the checkpoint, a folder per micro-batch.
    """
    require_model(store)
    model_name, model = latest_model(store.spark, store.models)

    def write(batch: DataFrame, number: int) -> None:
        label = f"{name}_{number:010d}"
        if store.has(label):
            return
        checked = materialize(batch.withColumn("entrada_error", text_error(F.col("texto"))), "arrivals")
        checked.where("entrada_error IS NOT NULL").select("guid", "filename", "entrada_error").write.mode(
            "overwrite").parquet(f"{checkpoint}/refused/batch_id={number}")
        texts = checked.where("entrada_error IS NULL").select("guid", "filename", "texto").dropDuplicates(["guid"])
        score_batch(store, texts, model_name, model, label, connect, partitions, **request)

    return (
        arrivals.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(**(trigger or {"availableNow": True})).start()
    )
