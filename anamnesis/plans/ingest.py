"""Text files to stored transcripts and new cases."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from ..functions.text import object_key, object_url, specialty_at_ingest, stable_guid
from ..operators.metrics import batch_report
from ..operators.state import insert_if_absent, new_batch_cases
from ..session import materialize, scratch_path
from ..sources.store import Store
from ..sources.texts import read_transcripts, scan_corpus, write_transcripts
from ..streaming.inputs import text_file_stream


def ingest(
    store: Store, folder: str, base_url: str = "store", bucket: str = "textos-originales",
    modified_after: str | None = None,
) -> DataFrame:
    """Files whose name is not known yet become cases. Returns the batch report.

    Names are compared on the listing alone; contents are read for the second
    scan. ``modified_after`` keeps files of earlier runs out of both.

    The case log is written last: a job that dies before that leaves no case.
    The next run finds the same ids, as they follow from name and content, and
    adds only the texts that are not stored yet.
    """
    at = datetime.now(timezone.utc)
    names = scan_corpus(store.spark, folder, modified_after=modified_after).select("nombre_fichero")
    known = store.cases(["nombre_fichero"])
    fresh_names = materialize(insert_if_absent(names, known, "nombre_fichero"), "ingest-names")
    corpus = scan_corpus(store.spark, folder, modified_after=modified_after).join(
        fresh_names, "nombre_fichero", "left_semi"
    )
    texts = read_transcripts(corpus).withColumn(
        "guid", stable_guid(F.col("nombre_fichero"), F.col("texto"))
    )
    key = object_key(F.col("especialidad"), F.col("nombre_fichero"))
    written = materialize(texts, "ingest")
    stored = store.read("transcripts").select("guid")
    write_transcripts(written.join(stored, "guid", "left_anti"), store.path("transcripts"))
    rows = written.withColumn("url", object_url(base_url, bucket, key))
    store.append("case_log", new_batch_cases(rows, at))
    outcomes = names.join(fresh_names.withColumn("_new", F.lit(True)), "nombre_fichero", "left").select(
        F.when(F.col("_new"), "ingested").otherwise("skipped").alias("outcome")
    )
    return batch_report(outcomes)


def ingest_new(
    store: Store, folder: str, base_url: str = "store", bucket: str = "textos-originales",
    name: str = "ingest", max_files: int = 10_000, pattern: str = "*.txt",
) -> DataFrame:
    """Like ``ingest``, by a log of the files seen: what an earlier run has taken is not
    opened again, nor is a file that has changed under a name that was taken.

    The stream ``name`` of the store runs until nothing new is there, ``max_files`` to
    a micro-batch; each is one batch of the store and may run twice. A name that
    is a case already, from another folder say, is skipped. Returns the report of
    the files this run has seen. Another folder needs another name.
    """
    at = datetime.now(timezone.utc)
    seen = scratch_path(store.spark, "ingest-outcomes")
    store.spark.createDataFrame([], "outcome string").write.parquet(seen)
    files = text_file_stream(store.spark, folder, pattern, maxFilesPerTrigger=max_files)

    def take(batch: DataFrame, number: int) -> None:
        texts = batch.select("nombre_fichero", specialty_at_ingest(F.col("nombre_fichero")).alias("especialidad"), "texto")
        texts = materialize(texts.withColumn("guid", stable_guid(F.col("nombre_fichero"), F.col("texto"))), "ingest")
        known = store.cases(["nombre_fichero"]).where("nombre_fichero IS NOT NULL").select("nombre_fichero", F.col("guid").alias("case"))
        named = texts.join(known, "nombre_fichero", "left")
        # A micro-batch that is run again finds its own cases: they are not another's.
        fresh = named.where(F.col("case").isNull() | (F.col("case") == F.col("guid"))).drop("case").dropDuplicates(["guid"])
        fresh = materialize(fresh, "ingest-new")
        stored = store.read("transcripts").select("guid")
        write_transcripts(fresh.join(stored, "guid", "left_anti"), store.path("transcripts"))
        url = object_url(base_url, bucket, object_key(F.col("especialidad"), F.col("nombre_fichero")))
        store.write({"case_log": new_batch_cases(fresh.withColumn("url", url), at)}, f"{name}_{number:010d}")
        outcome = F.when(F.col("_new"), "ingested").otherwise("skipped").alias("outcome")
        texts.select("nombre_fichero").join(
            fresh.select("nombre_fichero", F.lit(True).alias("_new")), "nombre_fichero", "left").select(outcome).write.mode("append").parquet(seen)

    query = (
        files.writeStream.foreachBatch(take).option("checkpointLocation", store.path(f"streams/{name}"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return batch_report(store.spark.read.schema("outcome string").parquet(seen))
