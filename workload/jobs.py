"""The jobs over a store, from given texts to its tables and reports."""

from pyspark.sql import functions as F

from anamnesis.operators.state import current_entities
from anamnesis.plans import enrich, learn, report, score
from anamnesis.session import scratch_path
from anamnesis.sources.store import Store

from .registry import query
from .replies import _LEVEL


def store_of(t):
    return Store(t.spark, scratch_path(t.spark, "store")).prepare()


@query("jobs_enrich_store", f"""SELECT guid, 'ENRICHED' AS estado, {_LEVEL} AS nivel_triaje,
  CAST(irradiacion AS INT) * 2 + CAST(coalesce(disnea, false) AS INT) + CAST(fiebre AS INT)
  + CAST(perdida_consciencia AS INT) + CAST(antecedentes_cardiacos AS INT) AS n_entities FROM interviews""")
def jobs_enrich_store(t):
    """All texts become enriched cases; what the store's tables then say of them."""
    store = store_of(t)
    enrich.enrich_given(store, t.planted.select("guid", "texto"))
    entities = current_entities(store.read("entities"), store.read("annotations")).groupBy("guid").agg(F.count("*").alias("n"))
    return store.cases([]).join(report.results(store), "guid").join(entities, "guid", "left").select(
        "guid", "estado", "nivel_triaje", F.coalesce("n", F.lit(0)).cast("int").alias("n_entities"))


@query("jobs_end_to_end", """SELECT 'EVALUATED' AS estado, count(*) AS n, count(*) AS trained FROM documents
  UNION ALL SELECT 'COMPLETADA', count(*), count(*) FROM documents""")
def jobs_end_to_end(t):
    """Enrich, dataset, train, evaluate, score and metrics, one after another."""
    store = store_of(t)
    enrich.enrich_given(store, t.planted.select("guid", "texto"))
    learn.build_dataset(store)
    summary = learn.train(store)
    learn.evaluate(store)
    asked = t.planted.select(F.lit(None).cast("string").alias("filename"), F.lit(None).cast("binary").alias("contenido"), "texto")
    score.score(store, asked)
    states = report.metrics_document(store).select(F.explode("textos.por_estado").alias("estado", "n"))
    return states.withColumn("trained", summary.select("n_samples").scalar())
