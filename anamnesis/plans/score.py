"""On-demand texts to predictions, many at once."""

from collections.abc import Callable
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from ..functions.encoding import annotated_or_predicted, level_label, rating
from ..functions.replies import scoring_features
from ..functions.text import specialty_at_scoring, stable_guid
from ..operators.annotate import Client
from ..operators.models import Model, predict
from ..operators.state import new_on_demand_cases, transition
from ..schemas import COMPLETED, FEATURES
from ..session import materialize
from ..sources.artifacts import latest_model
from ..sources.store import Store
from ..sources.texts import (
    ON_DEMAND_FOLDER, archive_on_demand, on_demand_input, with_stored_texts, write_transcripts,
)
from .enrich import enrich_texts, enriched_tables
from .learn import require_model

RESPONSE = [
    "guid", "nivel_triaje_predicho", "nivel_manchester", "nivel_triaje_llm",
    "score_urgencia", "score_ansiedad", "confianza", "valoracion",
    "motivo_consulta", "justificacion", "entidades_normalizadas",
]


def score_enriched(enriched: DataFrame, model: Model, filename: str = "filename") -> DataFrame:
    """Reply fields in; prediction, confidence and rating out, with the
    annotator's own fields kept beside the model's numbers."""
    annotated = {f"_{name}": F.col(name) for name in ("score_urgencia", "score_ansiedad")}
    name = F.col(filename) if filename in enriched.columns else F.lit("")
    inputs = scoring_features(specialty_at_scoring(name))
    rows = enriched.withColumns(annotated).withColumn("_level", F.col("nivel_triaje")).withColumns(inputs)
    scored = predict(model, rows)
    level = annotated_or_predicted(F.col("_level"), F.col("prediccion_modelo"))
    return scored.withColumns({
        "nivel_triaje_llm": level,
        "valoracion": rating(F.col("confianza"), F.col("prediccion_modelo"), F.col("_level")),
        "score_urgencia": F.col("_score_urgencia"),
        "score_ansiedad": F.col("_score_ansiedad"),
    }).drop("_score_urgencia", "_score_ansiedad", "_level", "probabilidades",
            *[name for name in FEATURES if not name.startswith("score_")])


def response_rows(scored: DataFrame, *kept: str) -> DataFrame:
    return scored.select(
        "guid", *kept,
        F.col("prediccion_modelo").alias("nivel_triaje_predicho"),
        F.concat(F.lit("C"), F.col("prediccion_modelo").cast("string")).alias("nivel_manchester"),
        "nivel_triaje_llm", "score_urgencia", "score_ansiedad",
        F.round(F.col("confianza").cast("decimal(20,15)"), 3).cast("double").alias("confianza"),
        "valoracion", "motivo_consulta", "justificacion",
        F.coalesce("entidades_normalizadas", F.array().cast("array<string>")).alias("entidades_normalizadas"),
    )


def with_ids(requests: DataFrame, job: str) -> DataFrame:
    """Adds ``guid``, which follows from the job's name, the request, and which of equal requests it is.

    A job that is run again under its name gives the same ids; equal requests of one
    job are cases each. Equal ones are counted and spread again, so none of them
    needs a place of its own.
    """
    counted = requests.groupBy(*requests.columns).agg(F.count("*").alias("_n"))
    each = counted.withColumn("_place", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    named = F.concat_ws("/", F.lit(job), F.col("_place").cast("string"), F.coalesce("filename", F.lit("")))
    return each.withColumn("guid", stable_guid(named, F.coalesce("texto", F.lit("")))).drop("_n", "_place")


def score_batch(
    store: Store, texts: DataFrame, model_name: str, model: Model, batch: str,
    connect: Callable[[], Client] | None = None, partitions: int | None = None, **request,
) -> tuple[DataFrame, DataFrame]:
    """Scores (guid, filename, texto) and adds cases, findings, entities, predictions and completions
    to the store as one batch: all of it or, after a crash, nothing. A batch on record
    is not added again. Returns scored rows, and the ids whose text could not be
    annotated with the reason."""
    started = datetime.now(timezone.utc)
    archived = archive_on_demand(texts)
    here = store.read("transcripts").where(F.col("especialidad") == ON_DEMAND_FOLDER).select("guid")
    write_transcripts(archived.join(here, "guid", "left_anti"), store.path("transcripts"))
    enriched = materialize(enrich_texts(texts.select("guid", "texto"), connect, partitions, store.replies, **request), "enriched")
    good = enriched.where("error IS NULL").join(texts.select("guid", "filename"), "guid")
    scored = materialize(score_enriched(good, model), "scored")
    tables = enriched_tables(enriched, started)
    ended = datetime.now(timezone.utc)
    url = F.concat(F.lit("fase2/"), F.col("guid"), F.lit(".txt"))
    log = new_on_demand_cases(texts, started).unionByName(transition(texts, None, started, 0, url_texto_original=url))
    log = log.unionByName(tables["case_log"])
    log = log.unionByName(transition(scored, COMPLETED, ended, 8, url_modelo_entrenado=model_name, fin_solicitud=ended))
    store.write({
        **tables, "case_log": log,
        "predictions": scored.withColumns({"ts": F.lit(ended), "seq": F.lit(8).cast("long")}),
    }, batch)
    return scored, enriched.where("error IS NOT NULL").select("guid", "error")


def score(
    store: Store, requests: DataFrame, connect: Callable[[], Client] | None = None,
    partitions: int | None = None, job: str | None = None, **request,
) -> tuple[DataFrame, DataFrame]:
    """Scores requests (filename, contenido, texto, maybe especialidad). A request
    that names a stored file and brings no bytes is scored by the stored text.
    Returns response rows and refused requests. Without a model nothing is
    written.

    ``job`` names the run: run again under its name, after a crash or after its end,
    it leaves one case, one prediction and one completion per request. Without a
    name every run makes new cases. ``request`` is the ``template``, ``examples`` and
    ``model`` of what a client is sent.
    """
    require_model(store)
    model_name, model = latest_model(store.spark, store.models)
    job = job or uuid4().hex
    asked = with_stored_texts(requests, store.read("transcripts"))
    checked = materialize(with_ids(on_demand_input(asked), job), "requests")
    accepted = checked.where("entrada_error IS NULL").drop("entrada_error")
    scored, failed = score_batch(store, accepted, model_name, model, f"score_{job}", connect, partitions, **request)
    refused = checked.where("entrada_error IS NOT NULL").select("filename", "entrada_error").unionByName(
        failed.join(accepted.select("guid", "filename"), "guid").select("filename", F.col("error").alias("entrada_error")))
    return response_rows(scored), refused
