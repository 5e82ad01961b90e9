"""Pending cases to structured findings."""

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from ..functions.replies import entity_rows, parse_replies
from ..functions.text import clean_text, patient_text, text_to_annotate
from ..operators.annotate import Client, annotate, rule_replies
from ..operators.metrics import batch_report, fail_on_errors
from ..operators.state import by_file_name, missing_cases, pending, transition
from ..schemas import (
    ENRICHED, ENRICHING, ERROR_ENRICHMENT, PREPROCESSED, PREPROCESSING, REPLY_FIELDS,
)
from ..session import materialize
from ..sources.replies import ReplyTable
from ..sources.store import Store
from ..sources.texts import texts_of


def preprocess(texts: DataFrame, text: str = "texto") -> DataFrame:
    """Adds the cleaned text, the patient's words and the text to annotate."""
    return (
        texts.withColumn("texto_completo", clean_text(F.col(text)))
        .withColumn("texto_paciente", patient_text(F.col("texto_completo")))
        .withColumn("texto_anotable", text_to_annotate(F.col("texto_paciente"), F.col("texto_completo")))
    )


def enrich_texts(
    texts: DataFrame, connect: Callable[[], Client] | None = None, partitions: int | None = None,
    replies: ReplyTable | None = None, **request,
) -> DataFrame:
    """guid and text in; guid, reply fields and an error column out, written
    once. The rule annotator runs when no client is given. ``request`` is the
    ``template``, ``examples`` and ``model`` of what a client is sent, and the ``pace`` of
    its calls. With a table of ``replies`` no request in it is sent again."""
    # Texts are often the end of a join: written once, read by both branches.
    prepared = materialize(preprocess(texts).select("guid", "texto_anotable", "texto_completo"), "prepared")
    present = prepared.where("texto_anotable IS NOT NULL")
    if connect is None:
        raw = rule_replies(present, "texto_anotable", "texto_completo")
    elif replies is not None:
        raw = replies.annotate(present, "texto_anotable", connect, partitions, **request)
    else:
        raw = annotate(present, "texto_anotable", connect, partitions, **request)
    parsed = parse_replies(materialize(raw, "replies"))
    error = F.coalesce("annotate_error", "reply_error")
    missing = prepared.where("texto_anotable IS NULL").select("guid")
    return parsed.withColumn("error", error).unionByName(
        missing.withColumn("error", F.lit("text_not_found")), allowMissingColumns=True
    ).select("guid", "error", "urgencia_ausente", *REPLY_FIELDS)


def enriched_tables(enriched: DataFrame, started: datetime) -> dict[str, DataFrame]:
    """Findings, entities and transitions of one enriched batch, by table."""
    ended = datetime.now(timezone.utc)
    good, bad = enriched.where("error IS NULL"), enriched.where("error IS NOT NULL")
    stamped = {"ts": F.lit(ended), "seq": F.lit(4).cast("long")}
    steps = enriched.select("guid")
    log = transition(steps, PREPROCESSING, started, 1, inicio_preprocesamiento=started)
    log = log.unionByName(transition(steps, PREPROCESSED, started, 2, fin_preprocesamiento=started))
    log = log.unionByName(transition(steps, ENRICHING, started, 3, inicio_extraccion_entidades=started))
    phases = ["normalizacion", "etiquetado", "score"]
    done = {f"inicio_{phase}": started for phase in phases} | {f"fin_{phase}": ended for phase in phases}
    log = log.unionByName(transition(
        good, ENRICHED, ended, 4, fin_extraccion_entidades=ended, **done
    ))
    log = log.unionByName(transition(bad, ERROR_ENRICHMENT, ended, 4))
    return {
        "annotations": good.withColumns({**stamped, "timestamp_pred": F.lit(ended)}),
        "entities": entity_rows(good).withColumns(stamped), "case_log": log,
    }


def enrich_pending(
    store: Store, connect: Callable[[], Client] | None = None, limit: int = 0,
    partitions: int | None = None, strict: bool = False, **request,
) -> DataFrame:
    """Enriches new and failed cases; failed ones stay pending for the next
    run. ``limit`` is the size of a batch, 0 for all. Returns the report.

    Findings, entities and transitions enter the store as one batch, so no reader
    sees results of a case that is still pending. Whatever succeeded is stored first; with ``strict`` the job then fails if
    any case did.
    """
    started = datetime.now(timezone.utc)
    waiting = by_file_name(pending(store.cases(["nombre_fichero", "especialidad"])).where(
        "nombre_fichero IS NOT NULL"
    ), limit)
    texts = texts_of(materialize(waiting, "pending"), store.read("transcripts"))
    enriched = materialize(enrich_texts(texts, connect, partitions, store.replies, **request), "enriched")
    store.write(enriched_tables(enriched, started))
    report = batch_report(enriched.select(
        F.when(F.col("error").isNull(), "ok").otherwise("error").alias("outcome")
    ))
    if strict:
        fail_on_errors(report, "cases could not be enriched")
    return report


def enrich_given(
    store: Store, texts: DataFrame, connect: Callable[[], Client] | None = None,
    partitions: int | None = None, **request,
) -> DataFrame:
    """Enriches given (guid, texto) rows; unknown ids become cases first."""
    started = datetime.now(timezone.utc)
    fresh = materialize(missing_cases(texts, store.cases([]), started), "new-cases")
    enriched = materialize(enrich_texts(texts, connect, partitions, store.replies, **request), "enriched")
    tables = enriched_tables(enriched, started)
    store.write({**tables, "case_log": fresh.unionByName(tables["case_log"])})
    return enriched
