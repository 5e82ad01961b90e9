"""Reports over a store, as it is or was after a version: metrics document, audit, latencies."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators import metrics
from ..operators.state import merge_results, move_all
from ..schemas import EVALUATED, EVALUATION, INGESTED, LATENCY_CUTOFF_S
from ..session import materialize
from ..sources.artifacts import latest_evaluation
from ..sources.store import Store

LATENCY_COLUMNS = [
    "nombre_fichero",
    *[f"{edge}_{phase}" for phase in ("solicitud", "extraccion_entidades", "preprocesamiento",
                                      "normalizacion") for edge in ("inicio", "fin")],
]


def results(store: Store, as_of: int | None = None) -> DataFrame:
    return merge_results(store.read("annotations", as_of), store.read("predictions", as_of))


def metrics_document(store: Store, as_of: int | None = None) -> DataFrame:
    """The case view is written once: it is read twice, by the totals and by
    the last-batch window."""
    columns = ["inicio_solicitud", "fin_solicitud", "inicio_extraccion_entidades",
               "fin_extraccion_entidades", "inicio_entrenamiento", "fin_entrenamiento"]
    cases = materialize(store.cases(columns, as_of), "cases")
    evaluation = latest_evaluation(store.spark, store.evaluations)
    if evaluation is None:
        nothing = F.lit(None).cast(T.StructType(EVALUATION.fields))
        return metrics.metrics_document(cases).withColumn("metricas_modelo", nothing)
    return metrics.metrics_document(cases, evaluation)


def audit(store: Store, as_of: int | None = None) -> DataFrame:
    cases = store.cases(["nombre_fichero", "fin_solicitud"], as_of)
    return metrics.audit_listing(metrics.audit_rows(cases, results(store, as_of)))


def latencies(store: Store, cutoff_s: int = LATENCY_CUTOFF_S, as_of: int | None = None) -> DataFrame:
    return metrics.latest_latencies(store.cases(LATENCY_COLUMNS, as_of), cutoff_s)


def reset_for_enrichment(store: Store, state: str = EVALUATED) -> int:
    """Puts every case of a state back to the start. Returns the version before,
    which ``store.restore`` puts back and ``store.read(..., as_of=version)`` shows."""
    at = datetime.now(timezone.utc)
    version = store.force().version
    store.append("case_log", move_all(materialize(store.cases([], as_of=version), "reset"), state, INGESTED, at, 9))
    return version
