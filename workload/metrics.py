"""Operational metrics: A2-A4, A6, P10-P12, P17-P19, O2, O3, J7, J9."""

from datetime import datetime

from pyspark.sql import functions as F

from anamnesis.operators import evaluation as ev, metrics as mt
from anamnesis.operators.evaluation import is_audit_case, is_critical_under_triage
from anamnesis.operators.state import transition
from anamnesis.plans.increments import metrics_of, update_metrics
from anamnesis.plans.learn import evaluation_document
from anamnesis.schemas import PHASE_TIMES
from anamnesis.session import materialize, scratch_path
from anamnesis.sources.store import Store

from .registry import query

# The given cases are days long, so the cutoff of 120 seconds is a parameter.
CUTOFF_S = 21600


def _seconds(phase):
    return f"(CAST(epoch_us(fin_{phase}) - epoch_us(inicio_{phase}) AS DECIMAL(28, 0)) * CAST(0.000001 AS DECIMAL(7, 6)))"


def _rounded(phase, digits):
    return f"CAST(round({_seconds(phase)}, {digits}) AS DOUBLE)"


_WITHIN = f"epoch_us(fin_solicitud) - epoch_us(inicio_solicitud) < {CUTOFF_S}000000"


@query("p10_completed_within", f"SELECT guid FROM cases WHERE {_WITHIN}")
def p10_completed_within(t):
    return mt.completed_within(t.cases, CUTOFF_S).select("guid")


_LATENCIES = f"""SELECT guid, estado, {_rounded('solicitud', 1)} AS e2e_s, coalesce({_rounded('extraccion_entidades', 1)}, -1) AS llm_s,
  coalesce({_rounded('preprocesamiento', 2)}, -1) AS prep_s, coalesce({_rounded('normalizacion', 2)}, -1) AS norm_s FROM cases"""


@query("p17_case_latencies", _LATENCIES)
def p17_case_latencies(t):
    return mt.case_latencies(t.cases).drop("inicio_solicitud", "nombre_fichero").fillna(-1.0)


@query("o2_latest_latencies", f"""{_LATENCIES} WHERE {_WITHIN} ORDER BY cases.inicio_solicitud DESC, guid LIMIT 50""")
def o2_latest_latencies(t):
    return mt.latest_latencies(t.cases, CUTOFF_S).drop("inicio_solicitud", "nombre_fichero").fillna(-1.0)


@query("p19_latency_table", f"""SELECT guid, e2e_s AS "E2E (s)", llm_s AS "LLM (s)", prep_s AS "Prep. (s)", started AS "Inicio" FROM (
  SELECT guid, {_rounded('solicitud', 1)} AS e2e_s, coalesce({_rounded('extraccion_entidades', 1)}, -1) AS llm_s,
  coalesce({_rounded('preprocesamiento', 2)}, -1) AS prep_s, strftime(inicio_solicitud, '%Y-%m-%d %H:%M') AS started
  FROM cases WHERE {_WITHIN} ORDER BY inicio_solicitud DESC, guid LIMIT 50)""")
def p19_latency_table(t):
    return mt.latency_table(mt.latest_latencies(t.cases, CUTOFF_S)).fillna(-1.0)


def _mean(phase):
    return f"round(CAST(sum(epoch_us(fin_{phase}) - epoch_us(inicio_{phase})) AS DOUBLE) / count(fin_{phase}) / 1000000, 2)"


_SUMMARY = f"""SELECT {_mean('solicitud')} AS avg_latencia_e2e_s, CAST(round(min({_seconds('solicitud')}), 2) AS DOUBLE) AS min_latencia_e2e_s,
  CAST(round(max({_seconds('solicitud')}), 2) AS DOUBLE) AS max_latencia_e2e_s, {_mean('extraccion_entidades')} AS avg_tiempo_llm_s,
  count(*) AS n_completadas FROM cases WHERE estado = 'COMPLETADA'"""


@query("a2_latency_summary", _SUMMARY)
def a2_latency_summary(t):
    return mt.latency_summary(t.cases)


_TRAINING = f"""SELECT {_mean('entrenamiento')} AS avg_tiempo_entrenamiento_s, epoch_us(max(fin_entrenamiento)) AS ultimo_entrenamiento
  FROM cases WHERE fin_entrenamiento IS NOT NULL"""


@query("a3_training_summary", _TRAINING)
def a3_training_summary(t):
    return mt.training_summary(t.cases).withColumn("ultimo_entrenamiento", F.unix_micros("ultimo_entrenamiento"))


_THROUGHPUT = """batch AS (SELECT count(*) AS n,
  CAST(round((epoch_us(max(fin_extraccion_entidades)) - epoch_us(min(inicio_extraccion_entidades))) / 1000000.0, 0) AS DOUBLE) AS span
  FROM cases WHERE inicio_extraccion_entidades IS NOT NULL
    AND fin_extraccion_entidades >= (SELECT max(fin_extraccion_entidades) FROM cases) - INTERVAL 3 HOUR)"""


@query("a4_batch_throughput", f"""WITH {_THROUGHPUT}
SELECT n AS textos_ultimo_batch, span AS duracion_s, round(n * 60 / span, 2) AS throughput_por_minuto FROM batch""")
def a4_batch_throughput(t):
    return mt.batch_throughput(t.cases)


def document(t):
    """The metrics document with an evaluation over the given predictions. As
    in the job, the case view and the evaluation are written once, then read."""
    rows = t.predictions.where("prediccion_modelo IS NOT NULL")
    folds = ev.fold_scores(rows.withColumn("fold", (F.col("doc_id") % 5).cast("int")))
    importances = t.results.agg(F.map_from_arrays(
        F.array(F.lit("edad"), F.lit("score_urgencia")), F.array(F.avg("edad"), F.avg("score_urgencia"))
    ).alias("feature_importances"))
    evaluation = evaluation_document(rows, folds, importances, "modelo_1", "dataset_1")
    return mt.metrics_document(materialize(t.cases, "cases"), materialize(evaluation, "evaluation"))


@query("a6_metrics_document", f"""WITH {_THROUGHPUT}, lat AS ({_SUMMARY}), tr AS ({_TRAINING})
SELECT (SELECT count(*) FROM cases) AS total, (SELECT count(*) FROM cases WHERE estado = 'ERROR_ENRICHMENT') AS n_errors,
  (SELECT count(*) FROM cases WHERE estado = 'COMPLETADA') AS n_completed, lat.*, avg_tiempo_entrenamiento_s,
  n AS textos_ultimo_batch, span AS duracion_s, round(n * 60 / span, 2) AS throughput_por_minuto,
  (SELECT count(*) FROM predictions WHERE nivel_triaje <= 2 AND prediccion_modelo > nivel_triaje) AS under_triage_count
FROM lat, tr, batch""")
def a6_metrics_document(t):
    """Every part of the document, flattened for the check."""
    return document(t).select(
        F.col("textos.total").alias("total"),
        F.element_at("errores", "ERROR_ENRICHMENT").alias("n_errors"),
        F.element_at("textos.por_estado", "COMPLETADA").alias("n_completed"),
        "latencia_fase2.*", F.col("entrenamiento.avg_tiempo_entrenamiento_s").alias("avg_tiempo_entrenamiento_s"),
        "throughput_batch.*", F.col("metricas_modelo.under_triage_count").alias("under_triage_count"),
    )


@query("a6_incremental_document", f"""WITH {_THROUGHPUT}, lat AS ({_SUMMARY}), tr AS ({_TRAINING})
SELECT (SELECT count(*) FROM cases) AS total, (SELECT count(*) FROM cases WHERE estado = 'ERROR_ENRICHMENT') AS n_errors,
  (SELECT count(*) FROM cases WHERE estado = 'COMPLETADA') AS n_completed, lat.*, avg_tiempo_entrenamiento_s,
  n AS textos_ultimo_batch, span AS duracion_s, round(n * 60 / span, 2) AS throughput_por_minuto FROM lat, tr, batch""")
def a6_incremental_document(t):
    """The document after three increments and a snapshot, each of which saw only what had moved."""
    store = Store(t.spark, scratch_path(t.spark, "store")).prepare()
    cases = materialize(t.cases, "cases")
    times = [name for name in cases.columns if name in PHASE_TIMES]
    third = F.pmod(F.xxhash64("guid"), F.lit(3))
    start, end = datetime(2020, 1, 1), datetime(2020, 1, 2)

    def moved(rows, seq):
        return transition(rows, None, end, seq, estado=F.col("estado"), **{name: F.col(name) for name in times})

    store.append("case_log", transition(cases, "INGESTED", start, 0, inicio_solicitud=F.col("inicio_solicitud")))
    update_metrics(store)
    store.compact()
    store.append("case_log", moved(cases.where(third < 2), 1))
    update_metrics(store)
    store.append("case_log", moved(cases.where(third == 2), 1).unionByName(moved(cases.where(third == 0), 2)))
    return metrics_of(store).select(
        F.col("textos.total").alias("total"), F.element_at("errores", "ERROR_ENRICHMENT").alias("n_errors"),
        F.element_at("textos.por_estado", "COMPLETADA").alias("n_completed"),
        "latencia_fase2.*", F.col("entrenamiento.avg_tiempo_entrenamiento_s").alias("avg_tiempo_entrenamiento_s"), "throughput_batch.*")


@query("j7_document_json", """WITH c AS (SELECT estado, count(*) AS n FROM cases GROUP BY estado)
SELECT 1 AS n_documents, (SELECT count(*) FROM cases) AS total,
  (SELECT string_agg(estado, ',' ORDER BY estado) FROM c) AS states, 'modelo_1' AS modelo""")
def j7_document_json(t):
    """The document as JSON text, read back by path."""
    made = mt.document_json(document(t))
    states = F.json_object_keys(F.get_json_object("documento", "$.textos.por_estado"))
    return made.select(
        F.lit(1).alias("n_documents"), F.get_json_object("documento", "$.textos.total").cast("long").alias("total"),
        F.array_join(F.array_sort(states), ",").alias("states"),
        F.get_json_object("documento", "$.metricas_modelo.modelo").alias("modelo"),
    )


@query("j9_dashboard_figures", f"""
WITH p AS (SELECT *, doc_id % 5 AS fold FROM predictions WHERE prediccion_modelo IS NOT NULL), lat AS ({_SUMMARY}), tr AS ({_TRAINING}),
sides AS (SELECT fold, nivel_triaje AS clase, CASE WHEN nivel_triaje = prediccion_modelo THEN 1 ELSE 0 END AS tp, 1 AS a, 0 AS b FROM p
  UNION ALL SELECT fold, prediccion_modelo, 0, 0, 1 FROM p),
f AS (SELECT fold, clase, 2.0::DOUBLE * sum(tp) / (sum(a) + sum(b)) AS f1 FROM sides GROUP BY 1, 2),
m AS (SELECT fold, avg(f1) AS f1_macro FROM f GROUP BY 1)
SELECT (SELECT round(avg(f1_macro), 4) FROM m) AS cv_f1_macro, (SELECT round(stddev_pop(f1_macro), 4) FROM m) AS cv_f1_std,
  (SELECT sum(tp)::DOUBLE / sum(a) FROM sides WHERE clase = 2) AS recall_c2,
  (SELECT 2.0::DOUBLE * sum(tp) / (sum(a) + sum(b)) FROM sides WHERE clase = 3) AS f1_c3,
  min_latencia_e2e_s, avg_tiempo_llm_s, n_completadas AS casos_procesados, 'modelo_1' AS modelo,
  (SELECT count(*) FROM tr) AS n_trained FROM lat""")
def j9_dashboard_figures(t):
    figures = mt.dashboard_figures(document(t))
    return figures.withColumn("n_trained", F.when(F.col("entrenado") != "—", 1).otherwise(0).cast("long")).drop("entrenado")


@query("p11_audit_predicate", """SELECT guid FROM predictions WHERE prediccion_modelo > nivel_triaje AND score_ansiedad >= 0.7""")
def p11_audit_predicate(t):
    test = is_audit_case(F.col("nivel_triaje"), F.col("prediccion_modelo"), F.col("score_ansiedad"))
    return t.predictions.where(test).select("guid")


@query("p12_critical_under_triage", """SELECT guid FROM predictions WHERE prediccion_modelo > nivel_triaje AND nivel_triaje <= 2""")
def p12_critical_under_triage(t):
    test = is_critical_under_triage(F.col("nivel_triaje"), F.col("prediccion_modelo"))
    return t.predictions.where(test).select("guid")


def audit(t):
    return mt.audit_rows(t.doc_cases.withColumn("fin_solicitud", F.current_timestamp()), t.predictions)


_AUDIT = """FROM doc_cases c JOIN predictions p ON c.guid = p.guid
  WHERE p.prediccion_modelo > p.nivel_triaje AND p.score_ansiedad >= 0.7"""


@query("p18_audit_listing", f"""
SELECT coalesce(nullif(c.nombre_fichero, ''), substr(c.guid, 1, 8)) AS "ID_Caso", coalesce(nullif(p.motivo_consulta, ''), '—') AS "Motivo",
  CAST(round(CAST(p.score_ansiedad AS DECIMAL(10, 6)), 2) AS DOUBLE) AS "Score Ansiedad", 'C' || prediccion_modelo AS "Pred. IA", 'C' || nivel_triaje AS "Ground Truth",
  '❌ Under-triage' AS "Validación", 'El modelo RF priorizó ansiedad sobre clínica' AS "Causa" {_AUDIT}""")
def p18_audit_listing(t):
    return mt.audit_listing(audit(t))


@query("o3_audit_order", f"""SELECT c.guid, score_ansiedad, prediccion_modelo, nivel_triaje {_AUDIT} ORDER BY score_ansiedad DESC, c.guid""")
def o3_audit_order(t):
    """Most anxious first. The id is part of the sort key, so many equal scores
    still spread over range partitions."""
    return audit(t).select("guid", "score_ansiedad", "prediccion_modelo", "nivel_triaje")
