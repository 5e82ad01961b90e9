"""Evaluation without a model: A7-A12, A14-A17, O4, O6, O7, J6, M10, M16."""

from pyspark.sql import functions as F

from anamnesis.functions.encoding import rating
from anamnesis.operators import evaluation as ev
from anamnesis.operators.models import importance_map
from anamnesis.operators.ranking import stratified_folds, stratified_split

from .registry import query

# Three-class matrix keeps the two views of the same counts apart: rows by
# actual class, and sides per class.
_PAIRS = """p AS (SELECT * FROM predictions WHERE prediccion_modelo IS NOT NULL),
lv AS (SELECT unnest([1, 2, 3, 4, 5]) AS level),
matrix AS (SELECT a.level AS actual, b.level AS predicted,
  (SELECT count(*) FROM p WHERE nivel_triaje = a.level AND prediccion_modelo = b.level) AS n FROM lv a, lv b),
tot AS (SELECT level AS clase, CAST(sum(n) FILTER (WHERE actual = level AND predicted = level) AS BIGINT) AS tp,
  CAST(sum(n) FILTER (WHERE actual = level) AS BIGINT) AS support, CAST(sum(n) FILTER (WHERE predicted = level) AS BIGINT) AS claimed
  FROM lv, matrix GROUP BY level),
scores AS (SELECT clase, CASE WHEN claimed = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / claimed END AS precision,
  CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / support END AS recall,
  CASE WHEN support + claimed = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * tp / (support + claimed) END AS f1, support, tp FROM tot)"""


def predicted(t):
    return t.predictions.where("prediccion_modelo IS NOT NULL")


@query("a7_class_weights", """
WITH c AS (SELECT nivel_triaje, count(*) AS n_c FROM results GROUP BY 1)
SELECT nivel_triaje, n_c, (SELECT sum(n_c) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n_c) AS weight FROM c""")
def a7_class_weights(t):
    return ev.class_weights(t.results)


@query("a8_confusion_matrix", f"WITH {_PAIRS} SELECT actual, predicted, n FROM matrix")
def a8_confusion_matrix(t):
    return ev.confusion_matrix(t.predictions)


@query("a8_confusion_matrix_wide", f"""WITH {_PAIRS} SELECT actual,
  {', '.join(f'CAST(sum(n) FILTER (WHERE predicted = {i}) AS BIGINT) AS pred_{i}' for i in range(1, 6))} FROM matrix GROUP BY actual""")
def a8_confusion_matrix_wide(t):
    return ev.matrix_rows(ev.confusion_matrix(t.predictions))


@query("a9_class_report", f"WITH {_PAIRS} SELECT clase, precision, recall, f1, support FROM scores")
def a9_class_report(t):
    return ev.class_scores(ev.confusion_matrix(t.predictions)).drop("tp")


@query("a10_overall_scores", f"""WITH {_PAIRS} SELECT sum(tp)::DOUBLE / sum(support) AS accuracy,
  {', '.join(f'avg({m}) AS macro_{m}, sum({m} * support) / sum(support)::DOUBLE AS weighted_{m}' for m in ('precision', 'recall', 'f1'))},
  CAST(sum(support) AS BIGINT) AS support FROM scores""")
def a10_overall_scores(t):
    return ev.overall_scores(ev.class_scores(ev.confusion_matrix(t.predictions)))


_FOLD_SCORES = """p AS (SELECT *, CAST(doc_id % 5 AS INT) AS fold FROM predictions WHERE prediccion_modelo IS NOT NULL),
sides AS (SELECT fold, nivel_triaje AS clase, CASE WHEN nivel_triaje = prediccion_modelo THEN 1 ELSE 0 END AS tp, 1 AS a, 0 AS b FROM p
  UNION ALL SELECT fold, prediccion_modelo, 0, 0, 1 FROM p),
f AS (SELECT fold, clase, 2.0::DOUBLE * sum(tp) / (sum(a) + sum(b)) AS f1 FROM sides GROUP BY 1, 2),
m AS (SELECT fold, avg(f1) AS f1_macro FROM f GROUP BY 1)"""


def folds(t):
    return ev.fold_scores(predicted(t).withColumn("fold", (F.col("doc_id") % 5).cast("int")))


@query("a11_fold_scores", f"WITH {_FOLD_SCORES} SELECT fold, round(f1_macro, 12) AS f1_macro FROM m")
def a11_fold_scores(t):
    return folds(t).withColumn("f1_macro", F.round("f1_macro", 12))


@query("a11_cross_validation_summary", f"""WITH {_FOLD_SCORES}
SELECT round(avg(f1_macro), 4) AS cv_f1_macro, round(stddev_pop(f1_macro), 4) AS cv_f1_std FROM m""")
def a11_cross_validation_summary(t):
    summary = ev.cross_validation_summary(folds(t))
    return summary.select(*[F.round(name, 4).alias(name) for name in summary.columns])


@query("a12_under_triage_count", """SELECT count(*) AS under_triage_count FROM predictions
  WHERE nivel_triaje <= 2 AND prediccion_modelo > nivel_triaje""")
def a12_under_triage_count(t):
    return ev.under_triage_count(t.predictions)


@query("m16_under_triage_listing", """SELECT guid, nivel_triaje, prediccion_modelo, coalesce(score_urgencia, -9.0) AS score_urgencia
  FROM predictions WHERE nivel_triaje <= 2 AND prediccion_modelo > nivel_triaje""")
def m16_under_triage_listing(t):
    return ev.under_triage_listing(t.predictions).fillna(-9.0)


@query("a14_sample_summary", "SELECT count(*) AS n_samples, count(DISTINCT nivel_triaje) AS n_classes FROM results")
def a14_sample_summary(t):
    return ev.sample_summary(t.results)


def _distribution(column, source):
    return f"""WITH c AS (SELECT {column}, count(*) AS n FROM {source} GROUP BY 1)
SELECT {column}, n, CAST(round(CAST(n * 100 AS DOUBLE) / (SELECT sum(n) FROM c), 1) AS DOUBLE) AS pct FROM c"""


@query("a15_class_distribution", _distribution("nivel_triaje", "results"))
def a15_class_distribution(t):
    return ev.class_distribution(t.results, "nivel_triaje")


@query("a16_predicted_distribution", _distribution("prediccion_modelo", "(SELECT * FROM predictions WHERE prediccion_modelo IS NOT NULL) q"))
def a16_predicted_distribution(t):
    return ev.class_distribution(predicted(t), "prediccion_modelo")


def _quality():
    from anamnesis.schemas import FEATURES, TARGET
    parts = []
    for name in [*FEATURES, TARGET]:
        bad = "false"
        if name in ev.NUMERIC_DOMAINS:
            low, high = ev.NUMERIC_DOMAINS[name]
            bad = f"{name} < {low} OR {name} > {high}"
        elif name == "sexo":
            bad = "sexo NOT IN ('M', 'F')"
        parts.append(f"SELECT count(*) AS n_rows, '{name}' AS columna, count(*) FILTER (WHERE {name} IS NULL) AS n_null, "
                     f"count(*) FILTER (WHERE {bad}) AS n_violations FROM results")
    return " UNION ALL ".join(parts)


@query("a17_quality_report", _quality())
def a17_quality_report(t):
    return ev.quality_report(t.results)


_IMPORTANCE = """WITH i AS (SELECT event_type AS feature, round(sum(value) / (SELECT sum(value) FROM events), 9) AS importance
  FROM events GROUP BY 1)"""


def importances(t):
    """Shares of the event kinds stand in for a model's importances."""
    total = t.events.agg(F.sum("value")).scalar()
    return t.events.groupBy(F.col("event_type").alias("feature")).agg(F.round(F.sum("value") / total, 9).alias("importance"))


@query("o4_importance_ranking", f"{_IMPORTANCE} SELECT feature, importance, round(importance / (SELECT max(importance) FROM i), 6) AS share_of_max FROM i")
def o4_importance_ranking(t):
    return ev.importance_ranking(importances(t)).withColumn("share_of_max", F.round("share_of_max", 6))


@query("j6_importance_map", f"""{_IMPORTANCE} SELECT string_agg(feature, ',' ORDER BY feature) AS features, count(*) AS n,
  max(importance) FILTER (WHERE feature = 'click') AS click FROM i""")
def j6_importance_map(t):
    """Names and values to one map."""
    pairs = importances(t).agg(F.array_sort(F.collect_list(F.struct("feature", "importance"))).alias("v"))
    mapped = pairs.select(importance_map(F.col("v.feature"), F.col("v.importance")).alias("m"))
    return mapped.select(F.array_join(F.map_keys("m"), ",").alias("features"),
                         F.size("m").cast("long").alias("n"), F.element_at("m", "click").alias("click"))


_ORDERED = """o AS (SELECT guid, nivel_triaje,
  row_number() OVER (ORDER BY nivel_triaje, md5('42:' || guid), guid) - 1 AS position,
  row_number() OVER (PARTITION BY nivel_triaje ORDER BY md5('42:' || guid), guid) - 1 AS class_position FROM results)"""


@query("o7_stratified_folds", f"WITH {_ORDERED} SELECT guid, nivel_triaje, CAST(position % 5 AS INT) AS fold FROM o")
def o7_stratified_folds(t):
    return stratified_folds(t.results.select("guid", "nivel_triaje"), "nivel_triaje", "guid")


@query("o6_stratified_split", f"""WITH {_ORDERED},
c AS (SELECT nivel_triaje, count(*) AS n_c FROM results GROUP BY 1),
w AS (SELECT sum(n_c) AS n, ceil(CAST(sum(n_c) AS DOUBLE) * 0.2::DOUBLE)::BIGINT AS wanted FROM c),
s AS (SELECT nivel_triaje, (n_c * wanted) // n AS whole, (n_c * wanted) % n AS remainder, wanted FROM c, w),
q AS (SELECT nivel_triaje, whole + CASE WHEN row_number() OVER (ORDER BY remainder DESC, nivel_triaje)
  <= wanted - (SELECT sum(whole) FROM s) THEN 1 ELSE 0 END AS quota FROM s)
SELECT guid, o.nivel_triaje, class_position < quota AS is_test FROM o JOIN q ON o.nivel_triaje = q.nivel_triaje""")
def o6_stratified_split(t):
    return stratified_split(t.results.select("guid", "nivel_triaje"), "nivel_triaje", "guid")


@query("m10_rating", """SELECT guid, CAST(round(greatest(0, CAST(confianza AS DECIMAL(20, 15)) - abs(prediccion_modelo
  - coalesce(nullif(CASE WHEN doc_id % 11 = 0 THEN 0 ELSE nivel_triaje END, 0), prediccion_modelo)) * 0.25) * 10, 1) AS DOUBLE) AS valoracion
  FROM predictions WHERE prediccion_modelo IS NOT NULL""")
def m10_rating(t):
    """A level of 0 counts as no level: no penalty."""
    level = F.when(F.col("doc_id") % 11 == 0, 0).otherwise(F.col("nivel_triaje"))
    return predicted(t).select("guid", rating(F.col("confianza"), F.col("prediccion_modelo"), level).alias("valoracion"))
