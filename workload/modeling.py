"""Models: M5-M9, M11-M15. Forests have no SQL form, so these are checked by
rows here and by bounds in the tests."""

from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from anamnesis.operators import evaluation as ev, models as md
from anamnesis.operators.annotate import rule_fields
from anamnesis.operators.features import training_rows_from_raw
from anamnesis.plans import learn
from anamnesis.plans.enrich import preprocess
from anamnesis.plans.score import response_rows, score, score_enriched, with_ids
from anamnesis.schemas import TARGET
from anamnesis.session import materialize, scratch_path
from anamnesis.sources.artifacts import latest_model, write_model
from anamnesis.sources.store import Store
from anamnesis.sources.texts import on_demand_input

from .registry import query
from .replies import _LEVEL

_TRAINED: dict[tuple, tuple] = {}


def training_rows(t):
    return training_rows_from_raw(t.results).select("guid", *md.FEATURES, TARGET)


def learned_from(t):
    """The training rows of a session and folder, written once: a split and folds read them several times each."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, "rows")
    if key not in _TRAINED:
        _TRAINED[key] = materialize(training_rows(t), "training-rows")
    return _TRAINED[key]


def trained(t):
    """The split and the forest of a session and folder; fitted once, as several
    queries look at the same model."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _TRAINED:
        parts = materialize(md.split(learned_from(t)), "split")
        train = parts.where(~F.col("is_test"))
        _TRAINED[key] = (parts, md.fit_forest(train))
    return _TRAINED[key]


def cross_validated(t):
    key = (t.spark.sparkContext.applicationId, t.sf_dir, "folds")
    if key not in _TRAINED:
        _TRAINED[key] = materialize(md.fold_predictions(learned_from(t)), "folds")
    return _TRAINED[key]


def fitted(t, *more):
    """What ``trained`` and ``cross_validated`` give, worked on at once, as the short jobs of one fit leave
    cores to the other; ``more`` are made of the first two as soon as they are there."""
    def first():
        parts, forest = trained(t)
        return parts, forest, [make(parts) for make in more]

    learned_from(t)
    inherits = inheritable_thread_target(t.spark)
    with ThreadPool(2) as pool:
        (parts, forest, made), folds = pool.map(
            lambda work: work(), [inherits(first), inherits(lambda: cross_validated(t))], chunksize=1)
    return parts, forest, folds, *made


def baseline_of(parts):
    return md.fit_logistic(parts.where(~F.col("is_test")))


@query("m5_forest_predictions")
def m5_forest_predictions(t):
    """Held-out rows with the forest's level, confidence and class votes."""
    parts, forest = trained(t)
    scored = md.predict(forest, parts.where("is_test"))
    return scored.select("guid", TARGET, "prediccion_modelo", "confianza",
                         F.aggregate("probabilidades", F.lit(0.0), lambda a, x: a + x).alias("total"))


# The held-out part as SQL tells it: quotas by level, filled in the order of a hash.
_HELD = """
WITH c AS (SELECT guid, nivel_triaje FROM results WHERE score_urgencia IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY nivel_triaje ORDER BY md5('42:' || guid), guid) - 1 AS place FROM c),
s AS (SELECT nivel_triaje, count(*) AS n_c, sum(count(*)) OVER () AS n FROM c GROUP BY 1),
w AS (SELECT *, ceil(n::DOUBLE * 0.2::DOUBLE)::BIGINT AS wanted FROM s),
f AS (SELECT nivel_triaje, (n_c * wanted) // n AS whole, (n_c * wanted) % n AS rest, wanted FROM w),
q AS (SELECT nivel_triaje, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, nivel_triaje)
  <= wanted - (SELECT sum(whole) FROM f) THEN 1 ELSE 0 END AS quota FROM f)"""


@query("m5_forest_invariants", f"""{_HELD}
SELECT guid, o.nivel_triaje, true AS in_scale, true AS votes_sum_to_one, true AS confidence_is_top_vote
FROM o JOIN q USING (nivel_triaje) WHERE place < quota""")
def m5_forest_invariants(t):
    """The held-out rows are the right ones, and each prediction is sound."""
    parts, forest = trained(t)
    scored = md.predict(forest, parts.where("is_test"))
    total = F.aggregate("probabilidades", F.lit(0.0), lambda a, x: a + x)
    top = F.element_at("probabilidades", F.col("prediccion_modelo"))
    return scored.select(
        "guid", TARGET, F.col("prediccion_modelo").between(1, 5).alias("in_scale"),
        (F.abs(total - 1) < 1e-9).alias("votes_sum_to_one"), (top == F.col("confianza")).alias("confidence_is_top_vote"),
    )


@query("m8_out_of_fold_rows", """
WITH c AS (SELECT guid, nivel_triaje FROM results WHERE score_urgencia IS NOT NULL)
SELECT guid, nivel_triaje, CAST((row_number() OVER (ORDER BY nivel_triaje, md5('42:' || guid), guid) - 1) % 5 AS INT) AS fold,
  true AS in_scale FROM c""")
def m8_out_of_fold_rows(t):
    """Every row is predicted once, by the model that has not seen its fold."""
    return cross_validated(t).select("guid", TARGET, "fold", F.col("prediccion_modelo").between(1, 5).alias("in_scale"))


@query("m6_logistic_predictions")
def m6_logistic_predictions(t):
    parts, _ = trained(t)
    baseline = md.fit_logistic(parts.where(~F.col("is_test")))
    return md.predict(baseline, parts.where("is_test")).select("guid", TARGET, "prediccion_modelo", "confianza")


@query("m7_holdout_report")
def m7_holdout_report(t):
    """Accuracy of both models and the forest's class scores on held-out rows."""
    parts, forest = trained(t)
    baseline = md.fit_logistic(parts.where(~F.col("is_test")))
    test = parts.where("is_test")
    scores, overall = learn.hold_out_scores(forest, test)
    _, other = learn.hold_out_scores(baseline, test)
    return scores.drop("tp").withColumns({
        "rf_accuracy": overall.select("accuracy").scalar(), "lr_accuracy": other.select("accuracy").scalar(),
    })


@query("m8_cross_validation")
def m8_cross_validation(t):
    return ev.cross_validation_summary(ev.fold_scores(cross_validated(t)))


@query("m9_class_probabilities")
def m9_class_probabilities(t):
    """One row per case and class of the held-out part."""
    parts, forest = trained(t)
    scored = md.predict(forest, parts.where("is_test"))
    return scored.select("guid", "prediccion_modelo", "confianza", F.posexplode("probabilidades").alias("pos", "p")).select(
        "guid", "prediccion_modelo", "confianza", (F.col("pos") + 1).alias("nivel"), "p")


@query("m11_feature_importances")
def m11_feature_importances(t):
    _, forest = trained(t)
    one = md.feature_importances(t.spark, forest)
    return ev.importance_ranking(one.select(F.explode("feature_importances").alias("feature", "importance")))


@query("m12_training_summary")
def m12_training_summary(t):
    """Accuracies, cross-validation, weights and size, from shared fits."""
    parts, forest, folds, baseline = fitted(t, baseline_of)
    test = parts.where("is_test")
    cv = ev.cross_validation_summary(ev.fold_scores(folds))
    return parts.agg(F.count("*").alias("n_samples"), F.countDistinct(TARGET).alias("n_classes")).select(
        "*", learn.hold_out_scores(forest, test)[1].select("accuracy").scalar().alias("rf_accuracy"),
        learn.hold_out_scores(baseline, test)[1].select("accuracy").scalar().alias("lr_accuracy"),
        cv.select("cv_f1_macro").scalar().alias("cv_f1_macro"), cv.select("cv_f1_std").scalar().alias("cv_f1_std"),
    )


@query("m13_evaluation_document")
def m13_evaluation_document(t):
    """The evaluation document over all rows, as JSON."""
    parts, forest, folds = fitted(t)
    predicted = md.predict(forest, parts).drop("probabilidades")
    made = learn.evaluation_document(
        predicted, ev.fold_scores(folds), md.feature_importances(t.spark, forest), "modelo_1", "dataset_1")
    return made.select("modelo", "dataset", "cv_f1_macro", "cv_f1_std", "under_triage_count",
                       F.to_json("classification_report").alias("classification_report"),
                       F.to_json("confusion_matrix").alias("confusion_matrix"),
                       F.to_json("feature_importances").alias("feature_importances"))


@query("m14_score_texts")
def m14_score_texts(t):
    """Whole texts to response rows: preprocess, annotate, predict, rate."""
    _, forest = trained(t)
    named = t.planted.withColumnRenamed("nombre_fichero", "filename")
    prepared = preprocess(named).select("guid", "filename", "texto_anotable")
    responses = response_rows(score_enriched(rule_fields(prepared, "texto_anotable"), forest))
    return responses.withColumn("entidades_normalizadas", F.array_join("entidades_normalizadas", ","))


@query("m14_annotated_side", f"""
WITH told AS (SELECT *, {_LEVEL} AS nivel FROM interviews)
SELECT guid, nivel AS nivel_triaje_llm, 0.2::DOUBLE AS score_ansiedad, true AS rating_in_range,
  true AS code_matches FROM told""")
def m14_annotated_side(t):
    """Of the response rows: the annotator's fields, which SQL can tell, and
    the range of the rating."""
    return m14_score_texts(t).select(
        "guid", "nivel_triaje_llm", "score_ansiedad", F.col("valoracion").between(0, 10).alias("rating_in_range"),
        (F.col("nivel_manchester") == F.concat(F.lit("C"), "nivel_triaje_predicho")).alias("code_matches"),
    )


@query("s14_model_round_trip", """SELECT guid, 'modelo_20240101_000000' AS model, true AS same_level, true AS same_confidence
  FROM results WHERE score_urgencia IS NOT NULL""")
def s14_model_round_trip(t):
    """The newest saved model predicts what the fitted one does."""
    parts, forest = trained(t)
    folder = scratch_path(t.spark, "models")
    for year in (2023, 2024):
        write_model(t.spark, forest, folder, datetime(year, 1, 1, tzinfo=timezone.utc))
    name, loaded = latest_model(t.spark, folder)
    before = md.predict(forest, parts).select(
        "guid", F.col("confianza").alias("confidence"), F.col("prediccion_modelo").alias("level"))
    return md.predict(loaded, parts).join(before, "guid").select(
        "guid", F.lit(name).alias("model"), (F.col("prediccion_modelo") == F.col("level")).alias("same_level"),
        (F.col("confianza") == F.col("confidence")).alias("same_confidence"))


@query("m6_logistic_invariants", f"""{_HELD}
SELECT guid, o.nivel_triaje, true AS in_scale, true AS votes_sum_to_one FROM o JOIN q USING (nivel_triaje) WHERE place < quota""")
def m6_logistic_invariants(t):
    parts, _ = trained(t)
    baseline = md.fit_logistic(parts.where(~F.col("is_test")))
    total = F.aggregate("probabilidades", F.lit(0.0), lambda a, x: a + x)
    return md.predict(baseline, parts.where("is_test")).select(
        "guid", TARGET, F.col("prediccion_modelo").between(1, 5).alias("in_scale"), (F.abs(total - 1) < 1e-9).alias("votes_sum_to_one"))


@query("m7_report_over_predictions", f"""{_HELD}
SELECT nivel_triaje, CAST(quota AS BIGINT) AS support, true AS same_hits, true AS same_recall, true AS same_accuracy FROM q WHERE quota > 0""")
def m7_report_over_predictions(t):
    """The report's figures against plain counts over the predictions it is about."""
    parts, forest = trained(t)
    test = materialize(md.predict(forest, parts.where("is_test")).select(TARGET, "prediccion_modelo"), "held-out")
    scores, overall = learn.hold_out_scores(forest, parts.where("is_test"))
    hit = (F.col(TARGET) == F.col("prediccion_modelo")).cast("int")
    plain = test.groupBy(TARGET).agg(F.count("*").alias("n"), F.sum(hit).alias("hits"))
    accuracy = test.agg(F.avg(hit)).scalar()
    return scores.join(plain, F.col("clase") == F.col(TARGET)).select(
        TARGET, F.col("support").cast("long").alias("support"), (F.col("tp") == F.col("hits")).alias("same_hits"),
        (F.abs(F.col("recall") - F.col("hits") / F.col("n")) < 1e-9).alias("same_recall"),
        (F.abs(overall.select("accuracy").scalar() - accuracy) < 1e-9).alias("same_accuracy"))


@query("m8_scores_over_folds", """WITH c AS (SELECT guid, nivel_triaje FROM results WHERE score_urgencia IS NOT NULL),
f AS (SELECT (row_number() OVER (ORDER BY nivel_triaje, md5('42:' || guid), guid) - 1) % 5 AS fold FROM c)
SELECT CAST(fold AS INT) AS fold, count(*) AS n, true AS same_mean FROM f GROUP BY fold""")
def m8_scores_over_folds(t):
    rows = cross_validated(t)
    scores = ev.fold_scores(rows)
    summary = ev.cross_validation_summary(scores).select("cv_f1_macro").scalar()
    mean = scores.agg(F.avg("f1_macro")).scalar()
    return rows.groupBy("fold").agg(F.count("*").alias("n")).select(
        F.col("fold").cast("int").alias("fold"), "n", (F.abs(summary - mean) < 1e-4).alias("same_mean"))


@query("m9_votes_by_class", f"""{_HELD}
SELECT guid, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS nivel, true AS in_range, true AS top_is_predicted
FROM o JOIN q USING (nivel_triaje) WHERE place < quota""")
def m9_votes_by_class(t):
    rows = m9_class_probabilities(t)
    return rows.select(
        "guid", F.col("nivel").cast("int").alias("nivel"), F.col("p").between(0, 1).alias("in_range"),
        ((F.col("nivel") != F.col("prediccion_modelo")) | (F.col("p") == F.col("confianza"))).alias("top_is_predicted"))


@query("m11_importances_sum_to_one", "SELECT unnest([" + ", ".join(f"'{name}'" for name in md.FEATURES) + """]) AS feature,
  true AS in_range, true AS sum_to_one""")
def m11_importances_sum_to_one(t):
    _, forest = trained(t)
    rows = md.feature_importances(t.spark, forest).select(F.explode("feature_importances").alias("feature", "importance"))
    total = rows.agg(F.sum("importance")).scalar()
    return rows.select("feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sum_to_one"))


@query("m12_summary_over_predictions", """SELECT count(*) AS n_samples, count(DISTINCT nivel_triaje) AS n_classes,
  true AS same_forest, true AS same_baseline FROM results WHERE score_urgencia IS NOT NULL""")
def m12_summary_over_predictions(t):
    parts, forest = trained(t)
    test = parts.where("is_test")
    baseline = md.fit_logistic(parts.where(~F.col("is_test")))
    hit = F.avg((F.col(TARGET) == F.col("prediccion_modelo")).cast("int"))
    told = m12_training_summary(t)
    return told.select(
        "n_samples", "n_classes",
        (F.abs(F.col("rf_accuracy") - md.predict(forest, test).agg(hit).scalar()) < 1e-9).alias("same_forest"),
        (F.abs(F.col("lr_accuracy") - md.predict(baseline, test).agg(hit).scalar()) < 1e-9).alias("same_baseline"))


@query("m13_document_rows", """SELECT CAST(nivel_triaje AS INT) AS nivel, count(*) AS support, count(*) AS row_sum
  FROM results WHERE score_urgencia IS NOT NULL GROUP BY 1""")
def m13_document_rows(t):
    """Supports and matrix rows of the stored document, by level."""
    parts, forest, folds = fitted(t)
    made = learn.evaluation_document(
        md.predict(forest, parts).drop("probabilidades"), ev.fold_scores(folds),
        md.feature_importances(t.spark, forest), "modelo_1", "dataset_1")
    supports = F.array(*[F.col(f"classification_report.C{level}.support").cast("long") for level in range(1, 6)])
    return made.select(F.posexplode(F.arrays_zip(supports.alias("s"), F.col("confusion_matrix").alias("m"))).alias("pos", "r")).select(
        (F.col("pos") + 1).cast("int").alias("nivel"), F.col("r.s").alias("support"),
        F.aggregate("r.m", F.lit(0).cast("long"), lambda a, x: a + x).alias("row_sum")).where("row_sum > 0")


@query("n8_predictions_keep_their_rows", """SELECT guid, nivel_triaje, coalesce(edad, -1)::DOUBLE AS edad, score_urgencia, true AS in_scale
  FROM results WHERE score_urgencia IS NOT NULL""")
def n8_predictions_keep_their_rows(t):
    """Predictions stand beside the rows they are about; nothing is attached by position."""
    parts, forest = trained(t)
    return md.predict(forest, parts).select(
        "guid", TARGET, F.col("edad").cast("double").alias("edad"), F.col("score_urgencia").cast("double").alias("score_urgencia"),
        F.col("prediccion_modelo").between(1, 5).alias("in_scale"))


def asked(t):
    """A scoring request for every text: a file of its own."""
    return t.planted.select(F.concat("guid", F.lit(".txt")).alias("filename"), F.col("texto").cast("binary").alias("contenido"),
                            F.lit(None).cast("string").alias("texto"))


@query("m15_no_model_guard", """SELECT count(*) AS n_requests, 'MODEL_NOT_FOUND: no model has been trained' AS error,
  CAST(0 AS BIGINT) AS n_log_rows, CAST(0 AS BIGINT) AS n_texts FROM documents""")
def m15_no_model_guard(t):
    """Requests without a model are refused before any row is written."""
    store = Store(t.spark, scratch_path(t.spark, "store")).prepare()
    error = None
    try:
        score(store, asked(t))
    except FileNotFoundError as refused:
        error = str(refused)
    return asked(t).agg(F.count("*").alias("n_requests")).select(
        "n_requests", F.lit(error).alias("error"), F.lit(store.read("case_log").count()).alias("n_log_rows"),
        F.lit(store.read("transcripts").count()).alias("n_texts"))


@query("m14_scored_store", f"""SELECT guid, {_LEVEL} AS level, 'COMPLETADA' AS estado, 1::BIGINT AS n_predictions, true AS rated, true AS answered
  FROM interviews""")
def m14_scored_store(t):
    """The scoring job run twice under one name: what the store's tables say then of every request, whose
    id follows from it. Ratings are computed again from the written predictions."""
    _, forest = trained(t)
    store = Store(t.spark, scratch_path(t.spark, "store")).prepare()
    write_model(t.spark, forest, store.models, datetime(2024, 1, 1, tzinfo=timezone.utc))
    for _ in range(2):
        responses, _ = score(store, asked(t), job="morning")
    named = with_ids(on_demand_input(asked(t)), "morning").select("guid", F.expr("left(filename, length(filename) - 4)").alias("case"))
    predicted = store.read("predictions").select("guid", "prediccion_modelo", "confianza", "valoracion")
    level = store.read("annotations").select("guid", F.col("nivel_triaje").alias("level"))
    answer = responses.select("guid", F.col("nivel_triaje_predicho").alias("told"))
    rows = store.cases([]).join(named, "guid").join(level, "guid").join(predicted, "guid").join(answer, "guid")
    exact = F.col("confianza").cast("decimal(20,15)") - F.abs(F.col("prediccion_modelo") - F.col("level")) * F.lit(0.25).cast("decimal(3,2)")
    due = F.round(F.greatest(F.lit(0).cast("decimal(20,15)"), exact) * 10, 1).cast("double")
    return rows.groupBy(F.col("case").alias("guid"), "level", "estado").agg(
        F.count("*").alias("n_predictions"), F.every(due == F.col("valoracion")).alias("rated"),
        F.every(F.col("told") == F.col("prediccion_modelo")).alias("answered"))
