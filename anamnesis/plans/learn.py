"""Dataset, training and evaluation jobs."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from ..operators import evaluation as ev, models
from ..operators.features import dataset_rows, encode_raw, evaluation_rows, training_rows_from_encoded
from ..operators.state import latest_rows, move_all
from ..schemas import (
    DATASET_READY, ENRICHED, EVALUATED, LEVELS, MODEL_PREFIX, MODEL_TRAINED, TARGET, TREES,
)
from ..session import materialize
from ..sources.artifacts import (
    latest_dataset, latest_model, require_artifact, write_dataset, write_evaluation, write_model,
)
from ..sources.store import Store


def build_dataset(store: Store, exclude_simulated: bool = False) -> str:
    """Encoded rows of all enriched cases as a dated CSV folder; its cases move
    on. The set of cases is fixed first, so late arrivals wait for the next
    dataset."""
    at = datetime.now(timezone.utc)
    results = latest_rows(store.read("annotations"), "guid", ["ts", "seq"])
    rows = materialize(
        dataset_rows(store.cases(["especialidad", "origen"]), results, exclude_simulated), "dataset"
    )
    if rows.isEmpty():
        raise ValueError("no enriched case to build a dataset from")
    name = write_dataset(encode_raw(rows), store.datasets, at)
    moved = rows.select("guid", F.lit(ENRICHED).alias("estado"))
    store.append("case_log", move_all(
        moved, ENRICHED, DATASET_READY, at, 5, url_dataset_generado=f"{store.datasets}/{name}"
    ))
    return name


def hold_out_scores(model: models.Model, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-class and overall scores on rows the model has not seen."""
    counts = ev.confusion_counts(models.predict(model, test), TARGET, "prediccion_modelo")
    scores = ev.class_scores(counts)
    return scores, ev.overall_scores(scores)


def training_report(rows: DataFrame, key: str = "guid", trees: int = TREES) -> tuple[models.PartedForest, DataFrame]:
    """Fits the forest on the training part and compares it with the baseline.

    Returns the forest and a one-row summary; the summary's map has one entry
    per class.
    """
    parts = models.split(rows, key).persist()
    train, test = parts.where(~F.col("is_test")), parts.where("is_test")
    forest, baseline = models.fit_forest(train, trees), models.fit_logistic(train)
    forest_scores, forest_overall = hold_out_scores(forest, test)
    _, baseline_overall = hold_out_scores(baseline, test)
    weights = ev.class_weights(rows.where(F.col(TARGET).isin(LEVELS)))
    cv = ev.cross_validation_summary(models.cross_validate(rows, key, trees))
    report = forest_scores.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        F.col("clase").cast("string"), F.struct("precision", "recall", "f1", "support")
    ))))).alias("v"))
    weight_map = weights.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        F.col(TARGET).cast("string"), F.round("weight", 3)
    )))).alias("v"))
    summary = rows.agg(F.count("*").alias("n_samples")).select(
        forest_overall.select("accuracy").scalar().alias("rf_accuracy"),
        baseline_overall.select("accuracy").scalar().alias("lr_accuracy"),
        cv.select("cv_f1_macro").scalar().alias("cv_f1_macro"),
        report.select("v").scalar().alias("classification_report"),
        weight_map.select("v").scalar().alias("class_weights"),
        "n_samples",
    )
    summary = materialize(summary, "training-summary")
    parts.unpersist()
    return forest, summary


def train(store: Store, trees: int = TREES) -> DataFrame:
    """Trains on the newest dataset, saves the forest, moves the dataset's
    cases on. Returns the one-row summary."""
    started = datetime.now(timezone.utc)
    _, dataset = latest_dataset(store.spark, store.datasets)
    rows = materialize(training_rows_from_encoded(dataset), "training")
    model, summary = training_report(rows, trees=trees)
    ended = datetime.now(timezone.utc)
    name = write_model(store.spark, model, store.models, ended)
    ready = store.cases([]).join(dataset.select("guid"), "guid", "left_semi")
    store.append("case_log", move_all(
        ready, DATASET_READY, MODEL_TRAINED, ended, 6,
        url_modelo_entrenado=f"{store.models}/{name}",
        inicio_entrenamiento=started, fin_entrenamiento=ended,
    ))
    return summary.withColumn("modelo", F.lit(name))


def evaluation_document(
    predicted: DataFrame, folds: DataFrame, importances: DataFrame, model: str, dataset: str
) -> DataFrame:
    """One row in the stored shape. ``predicted`` holds rows with level and
    prediction, ``folds`` the macro F1 per fold."""
    matrix = ev.confusion_matrix(predicted)
    scores = ev.class_scores(matrix)
    summary = ev.cross_validation_summary(folds)
    cv = summary.select(F.struct(*summary.columns)).scalar()

    def per_class(level):
        mine = F.col("clase") == level
        return F.struct(
            F.max(F.when(mine, F.col("precision"))).alias("precision"),
            F.max(F.when(mine, F.col("recall"))).alias("recall"),
            F.max(F.when(mine, F.col("f1"))).alias("f1-score"),
            F.max(F.when(mine, F.col("support"))).alias("support"),
        ).alias(f"C{level}")

    n = F.sum("support")

    def average(name, how):
        if how == "macro":
            value = F.avg(name)
        else:
            value = F.sum(F.col(name) * F.col("support")) / n
        return value.alias("f1-score" if name == "f1" else name)

    def averages(how):
        parts = [average(name, how) for name in ("precision", "recall", "f1")]
        return F.struct(*parts, n.alias("support")).alias(f"{how} avg")

    report = scores.agg(F.struct(
        *[per_class(level) for level in LEVELS],
        (F.sum("tp") / n).alias("accuracy"), averages("macro"), averages("weighted"),
    ).alias("v"))
    rows = ev.matrix_rows(matrix).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(
            "actual", F.array(*[F.col(f"pred_{level}") for level in LEVELS]).alias("counts")
        ))), lambda row: row["counts"],
    ).alias("v"))
    return importances.select(
        F.lit(model).alias("modelo"), F.lit(dataset).alias("dataset"),
        F.round(cv["cv_f1_macro"], 4).alias("cv_f1_macro"),
        F.round(cv["cv_f1_std"], 4).alias("cv_f1_std"),
        report.select("v").scalar().alias("classification_report"),
        rows.select("v").scalar().alias("confusion_matrix"),
        ev.under_triage_count(predicted).select("under_triage_count").scalar().alias("under_triage_count"),
        "feature_importances",
    )


def evaluate(store: Store, trees: int = TREES) -> tuple[DataFrame, DataFrame]:
    """Evaluates the newest model on the newest dataset, training rows
    included, and stores the document. Returns it with the critical cases."""
    at = datetime.now(timezone.utc)
    spark = store.spark
    model_name, model = latest_model(spark, store.models)
    dataset_name, dataset = latest_dataset(spark, store.datasets)
    rows = materialize(evaluation_rows(dataset), "evaluation")
    predicted = materialize(models.predict(model, rows).drop("probabilidades"), "predicted")
    folds = materialize(models.cross_validate(rows, trees=trees), "folds")
    document = evaluation_document(
        predicted, folds, models.feature_importances(spark, model), model_name, dataset_name
    )
    write_evaluation(document, store.evaluations, at)
    trained = materialize(store.cases([]).where(F.col("estado") == MODEL_TRAINED), "trained")
    store.append("case_log", move_all(trained, MODEL_TRAINED, EVALUATED, at, 7))
    return document, ev.under_triage_listing(predicted)


def require_model(store: Store) -> str:
    """Checked before any row is written."""
    return require_artifact(
        store.spark, store.models, MODEL_PREFIX, "MODEL_NOT_FOUND: no model has been trained"
    )
