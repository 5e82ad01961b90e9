"""Class weights, confusion matrix, class scores, under-triage, data quality.

Every report starts with one map-side combined count; what follows works on a
few dozen rows.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import AUDIT_ANXIETY, FEATURES, FLAGS, LEVELS, TARGET

# Allowed range per numeric column, and allowed codes of sex.
NUMERIC_DOMAINS = {
    "nivel_triaje": (1, 5),
    "score_urgencia": (0, 100),
    "score_ansiedad": (0, 1),
    "dolor_intensidad": (0, 10),
    "edad": (0, 120),
}
SEX_DOMAIN = ["M", "F"]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom != 0, top / bottom).otherwise(0.0)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and percent of all, one decimal."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    share = F.col("n") * F.lit(100).cast("decimal(3,0)") / F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(share, 1).cast("double"))


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """n / (classes x rows of the class); one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_c"))
    every = Window.partitionBy()
    return counts.select(
        label, "n_c",
        (F.sum("n_c").over(every) / (F.count("*").over(every) * F.col("n_c"))).alias("weight"),
    )


def sample_summary(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.agg(F.count("*").alias("n_samples"), F.countDistinct(label).alias("n_classes"))


def confusion_counts(df: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    return df.groupBy(
        *by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, actual: str = TARGET, predicted: str = "prediccion_modelo",
    levels: list[int] = LEVELS,
) -> DataFrame:
    """Long form over fixed labels, zeros included; other labels are left out."""
    size = len(levels)
    labels = F.array(*[F.lit(level) for level in levels])
    grid = df.sparkSession.range(size * size, numPartitions=1).select(
        F.get(labels, F.expr(f"CAST(id DIV {size} AS INT)")).alias("actual"),
        F.get(labels, F.expr(f"CAST(id % {size} AS INT)")).alias("predicted"),
    )
    counts = confusion_counts(
        df.where(F.col(actual).isin(levels) & F.col(predicted).isin(levels)), actual, predicted
    )
    return grid.join(counts, ["actual", "predicted"], "left").fillna(0, ["n"])


def matrix_rows(matrix: DataFrame, levels: list[int] = LEVELS) -> DataFrame:
    """Long form to one row per actual class, predicted classes as columns."""
    return matrix.groupBy("actual").agg(*[
        F.sum(F.when(F.col("predicted") == level, F.col("n")).otherwise(0)).alias(f"pred_{level}")
        for level in levels
    ])


def class_scores(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of each class seen as actual or
    predicted. Undefined ratios are zero."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col("actual").alias("clase"), hit.alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed")),
        F.struct(F.col("predicted").alias("clase"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed")),
    )))
    sums = sides.groupBy(*by, "clase").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("claimed").alias("claimed")
    )
    return sums.select(
        *by, "clase",
        _ratio(F.col("tp"), F.col("claimed")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("claimed")).alias("f1"),
        "support", "tp",
    )


def overall_scores(scores: DataFrame) -> DataFrame:
    """Accuracy, plain and support-weighted averages, as one row."""
    n = F.sum("support")

    def weighted(name):
        return F.sum(F.col(name) * F.col("support")) / n

    return scores.agg(
        (F.sum("tp") / n).alias("accuracy"),
        *[F.avg(name).alias(f"macro_{name}") for name in ("precision", "recall", "f1")],
        *[weighted(name).alias(f"weighted_{name}") for name in ("precision", "recall", "f1")],
        n.alias("support"),
    )


def fold_scores(predictions: DataFrame, actual: str = TARGET, predicted: str = "prediccion_modelo",
                fold: str = "fold") -> DataFrame:
    """Macro F1 per fold, over the classes seen in that fold."""
    counts = confusion_counts(predictions, actual, predicted, [fold])
    return class_scores(counts, [fold]).groupBy(fold).agg(F.avg("f1").alias("f1_macro"))


def cross_validation_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(
        F.avg("f1_macro").alias("cv_f1_macro"), F.stddev_pop("f1_macro").alias("cv_f1_std")
    )


# Three tests of under-triage are in use; they answer different questions.

def is_critical_under_triage(level: Column, predicted: Column) -> Column:
    """An urgent case (level 1 or 2) put at a less urgent level."""
    return (level <= 2) & (predicted > level)


def is_audit_case(level: Column, predicted: Column, anxiety: Column) -> Column:
    """Any case put at a less urgent level while the patient is anxious."""
    return (predicted > level) & (anxiety >= AUDIT_ANXIETY)


def is_shown_under_triage(level: Column, predicted: Column) -> Column:
    return predicted > level


def under_triage_count(df: DataFrame, level: str = TARGET, predicted: str = "prediccion_modelo") -> DataFrame:
    test = is_critical_under_triage(F.col(level), F.col(predicted))
    return df.agg(F.count_if(test).alias("under_triage_count"))


def under_triage_listing(df: DataFrame, level: str = TARGET, predicted: str = "prediccion_modelo") -> DataFrame:
    test = is_critical_under_triage(F.col(level), F.col(predicted))
    return df.where(test).select("guid", level, predicted, "score_urgencia")


def importance_ranking(importances: DataFrame) -> DataFrame:
    """(feature, importance) by falling importance, with the share of the top.

    A model has few features, so the sort is small.
    """
    top = importances.agg(F.max("importance")).scalar()
    return importances.select(
        "feature", "importance", _ratio(F.col("importance"), top).alias("share_of_max")
    ).orderBy(F.desc("importance"), "feature")


def quality_report(results: DataFrame) -> DataFrame:
    """Nulls and domain violations per column, in one pass over the table."""
    columns = [name for name in dict.fromkeys([*FEATURES, *FLAGS, TARGET]) if name in results.columns]
    measures = []
    for name in columns:
        value = F.col(name)
        if name in NUMERIC_DOMAINS:
            low, high = NUMERIC_DOMAINS[name]
            bad = ~value.between(low, high)
        elif name == "sexo":
            bad = ~value.isin(SEX_DOMAIN)
        else:
            bad = F.lit(False)
        measures += [
            F.count_if(value.isNull()).alias(f"{name}_nulls"),
            F.count_if(bad).alias(f"{name}_bad"),
        ]
    one = results.agg(F.count("*").alias("n_rows"), *measures)
    return one.select("n_rows", F.inline(F.array(*[
        F.struct(F.lit(name).alias("columna"), F.col(f"{name}_nulls").alias("n_null"),
                 F.col(f"{name}_bad").alias("n_violations"))
        for name in columns
    ])))
