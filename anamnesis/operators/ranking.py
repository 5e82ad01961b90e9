"""Stratified split and folds that never sort a whole class in one task.

A class may hold most rows, so ``row_number`` over a class would send them all
to one task. Rows are instead ranked inside small hash buckets, and bucket
counts (classes x 16^digits rows, whatever the input size) give each bucket its
offset. The result equals one global sort by (class, hash, key).
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import FOLDS, SEED, TEST_FRACTION

BUCKET_DIGITS = 3


def shuffle_key(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """As ``left.join(right, on)``, but null equals null."""
    named = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    both = left.join(named, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return both.select(*on, *(c for c in (*left.columns, *right.columns) if c not in on))


def class_positions(
    df: DataFrame, label: str, key: str, seed: int = SEED, digits: int = BUCKET_DIGITS,
    per_class: DataFrame | None = None,
) -> DataFrame:
    """Adds 0-based ``position`` (all rows, class by class), ``class_position``,
    ``class_size`` and ``n_rows``. ``key`` must be unique. A null label is a class
    like others, the first; a null key comes first in its class.

    Columns of ``per_class`` ride along on the bucket counts, so that they need
    no join of their own on the class, where one key may hold most rows.
    """
    keyed = df.withColumn("_mix", shuffle_key(F.col(key), seed)).withColumn(
        "_bucket", F.substring("_mix", 1, digits)
    )
    counts = keyed.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy(label, "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    of_class = Window.partitionBy(label)
    everything = Window.partitionBy()
    offsets = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(
            label, "_bucket", "_before",
            F.min("_before").over(of_class).alias("_class_start"),
            F.sum("_n").over(of_class).alias("class_size"),
            F.sum("_n").over(everything).alias("n_rows"),
        )
    )
    if per_class is not None:
        offsets = _join_null_safe(offsets, per_class, [label])
    in_bucket = Window.partitionBy(label, "_bucket").orderBy("_mix", key)
    ranked = keyed.withColumn("_rn", F.row_number().over(in_bucket))
    position = F.col("_before") + F.col("_rn") - 1
    return (
        _join_null_safe(ranked, offsets, [label, "_bucket"])
        .withColumn("position", position)
        .withColumn("class_position", F.col("position") - F.col("_class_start"))
        .drop("_mix", "_bucket", "_rn", "_before", "_class_start")
    )


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = FOLDS, seed: int = SEED
) -> DataFrame:
    """Adds ``fold``. Rows are dealt in class order, so fold sizes differ by one
    at most and a class with fewer rows than folds is no error."""
    placed = class_positions(df, label, key, seed)
    return placed.withColumn("fold", (F.col("position") % folds).cast("int")).drop(
        "position", "class_position", "class_size", "n_rows"
    )


def held_out_quotas(class_sizes: DataFrame, label: str, fraction: float = TEST_FRACTION) -> DataFrame:
    """Held-out rows per class: whole shares first, left-over rows to the
    classes with the largest remainders. One row per class in and out."""
    everything = Window.partitionBy()
    by_remainder = Window.orderBy(F.desc("_remainder"), label)
    return (
        class_sizes.withColumn("_n", F.sum("class_size").over(everything))
        .withColumn("_wanted", F.ceil(F.col("_n") * F.lit(float(fraction))))
        .withColumn("_floor", F.expr("(class_size * _wanted) div _n"))
        .withColumn("_remainder", F.col("class_size") * F.col("_wanted") % F.col("_n"))
        .withColumn("_left", F.col("_wanted") - F.sum("_floor").over(everything))
        .withColumn("_rank", F.row_number().over(by_remainder))
        .select(label, (F.col("_floor") + (F.col("_rank") <= F.col("_left")).cast("long")).alias("quota"))
    )


def stratified_split(
    df: DataFrame, label: str, key: str, fraction: float = TEST_FRACTION, seed: int = SEED
) -> DataFrame:
    """Adds ``is_test``."""
    sizes = df.groupBy(label).agg(F.count("*").alias("class_size"))
    quotas = held_out_quotas(sizes, label, fraction)
    return (
        class_positions(df, label, key, seed, per_class=quotas)
        .withColumn("is_test", F.col("class_position") < F.col("quota"))
        .drop("position", "class_position", "class_size", "n_rows", "quota")
    )
