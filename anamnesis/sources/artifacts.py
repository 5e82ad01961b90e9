"""Versioned datasets, models and evaluation documents.

A version is a folder named by prefix and UTC second, so the newest name is the
newest version. Its name enters the folder's manifest only after it has been
written, so a half-written version is never picked up.
"""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.models import PartedForest
from ..schemas import DATASET, DATASET_PREFIX, EVALUATION, EVALUATION_PREFIX, MODEL_PREFIX
from ..session import small_table

MANIFEST = "name string"


def versioned_name(prefix: str, at: datetime) -> str:
    return f"{prefix}{at:%Y%m%d_%H%M%S}"


def latest_by_prefix(names: DataFrame, prefix: str, name: str = "name") -> DataFrame:
    """One row with the last name of a prefix; null when there is none."""
    return names.where(F.col(name).startswith(prefix)).agg(F.max(name).alias("latest"))


def _manifest(folder: str) -> str:
    return f"{folder}/manifest"


def publish(spark: SparkSession, folder: str, name: str) -> str:
    """Puts a written version on record."""
    small_table(spark, [(name,)], MANIFEST).write.mode("append").parquet(_manifest(folder))
    return name


def published(spark: SparkSession, folder: str) -> DataFrame:
    """Names on record; a folder without a manifest has none."""
    try:
        return spark.read.schema(MANIFEST).parquet(_manifest(folder))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def latest_artifact(spark: SparkSession, folder: str, prefix: str) -> str | None:
    return latest_by_prefix(published(spark, folder), prefix).first()["latest"]


def require_artifact(spark: SparkSession, folder: str, prefix: str, error: str) -> str:
    name = latest_artifact(spark, folder, prefix)
    if name is None:
        raise FileNotFoundError(error)
    return name


def write_dataset(rows: DataFrame, folder: str, at: datetime) -> str:
    name = versioned_name(DATASET_PREFIX, at)
    rows.write.option("header", True).csv(f"{folder}/{name}")
    return publish(rows.sparkSession, folder, name)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DATASET).option("header", True).csv(path)


def latest_dataset(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    name = require_artifact(spark, folder, DATASET_PREFIX, "no dataset has been built")
    return name, read_dataset(spark, f"{folder}/{name}")


def write_model(spark: SparkSession, model: PartedForest, folder: str, at: datetime) -> str:
    name = versioned_name(MODEL_PREFIX, at)
    model.save(f"{folder}/{name}")
    return publish(spark, folder, name)


def latest_model(spark: SparkSession, folder: str) -> tuple[str, PartedForest]:
    name = require_artifact(spark, folder, MODEL_PREFIX, "MODEL_NOT_FOUND: no model has been trained")
    return name, PartedForest.load(spark, f"{folder}/{name}")


def write_evaluation(document: DataFrame, folder: str, at: datetime) -> str:
    """The document has one row."""
    name = versioned_name(EVALUATION_PREFIX, at)
    document.coalesce(1).write.json(f"{folder}/{name}")
    return publish(document.sparkSession, folder, name)


def latest_evaluation(spark: SparkSession, folder: str) -> DataFrame | None:
    name = latest_artifact(spark, folder, EVALUATION_PREFIX)
    return None if name is None else spark.read.schema(EVALUATION).json(f"{folder}/{name}")
