"""Case state on immutable files: an append-only log and latest-wins views.

Nothing is updated in place. A transition appends a row that carries only what
changed; the current case takes, per column, the newest value that was set.
The log is wide with mostly-null columns rather than a map, so a query that
needs two times reads two Parquet columns.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import (
    ERROR_ENRICHMENT, INGESTED, ORIGIN_DATASET, ORIGIN_ON_DEMAND, PHASE_TIMES,
)

CASE_ATTRIBUTES = [
    "url_texto_original", "url_dataset_generado", "url_modelo_entrenado",
    "motor_workflow", "workflow_id", "nombre_fichero", "especialidad", "origen",
]
CASE_LOG = T.StructType([
    T.StructField("guid", T.StringType()),
    T.StructField("estado", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in CASE_ATTRIBUTES],
    *[T.StructField(name, T.TimestampType()) for name in PHASE_TIMES],
])

#: What a case has, and the snapshot's row of a case: each value with the (ts, seq) that set it.
CASE_VALUES = ["estado", *CASE_ATTRIBUTES, *PHASE_TIMES]
VERSION = T.StructType([CASE_LOG["ts"], CASE_LOG["seq"]])
CASE_SNAPSHOT = T.StructType([
    CASE_LOG["guid"],
    *[kind for name in CASE_VALUES for kind in (CASE_LOG[name], T.StructField(f"{name}_version", VERSION))],
])


def newest(value: str, order: list[str]) -> Column:
    """The latest set value of a column; usable in any aggregation."""
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return F.max_by(F.when(F.col(value).isNotNull(), F.col(value)),
                    F.when(F.col(value).isNotNull(), by)).alias(value)


def current_cases(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per case. Partial aggregation runs before the only shuffle, so
    a case with very many log rows reaches its reducer as a few rows."""
    wanted = CASE_ATTRIBUTES + PHASE_TIMES if columns is None else columns
    return log.groupBy("guid").agg(
        *[newest(name, ["ts", "seq"]) for name in ["estado", *wanted]]
    )


def _versioned(log: DataFrame, names: list[str]) -> DataFrame:
    """Log rows in the shape of a snapshot."""
    at = F.struct("ts", "seq")
    return log.select("guid", *[
        column for name in names
        for column in (F.col(name), F.when(F.col(name).isNotNull(), at).alias(f"{name}_version"))])


def compacted_cases(snapshot: DataFrame | None, tail: DataFrame) -> DataFrame:
    """The next snapshot: a row per case with each newest value and its version.

    Versions make a later merge exact, also for rows that arrive late.
    """
    rows = _versioned(tail, CASE_VALUES)
    rows = rows if snapshot is None else snapshot.unionByName(rows)
    return rows.groupBy("guid").agg(*[
        column for name in CASE_VALUES
        for column in (F.max_by(name, f"{name}_version").alias(name), F.max(f"{name}_version").alias(f"{name}_version"))])


def merged_cases(snapshot: DataFrame | None, tail: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """What ``current_cases`` gives for the whole log, from a snapshot and the log since.

    Cases that the tail does not touch pass as they are: where its ids are few
    enough to be broadcast, the snapshot is scanned and never shuffled.
    """
    if snapshot is None:
        return current_cases(tail, columns)
    names = ["estado", *(CASE_ATTRIBUTES + PHASE_TIMES if columns is None else columns)]
    versions = [f"{name}_version" for name in names]
    touched = tail.select("guid").distinct()
    still = snapshot.select("guid", *names).join(touched, "guid", "left_anti")
    moved = snapshot.select("guid", *names, *versions).join(touched, "guid", "left_semi")
    moved = moved.unionByName(_versioned(tail, names)).groupBy("guid").agg(*[
        F.max_by(name, version).alias(name) for name, version in zip(names, versions)])
    return still.unionByName(moved)


def transition(
    guids: DataFrame, state: str | None, at: datetime, seq: int, **changes
) -> DataFrame:
    """Log rows that move the given cases. ``changes`` are the columns set by
    the move: constants, or Columns over ``guids``."""
    unknown = set(changes) - set(CASE_LOG.fieldNames())
    if unknown:
        raise ValueError(f"not a case column: {sorted(unknown)}")
    values = {"estado": state, "ts": at, "seq": seq, **changes}
    columns = [F.col("guid")]
    for field in CASE_LOG.fields[1:]:
        value = values.get(field.name)
        column = value if isinstance(value, Column) else F.lit(value)
        columns.append(column.cast(field.dataType).alias(field.name))
    return guids.select(*columns)


def new_batch_cases(files: DataFrame, at: datetime, seq: int = 0) -> DataFrame:
    """Ingested files as first log rows."""
    return transition(
        files, INGESTED, at, seq, motor_workflow="airflow", inicio_solicitud=at,
        url_texto_original=F.col("url"), nombre_fichero=F.col("nombre_fichero"),
        especialidad=F.col("especialidad"), origen=ORIGIN_DATASET,
    )


def new_on_demand_cases(texts: DataFrame, at: datetime, seq: int = 0) -> DataFrame:
    return transition(
        texts, INGESTED, at, seq, motor_workflow="airflow", inicio_solicitud=at,
        origen=ORIGIN_ON_DEMAND,
    )


def missing_cases(guids: DataFrame, cases: DataFrame, at: datetime, seq: int = 0) -> DataFrame:
    """First log rows for ids that have no case yet; others are left alone."""
    absent = insert_if_absent(guids.select("guid").distinct(), cases, "guid")
    return transition(absent, INGESTED, at, seq, motor_workflow="api", inicio_solicitud=at)


def insert_if_absent(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return new.join(existing.select(key), key, "left_anti")


def pending(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("estado").isin(INGESTED, ERROR_ENRICHMENT))


def by_file_name(cases: DataFrame, limit: int = 0) -> DataFrame:
    """The first ``limit`` cases by name, nulls last. 0 means all: as the order
    ends with the next shuffle, nothing is sorted for them."""
    return cases.orderBy(F.asc_nulls_last("nombre_fichero"), "guid").limit(limit) if limit > 0 else cases


def move_all(
    cases: DataFrame, source: str, target: str, at: datetime, seq: int, **changes
) -> DataFrame:
    """Move every case now in ``source``. Give it the set a job has read, not a
    fresh view: cases that arrive meanwhile then stay where they are."""
    return transition(cases.where(F.col("estado") == source), target, at, seq, **changes)


def latest_rows(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Whole newest row per key, by aggregation rather than a window."""
    rest = [name for name in df.columns if name != key]
    picked = df.groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(key, "_row.*")


def merge_results(annotations: DataFrame, predictions: DataFrame) -> DataFrame:
    """Upsert as two logs: the newest annotation of a case, with the newest
    prediction kept through later annotations."""
    left = latest_rows(annotations, "guid", ["ts", "seq"]).drop("ts", "seq")
    right = latest_rows(predictions, "guid", ["ts", "seq"]).drop("ts", "seq")
    return left.join(right, "guid", "left")


def replace_children(old: DataFrame, new: DataFrame, parents: DataFrame, key: str = "guid") -> DataFrame:
    """Old children of the replaced parents go, new ones come."""
    kept = old.join(parents.select(key), key, "left_anti")
    return kept.unionByName(new)


def current_entities(entities: DataFrame, annotations: DataFrame, versions: bool = False) -> DataFrame:
    """Children written with the newest annotation of their case. A case that
    was annotated again without findings loses its old ones."""
    newest_run = annotations.groupBy("guid").agg(F.max(F.struct("ts", "seq")).alias("_run"))
    runs = newest_run.select("guid", F.col("_run.ts").alias("ts"), F.col("_run.seq").alias("seq"))
    found = entities.join(runs, ["guid", "ts", "seq"])
    return found if versions else found.drop("ts", "seq")


def orphans(children: DataFrame, cases: DataFrame, key: str = "guid") -> DataFrame:
    return children.join(cases.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, key: str = "guid") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
