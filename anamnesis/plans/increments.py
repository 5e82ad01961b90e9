"""Metrics kept up to date by what has moved since they were last looked at.

The state is a few rows by day and state, with counts and sums, the extremes, and
the cases that may belong to the last batch. An increment looks at the cases that
the batches since then touch: what they were is taken off, what they are is added.
A removed extreme cannot be taken off a minimum; the extremes are then found anew.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import metrics
from ..schemas import BATCH_WINDOW, EVALUATION
from ..session import materialize
from ..sources.artifacts import latest_artifact, latest_evaluation, publish
from ..sources.store import STATES, Store

COLUMNS = ["inicio_solicitud", "fin_solicitud", "inicio_extraccion_entidades", "fin_extraccion_entidades",
           "inicio_entrenamiento", "fin_entrenamiento"]
SUMS = ["n", "done", "whole_sum", "ext_sum", "ext_n", "train_sum", "train_n"]
LOWEST, HIGHEST = ["whole_min"], ["whole_max", "train_last"]
EXTREMES = LOWEST + HIGHEST
RECENT = ["guid", "estado", "inicio_extraccion_entidades", "fin_extraccion_entidades"]
PREFIX = "metrics_"


@dataclass(frozen=True)
class State:
    """The newest state on record: the version it was made at, and how many entries there were up to it."""

    spark: SparkSession
    folder: str
    name: str

    @property
    def version(self) -> int:
        return int(self.name.removeprefix(PREFIX).split("_")[0])

    @property
    def entries(self) -> int:
        return int(self.name.removeprefix(PREFIX).split("_")[1])

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{self.name}/{name}")


def newest_state(store: Store) -> State | None:
    folder = store.path("metricas")
    name = latest_artifact(store.spark, folder, PREFIX)
    return None if name is None else State(store.spark, folder, name)


def _day_parts(cases: DataFrame) -> DataFrame:
    return metrics.state_parts(cases, F.to_date("inicio_solicitud").alias("dia"))


def _extremes(parts: DataFrame) -> DataFrame:
    return parts.agg(*[F.min(name).alias(name) for name in LOWEST], *[F.max(name).alias(name) for name in HIGHEST])


def _recent(cases: DataFrame) -> DataFrame:
    """All that ended within the window behind the newest end."""
    ended = cases.select(*RECENT).where(F.col("fin_extraccion_entidades").isNotNull())
    newest = ended.agg(F.max("fin_extraccion_entidades")).scalar()
    return ended.where(F.col("fin_extraccion_entidades") >= newest - F.expr(BATCH_WINDOW))


def _publish(store: Store, version: int, entries: int, parts: DataFrame, extremes: DataFrame, recent: DataFrame) -> State:
    """The state enters the manifest when all of its tables are written."""
    state = State(store.spark, store.path("metricas"), f"{PREFIX}{version:012d}_{entries:012d}")
    for name, rows in (("parts", parts.coalesce(1)), ("extremes", extremes.coalesce(1)), ("recent", recent)):
        rows.write.mode("overwrite").parquet(f"{state.folder}/{state.name}/{name}")
    publish(store.spark, state.folder, state.name)
    return state


def _whole(store: Store, version: int, entries: int) -> State:
    cases = materialize(store.cases(COLUMNS, version), "cases")
    parts = materialize(_day_parts(cases), "parts")
    return _publish(store, version, entries, parts.drop(*EXTREMES), _extremes(parts), _recent(cases))


def update_metrics(store: Store) -> State:
    """Brings the state up to the store's newest version.

    The first time, and after a restore, all cases are counted. Else only the
    cases are merged that batches since the last state have touched: snapshots and
    tails are read for their ids, and no earlier log is.
    """
    entries = store.entries()
    now = store.force(entries=entries).version
    state = newest_state(store)
    known = [e for e in entries if e["version"] <= now]
    if state is None:
        return _whole(store, now, len(known))
    since = [e for e in known if e["version"] > state.version]
    if len(known) - len(since) != state.entries or any(e["action"] == "restore" for e in since):
        return _whole(store, now, len(known))
    if not since:
        return state
    batches = [e["batch"] for e in since if e["action"] not in STATES and "case_log" in e["tables"]]
    touched = materialize(store.batches("case_log", batches).select("guid").distinct(), "touched")
    was = materialize(store.cases(COLUMNS, state.version, touched), "was")
    now_is = materialize(store.cases(COLUMNS, now, touched), "now")

    old, new = materialize(_day_parts(was), "old-parts"), materialize(_day_parts(now_is), "new-parts")
    taken = old.select("dia", "estado", *[(-F.col(name)).alias(name) for name in SUMS])
    every = state.table("parts").unionByName(taken).unionByName(new.select("dia", "estado", *SUMS))
    parts = every.groupBy("dia", "estado").agg(*[F.sum(name).alias(name) for name in SUMS]).where("n > 0")
    types = dict(state.table("parts").dtypes)
    parts = parts.select("dia", "estado", *[F.col(name).cast(types[name]).alias(name) for name in SUMS])

    before, gone, come = (df.first() for df in (state.table("extremes"), _extremes(old), _extremes(new)))
    extremes = _extremes(state.table("extremes").unionByName(_extremes(new)))

    def lost(name: str) -> bool:
        """Whether an extreme has been taken off and nothing as extreme has come."""
        if gone[name] is None:
            return False
        beyond = (lambda a, b: a <= b) if name in LOWEST else (lambda a, b: a >= b)
        return beyond(gone[name], before[name]) and (come[name] is None or not beyond(come[name], gone[name]))

    if any(map(lost, EXTREMES)):
        extremes = _extremes(metrics.state_parts(store.cases(COLUMNS, now)))
    # A case that left the last batch by ending later stays in it; others only leave as the newest end moves on.
    others = state.table("recent").join(touched, "guid", "left_anti")
    newest = state.table("recent").agg(F.max("fin_extraccion_entidades")).first()[0]
    if newest is not None and was.where(F.col("fin_extraccion_entidades") == F.lit(newest)).count() and not now_is.where(
            F.col("fin_extraccion_entidades") >= F.lit(newest)).count():
        recent = _recent(store.cases(COLUMNS, now))
    else:
        recent = _recent(others.unionByName(now_is.select(*RECENT)))
    return _publish(store, now, len(known), parts, extremes, recent)


def metrics_of(store: Store, state: State | None = None) -> DataFrame:
    """The metrics document from the newest state, without a look at any case."""
    state = state or update_metrics(store)
    by_state = state.table("parts").groupBy("estado").agg(*[F.sum(name).alias(name) for name in SUMS])
    found = state.table("extremes").first()
    # Extremes are of all states together, as the document tells them.
    by_state = by_state.withColumns({name: F.lit(found[name]).cast(dict(state.table("extremes").dtypes)[name]) for name in EXTREMES})
    evaluation = latest_evaluation(store.spark, store.evaluations)
    document = metrics.document_of(by_state, state.table("recent"), evaluation)
    if evaluation is None:
        return document.withColumn("metricas_modelo", F.lit(None).cast(EVALUATION))
    return document
