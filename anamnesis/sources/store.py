"""The tables of one installation, as folders below one root, and the record of what is in force.

Rows are added in batches. A batch writes a folder in each table it adds to and
then puts one entry in the manifest: readers see all of it from that moment, and
nothing of it before. A batch has a name; one that is on record already is not
written again, so a job or a micro-batch that is run twice adds its rows once.

From time to time ``compact`` writes a snapshot: one row per case, and per case the
newest findings, prediction and entities. An entry that names the snapshot and
the batches it holds puts it in force. Readers then open the snapshot and the
batches since, and no other folder. ``restore`` puts an earlier version in force
in the same way. Folders are never changed; let them expire as far back as
``restore`` and ``as_of`` are to reach.
"""

from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators.state import (
    CASE_LOG, CASE_SNAPSHOT, compacted_cases, current_entities, latest_rows, merged_cases,
)
from ..schemas import REPLY
from . import texts
from .replies import ReplyTable

ENTITIES = "guid string, pos int, entidad_raw string, entidad_normalizada string, tipo string, ts timestamp, seq bigint"
ANNOTATIONS = T.StructType([
    T.StructField("guid", T.StringType()),
    *[field for field in REPLY.fields if not field.name.startswith("entidades")],
    T.StructField("timestamp_pred", T.TimestampType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])
PREDICTIONS = (
    "guid string, prediccion_modelo int, confianza double, valoracion double, ts timestamp, seq bigint"
)
#: A row per entry. ``append`` adds a batch to ``tables``; ``snapshot`` and ``restore`` say what is in
#: force from then on: a snapshot, and which batches on record are in it or no longer in force.
MANIFEST = "version bigint, at timestamp, action string, batch string, tables array<string>, snapshot string, gone array<string>"
STATES = ("snapshot", "restore")


@dataclass(frozen=True)
class Force:
    """What is in force: a snapshot, if there is one, and for each batch since then its tables."""

    version: int = 0
    snapshot: str | None = None
    batches: dict[str, frozenset[str]] = field(default_factory=dict)

    def of(self, table: str) -> list[str]:
        return sorted(batch for batch, tables in self.batches.items() if table in tables)


@dataclass(frozen=True)
class Store:
    """Paths, readers and appenders. Every table is append-only."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def datasets(self) -> str:
        return self.path("datasets")

    @property
    def models(self) -> str:
        return self.path("modelos")

    @property
    def evaluations(self) -> str:
        return self.path("evaluacion")

    @property
    def replies(self) -> ReplyTable:
        """What annotators have been paid for."""
        return ReplyTable(self.spark, self.path("replies"))

    def prepare(self) -> "Store":
        """An empty manifest and no transcripts, so that first readers find a schema and no rows."""
        for name, schema in (("manifest", MANIFEST), ("transcripts", texts.TRANSCRIPTS)):
            self.spark.createDataFrame([], schema).write.mode("append").parquet(self.path(name))
        self.replies.prepare()
        return self

    @staticmethod
    def _schemas() -> dict:
        return {"case_log": CASE_LOG, "annotations": ANNOTATIONS, "predictions": PREDICTIONS, "entities": ENTITIES}

    # -- the manifest ----------------------------------------------------------

    def entries(self) -> list:
        """All entries, oldest first: one for each batch, snapshot and restore; none for rows."""
        rows = self.spark.read.schema(MANIFEST).parquet(self.path("manifest")).collect()
        return sorted(rows, key=lambda row: (row["version"], row["batch"]))

    def force(self, as_of: int | None = None, entries: list | None = None) -> Force:
        """What is in force, now or right after version ``as_of``.

        A batch that is put on record while a snapshot is made counts from then
        on, whatever its version: only batches the entry knew can be gone.
        """
        known = [e for e in (self.entries() if entries is None else entries) if as_of is None or e["version"] <= as_of]
        states = [e for e in known if e["action"] in STATES]
        last = states[-1] if states else None
        appended = {e["batch"]: frozenset(e["tables"]) for e in known if e["action"] == "append"}
        gone = set(last["gone"]) if last else set()
        live = {batch: tables for batch, tables in appended.items() if batch not in gone}
        return Force(max((e["version"] for e in known), default=0), last["snapshot"] if last else None, live)

    def _record(self, entries: list, action: str, batch: str, tables=(), snapshot=None, gone=()) -> int:
        """One row in one file: it is there as a whole or not at all."""
        version = max((e["version"] for e in entries), default=0) + 1
        row = (version, datetime.now(timezone.utc), action, batch, list(tables), snapshot, list(gone))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(self.path("manifest"))
        return version

    # -- adding ----------------------------------------------------------------

    def has(self, batch: str) -> bool:
        return any(e["batch"] == batch for e in self.entries())

    def write(self, tables: dict[str, DataFrame], batch: str | None = None) -> bool:
        """Adds rows to several tables as one batch; False if the batch is on record already.

        What an earlier attempt left in the batch's folders is replaced.
        """
        batch = batch or f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid4().hex}"
        if self.has(batch):
            return False
        for name, rows in tables.items():
            rows.select(*self.tail(name, Force()).columns).write.mode("overwrite").parquet(self._batch(name, batch))
        self._record(self.entries(), "append", batch, sorted(tables))
        return True

    def append(self, name: str, rows: DataFrame) -> None:
        self.write({name: rows})

    def _batch(self, name: str, batch: str) -> str:
        return self.path(f"{name}/batch={batch}")

    def _snapshot(self, name: str, snapshot: str) -> str:
        return self.path(f"{name}_snapshot/{snapshot}")

    # -- reading ---------------------------------------------------------------

    def _rows(self, paths: list[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def tail(self, name: str, force: Force | None = None) -> DataFrame:
        """Rows of the batches in force that no snapshot holds."""
        force = force or self.force()
        return self._rows([self._batch(name, batch) for batch in force.of(name)], self._schemas()[name])

    def batches(self, name: str, batches: list[str]) -> DataFrame:
        """Rows of given batches, in force or not."""
        return self._rows([self._batch(name, batch) for batch in batches], self._schemas()[name])

    def snapshot(self, name: str, force: Force | None = None) -> DataFrame:
        """Rows of the snapshot in force; cases carry the version of each value."""
        force = force or self.force()
        schema = CASE_SNAPSHOT if name == "case_log" else self._schemas()[name]
        return self._rows([self._snapshot(name, force.snapshot)] if force.snapshot else [], schema)

    def read(self, name: str, as_of: int | None = None) -> DataFrame:
        """A table as it is in force, or was after version ``as_of``. Of ``case_log`` the rows since the
        last snapshot: see ``cases`` for what the cases are now."""
        if name == "transcripts":
            return texts.stored_transcripts(self.spark, self.path(name))
        force = self.force(as_of)
        if name == "case_log" or not force.snapshot:
            return self.tail(name, force)
        return self.snapshot(name, force).unionByName(self.tail(name, force))

    def cases(self, columns: list[str] | None = None, as_of: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """One row per case: those of the snapshot, moved on by the log since; ``only``
        the ones whose guid is in a table of ids, of which no other row is merged."""
        force = self.force(as_of)
        before = self.snapshot("case_log", force) if force.snapshot else None
        tail = self.tail("case_log", force)
        if only is not None:
            before = None if before is None else before.join(only, "guid", "left_semi")
            tail = tail.join(only, "guid", "left_semi")
        return merged_cases(before, tail, columns)

    # -- what is in force ------------------------------------------------------

    def compact(self) -> str | None:
        """Writes a snapshot of all tables and puts it in force; None if nothing was added since the last.

        A job that dies before the last step leaves folders that nobody reads. Batches
        that arrive meanwhile stay beside the new snapshot.
        """
        force = self.force()
        if not force.batches:
            return None
        name = f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid4().hex}"
        cases = compacted_cases(self.snapshot("case_log", force) if force.snapshot else None, self.tail("case_log", force))
        cases.write.parquet(self._snapshot("case_log", name))

        def both(table: str) -> DataFrame:
            return self.snapshot(table, force).unionByName(self.tail(table, force))

        for table in ("annotations", "predictions"):
            rows = latest_rows(both(table), "guid", ["ts", "seq"])
            rows.select(*both(table).columns).write.parquet(self._snapshot(table, name))
        entities = both("entities")
        newest = self._rows([self._snapshot("annotations", name)], ANNOTATIONS)
        current_entities(entities, newest, versions=True).select(*entities.columns).write.parquet(self._snapshot("entities", name))
        self._swap(name, force)
        return name

    def _swap(self, snapshot: str | None, held: Force, live: frozenset = frozenset(), action: str = "snapshot") -> int:
        """Puts a snapshot in force beside the batches ``live``; the others of ``held`` are gone."""
        entries = self.entries()
        earlier = [e for e in entries if e["action"] in STATES]
        gone = (set(earlier[-1]["gone"]) if earlier else set()) | set(held.batches)
        return self._record(entries, action, f"{action}_{uuid4().hex}", sorted(self._schemas()), snapshot, sorted(gone - live))

    def restore(self, version: int) -> int:
        """Puts all tables back to what they were after ``version``, by one entry; returns its version."""
        entries = self.entries()
        if version and version not in {e["version"] for e in entries}:
            raise ValueError(f"no version {version}")
        then, now = self.force(version, entries), self.force(entries=entries)
        return self._swap(then.snapshot, now, frozenset(then.batches), "restore")


def read_table(spark: SparkSession, source: str, query: str | None = None, **args) -> DataFrame:
    """A Parquet folder or a catalog table, optionally through SQL over the
    name ``source`` with named parameters."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return spark.sql(query, args=args or None, source=df) if query else df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low, high, parts: int, **options) -> DataFrame:
    """A database table, read in ranges of a numeric or time key so that no
    single task scans it whole."""
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", table)
        .option("partitionColumn", key).option("lowerBound", low).option("upperBound", high)
        .option("numPartitions", parts).options(**options).load()
    )
