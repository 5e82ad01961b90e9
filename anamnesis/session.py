"""Session settings, and the one place that decides where scratch data may live."""

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type


def configure(spark: SparkSession) -> SparkSession:
    """Settings the results depend on; cluster sizing stays with the cluster.

    Times are naive UTC, and a repeated key in a reply keeps its last value.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def local_session(app: str = "anamnesis", cpus: str = "*") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    return configure(builder.getOrCreate())


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local-mode session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="anamnesis-")
        folder = _LOCAL_FOLDERS[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as one partition, without a Python worker: one made from a list takes one for each core."""
    fields = spark.createDataFrame([], schema).schema
    columns = {field.name: pa.array([row[i] for row in rows], to_arrow_type(field.dataType)) for i, field in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), fields).coalesce(1)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Used after costly or non-repeatable steps: a lost executor then re-reads
    files instead of running the step again with another outcome.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
