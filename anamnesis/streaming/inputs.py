"""File streams."""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import unix_newlines
from ..sources.texts import decode, file_name


BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def parquet_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream of a Parquet folder, or of one Parquet file in a folder."""
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema).options(**options)
    folder, name = path.rstrip("/").rsplit("/", 1)
    if [unquote(file.rsplit("/", 1)[-1]) for file in table.inputFiles()] != [name]:
        return reader.parquet(path)
    return reader.option("pathGlobFilter", name).parquet(folder)


def text_file_stream(spark: SparkSession, folder: str, pattern: str = "*.txt", **options) -> DataFrame:
    """Arriving text files: name, whole text and the file's time. The stream's
    checkpoint logs the files it has seen; it opens none of them again."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).options(**options)
    files = reader.option("pathGlobFilter", pattern).load(folder)
    return files.select(
        file_name(files["path"]).alias("nombre_fichero"),
        unix_newlines(decode(files["content"])).alias("texto"), files["modificationTime"].alias("ts"),
    )
