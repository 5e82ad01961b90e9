"""Text files in, transcript table out."""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import (
    demo_label, object_key, specialty_at_ingest, specialty_in_job, strip, unix_newlines,
)

# Byte order marks that announce UTF-16.
UTF16_MARKS = ["FFFE", "FEFF"]
GLOB_SIGNS = r"([\[\]{}*?\\])"
_ESCAPED = r"\\\1"
ON_DEMAND_FOLDER = "fase2"
# The folder of texts whose name has no letters, hence no specialty.
NO_SPECIALTY_FOLDER = "sin_especialidad"
TRANSCRIPTS = "especialidad string, nombre_fichero string, guid string, texto string"


def file_name(path: Column) -> Column:
    return F.url_decode(F.element_at(F.split(path, "/"), -1))


def scan_corpus(
    spark: SparkSession, folder: str, pattern: str = "*.txt", recursive: bool = False,
    modified_after: str | None = None,
) -> DataFrame:
    """Name and bytes of every matching file; an empty folder is an error.
    ``modified_after`` (YYYY-MM-DDTHH:mm:ss) drops older files while listing."""
    reader = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
    )
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    files = reader.load(folder)
    corpus = files.select(file_name(F.col("path")).alias("nombre_fichero"), "path", "content")
    if corpus.select("nombre_fichero").isEmpty():
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return corpus


def list_objects(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """Paths below a folder whose relative name starts with the prefix. Only
    what the prefix leads to is listed, and no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.load(f"{folder.rstrip('/')}/{re.sub(GLOB_SIGNS, _ESCAPED, prefix)}*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string")
    tail = F.substring_index("path", folder.rstrip("/") + "/", -1)
    return files.select(F.url_decode(tail).alias("name")).where(F.col("name").startswith(prefix))


def decode(content: Column) -> Column:
    """UTF-8, else UTF-16 when it says so, else Latin-1, which never fails.

    UTF-16 without a mark cannot be told from Latin-1, so it is not guessed.
    """
    head = F.hex(F.substring(content, 1, 2))
    as_text = content.cast("string")
    marked = head.isin(UTF16_MARKS) & (F.length(content) % 2 == 0)
    return (
        F.when(F.is_valid_utf8(as_text), as_text)
        .when(marked, F.decode(content, "UTF-16"))
        .otherwise(F.decode(content, "ISO-8859-1"))
    )


def decode_lossy(content: Column) -> Column:
    """UTF-8 with a replacement character for each bad sequence."""
    return F.make_valid_utf8(content.cast("string"))


def read_transcripts(corpus: DataFrame) -> DataFrame:
    """Decoded texts with the specialty taken from the file name."""
    return corpus.select(
        specialty_at_ingest(F.col("nombre_fichero")).alias("especialidad"),
        "nombre_fichero",
        unix_newlines(decode(F.col("content"))).alias("texto"),
    )


def text_folder(specialty: Column) -> Column:
    """Where texts of a specialty are stored; an empty one has a folder too."""
    return F.when(specialty == "", NO_SPECIALTY_FOLDER).otherwise(specialty)


def write_transcripts(transcripts: DataFrame, path: str) -> None:
    """Append, one folder per specialty, so a keyed read prunes folders."""
    transcripts.select(
        text_folder(F.col("especialidad")).alias("especialidad"), "nombre_fichero", "guid", "texto",
    ).write.partitionBy("especialidad").mode("append").parquet(path)


def stored_transcripts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRANSCRIPTS).parquet(path)


def archive_on_demand(texts: DataFrame) -> DataFrame:
    """On-demand texts as transcript rows in their own folder."""
    return texts.select(
        F.lit(ON_DEMAND_FOLDER).alias("especialidad"),
        F.concat("guid", F.lit(".txt")).alias("nombre_fichero"),
        "guid", "texto",
    )


def texts_of(cases: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Texts of cases by (specialty, file name), one row per case. A case without
    a name is left out; one whose text is missing keeps a null text, to be
    reported."""
    named = cases.where(F.col("nombre_fichero").isNotNull()).select("guid", "especialidad", "nombre_fichero")
    stored = transcripts.select(
        text_folder(F.col("especialidad")).alias("_folder"), "nombre_fichero", "texto")
    found = named.withColumn("_folder", text_folder(F.col("especialidad"))).join(
        stored, ["_folder", "nombre_fichero"], "left").drop("_folder")
    return found.dropDuplicates(["guid"])


def requested_texts(requests: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Scoring requests (filename, especialidad, texto) with their text: from
    the store when a file is named, else as given."""
    keyed = requests.withColumn("filename", strip(F.col("filename"))).withColumn(
        "_folder", F.when(F.length("filename") > 0, text_folder(specialty_in_job(F.col("especialidad"), F.col("filename"))))
    )
    stored = transcripts.select(
        text_folder(F.col("especialidad")).alias("_folder"), F.col("nombre_fichero").alias("filename"),
        F.col("texto").alias("_stored"),
    )
    chosen = F.when(F.length("filename") > 0, F.col("_stored")).otherwise(F.col("texto"))
    return keyed.join(stored, ["_folder", "filename"], "left").withColumns({
        "objeto": object_key(F.col("_folder"), F.col("filename")), "texto": chosen,
    }).drop("_folder", "_stored")


def with_stored_texts(requests: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Requests (filename, contenido, texto, maybe especialidad) that name a file
    and bring no bytes get the stored text of that file; ``almacenado`` marks
    them. A name that is not stored leaves no text."""
    if "especialidad" not in requests.columns:
        requests = requests.withColumn("especialidad", F.lit(None).cast("string"))
    asked = F.coalesce(F.col("contenido").isNull() & (F.length(strip(F.col("filename"))) > 0), F.lit(False))
    looked_up = requested_texts(
        requests.withColumn("almacenado", asked).withColumn("_name", F.col("filename"))
        .withColumn("filename", F.when(asked, F.col("filename"))), transcripts)
    return looked_up.withColumn("filename", F.coalesce("filename", "_name")).drop("_name", "objeto", "especialidad")


def on_demand_input(requests: DataFrame) -> DataFrame:
    """Requests hold file bytes or a text. Adds the text, the file name and
    ``entrada_error`` (null when usable). The file wins over the text."""
    from_file = F.col("contenido").isNotNull()
    named = from_file | F.col("almacenado") if "almacenado" in requests.columns else from_file
    text = F.when(from_file, decode_lossy(F.col("contenido"))).when(F.length("texto") > 0, F.col("texto"))
    return (
        requests.withColumn("_text", text)
        .withColumn("filename", F.when(named, F.coalesce("filename", F.lit(""))).otherwise(""))
        .withColumn("entrada_error", F.when(F.col("_text").isNull(), "missing")
                    .when(F.length(strip(F.col("_text"))) == 0, "blank"))
        .withColumn("texto", F.col("_text")).drop("_text", "contenido", "almacenado")
    )


def demo_cases(corpus: DataFrame) -> DataFrame:
    return corpus.select(
        demo_label(F.col("nombre_fichero")).alias("etiqueta"),
        decode(F.col("content")).alias("texto"),
    ).orderBy("etiqueta")
