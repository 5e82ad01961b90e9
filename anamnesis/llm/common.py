"""Helpers that several operators of this subpackage share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anamnesis.session import materialize, scratch_path, shared_folder

__all__ = ["materialize", "scratch_path", "shared_folder"]

BLANKS = " \t\n\x0b\f\r"
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row.

    A one-row generator holds them, into which the optimizer does not inline
    what lambdas above refer to again and again.
    """
    fields = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select("*", F.inline(F.array(fields)))


def unreserved(docs: DataFrame) -> DataFrame:
    """``docs``, unless one of its columns bears a name that helpers here need beside the caller's columns."""
    taken = [name for name in docs.columns if name.lower().startswith("_llm_")]
    if taken:
        raise ValueError(f"column names that begin with _llm_ are reserved: {taken}")
    return docs


def word_count(text: Column) -> Column:
    """The number of words, counted without an array of them; null has none."""
    marked = F.regexp_replace(F.ltrim(text, F.lit(BLANKS)), f"{NOT_BLANK}++{BLANK}*+", "x")
    return F.coalesce(F.length(marked), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text that is not null, as an array."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"{BLANK}+"))


def in_order(df: DataFrame, *keys: Column, block: str = "block") -> DataFrame:
    """Rows dealt into blocks of consecutive keys, written once, with the block's number.

    Equal keys share a block, so give a last key that tells repeated rows apart
    where they may be many. What follows ranks or sums within blocks, and adds
    the totals of the blocks before: no task ever sorts a whole group.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions(spark), *keys).withColumn(block, F.spark_partition_id())
    return materialize(dealt, "in-order")


def before(totals: DataFrame, group: list[str], block: str, column: str, name: str) -> DataFrame:
    """Adds to block totals the sum over the earlier blocks of the group: at most a row a block."""
    window = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum(column).over(window), F.lit(0)))
