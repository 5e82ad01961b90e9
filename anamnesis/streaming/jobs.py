"""The streams themselves: plain DataFrame transformations."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.encoding import seconds_between
from ..functions.text import strip
from ..operators.annotate import rule_fields
from ..operators.models import Model
from ..plans.enrich import preprocess
from ..plans.score import response_rows, score_enriched


def text_error(text: Column) -> Column:
    """Why a text cannot be scored; null if it can."""
    return F.when(text.isNull(), "missing").when(F.length(strip(text)) == 0, "blank")


def score_stream(texts: DataFrame, model: Model) -> DataFrame:
    """Arriving (guid, filename, texto) rows to response rows; no state.

    A missing or blank text is refused: ``entrada_error`` tells which, and all
    else of its row is null. It is null for texts that were scored.
    """
    checked = texts.withColumn("entrada_error", text_error(F.col("texto")))
    prepared = preprocess(checked).select("guid", "filename", "texto_anotable", "texto_completo", "entrada_error")
    scored = score_enriched(rule_fields(prepared, "texto_anotable", "texto_completo"), model)
    rows = response_rows(scored, "entrada_error")
    return rows.select("guid", "entrada_error", *[
        F.when(F.col("entrada_error").isNull(), F.col(name)).alias(name)
        for name in rows.columns if name not in ("guid", "entrada_error")
    ])


def running_state_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("estado").agg(F.count("*").alias("n"))


def windowed_throughput(log: DataFrame, length: str = "3 hours", slide: str | None = None,
                        late: str = "1 hour") -> DataFrame:
    """Ended extractions per tumbling or sliding window; rows later than
    ``late`` behind the newest are dropped."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return (
        log.withWatermark("ts", late).groupBy(window.alias("w"))
        .agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "n", "first_ts", "last_ts")
    )


def paired_latencies(log: DataFrame, started: str, ended: str, late: str = "1 day",
                     within: str = "1 day") -> DataFrame:
    """Seconds from a case's first start to its last end, per case and session.

    A session ends when a case is quiet for ``within``; it may run over
    midnight. Start and end are paired by aggregation, not by a stream-stream
    join: a case with many starts and ends would otherwise emit every pair of
    them. Sessions are put out when the watermark has passed their end, so
    this stream appends.
    """
    is_start, is_end = F.col("estado") == started, F.col("estado") == ended
    return (
        log.where(is_start | is_end).withWatermark("ts", late)
        .groupBy("guid", F.session_window("ts", within).alias("w"))
        .agg(F.min(F.when(is_start, F.col("ts"))).alias("started_at"),
             F.max(F.when(is_end, F.col("ts"))).alias("ended_at"))
        .where(F.col("ended_at") >= F.col("started_at"))
        .select("guid", "started_at", "ended_at",
                seconds_between(F.col("started_at"), F.col("ended_at")).cast("double").alias("seconds"))
    )
