"""Replies of an annotator, kept by the hash of what was asked."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.replies import parse_replies
from ..operators.annotate import Client, Pace, annotate, request_text
from ..session import materialize

REPLIES = "request string, raw string"
#: Requests that are called and stored together: what a crash costs at most.
SAVE_EVERY = 10_000


@dataclass(frozen=True)
class ReplyTable:
    """An append-only table of (request, raw): ``request`` is the SHA-256 of the whole request."""

    spark: SparkSession
    path: str

    def prepare(self) -> "ReplyTable":
        self.spark.createDataFrame([], REPLIES).write.mode("append").parquet(self.path)
        return self

    def read(self) -> DataFrame:
        """One reply per request; should two jobs have asked the same at once, the least."""
        rows = self.spark.read.schema(REPLIES).parquet(self.path)
        return rows.groupBy("request").agg(F.min("raw").alias("raw"))

    def annotate(
        self, df: DataFrame, text: str, connect: Callable[[], Client], partitions: int | None = None,
        pace: Pace = Pace(), save_every: int = SAVE_EVERY, **request,
    ) -> DataFrame:
        """(guid, raw, annotate_error) like ``annotate``, but every request is paid once.

        Equal requests are one call. Those with a stored reply are not called; the
        others go in parts of about ``save_every``, and each part's replies are stored
        before the next part is called. So a run after a crash calls only what is
        missing. Errors are not kept, nor replies that are no valid findings: the next
        run asks again.
        """
        asked = df.select("guid", request_text(F.col(text), **request).alias("asked"))
        asked = asked.withColumn("request", F.sha2("asked", 256))
        # Written before the first call, so that what is missing is decided once.
        missing = materialize(
            asked.dropDuplicates(["request"]).join(self.read(), "request", "left_anti").select(F.col("request").alias("guid"), "asked"), "missing")
        count = missing.count()
        parts = -(-count // save_every)
        failed = None
        for number in range(parts):
            part = missing.where(F.pmod(F.xxhash64("guid"), F.lit(parts)) == number)
            called = materialize(annotate(part, "asked", connect, partitions, pace=pace), "called")
            judged = materialize(called.join(parse_replies(called).select("guid", "reply_error"), "guid"), "judged")
            judged = judged.withColumnRenamed("guid", "request")
            good = F.col("raw").isNotNull() & F.col("reply_error").isNull()
            judged.where(good).select("request", "raw").write.mode("append").parquet(self.path)
            bad = judged.where(~good).select("request", F.col("raw").alias("bad_raw"), "annotate_error")
            failed = bad if failed is None else failed.unionByName(bad)
        found = asked.select("guid", "request").join(self.read(), "request", "left")
        if failed is None:
            return found.select("guid", "raw", F.lit(None).cast("string").alias("annotate_error"))
        return found.join(failed, "request", "left").select("guid", F.coalesce("raw", "bad_raw").alias("raw"), "annotate_error")
