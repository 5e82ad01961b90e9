"""The earliest arrival of each file name, told when no earlier one can come."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "nombre_fichero string, at bigint, arrival bigint"
STATE = "at bigint, arrival bigint, told boolean"


class FirstArrival(StatefulProcessor):
    """Per name the earliest (time, arrival) so far, whether it has been told, and a timer.

    The timer stands at the earliest time: when the watermark has passed it, what
    could come before is too late, and the arrival is told. From then on the
    name is known: its small state row stays, on the state store's disk.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = min((row["at"], row["arrival"]) for row in rows)
        known = self.first.get()
        if known is not None:
            at, arrival, told = known
            if told or (at, arrival) <= best:
                return iter(())
            self.handle.deleteTimer(at // 1000)
        self.first.update((*best, False))
        self.handle.registerTimer(best[0] // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, arrival, told = self.first.get()
        if told:
            return iter(())
        self.first.update((at, arrival, True))
        return iter((Row(nombre_fichero=key[0], at=at, arrival=arrival),))

    def close(self) -> None:
        pass


def first_arrivals(files: DataFrame, late: str = "1 day") -> DataFrame:
    """(nombre_fichero, ts, arrival): the earliest row of each name, by time and then by arrival.

    ``files`` has nombre_fichero, ts and arrival (a number that tells equal times apart).
    Whatever the order and the micro-batches rows come in, the same one is told, if
    none is later than ``late``; later ones are dropped by the watermark. A name that
    fills the stream costs its task one pass over its rows of a micro-batch, which
    the source bounds, and one state row; names without a name are one name.

    Timers need the state store that ``append_to(..., rocksdb=True)`` sets.
    """
    rows = files.select("nombre_fichero", "ts", F.unix_micros("ts").alias("at"), F.col("arrival").cast("long").alias("arrival"))
    told = rows.withWatermark("ts", late).groupBy("nombre_fichero").transformWithState(
        FirstArrival(), OUTPUT, outputMode="Append", timeMode="EventTime")
    return told.select("nombre_fichero", F.timestamp_micros("at").alias("ts"), "arrival")
