"""Streams give what their batch forms give, also over several batches."""

import uuid

from pyspark.sql import functions as F

from anamnesis.streaming import arrivals, inputs, jobs, sinks

LOG = "guid string, estado string, ts timestamp"
ROWS = [
    ("a", "ENRICHED", "2024-01-01 00:00:00"), ("a", "COMPLETADA", "2024-01-01 01:00:00"),
    ("b", "ENRICHED", "2024-01-01 02:00:00"), ("a", "COMPLETADA", "2024-01-01 02:30:00"),
    ("b", "INGESTED", "2024-01-01 04:00:00"), ("c", "COMPLETADA", "2024-01-01 05:00:00"),
    ("b", "COMPLETADA", "2024-01-01 06:00:00"),
]


def log_files(spark, tmp_path):
    """Three files, read one per batch."""
    folder = str(tmp_path / "log")
    rows = spark.createDataFrame([(g, s, t) for g, s, t in ROWS], "guid string, estado string, t string")
    rows = rows.select("guid", "estado", F.col("t").cast("timestamp").alias("ts"))
    for start in (0, 3, 5):
        part = rows.where(F.col("ts").isin([F.lit(r[2]).cast("timestamp") for r in ROWS[start:start + (3 if start == 0 else 2)]]))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder, rows


def run(spark, tmp_path, make, keys):
    folder, rows = log_files(spark, tmp_path)
    stream = inputs.parquet_stream(spark, folder, maxFilesPerTrigger=1)
    out = str(tmp_path / uuid.uuid4().hex)
    sinks.upsert_to(make(stream), out, out + "-checkpoint").awaitTermination()
    return sinks.read_upserts(spark, out, keys), make(rows)


def same(left, right):
    right = right.select(*left.columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0 and left.count() > 0


def test_running_counts(spark, tmp_path):
    same(*run(spark, tmp_path, jobs.running_state_counts, ["estado"]))


def test_windows(spark, tmp_path):
    same(*run(spark, tmp_path, lambda df: jobs.windowed_throughput(df, late="1 day"), ["window_start"]))
    same(*run(spark, tmp_path / "s", lambda df: jobs.windowed_throughput(df, slide="1 hour", late="1 day"), ["window_start"]))


def test_pairs(spark, tmp_path):
    """Over batches and midnight; a case that is quiet for a day starts anew."""
    folder = str(tmp_path / "log")
    batches = [
        [("a", "ENRICHED", "2024-01-01 23:55:00"), ("b", "ENRICHED", "2024-01-01 02:00:00")],
        [("a", "COMPLETADA", "2024-01-02 00:05:00"), ("b", "COMPLETADA", "2024-01-01 06:00:00"), ("c", "COMPLETADA", "2024-01-02 05:00:00")],
        [("a", "COMPLETADA", "2024-01-02 00:10:00"), ("a", "ENRICHED", "2024-01-05 00:00:00"), ("a", "COMPLETADA", "2024-01-05 00:00:07")],
        [("", "ENRICHED", "2024-06-01 00:00:00")],
    ]
    for batch in batches:
        rows = spark.createDataFrame(batch, "guid string, estado string, t string")
        rows.select("guid", "estado", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(folder)
    stream = inputs.parquet_stream(spark, folder, maxFilesPerTrigger=1)
    out = str(tmp_path / "pairs")
    sinks.append_to(jobs.paired_latencies(stream, "ENRICHED", "COMPLETADA", late="2 days"), out, out + "-checkpoint").awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r["guid"], r["seconds"]) for r in got.collect()) == [("a", 7.0), ("a", 900.0), ("b", 14400.0)]
    same(got, jobs.paired_latencies(spark.read.parquet(folder), "ENRICHED", "COMPLETADA"))


def arrived(spark, folder, batches):
    for batch in batches:
        rows = spark.createDataFrame(batch, "nombre_fichero string, t string, arrival long")
        rows.select("nombre_fichero", F.col("t").cast("timestamp").alias("ts"), "arrival").coalesce(1).write.mode("append").parquet(folder)


def told(spark, tmp_path, folder, late):
    out = str(tmp_path / uuid.uuid4().hex)
    stream = inputs.parquet_stream(spark, folder, maxFilesPerTrigger=1)
    sinks.append_to(arrivals.first_arrivals(stream, late), out, out + "-checkpoint", rocksdb=True).awaitTermination()
    return sorted((r["nombre_fichero"] or "", r["arrival"]) for r in spark.read.schema("nombre_fichero string, arrival long").parquet(out).collect())


def test_first_arrivals_over_batches(spark, tmp_path):
    """The earliest survives, whatever the batch and order it came in; equal times go by arrival."""
    day = "2024-01-01 0{}:00:00".format
    batches = [
        [("a", day(5), 1), ("b", day(1), 2), (None, day(2), 3)],
        [("a", day(3), 4), ("a", day(4), 5), ("b", day(1), 1), ("c", day(6), 6), (None, day(1), 7)],
        [("a", day(3), 8), ("c", day(7), 9)] + [("hot", day(8), n) for n in range(500, 100, -1)],
        [("z", "2024-01-05 00:00:00", 10)],
        [("y", "2024-01-05 00:30:00", 15)],  # the watermark of the batch before now tells what is late
        [("a", day(0), 11), ("b", "2024-01-05 01:00:00", 12), ("late", day(0), 13)],
        [("end", "2024-02-01 00:00:00", 14)],
    ]
    folder = str(tmp_path / "files")
    arrived(spark, folder, batches)
    assert told(spark, tmp_path, folder, "1 day") == [("", 7), ("a", 4), ("b", 1), ("c", 6), ("hot", 101), ("y", 15), ("z", 10)]
    assert spark.conf.get(sinks.STATE_STORE) != sinks.ROCKSDB


def test_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "late")
    for stamp in ("2024-01-02 00:00:00", "2024-01-01 00:00:00"):
        spark.createDataFrame([(stamp,)], "t string").select(F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode(
            "append").parquet(folder)
        if stamp.startswith("2024-01-02"):
            out = str(tmp_path / "out")
        stream = inputs.parquet_stream(spark, folder, maxFilesPerTrigger=1)
        sinks.upsert_to(jobs.windowed_throughput(stream, late="1 hour"), out, out + "-checkpoint").awaitTermination()
    rows = sinks.read_upserts(spark, out, ["window_start"]).collect()
    assert [str(r["window_start"]) for r in rows] == ["2024-01-02 00:00:00"]


def test_text_files_arrive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "CAR1.txt").write_bytes("P: señal".encode("latin-1"))
    out = str(tmp_path / "texts")
    sinks.append_to(inputs.text_file_stream(spark, str(tmp_path / "in")), out, out + "-checkpoint").awaitTermination()
    row = spark.read.parquet(out).first()
    assert (row["nombre_fichero"], row["texto"]) == ("CAR1.txt", "P: señal")
