import pytest
from pyspark.sql import functions as F

from anamnesis.sources import artifacts, texts as tx
from anamnesis.sources.store import read_table


def test_decoding_order(spark, tmp_path):
    files = {"a.txt": "P: niño".encode(), "b.txt": "P: niño".encode("utf-16"), "c.txt": "P: niño".encode("latin-1"),
             "d.txt": b"ab\xe9!", "e b.txt": "x\r\ny\rz".encode()}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    corpus = tx.scan_corpus(spark, str(tmp_path))
    got = {r["nombre_fichero"]: r["texto"] for r in tx.read_transcripts(corpus).collect()}
    assert got == {"a.txt": "P: niño", "b.txt": "P: niño", "c.txt": "P: niño", "d.txt": "abé!", "e b.txt": "x\ny\nz"}


def test_lossy(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),)], "c binary")
    assert df.select(tx.decode_lossy(F.col("c"))).first()[0] == "a�b"


def test_no_files(spark, tmp_path):
    (tmp_path / "x.md").write_text("x")
    with pytest.raises(FileNotFoundError):
        tx.scan_corpus(spark, str(tmp_path))


def test_latest_is_the_last_published_name(spark, tmp_path):
    folder = str(tmp_path)
    assert artifacts.latest_artifact(spark, folder, "modelo_") is None
    for name in ("modelo_20240102_000000", "modelo_20240101_000000", "dataset_20990101_000000"):
        artifacts.publish(spark, folder, name)
    assert artifacts.latest_artifact(spark, folder, "modelo_") == "modelo_20240102_000000"
    with pytest.raises(FileNotFoundError):
        artifacts.require_artifact(spark, folder, "evaluacion_", "none")


def test_listing_by_prefix(spark, tmp_path):
    for name in ("RES/a.txt", "RES/b c.txt", "CAR/a.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x")
    names = sorted(r["name"] for r in tx.list_objects(spark, str(tmp_path), "RES/").collect())
    assert names == ["RES/a.txt", "RES/b c.txt"]


def test_table_with_parameters(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    got = read_table(spark, str(tmp_path / "t"), "SELECT id FROM {source} WHERE id > :low", low=7)
    assert sorted(r["id"] for r in got.collect()) == [8, 9]
