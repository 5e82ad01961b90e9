"""Paid calls: once per request, with waits and pace; and ingest by the log of files."""

import json
import time

import pytest

from anamnesis.operators import annotate as an
from anamnesis.plans import enrich, ingest
from anamnesis.sources.replies import ReplyTable
from anamnesis.sources.store import Store

REPLY = json.dumps({"nivel_triaje": 3, "score_urgencia": 50, "entidades": [], "entidades_normalizadas": []})


def counting(folder, fail=(), invalid=()):
    """A client that leaves a mark for every text it is asked, and fails on some."""
    def connect():
        import os
        import uuid

        def client(texts):
            for text in texts:
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as mark:
                    mark.write(text)
            if any(word in text for text in texts for word in fail):
                raise ValueError("refused")
            return ["no json" if any(word in text for word in invalid) else REPLY for text in texts]
        return client
    return connect


def calls(folder):
    return sorted(path.read_text() for path in folder.iterdir())


ONE = an.Pace(texts_per_call=1)


def test_replies_are_paid_once(spark, tmp_path, monkeypatch):
    table = ReplyTable(spark, str(tmp_path / "replies")).prepare()
    rows = spark.createDataFrame([(f"g{i}", f"text {i % 30}") for i in range(40)], "guid string, t string")
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    # The third part of the calls is not reached: the driver dies before it.
    done, plain = [], an.annotate

    def dying(*args, **kwargs):
        done.append(1)
        if len(done) == 3:
            raise OSError("down")
        return plain(*args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr("anamnesis.sources.replies.annotate", dying)
        with pytest.raises(OSError):
            table.annotate(rows, "t", counting(str(first)), 2, ONE, save_every=8)
    paid = calls(first)
    assert 0 < len(paid) == len(set(paid)) < 30
    got = table.annotate(rows, "t", counting(str(second)), 2, ONE, save_every=8).collect()
    assert len(got) == 40 and all(r["raw"] == REPLY and r["annotate_error"] is None for r in got)
    assert sorted(paid + calls(second)) == sorted({f"text {i}" for i in range(30)})
    again = tmp_path / "again"
    again.mkdir()
    assert table.annotate(rows, "t", counting(str(again)), 2, ONE).count() == 40 and calls(again) == []
    # Another template is another request.
    table.annotate(rows.limit(1), "t", counting(str(again)), 2, ONE, template="Read: {transcripcion}", model="m")
    assert len(calls(again)) == 1


def test_errors_and_invalid_replies_are_asked_again(spark, tmp_path):
    table = ReplyTable(spark, str(tmp_path / "replies")).prepare()
    rows = spark.createDataFrame([("a", "good"), ("b", "bad"), ("c", "odd"), ("d", None)], "guid string, t string").where("t is not null")
    for turn in ("one", "two"):
        (tmp_path / turn).mkdir()
        got = {r["guid"]: r for r in table.annotate(rows, "t", counting(str(tmp_path / turn), ["bad"], ["odd"]), 1).collect()}
        assert got["a"]["raw"] == REPLY and got["b"]["annotate_error"] == "ValueError: refused" and got["c"]["raw"] == "no json"
    assert "good" in calls(tmp_path / "one") and set(calls(tmp_path / "two")) == {"bad", "odd"}


def test_a_busy_service_is_waited_for(spark, tmp_path):
    log = str(tmp_path / "log")

    def connect():
        import time
        seen = []

        def client(texts):
            seen.append(1)
            with open(log, "a") as out:
                out.write(f"{time.monotonic()}\n")
            if len(seen) < 4:
                raise RuntimeError("Too many requests")
            return ["ok"] * len(texts)
        return client

    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "guid string, t string")
    pace = an.Pace(first_wait=0.1, longest_wait=0.3)
    assert [r["raw"] for r in an.annotate(rows, "t", connect, 1, pace=pace).collect()] == ["ok", "ok"]
    times = [float(x) for x in open(log).read().split()]
    waits = [b - a for a, b in zip(times, times[1:])]
    assert len(times) == 4 and waits[0] >= 0.1 and waits[1] >= 0.2 and waits[2] >= 0.3

    def always():
        def client(texts):
            raise RuntimeError("429")
        return client

    rows = an.annotate(rows, "t", always, 1, pace=an.Pace(attempts=2, first_wait=0.01)).collect()
    assert [r["annotate_error"] for r in rows] == ["RuntimeError: 429"] * 2


def test_pace_is_kept_in_a_task(spark):
    def connect():
        return lambda texts: ["ok"] * len(texts)

    rows = spark.createDataFrame([(f"g{i}", "x") for i in range(12)], "guid string, t string")
    began = time.monotonic()
    an.annotate(rows, "t", connect, 1, pace=an.Pace(texts_per_call=2, per_second=10)).collect()
    assert time.monotonic() - began >= 1.0


def test_a_job_asks_for_what_is_missing_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t")).prepare()
    texts = spark.createDataFrame([("c1", "P: bad one"), ("c2", "P: good"), ("c3", "P: good")], "guid string, texto string")
    for turn, fail in (("one", ["bad"]), ("two", [])):
        (tmp_path / turn).mkdir()
        enrich.enrich_given(store, texts, counting(str(tmp_path / turn), fail), 1, pace=ONE)
    assert calls(tmp_path / "one") == ["bad one", "good"] and calls(tmp_path / "two") == ["bad one"]
    assert {r["estado"] for r in store.cases([]).collect()} == {"ENRICHED"}


def test_known_files_stay_closed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("CAR1.txt", "MSK2.txt", "RES3.txt"):
        (folder / name).write_bytes(b"P: me ahogo\r\n")
    store = Store(spark, str(tmp_path / "t")).prepare()
    look = lambda report: {r["outcome"]: r["n"] for r in report.collect()}
    assert look(ingest.ingest_new(store, str(folder), max_files=2)) == {"ingested": 3}
    assert sum(e["action"] == "append" for e in store.entries()) == 2
    texts = lambda: {r["nombre_fichero"]: r["texto"] for r in store.read("transcripts").collect()}
    assert texts() == {name: "P: me ahogo\n" for name in ("CAR1.txt", "MSK2.txt", "RES3.txt")}
    # A changed file under a known name is not opened; a new one is all that is read.
    (folder / "CAR1.txt").write_text("P: something else entirely")
    (folder / "GEN4.txt").write_text("P: hola")
    assert look(ingest.ingest_new(store, str(folder))) == {"ingested": 1}
    assert look(ingest.ingest_new(store, str(folder))) == {}
    assert len(texts()) == 4 and texts()["CAR1.txt"] == "P: me ahogo\n"
    # From another folder, a name that is a case already is skipped.
    other = tmp_path / "other"
    other.mkdir()
    (other / "CAR1.txt").write_text("P: other text")
    (other / "DER5.txt").write_text("P: new")
    assert look(ingest.ingest_new(store, str(other), name="other")) == {"ingested": 1, "skipped": 1}
    assert store.cases([]).count() == 5
    one, two = ingest.ingest(Store(spark, str(tmp_path / "u")).prepare(), str(folder)), store.cases(["especialidad"])
    assert look(one) == {"ingested": 4} and {r["especialidad"] for r in two.collect()} == {"CAR", "MSK", "RES", "GEN", "DER"}
