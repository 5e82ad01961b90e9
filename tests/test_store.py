"""The store's batches, snapshots and versions, and the stream that writes into it."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from anamnesis.operators import state as st
from anamnesis.operators.models import fit_forest, split
from anamnesis.plans import report
from anamnesis.sources.artifacts import write_model
from anamnesis.sources.store import Store
from anamnesis.streaming import inputs, sinks

AT = datetime(2024, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store")).prepare()


def log_rows(rng, n, guids=25):
    """Transitions in no order of time, with values set and left out; no two of a case at one moment."""
    out = []
    for seq, minute in enumerate(rng.sample(range(10 * n), n)):
        row = {"guid": f"g{rng.randrange(guids)}", "estado": rng.choice(["INGESTED", "ENRICHED", None]), "ts": AT + timedelta(minutes=minute), "seq": seq}
        for name in rng.sample(st.CASE_VALUES[1:], 3):
            row[name] = AT + timedelta(seconds=seq) if name in st.PHASE_TIMES else f"{name}-{seq}"
        out.append(tuple(row.get(f.name) for f in st.CASE_LOG.fields))
    return out


def shown(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_cases_before_between_and_after_compactions(spark, store):
    rng = random.Random(4)
    whole = []
    for turn in range(4):
        more = log_rows(rng, 40)
        whole += more
        store.append("case_log", spark.createDataFrame(more, st.CASE_LOG))
        want = st.current_cases(spark.createDataFrame(whole, st.CASE_LOG))
        few = ["especialidad", "fin_score"]
        for _ in range(2):
            assert shown(store.cases()) == shown(want)
            assert shown(store.cases(few)) == shown(want.select("guid", "estado", *few))
            if turn < 3:
                assert (store.compact() is None) == (_ == 1)
    assert store.read("case_log").count() == 40


def test_readers_open_the_snapshot_and_the_tail_only(spark, store):
    rng = random.Random(5)
    for _ in range(3):
        store.append("case_log", spark.createDataFrame(log_rows(rng, 30), st.CASE_LOG))
    name = store.compact()
    store.append("case_log", spark.createDataFrame(log_rows(rng, 5), st.CASE_LOG))
    (tail,) = store.force().of("case_log")
    cases = store.cases(["especialidad"])
    files = cases.inputFiles()
    assert files and all(f"case_log_snapshot/{name}/" in f or f"case_log/batch={tail}/" in f for f in files)
    cases.collect()
    plan = cases._jdf.queryExecution().executedPlan().toString()
    assert "workflow_id" not in plan and "especialidad_version" in plan
    final = plan.split("== Initial Plan ==")[0]
    still = final[final.index("BroadcastHashJoin"):].split("Union")[0]
    assert "LeftAnti" in still  # untouched cases pass beside a broadcast of the tail's ids


def test_a_crash_before_the_swap_changes_nothing(spark, store, monkeypatch):
    rng = random.Random(6)
    store.append("case_log", spark.createDataFrame(log_rows(rng, 30), st.CASE_LOG))
    before, force = shown(store.cases()), store.force()

    def down(*_):
        raise OSError("down")

    with monkeypatch.context() as patched:
        patched.setattr(Store, "_swap", down)
        with pytest.raises(OSError):
            store.compact()
    assert store.force() == force and shown(store.cases()) == before
    # A batch that arrives while a snapshot is made stays beside it.
    late, swap = log_rows(rng, 10), Store._swap

    def slow(self, *args):
        store.append("case_log", spark.createDataFrame(late, st.CASE_LOG))
        return swap(self, *args)

    with monkeypatch.context() as patched:
        patched.setattr(Store, "_swap", slow)
        assert store.compact()
    assert store.read("case_log").count() == 10
    store.compact()
    assert store.read("case_log").count() == 0 and store.cases().count() > 0


def test_a_batch_is_seen_whole_and_once(spark, store, monkeypatch):
    rng = random.Random(7)
    rows = spark.createDataFrame(log_rows(rng, 20), st.CASE_LOG)
    predictions = spark.createDataFrame([("g1", 2, 0.5, 5.0, AT, 8)], store.tail("predictions").schema)

    def down(*_, **__):
        raise OSError("down")

    with monkeypatch.context() as patched:
        patched.setattr(Store, "_record", down)
        with pytest.raises(OSError):
            store.write({"case_log": rows, "predictions": predictions}, "job-1")
    assert store.read("case_log").count() == 0 and store.read("predictions").count() == 0
    assert store.write({"case_log": rows, "predictions": predictions}, "job-1")
    assert not store.write({"case_log": rows, "predictions": predictions}, "job-1")
    assert store.read("case_log").count() == 20 and store.read("predictions").count() == 1
    store.compact()
    assert not store.write({"case_log": rows}, "job-1")
    assert store.read("case_log").count() == 0


def test_versions_that_are_not_there(store):
    with pytest.raises(ValueError):
        store.restore(7)
    assert store.compact() is None and store.cases().count() == 0
    assert store.restore(0) == 1 and store.cases([]).columns == ["guid", "estado"]


@pytest.fixture(scope="module")
def forest(spark):
    from anamnesis.schemas import FEATURES

    rng = random.Random(1)
    rows = [(f"r{i}", *[float(rng.randrange(3)) for _ in FEATURES], 1 + i % 5) for i in range(100)]
    table = spark.createDataFrame(rows, "guid string, " + ", ".join(f"{f} double" for f in FEATURES) + ", nivel_triaje int")
    return fit_forest(split(table).where("not is_test"), trees=3)


def test_a_stream_into_the_store_runs_twice(spark, store, forest, tmp_path):
    with pytest.raises(FileNotFoundError, match="MODEL_NOT_FOUND"):
        sinks.scores_to_store(spark.readStream.format("rate").load(), store, "s", str(tmp_path / "c"))
    write_model(spark, forest, store.models, AT)
    arrived = str(tmp_path / "arrived")
    texts = {f"c{i}": ["P: me ahogo", "P: I came for a form", " ", None][i % 4] for i in range(20)}
    for number in range(4):
        rows = [(g, None, t) for i, (g, t) in enumerate(texts.items()) if i % 4 == number or i % 5 == number]
        spark.createDataFrame(rows, "guid string, filename string, texto string").coalesce(1).write.mode("append").parquet(arrived)

    def run(checkpoint):
        stream = inputs.parquet_stream(spark, arrived, maxFilesPerTrigger=1)
        sinks.scores_to_store(stream, store, "desk", checkpoint).awaitTermination()

    run(str(tmp_path / "one"))
    good = {g for g, t in texts.items() if t and t.strip()}

    def look():
        cases = store.cases([]).collect()
        results = report.results(store).collect()
        assert {r["guid"] for r in cases} == good == {r["guid"] for r in results} and len(results) == len(cases) == len(good)
        assert {r["estado"] for r in cases} == {"COMPLETADA"} and all(1 <= r["prediccion_modelo"] <= 5 for r in results)
        assert sum(e["action"] == "append" for e in store.entries()) == 4
        return [store.read(n).count() for n in ("case_log", "annotations", "predictions", "entities", "transcripts")]

    once = look()
    run(str(tmp_path / "two"))  # every micro-batch again, as after a crash before the stream's own commit
    assert look() == once
    refused = spark.read.parquet(str(tmp_path / "one" / "refused"))
    assert {r["guid"]: r["entrada_error"] for r in refused.select("guid", "entrada_error").collect()} == {
        g: "missing" if t is None else "blank" for g, t in texts.items() if g not in good}
