"""The jobs one after another over one store, on small files."""

import pytest
from pyspark.sql import functions as F

from anamnesis.operators.state import current_entities, duplicate_keys
from anamnesis.plans import enrich, ingest, learn, report, score
from anamnesis.schemas import FEATURES, LEVELS
from anamnesis.sources import artifacts, texts
from anamnesis.sources.store import Store

TEXTS = {
    "CAR": "D: Dígame\nP: Tengo dolor en el pecho y me cuesta respirar. Tengo {age} años.",
    "MSK": "D: Hola\nP: Me duele la rodilla, un tres. Tengo {age} años.",
    "RES": "D: Hi\nP: I have shortness of breath. I'm {age}, a man. I smoke.",
    "GEN": "D: Hi\nP: I came for a form, I'm {age}.",
}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    corpus = root / "corpus"
    corpus.mkdir()
    for code, text in TEXTS.items():
        for number in range(12):
            (corpus / f"{code}{number:04d}.txt").write_text(text.format(age=30 + number), encoding="utf-8")
    (corpus / "notes.md").write_text("not a text")
    made = Store(spark, str(root / "tables")).prepare()
    with pytest.raises(FileNotFoundError):
        score.score(made, spark.createDataFrame([("a", None, "x")], "filename string, contenido binary, texto string"))
    assert made.read("case_log").count() == 0
    first = ingest.ingest(made, str(corpus))
    assert {r["outcome"]: r["n"] for r in first.collect()} == {"ingested": 48}
    again = ingest.ingest(made, str(corpus))
    assert {r["outcome"]: r["n"] for r in again.collect()} == {"skipped": 48}
    return made


def states(store):
    return {r["estado"]: r["n"] for r in store.cases([]).groupBy("estado").agg(F.count("*").alias("n")).collect()}


def test_batch_then_on_demand(spark, store):
    assert states(store) == {"INGESTED": 48}
    assert store.read("transcripts").where("especialidad = 'CAR'").count() == 12

    def broken():
        def client(texts):
            raise OSError("down")
        return client

    failed = enrich.enrich_pending(store, broken, limit=5)
    assert {r["outcome"]: r["n"] for r in failed.collect()} == {"error": 5}
    assert states(store) == {"INGESTED": 43, "ERROR_ENRICHMENT": 5}
    done = enrich.enrich_pending(store)
    assert {r["outcome"]: r["n"] for r in done.collect()} == {"ok": 48}
    assert states(store) == {"ENRICHED": 48}
    assert enrich.enrich_pending(store).count() == 0
    levels = {r["especialidad"]: r["nivel_triaje"] for r in store.cases(["especialidad"]).join(
        report.results(store), "guid").select("especialidad", "nivel_triaje").distinct().collect()}
    assert levels == {"CAR": 2, "MSK": 4, "RES": 3, "GEN": 5}
    assert store.read("entities").where("entidad_normalizada = 'disnea'").count() == 24

    name = learn.build_dataset(store)
    assert name.startswith("dataset_entrenamiento_") and states(store) == {"DATASET_READY": 48}
    with pytest.raises(ValueError):
        learn.build_dataset(store)

    summary = learn.train(store, trees=5).first()
    assert summary["rf_accuracy"] >= 0.8 and summary["n_samples"] == 48 and summary["cv_f1_macro"] >= 0.7
    assert set(summary["class_weights"]) == {"2", "3", "4", "5"} and summary["modelo"].startswith("modelo_")
    assert states(store) == {"MODEL_TRAINED": 48}

    document, critical = learn.evaluate(store, trees=5)
    row = document.first()
    assert critical.count() == row["under_triage_count"] == 0
    assert sum(map(sum, row["confusion_matrix"])) == 48 and len(row["confusion_matrix"]) == len(LEVELS)
    assert set(row["feature_importances"]) == set(FEATURES)
    assert sum(row["feature_importances"].values()) == pytest.approx(1)
    stored = artifacts.latest_evaluation(spark, store.evaluations).first()
    assert stored["classification_report"]["C2"]["support"] == 12 and stored["modelo"] == row["modelo"]
    assert states(store) == {"EVALUATED": 48}

    asked = spark.createDataFrame([
        ("CAR1.txt", bytearray(TEXTS["CAR"].format(age=50).encode()), None),
        (None, None, "P: I came for a form, I'm 33."),
        (None, None, " \n"), (None, None, None),
    ], "filename string, contenido binary, texto string")
    responses, refused = score.score(store, asked)
    got = {r["nivel_triaje_llm"]: r for r in responses.collect()}
    assert set(got) == {2, 5} and got[2]["nivel_manchester"] == f"C{got[2]['nivel_triaje_predicho']}"
    assert 0 <= got[2]["valoracion"] <= 10 and got[2]["entidades_normalizadas"][0] == "dolor torácico"
    assert sorted(r["entrada_error"] for r in refused.collect()) == ["blank", "missing"]
    assert states(store) == {"EVALUATED": 48, "COMPLETADA": 2}
    assert duplicate_keys(report.results(store)).count() == 0
    assert report.results(store).where("prediccion_modelo IS NOT NULL").count() == 2

    metrics = report.metrics_document(store).first()
    assert metrics["textos"]["total"] == 50 and metrics["textos"]["por_estado"] == {"COMPLETADA": 2, "EVALUATED": 48}
    assert metrics["latencia_fase2"]["n_completadas"] == 2 and metrics["errores"] == {}
    assert metrics["entrenamiento"]["avg_tiempo_entrenamiento_s"] > 0
    assert metrics["metricas_modelo"]["modelo"] == row["modelo"]
    assert report.latencies(store).count() == 2
    assert report.audit(store).count() == 0

    # After a reset, or two, everything can be seen and had again as it was.
    def reports(as_of=None):
        shown = [report.metrics_document(store, as_of), report.audit(store, as_of), report.latencies(store, as_of=as_of), report.results(store, as_of),
                 store.cases(as_of=as_of), current_entities(store.read("entities", as_of), store.read("annotations", as_of))]
        return [sorted(map(str, df.collect())) for df in shown]

    was = reports()
    version = report.reset_for_enrichment(store)
    assert states(store) == {"INGESTED": 48, "COMPLETADA": 2} and reports(version) == was
    enrich.enrich_pending(store)
    store.compact()
    assert states(store) == {"ENRICHED": 48, "COMPLETADA": 2} and reports(version) == was
    store.restore(version)
    assert reports() == was and states(store) == {"EVALUATED": 48, "COMPLETADA": 2}
    store.compact()
    assert reports() == was
    report.reset_for_enrichment(store)
    assert states(store) == {"INGESTED": 48, "COMPLETADA": 2}

    # Requests that run again under their job's name add nothing.
    for _ in range(2):
        again, _ = score.score(store, asked, job="monday")
        assert again.count() == 2
    assert states(store) == {"INGESTED": 48, "COMPLETADA": 4}
    assert report.results(store).where("prediccion_modelo IS NOT NULL").count() == 4

    # A second run replaces findings and entities, and keeps predictions.
    enrich.enrich_pending(store)
    assert store.read("entities").count() > current_entities(store.read("entities"), store.read("annotations")).count()
    assert duplicate_keys(report.results(store)).count() == 0


def test_ingest_is_repeatable(spark, tmp_path, monkeypatch):
    """A run that dies between texts and cases, and a name without letters."""
    (tmp_path / "in").mkdir()
    for name in ("99.txt", "CAR1.txt"):
        (tmp_path / "in" / name).write_text("P: me ahogo")
    made = Store(spark, str(tmp_path / "t")).prepare()
    append = Store.append

    def broken(self, name, rows):
        raise OSError("down")

    monkeypatch.setattr(Store, "append", broken)
    with pytest.raises(OSError):
        ingest.ingest(made, str(tmp_path / "in"))
    monkeypatch.setattr(Store, "append", append)
    assert made.read("transcripts").count() == 2 and made.read("case_log").count() == 0
    ingest.ingest(made, str(tmp_path / "in"))
    assert made.read("transcripts").count() == 2
    done = enrich.enrich_pending(made, strict=True)
    assert {r["outcome"]: r["n"] for r in done.collect()} == {"ok": 2}
    assert current_entities(made.read("entities"), made.read("annotations")).count() == 2


def test_strict_enrichment_fails_after_storing(spark, tmp_path):
    def connect():
        def client(texts):
            raise OSError("down")
        return client

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "CAR1.txt").write_text("P: me ahogo")
    made = Store(spark, str(tmp_path / "t")).prepare()
    ingest.ingest(made, str(tmp_path / "in"))
    with pytest.raises(RuntimeError, match="1 cases could not be enriched"):
        enrich.enrich_pending(made, connect, strict=True)
    assert states(made) == {"ERROR_ENRICHMENT": 1}


def test_requests_by_stored_name(spark):
    stored = spark.createDataFrame([("CAR", "CAR1.txt", "g", "stored")], "especialidad string, nombre_fichero string, guid string, texto string")
    asked = spark.createDataFrame([
        (" CAR1.txt ", None, None, None), ("CAR1.txt", bytearray(b"bytes"), None, None), ("CAR2.txt", None, None, None),
        (" ", None, "text", None), (None, None, "text", "CAR"),
    ], "filename string, contenido binary, texto string, especialidad string")
    got = texts.on_demand_input(texts.with_stored_texts(asked, stored)).collect()
    assert sorted((r["filename"], r["texto"], r["entrada_error"]) for r in got if r["texto"]) == [
        ("", "text", None), ("", "text", None), ("CAR1.txt", "bytes", None), ("CAR1.txt", "stored", None)]
    assert [r["entrada_error"] for r in got if r["texto"] is None] == ["missing"]


def test_enriching_a_given_text_makes_a_case(spark, store):
    texts = spark.createDataFrame([("case-x", "P: me ahogo")], "guid string, texto string")
    enrich.enrich_given(store, texts)
    enrich.enrich_given(store, texts)
    case = store.cases(["motor_workflow"]).where("guid = 'case-x'").collect()
    assert [(r["estado"], r["motor_workflow"]) for r in case] == [("ENRICHED", "api")]


def test_empty_sources(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    empty = Store(spark, str(tmp_path / "t")).prepare()
    with pytest.raises((FileNotFoundError, Exception)):
        ingest.ingest(empty, str(tmp_path / "empty"))
    assert artifacts.latest_evaluation(spark, empty.evaluations) is None
    with pytest.raises(FileNotFoundError, match="MODEL_NOT_FOUND"):
        learn.require_model(empty)
    document = report.metrics_document(empty).first()
    assert document["textos"]["total"] == 0 and document["throughput_batch"]["duracion_s"] is None


def test_the_end_to_end_query_fits_what_the_jobs_fit(monkeypatch):
    """The query hands no smaller forest to the jobs than their default."""
    from types import SimpleNamespace

    from anamnesis.plans import learn as plan
    from workload import jobs

    class Ended(Exception):
        pass

    given = []

    def evaluated(*_, **settings):
        given.append(settings)
        raise Ended

    monkeypatch.setattr(jobs, "store_of", lambda t: None)
    monkeypatch.setattr(jobs.enrich, "enrich_given", lambda *_: None)
    monkeypatch.setattr(plan, "build_dataset", lambda *_: None)
    monkeypatch.setattr(plan, "train", lambda *_, **settings: given.append(settings))
    monkeypatch.setattr(plan, "evaluate", evaluated)
    with pytest.raises(Ended):
        jobs.jobs_end_to_end(SimpleNamespace(planted=SimpleNamespace(select=lambda *_: None)))
    assert given == [{}, {}]
