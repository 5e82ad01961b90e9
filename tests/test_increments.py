"""Metrics by increments are those of a scan over all cases."""

import random
from datetime import datetime, timedelta

import pytest

from anamnesis.operators import state as st
from anamnesis.plans import increments as inc, report
from anamnesis.sources.store import Store

AT = datetime(2024, 3, 1)
STATES = ["INGESTED", "ENRICHED", "COMPLETADA", "ERROR_ENRICHMENT", None]


def moves(rng, seq, guids):
    """One batch: some cases move, with some of their times set, later or earlier than before."""
    rows = []
    for guid in guids:
        row = {"guid": guid, "estado": rng.choice(STATES), "ts": AT + timedelta(minutes=seq), "seq": seq}
        for name in inc.COLUMNS:
            if rng.random() < 0.6:
                row[name] = AT + timedelta(hours=rng.randrange(30), seconds=rng.randrange(50))
        rows.append(tuple(row.get(f.name) for f in st.CASE_LOG.fields))
    return rows


def told(document):
    return str(document.drop("metricas_modelo").first())


def test_increments_equal_the_whole(spark, tmp_path, monkeypatch):
    rng = random.Random(12)
    store = Store(spark, str(tmp_path / "t")).prepare()
    assert told(inc.metrics_of(store)) == told(report.metrics_document(store))
    names = [f"g{i}" for i in range(30)]
    versions = []
    for seq in range(1, 7):
        store.append("case_log", spark.createDataFrame(moves(rng, seq, rng.sample(names, 12)), st.CASE_LOG))
        if seq in (2, 4):
            store.compact()
        versions.append(store.force().version)
        state = inc.update_metrics(store)
        assert state.version == store.force().version and inc.update_metrics(store) == state
        assert told(inc.metrics_of(store, state)) == told(report.metrics_document(store)), seq
    store.restore(versions[2])
    assert told(inc.metrics_of(store)) == told(report.metrics_document(store))


def test_an_increment_reads_what_moved(spark, tmp_path, monkeypatch):
    rng = random.Random(13)
    store = Store(spark, str(tmp_path / "t")).prepare()
    first = {"inicio_solicitud": AT, "fin_solicitud": AT + timedelta(hours=1), "inicio_extraccion_entidades": AT, "fin_extraccion_entidades": AT + timedelta(minutes=5)}
    done = [tuple({"guid": f"d{i}", "estado": "COMPLETADA", "ts": AT, "seq": 1, **first}.get(f.name) for f in st.CASE_LOG.fields) for i in range(20)]
    store.append("case_log", spark.createDataFrame(done, st.CASE_LOG))
    store.compact()
    inc.update_metrics(store)
    asked, whole = [], Store.cases

    def cases(self, columns=None, as_of=None, only=None):
        asked.append(only)
        return whole(self, columns, as_of, only)

    new = [tuple({"guid": g, "estado": "COMPLETADA", "ts": AT, "seq": 2, **first, "fin_solicitud": AT + timedelta(hours=h)}.get(f.name) for f in st.CASE_LOG.fields)
           for g, h in (("d1", 1), ("new", 2))]
    store.append("case_log", spark.createDataFrame(new, st.CASE_LOG))
    with monkeypatch.context() as patched:
        patched.setattr(Store, "cases", cases)
        state = inc.update_metrics(store)
    assert len(asked) == 2 and all(only is not None and only.count() == 2 for only in asked)
    assert told(inc.metrics_of(store, state)) == told(report.metrics_document(store))
    row = inc.metrics_of(store, state).first()
    assert row["latencia_fase2"]["n_completadas"] == 21 and row["latencia_fase2"]["max_latencia_e2e_s"] == pytest.approx(7200)
