from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from anamnesis.operators import metrics as mt, state as st

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def cases(spark, rows):
    schema = ("guid string, nombre_fichero string, estado string, " + ", ".join(
        f"{edge}_{phase} timestamp" for phase in ("solicitud", "extraccion_entidades", "preprocesamiento",
                                                  "normalizacion", "entrenamiento") for edge in ("inicio", "fin")))
    return spark.createDataFrame([(*row, *[None] * (13 - len(row))) for row in rows], schema)


def after(seconds):
    return T0 + timedelta(seconds=seconds)


def test_newest_value_per_column(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "guid string")
    log = st.transition(ids, "INGESTED", T0, 0, inicio_solicitud=T0, nombre_fichero="n")
    log = log.unionByName(st.transition(ids.where("guid = 'a'"), "ENRICHED", T0, 1, fin_solicitud=after(5)))
    log = log.unionByName(st.transition(ids.where("guid = 'a'"), None, after(9), 0, url_texto_original="u"))
    got = {r["guid"]: r for r in st.current_cases(log).collect()}
    assert got["a"]["estado"] == "ENRICHED" and got["b"]["estado"] == "INGESTED"
    assert got["a"]["nombre_fichero"] == "n" and got["a"]["url_texto_original"] == "u"
    assert got["b"]["fin_solicitud"] is None
    twice = st.current_cases(log.unionByName(log))
    assert twice.exceptAll(st.current_cases(log)).count() == 0


def test_unknown_column_is_refused(spark):
    with pytest.raises(ValueError):
        st.transition(spark.createDataFrame([("a",)], "guid string"), "X", T0, 0, inicio_siesta=T0)


def test_pending_sorts_missing_names_last(spark):
    df = spark.createDataFrame([("1", None, "INGESTED"), ("2", "b", "ERROR_ENRICHMENT"), ("3", "a", "INGESTED"),
                                ("4", "a", "ENRICHED")], "guid string, nombre_fichero string, estado string")
    assert sorted(r["guid"] for r in st.by_file_name(st.pending(df)).collect()) == ["1", "2", "3"]
    assert [r["guid"] for r in st.by_file_name(st.pending(df), 1).collect()] == ["3"]


def test_late_arrivals_do_not_move(spark):
    seen = spark.createDataFrame([("a", "ENRICHED")], "guid string, estado string")
    moved = st.move_all(seen, "ENRICHED", "DATASET_READY", T0, 5)
    assert [r["guid"] for r in moved.collect()] == ["a"]


def test_zero_span_gives_no_throughput(spark):
    df = cases(spark, [("a", None, "X", None, None, T0, T0)])
    row = mt.batch_throughput(df).first()
    assert (row["textos_ultimo_batch"], row["duracion_s"], row["throughput_por_minuto"]) == (None, None, None)


def test_last_batch_needs_a_start_but_any_end_sets_the_window(spark):
    df = cases(spark, [
        ("a", None, "X", None, None, T0, after(60)),
        ("b", None, "X", None, None, None, after(3600 * 3 + 30)),
        ("c", None, "X", None, None, T0, after(20)),
    ])
    assert [r["guid"] for r in mt.last_batch(df).collect()] == ["a"]
    row = mt.batch_throughput(df).first()
    assert (row["textos_ultimo_batch"], row["duracion_s"], row["throughput_por_minuto"]) == (1, 60.0, 1.0)


def test_latency_rounding_is_half_away(spark):
    df = cases(spark, [("a", "n", "COMPLETADA", T0, after(0.25), T0, after(0.05))])
    row = mt.latest_latencies(df).first()
    assert (row["e2e_s"], row["llm_s"]) == (0.3, 0.1)
    assert mt.latency_table(mt.latest_latencies(df)).columns == ["guid", "E2E (s)", "LLM (s)", "Prep. (s)", "Inicio"]


def test_cutoff_and_order(spark):
    df = cases(spark, [("a", "n", "X", T0, after(119)), ("b", "n", "X", after(1), after(121)), ("c", "n", "X", after(2), after(5)),
                       ("d", "n", "X", T0, None)])
    assert [r["guid"] for r in mt.latest_latencies(df).collect()] == ["c", "a"]


def test_errors_skip_null_states(spark):
    df = cases(spark, [("a", None, None), ("b", None, "ERROR_X"), ("c", None, "OK")])
    assert [(r["estado"], r["n"]) for r in mt.error_counts(df).collect()] == [("ERROR_X", 1)]
    document = mt.metrics_document(df).first()
    assert document["textos"]["total"] == 3 and document["errores"] == {"ERROR_X": 1}


def test_audit_listing(spark):
    results = spark.createDataFrame([
        ("guid-number-1", 0.7, 4, 3, "", "j"), ("guid-number-2", 0.95, 3, 2, "m", "j"), ("guid-number-3", 0.6, 5, 1, "m", "j"),
    ], "guid string, score_ansiedad double, prediccion_modelo int, nivel_triaje int, motivo_consulta string, justificacion string")
    known = spark.createDataFrame([("guid-number-1", None), ("guid-number-2", "f.txt"), ("guid-number-3", "g.txt")],
                                  "guid string, nombre_fichero string").withColumn("fin_solicitud", F.lit(T0))
    rows = [tuple(r)[:5] for r in mt.audit_listing(mt.audit_rows(known, results)).collect()]
    assert rows == [("f.txt", "m", 0.95, "C3", "C2"), ("guid-num", "—", 0.7, "C4", "C3")]


def test_dashboard_defaults(spark):
    df = cases(spark, [("a", None, "INGESTED")])
    from anamnesis.schemas import EVALUATION
    document = mt.metrics_document(df).withColumn("metricas_modelo", F.lit(None).cast(EVALUATION))
    row = mt.dashboard_figures(document).first()
    assert (row["cv_f1_macro"], row["casos_procesados"], row["modelo"], row["entrenado"]) == (0.0, 0, "—", "—")


def test_failed_batch_stops_the_job(spark):
    report = spark.createDataFrame([("error", 2)], "outcome string, n long")
    with pytest.raises(RuntimeError):
        mt.fail_on_errors(report, "texts failed")
