"""Operational metrics over the case table."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.encoding import level_label, seconds_between
from ..operators.evaluation import is_audit_case
from ..schemas import (
    AUDIT_CAUSE, AUDIT_VERDICT, BATCH_WINDOW, COMPLETED, LATENCY_CUTOFF_S, LATENCY_ROWS,
)


def phase_seconds(phase: str) -> Column:
    return seconds_between(F.col(f"inicio_{phase}"), F.col(f"fin_{phase}"))


def _number(value: Column, digits: int) -> Column:
    return F.round(value, digits).cast("double")


def state_counts(cases: DataFrame) -> DataFrame:
    return cases.groupBy("estado").agg(F.count("*").alias("n")).orderBy("estado")


def error_counts(cases: DataFrame) -> DataFrame:
    """The filter runs before the count, on the scan."""
    return state_counts(cases.where(F.col("estado").contains("ERROR")))


def state_map(counts: DataFrame) -> DataFrame:
    """One row: state -> count, and the total. States are a short fixed list."""
    entry = F.when(F.col("estado").isNotNull(), F.struct("estado", "n"))
    return counts.agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("por_estado"),
        F.sum("n").alias("total"),
    )


def completed_within(cases: DataFrame, cutoff_s: int = LATENCY_CUTOFF_S) -> DataFrame:
    """Cases with both ends whose whole time is under the cutoff."""
    return cases.where(
        F.col("fin_solicitud").isNotNull() & F.col("inicio_solicitud").isNotNull()
        & (phase_seconds("solicitud") < cutoff_s)
    )


def case_latencies(cases: DataFrame) -> DataFrame:
    return cases.select(
        "guid", "nombre_fichero", "estado",
        _number(phase_seconds("solicitud"), 1).alias("e2e_s"),
        _number(phase_seconds("extraccion_entidades"), 1).alias("llm_s"),
        _number(phase_seconds("preprocesamiento"), 2).alias("prep_s"),
        _number(phase_seconds("normalizacion"), 2).alias("norm_s"),
        "inicio_solicitud",
    )


def latest_latencies(cases: DataFrame, cutoff_s: int = LATENCY_CUTOFF_S, rows: int = LATENCY_ROWS) -> DataFrame:
    """Newest cases first; sort and limit fuse, so each task keeps ``rows`` rows."""
    return case_latencies(completed_within(cases, cutoff_s)).orderBy(
        F.desc("inicio_solicitud"), "guid"
    ).limit(rows)


def latency_table(latencies: DataFrame) -> DataFrame:
    """The table as shown: fewer columns, display names, start to the minute."""
    return latencies.drop("norm_s", "nombre_fichero", "estado").withColumn(
        "inicio_solicitud", F.date_format("inicio_solicitud", "yyyy-MM-dd HH:mm")
    ).withColumnsRenamed({
        "e2e_s": "E2E (s)", "llm_s": "LLM (s)", "prep_s": "Prep. (s)", "inicio_solicitud": "Inicio",
    })


def latency_summary(cases: DataFrame) -> DataFrame:
    whole = phase_seconds("solicitud")
    done = cases.where(
        (F.col("estado") == COMPLETED)
        & F.col("fin_solicitud").isNotNull() & F.col("inicio_solicitud").isNotNull()
    )
    return done.agg(
        _number(F.avg(whole), 2).alias("avg_latencia_e2e_s"),
        _number(F.min(whole), 2).alias("min_latencia_e2e_s"),
        _number(F.max(whole), 2).alias("max_latencia_e2e_s"),
        _number(F.avg(phase_seconds("extraccion_entidades")), 2).alias("avg_tiempo_llm_s"),
        F.count("*").alias("n_completadas"),
    )


def training_summary(cases: DataFrame) -> DataFrame:
    """Weighted by rows: each case of a run carries the run's times."""
    return cases.where(F.col("fin_entrenamiento").isNotNull()).agg(
        _number(F.avg(phase_seconds("entrenamiento")), 2).alias("avg_tiempo_entrenamiento_s"),
        F.max("fin_entrenamiento").alias("ultimo_entrenamiento"),
    )


def last_batch(cases: DataFrame) -> DataFrame:
    """Cases whose extraction ended within three hours of the latest end.

    The latest end is a scalar subquery: one row, no join.
    """
    ended = cases.where(F.col("fin_extraccion_entidades").isNotNull())
    newest_end = ended.agg(F.max("fin_extraccion_entidades")).scalar()
    return ended.where(
        F.col("inicio_extraccion_entidades").isNotNull()
        & (F.col("fin_extraccion_entidades") >= newest_end - F.expr(BATCH_WINDOW))
    )


def batch_throughput(cases: DataFrame) -> DataFrame:
    """Count, span in whole seconds and items per minute; all null when the
    span is null or zero."""
    span = F.round(seconds_between(
        F.min("inicio_extraccion_entidades"), F.max("fin_extraccion_entidades")
    ), 0)
    one = last_batch(cases).agg(F.count("*").alias("n"), span.alias("span"))
    known = F.col("span") != 0
    rate = F.col("n") * F.lit(60).cast("decimal(2,0)") / F.when(known, F.col("span"))
    return one.select(
        F.when(known, F.col("n")).alias("textos_ultimo_batch"),
        F.when(known, F.col("span")).cast("double").alias("duracion_s"),
        _number(rate, 2).alias("throughput_por_minuto"),
    )


def state_parts(cases: DataFrame, *keys: Column) -> DataFrame:
    """Counts, sums and extremes by state (and ``keys``): all that the document's totals need.

    Counts and sums of disjoint sets of cases add up; extremes merge.
    """
    whole, extraction = phase_seconds("solicitud"), phase_seconds("extraccion_entidades")
    training = phase_seconds("entrenamiento")
    done = (
        (F.col("estado") == COMPLETED)
        & F.col("fin_solicitud").isNotNull() & F.col("inicio_solicitud").isNotNull()
    )
    trained = F.col("fin_entrenamiento").isNotNull()

    def where(test, value):
        return F.when(test, value)

    return cases.groupBy(*keys, "estado").agg(
        F.count("*").alias("n"),
        F.count_if(done).alias("done"),
        F.sum(where(done, whole)).alias("whole_sum"),
        F.min(where(done, whole)).alias("whole_min"),
        F.max(where(done, whole)).alias("whole_max"),
        F.sum(where(done, extraction)).alias("ext_sum"),
        F.count(where(done, extraction)).alias("ext_n"),
        F.sum(where(trained, training)).alias("train_sum"),
        F.count(where(trained, training)).alias("train_n"),
        F.max("fin_entrenamiento").alias("train_last"),
    )


def folded_parts(by_state: DataFrame) -> DataFrame:
    """The document's totals from a few rows by state."""
    entry = F.when(F.col("estado").isNotNull(), F.struct("estado", "n"))
    failed = F.when(F.col("estado").contains("ERROR"), F.struct("estado", "n"))

    def mean(total, count):
        return _number(F.sum(total) / F.when(F.sum(count) > 0, F.sum(count)), 2)

    return by_state.agg(
        F.struct(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("por_estado"),
        ).alias("textos"),
        F.struct(
            mean("whole_sum", "done").alias("avg_latencia_e2e_s"),
            _number(F.min("whole_min"), 2).alias("min_latencia_e2e_s"),
            _number(F.max("whole_max"), 2).alias("max_latencia_e2e_s"),
            mean("ext_sum", "ext_n").alias("avg_tiempo_llm_s"),
            F.coalesce(F.sum("done"), F.lit(0)).alias("n_completadas"),
        ).alias("latencia_fase2"),
        F.struct(
            mean("train_sum", "train_n").alias("avg_tiempo_entrenamiento_s"),
            F.max("train_last").cast("string").alias("ultimo_entrenamiento"),
        ).alias("entrenamiento"),
        F.map_from_entries(F.array_sort(F.collect_list(failed))).alias("errores"),
    )


def metrics_document(cases: DataFrame, evaluation: DataFrame | None = None) -> DataFrame:
    """All metrics as one row of structs.

    Counts, latency and training times come from one pass grouped by state; the
    few state rows are then folded. Throughput needs the latest end first and
    is attached as a scalar subquery.
    """
    return document_of(state_parts(cases), cases, evaluation)


def document_of(by_state: DataFrame, ended: DataFrame, evaluation: DataFrame | None = None) -> DataFrame:
    """The document from parts by state and the cases that may be in the last batch."""
    rate = batch_throughput(ended)
    document = folded_parts(by_state).withColumn("throughput_batch", rate.select(F.struct(*rate.columns)).scalar())
    if evaluation is not None:
        document = document.withColumn(
            "metricas_modelo", evaluation.select(F.struct(*evaluation.columns)).scalar()
        )
    return document


def document_json(document: DataFrame) -> DataFrame:
    return document.select(F.to_json(F.struct(*document.columns)).alias("documento"))


def dashboard_figures(document: DataFrame) -> DataFrame:
    """Headline figures of a metrics document; a missing path counts as zero,
    a missing name as a dash."""
    model = F.col("metricas_modelo")
    report = model["classification_report"]

    def number(path):
        return F.coalesce(path.cast("double"), F.lit(0.0))

    return document.select(
        number(model["cv_f1_macro"]).alias("cv_f1_macro"),
        number(model["cv_f1_std"]).alias("cv_f1_std"),
        number(report["C2"]["recall"]).alias("recall_c2"),
        number(report["C3"]["f1-score"]).alias("f1_c3"),
        number(F.col("latencia_fase2.min_latencia_e2e_s")).alias("min_latencia_e2e_s"),
        number(F.col("latencia_fase2.avg_tiempo_llm_s")).alias("avg_tiempo_llm_s"),
        F.coalesce(F.try_element_at(F.col("textos.por_estado"), F.lit(COMPLETED)), F.lit(0))
        .alias("casos_procesados"),
        F.coalesce(model["modelo"], F.lit("—")).alias("modelo"),
        F.coalesce(F.col("entrenamiento.ultimo_entrenamiento"), F.lit("—")).alias("entrenado"),
    )


def audit_rows(cases: DataFrame, results: DataFrame) -> DataFrame:
    """Cases put at a less urgent level while the patient was anxious. The
    predicate is applied to the results before the join."""
    hits = results.where(is_audit_case(
        F.col("nivel_triaje"), F.col("prediccion_modelo"), F.col("score_ansiedad")
    )).select("guid", "score_ansiedad", "prediccion_modelo", "nivel_triaje",
              "motivo_consulta", "justificacion")
    named = cases.select("guid", "nombre_fichero", F.col("fin_solicitud").alias("timestamp_pred"))
    return named.join(hits, "guid").orderBy(F.desc("score_ansiedad"), "guid")


def audit_listing(rows: DataFrame) -> DataFrame:
    """Audit rows as shown to a reviewer."""
    def filled(name, other):
        return F.coalesce(F.nullif(F.col(name), F.lit("")), other)

    shown = F.round(F.col("score_ansiedad").cast("decimal(10,6)"), 2).cast("double")
    return rows.select(
        filled("nombre_fichero", F.substring("guid", 1, 8)).alias("ID_Caso"),
        filled("motivo_consulta", F.lit("—")).alias("Motivo"),
        F.when(F.col("score_ansiedad") != 0, shown).alias("Score Ansiedad"),
        level_label(F.col("prediccion_modelo")).alias("Pred. IA"),
        level_label(F.col("nivel_triaje")).alias("Ground Truth"),
        F.lit(AUDIT_VERDICT).alias("Validación"),
        F.lit(AUDIT_CAUSE).alias("Causa"),
    )


def batch_report(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


def fail_on_errors(report: DataFrame, what: str, outcome: str = "error") -> None:
    """Stop the job when a batch report counts failed rows."""
    failed = report.where(F.col("outcome") == outcome).first()
    if failed and failed["n"]:
        raise RuntimeError(f"{failed['n']} {what}")
