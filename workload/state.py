"""Case state, joins and table changes: P6, P7, P14, P16, N*, D*, O1, O2, O5, O8, A1, A13."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from anamnesis.functions import replies as rp
from anamnesis.operators import features as ft, metrics as mt, state as st
from anamnesis.plans.enrich import enrich_texts
from anamnesis.plans.report import reset_for_enrichment
from anamnesis.schemas import FLAGS
from anamnesis.session import materialize, scratch_path
from anamnesis.sources import texts as tx
from anamnesis.sources.store import Store

from .registry import query
from .replies import reply_fields

# Fixed moment, so that a run can be compared with its check.
AT = datetime(2024, 2, 1, 12, 0, 0, tzinfo=timezone.utc)
AT_US = 1706788800000000


def case_log(t):
    """The events as log rows with phase times and attributes."""
    kind = F.col("event_type")
    blank = st.transition(t.state_log, None, AT, 0).drop("guid", "estado", "ts", "seq").columns
    source = t.state_log
    values = {
        "inicio_solicitud": F.when(kind == "signup", F.col("ts")),
        "inicio_extraccion_entidades": F.when(kind == "view", F.col("ts")),
        "fin_extraccion_entidades": F.when(kind == "click", F.col("ts")),
        "fin_solicitud": F.when(kind == "purchase", F.col("ts")),
        "workflow_id": F.when(kind != "error", F.concat(F.lit("w"), F.col("seq").cast("string"))),
    }
    moved = st.transition(source, None, AT, 0)
    types = dict(moved.dtypes)
    return source.select("guid", "estado", "ts", "seq", *[
        values.get(name, F.lit(None)).cast(types[name]).alias(name) for name in blank
    ])


def micros(name):
    return F.coalesce(F.unix_micros(name), F.lit(-1)).alias(name)


_P16 = """
SELECT guid, arg_max(estado, row(ts, seq)) AS estado,
  coalesce(epoch_us(max(ts) FILTER (WHERE event_type = 'signup')), -1) AS inicio_solicitud,
  coalesce(epoch_us(max(ts) FILTER (WHERE event_type = 'view')), -1) AS inicio_extraccion_entidades,
  coalesce(epoch_us(max(ts) FILTER (WHERE event_type = 'click')), -1) AS fin_extraccion_entidades,
  coalesce(epoch_us(max(ts) FILTER (WHERE event_type = 'purchase')), -1) AS fin_solicitud,
  coalesce(arg_max('w' || seq, row(ts, seq)) FILTER (WHERE event_type <> 'error'), '?') AS workflow_id
FROM state_log GROUP BY guid"""


@query("p16_current_cases", _P16)
def p16_current_cases(t):
    names = ["inicio_solicitud", "inicio_extraccion_entidades", "fin_extraccion_entidades", "fin_solicitud"]
    cases = st.current_cases(case_log(t), [*names, "workflow_id"])
    return cases.select("guid", "estado", *[micros(name) for name in names],
                        F.coalesce("workflow_id", F.lit("?")).alias("workflow_id"))


def compacted_store(t):
    """The log in a store: three parts, a snapshot after each of the first two, the last beside them.

    Parts are dealt by seq, so later parts hold rows older than the snapshot's.
    """
    store = Store(t.spark, scratch_path(t.spark, "store")).prepare()
    log = materialize(case_log(t), "log")
    for part in range(3):
        store.append("case_log", log.where(F.col("seq") % 3 == part))
        if part < 2:
            store.compact()
    return store


@query("p16_compacted_cases", _P16)
def p16_compacted_cases(t):
    """The current cases from the second snapshot and the log since."""
    names = ["inicio_solicitud", "inicio_extraccion_entidades", "fin_extraccion_entidades", "fin_solicitud"]
    cases = compacted_store(t).cases([*names, "workflow_id"])
    return cases.select("guid", "estado", *[micros(name) for name in names],
                        F.coalesce("workflow_id", F.lit("?")).alias("workflow_id"))


@query("p6_pending_cases", "SELECT guid, estado FROM cases WHERE estado IN ('INGESTED', 'ERROR_ENRICHMENT')")
def p6_pending_cases(t):
    return st.pending(st.current_cases(case_log(t), [])).select("guid", "estado")


@query("o1_pending_by_name", """SELECT guid, coalesce(nombre_fichero, '?') AS nombre_fichero FROM cases
  WHERE estado IN ('INGESTED', 'ERROR_ENRICHMENT') ORDER BY cases.nombre_fichero ASC NULLS LAST, guid LIMIT 100""")
def o1_pending_by_name(t):
    """One batch of 100, as the job's own batch limit sets it."""
    batch = st.by_file_name(st.pending(t.cases), 100)
    return batch.select("guid", F.coalesce("nombre_fichero", F.lit("?")).alias("nombre_fichero"))


@query("p7_dataset_projection", f"""
SELECT c.guid, coalesce(c.especialidad, '?') AS especialidad, coalesce(c.origen, '?') AS origen, coalesce(r.edad, -9) AS edad,
  coalesce(r.sexo, '?') AS sexo, coalesce(r.dolor_intensidad, -9) AS dolor_intensidad,
  {', '.join(f'coalesce(r.{n}, false) AS {n}' for n in FLAGS)}, coalesce(r.score_urgencia, -9.0) AS score_urgencia,
  coalesce(r.score_ansiedad, -9.0) AS score_ansiedad, r.nivel_triaje
FROM doc_cases c JOIN results r ON c.guid = r.guid WHERE c.estado = 'ENRICHED'""")
def p7_dataset_projection(t):
    rows = ft.dataset_rows(t.doc_cases, t.results)
    return rows.fillna("?", ["especialidad", "origen", "sexo"]).fillna(-9, ["edad", "dolor_intensidad"]).fillna(
        -9.0, ["score_urgencia", "score_ansiedad"]).fillna(False, FLAGS)


@query("n1_case_result_join", """SELECT c.guid, c.estado, r.nivel_triaje FROM doc_cases c JOIN results r ON c.guid = r.guid
  WHERE c.estado = 'ENRICHED' AND c.origen IS DISTINCT FROM 'simulacion'""")
def n1_case_result_join(t):
    """The dataset join with on-demand cases kept out of training."""
    rows = ft.dataset_rows(t.doc_cases, t.results, exclude_simulated=True)
    return rows.select("guid", F.lit("ENRICHED").alias("estado"), "nivel_triaje")


@query("n2_audit_join", """SELECT c.guid, c.nombre_fichero IS NULL AS unnamed, p.prediccion_modelo, p.nivel_triaje, p.score_ansiedad
  FROM doc_cases c JOIN predictions p ON c.guid = p.guid WHERE p.prediccion_modelo > p.nivel_triaje AND p.score_ansiedad >= 0.7""")
def n2_audit_join(t):
    cases = t.doc_cases.withColumn("fin_solicitud", F.lit(AT))
    rows = mt.audit_rows(cases, t.predictions)
    return rows.select("guid", F.col("nombre_fichero").isNull().alias("unnamed"), "prediccion_modelo", "nivel_triaje", "score_ansiedad")


@query("n3_last_batch", """WITH newest AS (SELECT max(fin_extraccion_entidades) AS fin_max FROM cases)
SELECT guid FROM cases, newest WHERE inicio_extraccion_entidades IS NOT NULL
  AND fin_extraccion_entidades >= fin_max - INTERVAL 3 HOUR""")
def n3_last_batch(t):
    return mt.last_batch(t.cases).select("guid")


def known_names(t):
    return t.doc_cases.where("estado <> 'INGESTED'").select("nombre_fichero")


_KNOWN = "SELECT nombre_fichero FROM doc_cases WHERE estado <> 'INGESTED' AND nombre_fichero IS NOT NULL"


@query("n4_new_files_only", f"SELECT doc_id, nombre_fichero FROM transcripts WHERE nombre_fichero NOT IN ({_KNOWN})")
def n4_new_files_only(t):
    files = t.transcripts.select("doc_id", "nombre_fichero")
    return st.insert_if_absent(files, known_names(t), "nombre_fichero")


@query("n5_insert_if_absent", f"""SELECT DISTINCT guid, 'INGESTED' AS estado, 'api' AS motor_workflow, {AT_US} AS inicio_solicitud FROM state_log
  WHERE guid NOT IN (SELECT guid FROM state_log WHERE event_type = 'signup')""")
def n5_insert_if_absent(t):
    known = t.state_log.where("event_type = 'signup'").select("guid")
    made = st.missing_cases(t.state_log.select("guid"), known, AT)
    return made.select("guid", "estado", "motor_workflow", F.unix_micros("inicio_solicitud").alias("inicio_solicitud"))


@query("n6_positional_pairs", """
WITH lists AS (SELECT guid, list_filter([lang, source, sexo, especialidad], lambda x: x IS NOT NULL) AS raws,
  [upper(lang), upper(source), CAST(n_chars AS VARCHAR)][1:CAST(doc_id % 3 AS INT) + 1] AS norms FROM results)
SELECT guid, CAST(least(len(raws), len(norms)) AS BIGINT) AS n_pairs, raws[1] || '=' || norms[1] AS first_pair FROM lists""")
def n6_positional_pairs(t):
    pairs = rp.entity_rows(reply_fields(t))
    return pairs.groupBy("guid").agg(
        F.count("*").alias("n_pairs"),
        F.max(F.when(F.col("pos") == 0, F.concat_ws("=", "entidad_raw", "entidad_normalizada"))).alias("first_pair"),
    )


def stored_texts(t):
    return t.transcripts.join(t.doc_cases.select("guid", "especialidad"), "guid").where("doc_id % 6 <> 0")


_LOOKUP = """SELECT c.guid, s.texto IS NULL AS missing, coalesce(length(s.texto), -1) AS n_chars
  FROM doc_cases c LEFT JOIN (SELECT t.*, d.especialidad FROM transcripts t JOIN doc_cases d USING (guid) WHERE doc_id % 6 <> 0) s
    ON c.especialidad = s.especialidad AND c.nombre_fichero = s.nombre_fichero
  WHERE c.nombre_fichero IS NOT NULL"""


@query("n7_text_of_case", f"SELECT guid, missing, CAST(n_chars AS INT) AS n_chars FROM ({_LOOKUP})")
def n7_text_of_case(t):
    """Texts by (specialty, name); cases without a stored text are kept."""
    found = tx.texts_of(t.doc_cases, stored_texts(t))
    return found.select("guid", F.col("texto").isNull().alias("missing"),
                        F.coalesce(F.length("texto"), F.lit(-1)).alias("n_chars"))


@query("n9_orphan_results", """SELECT r.guid FROM results r WHERE r.guid NOT IN (SELECT guid FROM doc_cases WHERE estado = 'ENRICHED')""")
def n9_orphan_results(t):
    return st.orphans(t.results.select("guid"), t.doc_cases.where("estado = 'ENRICHED'"))


@query("d1_insert_batch_cases", f"""SELECT guid, 'INGESTED' AS estado, 's3://b/' || nombre_fichero AS url_texto_original, nombre_fichero,
  coalesce(especialidad, '?') AS especialidad, 'dataset' AS origen, 'airflow' AS motor_workflow, {AT_US} AS inicio_solicitud
  FROM doc_cases WHERE nombre_fichero IS NOT NULL""")
def d1_insert_batch_cases(t):
    files = t.doc_cases.where("nombre_fichero IS NOT NULL").withColumn("url", F.concat(F.lit("s3://b/"), "nombre_fichero"))
    rows = st.new_batch_cases(files, AT)
    return rows.select("guid", "estado", "url_texto_original", "nombre_fichero",
                       F.coalesce("especialidad", F.lit("?")).alias("especialidad"), "origen", "motor_workflow",
                       F.unix_micros("inicio_solicitud").alias("inicio_solicitud"))


@query("d2_insert_on_demand_cases", f"""SELECT guid, 'INGESTED' AS estado, 'simulacion' AS origen, true AS unnamed, {AT_US} AS inicio_solicitud
  FROM transcripts""")
def d2_insert_on_demand_cases(t):
    rows = st.new_on_demand_cases(t.transcripts, AT)
    return rows.select("guid", "estado", "origen", F.col("nombre_fichero").isNull().alias("unnamed"),
                       F.unix_micros("inicio_solicitud").alias("inicio_solicitud"))


@query("d3_update_state", f"""
WITH latest AS (SELECT guid, arg_max(estado, row(ts, seq)) AS estado,
  max(ts) FILTER (WHERE event_type = 'click') AS fin FROM state_log GROUP BY guid)
SELECT guid, CASE WHEN estado = 'INGESTED' THEN 'ENRICHING' ELSE estado END AS estado,
  CASE WHEN estado = 'INGESTED' THEN {AT_US} ELSE coalesce(epoch_us(fin), -1) END AS fin_extraccion_entidades FROM latest""")
def d3_update_state(t):
    """A transition with a dynamic set of times, seen through the view."""
    log = case_log(t)
    before = st.current_cases(log, [])
    move = st.transition(before.where("estado = 'INGESTED'"), "ENRICHING", AT, 0, fin_extraccion_entidades=AT)
    after = st.current_cases(log.unionByName(move), ["fin_extraccion_entidades"])
    return after.select("guid", "estado", micros("fin_extraccion_entidades"))


@query("d4_replace_entities", """
WITH old AS (SELECT guid, source AS term FROM results), parents AS (SELECT guid FROM results WHERE doc_id % 3 = 0),
new AS (SELECT guid, lang || '/new' AS term FROM results WHERE doc_id % 3 = 0 AND fiebre)
SELECT * FROM old WHERE guid NOT IN (SELECT guid FROM parents) UNION ALL SELECT * FROM new""")
def d4_replace_entities(t):
    old = t.results.select("guid", F.col("source").alias("term"))
    parents = t.results.where("doc_id % 3 = 0")
    new = parents.where("fiebre").select("guid", F.concat("lang", F.lit("/new")).alias("term"))
    return st.replace_children(old, new, parents)


def two_logs(t):
    """Two annotation runs per case and, for some, predictions between them."""
    base = t.predictions.select("guid", "doc_id", "nivel_triaje", "prediccion_modelo", "confianza")
    first = base.select("guid", F.lit(1).alias("nivel_triaje"), F.lit(1).alias("ts"), F.col("doc_id").alias("seq"))
    second = base.where("doc_id % 4 <> 0").select(
        "guid", "nivel_triaje", F.lit(3).alias("ts"), F.col("doc_id").alias("seq"))
    predicted = base.where("doc_id % 5 <> 0").select(
        "guid", "prediccion_modelo", "confianza", F.lit(2).alias("ts"), F.col("doc_id").alias("seq"))
    return first.unionByName(second), predicted


@query("d5_upsert_results", """SELECT guid, CASE WHEN doc_id % 4 = 0 THEN 1 ELSE nivel_triaje END AS nivel_triaje,
  CASE WHEN doc_id % 5 = 0 THEN -1 ELSE coalesce(prediccion_modelo, -1) END AS prediccion_modelo,
  CASE WHEN doc_id % 5 = 0 THEN -1.0 ELSE confianza END AS confianza FROM predictions""")
def d5_upsert_results(t):
    """Findings are replaced by a later run; the prediction stays."""
    merged = st.merge_results(*two_logs(t))
    return merged.fillna({"prediccion_modelo": -1, "confianza": -1.0})


@query("o8_latest_row", """WITH ranked AS (SELECT guid, estado, seq, row_number() OVER (PARTITION BY guid ORDER BY ts DESC, seq DESC) AS rn FROM state_log)
SELECT guid, estado, seq FROM ranked WHERE rn = 1""")
def o8_latest_row(t):
    return st.latest_rows(t.state_log, "guid", ["ts", "seq"]).select("guid", "estado", "seq")


@query("o8_compacted_rows", f"""WITH ranked AS (SELECT guid, seq, epoch_us(ts) AS at_us, row_number() OVER (PARTITION BY guid ORDER BY ts DESC, seq DESC) AS rn FROM state_log)
SELECT guid, CAST(seq % 5 + 1 AS INT) AS prediccion_modelo, at_us, seq FROM ranked WHERE rn = 1""")
def o8_compacted_rows(t):
    """The newest prediction of each case, from two snapshots and the rows since."""
    store = Store(t.spark, scratch_path(t.spark, "store")).prepare()
    rows = materialize(t.state_log.select(
        "guid", (F.col("seq") % 5 + 1).cast("int").alias("prediccion_modelo"), F.lit(1.0).alias("confianza"),
        F.lit(1.0).alias("valoracion"), "ts", F.col("seq").cast("long").alias("seq")), "predictions")
    for part in range(3):
        store.append("predictions", rows.where(F.col("seq") % 3 == part))
        if part < 2:
            store.compact()
    newest = st.latest_rows(store.read("predictions"), "guid", ["ts", "seq"])
    return newest.select("guid", "prediccion_modelo", F.unix_micros("ts").alias("at_us"), "seq")


_D6 = f"""
WITH latest AS (SELECT guid, arg_max(estado, row(ts, seq)) AS estado FROM state_log GROUP BY guid)
SELECT CASE estado WHEN 'ENRICHED' THEN 'DATASET_READY' ELSE estado END AS estado, count(*) AS n,
  count(*) FILTER (WHERE estado = 'ENRICHED') AS with_url FROM latest GROUP BY 1"""


@query("d6_compacted_transition", _D6)
def d6_compacted_transition(t):
    """The move is appended to a compacted store, which is then compacted again."""
    store = compacted_store(t)
    store.append("case_log", st.move_all(materialize(store.cases([]), "read"), "ENRICHED", "DATASET_READY", AT, 5, url_dataset_generado="datasets/v1"))
    store.compact()
    return store.cases(["url_dataset_generado"]).groupBy("estado").agg(F.count("*").alias("n"), F.count("url_dataset_generado").alias("with_url"))


@query("d6_bulk_transition", _D6)
def d6_bulk_transition(t):
    log = case_log(t)
    moves = st.move_all(st.current_cases(log, []), "ENRICHED", "DATASET_READY", AT, 5, url_dataset_generado="datasets/v1")
    after = st.current_cases(log.unionByName(moves), ["url_dataset_generado"])
    return after.groupBy("estado").agg(F.count("*").alias("n"), F.count("url_dataset_generado").alias("with_url"))


@query("d7_store_predictions", """SELECT guid, prediccion_modelo, confianza,
  round(greatest(0, CAST(confianza AS DECIMAL(20, 15)) - abs(prediccion_modelo - nivel_triaje) * 0.25) * 10, 1)::DOUBLE AS valoracion
  FROM predictions WHERE prediccion_modelo IS NOT NULL""")
def d7_store_predictions(t):
    """Prediction rows appended to their own log and read back."""
    from anamnesis.functions.encoding import rating
    rows = t.predictions.where("prediccion_modelo IS NOT NULL").select(
        "guid", "prediccion_modelo", "confianza",
        rating(F.col("confianza"), F.col("prediccion_modelo"), F.col("nivel_triaje")).alias("valoracion"),
    )
    return materialize(rows, "predictions")


@query("d8_complete_cases", f"""SELECT guid, 'COMPLETADA' AS estado, 'modelo_1' AS url_modelo_entrenado, {AT_US} AS fin_solicitud
  FROM predictions WHERE prediccion_modelo IS NOT NULL""")
def d8_complete_cases(t):
    done = t.predictions.where("prediccion_modelo IS NOT NULL")
    rows = st.transition(done, "COMPLETADA", AT, 8, url_modelo_entrenado="modelo_1", fin_solicitud=AT)
    return rows.select("guid", "estado", "url_modelo_entrenado", F.unix_micros("fin_solicitud").alias("fin_solicitud"))


@query("d9_failed_rows_stay_pending", f"""WITH r AS ({_LOOKUP})
SELECT guid, CASE WHEN missing THEN 'ERROR_ENRICHMENT' ELSE 'ENRICHED' END AS estado, missing AS pending FROM r""")
def d9_failed_rows_stay_pending(t):
    """Cases whose text is gone end in the error state and are pending again."""
    enriched = enrich_texts(tx.texts_of(t.doc_cases, stored_texts(t)).select("guid", "texto"))
    good, bad = enriched.where("error IS NULL"), enriched.where("error IS NOT NULL")
    log = st.transition(good, "ENRICHED", AT, 4).unionByName(st.transition(bad, "ERROR_ENRICHMENT", AT, 4))
    cases = st.current_cases(log, [])
    waiting = st.pending(cases).select("guid", F.lit(True).alias("pending"))
    return cases.join(waiting, "guid", "left").select("guid", "estado", F.coalesce("pending", F.lit(False)).alias("pending"))


@query("d10_duplicate_keys", "SELECT guid, count(*) AS n FROM state_log GROUP BY guid HAVING count(*) > 1")
def d10_duplicate_keys(t):
    return st.duplicate_keys(t.state_log)


@query("d11_backup_and_reset", """
WITH latest AS (SELECT guid, arg_max(estado, row(ts, seq)) AS estado FROM state_log GROUP BY guid)
SELECT (SELECT count(*) FROM state_log) AS n_backup, count(*) FILTER (WHERE estado IN ('COMPLETADA', 'INGESTED')) AS n_at_start,
  count(*) FILTER (WHERE estado = 'COMPLETADA') AS n_reset FROM latest""")
def d11_backup_and_reset(t):
    log = case_log(t)
    backup = materialize(log, "backup")
    moves = st.move_all(st.current_cases(log, []), "COMPLETADA", "INGESTED", AT, 9)
    after = st.current_cases(log.unionByName(moves), [])
    return after.agg(
        backup.agg(F.count("*")).scalar().alias("n_backup"),
        F.count_if(F.col("estado") == "INGESTED").alias("n_at_start"),
        moves.agg(F.count("*")).scalar().alias("n_reset"),
    )


@query("d11_restored_cases", """SELECT guid, arg_max(estado, row(ts, seq)) AS estado, true AS was_reset FROM state_log GROUP BY guid
  HAVING arg_max(estado, row(ts, seq)) = 'COMPLETADA' UNION ALL SELECT guid, arg_max(estado, row(ts, seq)), false FROM state_log GROUP BY guid
  HAVING arg_max(estado, row(ts, seq)) <> 'COMPLETADA'""")
def d11_restored_cases(t):
    """Cases after a reset, a snapshot and the way back; beside them, whom the reset had moved."""
    store = compacted_store(t)
    version = reset_for_enrichment(store, "COMPLETADA")
    store.compact()
    after = store.cases([]).select("guid", F.col("estado").alias("reset"))
    store.restore(version)
    cases = store.cases([]).join(after, "guid")
    return cases.select("guid", "estado", (F.col("estado") != F.col("reset")).alias("was_reset"))


@query("a1_state_counts", "SELECT estado, count(*) AS n FROM cases GROUP BY estado")
def a1_state_counts(t):
    return mt.state_counts(t.cases)


@query("a5_error_counts", "SELECT estado, count(*) AS n FROM cases WHERE contains(estado, 'ERROR') GROUP BY estado")
def a5_error_counts(t):
    return mt.error_counts(t.cases)


@query("p14_error_cases", "SELECT guid FROM cases WHERE contains(estado, 'ERROR')")
def p14_error_cases(t):
    return t.cases.where(F.col("estado").contains("ERROR")).select("guid")


@query("j5_state_map", """WITH c AS (SELECT estado, count(*) AS n FROM cases GROUP BY estado)
SELECT '{' || string_agg('"' || estado || '":' || n, ',' ORDER BY estado) || '}' AS por_estado, CAST(sum(n) AS BIGINT) AS total FROM c""")
def j5_state_map(t):
    return mt.state_map(mt.state_counts(t.cases)).select(F.to_json("por_estado").alias("por_estado"), "total")


@query("a13_batch_report", f"""WITH r AS (SELECT CASE WHEN nombre_fichero IN ({_KNOWN}) THEN 'skipped' ELSE 'ingested' END AS outcome FROM transcripts)
SELECT outcome, count(*) AS n FROM r GROUP BY outcome""")
def a13_batch_report(t):
    files = t.transcripts.select("nombre_fichero")
    fresh = st.insert_if_absent(files, known_names(t), "nombre_fichero").withColumn("_new", F.lit(True))
    return mt.batch_report(files.join(fresh, "nombre_fichero", "left").select(
        F.when(F.col("_new"), "ingested").otherwise("skipped").alias("outcome")))
