"""Sources and sinks: S1-S13, S15, S16, P20."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from anamnesis.functions import text as fx
from anamnesis.operators import evaluation as ev, features as ft
from anamnesis.plans.learn import evaluation_document
from anamnesis.plans.score import response_rows
from anamnesis.session import scratch_path
from anamnesis.sources import artifacts as ar, texts as tx
from anamnesis.sources.store import read_table

from .encoding import ENCODED, OUTPUT
from .registry import query

JAN_2024 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def corpus_files(t):
    """The benchmark items as one text file each, below a scratch folder."""
    folder = scratch_path(t.spark, "corpus")
    named = t.benchmark.select("text", F.concat(F.lit("caso_"), F.col("item_id").cast("string"), F.lit(".txt")).alias("nombre"))
    named.write.partitionBy("nombre").text(folder)
    return tx.scan_corpus(t.spark, folder, recursive=True).withColumn(
        "nombre_fichero", F.regexp_extract("path", "nombre=([^/]+)/", 1))


@query("s1_corpus_scan", "SELECT 'caso_' || item_id || '.txt' AS nombre_fichero, md5(text || chr(10)) AS digest FROM benchmark")
def s1_corpus_scan(t):
    return corpus_files(t).select("nombre_fichero", F.md5("content").alias("digest"))


@query("s16_demo_cases", "SELECT 'caso ' || item_id AS etiqueta, md5(text || chr(10)) AS digest FROM benchmark")
def s16_demo_cases(t):
    return tx.demo_cases(corpus_files(t)).select("etiqueta", F.md5("texto").alias("digest"))


@query("s13_list_objects", "SELECT 'nombre=caso_' || item_id || '.txt' AS folder FROM benchmark WHERE starts_with(CAST(item_id AS VARCHAR), '1')")
def s13_list_objects(t):
    folder = scratch_path(t.spark, "objects")
    named = t.benchmark.select("text", F.concat(F.lit("caso_"), F.col("item_id").cast("string"), F.lit(".txt")).alias("nombre"))
    named.write.partitionBy("nombre").text(folder)
    found = tx.list_objects(t.spark, folder, "nombre=caso_1")
    return found.select(F.substring_index("name", "/", 1).alias("folder"))


def encoded_documents(t):
    """Whole texts as bytes: UTF-8, UTF-16 with a mark, or Latin-1 where the
    text allows it and its bytes are no accidental UTF-8."""
    latin = F.col("text").rlike("^[\\x00-\\xff]*$") & F.col("text").rlike("[\\xe0-\\xff]") & ~F.col("text").rlike("[\\xc0-\\xdf][\\x80-\\xbf]|[\\xe0-\\xff][\\x80-\\xbf]")
    kind = F.col("doc_id") % 3
    content = (
        F.when(kind == 1, F.encode("text", "UTF-16"))
        .when((kind == 2) & latin, F.encode("text", "ISO-8859-1"))
        .otherwise(F.encode("text", "UTF-8"))
    )
    return t.documents.select("doc_id", content.alias("content"))


@query("s2_decode", "SELECT doc_id, md5(text) AS digest FROM documents")
def s2_decode(t):
    return encoded_documents(t).select("doc_id", F.md5(tx.decode(F.col("content"))).alias("digest"))


@query("s3_unix_newlines", """SELECT doc_id, md5(regexp_replace(replace(text, chr(10), CASE doc_id % 3 WHEN 0 THEN chr(13) || chr(10)
  WHEN 1 THEN chr(13) ELSE chr(10) END), '\\r\\n?', chr(10), 'g')) AS digest FROM documents""")
def s3_unix_newlines(t):
    end = F.when(F.col("doc_id") % 3 == 0, "\r\n").when(F.col("doc_id") % 3 == 1, "\r").otherwise("\n")
    return t.documents.select("doc_id", F.md5(fx.unix_newlines(F.replace("text", F.lit("\n"), end))).alias("digest"))


def store_transcripts(t):
    path = scratch_path(t.spark, "transcripts")
    rows = t.transcripts.withColumn("especialidad", fx.specialty_at_ingest(F.col("nombre_fichero")))
    tx.write_transcripts(rows, path)
    return tx.stored_transcripts(t.spark, path), path


_SPEC = "substr(upper(regexp_replace(regexp_replace(nombre_fichero, '\\.txt$', ''), '[^\\p{L}]', '', 'g')), 1, 3)"


@query("s4_transcript_store", f"""SELECT {_SPEC} AS especialidad, nombre_fichero, md5(texto) AS digest FROM transcripts
  WHERE {_SPEC} IN ('CAR', 'RES')""")
def s4_transcript_store(t):
    """Stored by specialty; the read of two of them opens two folders."""
    stored, _ = store_transcripts(t)
    return stored.where(F.coalesce("especialidad", F.lit("")).isin("CAR", "RES")).select(
        "especialidad", "nombre_fichero", F.md5("texto").alias("digest"))


@query("s5_text_by_key", f"""SELECT c.guid, md5(t.texto) AS digest FROM doc_cases c JOIN transcripts t
  ON c.nombre_fichero = t.nombre_fichero AND c.especialidad = {_SPEC.replace('nombre_fichero', 't.nombre_fichero')}""")
def s5_text_by_key(t):
    stored, _ = store_transcripts(t)
    found = tx.texts_of(t.doc_cases, stored).where("texto IS NOT NULL")
    return found.select("guid", F.md5("texto").alias("digest"))


@query("s5_text_of_every_name", """SELECT guid, md5(texto) AS digest FROM transcripts""")
def s5_text_of_every_name(t):
    """Cases as ingest makes them, names without letters among them, all find their text."""
    stored, _ = store_transcripts(t)
    cases = t.transcripts.withColumn("especialidad", fx.specialty_at_ingest(F.col("nombre_fichero")))
    return tx.texts_of(cases, stored).select("guid", F.md5("texto").alias("digest"))


@query("s6_lossy_decode", "SELECT doc_id, md5(CASE doc_id % 2 WHEN 0 THEN text || chr(65533) || 'x' ELSE text END) AS digest FROM documents")
def s6_lossy_decode(t):
    bad = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF78")))
    content = F.when(F.col("doc_id") % 2 == 0, bad).otherwise(F.encode("text", "UTF-8"))
    return t.documents.select("doc_id", F.md5(tx.decode_lossy(content)).alias("digest"))


def requests(t):
    """Requests with a file, a text, blanks, or nothing."""
    kind = F.col("doc_id") % 5
    return t.documents.select(
        "doc_id",
        F.when(kind.isin(0, 3), "CAR1.txt").alias("filename"),
        F.when(kind == 0, F.encode("text", "UTF-8")).when(kind == 3, F.encode(F.lit(" \n\t"), "UTF-8")).alias("contenido"),
        F.when(kind.isin(1, 0), F.col("text")).when(kind == 2, "  \n").when(kind == 4, "").alias("texto"),
    )


@query("s7_on_demand_input", """SELECT doc_id, CASE WHEN doc_id % 5 IN (0, 3) THEN 'CAR1.txt' ELSE '' END AS filename,
  CASE doc_id % 5 WHEN 2 THEN 'blank' WHEN 3 THEN 'blank' WHEN 4 THEN 'missing'
    ELSE CASE WHEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'blank' ELSE 'ok' END END AS outcome FROM documents""")
def s7_on_demand_input(t):
    checked = tx.on_demand_input(requests(t))
    return checked.select("doc_id", "filename", F.coalesce("entrada_error", F.lit("ok")).alias("outcome"))


@query("s7_requests_with_text", """SELECT r.guid, CASE WHEN doc_id % 2 = 0 THEN
    coalesce(d.especialidad, upper(substr(r.nombre_fichero, 1, 3))) || '/' || r.nombre_fichero ELSE '' END AS objeto,
  CASE WHEN doc_id % 2 = 1 THEN 'given' WHEN coalesce(d.especialidad, upper(substr(r.nombre_fichero, 1, 3))) = """ + _SPEC.replace('nombre_fichero', 'r.nombre_fichero') + """
    THEN 'stored' ELSE 'none' END AS source FROM transcripts r JOIN doc_cases d ON r.guid = d.guid""")
def s7_requests_with_text(t):
    """Scoring requests by file name or with a text of their own."""
    stored, _ = store_transcripts(t)
    by_file = F.col("doc_id") % 2 == 0
    asked = t.transcripts.join(t.doc_cases.select("guid", "especialidad"), "guid").select(
        "guid", F.when(by_file, F.col("nombre_fichero")).otherwise("").alias("filename"),
        "especialidad", F.when(~by_file, "given").alias("texto"))
    found = tx.requested_texts(asked, stored)
    source = F.when(F.col("texto") == "given", "given").when(F.col("texto").isNotNull(), "stored").otherwise("none")
    return found.select("guid", "objeto", source.alias("source"))


@query("s8_archive_on_demand", """SELECT 'fase2' AS especialidad, guid || '.txt' AS nombre_fichero, guid, md5(texto) AS digest FROM transcripts""")
def s8_archive_on_demand(t):
    """New rows go to a folder of their own; the rest of the store stays."""
    _, path = store_transcripts(t)
    tx.write_transcripts(tx.archive_on_demand(t.transcripts.select("guid", "texto")), path)
    stored = tx.stored_transcripts(t.spark, path).where("especialidad = 'fase2'")
    return stored.select("especialidad", "nombre_fichero", "guid", F.md5("texto").alias("digest"))


@query("s9_parameterised_scan", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND value > 10.0")
def s9_parameterised_scan(t):
    return read_table(t.spark, t.path("events"),
                      "SELECT event_id, user_id FROM {source} WHERE event_type = :kind AND value > :least",
                      kind="purchase", least=10.0)


def dataset_folder(t):
    folder = scratch_path(t.spark, "datasets")
    rows = ft.encode_raw(t.results).withColumn("origen", F.lit("dataset")).select(*ft.DATASET_COLUMNS)
    for year in (2023, 2024):
        ar.write_dataset(rows.where(F.lit(year == 2024)), folder, JAN_2024.replace(year=year))
    return folder


@query("s10_dataset_csv", """SELECT 'dataset_entrenamiento_20240101_000000' AS name, count(*) AS n_rows, count(score_urgencia) AS n_scored FROM results""")
def s10_dataset_csv(t):
    """Dated CSV folders; the newest published one is read."""
    name, rows = ar.latest_dataset(t.spark, dataset_folder(t))
    return rows.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"), F.count("score_urgencia").alias("n_scored"))


@query("s11_dataset_scan", f"WITH enc AS ({ENCODED}) SELECT {', '.join(OUTPUT)} FROM enc WHERE score_urgencia IS NOT NULL")
def s11_dataset_scan(t):
    _, rows = ar.latest_dataset(t.spark, dataset_folder(t))
    return ft.training_rows_from_encoded(rows).select(*OUTPUT)


@query("s12_latest_by_prefix", """WITH n AS (SELECT CASE event_type WHEN 'view' THEN 'modelo_' WHEN 'click' THEN 'dataset_entrenamiento_'
  ELSE 'evaluacion_' END || strftime(ts, '%Y%m%d_%H%M%S') AS name FROM state_log)
SELECT max(name) AS latest FROM n WHERE name LIKE 'modelo_%'""")
def s12_latest_by_prefix(t):
    kind = F.when(F.col("event_type") == "view", "modelo_").when(F.col("event_type") == "click", "dataset_entrenamiento_").otherwise("evaluacion_")
    names = t.state_log.select(F.concat(kind, fx.version_stamp(F.col("ts"))).alias("name"))
    return ar.latest_by_prefix(names, "modelo_")


@query("s15_evaluation_json", """SELECT 'modelo_1' AS modelo, count(*) FILTER (WHERE nivel_triaje <= 2 AND prediccion_modelo > nivel_triaje) AS under_triage_count,
  count(*) FILTER (WHERE nivel_triaje = 3 AND prediccion_modelo = 3) AS c3_hits, count(*) FILTER (WHERE nivel_triaje = 3) AS c3_support,
  count(*) FILTER (WHERE nivel_triaje = 3 AND prediccion_modelo = 3)::DOUBLE / count(*) FILTER (WHERE nivel_triaje = 3) AS c3_recall
FROM predictions WHERE prediccion_modelo IS NOT NULL""")
def s15_evaluation_json(t):
    """The document written as JSON and read back with its fixed schema."""
    rows = t.predictions.where("prediccion_modelo IS NOT NULL")
    folds = ev.fold_scores(rows.withColumn("fold", (F.col("doc_id") % 5).cast("int")))
    importances = t.results.agg(F.create_map(F.lit("edad"), F.avg("edad")).alias("feature_importances"))
    folder = scratch_path(t.spark, "evaluations")
    ar.write_evaluation(evaluation_document(rows, folds, importances, "modelo_1", "dataset_1"), folder, JAN_2024)
    read = ar.latest_evaluation(t.spark, folder)
    c3 = F.col("classification_report.C3")
    return read.select("modelo", "under_triage_count", F.col("confusion_matrix")[2][2].alias("c3_hits"),
                       c3["support"].alias("c3_support"), c3["recall"].alias("c3_recall"))


@query("p20_response_rows", """SELECT guid, prediccion_modelo AS nivel_triaje_predicho, 'C' || prediccion_modelo AS nivel_manchester,
  nivel_triaje AS nivel_triaje_llm, coalesce(score_urgencia, -9.0) AS score_urgencia, coalesce(score_ansiedad, -9.0) AS score_ansiedad,
  CAST(round(CAST(confianza AS DECIMAL(20, 15)), 3) AS DOUBLE) AS confianza, confianza * 10 AS valoracion,
  coalesce(motivo_consulta, '?') AS motivo_consulta, justificacion, '' AS entidades_normalizadas
  FROM predictions WHERE prediccion_modelo IS NOT NULL""")
def p20_response_rows(t):
    scored = t.predictions.where("prediccion_modelo IS NOT NULL").withColumns({
        "nivel_triaje_llm": F.col("nivel_triaje"), "valoracion": F.col("confianza") * 10,
        "entidades_normalizadas": F.lit(None).cast("array<string>"),
    })
    return response_rows(scored).withColumn(
        "entidades_normalizadas", F.array_join("entidades_normalizadas", ",")
    ).fillna(-9.0, ["score_urgencia", "score_ansiedad"]).fillna("?", ["motivo_consulta"])
