"""Text, names and keys: X*, P1-P5, P15, and the flagship query."""

from pyspark.sql import functions as F

from anamnesis.functions import text as tx
from anamnesis.plans.enrich import preprocess
from anamnesis.session import materialize

from .registry import query

PROMPT = (
    "Read the interview and answer with one JSON object that holds the level (1-5), urgency, "
    "anxiety, complaint, entities, age, sex, pain and the six clinical signs.\n{transcripcion}"
)
EXAMPLES = [("P: Me duele la rodilla.", '{"nivel_triaje": 4}'), ("P: Me ahogo.", '{"nivel_triaje": 2}')]


@query("conversation_patient_words", """
WITH whole AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY turn) AS texto, count(*) AS n_turns
  FROM turns GROUP BY conv_id),
words AS (SELECT conv_id, n_turns, list_transform(
    list_filter(string_split(texto, chr(10)), lambda l: starts_with(trim(l), 'P:')),
    lambda l: regexp_replace(trim(substr(trim(l), 3)), ' +', ' ', 'g')) AS pieces FROM whole)
SELECT conv_id, n_turns, CAST(len(pieces) AS BIGINT) AS n_patient_lines,
  CAST(length(array_to_string(pieces, ' ')) AS BIGINT) AS patient_chars FROM words""")
def conversation_patient_words(t):
    """Per conversation: turns, patient lines, length of the patient text.

    Works turn by turn: a turn is cleaned and counted where it is read, and
    only numbers are shuffled, so no conversation is ever put together in one
    task however long it is.
    """
    pieces = tx.patient_turns(tx.clean_text(F.col("line")))
    counted = t.turns.select("conv_id", pieces.alias("pieces")).select(
        "conv_id", F.size("pieces").alias("n"),
        F.aggregate("pieces", F.lit(0), lambda total, piece: total + F.length(piece)).alias("chars"),
    )
    lines = F.sum("n")
    return counted.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), lines.alias("n_patient_lines"),
        (F.sum("chars") + F.greatest(lines - 1, F.lit(0))).alias("patient_chars"),
    )


@query("x1_clean_text", "SELECT doc_id, md5(texto) AS digest, CAST(length(texto) AS BIGINT) AS n_chars FROM clean")
def x1_clean_text(t):
    clean = t.transcripts.select("doc_id", tx.clean_text(F.col("texto")).alias("texto"))
    return clean.select("doc_id", F.md5("texto").alias("digest"), F.length("texto").cast("long").alias("n_chars"))


@query("x2_patient_turns", "SELECT doc_id, md5(texto) AS digest FROM patient")
def x2_patient_turns(t):
    words = tx.patient_text(tx.clean_text(F.col("texto")))
    return t.transcripts.select("doc_id", F.md5(words).alias("digest"))


@query("x2_patient_turns_of_raw_text", "SELECT doc_id, md5(regexp_replace(texto, '^ +| +$', '', 'g')) AS digest FROM patient")
def x2_patient_turns_of_raw_text(t):
    """Turns cut before cleaning: inner white space is cleaned afterwards."""
    words = tx.clean_text(tx.patient_text(F.col("texto"), cleaned=False))
    return t.transcripts.select("doc_id", F.md5(words).alias("digest"))


@query("x3_preprocess", """SELECT guid, md5(full_text) AS full_digest, md5(texto) AS patient_digest FROM patient""")
def x3_preprocess(t):
    done = preprocess(t.transcripts)
    return done.select(
        "guid", F.md5("texto_completo").alias("full_digest"), F.md5("texto_paciente").alias("patient_digest")
    )


@query("x4_patient_length", "SELECT guid, CAST(length(texto) AS BIGINT) AS patient_chars FROM patient")
def x4_patient_length(t):
    return preprocess(t.transcripts).select("guid", F.length("texto_paciente").cast("long").alias("patient_chars"))


@query("p15_text_to_annotate", """SELECT guid, md5(CASE WHEN length(texto) > 0 THEN texto ELSE full_text END) AS digest,
  length(texto) = 0 AS fell_back FROM patient""")
def p15_text_to_annotate(t):
    return preprocess(t.transcripts).select(
        "guid", F.md5("texto_anotable").alias("digest"), (F.length("texto_paciente") == 0).alias("fell_back")
    )


@query("x6_chat_messages", f"""
WITH m AS (SELECT guid, replace('{PROMPT}', '{{transcripcion}}', texto) AS content FROM clean)
SELECT guid, 5 AS n_messages, md5(content) AS last_digest, 'user' AS last_role, 'user,assistant,user,assistant,user' AS roles,
  md5(replace('{PROMPT}', '{{transcripcion}}', '{EXAMPLES[1][0]}') || '|' || '{EXAMPLES[1][1]}') AS second_example FROM m""".replace("\n{trans", "' || chr(10) || '{trans"))
def x6_chat_messages(t):
    messages = tx.chat_messages(PROMPT, EXAMPLES, tx.clean_text(F.col("texto")))
    made = t.transcripts.select("guid", messages.alias("m"))
    return made.select(
        "guid", F.size("m").alias("n_messages"), F.md5(F.element_at("m", -1)["content"]).alias("last_digest"),
        F.element_at("m", -1)["role"].alias("last_role"), F.array_join(F.col("m.role"), ",").alias("roles"),
        F.md5(F.concat_ws("|", F.col("m")[2]["content"], F.col("m")[3]["content"])).alias("second_example"),
    )


@query("j8_request_envelope", """
SELECT guid, 'local-model' AS model, 0 AS temperature, 'json_object' AS reply_format, 5 AS n_messages,
  md5(texto) AS asked_digest FROM clean""")
def j8_request_envelope(t):
    """Requests as a table, read back as a client would."""
    template = tx.PLACEHOLDER
    messages = tx.chat_messages(template, EXAMPLES, tx.clean_text(F.col("texto")))
    requests = t.transcripts.select("guid", tx.request_envelope("local-model", messages).alias("request"))
    schema = "model string, messages array<struct<role:string,content:string>>, temperature int, response_format struct<type:string>"
    body = F.from_json("request", schema)
    return requests.select("guid", body.alias("b")).select(
        "guid", F.col("b.model").alias("model"), F.col("b.temperature").alias("temperature"),
        F.col("b.response_format.type").alias("reply_format"), F.size("b.messages").alias("n_messages"),
        F.md5(F.element_at("b.messages", -1)["content"]).alias("asked_digest"),
    )


@query("x7_level_label", """SELECT guid, CASE WHEN prediccion_modelo BETWEEN 1 AND 5 THEN 'C' || prediccion_modelo
  ELSE CAST(prediccion_modelo AS VARCHAR) END AS predicted, CASE WHEN n_chars % 7 BETWEEN 1 AND 5 THEN 'C' || (n_chars % 7)
  ELSE CAST(n_chars % 7 AS VARCHAR) END AS other FROM predictions""")
def x7_level_label(t):
    from anamnesis.functions.encoding import level_label
    return t.predictions.select(
        "guid", level_label(F.col("prediccion_modelo")).alias("predicted"),
        level_label(F.col("n_chars") % 7).alias("other"),
    )


@query("x8_specialty_normalised", "SELECT guid, trim(upper(especialidad)) AS code FROM results")
def x8_specialty_normalised(t):
    return t.results.select("guid", tx.strip(F.upper("especialidad")).alias("code"))


@query("x9_version_stamp", """SELECT seq, 'dataset_entrenamiento_' || strftime(ts, '%Y%m%d_%H%M%S') AS name FROM state_log""")
def x9_version_stamp(t):
    return t.state_log.select("seq", F.concat(F.lit("dataset_entrenamiento_"), tx.version_stamp(F.col("ts"))).alias("name"))


@query("x10_join_segments", f"""SELECT doc_id, md5(array_to_string(list_transform(string_split(text, '. '),
  lambda s: trim(s, chr(9) || chr(10) || chr(13) || ' ')), ' ')) AS digest FROM documents""")
def x10_join_segments(t):
    segments = F.split("text", r"\. ")
    return t.documents.select("doc_id", F.md5(tx.join_segments(segments)).alias("digest"))


@query("p1_case_id", r"""SELECT doc_id, sha256(nombre_fichero || chr(10) || texto) AS guid FROM transcripts""")
def p1_case_id(t):
    return t.transcripts.select("doc_id", tx.stable_guid(F.col("nombre_fichero"), F.col("texto")).alias("guid"))


@query("p1_random_case_id", "SELECT count(*) AS n_cases, count(*) AS n_ids, count(*) AS n_well_formed FROM documents")
def p1_random_case_id(t):
    """Random ids, as on-demand cases get them: all new, all of version 4. Ids
    differ from run to run, so they are written before they are counted."""
    made = materialize(t.documents.select("doc_id", F.uuid().alias("guid")), "ids")
    pattern = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return made.agg(
        F.count("*").alias("n_cases"), F.countDistinct("guid").alias("n_ids"),
        F.count_if(F.col("guid").rlike(pattern)).alias("n_well_formed"),
    )


@query("p2_specialty_at_ingest", """SELECT doc_id, substr(upper(regexp_replace(regexp_replace(nombre_fichero, '\\.txt$', ''),
  '[^\\p{L}]', '', 'g')), 1, 3) AS especialidad FROM transcripts""")
def p2_specialty_at_ingest(t):
    return t.transcripts.select("doc_id", tx.specialty_at_ingest(F.col("nombre_fichero")).alias("especialidad"))


@query("p3_specialty_at_scoring", """
WITH c AS (SELECT doc_id, upper(regexp_replace(substr(nombre_fichero, 1, 3), '[^\\p{L}]', '', 'g')) AS code FROM transcripts)
SELECT doc_id, CASE WHEN code IN ('CAR', 'DER', 'GAS', 'GEN', 'MSK', 'RES', 'UNK') THEN code ELSE 'UNK' END AS especialidad FROM c""")
def p3_specialty_at_scoring(t):
    return t.transcripts.select("doc_id", tx.specialty_at_scoring(F.col("nombre_fichero")).alias("especialidad"))


@query("p4_specialty_in_job", """SELECT guid, coalesce(especialidad, upper(substr(nombre_fichero, 1, 3))) AS especialidad
  FROM doc_cases""")
def p4_specialty_in_job(t):
    return t.doc_cases.select(
        "guid", tx.specialty_in_job(F.col("especialidad"), F.col("nombre_fichero")).alias("especialidad")
    )


@query("p5_object_key_and_url", """SELECT doc_id, 'RES/' || nombre_fichero AS object_key,
  's3://store/textos/RES/' || nombre_fichero AS url FROM transcripts""")
def p5_object_key_and_url(t):
    key = tx.object_key(F.lit("RES"), F.col("nombre_fichero"))
    return t.transcripts.select("doc_id", key.alias("object_key"), tx.object_url("s3://store/", "textos", key).alias("url"))
