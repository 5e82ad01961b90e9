"""Replies: X5, J1-J4, E7, M2-M4."""

from pyspark.sql import functions as F

from anamnesis.functions import replies as rp
from anamnesis.operators import annotate as an
from anamnesis.plans.enrich import enrich_texts, preprocess
from anamnesis.schemas import FLAGS, REPLY_FIELDS

from .registry import query


def reply_fields(t):
    """Result rows with every field a reply has."""
    return t.results.selectExpr(
        "guid", "doc_id", "nivel_triaje", "score_urgencia", "score_ansiedad", "motivo_consulta",
        "filter(array(lang, source, sexo, especialidad), x -> x IS NOT NULL) AS entidades",
        "slice(array(upper(lang), upper(source), CAST(n_chars AS STRING)), 1, CAST(doc_id % 3 AS INT) + 1) AS entidades_normalizadas",
        "edad", "sexo", "dolor_intensidad", *FLAGS, "justificacion",
    )


def raw_replies(t):
    """Those rows as annotator replies: nulls written or left out, with and
    without fences, some broken."""
    with_nulls = an.reply_json()
    without = F.to_json(F.struct(*REPLY_FIELDS))
    body = F.when(F.col("doc_id") % 2 == 0, without).otherwise(with_nulls)
    fence = F.col("doc_id") % 4
    raw = (
        F.when(F.col("doc_id") % 31 == 0, F.concat(body, F.lit(" and more")))
        .when(F.col("doc_id") % 31 == 1, F.concat(F.lit("["), body, F.lit("]")))
        .when(F.col("doc_id") % 31 == 2, F.lit('{"entidades": null}'))
        .when(F.col("doc_id") % 31 == 3, F.concat(F.lit("```JSON\n"), body, F.lit("\n```")))
        .when(fence == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(fence == 1, F.concat(F.lit(" ```\n"), body, F.lit("```\n")))
        .otherwise(body)
    )
    return reply_fields(t).select("guid", "doc_id", raw.alias("raw"))


_ERROR = """CASE doc_id % 31 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'not_an_object'
  WHEN 2 THEN 'bad_entity_list' WHEN 3 THEN 'invalid_json' END"""


@query("x5_strip_fence", """
WITH r AS (SELECT guid, doc_id, '{"id":' || doc_id || '}' AS body FROM results)
SELECT guid, CASE WHEN doc_id % 4 = 2 THEN 'JSON' || chr(10) || body WHEN doc_id % 4 = 3 THEN body || '```' ELSE body END AS reply FROM r""")
def x5_strip_fence(t):
    body = F.concat(F.lit('{"id":'), F.col("doc_id").cast("string"), F.lit("}"))
    kind = F.col("doc_id") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```\n")))
        .when(kind == 1, F.concat(F.lit("\n```"), body, F.lit("```")))
        .when(kind == 2, F.concat(F.lit("```JSON\n"), body, F.lit("\n```")))
        .otherwise(F.concat(body, F.lit("```")))
    )
    return t.results.select("guid", rp.strip_fence(raw).alias("reply"))


@query("j1_strict_parse", f"SELECT guid, coalesce({_ERROR}, 'ok') AS outcome FROM results")
def j1_strict_parse(t):
    parsed = rp.parse_replies(raw_replies(t))
    return parsed.select("guid", F.coalesce("reply_error", F.lit("ok")).alias("outcome"))


@query("j2_reply_fields", f"""
SELECT guid, nivel_triaje, coalesce(score_urgencia, -9.0) AS urgency, coalesce(score_ansiedad, -9.0) AS anxiety,
  coalesce(edad, -9) AS age, coalesce(sexo, '?') AS sex, coalesce(dolor_intensidad, -9) AS pain,
  coalesce(disnea, false) AS disnea, fiebre, perdida_consciencia, irradiacion, antecedentes_cardiacos, fumador,
  coalesce(motivo_consulta, '?') AS motive, justificacion,
  score_urgencia IS NULL AND doc_id % 2 = 0 AS urgency_missing
FROM results WHERE {_ERROR} IS NULL""")
def j2_reply_fields(t):
    good = rp.parse_replies(raw_replies(t)).where("reply_error IS NULL")
    return good.select(
        "guid", "nivel_triaje", F.coalesce("score_urgencia", F.lit(-9.0)).alias("urgency"),
        F.coalesce("score_ansiedad", F.lit(-9.0)).alias("anxiety"), F.coalesce("edad", F.lit(-9)).alias("age"),
        F.coalesce("sexo", F.lit("?")).alias("sex"), F.coalesce("dolor_intensidad", F.lit(-9)).alias("pain"),
        *FLAGS, F.coalesce("motivo_consulta", F.lit("?")).alias("motive"), "justificacion",
        F.col("urgencia_ausente").alias("urgency_missing"),
    )


_ENTITIES = """
WITH lists AS (SELECT guid, list_filter([lang, source, sexo, especialidad], lambda x: x IS NOT NULL) AS raws,
  [upper(lang), upper(source), CAST(n_chars AS VARCHAR)][1:CAST(doc_id % 3 AS INT) + 1] AS norms FROM results),
pairs AS (SELECT guid, raws, norms, unnest(range(least(len(raws), len(norms)))) AS p FROM lists)"""


@query("j3_entity_rows", f"""{_ENTITIES}
SELECT guid, CAST(p AS INT) AS pos, raws[p + 1] AS entidad_raw, norms[p + 1] AS entidad_normalizada, 'sintoma' AS tipo FROM pairs""")
def j3_entity_rows(t):
    return rp.entity_rows(reply_fields(t))


@query("j4_entity_list", f"""SELECT guid, CASE WHEN doc_id % 31 = 2 OR doc_id % 31 IN (0, 1, 3) THEN ''
  ELSE array_to_string([upper(lang), upper(source), CAST(n_chars AS VARCHAR)][1:CAST(doc_id % 3 AS INT) + 1], ',') END AS entidades
  FROM results""")
def j4_entity_list(t):
    """A reply without the list counts as one with an empty list."""
    parsed = rp.parse_replies(raw_replies(t))
    return parsed.select("guid", F.array_join("entidades_normalizadas", ",").alias("entidades"))


@query("e7_scoring_features", f"""
SELECT guid, CASE trim(upper(especialidad)) WHEN 'CAR' THEN 0 WHEN 'DER' THEN 1 WHEN 'GAS' THEN 2 WHEN 'GEN' THEN 3
    WHEN 'MSK' THEN 4 WHEN 'RES' THEN 5 ELSE 6 END AS especialidad,
  coalesce(edad, -1) AS edad, CASE sexo WHEN 'M' THEN 1 WHEN 'F' THEN 0 ELSE -1 END AS sexo,
  coalesce(dolor_intensidad, -1) AS dolor_intensidad, CAST(coalesce(disnea, false) AS INT) AS disnea,
  CAST(fiebre AS INT) AS fiebre, CAST(perdida_consciencia AS INT) AS perdida_consciencia,
  CAST(irradiacion AS INT) AS irradiacion, CAST(antecedentes_cardiacos AS INT) AS antecedentes_cardiacos,
  CAST(fumador AS INT) AS fumador,
  coalesce(score_urgencia, CASE WHEN doc_id % 2 = 0 THEN 50.0 ELSE -9.0 END) AS urgency_or_null,
  coalesce(score_ansiedad, 0.0) AS score_ansiedad
FROM results WHERE {_ERROR} IS NULL""")
def e7_scoring_features(t):
    """A missing urgency is 50, a null one stays null (shown as -9)."""
    good = rp.parse_replies(raw_replies(t)).where("reply_error IS NULL").join(
        t.results.select("guid", F.col("especialidad").alias("_specialty")), "guid"
    )
    rows = good.select("guid", *[c.alias(n) for n, c in rp.scoring_features(F.col("_specialty")).items()])
    return rows.withColumn("urgency_or_null", F.coalesce("score_urgencia", F.lit(-9.0))).drop("score_urgencia")


_LEVEL = """CASE WHEN perdida_consciencia THEN 1 WHEN irradiacion THEN 2
  WHEN coalesce(dolor_intensidad, 0) >= 7 OR coalesce(disnea, false) THEN 3
  WHEN dolor_intensidad IS NOT NULL OR fiebre THEN 4 ELSE 5 END"""


@query("j2_numbers_out_of_range", """
SELECT guid, CASE doc_id % 4 WHEN 3 THEN CAST(doc_id % 90 AS INT) ELSE -9 END AS age, 3 AS level,
  CASE doc_id % 4 WHEN 2 THEN 7 ELSE -9 END AS pain, 'ok' AS outcome FROM doc_cases JOIN transcripts USING (guid)""")
def j2_numbers_out_of_range(t):
    """A number that no int holds is a missing one; its row and the others stay."""
    kind = F.col("doc_id") % 4
    age = F.when(kind == 0, "99999999999").when(kind == 1, "-1e300").when(kind == 2, '"old"').otherwise((F.col("doc_id") % 90).cast("string"))
    pain = F.when(kind == 2, "7.9").otherwise("3000000000")
    raw = F.concat(F.lit('{"edad": '), age, F.lit(', "nivel_triaje": 3, "dolor_intensidad": '), pain, F.lit("}"))
    parsed = rp.parse_replies(t.transcripts.select("guid", raw.alias("raw")))
    return parsed.select(
        "guid", F.coalesce("edad", F.lit(-9)).alias("age"), F.col("nivel_triaje").alias("level"),
        F.coalesce("dolor_intensidad", F.lit(-9)).alias("pain"), F.coalesce("reply_error", F.lit("ok")).alias("outcome"))


@query("m3_rule_level", f"""
WITH told AS (SELECT *, {_LEVEL} AS nivel FROM interviews)
SELECT guid, nivel AS nivel_triaje, least(100.0, CASE nivel WHEN 1 THEN 95.0 WHEN 2 THEN 80.0 WHEN 3 THEN 50.0 WHEN 4 THEN 25.0 ELSE 5.0 END
  + coalesce(dolor_intensidad, 0) * CAST(0.5 AS DOUBLE) + 2.0 * (CAST(coalesce(disnea, false) AS INT) + CAST(fiebre AS INT)
  + CAST(perdida_consciencia AS INT) + CAST(irradiacion AS INT) + CAST(antecedentes_cardiacos AS INT) + CAST(fumador AS INT))) AS score_urgencia
FROM told""")
def m3_rule_level(t):
    """Level and urgency from whole texts; the check knows what was told."""
    texts = preprocess(t.planted).select("guid", "texto_anotable")
    return an.rule_fields(texts, "texto_anotable").select("guid", "nivel_triaje", "score_urgencia")


@query("m4_rule_extraction", """
SELECT guid, coalesce(edad, -9) AS edad, CASE WHEN sexo IN ('M', 'F') THEN sexo ELSE '?' END AS sexo,
  coalesce(dolor_intensidad, -9) AS dolor_intensidad, coalesce(disnea, false) AS disnea, fiebre,
  perdida_consciencia, irradiacion, antecedentes_cardiacos, fumador FROM interviews""")
def m4_rule_extraction(t):
    """Age, sex, pain and signs, denials and relatives included."""
    texts = preprocess(t.planted).select("guid", "texto_anotable")
    return an.rule_fields(texts, "texto_anotable").select(
        "guid", F.coalesce("edad", F.lit(-9)).alias("edad"), F.coalesce("sexo", F.lit("?")).alias("sexo"),
        F.coalesce("dolor_intensidad", F.lit(-9)).alias("dolor_intensidad"), *FLAGS,
    )


@query("m2_injected_annotator", """
WITH told AS (SELECT guid, antecedentes_cardiacos AS refused FROM interviews)
SELECT guid, refused, CASE WHEN refused THEN 'ValueError: refused' ELSE 'ok' END AS outcome FROM told""")
def m2_injected_annotator(t):
    """An injected client that fails on some rows; failures are data."""
    def connect():
        """Stands in for a model: replies by the number of words it was given."""
        def client(texts):
            if any("Mi madre" not in text and "infarto" in text for text in texts):
                raise ValueError("refused")
            return [f'{{"nivel_triaje": {len(text.split()) % 5 + 1}, "entidades": []}}' for text in texts]
        return client

    texts = preprocess(t.planted).select("guid", "texto_anotable")
    raw = an.annotate(texts, "texto_anotable", connect, partitions=8)
    return raw.select(
        "guid", F.col("raw").isNull().alias("refused"),
        F.coalesce("annotate_error", F.lit("ok")).alias("outcome"),
    )


@query("m1_enrich", f"""SELECT guid, coalesce(antecedentes_cardiacos, false) AS cardiac, {_LEVEL} AS nivel_triaje,
  CAST(irradiacion AS INT) * 2 + CAST(coalesce(disnea, false) AS INT) + CAST(fiebre AS INT)
  + CAST(perdida_consciencia AS INT) + CAST(antecedentes_cardiacos AS INT) AS n_entities FROM interviews""")
def m1_enrich(t):
    """Texts to parsed findings, through the reply format, written once."""
    done = enrich_texts(t.planted.select("guid", "texto"))
    return done.where("error IS NULL").select(
        "guid", F.col("antecedentes_cardiacos").alias("cardiac"), "nivel_triaje",
        F.size("entidades").alias("n_entities"),
    )
