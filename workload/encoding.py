"""Feature encoding and display scalars: E1-E6, E8-E11, P8, P9, P13."""

from pyspark.sql import functions as F

from anamnesis.functions import encoding as en
from anamnesis.operators import features as ft
from anamnesis.operators.evaluation import is_shown_under_triage
from anamnesis.schemas import FEATURES, FLAGS

from .registry import query

SPECIALTY = """CASE trim(upper(especialidad)) WHEN 'CAR' THEN 0 WHEN 'DER' THEN 1 WHEN 'GAS' THEN 2 WHEN 'GEN' THEN 3
    WHEN 'MSK' THEN 4 WHEN 'RES' THEN 5 ELSE 6 END"""
SEX = "CASE sexo WHEN 'M' THEN 1 WHEN 'F' THEN 0 ELSE -1 END"
FLAG_SQL = ", ".join(f"CAST(coalesce({name}, false) AS INT) AS {name}" for name in FLAGS)
ENCODED = f"""SELECT guid, doc_id, {SPECIALTY} AS especialidad, coalesce(edad, -1) AS edad, {SEX} AS sexo,
  coalesce(dolor_intensidad, -1) AS dolor_intensidad, {FLAG_SQL}, score_urgencia,
  coalesce(score_ansiedad, 0.0) AS score_ansiedad, nivel_triaje FROM results"""
OUTPUT = ["guid", "especialidad", *FEATURES, "nivel_triaje"]


@query("e1_encode_specialty", f"SELECT guid, {SPECIALTY} AS code FROM results")
def e1_encode_specialty(t):
    return t.results.select("guid", en.encode_specialty(F.col("especialidad")).alias("code"))


@query("e2_encode_flags", f"SELECT guid, {FLAG_SQL} FROM results")
def e2_encode_flags(t):
    return t.results.select("guid", *[en.encode_flag(F.col(name)).alias(name) for name in FLAGS])


@query("e3_encode_sex", f"""SELECT guid, {SEX} AS raw_code,
  CASE WHEN doc_id % 4 IN (0, 1) THEN CAST(doc_id % 4 AS INT) ELSE -1 END AS kept_code FROM results""")
def e3_encode_sex(t):
    return t.results.select(
        "guid", en.encode_sex(F.col("sexo")).alias("raw_code"),
        en.keep_sex_code(F.when(F.col("doc_id") % 4 != 3, F.col("doc_id") % 4)).alias("kept_code"),
    )


@query("e4_encode_optional_int", """SELECT guid, coalesce(edad, -1) AS age, coalesce(dolor_intensidad, -1) AS pain,
  coalesce(CAST(trunc(score_urgencia) AS INT), -1) AS cut FROM results""")
def e4_encode_optional_int(t):
    return t.results.select(
        "guid", en.encode_optional_int(F.col("edad")).alias("age"),
        en.encode_optional_int(F.col("dolor_intensidad")).alias("pain"),
        en.encode_optional_int(F.coalesce("score_urgencia", F.lit(float("nan")))).alias("cut"),
    )


@query("e4_odd_values", """SELECT guid, CASE doc_id % 4 WHEN 3 THEN CAST(doc_id % 90 AS INT) ELSE -1 END AS whole,
  CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 0 END AS flag FROM transcripts""")
def e4_odd_values(t):
    """Words, and numbers that no int holds, are unknown; other words are no truth values."""
    kind, odd = F.col("doc_id") % 4, F.col("doc_id") % 3
    number = F.when(kind == 0, "99999999999").when(kind == 1, "many").when(kind == 2, "NaN").otherwise((F.col("doc_id") % 90).cast("string"))
    word = F.when(odd == 0, "si").when(odd == 1, "true")
    return t.transcripts.select("guid", en.encode_optional_int(number).alias("whole"), en.encode_flag(word).alias("flag"))


@query("e5_dataset_encoding", f"""WITH enc AS ({ENCODED})
SELECT {', '.join(n if n != 'score_urgencia' else 'coalesce(score_urgencia, -9.0) AS score_urgencia' for n in OUTPUT)} FROM enc""")
def e5_dataset_encoding(t):
    return ft.encode_raw(t.results).select(*OUTPUT).fillna(-9.0, ["score_urgencia"])


@query("e6_training_rows_raw", f"WITH enc AS ({ENCODED}) SELECT {', '.join(OUTPUT)} FROM enc WHERE score_urgencia IS NOT NULL")
def e6_training_rows_raw(t):
    return ft.training_rows_from_raw(t.results).select(*OUTPUT)


def half_encoded(t):
    """Encoded rows with gaps, as an edited dataset may have."""
    encoded = ft.encode_raw(t.results)
    gap = F.col("doc_id") % 5 == 0
    return encoded.withColumns({
        name: F.when(~gap, F.col(name)) for name in ("edad", "sexo", "fumador", "fiebre", "score_ansiedad", "especialidad")
    })


_GAPS = f"""enc AS ({ENCODED}), gaps AS (SELECT * REPLACE (
  CASE WHEN doc_id % 5 <> 0 THEN edad ELSE -1 END AS edad, CASE WHEN doc_id % 5 <> 0 THEN sexo ELSE -1 END AS sexo,
  CASE WHEN doc_id % 5 <> 0 THEN fumador ELSE 0 END AS fumador, CASE WHEN doc_id % 5 <> 0 THEN fiebre ELSE 0 END AS fiebre,
  CASE WHEN doc_id % 5 <> 0 THEN score_ansiedad ELSE 0.0 END AS score_ansiedad,
  CASE WHEN doc_id % 5 <> 0 THEN especialidad ELSE 6 END AS especialidad) FROM enc WHERE score_urgencia IS NOT NULL)"""


@query("e6_training_rows_encoded", f"WITH {_GAPS} SELECT {', '.join(OUTPUT)} FROM gaps")
def e6_training_rows_encoded(t):
    return ft.training_rows_from_encoded(half_encoded(t)).select(*OUTPUT)


_EVAL = [name for name in OUTPUT if name != "especialidad"]


@query("e8_evaluation_rows", f"WITH {_GAPS} SELECT {', '.join(_EVAL)} FROM gaps")
def e8_evaluation_rows(t):
    return ft.evaluation_rows(half_encoded(t)).select(*_EVAL)


@query("p8_labelled_rows", "SELECT guid, nivel_triaje, score_urgencia FROM results WHERE score_urgencia IS NOT NULL AND nivel_triaje IS NOT NULL")
def p8_labelled_rows(t):
    return ft.keep_labelled(t.results).select("guid", "nivel_triaje", "score_urgencia")


@query("p9_model_input", f"WITH enc AS ({ENCODED}) SELECT guid, {', '.join(FEATURES)} FROM enc WHERE score_urgencia IS NOT NULL")
def p9_model_input(t):
    return ft.model_input(ft.training_rows_from_raw(t.results))


@query("e9_display_numbers", """SELECT guid, coalesce(score_urgencia, 0.0) AS urgency, least(coalesce(score_urgencia, 0.0) * 1.5, 100.0) AS bar,
  coalesce(confianza, 0.0) AS confidence FROM predictions""")
def e9_display_numbers(t):
    return t.predictions.select(
        "guid", en.display_number(F.col("score_urgencia")).alias("urgency"),
        en.urgency_bar(F.col("score_urgencia") * 1.5).alias("bar"),
        en.display_number(F.col("confianza")).alias("confidence"),
    )


@query("e10_anxiety_band", """SELECT guid, CASE WHEN score_ansiedad IS NULL THEN 'none' WHEN score_ansiedad >= 0.86 THEN 'panic'
  WHEN score_ansiedad >= 0.7 THEN 'high' WHEN score_ansiedad >= 0.4 THEN 'moderate' ELSE 'calm' END AS band FROM results""")
def e10_anxiety_band(t):
    return t.results.select("guid", en.anxiety_band(F.col("score_ansiedad")).alias("band"))


@query("e11_level_attributes", """
WITH dim(level, codigo, nombre, color, bg, max_espera_min) AS (VALUES
  (1, 'C1', 'Inmediato', '#c62828', '#1a0a0a', 0), (2, 'C2', 'Muy Urgente', '#e65100', '#1a0e00', 10),
  (3, 'C3', 'Urgente', '#f9a825', '#1a1600', 60), (4, 'C4', 'Menos Urgente', '#2e7d32', '#0a1a0a', 120),
  (5, 'C5', 'No Urgente', '#1565c0', '#0a0f1a', 240))
SELECT guid, codigo, nombre, color, bg, max_espera_min FROM predictions p
JOIN dim ON dim.level = CASE WHEN prediccion_modelo BETWEEN 1 AND 5 THEN prediccion_modelo ELSE 3 END""")
def e11_level_attributes(t):
    return t.predictions.select("guid", en.level_attributes(F.col("prediccion_modelo")).alias("a")).select("guid", "a.*")


@query("p13_shown_flags", """SELECT guid, prediccion_modelo > nivel_triaje AS under, prediccion_modelo <> nivel_triaje AS differs
  FROM predictions WHERE prediccion_modelo IS NOT NULL""")
def p13_shown_flags(t):
    level, predicted = F.col("nivel_triaje"), F.col("prediccion_modelo")
    return t.predictions.where(predicted.isNotNull()).select(
        "guid", is_shown_under_triage(level, predicted).alias("under"), (predicted != level).alias("differs")
    )
