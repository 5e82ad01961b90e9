import pytest
from pyspark.sql import functions as F

from anamnesis.operators import annotate as an
from anamnesis.plans.enrich import preprocess

CASES = {
    "chest pain that spreads": ("Me duele: tengo un dolor muy fuerte en el pecho y me cuesta respirar. Un ocho. Me llega hasta el brazo "
               "izquierdo. Tuve un infarto hace cuatro años. Tengo 71 años.", 2),
    "knee": ("Me duele la rodilla desde hace como una semana. Un tres, quizás más. No me he caído. Sin fiebre. Treinta y cuatro años.", 4),
    "fear without chest pain": ("¡Me muero! Me falta el aire, el corazón acelerado. No me duele el pecho. Mi madre tuvo un infarto. Tengo 28 años.", 3),
    "fainting": ("I passed out at work. I don't smoke. I'm 40, a man.", 1),
    "nothing much": ("I came for a form.", 5),
}


@pytest.fixture(scope="module")
def fields(spark):
    df = spark.createDataFrame([(name, text) for name, (text, _) in CASES.items()], "guid string, t string")
    return {row["guid"]: row for row in an.rule_fields(df, "t").collect()}


@pytest.mark.parametrize("name", CASES)
def test_level(fields, name):
    assert fields[name]["nivel_triaje"] == CASES[name][1]


def test_fields(fields):
    urgent, knee, fear, faint = (fields[name] for name in list(CASES)[:4])
    assert (urgent["edad"], urgent["dolor_intensidad"], urgent["irradiacion"], urgent["antecedentes_cardiacos"]) == (71, 8, True, True)
    assert (knee["edad"], knee["dolor_intensidad"], knee["fiebre"], knee["score_ansiedad"]) == (34, 3, False, 0.2)
    assert (fear["antecedentes_cardiacos"], fear["disnea"], fear["score_ansiedad"], fear["edad"]) == (False, True, 0.95, 28)
    assert (faint["fumador"], faint["sexo"], faint["edad"], faint["perdida_consciencia"]) == (False, "M", 40, True)
    assert urgent["entidades"][0].startswith("dolor") and urgent["entidades_normalizadas"][:2] == ["dolor torácico", "disnea"]
    assert len(fear["entidades"]) == len(fear["entidades_normalizadas"])


@pytest.mark.parametrize("lines, age, pain", [
    ("D: Buenos días. ¿Qué edad tiene?\nP: Setenta y uno.\nD: ¿Del uno al diez?\nP: Un ocho, doctor.", 71, 8),
    ("D: ¿Cuántos años tiene usted?\n\nP: Pues 34, recién cumplidos.\nD: ¿Y de 0 a 10, cuánto duele?\nP: Tres.", 34, 3),
    ("D: How old are you?\nP: 52\nD: From one to ten?\nP: maybe seven", 52, 7),
    ("D: ¿Qué edad tiene?\nP: No quiero decirlo.\nD: ¿De cero a diez?\nP: Mucho.", None, None),
    ("D: ¿Qué edad tiene su hijo?\nD: Perdone.\nP: Nueve.", None, None),
    ("D: ¿Qué edad tiene?\nP: Tengo 40 años, mi madre 71.", 40, None),
])
def test_answers_are_read_with_their_questions(spark, lines, age, pain):
    df = preprocess(spark.createDataFrame([("g", lines)], "guid string, texto string"))
    got = an.rule_fields(df, "texto_anotable", "texto_completo").first()
    assert (got["edad"], got["dolor_intensidad"]) == (age, pain)


def test_injected_client_errors_are_rows(spark):
    def flaky():
        def client(texts):
            if "bad" in texts:
                raise ValueError("refused")
            return [f"reply to {text}" for text in texts]
        return client

    def short():
        return lambda texts: [] if len(texts) > 1 else ["x"]

    df = spark.createDataFrame([("1", "good"), ("2", "bad"), ("3", "fine")], "guid string, t string").coalesce(1)
    rows = {r["guid"]: r for r in an.annotate(df, "t", flaky, 2).collect()}
    assert rows["1"]["raw"] == "reply to good" and rows["3"]["annotate_error"] is None
    assert rows["2"]["raw"] is None and rows["2"]["annotate_error"] == "ValueError: refused"
    assert an.annotate(df, "t", short).where("raw = 'x'").count() == 3


def test_rule_replies_have_every_field(spark):
    df = spark.createDataFrame([("1", "hola")], "guid string, t string")
    raw = an.rule_replies(df, "t").first()["raw"]
    import json

    from anamnesis.schemas import REPLY_FIELDS
    assert list(json.loads(raw)) == REPLY_FIELDS


def test_each_expression_stands_once_in_the_plan(spark):
    """Named twice, a regex or the lower-case text would be worked out twice a row."""
    df = preprocess(spark.createDataFrame([("g", "P: hola")], "guid string, texto string")).repartition(2)
    plan = an.rule_replies(df, "texto_anotable", "texto_completo")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 2
    for pattern in (an.lex.AGE_IN_YEARS, an.lex.AGE_TOLD, an.lex.NOT_AN_AGE, an.lex.PAIN_OF_TEN, an.lex.PAIN_WORDS, an.lex.AGE_ASKED, an.lex.DENIED):
        assert plan.count(pattern) == 1, pattern


def test_columns_of_the_same_name_are_replaced(spark):
    df = spark.createDataFrame([("g", "I am 40 years old.", 7, "x")], "guid string, t string, edad int, sexo string")
    rows = an.rule_fields(df, "t")
    assert rows.columns.count("edad") == 1 and rows.select("edad", "sexo").first() == (40, None)


@pytest.mark.parametrize("text, age, pain", [
    ("At my age 52 it hurts, 11 out of 10, maybe a six", 52, None), ("i'm 7, an eight.", 7, 8), ("I am 40% sure", None, None),
    ("desde hace 3 años. Treinta y cuatro años", 34, None), ("I have 999 years old things. Pain is 10", 999, 10)])
def test_numbers_told(spark, text, age, pain):
    got = an.rule_fields(spark.createDataFrame([("g", text)], "guid string, t string"), "t").first()
    assert (got["edad"], got["dolor_intensidad"]) == (age, pain)
