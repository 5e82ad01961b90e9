import pytest
from pyspark.sql import functions as F

from anamnesis.functions import encoding as en
from anamnesis.operators import features as ft
from anamnesis.schemas import FLAGS


@pytest.mark.parametrize("value, code", [("CAR", 0), ("car ", 0), ("XYZ", 6), (None, 6), (" res", 5), ("UNK", 6)])
def test_specialty(one, value, code):
    assert one(en.encode_specialty(F.lit(value).cast("string"))) == code


@pytest.mark.parametrize("value, code", [("M", 1), ("F", 0), ("m", -1), (None, -1)])
def test_raw_sex(one, value, code):
    assert one(en.encode_sex(F.lit(value).cast("string"))) == code


@pytest.mark.parametrize("value, code", [(1, 1), (0, 0), (-1, -1), (7, -1), (None, -1)])
def test_encoded_sex(one, value, code):
    assert one(en.keep_sex_code(F.lit(value).cast("int"))) == code


@pytest.mark.parametrize("value, code", [(3.9, 3), (-3.9, -3), (float("nan"), -1), (None, -1), (0.0, 0)])
def test_optional_int(one, value, code):
    assert one(en.encode_optional_int(F.lit(value).cast("double"))) == code


@pytest.mark.parametrize("score, band", [(0.39, "calm"), (0.4, "moderate"), (0.7, "high"), (0.86, "panic"), (None, "none")])
def test_anxiety_band(one, score, band):
    assert one(en.anxiety_band(F.lit(score).cast("double"))) == band


@pytest.mark.parametrize("confidence, gap, value", [(0.96, 0, 9.6), (0.85, 1, 6.0), (0.80, 2, 3.0), (0.865, 0, 8.7),
                                                    (0.575, 0, 5.8), (0.3, 2, 0.0)])
def test_rating(one, confidence, gap, value):
    assert one(en.rating(F.lit(confidence), F.lit(1 + gap), F.lit(1))) == value


@pytest.mark.parametrize("level", [0, None])
def test_rating_without_a_level(one, level):
    assert one(en.rating(F.lit(0.9), F.lit(4), F.lit(level).cast("int"))) == 9.0


def test_levels(one):
    assert one(en.level_label(F.lit(3))) == "C3"
    assert one(en.level_label(F.lit(9))) == "9"
    assert one(en.level_attributes(F.lit(1)))["max_espera_min"] == 0
    assert one(en.level_attributes(F.lit(9)))["codigo"] == "C3"
    assert one(en.level_attributes(F.lit(None).cast("int")))["codigo"] == "C3"


RAW = ("guid string, especialidad string, edad int, sexo string, dolor_intensidad int, "
       + ", ".join(f"{name} boolean" for name in FLAGS) + ", score_urgencia double, score_ansiedad double, nivel_triaje int")


def test_training_rows(spark):
    rows = [("a", "car", None, "M", None, True, None, False, False, False, False, 10.0, None, 3),
            ("b", None, 40, None, 5, True, True, True, True, True, True, None, 0.5, 3),
            ("c", "MSK", 40, "f", 5, True, True, True, True, True, True, 1.0, 0.5, None)]
    got = ft.training_rows_from_raw(spark.createDataFrame(rows, RAW)).collect()
    assert [r["guid"] for r in got] == ["a"]
    row = got[0]
    assert (row["edad"], row["sexo"], row["dolor_intensidad"], row["disnea"], row["fiebre"]) == (-1, 1, -1, 1, 0)
    assert (row["score_ansiedad"], row["especialidad"]) == (0.0, 0)


def test_training_rows_without_optional_columns(spark):
    df = spark.createDataFrame([("a", "car", 1, "M", 1, *[True] * 6, 10.0, 0.1, 3)], RAW)
    row = ft.training_rows_from_raw(df.drop("especialidad", "score_ansiedad")).first()
    assert (row["especialidad"], row["score_ansiedad"]) == (6, 0.0)


def test_bar_and_display(one):
    assert one(en.urgency_bar(F.lit(140.0))) == 100.0
    assert one(en.display_number(F.lit(None).cast("double"))) == 0.0
