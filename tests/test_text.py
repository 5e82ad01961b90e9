import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from anamnesis.functions import text as tx

ALPHABET = st.sampled_from(list("ab DP:\n\t\r\u00a0\u2003\x1c\x85") + ["P: ", "\n\n\n"])


def brute_clean(text):
    """Character by character, with Python's own idea of white space."""
    out = []
    for char in text:
        if char != "\n" and char.isspace():
            if not out or out[-1] != " ":
                out.append(" ")
        else:
            out.append(char)
    kept, newlines = [], 0
    for char in out:
        newlines = newlines + 1 if char == "\n" else 0
        if newlines <= 2:
            kept.append(char)
    joined = "".join(kept)
    start, end = 0, len(joined)
    while start < end and joined[start].isspace():
        start += 1
    while end > start and joined[end - 1].isspace():
        end -= 1
    return joined[start:end]


def brute_patient(text):
    said = [line.strip() for line in text.splitlines()]
    return [line[2:].strip() for line in said if line[:2] == "P:"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=20, max_size=40))
def test_cleaning_and_turns_agree_with_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    clean = tx.clean_text(F.col("t"))
    rows = df.select("i", clean.alias("c"), tx.patient_turns(clean).alias("p"),
                     tx.patient_turns(F.col("t"), cleaned=False).alias("raw")).collect()
    for row in rows:
        want = brute_clean(texts[row["i"]])
        assert row["c"] == want
        assert row["p"] == brute_patient(want)
        assert row["raw"] == brute_patient(texts[row["i"]])


@pytest.mark.parametrize("raw, want", [
    ("D: x\nP: a \n cont\nP:b\nP; c", "a b"),
    ("p: low\n P : gap\nP:", ""),
    ("P:\nP: x", " x"),
])
def test_patient_text(one, raw, want):
    assert one(tx.patient_text(F.lit(raw))) == want


def test_cleaning_twice_changes_nothing(one):
    once = tx.clean_text(F.lit(" a\u00a0\t b \n\n\n\n c "))
    assert one(once) == one(tx.clean_text(once)) == "a b \n\n c"


@pytest.mark.parametrize("name, ingest, scoring", [
    ("CAR0123.txt", "CAR", "CAR"), ("1CAR.txt", "CAR", "UNK"), ("caso_suave_X.txt", "CAS", "UNK"),
    ("res01.txt", "RES", "RES"), ("r_es.txt", "RES", "UNK"),
])
def test_specialty_rules_differ(one, name, ingest, scoring):
    assert one(tx.specialty_at_ingest(F.lit(name))) == ingest
    assert one(tx.specialty_at_scoring(F.lit(name))) == scoring


def test_specialty_in_job(one):
    assert one(tx.specialty_in_job(F.lit(None).cast("string"), F.lit("x1z9.txt"))) == "X1Z"
    assert one(tx.specialty_in_job(F.lit("GAS"), F.lit("CAR1.txt"))) == "GAS"


def test_annotated_text_falls_back_to_the_whole(one):
    assert one(tx.text_to_annotate(F.lit(""), F.lit("all"))) == "all"
    assert one(tx.text_to_annotate(F.lit("p"), F.lit("all"))) == "p"


def test_messages(one):
    made = one(tx.chat_messages("Q {transcripcion}", [("s", "r")], F.lit("t")))
    assert [(m["role"], m["content"]) for m in made] == [("user", "Q s"), ("assistant", "r"), ("user", "Q t")]


def test_names(one):
    assert one(tx.demo_label(F.lit("caso_suave_X.txt"))) == "caso suave X"
    assert one(tx.version_stamp(F.lit("2024-02-03 04:05:06").cast("timestamp"))) == "20240203_040506"
    assert one(tx.join_segments(F.array(F.lit(" a "), F.lit("b\n")))) == "a b"
