"""The ordinal fit against what it was drawn from, and accuracy on held-out labels."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from anamnesis.llm import classifier

DATA = "/root/testdata/sf0.1"


def test_fit_finds_the_drawn_weights():
    rng = np.random.default_rng(3)
    true, cuts = np.array([2.0, -1.5, 0.7, 0.0]), np.array([-1.0, 1.0])
    has = rng.random((20_000, 4)) < 0.4
    score = has @ true
    upto = 1 / (1 + np.exp(score[:, None] - cuts))
    grade = (rng.random((20_000, 1)) > upto).sum(1)
    weights, thresholds = classifier.fit_ordinal([np.flatnonzero(h) for h in has], grade, 3, 4, l2=0, steps=600)
    assert weights == pytest.approx(true, abs=0.1) and thresholds == pytest.approx(cuts, abs=0.1)


def test_probabilities_are_ordered():
    model = classifier.Model({1: 2.0}, (-1.0, 0.5, 0.5))
    above = model.above(0.3)
    assert above == sorted(above, reverse=True) and above[0] == pytest.approx(1 / (1 + math.exp(-1.3)))
    assert all(0 <= p <= 1 for s in (-1e9, 1e9) for p in model.above(s))


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    graded = classifier.grades(spark.read.parquet(f"{DATA}/labels.parquet"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4)) == 0
    model = classifier.fit(docs, graded.where(~held))
    found = classifier.score(docs.join(graded.where(held), "doc_id"), model).join(graded, "doc_id")
    rates = {r.grade: r for r in found.groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg("expected_grade").alias("mean")).collect()}
    assert rates[0].kept < 0.05 and rates[1].kept < 0.1 and rates[2].kept > 0.98
    assert rates[0].mean < rates[1].mean < rates[2].mean


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows(spark, docs_of):
    rng = random.Random(4)
    prose = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(60))
    rows = [(i, prose() + (" vile" if i % 3 == 0 else " junk ###" if i % 3 == 1 else " fine")) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "vile"), (202, "fine"), (5, "again"), (5, "again"), (203, "word " * 200_000)]
    labels = labels_of(spark, [(i, int(i % 3 == 2), int(i % 3 == 0)) for i in range(150)] + [(0, 1, 0), (None, 1, 0), (7, None, None), (8, None, 1), (999, 1, 0)])
    got = classifier.classify(docs_of(rows), labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].expected_grade < by[202].expected_grade and not by[None].kept and by[202].kept
    again = classifier.classify(docs_of(rows).repartition(5), labels).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_sample_is_bounded(spark, docs_of):
    labels = classifier.grades(labels_of(spark, [(i, 1, 0) for i in range(50)]))
    assert classifier._sample(docs_of([(i, "x") for i in range(50)] * 2), labels, 10).count() == 10


def test_no_labels_and_no_rows(spark, docs_of):
    none = labels_of(spark, [])
    assert [r.tail_probability for r in classifier.classify(docs_of([(1, "x")]), none).collect()] == [0.5]
    assert classifier.classify(docs_of([]), none).count() == 0
    one = labels_of(spark, [(1, 1, 0)])
    assert classifier.classify(docs_of([(1, "x"), (2, "y")]), one).count() == 2
