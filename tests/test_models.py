"""A fit depends on its rows alone: not on files, partitions, cores or their number."""

import random

import pytest

from anamnesis.operators import models
from anamnesis.operators.annotate import annotate
from anamnesis.schemas import FEATURES, TARGET


def table(spark, n):
    rng = random.Random(3)
    rows = [(f"g{i}", *(float(rng.randrange(20)) for _ in FEATURES), 1 + rng.randrange(5)) for i in range(n)]
    return spark.createDataFrame(rows, ["guid", *FEATURES, TARGET])


def test_same_rows_same_forest(spark):
    rows = models.labelled(table(spark, 200))
    seen = []
    for parts in (1, 4, 8):
        model = models.fit_forest(rows.repartition(parts), trees=8)
        found = models.predict(model, rows).select("guid", "prediccion_modelo", "confianza").collect()
        seen.append(sorted(map(tuple, found)))
    assert seen[0] == seen[1] == seen[2]


def test_same_prediction_however_parts_are_held(spark, tmp_path):
    """Parts grown one or three at a time, scored whole or one by one, saved and loaded."""
    rows = models.labelled(table(spark, 150))
    look = lambda model, most: sorted(map(tuple, models.predict(model, rows, most).select(
        "guid", "prediccion_modelo", "confianza", "probabilidades").collect()), key=str)
    one = models.fit_forest(rows, trees=10, part_trees=4, at_once=1)
    three = models.fit_forest(rows, trees=10, part_trees=4, at_once=3)
    assert one.parts == three.parts and [trees for _, trees, _ in one.parts] == [4, 4, 2]
    assert [len(g) for g in one.groups(1)] == [1, 1, 1] and len(one.groups()) == 1
    first = look(one, 1)
    assert first == look(one, models.MOST_NODES) == look(three, max(n for *_, n in three.parts))
    one.save(str(tmp_path / "copy"))
    loaded = models.PartedForest.load(spark, str(tmp_path / "copy"))
    assert loaded.parts == one.parts and look(loaded, models.MOST_NODES) == first
    total = sum(models.feature_importances(spark, loaded).first()[0].values())
    assert total == pytest.approx(1)
    # The votes are those of all trees.
    trees = [t for name, _, _ in one.parts for t in one.part(name).trees]
    assert len(trees) == 10 and {t.uid for t in trees} and all(abs(sum(p) - 1) < 1e-9 for *_, p in first)


def test_folds_are_predicted_by_forests_that_have_not_seen_them(spark):
    rows = table(spark, 120).withColumn("edad", models.F.col(TARGET) * 10.0)
    got = models.fold_predictions(rows, trees=6).collect()
    assert len(got) == 120 == len({r["guid"] for r in got}) and {r["fold"] for r in got} == set(range(5))
    hits = sum(r["prediccion_modelo"] == r[TARGET] for r in got)
    assert hits > 80


def test_no_parameter_follows_the_rows(spark):
    def told(n):
        stage = models.forest()
        return {p.name: stage.getOrDefault(p) for p in stage.params if stage.isDefined(p)} | {
            "partitions": models.fit_rows(table(spark, n)).rdd.getNumPartitions()}

    assert told(10) == told(5000)


def test_sample_is_bounded(spark):
    rows = table(spark, 4000)
    kept = models.fit_rows(rows, max_fit_rows=400)
    assert 300 < kept.count() < 500
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, models.fit_rows(rows.repartition(3), max_fit_rows=400).collect()))


def test_calls_are_spread_and_carry_the_whole_request(spark):
    def connect():
        def client(texts):
            return texts
        return client

    df = spark.createDataFrame([(f"g{i}", f"text {i}") for i in range(400)], "guid string, t string").coalesce(1)
    source = annotate(df, "t", connect)
    assert source.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    got = annotate(df.limit(1), "t", connect, template="Read: {transcripcion}", examples=[("a", "{}")], model="m").first()["raw"]
    assert '"model":"m"' in got and '"role":"assistant"' in got and "text 0" in got
    with pytest.raises(TypeError):
        annotate(df, "t")
