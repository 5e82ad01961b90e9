import pytest
from pyspark.sql import functions as F

from anamnesis.operators import evaluation as ev
from anamnesis.operators.ranking import class_positions, shuffle_key, stratified_folds, held_out_quotas, stratified_split

# A published confusion matrix of 270 cases.
MATRIX = [[2, 0, 0, 0, 0], [0, 9, 0, 0, 0], [0, 0, 198, 2, 0], [0, 0, 1, 43, 0], [0, 0, 0, 1, 14]]


@pytest.fixture
def predictions(spark):
    rows = [(a + 1, p + 1) for a, line in enumerate(MATRIX) for p, n in enumerate(line) for _ in range(n)]
    return spark.createDataFrame(rows, "nivel_triaje int, prediccion_modelo int")


def test_matrix_and_scores(predictions):
    matrix = ev.confusion_matrix(predictions)
    got = {(r["actual"], r["predicted"]): r["n"] for r in matrix.collect()}
    assert got == {(a + 1, p + 1): n for a, line in enumerate(MATRIX) for p, n in enumerate(line)}
    assert sum(got.values()) == predictions.count()
    scores = {r["clase"]: r for r in ev.class_scores(matrix).collect()}
    assert [round(scores[c]["precision"], 5) for c in range(1, 6)] == [1, 1, 0.99497, 0.93478, 1]
    assert [round(scores[c]["recall"], 5) for c in range(1, 6)] == [1, 1, 0.99, 0.97727, 0.93333]
    overall = ev.overall_scores(ev.class_scores(matrix)).first()
    assert round(overall["accuracy"], 5) == 0.98519 and overall["support"] == 270


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(1, 2)], "nivel_triaje int, prediccion_modelo int")
    rows = ev.class_scores(ev.confusion_matrix(df)).collect()
    assert len(rows) == 5 and all(r["f1"] == 0.0 for r in rows)


def test_fold_scores_skip_unseen_classes(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 2, 2), (1, 1, 2)], "fold int, nivel_triaje int, prediccion_modelo int")
    got = {r["fold"]: r["f1_macro"] for r in ev.fold_scores(df).collect()}
    assert got == {0: 1.0, 1: 0.0}
    summary = ev.cross_validation_summary(ev.fold_scores(df)).first()
    assert (summary["cv_f1_macro"], summary["cv_f1_std"]) == (0.5, 0.5)


def test_class_weights(spark):
    rows = [(c,) for c, n in zip(range(1, 6), [2, 9, 200, 44, 15]) for _ in range(n)]
    df = spark.createDataFrame(rows, "nivel_triaje int")
    got = {r["nivel_triaje"]: r for r in ev.class_weights(df).collect()}
    assert [round(got[c]["weight"], 5) for c in range(1, 6)] == [27.0, 6.0, 0.27, 1.22727, 3.6]
    assert sum(r["weight"] * r["n_c"] for r in got.values()) == pytest.approx(270)


def skewed(spark, sizes):
    rows = [(f"g{c}-{i}", c) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "guid string, y int")


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_positions_equal_a_global_sort(spark, digits):
    df = skewed(spark, {1: 1, 2: 3, 3: 120, 5: 17})
    placed = class_positions(df, "y", "guid", digits=digits).collect()
    keys = {r["guid"]: r["m"] for r in df.select("guid", shuffle_key(F.col("guid")).alias("m")).collect()}
    want = sorted(placed, key=lambda r: (r["y"], keys[r["guid"]], r["guid"]))
    assert [r["position"] for r in want] == list(range(141))
    assert all(r["n_rows"] == 141 for r in placed)
    assert {r["y"]: r["class_size"] for r in placed} == {1: 1, 2: 3, 3: 120, 5: 17}


def test_folds_are_disjoint_whole_and_even(spark):
    df = skewed(spark, {1: 2, 2: 9, 3: 200, 4: 44, 5: 15})
    folds = stratified_folds(df, "y", "guid")
    assert folds.count() == folds.select("guid").distinct().count() == 270
    assert {r["n"] for r in folds.groupBy("fold").agg(F.count("*").alias("n")).collect()} == {54}
    per_class = folds.where("y = 3").groupBy("fold").count().collect()
    assert max(r["count"] for r in per_class) - min(r["count"] for r in per_class) <= 1


def test_fewer_rows_than_folds(spark):
    folds = stratified_folds(skewed(spark, {1: 1, 2: 2}), "y", "guid")
    assert folds.count() == 3


def test_split_sizes(spark):
    df = skewed(spark, {1: 2, 2: 9, 3: 200, 4: 44, 5: 15})
    test = stratified_split(df, "y", "guid").where("is_test")
    counts = {r["y"]: r["count"] for r in test.groupBy("y").count().collect()}
    assert sum(counts.values()) == 54
    assert counts == {2: 2, 3: 40, 4: 9, 5: 3}


def test_quotas_add_up(spark):
    sizes = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "y int, class_size long")
    got = {r["y"]: r["quota"] for r in held_out_quotas(sizes, "y", 0.5).collect()}
    assert sum(got.values()) == 2 and got == {1: 1, 2: 1, 3: 0}


def test_under_triage_tests_differ(spark):
    rows = [(1, 3, 0.1), (3, 4, 0.9), (3, 4, 0.1), (2, 1, 0.9), (2, None, 0.9)]
    df = spark.createDataFrame(rows, "l int, p int, a double")
    level, predicted, anxiety = F.col("l"), F.col("p"), F.col("a")
    got = df.select(ev.is_critical_under_triage(level, predicted).alias("c"),
                    ev.is_audit_case(level, predicted, anxiety).alias("a"),
                    ev.is_shown_under_triage(level, predicted).alias("s")).collect()
    assert [tuple(r) for r in got][:4] == [(True, False, True), (False, True, True), (False, False, True), (False, False, False)]
    assert got[4]["c"] is None


def test_quality_report(spark):
    df = spark.createDataFrame([(9, 101.0, "x"), (None, 5.0, "M")], "nivel_triaje int, score_urgencia double, sexo string")
    got = {r["columna"]: (r["n_null"], r["n_violations"]) for r in ev.quality_report(df).collect()}
    assert got == {"nivel_triaje": (1, 1), "score_urgencia": (0, 1), "sexo": (0, 1)}


def test_null_labels_and_keys_are_kept(spark):
    rows = [(f"k{i}", i % 3 if i % 4 else None) for i in range(60)] + [(None, 1)]
    df = spark.createDataFrame(rows, "guid string, y int")
    placed = class_positions(df, "y", "guid").collect()
    assert sorted(r.position for r in placed) == list(range(61))
    assert sorted(r.class_position for r in placed if r.y is None) == list(range(15))
    for got in (stratified_folds(df, "y", "guid"), stratified_split(df, "y", "guid")):
        assert got.columns[0] == "y" and sorted(map(str, ((r.guid, r.y) for r in got.collect()))) == sorted(map(str, rows))
    assert stratified_split(df, "y", "guid").where("is_test and y is null").count() > 0
