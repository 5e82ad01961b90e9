"""Trees grown in tasks: right splits, bounds kept, no tree on the driver."""

import random
import uuid
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from anamnesis.operators import models, trees
from anamnesis.schemas import FEATURES, TARGET
from anamnesis.session import scratch_path, small_table


def noise(spark, n, values=20, seed=5):
    rng = random.Random(seed)
    rows = [(f"g{i}", *(float(rng.randrange(values)) for _ in FEATURES), 1 + rng.randrange(5)) for i in range(n)]
    return spark.createDataFrame(rows, ["guid", *FEATURES, TARGET])


def impurity(label, weight):
    shares = np.array([weight[label == c].sum() for c in range(3)])
    return shares.sum() - (shares * shares).sum() / max(shares.sum(), 1e-300)


def best(codes, label, weight):
    """The greatest fall of impurity by any split, looked for one by one."""
    found = 0.0
    for code in codes:
        for cut in set(code[:-1]) | set(code):
            side = code <= cut
            if 0 < side.sum() < len(side):
                found = max(found, impurity(label, weight) - impurity(label[side], weight[side]) - impurity(label[~side], weight[~side]))
    return found


@pytest.mark.parametrize("seed", range(6))
def test_every_split_is_the_best_one(seed):
    draw = np.random.default_rng(seed)
    codes = draw.integers(0, 6, (3, 80)).astype("u1")
    label, count = draw.integers(0, 3, 80), draw.integers(1, 4, 80).astype("f8")
    weight = count * np.array([1.0, 0.25, 2.0])[label]
    tree = trees.Grown(trees.grow(codes, label, weight, count, [seed], trees.Shape(3, 3, 30, 1, 0.0)), 3)

    def look(node, rows):
        if tree.split[node] == trees.LEAF:
            shares = np.array([weight[rows][label[rows] == c].sum() for c in range(3)])
            assert np.allclose(tree.votes[tree.leaf[node]], shares / shares.sum(), atol=1e-11)
            return 1
        side = codes[tree.feature[node], rows] <= tree.split[node]
        part = [impurity(label[r], weight[r]) for r in (rows, rows[side], rows[~side])]
        assert part[0] - part[1] - part[2] == pytest.approx(best(codes[:, rows], label[rows], weight[rows]))
        return 1 + look(tree.left[node], rows[side]) + look(tree.left[node] + 1, rows[~side])

    assert look(0, np.arange(80)) == len(tree.split) > 5
    votes = np.zeros((80, 3))
    tree.add_votes(codes, votes)
    assert np.allclose(votes.sum(1), 1)


def test_depth_and_rows_of_a_leaf_are_bounds():
    draw = np.random.default_rng(1)
    codes, label = draw.integers(0, 100, (4, 500)).astype("u1"), draw.integers(0, 3, 500)
    one = np.ones(500)
    for depth, least in ((3, 1), (30, 20)):
        made = trees.grow(codes, label, one, one, [1], trees.Shape(3, 2, depth, least, 0.0))
        tree = trees.Grown(made, 3)
        assert made["nodes"] <= 2 ** (depth + 1) - 1
        at = np.zeros(500, int)
        for _ in range(depth):
            at = tree.left[at] + (codes[tree.feature[at], np.arange(500)] > tree.split[at])
        assert (tree.split[at] == trees.LEAF).all() and np.bincount(at)[np.unique(at)].min() >= least
    assert sum(made["importances"]) == pytest.approx(1)


def test_split_points_are_between_all_values_or_even_shares(spark):
    rows = noise(spark, 300).withColumn("edad", F.rand(1)).withColumn("sexo", F.when(F.col("sexo") < 10, F.lit(float("nan"))).otherwise(1.0))
    points = models.split_points(rows, 16)
    assert 12 <= len(points[0]) <= 16 and points[1] == []
    share = rows.where(F.col("edad") <= points[0][7]).count() / 300
    assert abs(share - 8 / 16) < 0.02
    assert models.split_points(rows, 128)[2] == [i + 0.5 for i in range(19)]


def jobs_of(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_follow_neither_depth_nor_nodes(spark):
    """Trees of noise are deep: a job a level, as before, would be many more."""
    rows = models.labelled(noise(spark, 600))
    model, jobs = jobs_of(spark, lambda: models.fit_forest(rows, trees=8))
    assert sum(nodes for *_, nodes in model.parts) > 1000 and jobs < 30
    _, few = jobs_of(spark, lambda: models.fit_forest(rows.limit(20), trees=8))
    assert jobs <= few + 2


def test_a_part_tells_of_its_trees_without_their_nodes(spark):
    model = models.fit_forest(models.labelled(noise(spark, 200)), trees=5, part_trees=2)
    told = [tree for name, _, _ in model.parts for tree in model.part(name).trees]
    assert len({tree.uid for tree in told}) == 5 and sum(tree.nodes for tree in told) == sum(nodes for *_, nodes in model.parts)
    assert all(sum(tree.importances) == pytest.approx(1) for tree in told)


def test_blocks_groups_and_streams_give_the_same_votes(spark, monkeypatch):
    rows = models.labelled(noise(spark, 400))
    model = models.fit_forest(rows, trees=6, part_trees=2)
    def look(df):
        return sorted((r["guid"], tuple(r["votes"])) for r in df.select("guid", "votes").collect())

    whole = look(model.votes(rows))
    monkeypatch.setattr(models, "VOTE_ROWS", 7)
    assert look(model.votes(rows, 1)) == look(model.votes(rows.repartition(5), 1)) == whole
    folder, out = scratch_path(spark, "arrived"), scratch_path(spark, "voted")
    rows.write.parquet(folder)
    stream = model.votes(spark.readStream.schema(rows.schema).parquet(folder))
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    assert look(spark.read.parquet(out)) == whole


def test_missing_values_go_right_and_empty_bags_do_not_vote(spark):
    rows = models.labelled(noise(spark, 60)).withColumn("edad", F.when(F.col(TARGET) > 2, F.lit(float("nan"))).otherwise(F.col(TARGET) * 1.0))
    model = models.fit_forest(rows, trees=30)
    asked = rows.withColumn("edad", F.when(~F.isnan("edad"), F.col("edad")))
    hits = models.predict(model, asked).where((F.col("prediccion_modelo") <= 2) == (F.col(TARGET) <= 2)).count()
    assert hits >= 57
    one = models.fit_forest(rows.limit(1), trees=20)
    [row] = one.votes(rows.limit(1)).collect()
    assert len(one.part("part=00000").trees) == 20 and 0 < sum(row["votes"]) < 20
    with pytest.raises(ValueError, match="no row"):
        models.fit_forest(rows.where("false"), trees=2)


def test_equal_rows_are_drawn_apart(spark):
    rows = spark.range(4000).select(F.xxhash64("id").alias("place"), F.lit(0.0).alias(models.LABEL), F.lit(1.0).alias(models.WEIGHT), F.lit(b"x").alias("codes"))
    drawn = models.bagged(rows, range(3), 1).where("count > 0").groupBy("tree").agg(F.sum("count").alias("n"), F.count("*").alias("rows")).collect()
    assert all(abs(r["n"] / 4000 - 1) < 0.06 and abs(r["rows"] / 4000 - 0.632) < 0.03 for r in drawn) and len(drawn) == 3
    # A table of one row many times still has bags of its size, not all or nothing.
    same = models.labelled(noise(spark, 1).crossJoin(spark.range(300)).drop("id").unionByName(noise(spark, 2, seed=9)))
    model = models.fit_forest(same, trees=4)
    assert all(tree.nodes >= 1 for tree in model.part("part=00000").trees)


def test_cells_without_a_sort_give_the_same_tree(monkeypatch):
    draw = np.random.default_rng(2)
    codes, label, count = draw.integers(0, 200, (4, 700)).astype("u1"), draw.integers(0, 3, 700), draw.integers(1, 4, 700).astype("f8")
    weight, shape = count * np.array([1.1, 0.3, 2.7])[label], trees.Shape(3, 2, 30, 1, 0.0)
    made = []
    for most in (0, 1 << 20):
        monkeypatch.setattr(trees, "MANY_CELLS", most)
        made.append(trees.grow(codes, label, weight, count, [9], shape))
    assert made[0] == made[1] and made[0]["nodes"] > 100


def test_a_small_table_takes_no_python_worker(spark):
    rows = [("b", 2, None), ("a", 1, 7)]
    table = small_table(spark, rows, models.PartedForest.TABLE)
    assert table.schema.simpleString() == "struct<name:string,trees:int,nodes:bigint>"
    assert [tuple(row) for row in table.collect()] == rows and table.rdd.getNumPartitions() == 1
    assert "Scan ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()


def test_folds_at_once_give_what_one_by_one_gives(spark, monkeypatch):
    rows, told, jobs = noise(spark, 60), [], []
    for at_once in (1, 3):
        monkeypatch.setattr(models, "FOLDS_AT_ONCE", at_once)
        made, n = jobs_of(spark, lambda: models.fold_predictions(rows, folds=3, trees=3))
        told.append(sorted(map(tuple, made.collect())))
        jobs.append(n)
    assert told[0] == told[1] and len(told[0]) == 60
    assert jobs[0] == jobs[1] > 30


def test_a_task_grows_several_small_trees(spark):
    rows = models.labelled(noise(spark, 50))
    model = models.fit_forest(rows, trees=8)
    files = model.table(model.parts[0][0]).inputFiles()
    assert 1 <= len(files) <= 2 and sum(trees for _, trees, _ in model.parts) == 8


def test_forest_and_folds_share_rows_that_are_written_once(spark, tmp_path, monkeypatch):
    """Both fits at once give what each gives alone, and neither works the training rows out again."""
    from workload import modeling, views

    calls, made = [], noise(spark, 80)
    monkeypatch.setattr(modeling, "_TRAINED", {})
    monkeypatch.setattr(modeling, "training_rows", lambda t: calls.append(t) or made)
    fit, folds_of = models.fit_forest, models.fold_predictions
    monkeypatch.setattr(models, "fit_forest", lambda train, *args: fit(train, 4))
    monkeypatch.setattr(models, "fold_predictions", lambda rows: folds_of(rows, folds=2, trees=4))
    tables = views.Tables(spark, str(tmp_path))
    parts, forest, folds, size = modeling.fitted(tables, lambda parts: parts.count())
    assert size == 80 and len(calls) == 1
    assert modeling.trained(tables) == (parts, forest) and modeling.cross_validated(tables) is folds and len(calls) == 1
    look = lambda df: sorted(map(tuple, df.collect()))
    alone = models.predict(fit(models.split(made).where(~F.col("is_test")), 4), parts).select("guid", "confianza")
    assert look(models.predict(forest, parts).select("guid", "confianza")) == look(alone)
    assert look(folds) == look(folds_of(made, folds=2, trees=4))


def look_at(model, rows, most=models.MOST_NODES):
    return sorted((r["guid"], tuple(r["votes"])) for r in model.votes(rows, most).select("guid", "votes").collect())


def test_a_forest_is_fitted_on_all_rows(spark):
    """Beyond 200,000 rows a share of them was taken."""
    n = 210_000
    rows = spark.range(n).select(F.col("id").cast("string").alias("guid"), *[(F.col("id") % 7 + place).cast("double").alias(name) for place, name in enumerate(FEATURES)],
                                 (F.col("id") % 7).cast("double").alias(models.LABEL), F.lit(1.0).alias(models.WEIGHT)).where("label < 5")
    rows = rows.unionByName(rows.withColumn("guid", F.concat("guid", F.lit("b")))).unionByName(rows.withColumn("guid", F.concat("guid", F.lit("c"))))
    n = rows.count()
    assert n == 450_000 and models.fit_rows(rows).count() == n
    model = models.fit_forest(rows, trees=2)
    bags = model.table(model.parts[0][0]).where("root = 1").select(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x).alias("n")).collect()
    assert len(bags) == 2 and all(abs(r["n"] / n - 1) < 0.01 for r in bags)
    few = rows.where("length(guid) = 2")
    assert few.count() > 9 and models.predict(model, few).where("prediccion_modelo = label + 1").count() == few.count()


@pytest.mark.parametrize("n, values, most", [(600, 20, 40), (500, 3, 30), (300, 20, 2)])
def test_a_tree_in_pieces_is_the_tree_in_one(spark, monkeypatch, n, values, most):
    """Nodes that look at all features have the same splits, whether a task holds their rows or many add them up."""
    whole_shape = models.shape_of
    monkeypatch.setattr(models, "shape_of", lambda stage: replace(whole_shape(stage), features_per_node=len(FEATURES), max_depth=9))
    rows = models.labelled(noise(spark, n, values)).withColumn(models.WEIGHT, F.lit(1.0))
    rows = rows.withColumn("edad", F.when(F.col("sexo") > 1, F.col("edad"))).withColumn(TARGET, F.when(F.col("fiebre") > 1, 2).otherwise(F.col(TARGET)))
    rows = rows.withColumn(models.LABEL, (F.col(TARGET) - 1).cast("double"))
    one = models.fit_forest(rows, trees=5, part_trees=2)
    monkeypatch.setattr(models, "PIECE_ROWS", most)
    monkeypatch.setattr(models, "OPEN_NODES", 7)
    pieces = models.fit_forest(rows.repartition(3), trees=5, part_trees=2, at_once=1)
    assert pieces.parts == one.parts and pieces.table(pieces.parts[0][0]).where("root > 1").count() >= 2
    assert look_at(one, rows) == look_at(pieces, rows) == look_at(pieces, rows, 1)
    for name, *_ in one.parts:
        for tree, other in zip(one.part(name).trees, pieces.part(name).trees, strict=True):
            assert (tree.uid, tree.nodes) == (other.uid, other.nodes) and tree.importances == pytest.approx(other.importances)
    folder = scratch_path(spark, "copy")
    pieces.save(folder)
    assert look_at(models.PartedForest.load(spark, folder), rows) == look_at(one, rows)


def test_pieces_follow_from_the_rows_alone(spark, monkeypatch):
    """Weights that are no binary fractions, summed up in another order."""
    monkeypatch.setattr(models, "PIECE_ROWS", 50)
    rows, seen = models.labelled(noise(spark, 400)), []
    for parts, block in ((1, 400), (5, 30)):
        monkeypatch.setattr(models, "BLOCK_ROWS", block)
        seen.append(look_at(models.fit_forest(rows.repartition(parts), trees=4), rows))
    assert seen[0] == seen[1]
    hits = models.predict(models.fit_forest(rows, trees=30), rows).where(f"prediccion_modelo = {TARGET}").count()
    assert hits > 380


def test_nodes_without_a_split_end_in_the_upper_part(spark, monkeypatch):
    monkeypatch.setattr(models, "PIECE_ROWS", 5)
    rows = models.labelled(noise(spark, 80, values=1))
    model = models.fit_forest(rows, trees=3)
    assert [trees for _, trees, _ in model.parts] == [3] and sum(nodes for *_, nodes in model.parts) == 3
    votes = look_at(model, rows)
    assert len({v for _, v in votes}) == 1 and sum(votes[0][1]) == pytest.approx(3)
    some = models.labelled(noise(spark, 80)).withColumn("label", F.lit(2.0))
    assert all(v == (0, 0, 2, 0, 0) for _, v in look_at(models.fit_forest(some, trees=2), some))


def test_split_points_over_several_ranges_are_those_of_one(spark):
    rows = noise(spark, 400).withColumn("edad", F.rand(3)).withColumn("sexo", F.floor(F.rand(4) * 150) / 7)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    told = [models.split_points(rows, 16)]
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        told.append(models.split_points(rows, 16))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    table, plain = rows.toPandas(), []
    for name in FEATURES:
        value, n = np.unique(table[name].to_numpy(), return_counts=True)
        share = np.concatenate([[0], n.cumsum() * 16 // n.sum()])
        ends = (share[1:] > share[:-1]) | (len(value) <= 16)
        plain.append(((value[:-1] + value[1:]) / 2)[ends[:-1]].tolist())
    assert told[0] == told[1] == plain


@pytest.mark.parametrize("seed", [1, 42, -7, 5_000_000_000])
def test_draws_in_a_task_are_those_of_bagged(spark, seed):
    rows = spark.range(900).select((F.xxhash64("id") - F.col("id")).alias("place"), F.lit(0.0).alias(models.LABEL), F.lit(1.0).alias(models.WEIGHT), F.lit(b"x").alias("codes"))
    told = {(r["tree"], r["place"], r["count"]) for r in models.bagged(rows, range(3, 70, 1), seed).where("count > 0").collect()}
    place = np.array([r["place"] for r in rows.collect()])
    draws = trees.Draws(place, seed)
    found = {(tree, int(place[row]), int(n)) for tree in range(3, 70) for row, n in zip(*draws.of(tree))}
    assert found == told and len(told) > 30_000 and max(n for *_, n in told) > 4
