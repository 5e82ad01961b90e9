"""Class-weighted forest, and logistic baseline with pyspark.ml.

A forest is fitted on all rows. Each tree is a group of its bag's rows, grown in a task and written there;
a bag of more rows than a task takes is split from sums over all of its rows until its nodes are
such groups. Scoring reads the trees in tasks and adds their votes. So the driver holds no tree, but of a
large one the nodes above its groups.
"""

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.util import inheritable_thread_target

from ..schemas import FEATURES, FOLDS, LEVELS, SEED, TARGET, TREES
from ..session import materialize, scratch_path, shared_folder, small_table
from .evaluation import class_weights, fold_scores
from .ranking import stratified_folds, stratified_split
from .trees import DRAWS, Crowns, Draws, Grown, Shape, Upper, add_votes, best_cut, codes_of, grow, picks_of

LABEL = "label"
WEIGHT = "weight"
# Constants of a fit; none follows the number of rows or of cores. A group of PIECE_ROWS rows of a bag, at most,
# is grown in a task; OPEN_NODES larger nodes, at most, are summed up in one pass. Rows are written in blocks of
# BLOCK_ROWS, as each is drawn for many trees. PART_TREES trees are a part, FITS_AT_ONCE
# parts grow in one job, TASK_TREES trees in a task, one after the other, since a task of
# one small tree is mostly its start and its file; and FOLDS_AT_ONCE folds are worked on. None is part of the model,
# nor is how many parts a task holds at once to score, at most MOST_NODES nodes for VOTE_ROWS rows.
MAX_DEPTH = 30
MIN_ROWS_PER_LEAF = 1
PIECE_ROWS = 130_000
OPEN_NODES = 2_000
BLOCK_ROWS = 20_000
PART_TREES = 50
FITS_AT_ONCE = 2
TASK_TREES = 4
FOLDS_AT_ONCE = 3
MOST_NODES = 4_000_000
VOTE_ROWS = 100_000


def labelled(df: DataFrame) -> DataFrame:
    """Adds a 0-based label and the balanced weight of its class.

    Levels outside the scale are no classes. The weight table has at most one
    row per level, hence the hint.
    """
    valid = df.where(F.col(TARGET).isin(LEVELS))
    weights = class_weights(valid).select(TARGET, WEIGHT)
    return valid.join(F.broadcast(weights), TARGET).withColumn(
        LABEL, (F.col(TARGET) - 1).cast("double")
    )


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")


def forest(trees: int = TREES, seed: int = SEED, max_depth: int = MAX_DEPTH,
           min_rows_per_leaf: int = MIN_ROWS_PER_LEAF) -> RandomForestClassifier:
    """The parameters of a forest, by their names in pyspark.ml. Its own fit sends dense
    counts of all codes for every node of every partition through a shuffle and builds all nodes
    on the driver, so deep forests are grown by ``fit_forest``."""
    return RandomForestClassifier(
        featuresCol="features", labelCol=LABEL, weightCol=WEIGHT,
        numTrees=trees, maxDepth=max_depth, maxBins=128, featureSubsetStrategy="sqrt",
        minInstancesPerNode=min_rows_per_leaf, seed=seed,
    )


def shape_of(stage: RandomForestClassifier) -> Shape:
    return Shape(len(LEVELS), math.ceil(math.sqrt(len(FEATURES))), stage.getMaxDepth(), stage.getMinInstancesPerNode(), stage.getMinInfoGain())


def logistic(n_train: int) -> Pipeline:
    """Unscaled ridge with unit strength, expressed per training row."""
    return Pipeline(stages=[_assembler(), LogisticRegression(
        featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, maxIter=1000,
        family="multinomial", standardization=False, regParam=1.0 / max(n_train, 1),
        elasticNetParam=0.0,
    )])


@dataclass(frozen=True)
class Tree:
    """What is known of a tree besides its nodes."""

    uid: str
    nodes: int
    importances: tuple[float, ...]


@dataclass(frozen=True)
class Part:
    trees: tuple[Tree, ...]


@dataclass(frozen=True)
class PartedForest:
    """A forest in a folder: a table of trees by part, and one of the parts with their trees and nodes."""

    spark: SparkSession
    path: str
    parts: tuple[tuple[str, int, int], ...]

    TABLE = "name string, trees int, nodes bigint"
    TREE = ("tree int, root bigint, nodes bigint, importances array<double>, gained double, weights array<double>, "
            "points array<array<double>>, feature binary, split binary, left binary, exits binary, votes binary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PartedForest":
        rows = spark.read.schema(cls.TABLE).parquet(f"{path}/parts").collect()
        return cls(spark, path, tuple(sorted((r["name"], r["trees"], r["nodes"]) for r in rows)))

    @classmethod
    def write(cls, spark: SparkSession, path: str, parts: Iterable[tuple[str, int, int]]) -> "PartedForest":
        """Puts the parts of a folder on record, when all of them are there."""
        small_table(spark, sorted(parts), cls.TABLE).write.parquet(f"{path}/parts")
        return cls.load(spark, path)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.TREE).parquet(f"{self.path}/{name}")

    def part(self, name: str) -> Part:
        """Of a tree in pieces, the importances are those of all its nodes, as if it were in one."""
        pieces = {}
        for row in sorted(self.table(name).select("tree", "root", "nodes", "importances", "gained").collect()):
            pieces.setdefault(row["tree"], []).append(row)
        out = []
        for tree, rows in pieces.items():
            shares = rows[0]["importances"]
            if len(rows) > 1:
                gains = np.sum([np.array(r["importances"]) * r["gained"] for r in rows], axis=0)
                shares = (gains / (gains.sum() or 1.0)).tolist()
            out.append(Tree(f"{name}/tree={tree:05d}", sum(r["nodes"] for r in rows), tuple(shares)))
        return Part(tuple(out))

    def save(self, path: str) -> None:
        """A copy elsewhere, part by part."""
        for name, _, _ in self.parts:
            self.table(name).write.parquet(f"{path}/{name}")
        self.write(self.spark, path, self.parts)

    def groups(self, most_nodes: int = MOST_NODES) -> list[list[str]]:
        """Parts in order, as many together as hold ``most_nodes``, one at least."""
        out, held = [], 0
        for name, _, nodes in self.parts:
            if not out or held + nodes > most_nodes:
                out.append([])
                held = 0
            out[-1].append(name)
            held += nodes
        return out

    def shared(self) -> "PartedForest":
        """The forest where tasks can read it: below the shared folder."""
        folder = shared_folder(self.spark)
        if self.path.startswith(f"{folder}/"):
            return self
        path = scratch_path(self.spark, "forest")
        self.save(path)
        return PartedForest(self.spark, path, self.parts)

    def votes(self, rows: DataFrame, most_nodes: int = MOST_NODES) -> DataFrame:
        """Adds ``votes`` by class, exact sums over the trees, so that they do not follow
        the order of the trees nor ``most_nodes``.

        A task reads the trees from the folder. It holds a group of parts at a time; if there
        are several, each passes over blocks of ``VOTE_ROWS`` rows, of which features alone are held. Of a part with more
        than ``most_nodes`` it holds a tree, or a piece of one, at a time.
        """
        path, groups = self.shared().path, self.groups(most_nodes)
        large = {name for name, _, nodes in self.parts if nodes > most_nodes}

        @F.pandas_udf("array<double>")
        def voted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            held = {}
            for block in _blocks(batches):
                sizes = [len(batch[0]) for batch in block]
                columns = [np.concatenate([np.asarray(batch[i], "f8") for batch in block]) for i in range(len(FEATURES))]
                votes = np.zeros((sum(sizes), len(LEVELS)))
                for number, group in enumerate(groups):
                    if large.intersection(group):
                        held = {}
                        for name in group:
                            add_votes(_grown(path, name), columns, votes)
                        continue
                    if number not in held:
                        held = {number: [sorted(_grown(path, name), key=lambda grown: (grown[1].tree, grown[1].root)) for name in group]}
                    for pieces in held[number]:
                        add_votes(pieces, columns, votes)
                end = 0
                for size in sizes:
                    yield pd.Series(list(votes[end:end + size]))
                    end += size

        return rows.withColumn("votes", voted(*[F.col(name).cast("double") for name in FEATURES]))


def _blocks(batches: Iterator[tuple[pd.Series, ...]], most: int = VOTE_ROWS) -> Iterator[list]:
    block, size = [], 0
    for batch in batches:
        block.append(batch)
        size += len(batch[0])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def _grown(path: str, name: str) -> Iterator[tuple[list, Grown]]:
    """The trees of a part with their split points, read in a task one by one; pieces come behind the upper parts."""
    fs, folder = pafs.FileSystem.from_uri(f"{path}/{name}")
    points = []
    files = [file.path for file in fs.get_file_info(pafs.FileSelector(folder)) if file.base_name.endswith(".parquet")]
    for first in (True, False):
        for file in files:
            with fs.open_input_file(file) as source:
                table = pq.ParquetFile(source)
                wanted = [(root == 1) == first for root in table.read(["root"])["root"].to_pylist()]
                if any(wanted):
                    for want, batch in zip(wanted, table.iter_batches(batch_size=1)):
                        if want:
                            row = batch.to_pylist()[0]
                            if row["points"] != points:
                                points = row["points"]
                            yield points, Grown(row, len(LEVELS))


Model = PipelineModel | PartedForest


def predict(model: Model, rows: DataFrame, most_nodes: int = MOST_NODES) -> DataFrame:
    """Adds predicted level, class probabilities and confidence."""
    if isinstance(model, PartedForest):
        voted = model.votes(rows, most_nodes)
        total = F.aggregate("votes", F.lit(0.0), lambda a, x: a + x)
        return voted.withColumn("probabilidades", F.transform("votes", lambda v: v / total)).withColumns({
            "prediccion_modelo": F.array_position("votes", F.array_max("votes")).cast("int"),
            "confianza": F.array_max("probabilidades"),
        }).drop("votes")
    inner = [name for name in ("rawPrediction", "probability", "prediction", "features")]
    scored = model.transform(rows).withColumn("probabilidades", vector_to_array("probability"))
    return scored.withColumns({
        "prediccion_modelo": (F.col("prediction") + 1).cast("int"),
        "confianza": F.array_max("probabilidades"),
    }).drop(*inner)


def split(rows: DataFrame, key: str = "guid") -> DataFrame:
    return stratified_split(labelled(rows), TARGET, key)


def fit_rows(train: DataFrame, key: str = "guid", max_fit_rows: int | None = None) -> DataFrame:
    """The rows a forest is fitted on: all of them. A caller of its own may ask for ``max_fit_rows`` at most, alike for
    every level: beyond, the rows whose hash lies in that share of all hashes. No fit does."""
    total = train.count() if max_fit_rows is not None else 0
    if max_fit_rows is None or total <= max_fit_rows:
        return train
    place = F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    return train.where(place < max_fit_rows / total)


def split_points(rows: DataFrame, bins: int) -> list[list[float]]:
    """Where each feature may be split: between all of its values, or between ``bins``
    even shares of the rows if it has more. Values that are no numbers have no place.

    A feature may have as many values as there are rows, so they are ranked in ranges, and what lies
    before and behind a range is told by a row for each range and feature.
    """
    long = rows.select(F.posexplode(F.array(*[F.col(name).cast("double") for name in FEATURES])).alias("feature", "value"))
    counts = long.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value").agg(F.count("*").alias("n"))
    dealt = materialize(counts.repartitionByRange("feature", "value").withColumn("range", F.spark_partition_id()), "values")
    of_feature = Window.partitionBy("feature")
    ranges = dealt.groupBy("feature", "range").agg(F.sum("n").alias("n"), F.count("*").alias("values"), F.min("value").alias("first")).select(
        "feature", "range", F.lead("first").over(of_feature.orderBy("range")).alias("following"),
        (F.sum("n").over(of_feature.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
        F.sum("n").over(of_feature).alias("total"), F.sum("values").over(of_feature).alias("values"))
    ordered = Window.partitionBy("feature", "range").orderBy("value")
    seen = dealt.withColumns({
        "next": F.lead("value").over(ordered),
        "upto": F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
    }).join(F.broadcast(ranges), ["feature", "range"]).withColumns({
        "next": F.coalesce("next", "following"), "upto": F.col("upto") + F.col("before")})
    ends = (F.col("values") <= bins) | F.expr(f"upto * {bins} div total > (upto - n) * {bins} div total")
    middle = (F.col("value") + F.col("next")) / 2
    cuts = seen.where(F.col("next").isNotNull() & ends).select("feature", middle.alias("at")).where(~F.isnan("at")).collect()
    return [sorted({r["at"] for r in cuts if r["feature"] == number}) for number in range(len(FEATURES))]


def bagged(rows: DataFrame, trees: range, seed: int) -> DataFrame:
    """A row of each tree's bag with how often it was drawn, a Poisson number by a hash of the row's ``place``
    and the tree; and a row drawn no times for each tree, so that an empty bag is a group too."""
    each = rows.withColumn("tree", F.explode(F.sequence(F.lit(trees.start), F.lit(trees.stop - 1))))
    draw = F.pmod(F.xxhash64("place", "tree", F.lit(seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    drawn = each.withColumn("draw", draw).where(F.col("draw") >= DRAWS[0]).withColumn(
        "count", sum((F.col("draw") >= share).cast("int") for share in DRAWS)).drop("draw")
    blank = rows.sparkSession.range(trees.start, trees.stop, numPartitions=1).select(
        F.lit(0).cast("long").alias("place"), F.lit(0.0).alias(LABEL), F.lit(0.0).alias(WEIGHT), F.lit(b"").alias("codes"),
        F.col("id").cast("int").alias("tree"), F.lit(0).alias("count"))
    return drawn.unionByName(blank)


def _exact_weights(rows: DataFrame, weight: float) -> DataFrame:
    """Weights as multiples of a power of two so small that the greatest sum of a bag is exact, so that sums do not
    follow their order. ``weight`` is that of all rows; one just above a power of two is not taken for one just below."""
    unit = 2.0 ** (math.ceil(math.log2(16 * max(weight, 1e-300) * 1.01)) - 52)
    return rows.withColumn(WEIGHT, F.rint(F.col(WEIGHT) / unit) * unit)


def _bags(batches: Iterator[pa.RecordBatch], trees: list[int], seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Tree by tree the rows of its bag, how often they are drawn and their codes (features x rows), with the batch that holds them."""
    for batch in batches:
        if batch.num_rows:
            binary = batch.column("codes").cast(pa.binary())
            ends = np.frombuffer(binary.buffers()[1], "i4", len(binary) + 1, binary.offset * 4)
            codes = np.ascontiguousarray(np.frombuffer(binary.buffers()[2], "u1")[ends[0]:ends[-1]].reshape(-1, len(FEATURES)).T)
            draws = Draws(batch.column("place").to_numpy(), seed)
            for tree in trees:
                rows, count = draws.of(tree)
                yield tree, rows, count, codes[:, rows], batch


def upper_parts(rows: DataFrame, trees: range, seed: int, shape: Shape, points: list[list[float]], total: int) -> dict[int, Upper]:
    """The trees' nodes of more than ``PIECE_ROWS`` rows, split level by level from sums over all rows of their bags.

    A task adds up its rows by node, feature and code; the sums of all tasks meet node by node, in tasks,
    and the driver is told the splits. A bag has no more rows than there are, and the share drawn on average
    tells whether there are such nodes.
    """
    size = math.ceil(total * (1 - DRAWS[0]))
    uppers = {tree: Upper(size, PIECE_ROWS, shape) for tree in trees}
    widths, classes = [len(cuts) + 1 for cuts in points], shape.classes
    schema = pa.schema([("slot", pa.int32()), ("weights", pa.binary()), ("counts", pa.binary()), ("held", pa.binary())])
    while still := [(tree, at) for tree, upper in uppers.items() for at in upper.open()]:
        for first in range(0, len(still), OPEN_NODES):
            some = still[first:first + OPEN_NODES]
            picks = np.stack([picks_of([seed & 0xFFFFFFFF, tree, uppers[tree].number[at], 1], shape, len(FEATURES)) for tree, at in some])
            crowns, slots = Crowns({tree: uppers[tree] for tree, _ in some}), {node: slot for slot, node in enumerate(some)}

            def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums = crowns.sums(slots, picks, widths, classes)
                for tree, rows, count, codes, batch in _bags(batches, asked, seed):
                    label, weight = batch.column(LABEL).to_numpy(), batch.column(WEIGHT).to_numpy()
                    sums.add(tree, codes, label[rows].astype("i8"), weight[rows] * count, count)
                for told in sums.told():
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, told))], schema)

            def best(sums: pd.DataFrame) -> pd.DataFrame:
                slot = int(sums["slot"].iloc[0])
                weights, counts, held = (
                    reduce(np.add, (np.frombuffer(part, kind) for part in sums[name])) for name, kind in (("weights", "f8"), ("counts", "i8"), ("held", "i8")))
                return pd.DataFrame([{"slot": slot, **best_cut(weights.reshape(-1, classes), counts, held, picks[slot], widths, shape)}])

            asked = sorted({tree for tree, _ in some})
            cuts = rows.select("place", LABEL, WEIGHT, "codes").mapInArrow(
                summed, "slot int, weights binary, counts binary, held binary").groupBy("slot").applyInPandas(
                best, "slot int, feature int, code int, gain double, left array<double>, right array<double>, left_rows bigint, right_rows bigint")
            made = {row["slot"]: row.asDict() for row in cuts.collect()}
            for slot, (tree, at) in enumerate(some):
                uppers[tree].cut(at, made.get(slot))
    return uppers


def _at_ends(rows: DataFrame, uppers: dict[int, Upper], seed: int) -> DataFrame:
    """As ``bagged``, with the ``root`` of the piece that a row belongs to; without rows that have ended in an upper part."""
    crowns, ends = Crowns(uppers), np.concatenate([np.isin(np.arange(len(upper.number)), upper.ends()) for upper in uppers.values()])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, rows, count, codes, batch in _bags(batches, list(uppers), seed):
            at = crowns.at(tree, codes)
            kept = np.flatnonzero(ends[at])
            if len(kept):
                yield batch.take(pa.array(rows[kept])).append_column("tree", pa.array(np.full(len(kept), tree, "i4"))).append_column(
                    "count", pa.array(count[kept].astype("i4"))).append_column("root", pa.array(crowns.number[at[kept]]))

    some = rows.select("place", LABEL, WEIGHT, "codes")
    return some.mapInArrow(placed, ", ".join(f"{name} {kind}" for name, kind in some.dtypes) + ", tree int, count int, root bigint")


def fit_forest(train: DataFrame, trees: int = TREES, seed: int = SEED, key: str = "guid",
               part_trees: int = PART_TREES, at_once: int = FITS_AT_ONCE) -> PartedForest:
    """Grows the trees of ``at_once`` parts in a job, on all rows, and writes them to the shared folder.

    A tree whose bag has at most ``PIECE_ROWS`` rows is a group, as is each piece of a larger one. A task holds one group
    at a time, of a few bytes a row; it is put in order first, so that a tree follows from its rows alone.
    """
    spark = train.sparkSession
    path = scratch_path(spark, "forest")
    stage = forest(trees, seed)
    chosen = materialize(fit_rows(train, key).select(key, *FEATURES, LABEL, WEIGHT), "fit-rows")
    total, weight = chosen.agg(F.count("*"), F.sum(WEIGHT)).first()
    if not total:
        raise ValueError("no row to fit a forest on")
    points = split_points(chosen, stage.getMaxBins())
    shape = shape_of(stage)

    @F.pandas_udf("binary")
    def coded(*columns: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in np.ascontiguousarray(codes_of(columns, points).T)], dtype=object)

    def grown(bag: pd.DataFrame) -> pd.DataFrame:
        tree, root = int(bag["tree"].iloc[0]), int(bag["root"].iloc[0])
        bag = bag[bag["count"] > 0].sort_values("place")
        codes = np.ascontiguousarray(np.frombuffer(b"".join(bag["codes"]), "u1").reshape(len(bag), len(FEATURES)).T)
        count = bag["count"].to_numpy("f8")
        own = [seed & 0xFFFFFFFF, tree, *([root] if root > 1 else [])]
        made = grow(codes, bag[LABEL].to_numpy("i8"), bag[WEIGHT].to_numpy("f8") * count, count, own,
                    replace(shape, max_depth=shape.max_depth - root.bit_length() + 1))
        return pd.DataFrame([{"tree": tree, "root": root, "points": points, "exits": b"", **made}])[columns]

    columns = [name.split()[0] for name in PartedForest.TREE.split(", ")]
    coded_rows = chosen.select(F.xxhash64(key, *FEATURES, LABEL).alias("place"), LABEL, WEIGHT,
                               coded(*[F.col(name).cast("double") for name in FEATURES]).alias("codes"))
    # Equal rows are drawn apart.
    again = F.row_number().over(Window.partitionBy("place").orderBy(LABEL, WEIGHT, "codes"))
    rows = materialize(coded_rows.repartition(math.ceil(total / BLOCK_ROWS), "place").withColumn("place", F.xxhash64("place", again)), "fit-codes")
    large = total * (1 - DRAWS[0]) > PIECE_ROWS
    if large:
        rows = _exact_weights(rows, weight)
    # A piece of one node belongs to the upper part, so it is not put on record.
    part = F.when((F.col("root") > 1) & (F.col("nodes") == 1), "loose").otherwise(F.lpad(F.floor(F.col("tree") / part_trees).cast("string"), 5, "0"))
    written = spark.read.schema(f"{PartedForest.TREE}, part string")
    step = part_trees * at_once
    for first in range(0, trees, step):
        some = range(first, min(trees, first + step))
        groups = len(some)
        if large:
            uppers = upper_parts(rows, some, seed, shape, points, total)
            groups = sum(len(upper.ends()) for upper in uppers.values())
            bags = _at_ends(rows, uppers, seed)
        else:
            bags = bagged(rows, some, seed).withColumn("root", F.lit(1).cast("long"))
        made = bags.repartition(max(1, math.ceil(groups / TASK_TREES)), "tree", "root").groupBy("tree", "root").applyInPandas(grown, PartedForest.TREE)
        made.withColumn("part", part).write.mode("append").partitionBy("part").parquet(path)
        if large:
            loose = {tree: {} for tree in some}
            if groups:
                for row in written.parquet(path).where((F.col("part") == "loose") & F.col("tree").between(some.start, some.stop - 1)).select(
                        "tree", "root", "weights").collect():
                    loose[row["tree"]][row["root"]] = row["weights"]
            tops = [{"tree": tree, "root": 1, "points": points, **upper.finished(loose[tree], len(FEATURES))} for tree, upper in uppers.items()]
            table = small_table(spark, [tuple(top[name] for name in columns) for top in tops], PartedForest.TREE)
            table.withColumn("part", part).write.mode("append").partitionBy("part").parquet(path)
    grown_parts = written.parquet(path).where(F.col("part") != "loose").groupBy("part").agg(
        F.countDistinct("tree").alias("trees"), F.sum("nodes").alias("nodes")).collect()
    return PartedForest.write(spark, path, [(f"part={r['part']}", r["trees"], r["nodes"]) for r in grown_parts])


def fit_logistic(train: DataFrame) -> PipelineModel:
    """Weights are balanced anew on the training part."""
    rows = train.drop(WEIGHT, LABEL)
    return logistic(train.count()).fit(labelled(rows))


def fold_predictions(rows: DataFrame, key: str = "guid", folds: int = FOLDS,
                     trees: int = TREES, seed: int = SEED) -> DataFrame:
    """Out-of-fold predictions of all rows.

    Rows are placed once and written. Each fold's forest is grown, its fold
    predicted and written, ``FOLDS_AT_ONCE`` folds at a time, as the short jobs of
    one leave cores to another. Weights come from all rows, as for the final model.
    """
    placed = materialize(stratified_folds(labelled(rows), TARGET, key, folds, seed), "folds")

    def predicted(number: int) -> DataFrame:
        model = fit_forest(placed.where(F.col("fold") != number), trees, seed, key)
        part = predict(model, placed.where(F.col("fold") == number)).select(key, "fold", TARGET, "prediccion_modelo")
        return materialize(part, "fold-predictions")

    # Threads keep the caller's job group and properties, as in pyspark.ml's CrossValidator.
    inherits = inheritable_thread_target(placed.sparkSession)
    works = [inherits(partial(predicted, number)) for number in range(folds)]
    with ThreadPool(FOLDS_AT_ONCE) as pool:
        parts = pool.map(lambda work: work(), works, chunksize=1)
    return reduce(DataFrame.unionByName, parts)


def cross_validate(rows: DataFrame, key: str = "guid", trees: int = TREES) -> DataFrame:
    """Macro F1 per fold."""
    return fold_scores(fold_predictions(rows, key, trees=trees))


def feature_importances(spark: SparkSession, model: PartedForest) -> DataFrame:
    """One row: feature name -> importance, the mean over trees; parts are looked at one by one."""
    values = [0.0] * len(FEATURES)
    for name, _, _ in model.parts:
        for tree in model.part(name).trees:
            values = [a + b for a, b in zip(values, tree.importances)]
    total = sum(values) or 1.0
    return spark.range(1, numPartitions=1).select(
        importance_map(F.array(*[F.lit(name) for name in FEATURES]),
                       F.array(*[F.lit(value / total) for value in values])).alias("feature_importances")
    )


def importance_map(names: Column, values: Column) -> Column:
    return F.map_from_arrays(names, values)
