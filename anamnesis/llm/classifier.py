"""A quality classifier: ordinal regression of graded ratings on hashed text."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Hashed features; and the most rows that a model is fitted on.
SPACE = 1 << 20
MAX_FIT_ROWS = 20_000
#: A feature enters the model if this many fitted texts have it, and their mean
#: grade is this many standard errors away from the mean of all.
LEAST_TEXTS, LEAST_SCORE = 5, 4.0

SYMBOLS = b"#*$%&|<>@!?"
#: Digits, small letters and all beyond ASCII stay, capitals become small, the rest parts words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def features(text: bytes | None) -> set[int]:
    """Hashes of a text's different words, and of marks for its length, variety and symbols."""
    text = text or b""
    words = text.translate(_FOLD).split()
    different, n = set(words), max(len(words), 1)
    marks = [b"\0variety:%d" % (8 * len(different) // n), b"\0length:%d" % int(math.log2(n))]
    for symbol in SYMBOLS:
        if found := text.count(symbol):
            marks.append(b"\0rate:%d:%d" % (symbol, int(math.log2(1000 * found / n))))
    return {xxhash.xxh64_intdigest(x, 1) % SPACE for x in (*different, *marks)}


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic texts 0, poor ones 1, good ones 2.

    Of several labels of a doc_id the lowest counts; labels without a toxic mark
    and without a quality, and null doc_ids, are left out.
    """
    grade = F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1).cast("int")
    return labels.select("doc_id", grade.alias("grade")).where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


@dataclass(frozen=True)
class Model:
    """P(grade <= j) = logistic(thresholds[j] - sum of the weights of a text's features)."""
    weights: dict[int, float]
    thresholds: tuple[float, ...]

    def score(self, text: bytes | None) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(text))

    def above(self, score: float) -> list[float]:
        """P(grade > j) for each threshold."""
        return [1 / (1 + math.exp(min(max(t - score, -500.0), 500.0))) for t in self.thresholds]


def fit_ordinal(rows: list, grade: np.ndarray, n_grades: int, n_features: int, l2: float = 1e-4, steps: int = 120, rate: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps on the cumulative likelihood.

    ``rows`` are arrays of feature numbers. Weights are shared by all
    thresholds, which start at the grades' own shares and stay in order.
    """
    n = len(grade)
    sizes = np.array([len(r) for r in rows])
    index = np.concatenate(rows).astype(np.int64) if sizes.sum() else np.array([], np.int64)
    of = np.repeat(np.arange(n), sizes)
    shares = (np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] + 0.5) / (n + 1)
    thresholds = np.log(shares / (1 - shares)) + 1e-3 * np.arange(n_grades - 1)
    weights, seen_w, seen_t = np.zeros(n_features), np.full(n_features, 1e-8), np.full(n_grades - 1, 1e-8)
    every = np.arange(n)
    for _ in range(steps):
        score = np.bincount(of, weights[index], minlength=n)
        upto = 1 / (1 + np.exp(np.clip(score[:, None] - thresholds, -500, 500)))
        upto = np.hstack([np.zeros((n, 1)), upto, np.ones((n, 1))])  # P(grade < 0), P(grade <= j), 1
        low, high = upto[every, grade], upto[every, grade + 1]
        share = np.maximum(high - low, 1e-12)
        slope_low, slope_high = low * (1 - low) / share, high * (1 - high) / share
        to_weights = np.bincount(index, (slope_high - slope_low)[of], minlength=n_features) / n + l2 * weights
        to_thresholds = np.array([slope_low[grade == j + 1].sum() - slope_high[grade == j].sum() for j in range(n_grades - 1)]) / n
        seen_w += to_weights ** 2
        seen_t += to_thresholds ** 2
        weights -= rate * to_weights / np.sqrt(seen_w)
        thresholds = np.sort(thresholds - rate * to_thresholds / np.sqrt(seen_t))
    return weights, thresholds


def _sample(docs: DataFrame, graded: DataFrame, max_fit_rows: int) -> DataFrame:
    """(doc_id, grade, features) of the graded texts that come first in the order of a hash."""
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_fit_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int32()))], ["doc_id", "grade", "features"])

    return texts.select("doc_id", "grade", F.col("text").cast("binary")).mapInArrow(
        hashed, f"doc_id {kind}, grade int, features array<int>")


def fit(docs: DataFrame, graded: DataFrame, n_grades: int = 3, max_fit_rows: int = MAX_FIT_ROWS) -> Model:
    """A model from graded texts, at most ``max_fit_rows`` of them, whatever the tables' sizes.

    Hashing and the choice of features are jobs over the sample; only the chosen
    features of at most ``max_fit_rows`` texts reach the driver, which takes the
    gradient steps. The sample's order is by a hash of doc_id, so the same
    labels give the same model. Without graded texts all odds are even.
    """
    sample = materialize(_sample(docs, graded, max_fit_rows), "graded-texts")
    whole = sample.agg(F.count("*").alias("n"), F.avg("grade").alias("mean"), F.stddev_pop("grade").alias("spread")).first()
    if not whole["n"]:
        return Model({}, (0.0,) * (n_grades - 1))
    each = sample.select("doc_id", "grade", F.explode("features").alias("feature"))
    score = F.abs(F.avg("grade") - whole["mean"]) * F.sqrt(F.count("*"))
    chosen = each.groupBy("feature").agg(F.count("*").alias("n"), score.alias("score")).where(
        (F.col("n") >= LEAST_TEXTS) & (F.col("score") >= LEAST_SCORE * (whole["spread"] or math.inf))).select("feature")
    known = sorted(r["feature"] for r in chosen.collect())
    number = {f: i for i, f in enumerate(known)}
    kept = F.array_intersect("features", F.array(*map(F.lit, known)).cast("array<int>"))
    rows = sample.select("grade", kept.alias("features")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    weights, thresholds = fit_ordinal(
        [np.array([number[f] for f in r["features"]], np.int64) for r in rows], np.array([r["grade"] for r in rows]), n_grades, len(known))
    return Model(dict(zip(known, weights.tolist())), tuple(thresholds.tolist()))


def score(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Per row: doc_id, ``expected_grade``, ``tail_probability`` (of the highest grade) and ``kept``.

    Whole texts are scored; a null text has no words; repeated rows stay; other
    columns are ignored; an empty table gives no rows. The model's size is
    bounded by the hashed space.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            above = [known.above(known.score(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([sum(a) for a in above], pa.float64()),
                pa.array([a[-1] for a in above], pa.float64())], ["doc_id", "expected_grade", "tail_probability"])

    found = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        scored, f"doc_id {kind}, expected_grade double, tail_probability double")
    return found.withColumn("kept", selected(F.col("tail_probability"), least))


def selected(tail: Column, least: float) -> Column:
    return tail >= least


def classify(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS, least: float = 0.5) -> DataFrame:
    """Fits on the labelled rows of ``docs`` and scores every row."""
    return score(docs, fit(docs, grades(labels), 3, max_fit_rows), least)
