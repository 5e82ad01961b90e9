"""Top-k search against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from anamnesis.llm import topk


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score long, terms string")


def plain(rows, every, k):
    ok = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for q, a in ok:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(64, 16), (4096, 2048), (7, 3)])
def test_against_all_products(spark, sizes):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) * (1 if d < 6 else 0.1) for d in range(24)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(1000, None), (1001, [None] * 24), (1002, [float("nan")] * 24), (1003, [float("inf")] + [0.0] * 23), (1010, []), (1020, [0.5]), (None, [1.0] * 24)]
    got = topk.search(frame(spark, rows), F.col("vec_id") % 10 == 0, 5, shard=sizes[0], block=sizes[1])
    assert sorted(map(tuple, got.collect())) == plain(rows, 10, 5)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e6 + i, -1e6, 3.5e5 * i]) for i in range(12)]
    got = topk.search(frame(spark, rows), F.col("vec_id") % 5 == 0, 5)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 5)


def test_few_and_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    got = topk.search(frame(spark, rows), F.col("vec_id") == 0, 5)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 32768), (0, 2, 1, 32768), (0, 3, 2, -65536)]
    assert topk.search(frame(spark, []), F.col("vec_id") == 0, 5).count() == 0
    assert topk.search(frame(spark, rows), F.col("vec_id") == 99, 5).count() == 0
    assert topk.search(frame(spark, rows[:1]), F.col("vec_id") == 0, 5).count() == 0


def test_unlike_vectors_under_one_id_have_a_list_each(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), *((i, [0.1 * i, 1 - 0.1 * i]) for i in range(1, 10))]
    got = topk.search(frame(spark, rows), F.col("vec_id") == 50, 5).collect()
    want = []
    for query in ([1.0, 0.0], [0.0, 1.0]):
        want += plain([(50, query), *rows[3:]], 50, 5)
    assert sorted(map(tuple, got)) == sorted(want) and len(got) == 10


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 32)) * np.geomspace(100, 1, 32)
    vectors = vectors.astype(np.int64)
    ids = rng.permutation(3000)
    for q, chosen, scores in topk.max_score(vectors[:20], ids[:20], vectors, ids, 5, probe=4):
        full = vectors @ vectors[q]
        full[q] = -(1 << 60)
        want = np.lexsort((ids, -full))[:5]
        assert ids[chosen].tolist() == ids[want].tolist() and scores.tolist() == full[want].tolist()
