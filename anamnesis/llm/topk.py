"""Exact top-k inner products by MaxScore over shards."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

SCALE = 256
#: Vectors of a shard and queries of a block: one task step holds one of each.
SHARD = 4096
QUERIES = 2048
#: Whole numbers up to here are exact in a double.
EXACT = 1 << 53


def terms(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, terms array<long>): floor(scale * x) of each component; vectors that are null, or
    hold a null or a value that is not finite, are left out."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("terms"))


def _matrix(rows: pd.Series) -> np.ndarray:
    """Rows of terms, shorter ones filled up with zeros."""
    width = max(map(len, rows), default=0)
    if all(len(r) == width for r in rows):
        return np.array(rows.tolist(), np.int64).reshape(len(rows), width)
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def max_score(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, probe: int = 8) -> Iterator[tuple]:
    """(query's place, places of its k best vectors, their scores), exact.

    A query's terms are ordered by the most that each can add within this shard.
    The lead vectors are scored whole and set a threshold; the terms that cannot
    reach it together are the non-essential ones. Essential postings are summed
    for all vectors; the others' are probed, ``probe`` terms at a time, only for
    the vectors that could still reach the threshold.
    """
    width = max(queries.shape[1], vectors.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * max(width, 1)
    kind = np.float64 if largest < EXACT else np.int64
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    top, low = vectors.max(0, initial=0), vectors.min(0, initial=0)
    bounds = np.maximum(queries * top, queries * low)  # never below zero
    order = np.argsort(bounds, axis=1, kind="stable")
    lead = np.lexsort((ids, -np.abs(vectors).sum(1)))[:min(len(ids), max(4 * k, 256))]
    led = queries @ vectors[lead].T
    for q in range(len(queries)):
        mine = ids[lead] != query_ids[q]
        known = np.sort(led[q][mine])
        threshold = known[-k] if len(known) >= k else None
        rest = np.cumsum(bounds[q][order[q]])  # of the terms from the least bound upwards
        # Terms whose bounds together stay below what is left above the essential ones cannot lift a vector alone.
        n_other = 0 if threshold is None else int(np.searchsorted(rest, max(threshold, 0), "left"))
        essential = order[q][n_other:]
        scores = vectors[:, essential] @ queries[q][essential]
        alive = np.flatnonzero(ids != query_ids[q])
        at = n_other
        while at and threshold is not None:
            alive = alive[scores[alive] + rest[at - 1] >= threshold]
            if not len(alive):
                break
            terms_ = order[q][max(0, at - probe):at]
            scores[alive] += vectors[np.ix_(alive, terms_)] @ queries[q][terms_]
            at -= len(terms_)
        chosen = alive[_best(scores[alive], ids[alive], k)]
        yield q, chosen, scores[chosen]


def search(vectors: DataFrame, queries: Column, k: int = 5, scale: int = SCALE, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): each query's k highest integer inner products.

    ``queries`` marks the query rows by a condition on vec_id. Vectors are dealt
    into shards and queries into blocks; every block meets every shard once, as
    one group of bounded size, and gives k rows a query. Shards are merged by
    rank. Rows of the query's own vec_id are no candidates; ties go to the
    smaller vec_id; repeated rows are candidates each. Equal query rows are answered
    once; unlike vectors under one vec_id are queries each, so that query_id has a
    list, ranked from 1, for every one of them. Shorter vectors are filled with zeros; null ids take no
    part; extra columns are ignored; no vectors give no rows.
    """
    found = materialize(terms(vectors, scale).where("vec_id is not null"), "terms")
    asked = materialize(found.where(queries).distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    n_shards = max(1, -(-found.count() // shard))
    n_blocks = max(1, -(-asked.count() // block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # A row's place salts its shard, so that a repeated id does not fill one.
    right = found.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_shards)).cast("int")).withColumn("block", every(n_blocks))
    left = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "terms"), F.lit(n_blocks)).cast("int")).withColumn("shard", every(n_shards))

    def meet(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if len(asked) and len(there):
            numbers, query_ids, ids = asked["query"].to_numpy(), asked["vec_id"].to_numpy(), there["vec_id"].to_numpy()
            for q, chosen, scores in max_score(_matrix(asked["terms"]), query_ids, _matrix(there["terms"]), ids, k):
                out["query"].append(np.full(len(chosen), numbers[q]))
                out["query_id"].append(np.full(len(chosen), query_ids[q]))
                out["vec_id"].append(ids[chosen])
                out["score"].append(scores.astype(np.int64))
        return pd.DataFrame({name: np.concatenate(parts) if parts else np.array([], np.int64) for name, parts in out.items()})

    keys = ["block", "shard"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def sql(k: int = 5, scale: int = SCALE, every: int = 50) -> str:
    return f"""
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS t
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.t AS DOUBLE[]), CAST(c.t AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
    """
