"""Targets against the resharing they stand for; rounding by its invariants and its expectation."""

import random
import re
from collections import defaultdict

import pytest

from anamnesis.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), total=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = total * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return out | share
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return out


def rows_of(rng, n=600):
    sources = ["b", "a", "é", "zz", "Ω", "𝒳", "￮", None, "lone"]
    rows = [(i, "w " * rng.choice([1, 3, 10, 40, 200, rng.randrange(1, 900)]), rng.choice(sources[:3] + sources[:8])) for i in range(n)]
    return rows + [(9000, "x y z", "lone"), (9001, None, "a"), (9002, "", None), (9003, " \n", "empty"), (None, "p q", "a"), (9005, "t t", "b"), (9005, "t t", "b"), (9005, "t t", "b")]


def test_targets_and_taken_words(docs_of, rng):
    rows = rows_of(rng)
    got = mixing.mix(docs_of(rows)).collect()
    assert len(got) == len(rows)
    sizes, docs = defaultdict(int), {}
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
        docs[i] = s
    want = plain_targets(sizes)
    largest, taken = defaultdict(int), defaultdict(int)
    for r in got:
        s = docs[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, s
        assert taken[s] <= 2 * sizes[s]


def test_repeated_rows_share_their_copies(docs_of):
    """A hundred equal rows in a source of 30,000 words: whole rows first, then half of one document at most."""
    rows = [(1, "w " * 100, "a")] * 100 + [(10 + i, "v " * 100, "a") for i in range(200)] + [(1000 + i, "u " * 1000, s) for i, s in enumerate("bcdefgh")]
    rows += [(5, "odd text", "a"), (5, "text odd", "a"), (None, "x y z", "a"), (None, "x y z", "a")]
    for seed in range(3):
        got = mixing.mix(docs_of(rows), seed=seed).collect()
        want = plain_targets({"a": 30_010, **{s: 1000 for s in "bcdefgh"}})["a"]
        mine = [r for r in got if r.source_size == 30_010]
        assert abs(sum(r.taken for r in mine) - want) <= 50
        equal = [r.taken for r in mine if r.doc_id == 1]
        rate = want / 30_010
        assert len(equal) == 100 and abs(sum(equal) / 100 - 100 * rate) <= 1 and set(equal) <= {100, 200}
        out = mixing.mixed(docs_of(rows), seed=seed).collect()
        assert sum(len(r.text.split()) for r in out) == sum(r.taken for r in got)
        assert sum(r.doc_id == 1 for r in out) == sum(equal) // 100


def test_reserved_names_are_refused(docs_of):
    with pytest.raises(ValueError, match="_llm_"):
        mixing.mixed(docs_of([(1, "x")]).withColumn("_llm_row", mixing.F.lit(1)))


def test_a_very_long_text(docs_of):
    rows = [(1, "long " * 2_000_000, "a"), (2, "short one", "a"), (3, "b", "b")]
    got = mixing.mix(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.size) for r in got) == [(1, 2_000_000), (2, 2), (3, 1)]


def test_reruns_and_partitions_agree(docs_of, rng):
    docs = docs_of(rows_of(rng))
    key = lambda r: tuple(map(str, r))
    one = sorted(map(tuple, mixing.mix(docs.repartition(1)).collect()), key=key)
    many = sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=key)
    assert one == many


def test_expectation(spark):
    """Over seeds, each document gets its fraction; whatever the seed, words are kept."""
    shares = {"a": 0.2, "b": 0.32, "c": 0.44, "d": 0.56, "e": 0.7}
    sizes = [10 + i % 7 if i % 10 else 300 for i in range(60)]
    units = [(s, 1000 * n + i, float(size), share * size) for n, (s, share) in enumerate(shares.items()) for i, size in enumerate(sizes)]
    df = spark.createDataFrame(units, "source string, unit long, size double, mass double").cache()
    hits, big = defaultdict(int), defaultdict(int)
    for seed in range(25):
        rows = mixing.rounded(df, 60, seed * 100, block=16).collect()
        assert sorted(r.unit for r in rows) == [u[1] for u in units] and {r.extra for r in rows} <= {0, 1}
        words = defaultdict(float)
        for r in rows:
            size = sizes[r.unit % 1000]
            words[r.source] += size * r.extra
            (big if size == 300 else hits)[r.source] += r.extra
        for s, share in shares.items():
            assert abs(words[s] - share * sum(sizes)) <= 150
    for s, share in shares.items():
        assert hits[s] / (25 * 54) == pytest.approx(share, abs=0.07) and big[s] / (25 * 6) == pytest.approx(share, abs=0.13)


def test_rows_as_often_as_taken(docs_of, rng):
    docs = docs_of(rows_of(rng, 200))
    taken = sum(r.taken for r in mixing.mix(docs).collect())
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == taken


def test_many_sources(spark):
    rng = random.Random(8)
    sizes = {f"s{i:04d}": rng.choice([0, 1, 5, 100, 10_000]) for i in range(500)}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(5)
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    assert got == {s: pytest.approx(t) for s, t in want.items()}


def test_odd_tables(docs_of):
    assert mixing.mix(docs_of([])).count() == 0 and mixing.mixed(docs_of([])).count() == 0
    assert [tuple(r) for r in mixing.mix(docs_of([(1, None, None), (2, "", "a")])).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_no_python_on_the_way(docs_of):
    for df in (mixing.mix(docs_of([(1, "x")])), mixing.mixed(docs_of([(1, "x")]))):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
