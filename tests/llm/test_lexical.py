"""Dual-tree search against scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np

from anamnesis.llm import lexical


def terms_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]


def plain(docs, items, k):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        want = Counter(terms_of(text))
        scored = []
        for i, c, n in counts:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, times in want.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id int, text string, score string, rank int"),
            spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id int, text string, terms string, place int"))


def some(rng, n, items):
    pool = [f"t{i}" for i in range(120)] + ["The", "the", "É", "é", "漢字", "x1"]
    out = []
    for i in range(n):
        topic = rng.sample(pool, 12)
        text = rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(topic if rng.random() < 0.8 else pool) for _ in range(rng.randrange(1, 60)))
        out.append((i, text + (" " + rng.choice(items)[1] if rng.random() < 0.1 and items else "")))
    return out


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_against_all_pairs(spark):
    rng = random.Random(8)
    items = some(rng, 30, [])
    items += [(100, None), (101, ""), (102, "!!"), (103, "unknown words alone"), (104, "the the THE"), (0, "t1 t2"), (5, "t3 t4 t5"), (5, "t3 t4 t5"), (None, "t6 t7")]
    docs = some(rng, 400, items[:30])
    docs += [(900, None), (901, ""), (None, items[0][1]), (None, "the"), (902, items[1][1]), (902, items[1][1]), (3, "t3"), (903, "z" * 5000 + " t9")]
    docs += [(1000 + i, "t1 t2 t3 copies") for i in range(40)]
    d, b = frames(spark, docs, items)
    same(lexical.search(d, b, 10).collect(), plain(docs, items, 10))
    same(lexical.search(d.repartition(7), b, 3, block_terms=60).collect(), plain(docs, items, 3))  # several blocks of items


def test_few_rows_and_empty_tables(spark):
    docs, items = [(1, "a b"), (2, "a")], [(7, "a"), (8, "zzz")]
    same(lexical.search(*frames(spark, docs, items), 10).collect(), plain(docs, items, 10))
    for no_docs, no_items in (([], items), (docs, []), ([], []), ([(1, None)], items), (docs, [(1, None)])):
        found = lexical.search(*frames(spark, no_docs, no_items))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_whole_texts(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 50)
    for _ in range(200):
        text = "".join(rng.choice("aB9 é,漢\n-_\x00\x7f") * rng.choice([1, 1, 30]) for _ in range(rng.randrange(200)))
        got = [t.decode() for p in lexical.pieces(text.encode()) for t in p]
        assert got == terms_of(text)
    monkeypatch.undo()
    long = "filler " * 400_000 + "needle " + "x" * 3_000_000 + " end"
    docs, items = [(1, long), (2, "needle"), (3, "other")], [(1, "Needle end")]
    same(lexical.search(*frames(spark, docs, items)).collect(), plain(docs, items, 10))


def test_search_passes_over_whole_batches():
    """Topics share no terms: an item's nodes meet few documents, and the result is that of all pairs."""
    rng = np.random.default_rng(3)
    topics, per = 16, 128
    ids = np.arange(topics * per)
    vectors = [(np.sort(rng.choice(20, 6, replace=False)) + 20 * (i % topics), rng.integers(1, 1000, 6)) for i in ids]
    terms, values = (np.concatenate([v[j] for v in vectors]).astype(np.int64) for j in (0, 1))
    offsets = np.arange(0, 6 * len(ids) + 1, 6)
    rows = [(np.sort(rng.choice(20, 5, replace=False)) + 20 * (i % topics), rng.integers(1, 4, 5)) for i in range(32)]
    block = lexical.Items(rows, np.ones(20 * topics, np.int64))
    best = lexical.Best(len(rows), 10)
    scored = block.search(ids, np.zeros(len(ids), bool), terms, values, offsets, best)
    assert scored < 0.3 * len(rows) * len(ids)
    dense = np.zeros((len(ids), 20 * topics), np.int64)
    dense[np.repeat(ids, 6), terms] = values
    for one, (t, times) in enumerate(rows):
        all_scores = dense[:, t] @ times
        want = sorted((-s, i) for s, i in zip(all_scores.tolist(), ids.tolist()) if s > 0)[:10]
        assert [(-s, i) for s, i in zip(best.scores[one].tolist(), best.ids[one].tolist())] == want


def test_tree_maxima_cover_their_rows():
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 9, 300)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    terms = np.concatenate([np.sort(rng.choice(40, s, replace=False)) for s in sizes]).astype(np.int64)
    values = rng.integers(0, 100, len(terms))
    tree = lexical.Tree(terms, values, offsets, rng.integers(0, 50, 40), 8)
    dense, sparse = tree.dense_maxima(40), tree.sparse_maxima()
    seen = []
    for node, pair in enumerate(tree.children):
        line = np.zeros(40, np.int64)
        line[sparse[node][0]] = sparse[node][1]
        assert (line == dense[node]).all()
        if pair is None:
            assert len(tree.members[node]) <= 8
            for m in tree.members[node].tolist():
                seen.append(m)
                assert (dense[node][terms[offsets[m]:offsets[m + 1]]] >= values[offsets[m]:offsets[m + 1]]).all()
        else:
            assert (dense[node] == np.maximum(*dense[list(pair)])).all()
    assert sorted(seen) == list(range(300))
