"""Runs on a grammar against all periods tried one by one."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from anamnesis.llm import runs


def plain_runs(words):
    """Every maximal stretch of every period, and of equal ends the smallest period."""
    n, whole = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(24, 3 * q):
                whole.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in whole.items())


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def some_words(rng):
    kind = rng.randrange(7)
    pool = [f"w{i}" for i in range(rng.choice([1, 2, 3, 5, 40]))]
    if kind == 0:
        return [rng.choice(pool) for _ in range(rng.randrange(120))]
    if kind == 1:  # the same passage far apart
        passage = [f"p{i}" for i in range(rng.randrange(8, 40))]
        return sum(([f"x{rng.random()}"] * rng.randrange(3) + passage for _ in range(rng.randrange(1, 6))), [])
    if kind == 2:  # strings without squares of a letter, and Fibonacci words
        a, b = ["a"], ["a", "b"]
        for _ in range(rng.randrange(4, 10)):
            a, b = b, b + a
        return b
    if kind == 3:
        return ["ab"[bin(i).count("1") % 2] for i in range(rng.randrange(200))]
    out = []
    while len(out) < 150:
        unit = [rng.choice(pool) for _ in range(rng.randrange(1, 12))]
        length = rng.randrange(1, 50)
        out += [unit[i % len(unit)] for i in range(length)]
        out += [f"u{rng.random()}"] * rng.randrange(3)
        if kind == 4:
            out += unit * 3 + ["z"] + unit * 3
        if kind == 5:
            out = (out + ["y"]) * rng.randrange(1, 5)
    return out[:400]


def test_runs_against_all_periods():
    rng = random.Random(11)
    for _ in range(1500):
        words = some_words(rng)
        ids, known = runs.word_ids(" ".join(words).encode())
        assert [known[i].decode() for i in ids] == words
        assert runs.runs_of(ids) == plain_runs(words), words


def test_grammar_derives_its_words():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.randrange(4) for _ in range(rng.randrange(2, 90))] + [-1] + [rng.randrange(3) for _ in range(rng.randrange(40))] + [-2]
        grammar = runs.Grammar(words)

        def out(s):
            return [s] if s < grammar.first else sum(map(out, grammar.rules[s - grammar.first]), [])

        assert sum((out(s) for _, s in grammar.top), []) == words
        pairs = [(a[1], b[1]) for a, b in zip(grammar.top, grammar.top[1:])]
        apart = [p for i, p in enumerate(pairs) if min(p) >= 0 and not (i and p[0] == p[1] and pairs[i - 1] == p)]
        assert len(apart) == len(set(apart))  # no pair stands twice
        for begin, size, rule in zip(grammar.begins, grammar.sizes, range(len(grammar.rules))):
            assert out(grammar.first + rule) == words[begin:begin + size]


def test_documents_against_plain(docs_of):
    rng = random.Random(4)
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:40] + [i for i in range(60) if zlib.crc32(str(i).encode()) % 10]
    rows = [(i, rng.choice([" ", "\n", "\t \x0b", "  "]).join(some_words(rng))) for i in ids]
    rows += [(i, " ".join(f"o{k}" for k in range(rng.randrange(1, 300)))) for i in ids[:40]]  # planted runs alone
    rows += [(None, "a b " * 20), (5, None), (6, ""), (7, " \n\x0b"), (ids[0], "one"), (9, "é ü " * 30), (9, "é ü " * 30), (10, "a\xa0b c " * 30), (11, "x" * 300_000)]
    rows += [(12, " ".join(f"t{k % 997}" for k in range(5000)))]
    got = [tuple(r) for r in runs.digests(docs_of(rows), repeats=True).collect()]
    assert sorted(got, key=str) == sorted((plain(i, t) for i, t in rows), key=str)
    assert runs.digests(docs_of([]), repeats=True).count() == 0


def test_long_texts_in_linear_time(spark):
    n = 400_000
    for words, want in ((["a"] * n, [(0, n, 1)]), ([f"w{i % 50_000}" for i in range(n)], [(0, n, 50_000)]),
                        ([f"w{i}" for i in range(n)], []), ([f"w{i % 7}" for i in range(n)] + ["x"] + [f"w{i % 9}" for i in range(n)], [(0, n, 7), (n + 1, n, 9)])):
        began = time.time()
        ids, _ = runs.word_ids(" ".join(words).encode())
        assert len(ids) == len(words)
        assert runs.runs_of(ids) == want
        assert time.time() - began < 60


def test_run_rows_and_collapsed_texts(docs_of):
    text = "start " + "one two three " * 10 + "end"
    rows = [(1, text), (2, "plain  text\nstays"), (3, None), (4, "")]
    assert [tuple(r) for r in runs.runs(docs_of(rows)).collect()] == [(1, 1, 30, 3, "one two three")]
    out = runs.collapsed(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "start one two three end", 2: "plain  text\nstays", 3: None, 4: ""}


@pytest.mark.parametrize("stretch", [23, 24, 25])
def test_shortest_runs(stretch):
    ids = np.array([i % 8 for i in range(stretch)] + [100])
    assert runs.runs_of(ids) == ([(0, stretch, 8)] if stretch >= 24 else [])
