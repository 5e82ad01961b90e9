"""Line deduplication against a plain count of keys."""

import hashlib
import random
from collections import Counter

from anamnesis.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, least_documents, least_chars):
    cut = [(i, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, ls in cut for k in {key_of(x) for x in ls} if len(k) >= least_chars)
    out = []
    for i, ls in cut:
        kept = [x for x in ls if seen[key_of(x)] < least_documents]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def some_rows(rng, n):
    common = ["The Same Line", " the same line\t", "É accent", "é accent", "ß", "footer\r", "menu | home", "漢字 line", "x" * 3000]
    rows = []
    for i in range(n):
        parts = [rng.choice(common) if rng.random() < 0.6 else f"own line {rng.randrange(10_000)}" for _ in range(rng.randrange(1, 14))]
        rows.append((i, "\n".join(parts + [""] * rng.randrange(3))))
    return rows


def same(got, want):
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got), key=str) == sorted(want, key=str)


def test_against_plain_counts(docs_of):
    rng = random.Random(6)
    for least_documents, least_chars in ((10, 1), (2, 2), (1, 0)):
        rows = some_rows(rng, 60)
        rows += [(100, None), (101, ""), (102, "\n"), (103, " \n\t\n"), (None, "The same line\nalone"), (None, "The same line\nother"), (104, "footer\n" * 5), (105, "KKelvin")]
        rows += [(106, "FOOTER\nFOOTER\nmine")] * 3 + [(106, "another text\nfooter")]
        same(lines.kept_lines(docs_of(rows), least_documents, least_chars).collect(), plain(rows, least_documents, least_chars))


def test_repeated_rows_count_as_documents(docs_of):
    nine, ten = [(1, "again\nkept 1")] * 9, [(2, "often\noften")] * 10
    same(lines.kept_lines(docs_of(nine + ten)).collect(), [(1, 2, 0, "again\nkept 1")] * 9 + [(2, 2, 2, "")] * 10)
    within = [(i, "inside " * (i == 0) + "\n" + "\n".join(["twelve times"] * 12)) for i in range(9)]
    assert all(r.n_dropped == 0 for r in lines.kept_lines(docs_of(within)).collect())


def test_very_long_texts(docs_of):
    rows = [(i, "shared\n" * (i == 0) * 150_000 + "shared\n" + "\n".join(f"{'shared' if k % 2 else k}" for k in range(20_000 if i == 1 else 3)) + "y" * (i == 2) * 2_000_000) for i in range(10)]
    same(lines.kept_lines(docs_of(rows)).collect(), plain(rows, 10, 1))


def test_bitmaps_are_runs(docs_of):
    rows = [(i, f"a\nown{i}\nb\na\nb") for i in range(10)]
    got = lines.bitmaps(docs_of(rows)).collect()
    assert len(got) == 10 and all([tuple(z) for z in r.zeros] == [(0, 1), (2, 3)] and r.n_dropped == 4 for r in got)


def test_digests_and_empty_tables(docs_of):
    got = lines.digests(docs_of([(1, "a\nb"), (2, None)])).collect()
    assert {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == {
        (1, 2, 0, hashlib.sha256(b"a\nb").hexdigest()), (2, 1, 0, hashlib.sha256(b"").hexdigest())}
    assert lines.digests(docs_of([])).count() == 0 and lines.bitmaps(docs_of([])).count() == 0


def test_no_second_shuffle_between_ranges_and_first_occurrences(docs_of):
    plan = lines.occurrences(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan and "Python" not in plan and "Arrow" not in plan
