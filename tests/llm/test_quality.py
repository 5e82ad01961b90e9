"""Quality rules against a plain reading of every text, and host verdicts against a closed form."""

import random
import re
from collections import Counter

import pytest

from anamnesis.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    marked = {i + d for i, g in enumerate(grams) if g in often for d in range(3)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in quality.SYMBOLS), len(lines),
            len(lines) - len(set(lines)), len(marked))


def test_measures_against_plain_reading(docs_of):
    rng = random.Random(2)
    rows = []
    for i in range(80):
        pool = rng.choice(["a b c", "the of # to *x $1 in was ü 漢 𝒳", "one two three four five six seven eight nine"]).split()
        rows.append((i, "".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "\t ", " \r\n", "\x0b"]) for _ in range(rng.randrange(200)))))
    rows += [(200, None), (201, ""), (202, " \n \n"), (203, "x"), (204, "x y z"), (None, "x y z x y z"), (205, "    a\n a"),
             (206, "long text here " * 30_000), (7, "again"), (7, "again")]
    got = quality.measures(docs_of(rows)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == sorted(
        ((i, *plain(t)) for i, t in rows), key=key)


def prose(rng, n=80):
    return " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))


def test_hosts_that_are_mostly_doubtful_are_held_to_all_rules(docs_of):
    rng = random.Random(4)
    noisy = lambda: prose(rng) + " ####" * 20
    rows = [(i, prose(rng), "good") for i in range(40)] + [(50, noisy(), "good")]
    rows += [(100 + i, noisy(), "bad") for i in range(40)] + [(150, prose(rng), "bad"), (151, "short", "bad")]
    rows += [(200, noisy(), "tiny"), (201, prose(rng), None), (202, noisy(), None)]
    got = {r.doc_id: r for r in quality.judged(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(40)) and got[50].kept  # a doubtful text of a good host stays
    assert not any(got[100 + i].kept for i in range(40)) and got[150].kept and not got[151].kept
    assert got[151].base_failed and not got[100].base_failed
    assert got[150].host_rate > 0.9 > 0.5 > got[0].host_rate
    # One document says little of its host: its rate is shrunk.
    assert got[200].host_rate < 1
    left = quality.passing(docs_of(rows))
    assert left.columns == docs_of(rows).columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, r in got.items() if r.kept)


def test_repeated_rows_stay(docs_of):
    text = prose(random.Random(1))
    rows = [(1, text)] * 3 + [(1, None), (None, text)]
    assert quality.judged(docs_of(rows)).count() == 5
    assert quality.passing(docs_of(rows)).count() == 4


def test_prior(spark):
    hosts = lambda rows: spark.createDataFrame(rows, "n long, bad long")
    assert quality.beta_prior(hosts([])) == (1.0, 1.0)
    assert quality.beta_prior(hosts([(10, 0)])) == (0.0, 2.0)
    a, b = quality.beta_prior(hosts([(1000, 100)] * 30))
    assert a / (a + b) == pytest.approx(0.1) and a + b > 1e5  # no spread beyond chance
    rng = random.Random(9)
    drawn = [(400, sum(rng.random() < p for _ in range(400))) for p in (rng.betavariate(2, 6) for _ in range(1500))]
    a, b = quality.beta_prior(hosts(drawn))
    assert a == pytest.approx(2, rel=0.15) and b == pytest.approx(6, rel=0.15)


def test_empty_table(docs_of):
    assert quality.judged(docs_of([])).count() == 0 and quality.passing(docs_of([])).count() == 0


def test_no_python_on_the_way(docs_of):
    plan = quality.judged(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
