"""The pipeline against its stages' plain versions on a small table, and the registered queries."""

import hashlib
import sys
from pathlib import Path

import public_tokenizers
import tiktoken

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline
from anamnesis.llm import bpe, mixing, queries
from test_quality import plain as measured
from test_secrets import linked
from test_simhash import slow_groups, slow_print

SMALL = "/root/testdata/sf0.001"


def clean(text):
    out, past = [], 0
    for start, _, stop in sorted(linked(text), key=lambda s: (s[0], s[2])):
        if start > past or not out:
            out += [text[past:start], "[REDACTED]"]
        past = max(past, stop)
    return "".join(out) + text[past:]


def test_stages_against_plain_versions(spark, tmp_path):
    """No source of this table is mostly doubtful, so only base rules reject."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {}
    for i, r in rows.items():
        n, _, _, _, _, repeated = measured(r.text)
        if n >= 50 and 100 * repeated <= 50 * n:
            kept[i] = r
    prints = [(i, slow_print(r.text)) for i, r in kept.items()]
    stay = set(slow_groups(prints).values())

    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frames[-1], SMALL)
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        frames.append(spark.read.parquet(path))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert all(f.columns == docs.columns for f in frames[:5])
    assert ids(frames[1]) == sorted(kept)
    assert ids(frames[2]) == sorted(stay)
    assert {r.doc_id: r.text for r in frames[3].collect()} == {i: clean(rows[i].text) for i in stay}
    copies = {r.doc_id: r.copies + r.odd for r in mixing.plan(frames[3]).collect()}
    assert ids(frames[4]) == sorted(i for i, n in copies.items() for _ in range(n))
    vocabulary = bpe.Vocabulary(open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb").read(), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    for r in frames[5].collect():
        text = clean(rows[r.doc_id].text)
        tokens = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(tokens), hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, whole.collect())) == sorted(map(str, frames[5].collect()))


def test_odd_tables(spark, docs_of):
    prose = " ".join(f"word{i}" for i in range(80))
    for rows in ([], [(1, None)], [(1, prose, None), (1, prose, None), (None, prose + " x", "a"), (2, "", "a"), (3, prose + " token=abcdefghij", "b")]):
        docs = docs_of(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            docs.collect()


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
