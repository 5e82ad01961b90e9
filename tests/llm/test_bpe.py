"""Encoding against a plain merge loop and the public library; decoding as an exact round trip."""

import array
import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from anamnesis.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "\n\n \t x", "The quick brown fox's 123 jumps!!  over", "Éauouon 漢字かな 🙂🙂 ‍", "<|endoftext|>",
    "a" * 3000, " " * 2500, "ab" * 1500 + "!?" * 800, "\x00\x1c\x85 x", "tokenisation unbelievably 0123456789abcdef" * 40, "long text of many words " * 60_000,
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(open(PATH, "rb").read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids_of(vocabulary, text):
    return array.array("i", vocabulary.encode(text)).tolist()


def plain(ranks, piece):
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_merges_like_the_plain_loop(vocabulary, rng):
    for n in [1, 2, 3, 5, 8, 9, 40, 200]:
        for alphabet in (b"ab", b"etaoin ", bytes(range(256))):
            piece = bytes(rng.choice(alphabet) for _ in range(n))
            assert vocabulary.merge(piece) == plain(vocabulary.ranks, piece)


def test_encodes_like_the_library(vocabulary, library, rng):
    for text in TEXTS[1:] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0xD7FF)])) for _ in range(2000))]:
        assert ids_of(vocabulary, text) == library.encode_ordinary(text)


def test_table(docs_of, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (1, "again"), (1, "again")]
    got = bpe.round_trip(docs_of(rows), PATH, public_tokenizers.PATTERN).collect()
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_empty_table(docs_of):
    assert bpe.round_trip(docs_of([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_small_vocabulary_and_long_run():
    tokens = [bytes([i]) for i in range(256)] + [b"aa", b"aaaa", b"ab"]
    file = b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens))
    v = bpe.Vocabulary(file, r"\S+|\s+")
    assert v.merge(b"aaaab") == plain(v.ranks, b"aaaab")
    assert v.decode(ids_of(v, "a" * 10_001 + "b")) == b"a" * 10_001 + b"b"
