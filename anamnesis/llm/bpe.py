"""Byte-level BPE by a segment tree of pair ranks, and decoding."""

import base64
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct pieces that each half of a Python worker's memory holds, some 150 bytes each. Only speed depends on it.
REMEMBERED = 150_000
REMEMBERED_BYTES = 64
#: Characters from which on a text's pieces are not listed at once.
LONG = 1 << 20
#: Ids that go into one Arrow batch before it is handed over (a single text may exceed it).
BATCH_IDS = 1 << 20


#: Children of a node of the segment tree.
FAN = 32


class _Known(dict):
    """Piece -> its ids as 32-bit numbers; a piece not yet known is encoded.

    When it is full, what it holds becomes the elder half, from which pieces that
    come again are taken over.
    """

    def __init__(self, merge):
        self.merge, self.elder = merge, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.elder.get(piece)
        if ids is None:
            data = piece.encode()
            ids = array("i", self.merge(data)).tobytes()
            if len(data) > REMEMBERED_BYTES:
                return ids
        if len(self) >= REMEMBERED:
            self.elder = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Vocabulary:
    """Token bytes by rank, and the pattern that cuts a text into pieces."""

    def __init__(self, ranks_file: bytes, pattern: str):
        pairs = (line.split() for line in ranks_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.cut = regex.compile(pattern)
        self.known = _Known(self.merge)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: always the leftmost pair of least rank is merged.

        A segment tree over the byte positions: its leaves hold, for the pair that
        starts at each live position, rank and position as one number, and every
        node above the least of the ``FAN`` below it, so that the least at the top
        is the next merge. A merge sets the leaves of the merged token and of its
        two neighbours, at most three, and renews the nodes above them, as many
        as the logarithm of the length to base ``FAN``.
        """
        rank_of, n = self.ranks.get, len(piece)
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        bits, absent = n.bit_length(), 1 << 40
        none, mask = absent << bits, (1 << bits) - 1
        leaves = [(rank_of(piece[i:i + 2], absent) << bits) + i for i in range(n - 1)]
        levels = [leaves]
        while len(levels[-1]) > FAN:
            below = levels[-1]
            levels.append([min(below[i:i + FAN]) for i in range(0, len(below), FAN)])
        top, above = levels[-1], list(zip(levels, levels[1:]))
        ends = list(range(1, n + 1))  # where the token that starts here ends
        starts = list(range(-1, n))  # where the token that ends here starts
        while (least := min(top)) < none:
            at = least & mask
            middle = ends[at]
            end = ends[at] = ends[middle]
            starts[end] = at
            if end < n:
                leaves[middle] = none
                leaves[at] = (rank_of(piece[at:ends[end]], absent) << bits) + at
            else:
                leaves[at] = none
                middle = at
            before = starts[at] if at else at
            if at:
                leaves[before] = (rank_of(piece[before:end], absent) << bits) + before
            for below, level in above:
                before, at, middle = before // FAN, at // FAN, middle // FAN
                for node in {before, at, middle}:
                    level[node] = min(below[node * FAN:node * FAN + FAN])
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at:ends[at]]])
            at = ends[at]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, as 32-bit numbers one after another."""
        if len(text) < LONG:
            pieces = self.cut.findall(text)
        else:
            pieces = (found.group() for found in self.cut.finditer(text))
        return b"".join(map(self.known.__getitem__, pieces))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """(number of ids, hash of the ids as text, hash of the bytes they stand for), a bounded number at a time."""
        listed, decoded = hashlib.sha256(), hashlib.sha256()
        numbers = memoryview(ids).cast("i")
        for at in range(0, len(numbers), BATCH_IDS):
            part = numbers[at:at + BATCH_IDS].tolist()
            listed.update(("," if at else "").encode() + ",".join(map(self.names.__getitem__, part)).encode())
            decoded.update(self.decode(part))
        return len(numbers), listed.hexdigest(), decoded.hexdigest()


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def _vocabulary(ranks_file: bytes, pattern: str) -> Vocabulary:
    """One per Python worker, with what it remembers."""
    key = (hashlib.sha256(ranks_file).hexdigest(), pattern)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(ranks_file, pattern)
    return _LOADED[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, pattern: str, keys: list[str] | None = None) -> DataFrame:
    """``keys`` (doc_id by default) and ``ids array<int>`` of each row's whole ``text``.

    ``path`` is a file of base64 tokens and ranks, read on the driver and sent to
    the workers: its size is the vocabulary's, not the data's. Each match of
    ``pattern`` is encoded by itself; special tokens are ordinary text. A null
    or empty text has no ids; repeated rows stay; other columns are ignored; an
    empty table gives no rows.
    """
    keys = keys or ["doc_id"]
    source = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    ranks_file = docs.sparkSession.sparkContext.broadcast(_read(path))
    schema = ", ".join(f"`{n}` {t}" for n, t in source.select(*keys).dtypes) + ", ids array<int>"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks_file.value, pattern)
        for batch in batches:
            texts, start, ids, offsets = batch.column(len(keys)), 0, [], [0]
            for row in range(batch.num_rows):
                ids.append(vocabulary.encode(texts[row].as_py()))
                offsets.append(offsets[-1] + len(ids[-1]) // 4)
                if offsets[-1] >= BATCH_IDS or row + 1 == batch.num_rows:
                    values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                    same = [c.slice(start, row + 1 - start) for c in batch.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*same, lists], [*keys, "ids"])
                    start, ids, offsets = row + 1, [], [0]

    return source.mapInArrow(encoded, schema)


def decode(encoded: DataFrame, path: str, pattern: str, keys: list[str] | None = None) -> DataFrame:
    """``keys``, ``ids`` and ``decoded binary``, the bytes the ids stand for; null ids stand for none.

    An id the vocabulary lacks is an error, as it is for other decoders.
    """
    keys = keys or ["doc_id"]
    source = encoded.select(*keys, "ids")
    ranks_file = encoded.sparkSession.sparkContext.broadcast(_read(path))
    schema = ", ".join(f"`{n}` {t}" for n, t in source.dtypes) + ", decoded binary"

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks_file.value, pattern)
        for batch in batches:
            # Offsets are 32 bits: hand over in parts.
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [vocabulary.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else []) for x in part.column(len(keys))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*keys, "ids", "decoded"])

    return source.mapInArrow(decoded, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, keys: list[str] | None = None) -> DataFrame:
    """Per row: ``keys``, ``n_tokens``, ``ids_sha256`` (of decimal ids joined by commas), ``decoded_sha256``.

    The bytes that are hashed last are those the ids decode to. One worker does
    both ways, so only hashes leave it; nulls, empty texts, repeated rows and
    extra columns are treated as by ``encode``.
    """
    keys = keys or ["doc_id"]
    source = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    ranks_file = docs.sparkSession.sparkContext.broadcast(_read(path))
    schema = ", ".join(f"`{n}` {t}" for n, t in source.select(*keys).dtypes) + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks_file.value, pattern)
        for batch in batches:
            rows = [vocabulary.digests(vocabulary.encode(text.as_py())) for text in batch.column(len(keys))]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*keys, "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(digested, schema)
