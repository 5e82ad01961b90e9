"""Periodic runs of words, found on a Re-Pair grammar of each text."""

import hashlib
import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least this many words long, and at least this many times its period.
LEAST_WORDS, LEAST_TIMES = 24, 3
#: Every window of so many words inside a run stands again one period away: a run is
#: at least 24 words and three periods long, so 16 words at least lie a period before its end.
WINDOW = 8
#: Bytes that are cut into words at a time, words that are joined at a time, and
#: candidates whose extents are computed at a time: only memory depends on them.
PIECE_BYTES = 1 << 20
PIECE_WORDS = 1 << 16
CANDIDATES = 1 << 20
ODD = 0x9E3779B97F4A7C15


def word_ids(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers in order of appearance, and the words by number.

    A long text is cut in pieces at blanks, so that its words never stand in one list.
    """
    numbers: dict[bytes, int] = {}
    ids = array("i")
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        piece = text[at:end]
        while end < len(text) and not text[end:end + 1].isspace():
            more = text[end:end + PIECE_BYTES]
            rest = more.split(None, 1)[0] if more else b""
            piece += rest
            end += len(rest)
        ids.extend([numbers.setdefault(w, len(numbers)) for w in piece.split()])
        at = end
    return np.frombuffer(ids, np.int32).astype(np.int64) if ids else np.zeros(0, np.int64), list(numbers)


def planted(ids: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The words after the contract's repetition of one document in ten; a null doc_id has none."""
    n = len(ids)
    if doc_id is None or not n:
        return ids
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return ids
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return ids[places]


def repeated_stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the stretches of words that may hold a run.

    Windows of eight words that stand once in the text lie in no run. What is
    left between them is taken whole, with both ends of every run it holds. Equal
    hashes of unlike windows only make stretches longer.
    """
    m = len(ids) - WINDOW + 1
    least = LEAST_WORDS - WINDOW + 1
    if m < least:
        return []
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(ODD)
        mixed ^= mixed >> np.uint64(29)
        hashes = np.zeros(m, np.uint64)
        for j in range(WINDOW):
            hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[j:m + j]
            hashes ^= hashes >> np.uint64(31)
    order = np.argsort(hashes)
    hashes = hashes[order]
    equal = hashes[1:] == hashes[:-1]
    again = np.zeros(m + 2, np.int8)
    again[1 + order[1:][equal]] = 1
    again[1 + order[:-1][equal]] = 1
    edges = np.flatnonzero(np.diff(again))
    return [(int(s), int(e) + WINDOW - 1) for s, e in zip(edges[::2], edges[1::2]) if e - s >= least]


class Grammar:
    """Re-Pair: the most frequent pair of neighbours becomes a symbol, until no pair stands twice.

    ``words`` holds the stretches one after another, each followed by a number of
    its own below zero, which no pair includes. Of equally frequent pairs the one
    known longest comes first, which keeps the rules shallow. ``rules[k]`` is the
    pair that symbol ``first + k`` stands for, ``sizes`` its number of words, and
    ``top`` are the (place, symbol) left over.
    """

    def __init__(self, words: list[int]):
        n = len(words)
        symbol = list(words)
        after, back = list(range(1, n + 1)), list(range(-1, n))
        self.first = max(words, default=0) + 1
        self.rules: list[tuple[int, int]] = []
        self.sizes: list[int] = []
        self.begins: list[int] = []  # a place where the symbol's words stand
        places: dict[tuple[int, int], list[int]] = {}
        for i in range(n - 1):
            if symbol[i] >= 0 and symbol[i + 1] >= 0:
                places.setdefault((symbol[i], symbol[i + 1]), []).append(i)
        heap = [(-len(at), serial, pair) for serial, (pair, at) in enumerate(places.items()) if len(at) > 1]
        heapq.heapify(heap)
        serial = len(places)
        gone = -1
        symbol_of = symbol.__getitem__
        while heap:
            told, age, pair = heapq.heappop(heap)
            left, right = pair
            at = places.get(pair)
            if at is None:
                continue
            # Of overlapping occurrences the earlier one counts.
            live, last = [], -1
            for i in at:
                j = after[i]
                if i != last and symbol_of(i) == left and j < n and symbol_of(j) == right:
                    live.append(i)
                    last = j
            if len(live) < 2:
                del places[pair]
                continue
            if len(live) < -told:
                places[pair] = live if left != right else at
                heapq.heappush(heap, (-len(live), age, pair))
                continue
            del places[pair]
            new = self.first + len(self.rules)
            self.rules.append(pair)
            self.sizes.append(self.size(left) + self.size(right))
            self.begins.append(live[0])
            touched: dict[tuple[int, int], list[int]] = {}
            for i in live:
                j = after[i]
                symbol[i], symbol[j] = new, gone
                k = after[i] = after[j]
                if k <= n:
                    back[k] = i
                b = back[i]
                if b >= 0 and symbol[b] >= 0:
                    touched.setdefault((symbol[b], new), []).append(b)
                if k < n and symbol[k] >= 0:
                    touched.setdefault((new, symbol[k]), []).append(i)
            for found, more in touched.items():
                # A pair grows only while it is new: its parts include the new symbol.
                places[found] = more
                if len(more) > 1:
                    heapq.heappush(heap, (-len(more), serial, found))
                    serial += 1
        self.top = []
        i = 0
        while i < n:
            self.top.append((i, symbol[i]))
            i = after[i]

    def size(self, symbol: int) -> int:
        return self.sizes[symbol - self.first] if symbol >= self.first else 1

    def nodes(self, least: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(start, boundary, end) of one occurrence of every nonterminal of ``least`` words or more,
        and all the starts of its occurrences in the derivation.

        What is left of a stretch at the top is halved until single symbols are
        left; these nodes stand once.
        """
        triples, starts = [], []
        derived: dict[int, list[np.ndarray]] = {}
        stretch: list[tuple[int, int]] = []

        def halved() -> None:
            waiting = [(0, len(stretch))]
            while waiting:
                low, high = waiting.pop()
                begin = stretch[low][0]
                end = stretch[high - 1][0] + self.size(stretch[high - 1][1])
                if high - low > 1 and end - begin >= least:
                    middle = (low + high) // 2
                    triples.append((begin, stretch[middle][0], end))
                    starts.append(np.array([begin]))
                    waiting += [(low, middle), (middle, high)]

        for place, symbol in self.top:
            if symbol < 0:
                if stretch:
                    halved()
                stretch = []
                continue
            stretch.append((place, symbol))
            if self.size(symbol) >= least:
                derived.setdefault(symbol, []).append(np.array([place]))
        if stretch:
            halved()
        # A rule refers to older symbols only, so from the newest on every one has all its occurrences.
        for k in range(len(self.rules) - 1, -1, -1):
            found = derived.pop(self.first + k, None)
            if found is None:
                continue
            at = np.concatenate(found)
            left, right = self.rules[k]
            cut = self.size(left)
            triples.append((self.begins[k], self.begins[k] + cut, self.begins[k] + self.sizes[k]))
            starts.append(at)
            if cut >= least:
                derived.setdefault(left, []).append(at)
            if self.size(right) >= least:
                derived.setdefault(right, []).append(at + cut)
        return np.array(triples, np.int64).reshape(-1, 3), starts


class Extents:
    """How far equal words go on from two places: names of all blocks of 1, 2, 4 ... words."""

    def __init__(self, words: np.ndarray, longest: int):
        self.names = [words]
        size = 1
        while 2 * size <= longest:
            names = self.names[-1]
            pairs = names[:-size] * np.int64(int(names.max()) + 1) + names[size:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            size *= 2

    def forward(self, i: np.ndarray, j: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Words from i and from j on that are equal, j before ``end``; i < j."""
        i, j, length = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            names, step = self.names[level], 1 << level
            # Only blocks of the largest level may follow each other.
            for _ in range(1 if level < len(self.names) - 1 else 1 + int(((end - j).max(initial=0)) >> level)):
                fits = np.flatnonzero(j + step <= end)
                ok = fits[names[i[fits]] == names[j[fits]]]
                if not len(ok):
                    break
                i[ok] += step
                j[ok] += step
                length[ok] += step
        return length

    def backward(self, i: np.ndarray, j: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Words up to and with i and j that are equal, i not before ``begin``; i < j."""
        i, j, length = i + 1, j + 1, np.zeros(len(i), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            names, step = self.names[level], 1 << level
            for _ in range(1 if level < len(self.names) - 1 else 1 + int(((i - begin).max(initial=0)) >> level)):
                fits = np.flatnonzero(i - step >= begin)
                ok = fits[names[i[fits] - step] == names[j[fits] - step]]
                if not len(ok):
                    break
                i[ok] -= step
                j[ok] -= step
                length[ok] += step
        return length


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) for every value from low up to high of each pair."""
    many = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(low)), many)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]


def _crossing(words: np.ndarray, nodes: np.ndarray, extents: Extents) -> np.ndarray:
    """(node, start, end, period) of the periodic stretches across each node's boundary, within the node.

    One that crosses the boundary at b with period q has a period or more on one
    side of it. So the word before b stands again q later, or the word at b
    stood q before; the equal words go on to both sides from there.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")  # places by word
    key = words[order] * (n + 1) + order
    begin, cut, end = nodes.T
    reach = (end - begin) // LEAST_TIMES
    place = lambda word, at: np.searchsorted(key, words[word] * (n + 1) + at)
    found = []
    for right in (True, False):
        if right:
            low, high = place(cut - 1, cut), place(cut - 1, np.minimum(end, cut + reach))
        else:
            low, high = place(cut, np.maximum(begin, cut - reach)), place(cut, cut)
        upto = np.cumsum(np.maximum(high - low, 0))
        parts = np.searchsorted(upto, np.arange(0, int(upto[-1]) if len(upto) else 0, CANDIDATES), "right")
        bounds = np.unique([*parts.tolist(), len(nodes)])
        for first, last in zip(bounds[:-1], bounds[1:]):
            which, at = _spread(low[first:last], high[first:last])
            which = which + first
            at = order[at]
            q = at - (cut[which] - 1) if right else cut[which] - at
            b = cut[which]
            if right:
                before = extents.backward(b - 1, b - 1 + q, begin[which])
                ahead = extents.forward(b, b + q, end[which])
                start, stop = b - before, b + q + ahead
            else:
                before = extents.backward(b - q - 1, b - 1, begin[which])
                ahead = extents.forward(b - q, b, end[which])
                start, stop = b - q - before, b + ahead
            ok = stop - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * q)
            found.append(np.stack([which[ok], start[ok], stop[ok], q[ok]], 1))
    return np.concatenate(found) if found else np.zeros((0, 4), np.int64)


def merged(found: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs, by start, then period.

    Stretches of one period that share a period's worth of words are one. Of
    those with the same ends the smallest period is the run's; the others are
    its multiples.
    """
    found = np.unique(found[:, [2, 0, 1]], axis=0)  # period, start, end
    whole: dict[tuple[int, int], int] = {}
    q0 = s0 = e0 = 0
    for q, s, e in [*found.tolist(), (0, 0, 0)]:
        if q == q0 and s + q <= e0:
            e0 = max(e0, e)
            continue
        if q0:
            whole[s0, e0] = min(whole.get((s0, e0), q0), q0)
        q0, s0, e0 = q, s, e
    return sorted((s, e - s, q) for (s, e), q in whole.items())


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of a text's word numbers."""
    stretches = repeated_stretches(ids)
    if not stretches:
        return []
    parts, offsets, at = [], [], 0
    for k, (s, e) in enumerate(stretches):
        parts += [ids[s:e], np.array([-1 - k])]
        offsets.append((at, s))
        at += e - s + 1
    words = np.concatenate(parts)
    nodes, starts = Grammar(words.tolist()).nodes(LEAST_WORDS)
    if not len(nodes):
        return []
    # Dense numbers keep the names of pairs within 64 bits.
    words = np.unique(words, return_inverse=True)[1].astype(np.int64)
    found = _crossing(words, nodes, Extents(words, max(e - s for s, e in stretches)))
    if not len(found):
        return []
    many = np.array([len(s) for s in starts])
    which, place = _spread(np.zeros(len(found), np.int64), many[found[:, 0]])
    flat, first = np.concatenate(starts), np.cumsum(many) - many
    shift = flat[first[found[which, 0]] + place] - nodes[found[which, 0], 0]
    here = np.array([o for o, _ in offsets])
    there = np.array([s for _, s in offsets])
    begin = found[which, 1] + shift
    stretch = np.searchsorted(here, begin, "right") - 1
    begin = begin - here[stretch] + there[stretch]
    return merged(np.stack([begin, begin + found[which, 2] - found[which, 1], found[which, 3]], 1))


def best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length over period; of equal ones the first, then of smallest period."""
    top = None
    for run in runs:
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    return top


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: a run keeps its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def joined_sha256(ids: np.ndarray, words: list[bytes]) -> str:
    """Of the words joined by blanks, in pieces."""
    digest = hashlib.sha256()
    for at in range(0, len(ids), PIECE_WORDS):
        piece = b" ".join(map(words.__getitem__, ids[at:at + PIECE_WORDS].tolist()))
        digest.update(b" " + piece if at else piece)
    return digest.hexdigest()


SCHEMA = pa.schema([
    ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])


def described(text: bytes | None, doc_id: int | None, repeats: bool) -> dict:
    ids, words = word_ids(text or b"")
    if repeats:
        ids = planted(ids, doc_id)
    runs = runs_of(ids)
    top = best(runs)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = ids[kept_words(len(ids), runs)] if runs else ids
    return {
        "n_runs": len(runs), "start": top and top[0], "length": top and top[1], "period": top and top[2],
        "exponent_milli": top and 1000 * top[1] // top[2],
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(), "collapsed_sha256": joined_sha256(kept, words),
    }


def digests(docs: DataFrame, repeats: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_runs, the run of greatest exponent (start, length, period,
    exponent_milli), and the hashes of all runs and of the text without repetitions.

    Whole texts, each by itself and without a shuffle. ``repeats`` first repeats
    words in one document of ten as the contract of the query asks. Null and empty
    texts have no words, no runs and the hashes of nothing; a null doc_id is a
    document like others; repeated rows stay; extra columns are ignored; an empty
    table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [described(text.as_py(), i, repeats) for i, text in zip(ids, batch.column(1))]
            columns = [pa.array([r[f.name] for r in out], f.type) for f in SCHEMA]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *SCHEMA.names])

    return source.mapInArrow(rows, "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
                                   "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")


def runs(docs: DataFrame, repeats: bool = False) -> DataFrame:
    """(doc_id, start, length, period, kept_text) of every run: ``kept_text`` is its first period.

    A row per run, so a text without runs has none; otherwise as ``digests``.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("kept_text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, words = word_ids(text.as_py() or b"")
                ids = planted(ids, i) if repeats else ids
                found = [{"doc_id": i, "start": s, "length": n, "period": q, "kept_text": b" ".join(words[w] for w in ids[s:s + q]).decode()} for s, n, q in runs_of(ids)]
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    return source.mapInArrow(rows, "doc_id bigint, start bigint, length bigint, period bigint, kept_text string")


def collapsed(docs: DataFrame) -> DataFrame:
    """``docs`` with the repetitions of runs taken out: words that stay, joined by blanks, in texts
    that hold a run; other texts, and null ones, are as they were."""
    place = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(place).to_pylist():
                ids, words = word_ids((text or "").encode())
                found = runs_of(ids)
                out.append(b" ".join(words[w] for w in ids[kept_words(len(ids), found)]).decode() if found else text)
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.column(place).type))

    return docs.mapInArrow(rows, docs.schema)
