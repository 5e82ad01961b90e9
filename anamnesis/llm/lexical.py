"""Ranked lexical search by two trees: items on one side, documents on the other."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Small letters and capitals fold together, digits and all beyond ASCII stay, the rest parts terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
PIECE_BYTES = 1 << 20
#: Terms of the items that are searched together: one such block is held by the driver and each worker.
BLOCK_TERMS = 1 << 16
#: Rows of a leaf on either side.
DOC_LEAF, ITEM_LEAF = 64, 4
#: Rows that others are compared with when a tree puts like rows together.
MOST_PIVOTS = 64
#: Numbers that the maxima of a document tree hold at most, which sets how many documents share a
#: tree; and postings and documents it holds at most.
TREE_CELLS, TREE_POSTINGS, TREE_DOCS = 1 << 22, 1 << 21, 1 << 14


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number of bytes at a time."""
    at = 0
    while at < len(text):
        end = min(at + PIECE_BYTES, len(text))
        folded = text[at:end].translate(FOLD)
        if end < len(text):
            cut = folded.rfind(b" ") + 1
            while not cut and end < len(text):  # one term fills the piece
                end = min(end + PIECE_BYTES, len(text))
                folded = text[at:end].translate(FOLD)
                cut = folded.rfind(b" ") + 1 if end < len(text) else len(folded)
            folded, end = (folded[:cut], at + cut) if end < len(text) else (folded, end)
        yield folded.split()
        at = end


def counted(text: bytes | None, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of terms, vocabulary numbers in order, their occurrences) of a whole text."""
    n, found = 0, []
    for terms in pieces(text or b""):
        n += len(terms)
        found += [i for i in map(vocabulary.get, terms) if i is not None]
    ids, tf = np.unique(np.array(found, np.int32), return_counts=True)
    return n, ids, tf.astype(np.int32)


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): a row per document, with its occurrences of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of items
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [counted(text.as_py(), shared.value) for text in batch.column(1)]
            lists = lambda k: pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *(len(o[1]) for o in out)]), pa.int32()),
                pa.array(np.concatenate([o[k] for o in out]) if out else [], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.int64()), lists(1), lists(2)], ["doc_id", "n", "terms", "tf"])

    return source.mapInArrow(rows, "doc_id bigint, n bigint, terms array<int>, tf array<int>")


def _alike(terms: np.ndarray, owner: np.ndarray, rows: int, weights: np.ndarray, leaf: int) -> np.ndarray:
    """The rows in an order in which like ones stand together.

    Some rows, always the same, are pivots; a row joins the pivot whose direction is
    next to its own, and the pivots follow each other from like to like. Only speed
    depends on the choice.
    """
    pivots = np.sort(np.random.default_rng(0).choice(rows, min(MOST_PIVOTS, rows // leaf + 1, rows), replace=False))
    weight = weights[terms].astype(np.float64)
    norm = np.maximum(np.sqrt(np.bincount(owner, weight * weight, rows)), 1e-9)
    begins = np.searchsorted(owner, [pivots, pivots + 1])
    line = np.zeros(len(weights))
    near, pivot_of, chain = np.zeros(rows), np.zeros(rows, np.int64), []
    for number, (low, high) in enumerate(begins.T):
        line[terms[low:high]] = weight[low:high]
        likeness = np.bincount(owner, line[terms] * weight, rows) / norm / norm[pivots[number]]
        line[terms[low:high]] = 0
        closer = likeness > near
        near[closer], pivot_of[closer] = likeness[closer], number
        chain.append(likeness[pivots])
    place, left, at = np.zeros(len(pivots), np.int64), set(range(len(pivots))), 0
    for number in range(len(pivots)):
        left.discard(at)
        place[at] = number
        at = max(left, key=lambda x: (chain[at][x], -x), default=0)
    return np.lexsort((near, place[pivot_of])) if len(pivots) else np.arange(rows)


class Tree:
    """A hierarchy over sparse rows, with the maximum of every coordinate below each node.

    Rows are (terms, values) one after another, cut at ``offsets``. ``members`` of a
    leaf are row numbers; ``children`` of an inner node are nodes; node 0 holds all.
    """

    def __init__(self, terms: np.ndarray, values: np.ndarray, offsets: np.ndarray, weights: np.ndarray, leaf: int):
        self.terms, self.values, self.offsets = terms, values, offsets
        sizes = np.diff(offsets)
        order = _alike(terms, np.repeat(np.arange(len(sizes)), sizes), len(sizes), weights, leaf)
        self.children: list[tuple[int, int] | None] = [None]
        self.members: list[np.ndarray] = [order]
        self.below = [len(sizes)]  # rows below each node
        node = 0
        while node < len(self.members):
            members = self.members[node]
            if len(members) > leaf:
                self.children[node] = (len(self.children), len(self.children) + 1)
                # Whole leaves on the left, so that groups of like rows are cut seldom.
                half = -(-len(members) // leaf) // 2 * leaf
                for part in (members[:half], members[half:]):
                    self.children.append(None)
                    self.members.append(part)
                    self.below.append(len(part))
                self.members[node] = members[:0]
            node += 1

    def rows(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the members' entries, where each member's begin)."""
        sizes = self.offsets[members + 1] - self.offsets[members]
        begins = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) - np.repeat(begins, sizes) + np.repeat(self.offsets[members], sizes)
        return places, begins

    def dense_maxima(self, width: int) -> np.ndarray:
        """Nodes x coordinates."""
        top = np.zeros((len(self.children), width), np.int64)
        for node in range(len(self.children) - 1, -1, -1):  # children stand behind their parent
            if self.children[node]:
                left, right = self.children[node]
                np.maximum(top[left], top[right], out=top[node])
            else:
                places, _ = self.rows(self.members[node])
                np.maximum.at(top[node], self.terms[places], self.values[places])
        return top

    def sparse_maxima(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(coordinates, maxima) by node."""
        out: list = [None] * len(self.children)
        for node in range(len(self.children) - 1, -1, -1):
            if self.children[node]:
                terms, values = (np.concatenate(x) for x in zip(*(out[c] for c in self.children[node])))
            else:
                places, _ = self.rows(self.members[node])
                terms, values = self.terms[places], self.values[places]
            order = np.lexsort((-values, terms))
            terms, values = terms[order], values[order]
            first = np.diff(terms, prepend=-1) != 0
            out[node] = terms[first], values[first]
        return out


class Best:
    """Each item's best documents so far: (score, document), equal scores by id, nulls last."""

    def __init__(self, items: int, k: int):
        self.k = k
        empty = np.zeros(0, np.int64)
        self.scores, self.ids, self.unnamed = [empty] * items, [empty] * items, [empty.astype(bool)] * items
        self.kth = np.zeros(items, np.int64)  # a document below this score is none of the best

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        near = np.flatnonzero((scores > 0) & (scores >= self.kth[item]))
        if not len(near):
            return
        scores = np.concatenate([self.scores[item], scores[near]])
        ids = np.concatenate([self.ids[item], ids[near]])
        unnamed = np.concatenate([self.unnamed[item], unnamed[near]])
        order = np.lexsort((ids, unnamed, -scores))[:self.k]
        self.scores[item], self.ids[item], self.unnamed[item] = scores[order], ids[order], unnamed[order]
        if len(order) == self.k:
            self.kth[item] = scores[order[-1]]


class Items:
    """A block of items: term counts over a vocabulary of their own, in a tree."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray):
        self.rows, self.weights = rows, weights
        offsets = np.cumsum([0, *(len(t) for t, _ in rows)])
        flat = lambda k: np.concatenate([r[k] for r in rows]).astype(np.int64) if rows else np.zeros(0, np.int64)
        self.tree = Tree(flat(0), flat(1), offsets, weights, ITEM_LEAF)
        self.maxima = self.tree.sparse_maxima()
        self.items: list = [None] * len(self.maxima)  # the items below each node
        for node in range(len(self.items) - 1, -1, -1):
            pair = self.tree.children[node]
            self.items[node] = np.concatenate([self.items[c] for c in pair]) if pair else self.tree.members[node]

    def search(self, ids: np.ndarray, unnamed: np.ndarray, terms: np.ndarray, values: np.ndarray, offsets: np.ndarray, best: Best) -> int:
        """Meets the items with one tree of documents; returns how many item-document pairs were scored.

        A pair of nodes is passed over if the maxima of the two together stay below
        the weakest kth score of the items below it: no document there can enter an
        item's list. An equal bound goes on, as a smaller id wins a tie.
        """
        docs = Tree(terms, values, offsets, self.weights, DOC_LEAF)
        top = docs.dense_maxima(len(self.weights))
        bound = lambda node, among: top[among][:, self.maxima[node][0]] @ self.maxima[node][1]
        weakest = lambda node: best.kth[self.items[node]].min()
        line = np.zeros(len(self.weights), np.int64)
        scored = 0
        waiting = [(0, 0, int(bound(0, [0])[0]))]
        while waiting:
            item, doc, most = waiting.pop()
            if most <= 0 or most < weakest(item):
                continue
            parts, sides = docs.children[doc], self.tree.children[item]
            # The side that stands for more leaves is parted first.
            if parts is not None and (sides is None or docs.below[doc] * ITEM_LEAF >= self.tree.below[item] * DOC_LEAF):
                told = bound(item, list(parts))
                # The more promising side is met first: it stands last.
                waiting += [(item, parts[i], int(told[i])) for i in np.argsort(told, kind="stable")]
            elif sides is not None:
                pair = [(side, doc, int(bound(side, [doc])[0])) for side in sides]
                waiting += sorted(pair, key=lambda x: x[2])
            else:
                members = docs.members[doc]
                places, begins = docs.rows(members)
                some = np.diff(np.append(begins, len(places))) > 0
                members, begins = members[some], begins[some]
                if not len(members):
                    continue
                there, worth = terms[places], values[places]
                for one in self.tree.members[item]:
                    coordinates, times = self.rows[one]
                    if top[doc][coordinates] @ times < best.kth[one]:
                        continue
                    line[coordinates] = times
                    scores = np.add.reduceat(worth * line[there], begins)
                    line[coordinates] = 0
                    scored += len(members)
                    best.offer(one, scores, ids[members], unnamed[members])
        return scored


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _values(n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, weights: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    m = np.array([25 + 75 * int(x) * n_docs // total for x in n], np.int64)
    tf = tf.astype(np.int64)
    return weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes)))


def _found(table: DataFrame, block: Items, places: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(place, doc_id, score): k rows an item and task at most; lists go on from tree to tree of a task."""
    shared = table.sparkSession.sparkContext.broadcast((block, places))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, numbers = shared.value
        width = len(items.weights)
        best = Best(len(items.rows), k)
        most_docs = min(TREE_DOCS, max(DOC_LEAF, TREE_CELLS // max(width, 1) * DOC_LEAF // 2))
        held: list[tuple] = []

        def met() -> None:
            ids, unnamed, n, sizes, terms, tf = (np.concatenate(x) for x in zip(*held))
            values = _values(n, sizes, terms, tf, items.weights, n_docs, total)
            items.search(ids, unnamed, terms, values, np.concatenate([[0], np.cumsum(sizes)]), best)
            held.clear()

        docs = entries = 0
        for batch in batches:
            table_ids = batch.column(0)
            unnamed = table_ids.is_null().to_numpy(zero_copy_only=False)
            ids = table_ids.fill_null(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            terms = lists.flatten().to_numpy(zero_copy_only=False)
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            at = 0
            while at < len(ids):
                upto = min(at + most_docs - docs, len(ids))
                # Within the bound of postings, a document at least.
                room = np.searchsorted(ends, (ends[at - 1] if at else 0) + TREE_POSTINGS - entries, "right")
                upto = max(at + (docs == 0), min(upto, int(room)))
                low, high = (int(ends[x - 1]) if x else 0 for x in (at, upto))
                if upto > at:
                    held.append((ids[at:upto], unnamed[at:upto], n[at:upto], sizes[at:upto], terms[low:high], tf[low:high]))
                    docs, entries = docs + upto - at, entries + high - low
                if upto < len(ids) or docs >= most_docs:
                    met()
                    docs = entries = 0
                at = upto
        if held:
            met()
        for one, number in enumerate(numbers):
            if len(best.ids[one]):
                ids = pa.array(best.ids[one], pa.int64(), mask=best.unnamed[one])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number), pa.int64()), ids, pa.array(best.scores[one], pa.int64())], ["place", "doc_id", "score"])

    return table.mapInArrow(rows, "place bigint, doc_id bigint, score bigint")


def _item_terms(items: DataFrame) -> DataFrame:
    """(place, item_id, terms, times): the distinct terms of each item row, in order, with their repeats."""
    source = items.select(F.monotonically_increasing_id().alias("place"), "item_id", F.col("text").cast("binary").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, times = [], []
            for text in batch.column(2):
                found: dict[bytes, int] = {}
                for piece in pieces(text.as_py() or b""):
                    for term in piece:
                        found[term] = found.get(term, 0) + 1
                terms.append(sorted(found))
                times.append([found[t] for t in terms[-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))],
                ["place", "item_id", "terms", "times"])

    return source.mapInArrow(rows, f"place bigint, item_id {kind}, terms array<binary>, times array<int>")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank from 1, doc_id, score): the k documents of highest score above 0 for every item.

    Counts cover all documents. Items go by blocks of about ``block_terms`` terms,
    dealt by hash; only one block's terms, never documents, are with the driver and
    the workers. Each block passes over the documents: one job counts its terms in
    whole texts, one takes weights from the counts, one searches. A worker builds
    trees over its documents, bounded in size, and carries each item's best
    documents from tree to tree; the lists of all tasks are merged by rank.

    Each item row is answered by itself, equal ones too, so an item_id that stands
    twice has two lists. Null and empty texts have no terms: as items they have no
    rows, as documents they count for nothing. Equal scores go by doc_id, a null
    doc_id last; repeated documents are documents each; extra columns are ignored;
    an empty table on either side gives no rows.
    """
    asked = materialize(_item_terms(items), "items")
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-n_terms // block_terms))
    lists = []
    for number in range(n_blocks):
        mine = asked.where((F.pmod(F.xxhash64("place"), F.lit(n_blocks)) == number) & (F.size("terms") > 0))
        rows = mine.select("place", "terms", "times").collect()
        if not rows:
            continue
        vocabulary: dict[bytes, int] = {}
        vectors = [(np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r["terms"]], np.int64), np.array(r["times"], np.int64)) for r in rows]
        table = materialize(postings(docs, vocabulary), "postings")
        n_docs, total = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not total:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the block's vocabulary at most
            df[r["t"]] = r["count"]
        weights = np.array([term_weight(n_docs, int(x)) for x in df], np.int64)
        places = np.array([r["place"] for r in rows])
        lists.append(_found(table.where(F.size("terms") > 0), Items(vectors, weights), places, n_docs, total, k))
    if not lists:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    found = lists[0]
    for more in lists[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("place", "item_id"), "place").select("item_id", "rank", "doc_id", "score")


def sql(k: int = 10) -> str:
    terms = lambda text: f"regexp_extract_all(coalesce({text}, ''), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')"
    lower = lambda term: f"translate({term}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms('text')} AS terms FROM documents),
    s AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n, CAST(sum(len(terms)) AS BIGINT) AS total FROM d),
    p AS (SELECT r, {lower('term')} AS term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY 1, 2),
    q AS (SELECT i, {lower('term')} AS term, count(*) AS times
          FROM (SELECT i, unnest({terms('text')}) AS term FROM (SELECT row_number() OVER () AS i, text FROM benchmark)) GROUP BY 1, 2),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term),
    v AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(terms) * n) // total))) AS value
          FROM p JOIN w USING (term) JOIN d USING (r), s),
    x AS (SELECT i, r, CAST(sum(times * value) AS BIGINT) AS score FROM q JOIN v USING (term) GROUP BY i, r HAVING sum(times * value) > 0),
    y AS (SELECT i, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM x JOIN d USING (r))
    SELECT item_id, rank, doc_id, score FROM y JOIN (SELECT row_number() OVER () AS i, item_id FROM benchmark) USING (i) WHERE rank <= {k}
    """
