"""One classification tree from its bag of rows, and the votes of grown trees: numpy inside tasks.

A feature enters as a code: how many of its split points lie below the value. A row
goes left where its code is at most the node's. A value that is no number lies above all.

A tree whose bag is too large for a task has an ``Upper`` part, whose splits follow from sums
over all of the bag's rows, and a piece, a tree of its own, below each of its ends.
"""

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

# A leaf lets every code pass on the left, to itself.
LEAF = 255
# A smaller gain, in weight, is rounding.
LEAST_GAIN = 1e-9
# So many cells of node and code are counted without a sort, however few the rows are.
MANY_CELLS = 4096
# Votes are multiples of this, so their sums are exact and follow no order.
VOTE = 2.0 ** -40


# Shares of draws from a Poisson distribution of mean one that are at most 0, 1, 2, ...
DRAWS = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(13)]
# Constants of Spark's xxhash64, and the seed that it begins with.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_FIRST = np.uint64(42)


@dataclass(frozen=True)
class Shape:
    """What bounds a tree, and how many features each node looks at."""

    classes: int
    features_per_node: int
    max_depth: int
    min_rows_per_leaf: int
    min_gain: float


def codes_of(columns, points: list[list[float]]) -> np.ndarray:
    """Features x rows."""
    return np.stack([
        np.searchsorted(np.asarray(cuts, "f8"), np.asarray(column, "f8"), "left").astype("u1") for column, cuts in zip(columns, points)])


def _turned(value: np.ndarray, bits: int) -> np.ndarray:
    return value << np.uint64(bits) | value >> np.uint64(64 - bits)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(33)) * _P2
    value = (value ^ value >> np.uint64(29)) * _P3
    return value ^ value >> np.uint64(32)


def hashed_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of a bigint, on top of a hash."""
    return _mixed(_turned(seed + _P5 + np.uint64(8) ^ _turned(value * _P2, 31) * _P1, 27) * _P1 + _P4)


def hashed_int(value: int, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int, on top of a hash."""
    told = np.array([value & 0xFFFFFFFF], "u8") * _P1
    return _mixed(_turned(seed + _P5 + np.uint64(4) ^ told, 23) * _P2 + _P3)


class Draws:
    """How often rows are in the bags of trees: the Poisson numbers of ``models.bagged``, without a row for each tree."""

    def __init__(self, place: np.ndarray, seed: int):
        self.place, self.seed = hashed_long(place.astype("i8").view("u8"), np.full(len(place), _FIRST)), seed

    def of(self, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows that are drawn, and how often."""
        value = hashed_int(tree, self.place)
        if -1 << 31 <= self.seed < 1 << 31:
            value = hashed_int(self.seed, value)
        else:
            value = hashed_long(np.array([self.seed], "i8").view("u8"), value)
        draw = (value & np.uint64((1 << 53) - 1)).astype("f8") / float(1 << 53)
        rows = np.flatnonzero(draw >= DRAWS[0])
        return rows, np.searchsorted(DRAWS, draw[rows], "right")


def _by_class(place: np.ndarray, label: np.ndarray, weight: np.ndarray, places: int, classes: int) -> np.ndarray:
    return np.bincount(place * classes + label, weight, places * classes).reshape(places, classes)


def _purity(stats: np.ndarray) -> np.ndarray:
    """Weight less its Gini impurity."""
    return (stats * stats).sum(1) / np.maximum(stats.sum(1), 1e-300)


def _best_splits(code, node, label, weight, count, stats, rows_of, shape: Shape):
    """Per node the gain and the code of its best split by one feature's codes; no gain: none."""
    nodes, codes = len(stats), int(code.max()) + 1
    if nodes * codes <= max(len(code), MANY_CELLS):
        # A cell for each node and code; those without rows are dropped. A cell adds its rows in their order.
        cell, cells = node * codes + code, nodes * codes
        held = np.flatnonzero(np.bincount(cell, minlength=cells))
        of, at = held // codes, (held % codes).astype("u1")
    else:
        # Counting sorts, by code and then by node; one of both where two bytes hold them.
        if nodes <= 256:
            order = np.argsort(node.astype("u2") << 8 | code, kind="stable")
        else:
            order = np.argsort(code, kind="stable")
            order = order[np.argsort(node[order].astype("u2" if nodes < 1 << 16 else "i8"), kind="stable")]
        at, of = code[order], node[order]
        new = np.ones(len(order), bool)
        new[1:] = (at[1:] != at[:-1]) | (of[1:] != of[:-1])
        cell, label, weight, count = np.cumsum(new) - 1, label[order], weight[order], count[order]
        at, of = at[new], of[new]
        cells, held = len(at), slice(None)
    first = np.searchsorted(of, np.arange(nodes))
    left = np.cumsum(_by_class(cell, label, weight, cells, shape.classes)[held], axis=0)
    left -= np.vstack([np.zeros((1, shape.classes)), left])[first][of]
    rows = np.cumsum(np.bincount(cell, count, cells)[held])
    rows -= np.concatenate([[0], rows])[first][of]
    gain = _purity(left) + _purity(np.maximum(stats[of] - left, 0)) - _purity(stats)[of]
    allowed = (rows >= shape.min_rows_per_leaf) & (rows_of[of] - rows >= shape.min_rows_per_leaf)
    allowed[:-1] &= of[1:] == of[:-1]
    allowed[-1] = False
    gain[~allowed] = 0.0
    best = np.maximum.reduceat(gain, first)
    places = np.flatnonzero(gain == best[of])[::-1]
    split = np.zeros(nodes, "u1")
    split[of[places]] = at[places]
    return best, split


def _kept(which: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    return list(columns) if which.all() else [column[which] for column in columns]


def _down(feature: np.ndarray, split: np.ndarray, left: np.ndarray, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The leaves at which rows end that start at ``at``; ``codes`` is features x rows."""
    every = np.arange(codes.shape[1])
    while True:
        down = left[at] + (codes[feature[at], every] > split[at])
        if np.array_equal(down, at):
            return at
        at = down


def grow(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, count: np.ndarray, seed: list[int], shape: Shape) -> dict:
    """A tree of Gini splits over the rows, level by level.

    ``weight`` is a row's weight times ``count``, how often the bag holds it. Every
    node looks at features of its own draw. Leaves of one parent that say the same class are one leaf.
    """
    draw = np.random.default_rng(seed)
    features, n = codes.shape
    rows, node, flat = np.arange(n), np.zeros(n, "i8"), codes.ravel()
    feature, split, left, stats_of, gains, starts = [], [], [], [], [], [0]
    nodes = 1
    for depth in range(shape.max_depth + 1):
        stats = _by_class(node, label, weight, nodes, shape.classes)
        size, start = stats.sum(1), starts[-1]
        at, gain, code = np.zeros(nodes, "u1"), np.zeros(nodes), np.full(nodes, LEAF, "u1")
        picks = draw.random((nodes, features)).argpartition(shape.features_per_node - 1, axis=1)[:, :shape.features_per_node]
        growing = (size - _purity(stats) > LEAST_GAIN) & (depth < shape.max_depth)
        rows, node, label, weight, count = _kept(growing[node], rows, node, label, weight, count)
        if len(rows):
            place = np.cumsum(growing) - 1
            own = place[node]
            inner, rows_of = stats[growing], np.bincount(own, count, int(growing.sum()))
            best, best_at, best_code = np.zeros(len(inner)), np.zeros(len(inner), "u1"), np.zeros(len(inner), "u1")
            for pick in np.sort(picks[growing], axis=1).T:
                found, where = _best_splits(flat[(pick * n)[own] + rows], own, label, weight, count, inner, rows_of, shape)
                better = found > best
                best[better], best_at[better], best_code[better] = found[better], pick[better], where[better]
            good = best > np.maximum(LEAST_GAIN, shape.min_gain * inner.sum(1))
            chosen = np.flatnonzero(growing)[good]
            at[chosen], gain[chosen], code[chosen] = best_at[good], best[good], best_code[good]
        is_split = code != LEAF
        rank = np.cumsum(is_split) - 1
        starts.append(start + nodes)
        left.append(np.where(is_split, starts[-1] + 2 * rank, start + np.arange(nodes)))
        feature.append(at), split.append(code), stats_of.append(stats), gains.append(gain)
        rows, node, label, weight, count = _kept(is_split[node], rows, node, label, weight, count)
        nodes = 2 * int(is_split.sum())
        if not nodes:
            break
        node = 2 * rank[node] + (flat[at[node].astype("i8") * n + rows] > code[node])
    return _pruned(np.concatenate(feature), np.concatenate(split), np.concatenate(left), np.concatenate(stats_of),
                   np.concatenate(gains), starts, features)


def _pruned(feature, split, left, stats, gains, starts, features: int) -> dict:
    said = stats.argmax(1)
    for start, end in reversed(list(zip(starts, starts[1:]))):
        inner = start + np.flatnonzero(split[start:end] != LEAF)
        child = left[inner]
        same = (split[child] == LEAF) & (split[child + 1] == LEAF) & (said[child] == said[child + 1])
        closed = inner[same]
        split[closed], feature[closed], left[closed], gains[closed] = LEAF, 0, closed, 0.0
    held = np.zeros(len(split), bool)
    held[0] = True
    for start, end in zip(starts, starts[1:]):
        inner = start + np.flatnonzero((split[start:end] != LEAF) & held[start:end])
        held[left[inner]] = held[left[inner] + 1] = True
    renumbered = np.cumsum(held) - 1
    feature, split, left, gains = feature[held], split[held], renumbered[left[held]], gains[held]
    return _told(feature, split, left, gains, _votes(stats[held][split == LEAF]), features) | {"weights": stats[0].tolist()}


def _votes(leaves: np.ndarray) -> np.ndarray:
    return np.round(leaves / np.maximum(leaves.sum(1, keepdims=True), 1e-300) / VOTE) * VOTE


def _told(feature, split, left, gains, votes, features: int) -> dict:
    shares = np.bincount(feature, gains, features)
    return {
        "nodes": len(split), "importances": (shares / (shares.sum() or 1.0)).tolist(), "gained": float(shares.sum()),
        "feature": feature.astype("u1").tobytes(),
        "split": split.astype("u1").tobytes(), "left": left.astype("<i4").tobytes(), "votes": votes.astype("<f8").tobytes(),
    }


def picks_of(seed: list[int], shape: Shape, features: int) -> np.ndarray:
    """The features that an upper node looks at."""
    draw = np.random.default_rng(seed).random(features)
    return np.sort(draw.argpartition(shape.features_per_node - 1)[:shape.features_per_node])


def best_cut(weights: np.ndarray, counts: np.ndarray, held: np.ndarray, picks: np.ndarray, widths: list[int], shape: Shape) -> dict:
    """A node's best split from sums over its rows by code, for one of its features after another: weight by class,
    draws, and rows. No gain: none."""
    start, made = 0, None
    for pick in picks:
        end = start + widths[pick]
        left, drawn, rows = weights[start:end].cumsum(0), counts[start:end].cumsum(), held[start:end].cumsum()
        stats = left[-1:]
        gain = _purity(left) + _purity(np.maximum(stats - left, 0)) - _purity(stats)
        gain[(drawn < shape.min_rows_per_leaf) | (drawn[-1] - drawn < shape.min_rows_per_leaf) | (drawn == drawn[-1])] = 0.0
        code = int(gain.argmax())
        if made is None or gain[code] > made["gain"]:
            made = {"feature": int(pick), "code": code, "gain": float(gain[code]), "left": left[code].tolist(), "right": (stats[0] - left[code]).tolist(),
                    "left_rows": int(rows[code]), "right_rows": int(rows[-1] - rows[code])}
        start = end
    size = sum(made["left"]) + sum(made["right"])
    return made if made["gain"] > max(LEAST_GAIN, shape.min_gain * size) else made | {"gain": 0.0}


class Upper:
    """The nodes of a tree that have more rows than a task takes, and their children. A node's number is 1 for the root
    and 2n and 2n + 1 for the children of n. An end is a leaf, or the place of a piece that a task grows."""

    def __init__(self, rows: int, most: int, shape: Shape):
        self.most, self.shape = most, shape
        self.number, self.rows, self.stats, self.closed = [1], [rows], [np.zeros(shape.classes)], [False]
        self.feature, self.split, self.left, self.gain = [0], [LEAF], [0], [0.0]

    def open(self) -> list[int]:
        """Nodes that are to be split yet."""
        return [at for at, rows in enumerate(self.rows) if rows > self.most and self.split[at] == LEAF and not self.closed[at]]

    def cut(self, at: int, made: dict | None) -> None:
        """Takes what ``best_cut`` says of a node; nothing of one without rows."""
        if made:
            self.stats[at] = np.asarray(made["left"]) + np.asarray(made["right"])
        if not made or not made["gain"]:
            self.closed[at] = True
            return
        self.feature[at], self.split[at], self.left[at], self.gain[at] = made["feature"], made["code"], len(self.number), made["gain"]
        for side, name in enumerate(("left", "right")):
            stats, number = np.asarray(made[name]), 2 * self.number[at] + side
            pure = stats.sum() - _purity(stats[None])[0] <= LEAST_GAIN
            self.left.append(len(self.number))
            self.number.append(number), self.rows.append(made[f"{name}_rows"]), self.stats.append(stats)
            self.closed.append(bool(pure) or number.bit_length() > self.shape.max_depth)
            self.feature.append(0), self.split.append(LEAF), self.gain.append(0.0)

    def ends(self) -> list[int]:
        """Nodes below which a task grows a piece."""
        return [at for at, rows in enumerate(self.rows) if rows <= self.most and self.split[at] == LEAF and not self.closed[at]]

    def finished(self, loose: dict[int, list[float]], features: int) -> dict:
        """The upper part as a table row holds it. ``loose`` are pieces of one node, by number: they are leaves of
        this part, and as anywhere leaves of one parent that say the same class are one leaf."""
        for at, number in enumerate(self.number):
            if number in loose:
                self.closed[at], self.stats[at] = True, np.asarray(loose[number])
        for at in reversed(range(len(self.number))):
            child = self.left[at]
            if self.split[at] != LEAF and self.closed[child] and self.closed[child + 1] \
                    and self.stats[child].argmax() == self.stats[child + 1].argmax():
                self.closed[at], self.split[at], self.feature[at], self.left[at], self.gain[at] = True, LEAF, 0, at, 0.0
        held = np.zeros(len(self.number), bool)
        held[0] = True
        for at in range(len(held)):
            if held[at] and self.split[at] != LEAF:
                held[self.left[at]:self.left[at] + 2] = True
        split, closed = np.array(self.split, "u1")[held], np.array(self.closed)[held]
        left = (np.cumsum(held) - 1)[np.array(self.left)][held]
        leaf = split == LEAF
        exits = np.where(closed, 0, np.array(self.number, "i8")[held])[leaf]
        votes = np.where(exits[:, None] == 0, _votes(np.stack(self.stats)[held][leaf]), 0.0)
        made = _told(np.array(self.feature)[held], split, left, np.array(self.gain)[held], votes, features)
        return made | {"nodes": made["nodes"] - int((exits > 0).sum()), "weights": self.stats[0].tolist(), "exits": exits.astype("<i8").tobytes()}


class Crowns:
    """The upper parts of several trees, for tasks that look where rows of a bag stand."""

    def __init__(self, uppers: dict[int, Upper]):
        self.starts = np.full(max(uppers) + 1, -1)
        kept, end = [], 0
        for tree, upper in uppers.items():
            self.starts[tree] = end
            kept.append((upper.feature, upper.split, np.array(upper.left) + end, upper.number))
            end += len(upper.number)
        self.feature, self.split, self.left, self.number = (
            np.concatenate([np.asarray(some, kind) for some in column]) for column, kind in zip(zip(*kept), ("u1", "u1", "i8", "i8")))

    def at(self, tree: int, codes: np.ndarray) -> np.ndarray:
        return _down(self.feature, self.split, self.left, np.full(codes.shape[1], self.starts[tree]), codes)

    def sums(self, slots: dict[tuple[int, int], int], picks: np.ndarray, widths: list[int], classes: int) -> "Sums":
        """Empty sums for some nodes, by tree and place in its upper part; ``picks`` are the features of each slot."""
        slot = np.full(len(self.number), -1)
        for (tree, at), number in slots.items():
            slot[self.starts[tree] + at] = number
        return Sums(self, slot, picks, np.asarray(widths), classes)


class Sums:
    """Per node, feature and code: weight by class, draws and rows."""

    def __init__(self, crowns: Crowns, slot: np.ndarray, picks: np.ndarray, widths: np.ndarray, classes: int):
        self.crowns, self.slot, self.picks, self.classes = crowns, slot, picks, classes
        ends = np.cumsum(widths[picks].ravel())
        self.first = np.concatenate([[0], ends[:-1]]).reshape(picks.shape)
        self.bounds = np.concatenate([self.first[:, 0], ends[-1:]])
        self.weights, self.counts, self.held = np.zeros((ends[-1], classes)), np.zeros(ends[-1], "i8"), np.zeros(ends[-1], "i8")

    def add(self, tree: int, codes: np.ndarray, label: np.ndarray, weight: np.ndarray, count: np.ndarray) -> None:
        """Rows of a tree's bag; ``weight`` is a row's weight times ``count``."""
        slot = self.slot[self.crowns.at(tree, codes)]
        rows = np.flatnonzero(slot >= 0)
        slot, label, weight, count = slot[rows], label[rows], weight[rows], count[rows]
        flat = self.weights.reshape(-1)
        for pick, first in zip(self.picks.T, self.first.T):
            cell = first[slot] + codes[pick[slot], rows]
            np.add.at(flat, cell * self.classes + label, weight)
            np.add.at(self.counts, cell, count)
            np.add.at(self.held, cell, 1)

    def told(self):
        """Slot by slot, those with rows."""
        for slot, (start, end) in enumerate(zip(self.bounds, self.bounds[1:])):
            if self.held[start:end].any():
                yield slot, self.weights[start:end].tobytes(), self.counts[start:end].tobytes(), self.held[start:end].tobytes()


class Grown:
    """A tree as its table row holds it, or one of its pieces, or its upper part, which has ``exits``: the number of
    the piece below each of its leaves, 0 for a leaf of its own."""

    def __init__(self, row: dict, classes: int):
        self.tree, self.root = row.get("tree"), row.get("root") or 1
        self.feature, self.split = np.frombuffer(row["feature"], "u1"), np.frombuffer(row["split"], "u1")
        self.left, self.votes = np.frombuffer(row["left"], "<i4"), np.frombuffer(row["votes"], "<f8").reshape(-1, classes)
        self.leaf = np.cumsum(self.split == LEAF) - 1
        self.exits = np.frombuffer(row.get("exits") or b"", "<i8")

    def add_votes(self, codes: np.ndarray, votes: np.ndarray) -> np.ndarray:
        """``codes`` is features x rows. Gives each row's leaf."""
        leaf = self.leaf[_down(self.feature, self.split, self.left, np.zeros(codes.shape[1], "i4"), codes)]
        votes += self.votes[leaf]
        return leaf


def add_votes(pieces: Iterable[tuple[list, Grown]], columns: list[np.ndarray], votes: np.ndarray) -> None:
    """Adds the votes of trees, each piece behind the upper part of its tree, with the split points of each."""
    points, codes, below = None, None, {}
    for at, piece in pieces:
        if at != points:
            points, codes = at, codes_of(columns, at)
        if piece.root == 1:
            leaf = piece.add_votes(codes, votes)
            if piece.exits.any():
                number = piece.exits[leaf]
                order = number.argsort(kind="stable").astype("i4")
                below[piece.tree] = order, number[order].astype("i4")
        elif piece.tree in below:
            order, number = below[piece.tree]
            rows = order[np.searchsorted(number, piece.root, "left"):np.searchsorted(number, piece.root, "right")]
            if len(rows):
                some = votes[rows]
                piece.add_votes(codes[:, rows], some)
                votes[rows] = some
