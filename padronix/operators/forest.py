"""Random forests whose trees grow where their rows are.

Rows are binned once (at most `bins` values per predictor) and packed into chunks of a few thousand. Bags are not drawn but
computed: a row's weight in a tree follows from a hash of the row and the tree, so any task knows it, and rows outside a
bag are known later without a table of them. The root of a tree and every other node of more than `local_rows` rows is
split over all chunks: tasks add up class counts per candidate predictor and bin, and the counts of a node are merged by its
key. A node of fewer rows is sent to one task with its rows, which grows the rest of the tree. Predictors tried at a
node follow from a hash of tree and node, so both ways give the same tree. Trees are rows of a written table; the driver
sees the splits of large nodes only, of which there are fewer than rows / local_rows per tree and level.

Rows of equal bins, part and class meet the same nodes. Where there are few such groups (`count_groups`), tasks add up how
often each group is in each bag, once for all folds and candidates, and one task grows a few trees of all forests from
the groups, whatever the number of rows (`grow_groups`). The trees are the same.

Leaf shares are whole numbers of 2^-20, so that votes add up alike in any order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padronix.operators import grower
from padronix.operators.shared import written
from padronix.operators.sizing import join_table

CHUNK_ROWS = 8192
LOCAL_ROWS = 2_500_000  # rows (copies of the bag) of a node that one task grows to its leaves
GROWN_ROWS = 2_000_000  # rows times trees that grow side by side in a task
FRONT_ROWS = 1 << 17  # rows of the nodes that a task splits at once, once nodes are as small
JOINT = 26  # bits of a sum of positive weights, where both sums fit one number
KEPT_ROWS = 2_000_000  # rows times trees to be kept that one call of the compiled function grows
UNIT_TREES = 25  # whole trees that one task grows, one after another
MOST_TASKS = 4096  # tasks that nodes are dealt to; each grows its nodes one after another
SLICE_CHUNKS = 32  # chunks that meet a batch of trees in one task
MEETING_TASKS = 96  # blocks from which on a batch has more than UNIT_TREES trees, as chunks are sent once per batch
MEETING_BYTES = 32 << 20  # heap numbers of the trees of such a batch
OPEN_NODES = 20_000  # large nodes whose counts a task holds at once
GROUPS = 2_000_000  # groups of equal rows up to which trees are grown from them
GROUP_ROWS = 4  # rows per group from which on that pays
GROUP_TREES = 5  # trees, of all forests, that one task grows from groups
SLAB_ROWS = 500_000  # rows that a task groups at once
PIECE_GROUPS = 100_000  # groups of one stored piece
SMALL_VOTES = 300_000  # votes of distinct rows that are broadcast
ONE = 1 << 20
HELD = 16  # bit s of `part`: the row trains split s; bit HELD + s: it is held out from split s

CHUNK = "ids binary, y binary, part binary, bins binary"
PIECE = "fit int, tree int, heap binary, feature binary, cut binary, share binary, gains binary"
OUT = f"{PIECE}, id binary, held binary, votes binary, n_trees int"
GROUP = "unit int, y binary, part binary, bins binary, weights binary"
CALL = f"{OUT}, first int, spec binary, trees binary, ids binary, y binary, codes binary, held_codes binary"
OUT_GROUPS = f"{PIECE}, rows binary, votes binary"


@dataclass(frozen=True)
class Growth:
    """One forest: which split's rows it learns from, and how its trees grow."""

    split: int
    mtry: int
    trees: int
    depth: int
    seed: int
    bins: int
    keep: bool = False  # whether its trees are returned, not only votes on held-out rows


# ---------------------------------------------------------------- bins


def fit_bins(rows: DataFrame, features: str, width: int, bins: int) -> list[list[float]]:
    """Upper edges of all bins but the last, per predictor: quantiles of the rows, from one aggregate.

    A predictor of few values has a bin for each that is a quantile; of more quantiles than `bins`, the smallest is left out.
    """
    values = rows.select(vector_to_array(features).alias("x"))
    grid = [i / bins for i in range(bins + 1)]
    marks = values.agg(F.array(*[F.percentile_approx(F.col("x")[i], grid, 20_000) for i in range(width)]).alias("m")).first()["m"]
    return [sorted(set(m))[:-1][-(bins - 1) :] for m in marks]


def binned(features: str, edges: Sequence[Sequence[float]]) -> Column:
    """Column: a byte per predictor, the number of edges below its value."""
    limits = [np.array(e, float) for e in edges]

    @F.pandas_udf("binary")
    def place(x: pd.Series) -> pd.Series:
        values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(limits)))
        out = np.empty(values.shape, np.uint8)
        for i, e in enumerate(limits):
            out[:, i] = np.searchsorted(e, values[:, i])
        return pd.Series([r.tobytes() for r in out])

    return place(vector_to_array(features))


# ---------------------------------------------------------------- hashes


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tree_key(seed: int, tree: int) -> np.ndarray:
    return _mixed(np.array([(seed << 32) + tree + 1], np.uint64))


# Shares of a Poisson variable of mean 1 up to each value: how often a row is drawn into a bag.
_DRAWN = np.exp(-1.0) * np.cumsum([1, 1, 1 / 2, 1 / 6, 1 / 24, 1 / 120, 1 / 720, 1 / 5040])


def _least(share: float) -> int:
    """The smallest hash that is over `share` of 2^64, as doubles."""
    low, high = 0, (1 << 64) - 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if float(middle) > share * 2.0**64 else (middle + 1, high)
    return low


_LEAST = np.array([_least(float(share)) for share in _DRAWN], np.uint64)


def bag(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is in the bag of a tree; 0 for the rows outside."""
    uniform = _mixed(ids.view(np.uint64) ^ _tree_key(seed, tree)) / 2.0**64
    drawn = np.zeros(len(ids), np.int8)
    for share in _DRAWN:
        drawn += uniform > share
    return drawn.astype(np.int64)


def tried(heaps: np.ndarray, growth: Growth, keys: np.ndarray, width: int) -> np.ndarray:
    """The predictors tried at each node, ascending: as if drawn without replacement. `keys` are those of the nodes' trees."""
    marks = _mixed(_mixed(heaps.astype(np.uint64) ^ keys)[:, None] + np.arange(width, dtype=np.uint64)[None])
    m = min(growth.mtry, width)
    chosen = np.flatnonzero(marks <= np.partition(marks, m - 1, axis=1)[:, m - 1 : m])
    if len(chosen) == m * len(heaps):  # no equal marks
        return (chosen % width).reshape(-1, m)
    return np.sort(np.argpartition(marks, m - 1, axis=1)[:, :m], axis=1)


def node_keys(growth: Growth, trees: Sequence[int]) -> np.ndarray:
    return np.concatenate([_tree_key(growth.seed + 1, t) for t in trees])


# ---------------------------------------------------------------- nodes


def counts_of(bins: np.ndarray, row: np.ndarray, weight: np.ndarray, positive: np.ndarray, node: np.ndarray, features: np.ndarray, n_bins: int) -> np.ndarray:
    """Weights and positive weights per node, tried predictor and bin: (nodes, mtry, bins, 2)."""
    k, m = features.shape
    out = np.empty((k, m, n_bins, 2))
    flat, start = bins.reshape(-1), row * bins.shape[1]
    for j in range(m):
        cell = node * n_bins + flat[start + features[node, j]]
        out[:, j, :, 0] = np.bincount(cell, weight, k * n_bins).reshape(k, n_bins)
        out[:, j, :, 1] = np.bincount(cell, positive, k * n_bins).reshape(k, n_bins)
    return out


def best_splits(counts: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, gain) per node: the largest fall of Gini impurity, times the node's weight; feature -1 for none.

    Rows of bins up to the cut go left. Of equal gains the smaller predictor and cut win.
    """
    k, m, n_bins, _ = counts.shape
    left = counts.cumsum(axis=2, dtype=np.float64)[:, :, :-1]  # whole numbers, so exact
    total = counts[:, :1].sum(axis=2, keepdims=True, dtype=np.float64)
    right = total - left

    # Twice this is what the weighted Gini impurity falls by: p^2 / n of both sides, less that of the node.
    gain = left[..., 1] ** 2 / np.maximum(left[..., 0], 1)
    gain += right[..., 1] ** 2 / np.maximum(right[..., 0], 1)
    gain -= total[..., 1] ** 2 / np.maximum(total[..., 0], 1)
    gain[(left[..., 0] == 0) | (right[..., 0] == 0)] = -1
    flat = gain.reshape(k, -1)
    # Rounded, so that equal gains are equal however they came about.
    at = np.round(flat, 6).argmax(axis=1)
    best = 2 * flat[np.arange(k), at]
    slot, cut = np.divmod(at, n_bins - 1)
    found = best > 1e-6
    return np.where(found, features[np.arange(k), slot], -1), np.where(found, cut, 0), np.where(found, best, 0.0)


def share_of(positive: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return (positive * ONE + weight // 2) // np.maximum(weight, 1)


@dataclass(frozen=True)
class Codes:
    """Binned rows in whole words: each predictor takes the bits that its largest bin needs, so that many fit a word."""

    words: np.ndarray  # (words, rows), uint64
    bits: list[tuple[int, int]]  # per predictor its word and its first bit
    sizes: np.ndarray  # bins per predictor

    @staticmethod
    def of(bins: np.ndarray) -> Codes:
        sizes = bins.max(axis=0, initial=0).astype(np.int64) + 1
        bits, word, used = [], 0, 0
        for size in sizes.tolist():
            need = (size - 1).bit_length()
            if used + need > 64:
                word, used = word + 1, 0
            bits.append((word, used % 64))
            used += need
        words = np.zeros((word + 1, len(bins)), np.uint64)
        for (at, shift), column in zip(bits, bins.T, strict=True):
            words[at] |= column.astype(np.uint64) << np.uint64(shift)
        return Codes(words, bits, sizes)

    def reader(self):
        """read(words, node, feature): the bin of each row's node's predictor."""
        word = np.array([w for w, _ in self.bits], np.int64)
        shift = np.array([b for _, b in self.bits], np.uint64)
        mask = np.array([(1 << (size - 1).bit_length()) - 1 for size in self.sizes.tolist()], np.uint64)

        def read(words: np.ndarray, node: np.ndarray, feature: np.ndarray) -> np.ndarray:
            if len(words) == 1:
                found = words[0] >> shift[feature][node]
            else:
                found = words[word[feature][node], np.arange(words.shape[1])] >> shift[feature][node]
            found &= mask[feature][node]
            return found.view(np.int64)

        return read


@dataclass
class _Front:
    """Nodes that may be split, of one or several trees, with their rows in the nodes' order."""

    heap: np.ndarray
    owner: np.ndarray  # which tree
    total: np.ndarray  # weight of the node
    positive: np.ndarray
    words: np.ndarray  # of the rows in bags
    node: np.ndarray
    weights: tuple[np.ndarray, ...]
    held_words: np.ndarray  # of the rows held out
    held_node: np.ndarray
    held_row: np.ndarray

    def pieces(self) -> Iterator[_Front]:
        """Runs of nodes of about FRONT_ROWS rows, the last run first; a larger node is a run of its own."""
        k = len(self.heap)
        rows, held = (np.searchsorted(of, np.arange(k + 1)) for of in (self.node, self.held_node))
        ends = rows + held
        run = (ends[:-1] + ends[1:]) // (2 * FRONT_ROWS)  # by the middle of a node: two runs at least
        cuts = np.flatnonzero(np.diff(run, prepend=-1, append=run[-1] + 1)).tolist()
        for a, b in reversed([*pairwise(cuts)]):
            r, h = slice(rows[a], rows[b]), slice(held[a], held[b])
            yield _Front(
                *(x[a:b] for x in (self.heap, self.owner, self.total, self.positive)), self.words[:, r].copy(), self.node[r] - a,
                tuple(w[r].copy() for w in self.weights), self.held_words[:, h].copy(), self.held_node[h] - a, self.held_row[h].copy(),
            )


def grow(
    codes: Codes, y: np.ndarray, trains: np.ndarray, held: np.ndarray, ids: np.ndarray, growth: Growth, trees: Sequence[int], root: int = 1,
) -> tuple[list[dict[str, np.ndarray]], list[np.ndarray], np.ndarray]:
    """(nodes, gains per predictor) of each of the trees below `root`, and the votes of the held-out rows, summed.

    The trees grow side by side. nodes: heap number (children of h are 2h and 2h + 1), feature (-1 for a leaf), cut, share of the
    positive class in 2^-20; none unless the forest is to be kept. Held-out rows count nothing and are led to their leaves.
    """
    some = np.flatnonzero(trains)
    weights = []
    for t in trees:
        drawn = np.zeros(len(trains), np.int64)
        drawn[some] = bag(ids[some], growth.seed, t)
        weights.append(drawn)
    return grow_weighted(codes, weights, [w * y for w in weights], held, growth, trees, root)


def grow_weighted(
    codes: Codes, weights: Sequence[np.ndarray], positives: Sequence[np.ndarray], held: np.ndarray, growth: Growth, trees: Sequence[int], root: int = 1,
) -> tuple[list[dict[str, np.ndarray]], list[np.ndarray], np.ndarray]:
    """As `grow`, from each tree's weights of the rows, all in all and of the positive class.

    Nodes are split level by level until they have few rows, then run by run, each down to its leaves, so that
    the arrays at work are small. Rows leave as soon as their node is a leaf.
    """
    keys, read, width = node_keys(growth, trees), codes.reader(), len(codes.sizes)
    used = [np.flatnonzero(w) for w in weights]
    outside = np.flatnonzero(held)
    joint = all(w.sum() < 1 << JOINT for w in weights)
    w, p = (np.concatenate([of[u] for of, u in zip(x, used, strict=True)]).astype(np.float64) for x in (weights, positives))
    front = _Front(
        np.full(len(trees), root, np.int64), np.arange(len(trees)), *(np.array([x.sum() for x in of], np.int64) for of in (weights, positives)),
        codes.words[:, np.concatenate(used)], np.repeat(np.arange(len(trees)), [len(u) for u in used]), (w * 2.0**JOINT + p,) if joint else (w, p),
        np.tile(codes.words[:, outside], len(trees)), np.repeat(np.arange(len(trees)), len(outside)), np.tile(outside, len(trees)),
    )
    votes = np.zeros(len(held), np.int64)
    made: list[tuple] = []
    if growth.keep:
        made.append((front.owner[:0], front.heap[:0], front.heap[:0], front.heap[:0], front.heap[:0], np.zeros(0)))

    def leaves(front: _Front, shut: np.ndarray) -> None:
        share = share_of(front.positive, front.total)
        if growth.keep:
            none = np.zeros(int(shut.sum()), np.int64)
            made.append((front.owner[shut], front.heap[shut], none - 1, none, share[shut], np.zeros(len(none))))
        of = shut[front.held_node]
        np.add.at(votes, front.held_row[of], share[front.held_node[of]])

    opened = (front.positive > 0) & (front.positive < front.total) & (front.heap < 1 << growth.depth)
    leaves(front, ~opened)
    stack = [_passed(front, opened)]
    while stack:
        front = stack.pop()
        if not len(front.heap):
            continue
        if len(front.heap) > 1 and len(front.node) + len(front.held_node) > 2 * FRONT_ROWS:
            stack += front.pieces()
            continue
        feature, cut, gain, left = _splits(front, codes.sizes, read, tried(front.heap, growth, keys[front.owner], width))
        split = feature >= 0
        if growth.keep:
            made.append((front.owner[split], front.heap[split], feature[split], cut[split], share_of(front.positive, front.total)[split], gain[split]))
        if not split.all():
            leaves(front, ~split)
            feature, cut, left = feature[split], cut[split], left[:, split]
            front = _passed(front, split)
        if not len(front.heap):
            continue
        # Children: all the left ones, then all the right ones, each in their parents' order.
        right, held_right = (read(words, node, feature) > cut[node] for words, node in ((front.words, front.node), (front.held_words, front.held_node)))
        to, held_to = (np.concatenate((np.flatnonzero(~r), np.flatnonzero(r))) for r in (right, held_right))
        k = len(front.heap)
        below = _Front(
            np.concatenate((2 * front.heap, 2 * front.heap + 1)), np.tile(front.owner, 2), np.concatenate((left[0], front.total - left[0])),
            np.concatenate((left[1], front.positive - left[1])), front.words, (front.node + k * right)[to], front.weights,
            front.held_words, (front.held_node + k * held_right)[held_to], front.held_row[held_to],
        )
        opened = (below.positive > 0) & (below.positive < below.total) & (below.heap < 1 << growth.depth)
        leaves(below, ~opened)
        stack.append(_passed(below, opened, to, held_to))
    nodes, gains = [], []
    if growth.keep:
        owner, heap, feature, cut, share, gain = (np.concatenate([m[i] for m in made]) for i in range(6))
        order = np.lexsort((heap, owner))
        ends = np.searchsorted(owner[order], np.arange(len(trees) + 1))
        for a, b in pairwise(ends.tolist()):
            at = order[a:b]
            nodes.append({"heap": heap[at], "feature": feature[at], "cut": cut[at], "share": share[at]})
            inner = at[feature[at] >= 0]
            gains.append(np.bincount(feature[inner], gain[inner], width))
    return nodes, gains, votes[held]


def _passed(front: _Front, which: np.ndarray, order: np.ndarray | None = None, held_order: np.ndarray | None = None) -> _Front:
    """The nodes that are marked, with their rows. `order` and `held_order`: where the words and weights of the rows stand."""
    number = np.cumsum(which) - 1
    rows, held = (np.flatnonzero(which[node]) for node in (front.node, front.held_node))
    at, held_at = (some if order is None else order[some] for some, order in ((rows, order), (held, held_order)))
    return _Front(
        *(x[which] for x in (front.heap, front.owner, front.total, front.positive)), front.words.take(at, axis=1), number[front.node[rows]],
        tuple(w[at] for w in front.weights), front.held_words.take(held_at, axis=1), number[front.held_node[held]], front.held_row[held],
    )


def _splits(front: _Front, sizes: np.ndarray, read, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, gain, left weights) per node, as `best_splits` chooses them, from counts of each tried predictor's own bins."""
    k, m = features.shape
    bits = JOINT if len(front.weights) == 1 else 32
    total, positive = front.total.astype(np.float64), front.positive.astype(np.float64)
    before = np.cumsum((front.total << bits) + front.positive) - ((front.total << bits) + front.positive)
    whole = positive**2 / np.maximum(total, 1)
    best, gain, feature = np.full(k, -1, np.int64), np.full(k, -1.0), np.full(k, -1, np.int64)
    cut, left = np.zeros(k, np.int64), np.zeros((2, k), np.int64)
    for j in range(m):
        tries = np.ascontiguousarray(features[:, j])
        size = sizes[tries]
        start = np.cumsum(size) - size
        cells = int(size.sum())
        cell = read(front.words, front.node, tries)
        cell += start[front.node]
        sums = [np.bincount(cell, w, cells).astype(np.int64) for w in front.weights]
        of = np.repeat(np.arange(k), size)
        # A node's counts follow those of the nodes before it, which are the same for every predictor.
        both = np.cumsum(sums[0] if len(sums) == 1 else (sums[0] << 32) + sums[1])
        both -= before[of]
        some = np.flatnonzero((both > 0) & (both >> bits < front.total[of]))  # rows on both sides
        if not len(some):
            continue
        both, of = both[some], of[some]
        n, p = (both >> bits).astype(np.float64), (both & ((1 << bits) - 1)).astype(np.float64)
        fall = p**2 / n
        more, rest = positive[of] - p, total[of] - n
        fall += more**2 / rest
        fall -= whole[of]
        # Rounded, so that equal gains are equal however they came about; of these the smallest cut wins.
        place = some - start[of]
        rank = (np.rint(fall * 1e6).astype(np.int64) << 8) + (255 - place)
        first = np.flatnonzero(np.diff(of, prepend=-1))
        top = np.maximum.reduceat(rank, first)
        nodes = of[first]
        won = np.flatnonzero(top >> 8 > best[nodes])
        nodes, top = nodes[won], top[won]
        cuts = 255 - (top & 255)
        # where the chosen cut stands among the cells that were looked at
        at = np.searchsorted(some, start[nodes] + cuts)
        best[nodes], feature[nodes], cut[nodes] = top >> 8, tries[nodes], cuts
        gain[nodes] = 2 * fall[at]
        left[:, nodes] = both[at] >> bits, both[at] & ((1 << bits) - 1)
    none = gain <= 1e-6
    feature[none], cut[none] = -1, 0
    return feature, cut, gain, left


class Tree:
    """A whole tree from its pieces, for leading rows to their leaves."""

    def __init__(self, pieces: list[dict[str, np.ndarray]]):
        heap = np.concatenate([p["heap"] for p in pieces])
        order = np.argsort(heap)
        self.heap = heap[order]
        self.feature, self.cut, self.share = (np.concatenate([p[c] for p in pieces])[order] for c in ("feature", "cut", "share"))
        self.left = np.searchsorted(self.heap, 2 * self.heap)  # the right child is the next one

    def shares(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        active = np.arange(len(bins))
        while len(active):
            here = at[active]
            inner = self.feature[here] >= 0
            active, here = active[inner], here[inner]
            at[active] = self.left[here] + (bins[active, self.feature[here]] > self.cut[here])
        return self.share[at]


KINDS = {"heap": np.int64, "feature": np.int16, "cut": np.uint8, "share": np.int32}


def _unpacked(row: dict) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(row[c], k).astype(np.int64) for c, k in KINDS.items()}


def _piece(fit: int, tree: int, nodes: dict[str, np.ndarray], gains: np.ndarray) -> dict:
    return {"fit": fit, "tree": tree, **{c: nodes[c].astype(k).tobytes() for c, k in KINDS.items()}, "gains": gains.tobytes()}


def each_tree(rows: Iterable[dict]) -> Iterator[tuple[int, Tree]]:
    """Trees in order, each unpacked when it is asked for: many large ones need not exist all at once."""
    pieces: dict[int, list] = {}
    for row in rows:
        pieces.setdefault(row["tree"], []).append(row)
    for t in sorted(pieces):
        yield t, Tree([_unpacked(p) for p in pieces.pop(t)])


def trees_of(rows: Iterable[dict]) -> dict[int, Tree]:
    return dict(each_tree(rows))


# ---------------------------------------------------------------- chunks


@dataclass
class Rows:
    """Packed rows as arrays."""

    ids: np.ndarray
    y: np.ndarray
    part: np.ndarray
    bins: np.ndarray

    @staticmethod
    def of(chunks: Sequence[dict]) -> Rows:
        ids = np.frombuffer(b"".join(c["ids"] for c in chunks), np.int64)
        return Rows(
            ids, np.frombuffer(b"".join(c["y"] for c in chunks), np.uint8).astype(np.int64),
            np.frombuffer(b"".join(c["part"] for c in chunks), np.int32),
            np.frombuffer(b"".join(c["bins"] for c in chunks), np.uint8).reshape(len(ids), -1),
        )

    def where(self, mask: np.ndarray) -> Rows:
        return Rows(self.ids[mask], self.y[mask], self.part[mask], self.bins[mask])

    def packed(self) -> dict:
        return {"ids": self.ids.tobytes(), "y": self.y.astype(np.uint8).tobytes(), "part": self.part.tobytes(), "bins": self.bins.tobytes()}

    def trains(self, split: int) -> np.ndarray:
        return (self.part >> split) & 1 > 0

    def held(self, split: int) -> np.ndarray:
        return (self.part >> (HELD + split)) & 1 > 0


def pack(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows (id bigint, y int, part int, bins binary) in chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, chunk_rows):
                b = batch.slice(low, chunk_rows)
                row = {
                    "ids": b.column("id").to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                    "y": b.column("y").to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                    "part": b.column("part").to_numpy(zero_copy_only=False).astype(np.int32).tobytes(),
                    "bins": b"".join(b.column("bins").to_pylist()),
                }
                yield _batch([row], CHUNK)

    return rows.select("id", "y", "part", "bins").mapInArrow(run, CHUNK)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _ARROW[k]) for n, k in fields], names=[n for n, _ in fields])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one by one: packed rows are large, and their copies need not exist all at once."""
    for i in range(batch.num_rows):
        yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}


# ---------------------------------------------------------------- large nodes


def _split_large(chunks: DataFrame, growths: Sequence[Growth], rows_of: Sequence[int], local_rows: int, width: int):
    """Splits of all nodes of more than `local_rows` rows, level by level: {(fit, tree): {heap: (feature, cut, share, gain, small)}}.

    feature is -1 for a leaf; small nodes are those to be grown by one task. Only splits reach the driver.
    """
    tops: dict[tuple[int, int], dict] = {(f, t): {} for f, g in enumerate(growths) for t in range(g.trees)}
    opened = {}
    for f, g in enumerate(growths):
        for t in range(g.trees):
            if rows_of[f] > local_rows:
                opened[f, t] = [1]
            else:
                tops[f, t][1] = (-1, 0, 0, 0.0, True)
    while opened:
        following: dict[tuple[int, int], list[int]] = {}
        for group in _groups(opened):
            for r in _count_large(chunks, growths, {k: tops[k] for k in group}, group, width):
                key, heap = (r["fit"], r["tree"]), r["heap"]
                g = growths[r["fit"]]
                tops[key][heap] = (r["feature"], r["cut"], r["share"], r["gain"], False)
                if r["feature"] < 0:
                    continue
                for child, n, p in ((2 * heap, r["ln"], r["lp"]), (2 * heap + 1, r["rn"], r["rp"])):
                    if not 0 < p < n or child >= 1 << g.depth:
                        tops[key][child] = (-1, 0, int(share_of(np.int64(p), np.int64(n))), 0.0, False)
                    elif n > local_rows:
                        following.setdefault(key, []).append(child)
                    else:
                        tops[key][child] = (-1, 0, 0, 0.0, True)
        opened = following
    return tops


def _groups(opened: dict) -> Iterator[dict]:
    held, size = {}, 0
    for key, heaps in opened.items():
        if held and size + len(heaps) > OPEN_NODES:
            yield held
            held, size = {}, 0
        held[key] = heaps
        size += len(heaps)
    if held:
        yield held


def _top_tree(top: dict) -> Tree | None:
    """The known part of a tree; nodes still to be split, or to be grown elsewhere, are its leaves, numbered by heap."""
    if not top:
        return None
    heaps = {1, *top, *(c for h, s in top.items() if s[0] >= 0 for c in (2 * h, 2 * h + 1))}
    heap = np.array(sorted(heaps), np.int64)
    of = [top.get(int(h), (-1, 0)) for h in heap]
    piece = {"heap": heap, "feature": np.array([s[0] for s in of]), "cut": np.array([s[1] for s in of]), "share": heap}
    return Tree([piece])


def _count_large(chunks: DataFrame, growths: Sequence[Growth], tops: dict, opened: dict, width: int) -> list:
    """Best splits of the opened nodes: counts are added up inside tasks, then by node."""
    schema = "fit int, tree int, heap bigint, counts binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = {k: _top_tree(t) for k, t in tops.items()}
        places = {k: np.array(sorted(h), np.int64) for k, h in opened.items()}
        features = {k: tried(h, growths[k[0]], node_keys(growths[k[0]], [k[1]]), width) for k, h in places.items()}
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for chunk in _rows(batch):
                rows = Rows.of([chunk])
                for key, heaps in places.items():
                    g = growths[key[0]]
                    weight = np.where(rows.trains(g.split), bag(rows.ids, g.seed, key[1]), 0)
                    heap = routes[key].shares(rows.bins) if routes[key] else np.ones(len(weight), np.int64)
                    at = np.minimum(np.searchsorted(heaps, heap), len(heaps) - 1)
                    used = np.flatnonzero((heaps[at] == heap) & (weight > 0))
                    w = weight[used]
                    found = counts_of(rows.bins, used, w, w * rows.y[used], at[used], features[key], g.bins)
                    sums[key] = sums[key] + found if key in sums else found
        for (f, t), counts in sums.items():
            made = [{"fit": f, "tree": t, "heap": int(h), "counts": c.tobytes()} for h, c in zip(places[f, t], counts, strict=True)]
            yield _batch(made, schema)

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        f, t, heap = (k.as_py() for k in key)
        g = growths[f]
        features = tried(np.array([heap]), g, node_keys(g, [t]), width)
        counts = sum(np.frombuffer(c) for c in table.column("counts").to_pylist()).reshape(1, features.shape[1], g.bins, 2)
        feature, cut, gain = (x[0] for x in best_splits(counts, features))
        n, p = counts[0, 0].sum(axis=0).astype(np.int64).tolist()
        slot = int(np.flatnonzero(features[0] == feature)[0]) if feature >= 0 else 0
        ln, lp = counts[0, slot, : cut + 1].sum(axis=0).astype(np.int64).tolist()
        row = {
            "fit": f, "tree": t, "heap": heap, "feature": int(feature), "cut": int(cut), "gain": float(gain),
            "share": int(share_of(np.int64(p), np.int64(n))), "ln": ln, "lp": lp, "rn": n - ln, "rp": p - lp,
        }
        return pa.Table.from_batches([_batch([row], SPLIT)])

    SPLIT = "fit int, tree int, heap bigint, feature int, cut int, gain double, share int, ln bigint, lp bigint, rn bigint, rp bigint"
    return chunks.mapInArrow(run, schema).groupBy("fit", "tree", "heap").applyInArrow(choose, SPLIT).collect()


# ---------------------------------------------------------------- units


def _units(growths: Sequence[Growth], tops: dict) -> list[tuple[int, list[int], int]]:
    """(fit, trees, heap) for every task: whole trees together, small nodes one by one."""
    units = []
    for f, g in enumerate(growths):
        whole = [t for t in range(g.trees) if tops[f, t].get(1, (0, 0, 0, 0.0, False))[4]]
        units += [(f, whole[i : i + UNIT_TREES], 1) for i in range(0, len(whole), UNIT_TREES)]
        for t in sorted(set(range(g.trees)) - set(whole)):
            units += [(f, [t], heap) for heap, split in sorted(tops[f, t].items()) if split[4]]
    return units


def _leaf_votes(chunks: DataFrame, growths: Sequence[Growth], tops: dict) -> DataFrame | None:
    """Votes of the leaves among the large nodes, given where the held-out rows are: a leaf may hold any number of rows."""
    leaves = {k: {h: s[2] for h, s in top.items() if s[0] < 0 and not s[4]} for k, top in tops.items()}
    leaves = {k: found for k, found in leaves.items() if found}
    if not leaves:
        return None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = {k: _top_tree(tops[k]) for k in leaves}
        known = {k: (np.array(sorted(h), np.int64), np.array([h[x] for x in sorted(h)], np.int64)) for k, h in leaves.items()}
        for batch in batches:
            for chunk in _rows(batch):
                rows = Rows.of([chunk])
                for f in sorted({f for f, _ in leaves}):
                    held = rows.where(rows.held(growths[f].split))
                    votes, voted = np.zeros(len(held.ids), np.int64), np.zeros(len(held.ids), np.int64)
                    for key in (k for k in leaves if k[0] == f):
                        heaps, shares = known[key]
                        heap = routes[key].shares(held.bins)
                        at = np.minimum(np.searchsorted(heaps, heap), len(heaps) - 1)
                        here = heaps[at] == heap
                        votes += np.where(here, shares[at], 0)
                        voted += here
                    out = []
                    for n in np.unique(voted[voted > 0]).tolist():
                        of = voted == n
                        y = held.y[of].astype(np.uint8)
                        out.append({"fit": f, "id": held.ids[of].tobytes(), "held": y.tobytes(), "votes": votes[of].tobytes(), "n_trees": n})
                    if out:
                        yield _batch(out, OUT)

    return chunks.mapInArrow(run, OUT)


def grow_forests(chunks: DataFrame, growths: Sequence[Growth], rows_of: Sequence[int], width: int, folder: str, local_rows: int = LOCAL_ROWS, compiled: bool = True) -> DataFrame:
    """A written table of the forests' pieces (PIECE) and of votes: id, held (labels) and votes of rows held out from a split.

    `rows_of` counts the training rows of each forest. Forests to be kept return their trees. `compiled`: tasks grow their trees by
    the session's compiled function (`grower`) where it is to be had, else by numpy, and to the same trees.
    """
    tops = _split_large(chunks, growths, rows_of, local_rows, width)
    units = _units(growths, tops)
    routed = {(f, trees[0]): tops[f, trees[0]] for f, trees, heap in units if heap != 1}

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes = {k: _top_tree(top) for k, top in routed.items()}
        for batch in batches:
            for chunk in _rows(batch):
                rows = Rows.of([chunk])
                leaves: dict = {}
                out = []
                for u, (f, trees, heap) in enumerate(units):
                    g = growths[f]
                    wanted = rows.held(g.split) | rows.trains(g.split)
                    if (f, trees[0]) in routes:
                        if (f, trees[0]) not in leaves:
                            leaves = {(f, trees[0]): routes[f, trees[0]].shares(rows.bins)}
                        wanted = wanted & (leaves[f, trees[0]] == heap)
                    if wanted.any():
                        out.append({"unit": u, **rows.where(wanted).packed()})
                    if len(out) >= 8:
                        yield _batch(out, f"unit int, {CHUNK}")
                        out = []
                if out:
                    yield _batch(out, f"unit int, {CHUNK}")

    def by_unit(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
        held: list[dict] = []
        for batch in batches:
            for row in _rows(batch):
                if held and row["unit"] != held[0]["unit"]:
                    yield held[0]["unit"], held
                    held = []
                held.append(row)
        if held:
            yield held[0]["unit"], held

    def by_numpy(f: int, trees: list[int], heap: int, rows: Rows) -> Iterator[dict]:
        g = growths[f]
        trains, held = rows.trains(g.split), rows.held(g.split)
        votes = np.zeros(int(held.sum()), np.int64)
        together = max(1, GROWN_ROWS // max(len(held), 1))
        codes = Codes.of(rows.bins)
        for low in range(0, len(trees), together):
            some = trees[low : low + together]
            nodes, gains, more = grow(codes, rows.y, trains, held, rows.ids, g, some, heap)
            votes += more
            if g.keep:
                yield from (_piece(f, *x) for x in zip(some, nodes, gains, strict=True))
        if held.any():
            yield {"fit": f, "id": rows.ids[held].tobytes(), "held": rows.y[held].astype(np.uint8).tobytes(), "votes": votes.tobytes(), "n_trees": len(trees)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, parts in by_unit(batches):
            for row in by_numpy(*units[u], Rows.of(parts)):
                yield _batch([row], OUT)

    def prepare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, parts in by_unit(batches):
            f, trees, heap = units[u]
            g, rows = growths[f], Rows.of(parts)
            codes = Codes.of(rows.bins)
            trains, held = rows.trains(g.split), rows.held(g.split)
            if codes.words.nbytes > grower.MOST_BYTES or int(trains.sum()) * len(_DRAWN) >= grower.MOST_WEIGHT:
                yield from (_batch([row], CALL) for row in by_numpy(f, trees, heap, rows))
                continue
            spec = grower.spec(len(codes.words), codes.bits, codes.sizes, g.mtry, g.depth, heap, g.keep, _LEAST)
            call = {"fit": f, "spec": spec, "ids": rows.ids[trains].tobytes(), "y": rows.y[trains].astype(np.uint8).tobytes()}
            call |= {"codes": codes.words.T[trains].tobytes(), "held_codes": codes.words.T[held].tobytes()}
            call |= {"id": rows.ids[held].tobytes(), "held": rows.y[held].astype(np.uint8).tobytes()}
            together = max(1, KEPT_ROWS // max(len(call["ids"]) // 8, 1)) if g.keep else len(trees)
            for low in range(0, len(trees), together):
                some = trees[low : low + together]
                keys = np.stack([np.concatenate((_tree_key(g.seed, t), _tree_key(g.seed + 1, t))) for t in some])
                yield _batch([call | {"trees": keys.tobytes(), "first": some[0], "n_trees": len(some)}], CALL)

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                grown = row.pop("grown")
                if grown is None:
                    yield _batch([row], OUT)
                    continue
                f, first, n_held = row["fit"], row["first"], len(row["held"])
                if growths[f].keep:
                    for t, (*nodes, gain) in enumerate(grower.trees_of(grown, n_held, row["n_trees"]), first):
                        nodes = dict(zip(KINDS, nodes, strict=True))
                        inner = nodes["feature"] >= 0
                        yield _batch([_piece(f, t, nodes, np.bincount(nodes["feature"][inner], gain[inner], width))], OUT)
                if n_held:
                    yield _batch([{"fit": f, "id": row["id"], "held": row["held"], "votes": grown[: 8 * n_held], "n_trees": row["n_trees"]}], OUT)

    tasks = max(1, min(len(units), MOST_TASKS))
    dealt = chunks.mapInArrow(deal, f"unit int, {CHUNK}").repartitionById(tasks, F.pmod("unit", F.lit(tasks)))
    dealt = dealt.sortWithinPartitions("unit")
    if compiled and (function := grower.registered(chunks.sparkSession)):
        sent = dealt.mapInArrow(prepare, CALL)
        call = F.call_function(function, *[F.col(c) for c in ("spec", "trees", "ids", "y", "codes", "held_codes")])
        made = sent.select(*[f.strip().split(" ")[0] for f in OUT.split(",")], "first", call.alias("grown")).mapInArrow(finish, OUT)
    else:
        made = dealt.mapInArrow(run, OUT)
    grown = written(made, f"{folder}/grown", large_rows=True)
    known = _leaf_votes(chunks, growths, tops)
    if known is not None:
        grown = grown.unionByName(known)
    pieces = []
    for (f, t), top in tops.items():  # what the driver knows of large trees
        inner = {h: s for h, s in top.items() if not s[4]}
        if inner and growths[f].keep:
            heap = np.array(sorted(inner), np.int64)
            nodes = {"heap": heap} | {c: np.array([inner[int(h)][i] for h in heap]) for i, c in enumerate(("feature", "cut", "share"))}
            gains = np.zeros(width)
            for feature, _, _, gain, _ in inner.values():
                if feature >= 0:
                    gains[feature] += gain
            pieces.append(_piece(f, t, nodes, gains))
    if not pieces:
        return grown
    known = grown.sparkSession.createDataFrame(pa.Table.from_batches([_batch(pieces, OUT)]), schema=OUT)
    return grown.unionByName(known)


def held_out_scores(grown: DataFrame) -> DataFrame:
    """(fit, id, y, score): the mean share of the rows held out, over all trees of their forest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                ids, votes = np.frombuffer(row["id"], np.int64), np.frombuffer(row["votes"], np.int64)
                columns = [pa.array(np.full(len(ids), row["fit"], np.int32)), pa.array(ids), pa.array(np.frombuffer(row["held"], np.uint8).astype(np.int32)),
                           pa.array(votes), pa.array(np.full(len(ids), row["n_trees"], np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["fit", "id", "y", "votes", "n"])

    rows = grown.where("votes IS NOT NULL").select("fit", "id", "held", "votes", "n_trees")
    return _mean_shares(rows.mapInArrow(run, "fit int, id bigint, y int, votes bigint, n bigint"))


def _mean_shares(votes: DataFrame) -> DataFrame:
    return votes.groupBy("fit", "id", "y").agg((F.sum("votes") / (F.sum("n") * ONE)).alias("score"))


# ---------------------------------------------------------------- groups of equal rows


def distinct(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct combination of whole numbers from 0 on, which combination each row has)."""
    code, size = np.zeros(len(columns[0]), np.int64), 1
    for c in columns:
        width = int(c.max(initial=0)) + 1
        if size * width >= 1 << 62:
            found, code = np.unique(code, return_inverse=True)
            size = len(found)
        code = code * width + c
        size *= width
    _, first, of = np.unique(code, return_index=True, return_inverse=True)
    return first, of


def _merge(y: np.ndarray, part: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return distinct([part.astype(np.int64), y, *bins.T])


def _mask(growths: Sequence[Growth]) -> tuple[np.int32, np.int32]:
    """Bits of `part` that the forests train on, and are held out from."""
    trained = sum({1 << g.split for g in growths})
    return np.int32(trained), np.int32(trained << HELD)


def _slabs(batches: Iterable[pa.RecordBatch], bits: np.int32) -> Iterator[Rows]:
    """Rows with any of the bits, whose `part` keeps no others, SLAB_ROWS or a chunk more at a time."""

    def slab() -> Rows:
        rows = Rows.of(held)
        rows.part = rows.part & bits
        return rows.where(rows.part > 0)

    held, n = [], 0
    for batch in batches:
        for chunk in _rows(batch):
            held.append(chunk)
            n += len(chunk["y"])
            if n >= SLAB_ROWS:
                yield slab()
                held, n = [], 0
    if held:
        yield slab()


def _binary(rows: np.ndarray) -> pa.Array:
    """An array of the bytes of each row."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def count_groups(chunks: DataFrame, growths: Sequence[Growth], most: int | None = None) -> int:
    """How many groups of equal rows the forests meet, or a number over `most` (GROUPS)."""
    bits = np.bitwise_or(*_mask(growths))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slabs(batches, bits):
            first, _ = _merge(rows.y, rows.part, rows.bins)
            for low in range(0, len(first), PIECE_GROUPS):
                at = first[low : low + PIECE_GROUPS]
                columns = [pa.array(rows.y[at].astype(np.int32)), pa.array(rows.part[at]), _binary(rows.bins[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["y", "part", "bins"])

    return chunks.mapInArrow(run, "y int, part int, bins binary").distinct().limit((GROUPS if most is None else most) + 1).count()


def grow_groups(chunks: DataFrame, growths: Sequence[Growth], width: int, folder: str) -> DataFrame:
    """A written table of the forests' pieces (PIECE), and of votes: the bins of distinct rows held out, and their votes.

    A group's weight in a tree is the sum of its rows' weights in the bag, which splits and candidates have in common.
    """
    trained, held_out = _mask(growths)
    units = []
    for seed in sorted({g.seed for g in growths}):
        trees = range(max(g.trees for g in growths if g.seed == seed))
        units += [(seed, trees[i : i + GROUP_TREES]) for i in range(0, len(trees), GROUP_TREES)]

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slabs(batches, trained | held_out):
            first, of = _merge(rows.y, rows.part, rows.bins)
            trains = rows.part & trained > 0
            ids, of = rows.ids[trains], of[trains]
            for u, (seed, trees) in enumerate(units):
                weights = np.stack([np.bincount(of, bag(ids, seed, t), len(first)) for t in trees], axis=1).astype(np.uint32)
                for low in range(0, len(first), PIECE_GROUPS):
                    at = first[low : low + PIECE_GROUPS]
                    group = {"y": rows.y[at].astype(np.uint8), "part": rows.part[at], "bins": rows.bins[at], "weights": weights[low : low + len(at)]}
                    yield _batch([{"unit": u} | {c: v.tobytes() for c, v in group.items()}], GROUP)

    def summed(parts: list[tuple]) -> tuple:
        y, part, bins, weights = (np.concatenate([p[i] for p in parts]) for i in range(4))
        first, of = _merge(y, part, bins)
        sums = np.stack([np.bincount(of, w, len(first)) for w in weights.T], axis=1).astype(np.int64)
        return y[first], part[first], bins[first], sums

    def by_unit(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[tuple] = []
        unit, n = -1, 0
        for batch in batches:
            for row in _rows(batch):
                if held and row["unit"] != unit:
                    yield unit, *summed(held)
                    held, n = [], 0
                unit, size = row["unit"], len(row["y"])
                arrays = (np.frombuffer(row[c], k) for c, k in (("y", np.uint8), ("part", np.int32), ("bins", np.uint8), ("weights", np.uint32)))
                y, part, bins, weights = arrays
                held.append((y.astype(np.int64), part, bins.reshape(size, width), weights.reshape(size, -1)))
                n += size
                if n > 2 * GROUPS:  # merged parts and new ones
                    held = [summed(held)]
                    n = len(held[0][0])
        if held:
            yield unit, *summed(held)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, y, part, bins, weights in by_unit(batches):
            seed, trees = units[u]
            first, of = distinct(list(bins.T))
            bins = bins[first]
            codes = Codes.of(bins)
            for split in sorted({g.split for g in growths if g.seed == seed}):
                trains = (part >> split) & 1 > 0
                held = np.bincount(of[(part >> (HELD + split)) & 1 > 0], minlength=len(first)) > 0
                positive = trains & (y > 0)
                all_weights = [np.bincount(of[trains], w[trains], len(first)).astype(np.int64) for w in weights.T]
                positives = [np.bincount(of[positive], w[positive], len(first)).astype(np.int64) for w in weights.T]
                for f, g in enumerate(growths):
                    if (g.seed, g.split) == (seed, split):
                        yield from grown(f, [t for t in trees if t < g.trees], bins, codes, all_weights, positives, held)

    def grown(f: int, trees: list[int], bins: np.ndarray, codes: Codes, weights: list, positives: list, held: np.ndarray) -> Iterator[pa.RecordBatch]:
        votes = np.zeros(int(held.sum()), np.int64)
        together = max(1, GROWN_ROWS // max(len(held), 1))
        for low in range(0, len(trees), together):
            some = slice(low, min(low + together, len(trees)))
            nodes, gains, more = grow_weighted(codes, weights[some], positives[some], held, growths[f], trees[some])
            votes += more
            if growths[f].keep:
                yield _batch([_piece(f, *x) for x in zip(trees[some], nodes, gains, strict=True)], OUT_GROUPS)
        rows = bins[held]
        for low in range(0, len(rows) if trees else 0, PIECE_GROUPS):
            some = slice(low, low + PIECE_GROUPS)
            yield _batch([{"fit": f, "rows": rows[some].tobytes(), "votes": votes[some].tobytes()}], OUT_GROUPS)

    dealt = chunks.mapInArrow(weigh, GROUP)
    tasks = max(1, min(len(units), MOST_TASKS))
    dealt = dealt.repartitionById(tasks, F.pmod("unit", F.lit(tasks))).sortWithinPartitions("unit")
    return written(dealt.mapInArrow(run, OUT_GROUPS), f"{folder}/grown", large_rows=True)


def held_out_group_scores(grown: DataFrame, chunks: DataFrame, growths: Sequence[Growth], width: int) -> DataFrame:
    """What `held_out_scores` gives, for forests grown from groups."""

    def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                votes = np.frombuffer(row["votes"], np.int64)
                bins = np.frombuffer(row["rows"], np.uint8).reshape(len(votes), width)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(votes), row["fit"], np.int32)), _binary(bins), pa.array(votes)], names=["fit", "bins", "votes"])

    def rows_held(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _rows(batch):
                rows = Rows.of([chunk])
                for f, g in enumerate(growths):
                    some = rows.where(rows.held(g.split))
                    n = np.full(len(some.ids), g.trees, np.int64)
                    columns = [pa.array(np.full(len(n), f, np.int32)), pa.array(some.ids), pa.array(some.y.astype(np.int32)), pa.array(n), _binary(some.bins)]
                    yield pa.RecordBatch.from_arrays(columns, names=["fit", "id", "y", "n", "bins"])

    votes = grown.where("votes IS NOT NULL").select("fit", "rows", "votes").mapInArrow(unpacked, "fit int, bins binary, votes bigint")
    votes = votes.groupBy("fit", "bins").agg(F.sum("votes").alias("votes"))
    rows = chunks.mapInArrow(rows_held, "fit int, id bigint, y int, n bigint, bins binary")
    return _mean_shares(join_table(rows, votes, ["fit", "bins"], max_rows=SMALL_VOTES))


# ---------------------------------------------------------------- rows against trees


def _meet(chunks: DataFrame, pieces: DataFrame, n_trees: int, work, schema: str) -> DataFrame:
    """`work(numbered trees, rows, slice)` for every batch of trees and slice of chunks: each row meets each tree once, in blocks."""
    slices = max(1, -(-chunks.count() // SLICE_CHUNKS))
    size = pieces.agg(F.sum(F.octet_length("heap"))).first()[0] or 0
    together = max(UNIT_TREES, min(n_trees, n_trees * slices // MEETING_TASKS, n_trees * MEETING_BYTES // max(size, 1)))
    batches = -(-n_trees // together)
    block = f"block int, tree int, {CHUNK}, heap binary, feature binary, cut binary, share binary"
    columns = [c.strip().split(" ") for c in block.split(",")]

    def shaped(table: DataFrame, block_of: Column) -> DataFrame:
        have = set(table.columns)
        return table.select(block_of.alias("block"), *[F.col(n) if n in have else F.lit(None).cast(k).alias(n) for n, k in columns[1:]])

    all_batches = F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))
    spread = F.pmod(F.xxhash64("bins", "ids"), F.lit(slices)).cast("int")
    data = chunks.withColumn("slice", spread).withColumn("batch", all_batches)
    left = shaped(data.withColumn("tree", F.lit(None).cast("int")), F.col("batch") * slices + F.col("slice"))
    all_slices = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    trees = pieces.select("tree", "heap", "feature", "cut", "share").withColumn("slice", all_slices)
    right = shaped(trees, F.floor(F.col("tree") / together).cast("int") * slices + F.col("slice"))
    both = left.unionByName(right).repartitionById(batches * slices, F.col("block"))

    def run(batches_in: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, tuple[list, list]] = {}
        for batch in batches_in:
            for row in _rows(batch):
                blocks.setdefault(row["block"], ([], []))[0 if row["tree"] is not None else 1].append(row)
        for number, (tree_rows, data_rows) in blocks.items():
            if tree_rows and data_rows:
                yield from work(each_tree(tree_rows), Rows.of(data_rows), number % slices)

    return both.mapInArrow(run, schema)


def scores(rows: DataFrame, pieces: DataFrame, n_trees: int, folder: str) -> DataFrame:
    """(bins, score) of the distinct binned rows: rows of equal bins have equal scores."""
    zero = F.lit(0)
    chunks = written(pack(rows.select("bins").distinct().select(F.lit(0).cast("bigint").alias("id"), zero.alias("y"), zero.alias("part"), "bins")), f"{folder}/scored", large_rows=True)

    def work(trees: Iterator[tuple[int, Tree]], block: Rows, number: int) -> Iterator[pa.RecordBatch]:
        votes = sum(t.shares(block.bins) for _, t in trees)
        yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in block.bins], pa.binary()), pa.array(votes)], names=["bins", "votes"])

    met = _meet(chunks, pieces, n_trees, work, "bins binary, votes bigint")
    return written(met.groupBy("bins").agg((F.sum("votes") / F.lit(n_trees * ONE)).alias("score")), f"{folder}/scores")


@dataclass(frozen=True)
class Neighbours:
    """The distinct rows of a block, and those that differ from one of them in one predictor's value."""

    bins: np.ndarray  # of all of them, once each
    own: np.ndarray  # where the block's distinct rows are among them
    group: np.ndarray  # which distinct row each row of the block is
    changed: list[np.ndarray]  # per predictor, by distinct row and value: which row it becomes

    @staticmethod
    def of(bins: np.ndarray) -> Neighbours | None:
        """None where they would be more than the rows."""
        n, width = bins.shape
        if not n:
            return None
        first, group = distinct(list(bins.T))
        sizes = bins.max(axis=0).astype(np.int64) + 1
        if len(first) * int(sizes.sum()) > n:
            return None
        own, made = bins[first], [bins[first]]
        for feature, size in enumerate(sizes.tolist()):
            rows = np.repeat(own, size, axis=0)
            rows[:, feature] = np.tile(np.arange(size, dtype=np.uint8), len(own))
            made.append(rows)
        every = np.concatenate(made)
        at, of = distinct(list(every.T))
        ends = np.cumsum([len(m) for m in made]).tolist()
        changed = [of[a:b].reshape(len(own), -1) for a, b in pairwise(ends)]
        return Neighbours(every[at], of[: len(own)], group, changed)


def outside_bags(chunks: DataFrame, pieces: DataFrame, growth: Growth) -> DataFrame:
    """(feature, loss): the mean over trees of the accuracy lost on the rows outside a tree's bag when one predictor's
    values are shuffled among them (inside slices of rows). A predictor that a tree does not use costs it nothing."""

    def work(trees: Iterator[tuple[int, Tree]], block: Rows, number: int) -> Iterator[pa.RecordBatch]:
        block = block.where(block.trains(growth.split))
        columns, y = np.ascontiguousarray(block.bins.T), block.y > 0
        near = Neighbours.of(block.bins)
        out = []
        for t, tree in trees:
            out_of = np.flatnonzero(bag(block.ids, growth.seed, t) == 0)
            n, yes = len(out_of), y[out_of]
            if near is None:
                bins = block.bins[out_of]
                said = tree.shares(bins) * 2 > ONE
            else:
                group, says = near.group[out_of], tree.shares(near.bins) * 2 > ONE
                said = says[near.own][group]
            right = int((said == yes).sum())
            out.append((t, -1, 0, n))
            for feature in np.unique(tree.feature[tree.feature >= 0]).tolist():
                rng = np.random.default_rng([growth.seed, t, number, feature])
                mixed = rng.permutation(columns[feature][out_of])
                if near is None:  # only rows whose value is another one may get to another leaf
                    other = np.flatnonzero(mixed != bins[:, feature])
                    rows = bins[other]
                    rows[:, feature] = mixed[other]
                    now = right + int(((tree.shares(rows) * 2 > ONE) == yes[other]).sum()) - int((said[other] == yes[other]).sum())
                else:
                    changed = near.changed[feature]
                    now = int((says[changed].reshape(-1)[group * changed.shape[1] + mixed] == yes).sum())
                out.append((t, feature, right - now, 0))
        columns = [pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "feature", "lost", "n"])

    met = _meet(chunks, pieces, growth.trees, work, "tree int, feature int, lost bigint, n bigint")
    sums = met.groupBy("tree", "feature").agg(F.sum("lost").alias("lost"), F.sum("n").alias("n"))
    # A window over the few sums: joined with themselves, all rows would meet the trees twice.
    sums = sums.withColumn("size", F.max(F.when(F.col("feature") < 0, F.col("n"))).over(Window.partitionBy("tree")))
    return sums.where("feature >= 0 AND size > 0").groupBy("feature").agg((F.sum(F.col("lost") / F.col("size")) / growth.trees).alias("loss"))


def impurity(pieces: DataFrame, width: int) -> list[float]:
    """Mean fall of impurity per predictor over the trees, added up where the pieces are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gains in batch.column("gains").to_pylist():
                found = np.frombuffer(gains, np.float64)
                at = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], names=["feature", "gain"])

    rows = pieces.select("gains").mapInArrow(run, "feature int, gain double").groupBy("feature").agg(F.sum("gain").alias("gain")).collect()
    found = {r["feature"]: r["gain"] for r in rows}
    return [found.get(i, 0.0) for i in range(width)]
