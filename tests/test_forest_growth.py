"""Trees grown from packed words, run by run of nodes, equal those of plain counts per node."""

import numpy as np
import pyarrow as pa
import pytest

from padronix.operators import forest, grower
from padronix.operators.forest import Codes, Growth


def by_counts(bins, weight, positive, g, tree):
    """{heap: (feature, cut, share)} and the gains of one tree, node by node."""
    width, out, gains = bins.shape[1], {}, np.zeros(bins.shape[1])
    todo = [(1, np.arange(len(bins)))]
    while todo:
        heap, rows = todo.pop()
        w, p = weight[rows], positive[rows]
        n, feature, cut = int(w.sum()), -1, 0
        if 0 < p.sum() < n and heap < 1 << g.depth:
            features = forest.tried(np.array([heap]), g, forest.node_keys(g, [tree]), width)
            used = np.flatnonzero(w)
            counts = forest.counts_of(bins, rows[used], w[used], p[used], np.zeros(len(used), np.int64), features, g.bins)
            feature, cut, gain = (x[0] for x in forest.best_splits(counts, features))
        out[heap] = (int(feature), int(cut), (int(p.sum()) * forest.ONE + n // 2) // max(n, 1))
        if feature >= 0:
            gains[feature] += gain
            right = bins[rows, feature] > cut
            todo += [(2 * heap, rows[~right]), (2 * heap + 1, rows[right])]
    return out, gains


@pytest.mark.parametrize("width, runs, joint", [(6, 1 << 17, 26), (6, 16, 26), (40, 16, 3)], ids=["levels", "runs", "words and separate sums"])
def test_runs_of_nodes_equal_plain_counts(monkeypatch, width, runs, joint):
    monkeypatch.setattr(forest, "FRONT_ROWS", runs)
    monkeypatch.setattr(forest, "JOINT", joint)
    rng = np.random.default_rng(width)
    n = 700
    bins = rng.integers(0, rng.choice([1, 2, 5, 11, 32], width), (n, width)).astype(np.uint8)
    y = (rng.random(n) < 0.3 + 0.4 * (bins[:, -1] > 0)).astype(np.int64)
    fold = rng.integers(0, 3, n)
    ids = rng.integers(-(1 << 62), 1 << 62, n)
    codes = Codes.of(bins)
    assert len(codes.words) == (1 if width == 6 else 2)
    g = Growth(0, 3, 4, 9, 5, 32, keep=True)
    nodes, gains, votes = forest.grow(codes, y, fold > 0, fold == 0, ids, g, [0, 2, 3])
    total = 0
    for t, found, gain in zip([0, 2, 3], nodes, gains, strict=True):
        weight = np.where(fold > 0, forest.bag(ids, g.seed, t), 0)
        want, want_gain = by_counts(bins, weight, weight * y, g, t)
        got = dict(zip(found["heap"].tolist(), zip(*(found[c].tolist() for c in ("feature", "cut", "share")), strict=True), strict=True))
        assert got == want and gain == pytest.approx(want_gain) and found["heap"].tolist() == sorted(want)
        total = total + forest.Tree([found]).shares(bins[fold == 0])
    assert votes.tolist() == total.tolist()
    few = Growth(0, 3, 4, 9, 5, 32)
    nodes, gains, again = forest.grow(codes, y, fold > 0, fold == 0, ids, few, [0, 2, 3])
    assert not nodes and not gains and again.tolist() == votes.tolist()
    none = forest.grow(Codes.of(bins[:0]), y[:0], fold[:0] > 0, fold[:0] == 0, ids[:0], g, [0])
    assert none[0][0]["heap"].tolist() == [1] and none[0][0]["feature"].tolist() == [-1] and not len(none[2])


def test_a_predictor_is_counted_in_its_own_bins(monkeypatch):
    """Predictors of two values took as many counts per node as those of 256."""
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 2, (500, 12)).astype(np.uint8)
    y, ids = rng.integers(0, 2, 500), rng.integers(0, 1 << 62, 500)
    cells, plain = [], np.bincount
    monkeypatch.setattr(forest.np, "bincount", lambda x, weights=None, minlength=0: cells.append(minlength) or plain(x, weights, minlength))
    g = Growth(0, 4, 1, 1, 3, 256)
    everything = np.ones(500, bool)
    forest.grow(Codes.of(bins), y, everything, ~everything, ids, g, [0])
    assert 0 < sum(cells) <= 2 * 4


@pytest.mark.parametrize("sizes, depth, mtry", [([32, 32, 11, 9, 2, 2, 1], 30, 3), ([32] * 40, 6, 7), ([256, 3], 60, 5)], ids=["a word", "words", "all tried"])
def test_the_compiled_function_grows_the_same_trees(spark, tmp_path, monkeypatch, sizes, depth, mtry):
    """Trees, gains and votes, of whole trees and of small nodes below large ones; before there was numpy alone."""
    assert grower.registered(spark) == grower.NAME
    rng = np.random.default_rng(depth)
    n = 1500
    bins = np.stack([rng.integers(0, k, n) for k in sizes], axis=1).astype(np.uint8)
    y = (rng.random(n) < 0.3 + 0.4 * (bins[:, 0] > sizes[0] // 2)).astype(np.int64)
    part = np.where(rng.random(n) < 0.2, 1 << forest.HELD, 1).astype(np.int32) | np.int32(2)
    rows = forest.Rows(rng.integers(-(1 << 62), 1 << 62, n), y, part, bins)
    packed = [rows.where(np.arange(n) % 3 == k).packed() for k in range(3)]
    chunks = spark.createDataFrame(pa.Table.from_batches([forest._batch(packed, forest.CHUNK)]), schema=forest.CHUNK)
    growths = [Growth(0, mtry, 5, depth, 5, 256), Growth(1, mtry, 5, depth, 6, 256, keep=True)]
    monkeypatch.setattr(forest, "KEPT_ROWS", 2 * n)

    def found(compiled, local_rows):
        grown = forest.grow_forests(chunks, growths, [n, n], len(sizes), f"file://{tmp_path}/{compiled}{local_rows}", local_rows, compiled).collect()
        nodes = {(r.fit, r.tree): [bytes(x) for x in (r.heap, r.feature, r.cut, r.share, r.gains)] for r in grown if r.heap is not None and local_rows >= n}
        votes = np.zeros((n, 2), np.int64)
        place = {int(i): k for k, i in enumerate(rows.ids)}
        for r in grown:
            if r.votes is not None:
                at = [place[i] for i in np.frombuffer(r.id, np.int64).tolist()]
                assert np.frombuffer(r.held, np.uint8).tolist() == y[at].tolist()
                votes[at] += np.stack([np.frombuffer(r.votes, np.int64), np.full(len(at), r.n_trees)], axis=1)
        return nodes, votes.tolist()

    whole = found(True, n)
    assert whole == found(False, n) and len(whole[0]) == 5
    assert found(True, 300)[1] == whole[1]


def test_too_much_for_the_compiled_function_is_grown_by_numpy(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(2)
    rows = forest.Rows(rng.integers(0, 1 << 62, 200), rng.integers(0, 2, 200), np.full(200, 1, np.int32), rng.integers(0, 4, (200, 3)).astype(np.uint8))
    chunks = spark.createDataFrame(pa.Table.from_batches([forest._batch([rows.packed()], forest.CHUNK)]), schema=forest.CHUNK)
    g = [Growth(0, 2, 3, 30, 5, 4, keep=True)]
    want = sorted(map(str, forest.grow_forests(chunks, g, [200], 3, f"file://{tmp_path}/a").collect()))
    monkeypatch.setattr(grower, "MOST_BYTES", 10)
    assert sorted(map(str, forest.grow_forests(chunks, g, [200], 3, f"file://{tmp_path}/b").collect())) == want and len(want) == 3


def test_trees_are_unpacked_one_by_one(monkeypatch):
    """A task that meets many trees unpacked all of them at once."""
    one = {"heap": np.array([1, 2, 3]), "feature": np.array([0, -1, -1]), "cut": np.array([0, 0, 0]), "share": np.array([0, 0, forest.ONE])}
    rows = [forest._piece(0, t, one, np.zeros(1)) for t in (2, 0, 1)]
    unpacked, plain = [], forest._unpacked
    monkeypatch.setattr(forest, "_unpacked", lambda row: unpacked.append(row["tree"]) or plain(row))
    for t, tree in forest.each_tree(rows):
        assert unpacked == list(range(t + 1)) and tree.shares(np.array([[0], [1]], np.uint8)).tolist() == [0, forest.ONE]
