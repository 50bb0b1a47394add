"""Vector codes against plain integer k-means, and the trees behind them."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from padronix.llm import codes
from padronix.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, code int, error string, cell int, ids int"


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, digest) by comparing every part with every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    width = -(-max(1, *(len(r[1]) for r in kept)) // parts) * parts
    size = width // parts
    bound = codes.largest(width)
    whole = [[max(-bound, min(bound, math.floor(4096 * float(np.float32(x))))) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, list(map(np.float32, kept[i][1]))))
    cut = [[w[p * size : (p + 1) * size] for p in range(parts)] for w in whole]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own, strict=True) if o == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(g for g, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label: dict = {}
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [(r[0], "".join(f"{e:02x}" for _, e in f), g, by_label[r[2]], digest) for r, f, g in zip(kept, found, error, strict=True)]


def vectors(n: int, seed: int = 1, width: int = 24) -> list[tuple]:
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.2) for _ in range(width)] for _ in range(7)]
    return [(i, [m + rng.gauss(0, 0.05) for m in rng.choice(middles)], i % 3 or None, "v", 1, "e", 2, 3) for i in range(n)]


def odd_vectors() -> list[tuple]:
    """Nulls, missing and infinite components, copies, repeated and null ids, other lengths, empty and huge ones."""
    rows = vectors(40)
    same = [(100 + i, [0.25] * 24, 1, "v", 1, "e", 2, 3) for i in range(60)]
    short = [(300, [0.5, -0.5], 1), (301, [], 2), (302, [1e30, -1e30] * 12, 2), (303, [0.1] * 30, None), (None, [0.3] * 24, 1), (5, [0.1] * 24, 1)]
    bad = [(400, None, 1), (401, [0.1, None], 1), (402, [float("nan")] * 24, 1), (0, [float("inf")] * 24, 1)]
    return rows + rows[:5] + same + [(*r, "v", 1, "e", 2, 3) for r in short + bad]


def run(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)
    return sorted(map(tuple, codes.compress(table, **options).collect()), key=repr)


@pytest.mark.parametrize("rows", [odd_vectors(), vectors(9), vectors(600, 2), vectors(300) + vectors(300)], ids=["odd", "few", "groups", "repeated"])
def test_codes_equal_plain_k_means(spark, rows):
    assert run(spark, rows) == sorted(plain(rows), key=repr)


def test_tiny_chunks_and_leaves(spark, monkeypatch):
    rows = vectors(200, 3)
    monkeypatch.setattr(codes, "CHUNK_ROWS", 17)
    assert run(spark, rows, parts=3, entries=5, rounds=4) == sorted(plain(rows, 3, 5, 4), key=repr)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [r for r in odd_vectors() if r[0] in (400, 401, 402)]) == []


def test_a_single_row(spark):
    assert run(spark, vectors(1)) == plain(vectors(1))


def test_trees_hold_all_points_and_bound_them():
    rng = np.random.default_rng(4)
    points = np.concatenate((rng.integers(-2000, 2000, (700, 8)), np.full((300, 8), 7), rng.normal(900, 10, (500, 8)).astype(int)))
    tree = codes.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    rows = np.array(tree.rows)
    assert tuple(rows[-1, :2]) == (0, len(points))
    for (low, high, left, right), total, centre, radius in zip(tree.rows, tree.sums, tree.centres, tree.radii, strict=True):
        mine = points[tree.order[low:high]]
        assert (mine.sum(axis=0) == total).all() and np.sqrt(((mine - centre) ** 2).sum(axis=1)).max() <= radius + 1e-6
        if left >= 0:
            assert (rows[left, 0], rows[left, 1], rows[right, 1]) == (low, rows[right, 0], high)
        else:
            assert high - low <= codes.LEAF or len(np.unique(mine, axis=0)) == 1


def test_balls_are_owned_whole_and_exactly():
    rng = np.random.default_rng(5)
    middles = rng.integers(-3000, 3000, (16, 8))
    points = middles[rng.integers(0, 16, 4000)] + rng.integers(-60, 60, (4000, 8))
    tree = codes.Tree(points)
    books = np.concatenate((middles[:15], middles[:1]))  # the last entry equals the first: it owns nothing
    runs = list(codes.owners(np.array(tree.rows), np.column_stack((np.array(tree.centres), tree.radii)), tree.order, points, books))
    found = np.full(4000, -1)
    for low, high, entry in runs:
        found[tree.order[low:high]] = entry
    assert (found == ((points[:, None] - books[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    whole = sum(high - low for low, high, entry in runs if isinstance(entry, int))
    assert whole > 2000 and sum(isinstance(r[2], int) for r in runs) < whole / 10


def test_query_equals_sql(spark):
    found = QUERIES["op11_anchor_codes"](spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.sql("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.sql(ORACLE_SQL["op11_anchor_codes"])
    assert sorted(map(tuple, found.select(*want.columns).collect())) == sorted(want.fetchall())
