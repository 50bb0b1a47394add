"""Forests: trees grown by one task, by all tasks together, and by plain recursion are the same."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from padronix.operators import forest, models
from padronix.operators.forest import HELD, Growth, Rows

N, WIDTH, BINS = 900, 5, 6


def made_rows() -> Rows:
    rng = np.random.default_rng(3)
    bins = rng.integers(0, BINS, (N, WIDTH)).astype(np.uint8)
    bins[:, 4] = bins[:, 4] > 2
    y = ((bins[:, 0] > 2) ^ (rng.random(N) < 0.2)).astype(np.int64)
    fold = rng.integers(0, 2, N)
    part = np.where(fold == 0, 1 << HELD, 1).astype(np.int32) | np.int32(2)
    return Rows(rng.integers(-(1 << 62), 1 << 62, N), y, part, bins)


@pytest.fixture(scope="module")
def chunks(spark):
    r = made_rows()
    rows = [(int(i), int(y), int(p), b.tobytes()) for i, y, p, b in zip(r.ids, r.y, r.part, r.bins, strict=True)]
    table = spark.createDataFrame(rows, "id bigint, y int, part int, bins binary").repartition(3)
    return forest.pack(table, 100).cache()


GROWTHS = [Growth(0, 3, 30, 12, 7, BINS), Growth(1, 2, 30, 4, 7, BINS, keep=True), Growth(1, 5, 3, 30, 8, BINS, keep=True)]


def by_recursion(r: Rows, g: Growth, tree: int) -> dict[int, tuple]:
    """{heap: (feature, cut, share)} of one tree, node by node."""
    weight = np.where(r.trains(g.split), forest.bag(r.ids, g.seed, tree), 0)
    out = {}

    def gini(w, y):
        n, p = w.sum(), (w * y).sum()
        return 2 * p * (n - p) / n if n else 0.0

    def node(heap, mask):
        w, y = weight[mask], r.y[mask]
        n, p = int(w.sum()), int((w * y).sum())
        best = None
        if 0 < p < n and heap < 1 << g.depth:
            for feature in forest.tried(np.array([heap]), g, forest.node_keys(g, [tree]), WIDTH)[0].tolist():
                for cut in range(BINS - 1):
                    left = r.bins[mask, feature] <= cut
                    if 0 < w[left].sum() < n:
                        gain = gini(w, y) - gini(w[left], y[left]) - gini(w[~left], y[~left])
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-6):
                            best = (gain, feature, cut)
        out[heap] = (best[1], best[2], 0) if best else (-1, 0, (p * forest.ONE + n // 2) // n)
        if best:
            right = r.bins[:, best[1]] > best[2]
            node(2 * heap, mask & ~right)
            node(2 * heap + 1, mask & right)

    node(1, np.ones(len(r.y), bool))
    return out


def pieces_of(grown) -> dict:
    out: dict = {}
    for row in grown.where("heap IS NOT NULL").collect():
        nodes = forest._unpacked(row.asDict())
        for h, f, c, s in zip(*(nodes[k].tolist() for k in ("heap", "feature", "cut", "share")), strict=True):
            out.setdefault((row.fit, row.tree), {})[h] = (f, c, s if f < 0 else 0)
    return out


def votes_of(grown) -> dict:
    return {(r.fit, r.id): (r.y, round(r.score, 12)) for r in forest.held_out_scores(grown).collect()}


@pytest.mark.parametrize("local_rows", [1_000_000, 100, 7], ids=["one task", "large nodes", "very large"])
def test_trees_equal_plain_recursion(spark, chunks, tmp_path, monkeypatch, local_rows):
    monkeypatch.setattr(forest, "MOST_TASKS", 8)
    monkeypatch.setattr(forest, "OPEN_NODES", 100)
    r = made_rows()
    counts = [int(r.trains(g.split).sum()) for g in GROWTHS]
    grown = forest.grow_forests(chunks, GROWTHS, counts, WIDTH, f"file://{tmp_path}/g", local_rows)
    got = pieces_of(grown)
    assert set(got) == {(1, t) for t in range(30)} | {(2, t) for t in range(3)}
    for f, t in [(1, 0), (1, 17), (2, 0), (2, 2)]:
        assert got[f, t] == by_recursion(r, GROWTHS[f], t)
    votes = votes_of(grown)
    held = np.flatnonzero(r.held(0))
    assert set(votes) == {(0, int(r.ids[i])) for i in held}
    trees = [forest.Tree([{c: np.array(v) for c, v in zip(("heap", "feature", "cut", "share"), zip(*((h, *x) for h, x in by_recursion(r, GROWTHS[0], t).items()), strict=True), strict=True)}]) for t in range(30)]
    want = sum(t.shares(r.bins[held]) for t in trees) / (30 * forest.ONE)
    assert [votes[0, int(r.ids[i])] for i in held] == [(int(r.y[i]), round(float(s), 12)) for i, s in zip(held, want, strict=True)]
    found = forest.impurity(grown.where("heap IS NOT NULL AND fit = 1"), WIDTH)
    assert np.argmax(found) == 0
    assert found == pytest.approx(forest.impurity(forest.grow_forests(chunks, GROWTHS[1:2], counts[1:2], WIDTH, f"file://{tmp_path}/o"), WIDTH))


def test_scores_and_losses_equal_brute_force(spark, chunks, tmp_path):
    r, g = made_rows(), GROWTHS[1]
    pieces = forest.grow_forests(chunks, [g], [N], WIDTH, f"file://{tmp_path}/p").where("heap IS NOT NULL")
    trees = forest.trees_of(x.asDict() for x in pieces.collect())
    rows = spark.createDataFrame([(b.tobytes(),) for b in r.bins], "bins binary")
    found = {bytes(x.bins): x.score for x in forest.scores(rows, pieces, g.trees, f"file://{tmp_path}/s").collect()}
    want = sum(t.shares(r.bins) for t in trees.values()) / (g.trees * forest.ONE)
    assert [found[b.tobytes()] for b in r.bins] == pytest.approx(want.tolist())

    order = np.concatenate([np.frombuffer(c.ids, np.int64) for c in chunks.collect()])
    whole = Rows.of([c.asDict() for c in chunks.collect()])
    assert sorted(order.tolist()) == sorted(r.ids.tolist())
    lost = {x.feature: x.loss for x in forest.outside_bags(chunks, pieces, g).collect()}
    sizes, total = [], np.zeros(WIDTH)
    rng = np.random.default_rng(9)
    for t, tree in trees.items():
        outside = forest.bag(whole.ids, g.seed, t) == 0
        bins, y = whole.bins[outside], whole.y[outside]
        sizes.append(len(y))
        right = ((tree.shares(bins) * 2 > forest.ONE) == y).mean()
        for j in range(WIDTH):
            drops = []
            for _ in range(20):
                mixed = bins.copy()
                mixed[:, j] = rng.permutation(bins[:, j])
                drops.append(right - ((tree.shares(mixed) * 2 > forest.ONE) == y).mean())
            total[j] += np.mean(drops) / g.trees
    assert 0.33 < np.mean(sizes) / N < 0.41  # 1 / e
    assert [lost.get(j, 0.0) for j in range(WIDTH)] == pytest.approx(total.tolist(), abs=0.02)
    assert lost[0] > 0.2 and all(abs(lost.get(j, 0.0)) < 0.03 for j in range(1, WIDTH))


def test_bags_and_tried_predictors_are_fair():
    ids = np.arange(200_000)
    drawn = forest.bag(ids, 1, 0)
    assert abs(drawn.mean() - 1) < 0.02 and abs((drawn == 0).mean() - np.exp(-1)) < 0.01 and drawn.max() > 4
    assert abs(np.corrcoef(drawn, forest.bag(ids, 1, 1))[0, 1]) < 0.02
    g = Growth(0, 3, 1, 30, 1, 32)
    some = forest.tried(np.arange(1, 20_001), g, forest.node_keys(g, [0]).repeat(20_000), 10)
    share = np.bincount(some.reshape(-1), minlength=10) / 20_000
    assert (np.diff(some, axis=1) > 0).all() and abs(share - 0.3).max() < 0.02


def test_a_forest_learns_ranks_and_survives_saving(spark, tmp_path):
    df = spark.range(1500).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("x"), (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000).alias("noise"),
        F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 2 + 1).cast("int")).alias("kind"),
    )
    df = df.withColumn("y", F.when(F.col("x") > 0.7, "yes").otherwise("no"))
    spec = models.Spec(
        label="y", positive="yes", categorical=("kind",), numeric=("x", "noise"), key=("id",), folds=2, forest={"numTrees": 20, "maxDepth": 8}, mtry=(1, 3)
    )
    model = models.fit_forest(df, spec)
    assert {(r.candidate, r.fold) for r in model.cv.collect()} == {(f"mtry={m}", f) for m in (1, 3) for f in (0, 1)}
    for table in (models.impurity_importance(model), models.out_of_bag_importance(model)):
        top = table.collect()
        assert top[0].variable == "x" and top[0].importance == 100 and all(r.importance < 10 for r in top[1:])
    scored = model.score(df)
    assert scored.count() == 1500 and scored.where("predicted = y").count() > 1470 and set(df.columns) < set(scored.columns)
    models.save_model(model, str(tmp_path / "f"))
    again = models.load_model(spark, str(tmp_path / "f"))
    assert again.score(df).exceptAll(scored).count() == 0
    with pytest.raises(ValueError):
        models.out_of_bag_importance(again)


def test_forests_of_groups_equal_those_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(forest, "SLAB_ROWS", 150)
    monkeypatch.setattr(forest, "PIECE_GROUPS", 7)
    monkeypatch.setattr(forest, "GROUPS", 40)
    r = made_rows()
    r.bins[:, 1:4] //= 3  # so that many rows are equal
    rows = [(int(i), int(y), int(p), b.tobytes()) for i, y, p, b in zip(r.ids, r.y, r.part, r.bins, strict=True)]
    rows += rows[:30]  # some ids come twice
    chunks = forest.pack(spark.createDataFrame(rows, "id bigint, y int, part int, bins binary").repartition(3), 100).cache()
    growths = [*GROWTHS, Growth(0, 2, 7, 3, 7, BINS)]
    counts = [int(r.trains(g.split).sum()) for g in growths]
    mine = forest.grow_groups(chunks, growths, WIDTH, f"file://{tmp_path}/g")
    assert pieces_of(mine) == pieces_of(forest.grow_forests(chunks, growths, counts, WIDTH, f"file://{tmp_path}/r"))
    scores = {(x.fit, x.id): (x.y, round(x.score, 12)) for x in forest.held_out_group_scores(mine, chunks, growths, WIDTH).collect()}
    assert scores == votes_of(forest.grow_forests(chunks, growths, counts, WIDTH, f"file://{tmp_path}/v"))
    assert forest.count_groups(chunks, growths) == 41  # more than the limit
    bits = r.part & np.bitwise_or(*forest._mask(growths))
    assert forest.count_groups(chunks, growths, 10_000) == len({(y, p, b.tobytes()) for y, p, b in zip(r.y, bits, r.bins, strict=True)})


def test_groups_of_many_wide_columns_are_told_apart():
    rng = np.random.default_rng(1)
    table = rng.integers(0, 255, (400, 30))
    table = np.concatenate((table, table[:150]))
    first, of = forest.distinct(list(table.T))
    assert len(first) == 400 and (table[first][of] == table).all()


def test_a_leaf_of_any_size_is_no_task(spark, tmp_path):
    """Rows that one threshold decides: the leaves are known when the root is split, and no task gets all their rows."""
    n = 2000
    rng = np.random.default_rng(5)
    bins = np.stack((np.arange(n) % 2, rng.integers(0, BINS, n)), axis=1).astype(np.uint8)
    part = np.where(np.arange(n) % 3 == 0, 1 << HELD, 1).astype(np.int32)
    rows = [(int(i), int(b[0]), int(p), b.tobytes()) for i, b, p in zip(rng.integers(0, 1 << 62, n), bins, part, strict=True)]
    chunks = forest.pack(spark.createDataFrame(rows, "id bigint, y int, part int, bins binary").repartition(3), 50).cache()
    growths = [Growth(0, 2, 4, 5, 1, BINS)]
    grown = forest.grow_forests(chunks, growths, [int((part == 1).sum())], 2, f"file://{tmp_path}/g", 100)
    assert max(len(x.held) for x in grown.where("votes IS NOT NULL").collect()) <= 50
    assert {(x.y, x.score) for x in forest.held_out_scores(grown).collect()} == {(0, 0.0), (1, 1.0)}


def test_a_model_is_the_same_from_groups_and_from_rows(spark, monkeypatch):
    df = spark.range(800).selectExpr("id", "cast(id % 7 as double) x", "cast(id % 3 as double) z", "if(id % 7 + id % 5 > 5, 'yes', 'no') y")
    spec = models.Spec(label="y", positive="yes", numeric=("x", "z"), key=("id",), folds=2, forest={"numTrees": 6, "maxDepth": 5}, mtry=(1, 2))
    rows = forest.grow_forests
    monkeypatch.setattr(forest, "grow_forests", None)
    groups = models.fit_forest(df, spec)
    monkeypatch.setattr(forest, "grow_forests", rows)
    monkeypatch.setattr(forest, "GROUPS", 3)
    one = models.fit_forest(df, spec)
    found, want = ({(r.candidate, r.fold): r.auc for r in m.cv.collect()} for m in (groups, one))
    assert found == pytest.approx(want)
    assert groups.score(df).exceptAll(one.score(df)).count() == 0
    assert models.impurity_importance(groups).collect() == models.impurity_importance(one).collect()


def test_large_rows_are_written_and_read_a_few_at_a_time(spark, tmp_path):
    import glob

    import pyarrow as pa
    import pyarrow.parquet as pq

    from padronix.operators.shared import written

    rows = spark.range(0, 400, 1, 1).selectExpr("repeat(cast(id AS string), 60000) AS chunk")
    out = written(rows, str(tmp_path / "chunks"), large_rows=True)
    assert out.count() == 400
    (file,) = glob.glob(str(tmp_path / "chunks" / "*.parquet"))
    groups = [pq.ParquetFile(file).metadata.row_group(i) for i in range(pq.ParquetFile(file).num_row_groups)]
    assert max(g.total_byte_size for g in groups) < 24 << 20 and {g.column(0).compression for g in groups} == {"UNCOMPRESSED"}
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([b"a", None], pa.binary())], names=["unit", "y"])
    assert next(forest._rows(batch)) == batch.to_pylist()[0] and list(forest._rows(batch)) == batch.to_pylist()
    assert forest.SLAB_ROWS <= 500_000


def losses_by_copies(chunks, pieces, g) -> dict:
    """Losses outside the bags, as one slice of all rows, from copies of the rows with one column shuffled."""
    block = Rows.of([c.asDict() for c in chunks.collect()])
    block = block.where(block.trains(g.split))
    lost: dict = {}
    for t, tree in forest.trees_of(x.asDict() for x in pieces.collect()).items():
        out_of = np.flatnonzero(forest.bag(block.ids, g.seed, t) == 0)
        bins, y = block.bins[out_of], block.y[out_of]
        right = ((tree.shares(bins) * 2 > forest.ONE) == (y > 0)).sum()
        for j in np.unique(tree.feature[tree.feature >= 0]).tolist():
            mixed = bins.copy()
            mixed[:, j] = bins[np.random.default_rng([g.seed, t, 0, j]).permutation(len(y)), j]
            now = ((tree.shares(mixed) * 2 > forest.ONE) == (y > 0)).sum()
            lost[j] = lost.get(j, 0) + (int(right) - int(now)) / len(y) / g.trees
    return lost


@pytest.mark.parametrize("few", [True, False], ids=["few distinct rows", "many"])
def test_losses_equal_shuffled_copies_and_rows_meet_trees_once(spark, tmp_path, few):
    r, g = made_rows(), GROWTHS[1]
    if few:
        r.bins[:, :4] %= 2
    assert (forest.Neighbours.of(r.bins) is not None) == few
    rows = [(int(i), int(y), int(p), b.tobytes()) for i, y, p, b in zip(r.ids, r.y, r.part, r.bins, strict=True)]
    packed = forest.pack(spark.createDataFrame(rows, "id bigint, y int, part int, bins binary").coalesce(1), N)
    chunks = forest.written(packed, f"file://{tmp_path}/c")
    pieces = forest.grow_forests(chunks, [g], [N], WIDTH, f"file://{tmp_path}/p").where("heap IS NOT NULL")
    losses = forest.outside_bags(chunks, pieces, g)
    assert losses._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # twice when sums were joined with themselves
    assert {x.feature: x.loss for x in losses.collect()} == pytest.approx(losses_by_copies(chunks, pieces, g))
