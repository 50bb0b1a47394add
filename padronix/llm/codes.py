"""Vector code compression: product codes by integer k-means over metric trees.

Vectors are cut into parts; each part position has a codebook. Rows are packed into chunks of a few thousand; a chunk
holds one metric tree per part position, built middle-out by the anchors hierarchy: anchors are picked farthest first
and steal the points nearer to them (the triangle inequality spares most distances), anchors that are too large are
divided again, and the smallest enclosing balls of pairs are merged upwards to one root. A ball caches the sum and count
of its points. In each round a ball inherits the entries that can still own any of its points, drops those that the
nearest one beats everywhere in the ball, and as soon as one is left the ball's sum and count go to it whole. Chunks are
written once; a round passes over them and returns one sum per codebook number. All results are exact: bounds decide
only where they are clear of rounding, and points of leaves are compared in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.llm.batches import bounded_batches, free_worker, materialize, shared_folder
from padronix.operators.sizing import join_table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
CHUNK_ROWS = 4096
CHUNK_VALUES = 1 << 20  # components of a chunk; longer vectors make chunks of fewer rows
LEAF = 64  # points of a ball that is not divided
MARGIN = 1e-9  # of the squared distances compared: far above their rounding errors

CHUNK = "ids array<bigint>, labels array<string>, points binary, perm binary, nodes binary, balls binary"
RESULT = "vec_id bigint, label string, code string, error bigint"

# ---------------------------------------------------------------- trees


class Tree:
    """Balls over points (n x d integers): `perm` lists the points so that every ball is a run of it.

    nodes has a row (low, high, left, right) per ball, children before parents and the root last; leaves have -1.
    sums caches the sum of a ball's points, balls its centre and radius.
    """

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.perm: list[np.ndarray] = []
        self.placed = 0
        self.rows: list[tuple[int, int, int, int]] = []
        self.sums: list[np.ndarray] = []
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self._divide(np.arange(len(points)))
        self.order = np.concatenate(self.perm).astype(np.int32)

    def _ball(self, members: np.ndarray, low: int, left: int, right: int) -> int:
        total = self.points[members].sum(axis=0)
        centre = total / len(members)
        gaps = self.points[members] - centre
        self.rows.append((low, low + len(members), left, right))
        self.sums.append(total)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(np.einsum("ij,ij->i", gaps, gaps).max())))
        return len(self.rows) - 1

    def _divide(self, members: np.ndarray) -> int:
        """The ball of these points; more than LEAF points get anchors, whose balls are merged pair by pair."""
        groups = self._anchors(members) if len(members) > LEAF else [members]
        if len(groups) == 1:
            low, self.placed = self.placed, self.placed + len(members)
            self.perm.append(members)
            return self._ball(members, low, -1, -1)
        # The order of merging decides the order of the points, so merges are planned on the anchors' balls first.
        centres = np.array([self.points[g].mean(axis=0) for g in groups])
        sizes = np.array([len(g) for g in groups], float)
        radii = np.array([np.sqrt(((self.points[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centres, strict=True)])
        return self._build(_merges(centres, radii, sizes), groups)

    def _build(self, plan: list, groups: list[np.ndarray]) -> int:
        """Balls of a plan of merges, children first, without recursion over the merges."""
        done: list[tuple[int, np.ndarray]] = []
        stack = [(plan, False)]
        while stack:
            item, ready = stack.pop()
            if isinstance(item, int):
                node = self._divide(groups[item])
                done.append((node, groups[item]))
            elif not ready:
                stack += [(item, True), (item[1], False), (item[0], False)]
            else:
                (right, b), (left, a) = done.pop(), done.pop()
                members = np.concatenate((a, b))
                done.append((self._ball(members, self.rows[left][0], left, right), members))
        return done[0][0]

    def _anchors(self, members: np.ndarray) -> list[np.ndarray]:
        """The square root of so many groups, each of the points nearest to its anchor; fewer if points are equal."""
        x = self.points[members]
        owner = np.zeros(len(x), np.int64)
        gap = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
        anchors = [0]
        while len(anchors) < int(np.sqrt(len(x))):
            far = int(gap.argmax())
            if gap[far] == 0:
                break
            between = np.sqrt(((x[anchors] - x[far]) ** 2).sum(axis=1))
            near = np.flatnonzero(gap > between[owner] / 2)  # others are nearer to their own anchor
            new = np.sqrt(((x[near] - x[far]) ** 2).sum(axis=1))
            stolen = new < gap[near]
            owner[near[stolen]], gap[near[stolen]] = len(anchors), new[stolen]
            anchors.append(far)
        by_owner = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[by_owner], np.arange(len(anchors) + 1))
        return [members[by_owner[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]


def _merges(centres: np.ndarray, radii: np.ndarray, sizes: np.ndarray) -> list | int:
    """Nested pairs of group numbers: again and again the two balls whose common ball is smallest."""
    plans: list = list(range(len(radii)))
    centres, radii, sizes = centres.copy(), radii.copy(), sizes.copy()

    def common(i: int) -> np.ndarray:
        between = np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
        return np.maximum((between + radii + radii[i]) / 2, np.maximum(radii, radii[i]))

    table = np.array([common(i) for i in range(len(plans))])
    np.fill_diagonal(table, np.inf)
    for _ in range(len(plans) - 1):
        i, j = divmod(int(table.argmin()), len(plans))
        radii[i] = table[i, j]
        centres[i] = (centres[i] * sizes[i] + centres[j] * sizes[j]) / (sizes[i] + sizes[j])
        sizes[i] += sizes[j]
        plans[i] = [plans[i], plans[j]]
        table[j, :] = table[:, j] = np.inf
        gone = np.isinf(table[i])
        table[i] = common(i)
        table[i, gone] = np.inf
        table[:, i] = table[i]
    return plans[i] if len(plans) > 1 else plans[0]


# ---------------------------------------------------------------- ownership


def owners(nodes: np.ndarray, balls: np.ndarray, perm: np.ndarray, points: np.ndarray, codebook: np.ndarray) -> Iterator[tuple[int, int, object]]:
    """Runs (low, high, entry) of `perm` that one entry owns whole; for points of leaves `entry` is an array.

    nodes: (low, high, left, right); balls: centre and radius. Of equal entries only the first can own anything.
    """
    k = len(codebook)
    book = codebook.astype(np.float64)
    apart = np.sqrt(((book[:, None] - book[None]) ** 2).sum(axis=2))
    distinct = np.array([not any((codebook[i] == codebook[j]).all() for j in range(i)) for i in range(k)])
    front = np.array([len(nodes) - 1])
    lists = distinct[None, :]
    while len(front):
        gaps = ((balls[front, None, :-1] - book[None]) ** 2).sum(axis=2)
        best = np.where(lists, gaps, np.inf).argmin(axis=1)
        least = np.take_along_axis(gaps, best[:, None], axis=1)
        # Entry c is farther than the best one from every point of the ball.
        beaten = gaps - least > 2 * balls[front, -1:] * apart[best] + MARGIN * (gaps + least + 1)
        lists = lists & ~beaten
        single = lists.sum(axis=1) == 1
        leaf = ~single & (nodes[front, 2] < 0)
        for node, entry in zip(front[single].tolist(), best[single].tolist(), strict=True):
            yield int(nodes[node, 0]), int(nodes[node, 1]), entry
        for node, left in zip(front[leaf].tolist(), lists[leaf], strict=True):
            low, high = int(nodes[node, 0]), int(nodes[node, 1])
            can = np.flatnonzero(left)
            gap = points[perm[low:high], None] - codebook[can][None]
            yield low, high, can[np.einsum("ijk,ijk->ij", gap, gap).argmin(axis=1)]  # the first of equal ones
        inner = ~single & ~leaf
        front = nodes[front[inner], 2:].reshape(-1)
        lists = np.repeat(lists[inner], 2, axis=0)


class Chunk:
    """The trees of one stored row."""

    def __init__(self, row: dict, parts: int):
        self.n = len(row["ids"])
        self.points = np.frombuffer(row["points"], np.int32).reshape(self.n, -1).astype(np.int64)
        self.size = self.points.shape[1] // parts
        self.perm = np.frombuffer(row["perm"], np.int32).reshape(parts, self.n)
        nodes = np.frombuffer(row["nodes"], np.int64).reshape(-1, 5 + self.size)
        balls = np.frombuffer(row["balls"], np.float64).reshape(-1, self.size + 1)
        cuts = np.searchsorted(nodes[:, 0], np.arange(parts + 1))
        self.nodes = [nodes[a:b, 1:5] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.sums = [nodes[a:b, 5:] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.balls = [balls[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def part(self, p: int) -> np.ndarray:
        return self.points[:, p * self.size : (p + 1) * self.size]

    def add_sums(self, books: np.ndarray, totals: np.ndarray) -> None:
        """Add what each entry owns to `totals` (parts x entries x (count, sums))."""
        for p, book in enumerate(books):
            points, perm, nodes = self.part(p), self.perm[p], self.nodes[p]
            whole = {(int(a), int(b)): s for (a, b), s in zip(nodes[:, :2], self.sums[p], strict=True)}
            for low, high, entry in owners(nodes, self.balls[p], perm, points, book):
                if isinstance(entry, int):
                    totals[p, entry, 0] += high - low
                    totals[p, entry, 1:] += whole[low, high]
                else:
                    np.add.at(totals[p, :, 0], entry, 1)
                    np.add.at(totals[p, :, 1:], entry, points[perm[low:high]])

    def codes(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every point and part, and the squared distances summed over parts."""
        found = np.zeros((self.n, len(books)), np.uint8)
        error = np.zeros(self.n, np.int64)
        for p, book in enumerate(books):
            for low, high, entry in owners(self.nodes[p], self.balls[p], self.perm[p], self.part(p), book):
                found[self.perm[p][low:high], p] = entry
            error += ((self.part(p) - book[found[:, p]]) ** 2).sum(axis=1)
        return found, error


def largest(width: int) -> int:
    """Bound of a component, so that a vector's error fits 64 bits."""
    return int((2.0**62 / max(width, 1)) ** 0.5 / 2)


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of integers floor(SCALE * x), filled up with zeros to `width`."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * SCALE), -largest(width), largest(width)).astype(np.int32)


def _packed(ids: list, labels: list, points: np.ndarray, parts: int) -> dict:
    size = points.shape[1] // parts
    perm, nodes, balls = [], [], []
    for p in range(parts):
        tree = Tree(points[:, p * size : (p + 1) * size])
        perm.append(tree.order)
        head = np.column_stack((np.full(len(tree.rows), p), np.array(tree.rows)))
        nodes.append(np.concatenate((head, np.array(tree.sums).reshape(len(head), size)), axis=1).astype(np.int64))
        balls.append(np.column_stack((np.array(tree.centres).reshape(len(head), size), tree.radii)))
    return {
        "ids": ids, "labels": labels, "points": points.tobytes(), "perm": np.concatenate(perm).tobytes(),
        "nodes": np.concatenate(nodes).tobytes(), "balls": np.concatenate(balls).tobytes(),
    }


def _chunks(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """Rows (vec_id, label, vector) packed into chunks with their trees."""
    most = max(1, min(CHUNK_ROWS, CHUNK_VALUES // width))
    kinds = (pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 4)
    names = ["ids", "labels", "points", "perm", "nodes", "balls"]

    def record(ids: list, labels: list, points: np.ndarray) -> pa.RecordBatch:
        row = _packed(ids, labels, points, parts)
        return pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in zip(names, kinds, strict=True)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        ids, labels, held = [], [], []
        for batch in batches:
            points = whole_numbers(batch.column(2), width)
            ids += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            held.append(points)
            while len(ids) >= most:
                points = np.concatenate(held)
                yield record(ids[:most], labels[:most], points[:most])
                ids, labels, held = ids[most:], labels[most:], [points[most:]]
        if ids:
            yield record(ids, labels, np.concatenate(held))

    return kept.mapInArrow(run, CHUNK)


# ---------------------------------------------------------------- rounds


def _totals(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Count and sums of what each entry owns, over all chunks: as many numbers as the codebooks have, and counts."""
    parts, k, size = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, k, 1 + size), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                Chunk(row, parts).add_sums(books, totals)
        flat = totals.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], names=["cell", "total"])

    rows = chunks.mapInArrow(run, "cell int, total bigint").groupBy("cell").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(parts * k * (1 + size), np.int64)
    for r in rows:
        out[r["cell"]] = r["total"]
    return out.reshape(parts, k, 1 + size)


def fit_codebooks(chunks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x components) after `rounds` of assignment and means; unused entries stay."""
    for _ in range(rounds):
        totals = _totals(chunks, books)
        count, sums = totals[:, :, :1], totals[:, :, 1:]
        books = np.where(count > 0, sums // np.maximum(count, 1), books)  # // goes down
    return books


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row whose vector is not null and has only finite components.

    Vectors shorter than the longest, or than a multiple of `parts`, are filled up with zeros; empty ones are zeros
    throughout. Components are held to what keeps an error within 64 bits (32,768 either way at 64 components). Codebooks
    start from the rows of the smallest keys, null keys last, equal keys by vector; with fewer rows than `entries` there
    are fewer entries. Repeated rows are separate rows. label_error sums the errors of equal labels, nulls together; it is
    null beyond 64 bits. Without rows the result is empty. Other columns are not read. The driver holds the codebooks only.
    """
    if entries > 256:
        raise ValueError("a code has one byte per part")
    spark = vectors.sparkSession
    bounded_batches(spark)
    folder = shared_folder(spark)
    picked = vectors.select(
        F.col(key).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = picked.where(F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    empty = f"{key} bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    if longest is None:
        return spark.createDataFrame([], empty)
    width = -(-max(longest, 1) // parts) * parts
    start = whole_numbers(first.column(0).combine_chunks(), width).astype(np.int64)
    books = start.reshape(len(start), parts, width // parts).transpose(1, 0, 2)
    chunks = materialize(_chunks(kept, width, parts), folder, "chunks")
    books = fit_codebooks(chunks, books, rounds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, error = Chunk(row, parts).codes(books)
                digits = found.tobytes().hex()
                code = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
                columns = [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array(code), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    coded = materialize(chunks.mapInArrow(run, RESULT), folder, "codes")
    by_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    joined = join_table(coded, by_label, ["label"])
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return joined.select(F.col("vec_id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(rounds: int = ROUNDS, entries: int = ENTRIES, parts: int = PARTS) -> str:
    """DuckDB SQL for `compress`, over embeddings(vec_id, embedding, label) of distinct keys and one length."""
    text = f"""
WITH k AS (
  SELECT vec_id, label, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (len(e) // {parts}) AS part, (i - 1) % (len(e) // {parts}) AS pos, CAST(floor({SCALE} * e[i]) AS BIGINT) AS x
  FROM (SELECT vec_id, e, unnest(range(1, len(e) + 1)) AS i FROM k)),
c0 AS MATERIALIZED (
  SELECT part, entry, pos, x AS v
  FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT {entries}) USING (vec_id)),"""
    for r in range(rounds + 1):
        text += f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, part, min(gap * 256 + entry) AS best
  FROM (SELECT vec_id, part, entry, sum((x - v) * (x - v)) AS gap FROM p JOIN c{r} USING (part, pos) GROUP BY ALL) GROUP BY ALL),"""
        if r < rounds:
            text += f"""
c{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(mean, v) AS v
  FROM c{r} LEFT JOIN (
    SELECT part, best % 256 AS entry, pos, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS mean
    FROM a{r} JOIN p USING (vec_id, part) GROUP BY ALL) USING (part, entry, pos)),"""
    return (
        text
        + f"""
f AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(best % 256 AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM f JOIN k USING (vec_id)
"""
    )


SQL = _sql()
