"""Jaccard join of documents on word shingles: a blocked sparse product of documents by shingles.

Exact. Texts of equal words are one row of the incidence matrix. Columns are ordered by how many rows hold them. Two
rows that reach the threshold share a column among the rarest (1 - threshold) share of both, and their sizes differ by at
most the threshold; both bounds come from sizes alone. Columns of one row can't be shared and are left out. What is left
decides which rows may meet at all (families); families are multiplied in blocks of rows and of columns, overlaps
are accumulated block by block, and pairs below the overlap that their sizes ask for are discarded inside the task.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.llm.batches import append_columns, bounded_batches, free_worker, key_runs, materialize, shared_folder
from padronix.llm.graph import components

SHINGLE = 5
PERCENT = 80
PACK_BYTES = 8_000_000  # text of one stored pack of documents
PART_TOKENS = 1_000_000  # counted shingles that one counting task holds, on average
BLOCK_ROWS = 1024  # rows of one side of a block product
BLOCK_TOKENS = 1_000_000  # shingles of one side of a block product, on average
BLOCK_COLUMNS = 2048  # columns multiplied at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_BYTE = np.random.default_rng(20_25).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^0..r^n and their inverses modulo 2^64, kept for the next text."""
    if len(_powers[0]) <= n:
        for i, r in enumerate((_R, _R_INVERSE)):
            factors = np.full(max(n + 1, 1 << 16), r, np.uint64)
            factors[0] = 1
            _powers[i] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run without ASCII white space, A-Z lower-cased) of a UTF-8 text."""
    codes = _LOWER[np.frombuffer(text, np.uint8)]
    inside = _IS_WORD[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power(len(codes))
    # A word's hash is a polynomial in r over its bytes' random values: a difference of running sums, moved to place 0.
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[codes] * power[: len(codes)])))
    return _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of word shingles; a text of fewer words is one shingle, without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    k = min(size, len(words))
    sums = np.full(len(words) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        sums = _mixed(sums * _R + words[i : len(words) - k + 1 + i])
    return np.unique(sums)


def text_class(text: bytes) -> bytes:
    """16 bytes that are equal for texts of equal words."""
    return xxhash.xxh3_128_digest(b" ".join(text.translate(_LOWER.tobytes()).split()))


def prefix_size(n: int, percent: int) -> int:
    """Of n ordered shingles, so many first ones hold a common one with any set that reaches the threshold."""
    return n - -(-percent * n // 100) + 1


# ---------------------------------------------------------------- stored packs: every text read once, copies in a pack once

STORED = "doc_id bigint, class binary, n bigint, pack string, texts binary"


def _store(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """A row per document (doc_id, class, n shingles), and a row per pack (pack, its texts compressed)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        press = zstandard.ZstdCompressor(level=5)
        held: dict[bytes, bytes] = {}
        known: dict[bytes, int] = {}
        total = 0

        def packed() -> pa.RecordBatch:
            body = b"".join(len(t).to_bytes(8, "little") + c + t for c, t in held.items())
            return _rows([(None, None, None, uuid.uuid4().hex, press.compress(body))])

        for batch in batches:
            rows = []
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                t = t or b""
                c = text_class(t)
                n = known.get(c)
                if n is None:
                    n = len(shingles(t, size))
                    if len(known) > 200_000:
                        known.clear()
                    known[c] = n
                    if n:
                        held[c] = t
                        total += len(t)
                rows.append((k, c, n, None, None))
                if total > PACK_BYTES:
                    yield packed()
                    held, total = {}, 0
            if rows:
                yield _rows(rows)
        if held:
            yield packed()

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.binary())
        names = ("doc_id", "class", "n", "pack", "texts")
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=list(names))

    picked = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("binary").alias("text"))
    return picked.mapInArrow(run, STORED)


def _unpack(texts: bytes) -> Iterator[tuple[bytes, bytes]]:
    body = zstandard.ZstdDecompressor().decompress(texts)
    at = 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 8], "little")
        yield body[at + 8 : at + 24], body[at + 24 : at + 24 + n]
        at += 24 + n


# ---------------------------------------------------------------- how many rows hold each column

COUNTS = "part int, pack string, tokens binary, counts binary"


def _split(token: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and 32-bit remainder of shingle hashes. Equal shingles agree in both; others rarely do, and may."""
    return (token >> np.uint64(64 - bits)).astype(np.int64), (token >> np.uint64(32 - bits)).astype(np.uint32)


def _pressed(tokens: np.ndarray) -> bytes:
    """Sorted 32-bit numbers by Elias and Fano: the low bits as they are, the high ones as gaps in unary; two bits more
    each than their mean distance needs."""
    n = len(tokens)
    low = ((1 << 32) // max(n, 1)).bit_length() - 1  # 32 at most
    bits = np.unpackbits(tokens.astype(">u4").view(np.uint8).reshape(n, 4), axis=1)[:, 32 - low :]
    high = (tokens.astype(np.int64) >> low) + np.arange(n)
    marks = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    marks[high] = 1
    return n.to_bytes(4, "little") + np.packbits(bits).tobytes() + np.packbits(marks).tobytes()


def _pressed_out(body: bytes) -> np.ndarray:
    n = int.from_bytes(body[:4], "little")
    low = ((1 << 32) // max(n, 1)).bit_length() - 1  # 32 at most
    cut = 4 + -(-n * low // 8)
    bits = np.unpackbits(np.frombuffer(body[4:cut], np.uint8), count=n * low).reshape(n, low)
    rest = np.zeros((n, 32), np.uint8)
    rest[:, 32 - low :] = bits
    high = np.flatnonzero(np.unpackbits(np.frombuffer(body[cut:], np.uint8))) - np.arange(n)
    return (np.packbits(rest, axis=1).view(">u4").reshape(n).astype(np.int64) | (high << low)).astype(np.uint32)


def _local_counts(packs: DataFrame, bits: int, size: int) -> DataFrame:
    """Per pack and part: the shingles that occur in the pack and in how many of its texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [shingles(t, size) for _, t in _unpack(row["texts"])]
                part, rest = _split(np.concatenate(found), bits)
                merged, counts = np.unique((part.astype(np.uint64) << np.uint64(32)) | rest, return_counts=True)
                cuts = np.searchsorted(merged, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
                tokens, counts = merged.astype(np.uint32), np.minimum(counts, 0xFFFF).astype(np.uint16)
                full = [p for p in range(1 << bits) if cuts[p] < cuts[p + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.int32()),
                        pa.array([row["pack"]] * len(full)),
                        pa.array([_pressed(tokens[cuts[p] : cuts[p + 1]]) for p in full], pa.binary()),
                        pa.array([_thin(counts[cuts[p] : cuts[p + 1]]) for p in full], pa.binary()),
                    ],
                    names=["part", "pack", "tokens", "counts"],
                )

    return packs.select("pack", "texts").mapInArrow(run, COUNTS)


def _thin(counts: np.ndarray) -> bytes:
    """Counts over 1 as (place, count) pairs; almost all are 1."""
    at = np.flatnonzero(counts > 1).astype(np.uint32)
    return at.tobytes() + counts[at].astype(np.uint32).tobytes()


def _thick(thin: bytes, n: int) -> np.ndarray:
    at, value = np.frombuffer(thin, np.uint32).reshape(2, -1)
    counts = np.ones(n, np.uint32)
    counts[at] = value
    return counts


def _shared_counts(local: DataFrame) -> DataFrame:
    """Per pack and part: the pack's shingles that at least two texts of all hold, and how many do."""

    def total(key: tuple, table: pa.Table) -> pa.Table:
        packs = table.column("pack").to_pylist()
        tokens = [_pressed_out(t) for t in table.column("tokens").to_pylist()]
        counts = [_thick(c, len(t)) for c, t in zip(table.column("counts").to_pylist(), tokens, strict=True)]
        everything = np.concatenate(tokens)
        order = np.argsort(everything, kind="stable")
        ordered = everything[order]
        firsts = np.flatnonzero(np.diff(ordered, prepend=ordered[0] ^ np.uint32(1)) != 0)
        sums = np.add.reduceat(np.concatenate(counts)[order].astype(np.uint64), firsts)
        of = np.empty(len(order), np.uint64)
        of[order] = np.repeat(sums, np.diff(np.append(firsts, len(order))))
        out, at = [], 0
        for pack, t in zip(packs, tokens, strict=True):
            n = of[at : at + len(t)]
            at += len(t)
            more = n > 1
            if more.any():
                n = np.minimum(n[more], 0xFFFFFFFF)
                out.append((key[0].as_py(), pack, _pressed(t[more]), n.astype(np.min_scalar_type(n.max())).tobytes()))
        kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary())
        names = ["part", "pack", "tokens", "counts"]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return local.groupBy("part").applyInArrow(total, COUNTS)


# ---------------------------------------------------------------- rows of the matrix that can have a partner

ROWS = "class binary, n bigint, prefix array<bigint>, tokens binary"


def _matrix_rows(packs: DataFrame, shared: DataFrame, bits: int, size: int, percent: int) -> DataFrame:
    """Texts with a shared shingle in their prefix: its shared shingles, and those of the prefix."""

    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            keys, counts = [], []
            for r in right.to_pylist():
                tokens = _pressed_out(r["tokens"]).astype(np.uint64)
                keys.append((np.uint64(r["part"]) << np.uint64(32)) | tokens)
                counts.append(np.frombuffer(r["counts"], f"u{len(r['counts']) // len(tokens)}").astype(np.uint32))
            known, held_by = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(known)
            known, held_by = known[order], held_by[order]
            for blob in left.column("texts").to_pylist():
                for c, text in _unpack(blob):
                    s = shingles(text, size)
                    part, rest = _split(s, bits)
                    sought = (part.astype(np.uint64) << np.uint64(32)) | rest
                    at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
                    found = known[at] == sought
                    tokens, n_rows = s[found], held_by[at[found]]
                    alone = len(s) - len(tokens)  # they come first in the order, and no other row has them
                    first = prefix_size(len(s), percent) - alone
                    if first > 0 and len(tokens):
                        tokens = tokens[np.lexsort((tokens, n_rows))].view(np.int64)
                        rows.append((c, len(s), tokens[:first].tolist(), tokens.tobytes()))
        kinds = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        names = ["class", "n", "prefix", "tokens"]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return packs.groupBy("pack").cogroup(shared.groupBy("pack")).applyInArrow(build, ROWS)


def _families(rows: DataFrame, percent: int, folder: str) -> DataFrame:
    """(class, family) of rows that may meet: they share a prefix column and lie in the same or neighbouring size bands.

    Sizes of two rows that reach the threshold differ by a factor of at most 100 / percent, so they lie in one band of
    that factor or in neighbouring ones; a row enters a column under its band and the next.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    entries = rows.select("class", F.explode("prefix").alias("token"), band.alias("band"))
    entries = entries.select("class", "token", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    first = entries.groupBy("token", "band").agg(F.min("class").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = entries.join(first, ["token", "band"]).select("a", F.col("class").alias("b")).where("a <> b").distinct()
    return components(met, folder, "families").select(F.col("node").alias("class"), F.col("label").alias("family"))


# ---------------------------------------------------------------- block products

LINKS = "a binary, b binary"


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common columns of each left and right row: a product of two sparse 0/1 matrices, summed over blocks of columns."""
    out = np.zeros((len(left), len(right)), np.float32)
    columns = np.intersect1d(np.concatenate(left), np.concatenate(right))  # sorted and distinct
    if not len(columns):
        return out

    def entries(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Columns and rows of one side's entries, by column; row by row, so that no second copy of all is made."""
        found, sizes = [], []
        for tokens in rows:
            at = np.minimum(np.searchsorted(columns, tokens), len(columns) - 1)
            at = at[columns[at] == tokens].astype(np.int32)
            found.append(at)
            sizes.append(len(at))
        at = np.concatenate(found)
        order = np.argsort(at, kind="stable")
        return at[order], np.repeat(np.arange(len(rows), dtype=np.int32), sizes)[order]

    l_at, l_row = entries(left)
    r_at, r_row = (l_at, l_row) if right is left else entries(right)
    for low in range(0, len(columns), BLOCK_COLUMNS):
        width = min(BLOCK_COLUMNS, len(columns) - low)
        dense = []
        for at, row, n in ((l_at, l_row, len(left)), (r_at, r_row, len(right))):
            a, b = np.searchsorted(at, (low, low + width))
            block = np.zeros((n, width), np.float32)
            block[row[a:b], at[a:b] - low] = 1
            dense.append(block)
        out += dense[0] @ dense[1].T
    return out


class _Forest:
    """Union-find over the rows of one block, to return links that connect, not all links."""

    def __init__(self):
        self.up: dict[bytes, bytes] = {}

    def find(self, x: bytes) -> bytes:
        while (p := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(p, p)
            x = p
        return x

    def join(self, a: bytes, b: bytes) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def block_links(left: list[dict], right: list[dict] | None, percent: int) -> list[tuple[bytes, bytes]]:
    """Links that connect what reaches the threshold between two lists of rows, or inside one (right is None)."""
    inner = right is None
    right = left if inner else right
    l_n, r_n = (np.array([r["n"] for r in rows], np.int64) for rows in (left, right))
    tokens = [r["tokens"] for r in left]
    common = _overlaps(tokens, tokens if inner else [r["tokens"] for r in right]).astype(np.int32)
    # 100 * common >= percent * (n1 + n2 - common)
    reach = (100 + percent) * common >= percent * (l_n[:, None] + r_n[None, :])
    if inner:
        reach = np.triu(reach, 1)
    forest, out = _Forest(), []
    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(reach)), strict=True):
        a, b = left[i]["class"], right[j]["class"]
        if forest.join(a, b):
            out.append((a, b))
    return out


def _family_links(rows: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Links between classes. A family of many rows, or of long ones, is cut into chunks; each pair of chunks is one
    group of rows, so a task's memory is bounded by BLOCK_ROWS and BLOCK_TOKENS, whatever the family."""
    weights = families.join(rows.select("class", (F.length("tokens") / 8).alias("m")), "class")
    parts = F.greatest(F.count("*") / BLOCK_ROWS, F.sum("m") / BLOCK_TOKENS)
    sizes = weights.groupBy("family").agg(F.ceil(parts).cast("int").alias("chunks"))
    placed = families.join(sizes, "family")
    chunk = F.pmod(F.hash("class"), F.col("chunks"))
    placed = placed.select("class", "family", "chunks", chunk.alias("chunk"))
    # Chunk c meets all others: it enters the blocks (min(c, i), max(c, i)).
    placed = placed.select("class", "family", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    placed = placed.select("class", "family", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    blocks = placed.join(rows.select("class", "n", "tokens"), "class")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), members in key_runs(batches, 3):
            for m in members:
                m["tokens"] = np.frombuffer(m["tokens"], np.int64)
            if low == high:
                found = block_links(members, None, percent)
            else:
                sides = [[m for m in members if m["chunk"] == c] for c in (low, high)]
                found = block_links(*sides, percent) if all(sides) else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    keyed = blocks.select("family", "low", "high", "chunk", "class", "n", "tokens")
    return keyed.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high").mapInArrow(run, LINKS)


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT,
) -> DataFrame:
    """One row per row of `docs`: the integer key, n_shingles, class (16 bytes, equal for texts of equal words), group (16
    bytes, equal for linked texts), component_id.

    Texts link when 100 * common shingles >= percent * all shingles of both; component_id is the smallest key reachable
    by links, itself included. A text without words, or null, has 0 shingles and is linked with nothing, so its
    component is its own key. Null keys stay null, and take part under the smallest non-null key of their component,
    if any. Repeated keys and rows are separate rows. Other columns are not returned.

    The order of columns needs counts over all texts: packs of texts send each of their shingles once to the part of
    the counts it belongs to, and get back those that others hold too. So one shingle, text or source of any frequency
    is at most one entry per pack. Packs, counts and tables below lie in the shared folder; any stage can be repeated.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = shared_folder(spark)
    stored = materialize(_store(docs, key, text, size), folder, "packs")
    members = stored.where("class IS NOT NULL").select("doc_id", "class", "n")
    packs = stored.where("pack IS NOT NULL").select("pack", "texts")
    tokens = members.agg(F.sum("n")).first()[0] or 0
    bits = max(4, min(20, math.ceil(math.log2(tokens / PART_TOKENS + 1))))
    shared = _shared_counts(_local_counts(packs, bits, size))
    rows = _matrix_rows(packs, shared, bits, size, percent)
    rows = materialize(rows, folder, "rows").groupBy("class").agg(*[F.any_value(c).alias(c) for c in ("n", "prefix", "tokens")])
    rows = materialize(rows, folder, "classes")
    families = materialize(_families(rows, percent, folder), folder, "families")
    links = materialize(_family_links(rows, families, percent), folder, "links")
    linked = components(links, folder, "linked").select(F.col("node").alias("class"), "label")

    classes = members.groupBy("class").agg(F.min("doc_id").alias("first"))
    grouped = classes.join(linked, "class", "left").select("class", "first", F.coalesce("label", "class").alias("label"))
    ids = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = grouped.join(ids, "label").select("class", F.col("label").alias("group"), "component_id")
    joined = members.join(of_class, "class")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "class", "group", component.alias("component_id"))


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of `docs`, columns as they are: of each group of linked texts the one of the smallest key (null last).

    Rows without words are linked with nothing and all stay. Of kept rows of equal key and words, one stays.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), docs[key].cast("bigint").alias("key"), docs[text].alias("text"))
    marked = jaccard_components(rows, "key", "text", **options)
    best = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "class"))
    kept = marked.where("n_shingles > 0").groupBy("group").agg(best.alias("best")).select("best.key", "best.class")
    kept = kept.select(F.col("key").alias("k_key"), F.col("class").alias("k_class"))

    def start():
        return lambda texts: [[text_class(t) if t else None for t in texts.to_pylist()], [bool(t) and len(t.split()) > 0 for t in texts.to_pylist()]]

    fields = T.StructType([T.StructField("class", T.BinaryType()), T.StructField("wordy", T.BooleanType())])
    classed = append_columns(rows, "text", fields, start, ["__row", "key"])
    one = classed.where("wordy").join(kept, F.col("key").eqNullSafe(F.col("k_key")) & (F.col("class") == F.col("k_class")))
    one = one.select("__row", "key", "class").dropDuplicates(["key", "class"]).select("__row.*")
    return one.unionByName(classed.where("NOT wordy").select("__row.*"))


# DuckDB SQL for op6, over documents(doc_id, text).
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^ \t\n\x0B\f\r]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, g.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) g USING (doc_id)
"""
