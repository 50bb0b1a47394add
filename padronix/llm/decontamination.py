"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark items, one scan of each text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.llm.batches import append_columns, arrow_type, kept_rows, materialize, shared_folder

WINDOW = 10
# Most bytes of item text in one automaton, which takes about 50 bytes of memory per byte of text in each Python worker.
AUTOMATON_BYTES = 8_000_000

# Bytes of separators become spaces, A-Z become a-z, everything else (a-z, 0-9, all of UTF-8's high bytes) stays.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
_SPAN = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")

FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StringType())),
    ]
)


def folded_words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


# What one scan finds, before scans are joined.
PLACES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("places", T.ArrayType(T.LongType())),
    ]
)


def windows_of(items: list[tuple[str, bytes]], window: int) -> dict[str, tuple[int, set[str]]]:
    """Pattern -> (words, ids of the items that hold it). Patterns are words between single spaces, read as Latin-1."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = folded_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            found.setdefault((b" " + b" ".join(part) + b" ").decode("latin-1"), (len(part), set()))[1].add(item)
    return found


def automaton(patterns: dict[str, tuple[int, set[str]]]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for pattern, (n, items) in patterns.items():
        built.add_word(pattern, (n, sorted(items)))
    built.make_automaton()
    return built


def locate(built: ahocorasick.Automaton | None, text: bytes) -> tuple[int, list[str], list[int]]:
    """Words, ids of items with an occurring window, and hit places.

    A place is four numbers: first word, word behind the last, and the same in code points of the original text.
    """
    words = folded_words(text)
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found = list(built.iter(line)) if built else []
    if not found:
        return len(words), [], []
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
    # Word i lies between spaces i and i + 1; a match ends on the space after its last word.
    after = np.searchsorted(spaces, [end for end, _ in found])
    change = np.zeros(len(words) + 1, np.int64)
    items: set[str] = set()
    for last, (_, (n, ids)) in zip(after.tolist(), found, strict=True):
        change[last - n] += 1
        change[last] -= 1
        items.update(ids)
    hit = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))).reshape(-1, 2)
    at = [m.span() for m in _SPAN.finditer(text)]
    # Offsets in the original: bytes, then code points (bytes that do not continue a character).
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    places = [p for a, b in edges.tolist() for p in (a, b, int(points[at[a][0]]), int(points[at[b - 1][1]]))]
    return len(words), sorted(items), places


def joined_places(places: list[int]) -> list[list[int]]:
    """Places of several scans in order; those that overlap or touch are one."""
    out: list[list[int]] = []
    for i in sorted(range(0, len(places), 4), key=places.__getitem__):
        first, last, start, end = places[i : i + 4]
        if out and first <= out[-1][1]:
            if last > out[-1][1]:
                out[-1][1], out[-1][3] = last, end
        else:
            out.append([first, last, start, end])
    return out


def described(n_words: int, items: list[str], places: list[int]) -> tuple[int, int, list[str], list[str]]:
    """The columns of `find_contamination` from all places of a text."""
    joined = joined_places(places)
    return n_words, sum(p[1] - p[0] for p in joined), sorted(set(items)), [f"{p[2]}:{p[3]}" for p in joined]


def cut_item(text: bytes, window: int, limit: int) -> Iterator[bytes]:
    """A text as parts of about `limit` bytes that hold all its windows; neighbours share `window` - 1 words."""
    if len(text) <= limit:
        yield text
        return
    words = folded_words(text)
    first = 0
    while True:
        last, size = first, 0
        while last < len(words) and (last - first < window or size < limit):
            size += len(words[last]) + 1
            last += 1
        yield b" ".join(words[first:last])
        if last >= len(words):
            return
        first = last - window + 1


def pieces_of(rows: Iterable[tuple[str, bytes]], window: int, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in pieces of about `limit` bytes of text; only one piece is held at a time."""
    piece: list[tuple[str, bytes]] = []
    total = 0
    for item, text in rows:
        for part in cut_item(text, window, limit):
            if piece and total + len(part) > limit:
                yield piece
                piece, total = [], 0
            piece.append((item, part))
            total += len(part)
    if piece:
        yield piece


def _columns(found: list[tuple], n: int) -> list[list]:
    return [list(c) for c in zip(*found, strict=True)] or [[] for _ in range(n)]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, keep: list[str] | None = None, automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """`docs` with the benchmark windows found in each whole text.

    Columns: n_words, n_hit (words inside any occurrence of a window of `window` consecutive item words; an item
    with fewer words is one window), items (sorted ids as text), spans (`start:end`, code points of the original text).
    Every row of `docs` is returned once, whatever its key; a null or wordless text has 0 words, no hit. Items
    without words, or null, match nothing. Repeated items are one. Columns of `docs` named as new ones are replaced.

    The size of the benchmark is read first. Up to `automaton_bytes` of text it makes one automaton, which is
    broadcast, and one scan. A larger one is read in pieces of that size, one piece and one scan at a time; the rows
    are numbered in a written table, and the places that the scans found are joined by row.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).cast("binary").alias("t"))
    rows = rows.where("i IS NOT NULL AND t IS NOT NULL").distinct()
    if (rows.agg(F.sum(F.octet_length("t") + F.octet_length("i"))).first()[0] or 0) > automaton_bytes:
        return _find_in_pieces(docs, rows, text, window, keep, automaton_bytes)
    shared = spark.sparkContext.broadcast([(r["i"], bytes(r["t"])) for r in rows.orderBy("i", "t").collect()])

    def start():
        patterns = windows_of(shared.value, window)
        built = automaton(patterns) if patterns else None

        def compute(texts: pa.Array) -> list:
            return _columns([described(*locate(built, t or b"")) for t in texts.to_pylist()], 4)

        return compute

    return append_columns(docs, text, FIELDS, start, keep)


def _find_in_pieces(docs: DataFrame, rows: DataFrame, text: str, window: int, keep: list[str] | None, limit: int) -> DataFrame:
    spark = docs.sparkSession
    folder = shared_folder(spark)
    new = {f.name.lower() for f in FIELDS}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    numbered = docs.select(
        F.monotonically_increasing_id().alias("id"), docs[text].cast("binary").alias("text"),
        F.struct(F.lit(0).alias("__none"), *[docs[c] for c in kept]).alias("row"),
    )
    numbered = materialize(numbered, folder, "rows")
    items = rows.repartitionByRange(max(1, spark.sparkContext.defaultParallelism), "i", "t").sortWithinPartitions("i", "t")
    items = materialize(items, folder, "items")
    found = []
    for number, piece in enumerate(pieces_of(((r["i"], bytes(r["t"])) for r in items.toLocalIterator()), window, limit)):
        shared = spark.sparkContext.broadcast(piece)
        scanned = append_columns(numbered.select("id", "text"), "text", PLACES, _start_piece(shared, window), ["id"])
        # Every row is kept by the first scan, so that its words are known; later ones add rows with a hit only.
        scanned = scanned if not number else scanned.where(F.size("items") > 0)
        found.append(materialize(scanned, folder, f"found/piece={number}").select("id", *PLACES.names))
        shared.destroy()
    every = spark.read.schema(found[0].schema).option("recursiveFileLookup", "true").parquet(f"{folder}/found")
    merged = every.groupBy("id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("places")).alias("places")
    )
    schema = T.StructType([T.StructField("id", T.LongType()), *FIELDS.fields])

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [arrow_type(f.dataType) for f in FIELDS]
        for batch in batches:
            lines = [described(r["n_words"], r["items"], r["places"]) for r in batch.to_pylist()]
            made = [pa.array(c, type=t) for c, t in zip(_columns(lines, 4), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    out = numbered.select("id", "row").join(merged.mapInArrow(describe, schema), "id")
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *FIELDS.names)


def _start_piece(shared, window: int):
    def start():
        patterns = windows_of(shared.value, window)
        built = automaton(patterns) if patterns else None

        def compute(texts: pa.Array) -> list:
            return _columns([locate(built, t or b"") for t in texts.to_pylist()], 3)

        return compute

    return start


def item_digest(items: str = "items"):
    """Lower-case hex SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(items, ","), 256)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows of `docs`, columns as they are, whose text holds no benchmark window."""
    return kept_rows(docs, text, lambda rows: find_contamination(rows, benchmark, **options), F.col("n_hit") == 0)


# DuckDB SQL for op10, over documents(doc_id, text) and benchmark(item_id, text).
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item FROM g JOIN p USING (n, gram)),
s AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id),
c AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN c USING (doc_id)
"""
