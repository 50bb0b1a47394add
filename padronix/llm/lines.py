"""Line dedup by winnowing: fingerprints of line runs are joined, matches extended both ways, later runs deleted.

Lines without words count for nothing and never end a run. A gram is the shortest run of lines from a line on that has
GRAM words; a window holds the grams that begin fewer than WINDOW words behind a line, and its smallest hash, the last of
equal ones, is a fingerprint. A run of GRAM + WINDOW words holds the whole window of its first line with all its grams, so
equal runs of so many words have a fingerprint in common, at the same place.

Fingerprints that occur twice tell where repeated runs can be. From there matches are extended: every shortest run of
LEAST_WORDS words, from a line on or back from it, that holds such a fingerprint is joined with its own first place.
Every line of a repeated run lies in such a run inside it, to the left or the right of the fingerprint; so all lines of
later runs are found, whichever earlier texts hold them, and no others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.llm.batches import bounded_batches, materialize, shared_folder
from padronix.operators.sizing import join_table

LEAST_WORDS = 20  # shorter repeated runs stay

TEXTS = "key bigint, tie bigint, hashes array<bigint>, words array<int>, at array<int>, print array<bigint>"
RUNS = "key bigint, tie bigint, low int, high int, gram binary"


def line_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, hashes and word counts of the lines of a text that have a word; white space at the ends is left out."""
    numbers, hashes, words = [], [], []
    for i, line in enumerate(text.split(b"\n")):
        stripped = line.strip()
        if stripped:
            numbers.append(i)
            hashes.append(xxhash.xxh3_64_intdigest(stripped))
            words.append(len(stripped.split()))
    return np.array(numbers, np.int32), np.array(hashes, np.uint64).view(np.int64), np.array(words, np.int32)


def fingerprints(hashes: np.ndarray, words: np.ndarray, least_words: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """(first line, 64-bit hash) of the window minima. Half of `least_words` is a gram, the rest a window."""
    gram = least_words // 2
    window = least_words - gram
    upto = np.concatenate(([0], np.cumsum(words)))
    ends = np.searchsorted(upto, upto[:-1] + gram)
    whole = int(np.searchsorted(ends, len(words), "right"))  # grams from these lines on end in the text
    grams = [xxhash.xxh3_64_intdigest(hashes[i:e].tobytes()) >> 1 for i, e in enumerate(ends[:whole].tolist())]
    # The window of line i holds the lines that begin fewer than `window` words behind it.
    lasts = (np.searchsorted(upto, upto[:-1] + window) - 1).tolist()
    found: dict[int, int] = {}
    rising: list[int] = []  # places whose hashes rise; the first is the window's minimum
    head = upper = 0
    for i in range(whole):
        while upper < whole and upper <= lasts[i]:
            while len(rising) > head and grams[rising[-1]] >= grams[upper]:
                rising.pop()
            rising.append(upper)
            upper += 1
        while rising[head] < i:
            head += 1
        found[rising[head]] = grams[rising[head]]
    return sorted(found.items())


def runs_through(hashes: np.ndarray, words: np.ndarray, matched: np.ndarray, least_words: int = LEAST_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, 128-bit hash) of the shortest runs of `least_words` words that begin, or end, at a line and hold the
    whole gram of a matched fingerprint."""
    upto = np.concatenate(([0], np.cumsum(words)))
    n = len(words)
    ends = np.searchsorted(upto, upto[:-1] + least_words)
    starts = np.searchsorted(upto, upto[1:] - least_words, "right") - 1
    low = np.concatenate((np.arange(n), starts))
    high = np.concatenate((ends, np.arange(1, n + 1)))
    inside = (low >= 0) & (high <= n)
    low, high = low[inside], high[inside]
    # The first matched gram from `low` on is the one that ends first.
    matched = np.sort(matched)
    gram_ends = np.searchsorted(upto, upto[matched] + least_words // 2)
    at = np.searchsorted(matched, low)
    held = np.append(gram_ends, n + 1)[at] <= high
    runs = np.unique(np.stack((low[held], high[held]), axis=1), axis=0).tolist()
    return [(i, e, xxhash.xxh3_128_digest(hashes[i:e].tobytes())) for i, e in runs]


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(key, tie, places): per text with later repeated runs, the numbers of their lines, ascending. tie is the text's hash.

    Texts are ordered by (key, text hash), null keys first; a run is later if an equal one stands in an earlier text or
    further up in the same one. All lines of later runs of at least `least_words` words are returned, whichever of the
    earlier texts holds them. A fingerprint or run of any frequency is counted by a grouped aggregate, and rows are joined
    with one row of it, over salts where it is very frequent: no group emits pairs or is held by one task. Every deleted
    line equals a line at an earlier place, so the first of equal lines always stays. Rows of equal key and text are one text.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = shared_folder(spark)
    picked = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("tie"), F.col(text).cast("binary").alias("text"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
        names = ["key", "tie", "hashes", "words", "at", "print"]
        for batch in batches:
            rows = []
            for k, tie, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                _, hashes, words = line_hashes(t or b"")
                found = fingerprints(hashes, words, least_words)
                if found:
                    rows.append((k, tie, hashes, words, [i for i, _ in found], [h for _, h in found]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    texts = materialize(picked.mapInArrow(read, TEXTS), folder, "texts")
    marks = texts.select("key", "tie", F.explode(F.arrays_zip("at", "print")).alias("m")).select("key", "tie", "m.at", "m.print")
    here = F.struct("key", "tie", "at")
    twice = marks.groupBy("print").agg(F.min(here).alias("a"), F.max(here).alias("b")).where("a < b").select("print")
    twice = materialize(twice, folder, "prints")
    matched = join_table(marks, twice, ["print"], "left_semi").groupBy("key", "tie").agg(F.collect_set("at").alias("matched"))
    of_text = [F.col("x.key").eqNullSafe(F.col("m.key")), F.col("x.tie") == F.col("m.tie")]
    around = texts.alias("x").join(matched.alias("m"), of_text).select("x.key", "x.tie", "hashes", "words", "matched")

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        names = ["key", "tie", "low", "high", "gram"]
        for batch in batches:
            for row in batch.to_pylist():
                arrays = (np.array(row["hashes"], np.int64), np.array(row["words"], np.int64), np.array(row["matched"], np.int64))
                found = [(row["key"], row["tie"], *r) for r in runs_through(*arrays, least_words)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)], names=names)

    runs = materialize(around.mapInArrow(extend, RUNS), folder, "runs")
    here = F.struct("key", "tie", "low")
    first = runs.groupBy("gram").agg(F.min(here).alias("first"), F.max(here).alias("last")).where("first < last").select("gram", "first")
    met = join_table(runs, materialize(first, folder, "first"), ["gram"]).where(~here.eqNullSafe(F.col("first")))
    places = F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("low", "high")), lambda m: F.sequence(m["low"], m["high"] - 1))))
    return met.groupBy("key", "tie").agg(F.sort_array(places).alias("places"))


def cut_lines(text: str | None, gone) -> str | None:
    """A text without the lines of these numbers, counted among lines with a word: one pass over its lines."""
    if text is None:
        return None
    drop, n, kept = set(gone), 0, []
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\f\r"):
            n += 1
            if n - 1 in drop:
                continue
        kept.append(line)
    return "\n".join(kept)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """`docs` with n_lines (lines with a word), n_removed, removed (their numbers from 0 among those) and cleaned.

    cleaned is the text without the removed lines; other lines, blank ones too, stay as they are. A null text stays
    null and has no lines; a text that keeps no line with a word is what is left of it. Every row is returned once.
    Columns of `docs` named as new ones are replaced. The texts are exchanged once, by key and text hash.
    """
    new = ("n_lines", "n_removed", "removed", "cleaned")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    runs = repeated_runs(docs, key, text, **options).select(F.col("key").alias("__key"), F.col("tie").alias("__tie"), F.col("places").alias("__places"))
    rows = docs.select(*[docs[c] for c in kept], docs[text].alias("__text"), docs[key].cast("bigint").alias("__k"), F.xxhash64(docs[text]).alias("__t"))
    joined = rows.join(runs, F.col("__k").eqNullSafe(F.col("__key")) & (F.col("__t") == F.col("__tie")), "left")
    n_lines = F.size(F.filter(F.split(F.coalesce("__text", F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")))
    places = F.coalesce("__places", F.array().cast("array<int>"))
    hit = F.col("__places").isNotNull()
    without_lines = F.pandas_udf(lambda t, p: pd.Series([cut_lines(*x) for x in zip(t, p, strict=True)], dtype=object), "string")
    cleaned = F.when(hit, without_lines(F.when(hit, F.col("__text")), places)).otherwise(F.col("__text"))
    return joined.select(
        *kept, n_lines.cast("bigint").alias("n_lines"), F.size(places).cast("bigint").alias("n_removed"),
        places.alias("removed"), cleaned.alias("cleaned"),
    )


# DuckDB SQL for the query, over documents(doc_id, text) of distinct ids: all runs of 20 words, each with its first place.
SQL = r"""
WITH s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, i, line, regexp_replace(line, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS bare FROM s),
w AS (
  SELECT doc_id, i, bare, row_number() OVER d - 1 AS p, len(regexp_extract_all(bare, '[^ \t\n\x0B\f\r]+')) AS n,
         sum(len(regexp_extract_all(bare, '[^ \t\n\x0B\f\r]+'))) OVER d AS upto
  FROM t WHERE bare <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
a AS (SELECT doc_id, list(bare ORDER BY p) AS bares FROM w GROUP BY doc_id),
r AS (
  SELECT x.doc_id, x.p AS low, y.p + 1 AS high FROM w x ASOF JOIN w y ON x.doc_id = y.doc_id AND x.upto - x.n + 20 <= y.upto
  UNION
  SELECT y.doc_id, x.p AS low, y.p + 1 AS high FROM w y ASOF JOIN w x ON x.doc_id = y.doc_id AND y.upto - 20 >= x.upto - x.n),
g AS (SELECT doc_id, low, high, list_slice(bares, low + 1, high) AS gram FROM r JOIN a USING (doc_id)),
f AS (SELECT gram, min(struct_pack(d := doc_id, l := low)) AS first FROM g GROUP BY gram),
x AS (
  SELECT DISTINCT doc_id, unnest(range(low, high)) AS p FROM g JOIN f USING (gram)
  WHERE struct_pack(d := doc_id, l := low) <> first),
z AS (SELECT t.doc_id, t.i, line, w.p, x.p IS NOT NULL AS gone FROM t LEFT JOIN w USING (doc_id, i) LEFT JOIN x ON x.doc_id = w.doc_id AND x.p = w.p)
SELECT d.doc_id, CAST(coalesce(count(z.p), 0) AS BIGINT) AS n_lines, CAST(coalesce(count(*) FILTER (gone), 0) AS BIGINT) AS n_removed,
       coalesce(string_agg(CAST(z.p AS VARCHAR), ',' ORDER BY z.p) FILTER (gone), '') AS removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY z.i) FILTER (NOT gone), '')) AS cleaned_md5
FROM documents d LEFT JOIN z USING (doc_id) GROUP BY d.doc_id
"""
