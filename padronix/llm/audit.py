"""Filter interaction audit: what each filter removes at each step of every order of application.

Every document is one cell of a 2x2x2x2x2 tensor (pass or fail of five filters), counted per part. All that the audit
reports of an order follows from the part's tensors by contraction: along each axis a step takes the passing slice, the
failing one, or all. So texts are read once, and orders cost nothing but arithmetic on 32 numbers a part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padronix.llm.batches import materialize, shared_folder
from padronix.llm.quality import SPACE, let
from padronix.operators.sizing import join_table

FILTERS = "ABCDE"
LEAST_WORDS = 200
PARTS_AT_ONCE = 64  # parts whose rows one batch returns

ORDERS = ["".join(p) for p in permutations(FILTERS)]
_PASS, _FAIL, _ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} bigint" for m in MEASURES)


def text_failures(text: str) -> Column:
    """Bits 0 to 3: the text fails filter A (few words), B (few distinct ones), C (capitals) or D (symbols); null is empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, rf"[{SPACE}]+"), lambda w: w != "")
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))

    def of_words(w: Column) -> Column:
        few = F.when(F.size(w) < LEAST_WORDS, 1).otherwise(0)
        alike = F.when(100 * F.size(F.array_distinct(w)).cast("bigint") < 50 * F.size(w).cast("bigint"), 2).otherwise(0)
        return few + alike

    loud = F.when(100 * capitals.cast("bigint") > 2 * F.length(t).cast("bigint"), 4).otherwise(0)
    marked = F.when(t.rlike("[#$%&*|]"), 8).otherwise(0)
    return let(words, of_words) + loud + marked


def failure_cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and cell; bit i of mask is set where filter i fails.

    Filter E fails where a smaller key has the same text anywhere in the table; texts are compared by their SHA-256. The
    smallest key of a text is a grouped minimum, combined before its exchange, and rows are matched with it by
    (text, key), so a group of copies is spread by its keys, whatever its size. Repeated rows have no smaller key among
    themselves; they are counted before they are matched. A null key is neither smaller nor larger than another: such a
    row passes E and has no labels. Of several labels of one key a document is good, or toxic, if any of them says so.
    """
    text_of = F.coalesce(docs[text].cast("string"), F.lit(""))
    read = docs.select(docs[key].cast("bigint").alias("key"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), text_of.alias("text"))
    read = read.select("key", "part", F.unhex(F.sha2("text", 256)).alias("same"), text_failures("text").alias("mask"))
    rows = materialize(read, shared_folder(docs.sparkSession), "failures")

    marks = labels.select(F.col(key).cast("bigint").alias("key"), *[(F.col(c) == 1).cast("int").alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))])
    marks = marks.where("key IS NOT NULL").groupBy("key").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    marked = join_table(rows, marks, ["key"], "left")
    sums = [F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c) for c in ("good", "toxic")]
    counted = marked.groupBy("same", "key", "part", "mask").agg(F.count("*").alias("n"), *sums)

    firsts = rows.groupBy("same").agg(F.min("key").alias("key")).withColumn("leads", F.lit(True))
    led = counted.join(firsts, ["same", "key"], "left")
    later = F.when(F.col("key").isNotNull() & F.col("leads").isNull(), 16).otherwise(0)
    cells = led.select("part", (F.col("mask") + later).alias("mask"), "n", "good", "toxic")
    return cells.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _selectors() -> dict[str, np.ndarray]:
    """For each measure a vector (pass, fail) per step and axis: what a step of an order takes of each filter's axis."""
    taken: dict[str, list] = {m: [] for m in ("kept", "removed", "failing", "unique_fails")}
    for order in ORDERS:
        for step, own in enumerate(order):
            earlier = order[:step]
            taken["kept"].append([_PASS if f in earlier or f == own else _ALL for f in FILTERS])
            taken["removed"].append([_FAIL if f == own else _PASS if f in earlier else _ALL for f in FILTERS])
            taken["failing"].append([_FAIL if f == own else _ALL for f in FILTERS])
            taken["unique_fails"].append([_FAIL if f == own else _PASS for f in FILTERS])
    return {m: np.array(v, np.int64) for m, v in taken.items()}


def _contract(tensors: np.ndarray, selector: np.ndarray) -> np.ndarray:
    """Of each part's tensor the sum that each step selects: parts x steps."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *(selector[:, i] for i in range(len(FILTERS))), optimize="greedy")


def interactions(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of all steps (ORDERS x 5) for tensors of shape (parts, 2, 2, 2, 2, 2); exact, in 64-bit integers."""
    take = _selectors()
    removed = _contract(counts, take["removed"])
    own = np.array([FILTERS.index(f) for order in ORDERS for f in order])
    by_filter = np.stack([removed[:, own == i].sum(axis=1) for i in range(len(FILTERS))], axis=1)
    return {
        "kept": _contract(counts, take["kept"]),
        "removed": removed,
        "redundant": _contract(counts, take["failing"]) - removed,
        "unique_fails": _contract(counts, take["unique_fails"]),
        "good_lost": _contract(good, take["removed"]),
        "toxic_lost": _contract(toxic, take["removed"]),
        "shapley": by_filter[:, own],
    }


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, filter_order (all 120) and step (1 to 5), with the measures that SCHEMA names.

    A null or empty part is the part ''. Null texts are empty. A table without rows has no parts, so no rows. Other
    columns are not read. See `failure_cells` for repeated keys, rows and labels. A task holds the tensors of
    PARTS_AT_ONCE parts, however many documents they count.
    """
    cells = failure_cells(docs, labels, key, text, part)
    tensors = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = len(ORDERS) * len(FILTERS)
        orders = np.repeat(ORDERS, len(FILTERS))
        numbers = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
        for batch in batches:
            for low in range(0, batch.num_rows, PARTS_AT_ONCE):
                rows = batch.slice(low, PARTS_AT_ONCE).to_pylist()
                # Bit i of a mask is the place on axis i: axes are laid out from the last bit to the first, then turned.
                flat = np.zeros((3, len(rows), 1 << len(FILTERS)), np.int64)
                for i, row in enumerate(rows):
                    for c in row["cells"]:
                        flat[:, i, c["mask"]] = c["n"], c["good"], c["toxic"]
                shaped = flat.reshape(3, len(rows), *[2] * len(FILTERS)).transpose(0, 1, 6, 5, 4, 3, 2)
                found = interactions(*shaped)
                columns = [
                    pa.array(np.repeat([r["part"] for r in rows], steps), pa.string()), pa.array(np.tile(orders, len(rows))),
                    pa.array(np.tile(numbers, len(rows))), *[pa.array(found[m].reshape(-1), pa.int64()) for m in MEASURES],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *MEASURES])

    return tensors.mapInArrow(run, SCHEMA)


# DuckDB SQL for the audit, over documents(doc_id, text, source) and labels(doc_id, quality, toxic).
SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w LEFT JOIN m USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (
  SELECT filter_order, step, CAST(1 << (ascii(filter_order[step]) - 65) AS BIGINT) AS own,
         CAST(coalesce(list_sum([1 << (ascii(q) - 65) FOR q IN string_split(filter_order[1:step - 1], '') IF q <> '']), 0) AS BIGINT) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
r AS (
  SELECT part, filter_order, step, own,
         CAST(coalesce(sum(n) FILTER (mask & (before | own) = 0), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (mask = own), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
