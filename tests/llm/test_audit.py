"""The filter audit against SQL and against applying the filters one after another."""

from __future__ import annotations

import re
from itertools import permutations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from padronix.llm import audit
from tests.llm import odd

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (6, 1, 1), (7, None, 1), (None, 1, 1), (17, 1, 1), (999, 1, 1)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def labels_arrow():
    return pa.table({c: pa.array([r[i] for r in LABELS], pa.int64()) for i, c in enumerate(("doc_id", "quality", "toxic"))})


def wide_texts() -> list[tuple]:
    """Texts on either side of each threshold, in two parts."""
    many = " ".join(f"w{i}" for i in range(200))
    texts = [
        many, many + " # $", many.replace("w", "W"), " ".join(["a b"] * 100), " ".join(["a b"] * 50 + [f"w{i}" for i in range(98)]),
        " ".join(f"w{i}" for i in range(199)), many, "A" + "x" * 49, "A" + "x" * 48, many, " ".join(["one"] * 300), "a|b", "a b #",
    ]
    return [(i, t, "en", ("p", "q")[i % 2], len(t), *odd.CLASH) for i, t in enumerate(texts)]


def by_steps(rows: list[tuple]) -> set[tuple]:
    """Every order applied to the rows, filter by filter."""
    docs = []
    for r in rows:
        t = r[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failing = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": r[0] is not None and any(o[0] is not None and o[0] < r[0] and (o[1] or "") == t for o in rows),
        }
        good, toxic = (any(x[0] == r[0] and x[i] == 1 for x in LABELS if x[0] is not None) for i in (1, 2))
        docs.append((r[3] or "", {f for f, bad in failing.items() if bad}, good, toxic))
    out, shapley = [], {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                here = [d for d in left if f in d[1]]
                failing = [d for d in docs if d[0] == part and f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
                only = sum(d[1] == {f} for d in failing)
                out.append((part, order, step, len(left), len(here), len(failing) - len(here), only, sum(d[2] for d in here), sum(d[3] for d in here)))
    return {(*o, shapley[o[0], o[1][o[2] - 1]]) for o in out}


@pytest.mark.parametrize("rows", [odd.odd_rows(), wide_texts(), odd.unique_rows() * 3], ids=["odd", "thresholds", "repeated"])
def test_audit_equals_filters_applied_in_every_order(spark, rows):
    table = odd.table(spark, rows).repartition(3)
    got = [tuple(r) for r in audit.audit_filters(table, labels(spark)).collect()]
    want = by_steps(rows)
    assert set(got) == want and len(got) == len(want) == 600 * len({r[3] or "" for r in rows})


def test_audit_equals_sql(spark):
    for rows in (odd.unique_rows(), wide_texts()):
        want, columns = odd.sql_rows(audit.SQL, rows, labels=labels_arrow())
        found = audit.audit_filters(odd.table(spark, rows), labels(spark))
        assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == want


def test_audit_of_empty_tables(spark):
    assert audit.audit_filters(odd.table(spark, []), labels(spark)).count() == 0
    rows = odd.unique_rows()
    without = audit.audit_filters(odd.table(spark, rows), labels(spark, []))
    assert without.where("good_lost > 0 OR toxic_lost > 0").count() == 0 and without.count() == 1800


def test_steps_of_an_order_add_up(spark):
    found = audit.audit_filters(odd.table(spark, odd.odd_rows()), labels(spark))
    ends = found.groupBy("part", "filter_order").agg((F.max(F.when(F.col("step") == 5, F.col("kept"))) + F.sum("removed")).alias("all"))
    assert ends.groupBy("part").agg(F.count_distinct("all").alias("n")).where("n <> 1").count() == 0


def test_shuffle_paths_give_the_same(spark, no_small_tables):
    rows = odd.odd_rows()
    assert {tuple(r) for r in audit.audit_filters(odd.table(spark, rows), labels(spark)).collect()} == by_steps(rows)
