"""Names matched by edit distance."""

import random

from padronix.operators import spelling
from padronix.plans import registry


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, above = [i], row
        for j, e in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (c != e)))
    return row[-1]


def test_matches_equal_comparing_all_pairs(spark):
    rng = random.Random(3)
    known = sorted({"".join(rng.choice("abñ ") for _ in range(rng.randint(0, 9))) for _ in range(60)})
    seen = ["".join(rng.choice("abñ ") for _ in range(rng.randint(0, 11))) for _ in range(300)] + ["", None, "a", "a"]
    df = spark.createDataFrame([(s,) for s in seen], "s string")
    names = spark.createDataFrame([(k,) for k in [*known, known[0], None]], "k string")
    for most in (0, 1, 2, 3):
        want = set()
        for s in {s for s in seen if s is not None}:
            near = sorted((distance(s, k), k) for k in known if distance(s, k) <= most)
            best = [k for d, k in near if d == near[0][0]]
            want.add((s, seen.count(s), best[0] if len(best) == 1 else None, near[0][0] if near else None, len(best)))
        got = spelling.match_names(df, "s", names, "k", most)
        assert got.columns == ["s", "n", "match", "distance", "n_ties"] and {tuple(r) for r in got.collect()} == want


def test_repair_keeps_what_is_not_settled(spark):
    df = spark.createDataFrame([(1, "Cordva"), (2, "Córdoba"), (3, "zzz"), (4, None), (5, "ab")], "id int, name string")
    known = spark.createDataFrame([("Córdoba",), ("ax",), ("ay",)], "name string")
    found = spelling.match_names(df, "name", known, "name")
    fixed = spelling.repair_names(df, "name", found)
    assert fixed.columns == ["id", "name"]
    assert {r.id: r.name for r in fixed.collect()} == {1: "Cordva", 2: "Córdoba", 3: "zzz", 4: None, 5: "ab"}
    loose = spelling.match_names(df, "name", known, "name", 3)
    assert {r.id: r.name for r in spelling.repair_names(df, "name", loose).collect()}[1] == "Córdoba"
    assert {r.name for r in spelling.unsettled_names(found).collect()} == {"Cordva", "zzz", "ab"}
    assert spelling.match_names(df, "name", known.limit(0), "name").where("match IS NOT NULL OR n_ties > 0").count() == 0


def test_province_spellings(spark):
    planted = {"Cordova": "Córdoba", "NEUQEN": "Neuquén", "Santa fé": "Santa Fe", "Tierra del Fugo": "Tierra del Fuego", "Atlantis": None}
    df = spark.createDataFrame([(p,) for p in planted], "province string")
    assert {r.province: r.match for r in registry.province_spellings(df).collect()} == planted
