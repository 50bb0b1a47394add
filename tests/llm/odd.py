"""Small tables with what real ones hold now and then: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa

WORDS = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they one".split()

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, score string, class int,"
    " key string, items string, spans string, size string, component_id string, kept string, words int, `__row` int, label string, places string, epochs string,"
    " target string, closed string, tie string, class_id int, n string"
)
CLASH = (7, "x", 1, "y", "z", "z", "z", "z", "z", 3, 4, "l", "p", "e", "t", "c", "i", 5, "n")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def texts() -> list[str | None]:
    rng = random.Random(11)
    base = sentence(rng, 120).split(" ")
    near = [*base]
    near[50] = "changed"
    far = [*base]
    far[::4] = ["other"] * len(far[::4])
    line = sentence(rng, 40)
    return [
        None, "", " \n\t ", "word", "four words are here", "Four  WORDS\tare here", " ".join(base), " ".join(near), " ".join(far),
        " ".join(base).upper(), " ".join(base), f"{line}\nshort\n{line}\nshort", f"first\n{line}\nlast of all",
        "a b c a b c a b c a b c", "ünï ünï ünï ünï ñandú ß K İ", "cc by cc by all rights reserved General Public License",
        "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0", sentence(rng, 30_000), "x" * 100_000,
        "mail a.b@c.de, call +1 (202) 555-0143, pay 4111 1111 1111 1111 from 10.0.0.255", "### $$$ %%% &&& ***",
        "say <|endoftext|> now<|endoftext|>", "the" + "\u0436" * 300 + "x" * 300,
    ]


def unique_rows() -> list[tuple]:
    """One row per text, ids 0, 1, ..., two sources and a null one."""
    return [(i, t, "en", ("b", "a", None)[i % 3], len(t or ""), *CLASH) for i, t in enumerate(texts())]


def odd_rows() -> list[tuple]:
    """`unique_rows`, some of them twice, with null ids, and one id with two texts."""
    rows = unique_rows()
    return rows + rows[:8] + [(None, *r[1:]) for r in rows[4:9]] + [(6, "another text of the same id", "en", "a", 5, *CLASH)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sql_rows(sql: str, rows: list[tuple], **tables) -> dict[str, list]:
    """What DuckDB makes of `sql` over documents and further tables, by column."""
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "source": pa.array([r[3] for r in rows], pa.string())}))
    for name, t in tables.items():
        con.register(name, t)
    out = con.sql(sql)
    return sorted(map(tuple, out.fetchall()), key=repr), out.columns
