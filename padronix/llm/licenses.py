"""License scans by diagonal voting: word k-grams meet template places in a join, votes of one diagonal are one place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padronix.llm.batches import materialize, shared_folder
from padronix.llm.quality import let

K = 2  # words of a gram: the shortest phrase has two
NEAR = 2  # diagonals that far apart, at overlapping places, are one place with words put in or left out
COVER = 0.8  # share of a template's grams that a place must hold
# All of ASCII but a-z and 0-9, one by one: Java's patterns look single characters up, ranges they compare in turn.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isdigit() and not chr(c).islower()) + "]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


# Phrases of well-known licenses in lower case, words between spaces.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nd", "licensed under cc by nd 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc0", "cc0 1 0 universal public domain dedication"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mpl-2.0", "mozilla public license version 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def lowered(text: Column) -> Column:
    """A-Z lower-cased, null as empty.

    Beyond ASCII more letters change, but none becomes an ASCII one: the two that would (Kelvin sign, dotted I) are
    replaced first, so words are cut alike and ASCII phrases match only ASCII letters.
    """
    t = F.coalesce(text, F.lit(""))
    for odd in ("K", "İ"):
        t = F.replace(t, F.lit(odd), F.lit("�"))
    return F.lower(t)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """One row per gram of each template; as large as the list of templates."""
    rows = []
    for number, t in enumerate(templates):
        words = t.text.split()
        if len(words) < K:
            raise ValueError(f"template {t.text!r} has fewer than {K} words")
        n = len(words) - K + 1
        rows += [(number, t.label, t.base, n, i, " ".join(words[i : i + K])) for i in range(n)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, n_grams int, t_place int, gram string").withColumn(
        "hash", F.xxhash64("gram")
    )


def votes(docs: DataFrame, key: str, text: str, templates: tuple[Template, ...]) -> DataFrame:
    """(key, text hash, template, diagonal, template place) of every gram that a template has at a place, once each.

    All rolling grams of all texts meet the broadcast template grams on hash and words, so every vote is verified.
    """
    grams = let(
        words_of(F.col(text)),
        lambda w: F.when(
            F.size(w) >= K,
            F.transform(F.sequence(F.lit(0), F.size(w) - K), lambda i: F.concat_ws(" ", *[w[i + j] for j in range(K)])),
        ).otherwise(F.array().cast("array<string>")),
    )
    rolling = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.posexplode(grams).alias("place", "gram"))
    known = template_grams(docs.sparkSession, templates)
    met = rolling.withColumn("hash", F.xxhash64("gram")).join(F.broadcast(known), ["hash", "gram"])
    return met.select(
        "key", "tie", "template", "label", "base", "n_grams", "t_place", (F.col("place") - F.col("t_place")).alias("diagonal")
    ).distinct()


def places(voted: DataFrame) -> DataFrame:
    """Places of templates: (key, tie, template, label, base, first_word, last_word, cover), neighbouring diagonals merged."""
    by = ["key", "tie", "template", "label", "base", "n_grams"]
    lines = voted.groupBy(*by, "diagonal").agg(
        F.collect_set("t_place").alias("seen"), F.min("t_place").alias("low"), F.max("t_place").alias("high")
    )
    order = "PARTITION BY key, tie, template ORDER BY diagonal"
    lines = lines.withColumn("gap", F.expr(f"diagonal - lag(diagonal) OVER ({order})"))
    lines = lines.withColumn("opens", (F.coalesce(F.col("gap"), F.lit(NEAR + 1)) > F.least(F.lit(NEAR), F.col("n_grams") - 1)).cast("int"))
    lines = lines.withColumn("place", F.expr(f"sum(opens) OVER ({order})"))
    merged = lines.groupBy(*by, "place").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("n"),
        F.min(F.col("diagonal") + F.col("low")).alias("first_word"),
        (F.max(F.col("diagonal") + F.col("high")) + K - 1).alias("last_word"),
    )
    return merged.select(*by[:-1], "first_word", "last_word", (F.col("n") / F.col("n_grams")).alias("cover"))


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES, cover: float = COVER,
) -> DataFrame:
    """One row per row of `docs`: the key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places where all words of a base phrase stand consecutively; first_word and last_word are the
    smallest and largest start of them, in words from 0, else null. labels adds those of templates of which a place
    holds a share `cover` of the grams. score is the largest such share, 1 where a base phrase stands, 0 without any.
    Rows are told apart by key and text hash, so null or repeated keys do no harm and equal rows get equal results. A
    null text has no words. Columns of `docs` beyond key and text are not returned.

    The texts are read twice, once for votes, which are written to the shared folder, and once for words. Only grams
    that meet a template are exchanged; a document's few votes are one group. Templates are a short list,
    the only thing broadcast. Native: column expressions and joins alone.
    """
    voted = materialize(votes(docs, key, text, templates), shared_folder(docs.sparkSession), "votes")
    whole = voted.where("base").groupBy("key", "tie", "template", "label", "n_grams", "diagonal").agg(F.count("*").alias("n")).where("n = n_grams")
    base = whole.groupBy("key", "tie").agg(
        F.count("*").alias("n_base"), F.min("diagonal").cast("bigint").alias("first_word"),
        F.max("diagonal").cast("bigint").alias("last_word"), F.collect_set("label").alias("base_set"),
    )
    near = places(voted.where("NOT base")).where(F.col("cover") >= cover).groupBy("key", "tie").agg(
        F.collect_set("label").alias("near_set"), F.max("cover").alias("near_cover")
    )
    near = near.select(F.col("key").alias("n_key"), F.col("tie").alias("n_tie"), "near_set", "near_cover")
    found = base.join(near, F.col("key").eqNullSafe(F.col("n_key")) & (F.col("tie") == F.col("n_tie")), "full").select(
        F.coalesce("key", "n_key").alias("f_key"), F.coalesce("tie", "n_tie").alias("f_tie"),
        "n_base", "first_word", "last_word", "base_set", "near_set", "near_cover",
    )
    counted = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.size(words_of(F.col(text))).cast("bigint").alias("n_words"))
    joined = counted.join(found, F.col("key").eqNullSafe(F.col("f_key")) & (F.col("tie") == F.col("f_tie")), "left")
    empty = F.array().cast("array<string>")

    def listed(*sets: str) -> Column:
        return F.array_join(F.array_sort(F.array_union(*[F.coalesce(F.col(s), empty) for s in (sets * 2)[:2]])), ",")

    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.col("near_cover"), F.lit(0.0)))
    return joined.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        listed("base_set").alias("base_labels"), listed("base_set", "near_set").alias("labels"), score.alias("score"),
    )


def _sql(templates: tuple[Template, ...]) -> str:
    """DuckDB SQL for op9, over documents(doc_id, text), with the same templates."""
    rows = ", ".join(
        f"({n}, '{t.label}', {str(t.base).lower()}, {len(t.text.split()) - 1}, {i}, '{' '.join(t.text.split()[i : i + 2])}')"
        for n, t in enumerate(templates)
        for i in range(len(t.text.split()) - 1)
    )
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t(template, label, base, n_grams, t_place, gram) AS (VALUES {rows}),
g AS (SELECT doc_id, i - 1 AS place, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
v AS (SELECT DISTINCT doc_id, template, label, base, n_grams, t_place, place - t_place AS diagonal FROM g JOIN t USING (gram)),
b AS (
  SELECT doc_id, label, diagonal FROM v WHERE base GROUP BY doc_id, template, label, n_grams, diagonal HAVING count(*) = n_grams),
n AS (
  SELECT doc_id, template, label, n_grams, t_place, diagonal, sum(opens) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS place
  FROM (
    SELECT *, CASE WHEN coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal, t_place), {NEAR + 1})
                        > least({NEAR}, n_grams - 1) THEN 1 ELSE 0 END AS opens
    FROM v WHERE NOT base)),
m AS (
  SELECT doc_id, label, count(DISTINCT t_place) / CAST(n_grams AS DOUBLE) AS cover FROM n
  GROUP BY doc_id, template, label, n_grams, place HAVING cover >= {COVER}),
s AS (
  SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
l AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM m) GROUP BY doc_id),
c AS (SELECT doc_id, max(cover) AS cover FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(cover, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
"""


SQL = _sql(TEMPLATES)
