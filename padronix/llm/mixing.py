"""Mixing sources to target weights: complete epochs, then weighted sampling without replacement to a word budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padronix.llm.batches import materialize, shared_folder
from padronix.llm.quality import SPACE

MAX_EPOCHS = 3
BROADCAST_SOURCES = 100_000  # most rows of a table of sources that is broadcast: about 10 MB
_BITS = 40  # of an order key; each of two levels of cells takes 10 of them


def word_count(text: Column) -> Column:
    """Runs without ASCII white space; 0 for null."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^{SPACE}]+"), F.lit(0))).cast("bigint")


def plain_quality(text: Column) -> Column:
    """0.1 to 1: the share of characters that are neither digits nor symbols."""
    t = F.coalesce(text, F.lit(""))
    plain = F.length(F.regexp_replace(t, r"[0-9#*$%&|<>]", "")) / F.greatest(F.length(t), F.lit(1))
    return F.lit(0.1) + F.lit(0.9) * plain


def order_key(key: Column, quality: Column, seed: int) -> Column:
    """An exponential variate of rate `quality`, made from a hash of the key, mapped in order to 0 .. 2^40 - 1.

    Taking the smallest keys first draws without replacement, with chances in proportion to quality.
    """
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    wait = -F.log(uniform) / quality
    return F.floor(wait / (wait + 1) * float(1 << _BITS)).cast("bigint")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = (1, 2, 3), most: float = MAX_EPOCHS) -> dict[str | None, float]:
    """Words to take of each source: shares of all words by weight, at most `most` times its size, the rest dealt anew.

    Sources by code point, null last, get the weights in turn, repeating.
    """
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


def _join_key(source: Column) -> Column:
    """Null-safe and joinable: null sources are one source of their own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _straddling(cells: DataFrame, by: list[str], cell: str, budget: str) -> DataFrame:
    """The one cell of each source in which the running size passes the budget, with the size of the cells before it."""
    running = f"sum(size) OVER (PARTITION BY {', '.join(by)} ORDER BY {cell})"
    summed = cells.withColumn("upto", F.expr(running)).withColumn("before", F.col("upto") - F.col("size"))
    return summed.where(f"before < {budget} AND upto >= {budget}").select(*by, cell, "before", budget)


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", size: Column | None = None,
    quality: Column | None = None, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7,
) -> DataFrame:
    """`docs` with size, source_size, target, copies and taken (size times copies).

    Every source is taken in whole epochs as far as its target holds them; what is missing is drawn from it by
    exponential keys of rate `quality`, up to the document whose end lies nearest to the target. Documents are taken
    whole. The same table gives the same mix. Null sources are one source; a null text has size 0 and takes nothing;
    equal keys are ordered by text hash and size; of rows equal in all of these as many are taken
    as the target needs, whichever. Columns of `docs` named as new
    ones are replaced.

    No task sorts a source: running sums go over 1,024 cells of the key's range per source, then over 1,024 parts of the
    cell that straddles the budget, then over the documents of one part. The driver holds one row per source, which is
    what weights are given for.
    """
    spark = docs.sparkSession
    size = word_count(F.col(text)) if size is None else size
    quality = plain_quality(F.col(text)) if quality is None else quality
    place = {
        "__size": size, "__order": order_key(F.col(key), quality, seed), "__tie": F.xxhash64(F.col(text)),
        "__key": F.col(key).cast("string"), "__source": _join_key(F.col(source)),
    }
    sized = materialize(
        docs.select(
            F.col(source).alias("source"), place["__source"].alias("s"), place["__size"].alias("size"),
            place["__order"].alias("o"), place["__key"].alias("k"), place["__tie"].alias("tie"),
        ),
        shared_folder(spark), "sized",
    )
    totals = sized.groupBy("s", "source").agg(F.sum("size").alias("size")).collect()
    sizes = {r["source"]: r["size"] for r in totals}
    wanted = targets(sizes, weights)
    epochs = {s: min(MAX_EPOCHS, int(wanted[s] // n)) if n else 0 for s, n in sizes.items()}
    plan = [(r["s"], r["size"], wanted[r["source"]], epochs[r["source"]], min(wanted[r["source"]] - epochs[r["source"]] * r["size"], r["size"])) for r in totals]
    budgets = spark.createDataFrame([(p[0], p[4]) for p in plan if p[4] > 0], "s string, budget double")

    drawn = sized.where("size > 0").withColumn("c1", F.expr("o DIV 1073741824")).withColumn("c2", F.expr("o DIV 1048576"))
    level1 = drawn.groupBy("s", "c1").agg(F.sum("size").alias("size")).join(budgets, "s")
    cell1 = _straddling(level1, ["s"], "c1", "budget")
    inner1 = drawn.join(F.broadcast(cell1) if len(plan) <= BROADCAST_SOURCES else cell1, ["s", "c1"]).withColumn("rest", F.col("budget") - F.col("before"))
    inner1 = inner1.select("s", "c2", "size", "o", "k", "tie", "rest")
    level2 = inner1.groupBy("s", "rest", "c2").agg(F.sum("size").alias("size"))
    cell2 = _straddling(level2, ["s"], "c2", "rest").withColumn("need", F.col("rest") - F.col("before"))
    last = inner1.drop("rest").join(cell2.select("s", "c2", "need"), ["s", "c2"])
    # Equal rows are one group of `n`, of which `fit` are taken.
    last = last.groupBy("s", "c2", "need", "o", "k", "tie", "size").agg(F.count("*").alias("n"))
    last = last.withColumn("upto", F.expr("sum(size * n) OVER (PARTITION BY s, c2 ORDER BY o, k, tie, size ROWS UNBOUNDED PRECEDING)"))
    last = last.withColumn("before", F.expr("upto - size * n"))
    last = last.withColumn("about", F.expr("CAST(least(greatest(floor((need - before) / size + 0.5D), 0), n) AS BIGINT)"))
    # The last document taken: of the two ends around the budget the nearer one, so a document may miss or exceed it.
    fits = "before + size * ({0}) - need <= need - (before + size * ({0} - 1))"
    last = last.withColumn("fit", F.expr(
        f"CASE WHEN about < n AND {fits.format('about + 1')} THEN about + 1 WHEN about > 0 AND NOT ({fits.format('about')}) THEN about - 1 ELSE about END"
    ))
    group = F.struct("o", "k", "tie", "size", "fit", "n")
    taken = last.where("fit > 0").groupBy("s").agg(F.max(group).alias("cut"))
    first = last.groupBy("s").agg(F.min(group).alias("first"))
    cuts = {r["s"]: r for r in first.join(taken, "s", "left").collect()}
    rows = []
    for s, n, target, epoch, _ in plan:
        cut = cuts.get(s)
        end = cut["cut"] or cut["first"] if cut else None
        rows.append((s, n, target, epoch, *(tuple(end) if end else (None,) * 6)))
    table = spark.createDataFrame(
        rows, "__s string, __n bigint, __target double, __epochs int, __cut_o bigint, __cut_k string, __cut_tie bigint, __cut_size bigint, __fit bigint, __equal bigint"
    )

    new = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c.lower() not in new]
    placed = docs.select(*[docs[c] for c in kept], *[v.alias(n) for n, v in place.items()])
    joined = placed.join(F.broadcast(table) if len(rows) <= BROADCAST_SOURCES else table, F.col("__source") == F.col("__s"), "left")
    here, cut = F.struct("__order", "__key", "__tie", F.col("__size").cast("bigint").alias("__size")), F.struct("__cut_o", "__cut_k", "__cut_tie", "__cut_size")
    cut_off = F.col("__cut_o").isNotNull()
    drawn_too = cut_off & ((here < cut) | (here == cut) & (F.col("__fit") == F.col("__equal")))
    if any(r[8] and r[8] < r[9] for r in rows):  # some of a group of equal rows: these are numbered
        shared = F.coalesce(cut_off & (here == cut) & (F.col("__fit") > 0) & (F.col("__fit") < F.col("__equal")), F.lit(False))
        at_cut = materialize(joined.where(shared).withColumn("__part", F.spark_partition_id()), shared_folder(spark), "cut")
        # Numbers run on over parts, each of them the rows of one task, so no task holds a group.
        parts = at_cut.groupBy("__s", "__part").count().withColumn("__past", F.expr("sum(count) OVER (PARTITION BY __s ORDER BY __part) - count"))
        parts = parts.select(F.col("__s").alias("__of"), F.col("__part").alias("__p"), "__past")
        numbered = at_cut.withColumn("__nth", F.expr("row_number() OVER (PARTITION BY __s, __part ORDER BY __order)"))
        numbered = numbered.join(parts, (F.col("__s") == F.col("__of")) & (F.col("__part") == F.col("__p")))
        numbered = numbered.select(*joined.columns, (F.col("__nth") + F.col("__past") <= F.col("__fit")).alias("__drawn"))
        joined = joined.where(~shared).select("*", drawn_too.alias("__drawn")).unionByName(numbered)
        drawn_too = F.col("__drawn")
    copies = F.col("__epochs") + F.coalesce(drawn_too, F.lit(False)).cast("int")
    return joined.select(
        *kept, F.col("__size").alias("size"), F.col("__n").alias("source_size"), F.col("__target").alias("target"),
        copies.alias("copies"), (F.col("__size") * copies).alias("taken"),
    )


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows of `docs`, columns as they are, each as often as the mix takes it; rows without words are left out."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), *[docs[c].alias(c) for c in {"doc_id", "source", text}])
    mixed = mix(rows, text=text, **options).where("taken > 0")
    return mixed.select("__row", F.explode(F.sequence(F.lit(1), "copies"))).select("__row.*")


# DuckDB SQL for op8, over documents(doc_id, text, source), with the same arithmetic.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(source, chr(1114111)) AS s, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS size,
         0.1::DOUBLE + 0.9::DOUBLE * (CAST(length(regexp_replace(coalesce(text, ''), '[0-9#*$%&|<>]', '', 'g')) AS DOUBLE)
           / greatest(length(coalesce(text, '')), 1)) AS q,
         (CAST(CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
o AS (SELECT *, CAST(floor((-ln(u) / q) / ((-ln(u) / q) + 1) * 1099511627776.0::DOUBLE) AS BIGINT) AS o FROM d),
w AS (
  SELECT s, CAST(sum(size) AS BIGINT) AS n, (row_number() OVER (ORDER BY s) - 1) % 3 + 1 AS weight FROM o GROUP BY s),
r AS (
  SELECT *, sum(n) OVER () - coalesce(sum(3 * n) OVER below, 0) AS spare, sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS open
  FROM w WINDOW below AS (ORDER BY 3.0::DOUBLE * n / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (
  SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * n / weight, s) AS nth, CAST(spare AS DOUBLE) * weight / open <= 3 * n AS fits FROM r),
f AS (SELECT nth AS first_open, CAST(spare AS DOUBLE) AS spare, CAST(open AS DOUBLE) AS open FROM k WHERE fits ORDER BY nth LIMIT 1),
t AS (
  SELECT s, n, CASE WHEN first_open IS NULL OR nth < first_open THEN 3.0::DOUBLE * n ELSE f.spare * weight / f.open END AS target
  FROM k LEFT JOIN f ON true),
e AS (
  SELECT *, CASE WHEN n > 0 THEN least(3, CAST(floor(target / n) AS INT)) ELSE 0 END AS epochs FROM t),
b AS (SELECT *, least(target - epochs * n, n) AS budget FROM e),
c AS (
  SELECT o.*, n, target, epochs, budget,
         sum(size) OVER (PARTITION BY o.s ORDER BY o, CAST(doc_id AS VARCHAR) ROWS UNBOUNDED PRECEDING) AS upto
  FROM o JOIN b USING (s))
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target,
       CAST(size * (epochs + CASE WHEN budget > 0 AND upto - budget <= budget - (upto - size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""
