"""Quality rules: a threshold table compiled into Spark column expressions, without user functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r" \t\n\x0B\f\r"
WORD = rf"[^{SPACE}]+"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "was", "for", "with", "be", "on", "it", "as", "by", "this",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein",
    "de", "la", "le", "les", "et", "que", "un", "une", "du", "est", "pour", "en", "qui", "dans", "par", "sur",
    "el", "los", "se", "del", "las", "con", "una", "su", "para", "al", "como", "por", "más", "lo", "y", "a",
)
_STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})


@dataclass(frozen=True)
class Rule:
    """`feature` must lie within low..high; None leaves a side open."""

    name: str
    feature: str
    low: float | None = None
    high: float | None = None


# Production thresholds. Ratios are shares from 0 to 1; mean_word is in code points.
RULES = (
    Rule("length", "n_words", low=50, high=1_000_000),
    Rule("mean_word", "mean_word", low=2.0, high=20.0),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_ratio", low=0.02),
    Rule("dup_lines", "dup_line_ratio", high=0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def features(text: str) -> dict[str, Column]:
    """Counts of one text; a null text counts as empty. Words are runs without ASCII white space."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.col("__words")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    n = F.size(words).cast("bigint")
    return {
        "n_words": n,
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_repeat_words": repeated_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*_STOP_FORMS))).cast("bigint"),
    }


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the array.

    A text whose window hashes all differ, as most do, has none. Else the hashes are shifted to make room for the
    window's place, so that one sort of long values brings equal ones together; windows beside an equal hash are
    then compared by their words, so the count is exact.
    """

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def beside_equal(values: Column, equal: Callable[[Column, Column], Column]) -> Column:
        """Members of a sorted array that equal the one before or after."""
        return F.filter(
            values,
            lambda x, i: F.coalesce(equal(F.get(values, i - 1), x), F.lit(False))
            | F.coalesce(equal(F.get(values, i + 1), x), F.lit(False)),
        )

    def candidates(h: Column) -> Column:
        """Places whose hash, but for the bits shifted out, is that of another place."""

        def with_bits(bits: Column) -> Column:
            place = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

            def same(x: Column, y: Column) -> Column:
                return F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0

            keyed = F.transform(h, lambda x, i: F.call_function("shiftleft", x, bits) + i)
            return let(
                F.sort_array(keyed),
                lambda k: let(place, lambda p: F.transform(beside_equal(k, same), lambda x: x.bitwiseAND(p).cast("int"))),
            )

        return let(F.length(F.bin(F.size(h))).cast("int"), with_bits)

    def proven(at: Column, w: Column) -> Column:
        """Places whose window's words occur at another candidate place as well, ascending."""
        spelt = F.transform(at, lambda p: F.struct(F.concat_ws(" ", w[p], w[p + 1], w[p + 2]).alias("g"), p.alias("p")))
        return let(
            F.sort_array(spelt),
            lambda s: F.sort_array(F.transform(beside_equal(s, lambda x, y: x["g"] == y["g"]), lambda x: x["p"])),
        )

    def covered(places: Column) -> Column:
        """Words under windows of three at ascending places."""
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
            lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
            lambda a: a["n"],
        )

    def count(w: Column, h: Column) -> Column:
        none = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(none, F.lit(0).cast("bigint")).otherwise(let(candidates(h), lambda at: covered(proven(at, w))))

    return F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(
        let(words, lambda w: let(hashes(w), lambda h: count(w, h)))
    )


def ratios() -> dict[str, Column]:
    """Ratios of the counts that `features` names; 0 where a text has no words or lines."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return {
        "mean_word": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "word_chars"),
        "stop_ratio": share("n_stop_words", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
    }


def verdict(rules: tuple[Rule, ...]) -> Column:
    """True where every rule holds: the table as one conjunction."""
    ok = F.lit(True)
    for r in rules:
        value = F.col(r.feature)
        if r.low is not None:
            ok = ok & (value >= r.low)
        if r.high is not None:
            ok = ok & (value <= r.high)
    return ok


def failed_rules(rules: tuple[Rule, ...]) -> Column:
    """Names of the rules that a row breaks, in the table's order."""
    broken = [F.when(~verdict((r,)), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*broken))


def score_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """`docs` with counts, ratios, base_failed, kept and failed (names of broken rules), as one projection.

    base_failed: fewer than 50 words, or over half of the words lie in repeated three-word windows. kept: not
    base_failed, and every rule holds. Every row is returned once; a null text counts as empty and fails. Columns of
    `docs` named as new ones are replaced. No exchange, no user functions; long texts cost n log n.
    """
    base = docs if keep is None else docs.select(*dict.fromkeys([*keep, text]))
    held = [c for c in (docs.columns if keep is None else keep)]
    t = F.coalesce(F.col(text), F.lit(""))
    counted = base.withColumn("__words", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
    counted = counted.select(*[F.col(c).alias(f"__in_{i}") for i, c in enumerate(held)], *[v.alias(k) for k, v in features(text).items()])
    scored = counted.withColumns(ratios())
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = scored.withColumn("base_failed", base_failed)
    scored = scored.withColumn("kept", ~F.col("base_failed") & verdict(rules)).withColumn("failed", failed_rules(rules))
    new = [c for c in scored.columns if not c.startswith("__in_")]
    taken = {c.lower() for c in new}
    return scored.select(*[F.col(f"__in_{i}").alias(c) for i, c in enumerate(held) if c.lower() not in taken], *new)


# DuckDB SQL for the counts, over documents(doc_id, text).
SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
v AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM g),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM v) WHERE k > 1),
c AS (SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS o(d) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({stop}))) AS n_stop
  FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words <= 1000000 AND word_chars / n_words BETWEEN 2.0 AND 20.0
       AND n_symbols / word_chars <= 0.1 AND n_stop / n_words >= 0.02
       AND n_dup_lines / n_lines <= 0.5 AS kept
FROM b
""".replace("{stop}", ", ".join(f"'{w}'" for w in _STOP_FORMS))
