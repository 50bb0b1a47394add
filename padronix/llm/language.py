"""Language by segmentation-marginalised unigrams: the probability of a word under a language is the sum over all ways
to cut it into pieces of a fixed public vocabulary, each piece with a probability of its own in that language.

A text's words are cut independently, so its probability is the product over its words; each distinct word is summed
once by a forward pass. Piece probabilities are learned by expectation maximisation over the same sums.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.llm.batches import append_columns
from padronix.llm.toxicity import held_out

ROWS_PER_LANGUAGE = 400  # most texts per language that a fit uses: those of the smallest hashes of their ids
BROADCAST_ROWS = 100_000  # most rows of a table of chosen keys that is broadcast
ROUNDS = 3
LONGEST_PIECE = 16
LETTERS_AT_ONCE = 1 << 18  # letters of the words that are summed side by side
MEMO_VALUES = 2_000_000  # numbers (words times languages) that a task remembers
UNSEEN = 1e-7  # probability of a letter that is no piece, and share of what all languages have in common
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 22


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def letter_pieces(vocabulary_file: str) -> list[str]:
    """Pieces of a sentencepiece vocabulary that a lower-case word can hold; `▁` opens a word."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary_file)
    found = {pieces.id_to_piece(i).lower() for i in range(pieces.get_piece_size())}
    return sorted(p for p in found if len(p) <= LONGEST_PIECE and p.replace("▁", "", p.startswith("▁")).isalpha() or p == "▁")


class Pieces:
    """Finds pieces in words by rolling hashes: a table of slots rules most substrings out, a sorted list decides."""

    def __init__(self, pieces: list[str]):
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self._order = np.argsort(hashes)
        self._sorted = hashes[self._order]
        self._slots = np.zeros(1 << _SLOT_BITS, bool)
        self._slots[self._slot(hashes)] = True
        self.size = len(pieces)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - _SLOT_BITS)

    def places(self, codes: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end 1..n of equally long words (rows of code points): (start, rows, piece ids) of pieces that end there."""
        n = codes.shape[1]
        ends: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(n + 1)]
        hashes = np.zeros((len(codes), n), np.uint64)
        for length in range(1, min(n, LONGEST_PIECE) + 1):
            hashes = hashes[:, : n - length + 1] * _MULTIPLIER + codes[:, length - 1 :] + np.uint64(1)
            row, start = np.nonzero(self._slots[self._slot(hashes)])
            sought = hashes[row, start]
            at = np.minimum(np.searchsorted(self._sorted, sought), self.size - 1)
            real = self._sorted[at] == sought
            row, start, piece = row[real], start[real], self._order[at[real]]
            by_start = np.argsort(start, kind="stable")
            row, start, piece = row[by_start], start[by_start], piece[by_start]
            cuts = np.searchsorted(start, np.arange(n - length + 2))
            found = range(n) if length == 1 else np.flatnonzero(np.diff(cuts)).tolist()
            for i in found:
                ends[i + length].append((i, row[cuts[i] : cuts[i + 1]], piece[cuts[i] : cuts[i + 1]]))
        return ends


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    sizes = np.array([len(w) for w in words])
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


def _codes(words: list[str]) -> np.ndarray:
    """Code points of equally long words, `▁` in front."""
    joined = "".join("▁" + w for w in words)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _parts(words: list[str]) -> Iterator[np.ndarray]:
    """Places of equally long words, in groups of a bounded number of letters."""
    for n, where in _by_length(words).items():
        step = max(1, LETTERS_AT_ONCE // (n + 1))
        for low in range(0, len(where), step):
            yield where[low : low + step]


def _forward(ends: list, n_words: int, probability: np.ndarray) -> list[np.ndarray]:
    """Logarithms of the sums over all cuts of the first i letters, for i = 0..n, per word and language.

    A letter that is no piece is unseen. Each sum is taken in units of the one before, so words of any length stay in range.
    """
    logs = [np.zeros((n_words, probability.shape[1]))]
    for end in range(1, len(ends)):
        last = logs[end - 1]
        total = np.full_like(last, UNSEEN)
        for start, rows, pieces in ends[end]:
            if start == end - 1:
                total[rows] += probability[pieces] - UNSEEN
            else:
                total[rows] += probability[pieces] * np.exp(logs[start][rows] - last[rows])
        logs.append(last + np.log(total))
    return logs


def word_log_probabilities(words: list[str], pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Natural logarithms, a row per word and a column per language."""
    out = np.zeros((len(words), probability.shape[1]))
    for part in _parts(words):
        out[part] = _forward(pieces.places(_codes([words[i] for i in part])), len(part), probability)[-1]
    return out


def _expected(words: list[str], counts: np.ndarray, pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all cuts of the counted words, under one language's probabilities."""
    uses = np.zeros(pieces.size)
    for part in _parts(words):
        ends = pieces.places(_codes([words[i] for i in part]))
        logs = [x[:, 0] for x in _forward(ends, len(part), probability)]
        # Expected number of cuts at each place, from the end back: what goes through it, times the word's count.
        through = [np.zeros(len(part)) for _ in ends]
        through[-1][:] = counts[part]
        for end in range(len(ends) - 1, 0, -1):
            for start, rows, found in ends[end]:
                flow = through[end][rows] * np.exp(logs[start][rows] - logs[end][rows]) * probability[found, 0]
                uses += np.bincount(found, flow, pieces.size)
                if start == end - 1:
                    unseen = through[end] * np.exp(logs[start] - logs[end]) * UNSEEN
                    unseen[rows] = 0
                    through[start] += unseen
                through[start][rows] += flow
    return uses


@dataclass(frozen=True)
class Model:
    """Piece probabilities (pieces by languages); without languages nothing is recognised."""

    pieces: list[str]
    languages: list[str]
    probability: np.ndarray


def fit(pieces: list[str], counted: dict[str, dict[str, int]], rounds: int = ROUNDS) -> Model:
    """Expectation maximisation per language from even probabilities; a thousandth of each is what all have in common."""
    finder, languages = Pieces(pieces), sorted(counted)
    uses = []
    for language in languages:
        words = sorted(counted[language])
        counts = np.array([counted[language][w] for w in words], float)
        p = np.full((len(pieces), 1), 1 / len(pieces))
        for _ in range(rounds):
            u = _expected(words, counts, finder, p)
            p = ((u + 1e-3) / (u.sum() + 1e-3 * len(u)))[:, None]
        uses.append(u)
    if not languages:
        return Model(pieces, [], np.zeros((len(pieces), 0)))
    own = np.stack([u / max(u.sum(), 1e-9) for u in uses], axis=1)
    return Model(pieces, languages, np.maximum(0.999 * own + 0.001 * own.mean(axis=1, keepdims=True), UNSEEN))


def learn(
    docs: DataFrame, vocabulary_file: str, key: str = "doc_id", text: str = "text", language: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> Model:
    """A model from rows with a language outside the held-out ones.

    Of each language at most `rows_per_language` keys are used, those of the smallest hashes; a hash bound from the
    language's number of keys leaves about four times as many to rank. Of rows of equal key and language the smallest text is used.
    Distinct words with counts come to the driver, texts do not. Null texts, keys and languages are left out.
    """
    known = docs.where(F.col(language).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    keys = known.select(F.col(key).alias("key"), F.col(language).alias("language"))
    sizes = keys.groupBy("language").agg(F.approx_count_distinct("key", 0.02).alias("n"))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    # About four times the wanted rows stay per language, however many it has: they are ranked in one task.
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 40)).alias("place")
    near = keys.join(sizes, "language").select("key", "language", place, "n").where(F.col("place").cast("double") * F.col("n") < float(4 * rows_per_language * (1 << 40))).distinct()
    ranked = near.withColumn("rank", F.expr("row_number() OVER (PARTITION BY language ORDER BY place, key)"))
    chosen = ranked.where(F.col("rank") <= rows_per_language).select("key", "language")
    texts = docs.select(F.col(key).alias("key"), F.col(language).alias("language"), F.col(text).alias("text"))
    few = chosen.count() <= BROADCAST_ROWS
    sample = texts.join(F.broadcast(chosen) if few else chosen, ["key", "language"])
    sample = sample.groupBy("key", "language").agg(F.min("text").alias("text"))  # a repeated key counts once
    fields = T.StructType([T.StructField("words", T.ArrayType(T.StringType()))])

    def start():
        return lambda texts: [[words_of(t) if t else [] for t in texts.cast(pa.string()).to_pylist()]]

    words = append_columns(sample, "text", fields, start, ["language"]).select("language", F.explode("words").alias("word"))
    counted: dict[str, dict[str, int]] = {}
    for r in words.groupBy("language", "word").count().toArrow().to_pylist():
        counted.setdefault(r["language"], {})[r["word"]] = r["count"]
    return fit(letter_pieces(vocabulary_file), counted)


FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict_language(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with lang_pred and score of every whole text.

    lang_pred is the language of the largest probability, the first in order on a tie; `und`, with score 0, where the
    text is null or has no letter or nothing was learned. score is that language's share of all languages' probability.
    Every row is returned once. Columns of `docs` named as new ones are replaced. The broadcast model has the
    vocabulary's size times the number of languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        finder, limit = Pieces(m.pieces), max(1, MEMO_VALUES // max(1, len(m.languages)))
        place: dict[str, int] = {}
        logs = np.zeros((1024, len(m.languages)))

        def remember(words: list[str]) -> None:
            nonlocal logs
            if len(place) + len(words) > limit:
                place.clear()
            first = len(place)
            while first + len(words) > len(logs):
                logs = np.concatenate((logs, np.zeros_like(logs)))
            logs[first : first + len(words)] = word_log_probabilities(words, finder, m.probability)
            place.update(zip(words, range(first, first + len(words)), strict=True))

        def one(text: str | None, words: list[str]) -> tuple[str, float]:
            if not m.languages or not (any(map(str.isalpha, words)) or text and any(map(str.isalpha, text))):
                return UNKNOWN, 0.0
            total = logs[list(map(place.__getitem__, words))].sum(axis=0)
            best = int(np.argmax(total))
            return m.languages[best], float(1 / np.exp(total - total[best]).sum())

        def compute(texts: pa.Array) -> list:
            rows = texts.cast(pa.string()).to_pylist()
            cut = [words_of(t) if t else [] for t in rows]
            out = []
            for low in range(0, len(cut), 100):
                part = cut[low : low + 100]
                needed = set().union(*part)
                missing = [w for w in needed if w not in place]
                if len(place) + len(missing) > limit:
                    missing = list(needed)
                if missing and m.languages:
                    remember(missing)
                out += [one(t, w) for t, w in zip(rows[low : low + 100], part, strict=True)]
            return [[o[0] for o in out], [o[1] for o in out]]

        return compute

    return append_columns(docs, text, FIELDS, start, keep)
