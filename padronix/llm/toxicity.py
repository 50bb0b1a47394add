"""Toxicity: a sparse logistic classifier whose scores may not depend on which group a text names.

Training swaps identity terms in the labelled sentences that hold them: in every sentence a name is replaced by each other
name of its kind, and the squared change of the sentence's score is penalised. A bare mention is a sentence too, and is
also compared with saying nothing. Every name weighs the same, however often it or others occur, so a name in few texts is
freed as one in many, and neutral mentions stay below the threshold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.llm.batches import append_columns, kept_rows
from padronix.llm.decontamination import folded_words

THRESHOLD = 0.3
FIT_ROWS = 4000  # most labelled rows that a fit uses: those of the smallest hashes of their ids
MIN_ROWS = 3  # rows of the fit that a word must occur in
PREFIXES = (4, 5, 6, 7)
LEAST_Z = 4.0  # words whose use differs less between the classes get no weight
MEMO_WORDS = 300_000

# Names of groups by kind; any of a kind may stand for any other. Names may have several words.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary", "trans women", "trans men", "non-binary people"),
    ("woman", "man", "girl", "boy", "female", "male", "trans woman", "trans man"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"),
    ("gay people", "straight people", "gay men", "lesbian women"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "jewish people", "muslim people"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous", "roma", "middle eastern", "native american"),
    ("black people", "white people", "asian people", "people of color", "african americans", "native americans", "arabs", "sinti", "romani people"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "russian", "nigerian", "turkish"),
    ("immigrants", "refugees", "migrants", "foreigners", "natives", "asylum seekers", "undocumented immigrants"),
    ("disabled", "blind", "deaf", "autistic", "elderly", "young", "old"),
    ("disabled people", "blind people", "deaf people", "people with disabilities", "old people", "young people"),
)
Terms = tuple[tuple[str, ...], ...]
SENTENCE_END = re.compile(rb"[.!?\n]+")
CHANGE = 0.1  # a change of score that costs 1 per unit of the penalty's weight


def word_id(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> 1  # fits a signed long


def word_features(word: bytes) -> tuple[int, ...]:
    """A word and its first 4 to 7 characters, which stand for its inflected forms."""
    text = word.decode("utf-8", "replace")
    return (word_id(word), *(word_id(b"^" + text[:n].encode()) for n in PREFIXES if len(text) > n))


def held_out(key) -> object:
    """Column: rows of this key are never learned from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


@dataclass(frozen=True)
class Model:
    """Weights of words by hash; all other words weigh nothing."""

    bias: float
    weights: dict[int, float]

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logits + self.bias, -30, 30)))


def _telling(col: np.ndarray, row: np.ndarray, labels: np.ndarray, m: int) -> np.ndarray:
    """Columns whose shares of the two classes differ by over LEAST_Z standard errors, and that some row lacks."""
    n, n1 = len(labels), float(labels.sum())
    seen, seen1 = np.bincount(col, minlength=m), np.bincount(col, labels[row], m)
    p = seen / n
    spread = np.sqrt(p * (1 - p) * (1 / n1 + 1 / (n - n1)))
    z = np.abs(seen1 / n1 - (seen - seen1) / (n - n1)) / np.maximum(spread, 1e-12)
    return (seen < n) & (z > LEAST_Z)


def names_of(terms: Terms) -> list[list[tuple[bytes, ...]]]:
    """The words of every name, kind by kind."""
    return [[tuple(folded_words(name.encode())) for name in kind] for kind in terms]


def name_features(words: tuple[bytes, ...]) -> set[int]:
    return {x for w in words for x in word_features(w)}


class Finder:
    """Names in the sentences of a text; of names that overlap the longest counts."""

    def __init__(self, terms: Terms):
        self.by_first: dict[bytes, list[tuple[tuple[bytes, ...], int, int]]] = {}
        for k, kind in enumerate(names_of(terms)):
            for i, words in enumerate(kind):
                self.by_first.setdefault(words[0], []).append((words, k, i))
        for found in self.by_first.values():
            found.sort(key=lambda x: -len(x[0]))

    def uses(self, text: bytes) -> set[tuple[int, int, bytes]]:
        """(kind, name, the features of the sentence's other words) for every name and sentence that holds it."""
        out = set()
        for sentence in SENTENCE_END.split(text):
            words = folded_words(sentence)
            at: dict[tuple[int, int], set[int]] = {}
            i = 0
            while i < len(words):
                step = 1
                for name, k, j in self.by_first.get(words[i], ()):
                    if len(name) >= step and tuple(words[i : i + len(name)]) == name:
                        at.setdefault((k, j), set()).update(range(i, i + len(name)))
                        step = len(name)
                i += step
            for (k, j), places in at.items():
                rest = {x for p, w in enumerate(words) if p not in places for x in word_features(w)}
                out.add((k, j, np.array(sorted(rest), np.int64).tobytes()))
        return out


class Swaps:
    """Pairs of sentences, as they stand and with a name swapped, in columns of the design; each with its weight.

    Per name: a bare mention beside nothing, of weight 1, and all swaps in its sentences, the bare mention among them, of
    weight 1 together.
    """

    def __init__(self, uses: list[tuple[int, int, bytes]], terms: Terms, columns: np.ndarray):
        names = [[name_features(w) for w in kind] for kind in names_of(terms)]
        held: dict[tuple[int, int], list[set[int]]] = {}
        for k, i, rest in uses:
            held.setdefault((k, i), []).append(set(np.frombuffer(rest, np.int64).tolist()))
        sides: tuple[list[set[int]], list[set[int]]] = ([], [])
        weight = []
        for k, kind in enumerate(names):
            for i, own in enumerate(kind):
                rests = [set(), *held.get((k, i), [])]
                pairs = [(own, set(), 1.0)]
                others = [o for j, o in enumerate(kind) if j != i]
                pairs += [(rest | own, rest | o, 1.0 / (len(rests) * len(others))) for rest in rests for o in others]
                for one, other, share in pairs:
                    sides[0].append(one)
                    sides[1].append(other)
                    weight.append(share)
        self.weight = np.array(weight)
        self.sides = [self._entries(side, columns) for side in sides]

    @staticmethod
    def _entries(side: list[set[int]], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(side)), [len(s) for s in side])
        flat = np.array([x for s in side for x in sorted(s)], np.int64)
        at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
        known = columns[at] == flat
        return row[known], at[known]

    def cost(self, w: np.ndarray, b: float) -> tuple[float, np.ndarray, float]:
        """Sum of weight * (change of score / CHANGE)^2, and its gradient by weights and bias."""
        n = len(self.weight)
        scores = [_sigmoid(np.bincount(row, w[col], n) + b) for row, col in self.sides]
        change = (scores[0] - scores[1]) / CHANGE
        gradient, by_bias = np.zeros(len(w)), 0.0
        for (row, col), s, sign in zip(self.sides, scores, (1.0, -1.0), strict=True):
            g = 2 * sign * self.weight * change * s * (1 - s) / CHANGE
            gradient += np.bincount(col, g[row], len(w))
            by_bias += float(g.sum())
        return float((self.weight * change**2).sum()), gradient, by_bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class Loss:
    """Weighted mean logistic loss + counterfactual * cost of the swaps, with its gradient."""

    row: np.ndarray
    col: np.ndarray
    labels: np.ndarray
    share: np.ndarray
    swaps: Swaps
    counterfactual: float

    def at(self, w: np.ndarray, b: float) -> tuple[float, np.ndarray, float]:
        z = np.bincount(self.row, w[self.col], len(self.labels)) + b
        error = (_sigmoid(z) - self.labels) * self.share
        cost, gradient, by_bias = self.swaps.cost(w, b) if self.counterfactual else (0.0, np.zeros(len(w)), 0.0)
        value = float((self.share * (np.logaddexp(0, z) - self.labels * z)).sum()) + self.counterfactual * cost
        gradient = np.bincount(self.col, error[self.row], len(w)) + self.counterfactual * gradient
        return value, gradient, float(error.sum()) + self.counterfactual * by_bias


def fit(
    rows: list[np.ndarray], labels: np.ndarray, uses: list[tuple[int, int, bytes]] = (), terms: Terms = IDENTITY_TERMS,
    l1: float = 5e-5, counterfactual: float = 1.0, steps: int = 1000,
) -> Model:
    """Fit on distinct word hashes per row and the uses of names in labelled sentences (see `Finder.uses`).

    Loss + l1 * sum of absolute weights, by proximal gradient with momentum; a step that raises the loss above what its
    slope allows is halved, and momentum ends where it points upwards. Toxic rows are rarer and count more, by the root of
    the classes' ratio. Without rows the score is 0.5; with one class it is that class's smoothed share.
    """
    n, positive = len(labels), float(np.sum(labels))
    prior = (positive + 0.5) / (n + 1)
    bias = float(np.log(prior / (1 - prior)))
    if not 0 < positive < n:
        return Model(bias, {})
    flat, row = np.concatenate(rows), np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    ids, seen = np.unique(flat, return_counts=True)
    ids = ids[seen >= MIN_ROWS]
    col = np.searchsorted(ids, flat)
    known = ids[np.minimum(col, len(ids) - 1)] == flat if len(ids) else np.zeros(len(flat), bool)
    flat, row, col = flat[known], row[known], col[known]
    named = np.array(sorted({x for kind in names_of(terms) for words in kind for x in name_features(words)}), np.int64)
    columns = np.union1d(ids[_telling(col, row, labels, len(ids))], named)
    at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
    known = columns[at] == flat
    share = np.where(labels > 0, np.sqrt((n - positive) / positive), 1.0)
    loss = Loss(row[known], at[known], labels, share / share.sum(), Swaps(sorted(uses), terms, columns), counterfactual)

    w, b = np.zeros(len(columns)), bias
    v, c, t, rate = w.copy(), b, 1.0, 1.0
    for _ in range(steps):
        value, gradient, by_bias = loss.at(v, c)
        while True:
            step = v - rate * gradient
            w_next = np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0)
            b_next = c - rate * by_bias
            moved, shifted = w_next - v, b_next - c
            allowed = value + gradient @ moved + by_bias * shifted + (moved @ moved + shifted * shifted) / (2 * rate)
            if loss.at(w_next, b_next)[0] <= allowed + 1e-12 or rate < 1e-9:
                break
            rate /= 2
        if moved @ (w_next - w) + shifted * (b_next - b) < 0 and (v - w_next) @ (w_next - w) > 0:
            t = 1.0
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
        rate *= 1.02  # steps may grow again
    used = np.flatnonzero(w)
    return Model(float(b), dict(zip(columns[used].tolist(), w[used].tolist(), strict=True)))


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS,
    terms: Terms = IDENTITY_TERMS,
) -> Model:
    """A model from labelled rows outside the held-out ones; `terms` lists the names of groups, kind by kind.

    At most `fit_rows` labels are used, those of the smallest key hashes; all of them if there are fewer. Their texts'
    word hashes, and those of the sentences that hold a name, come to the driver; texts do not. Of rows of equal key the
    smallest text is used. Null labels and keys, and labels without a document, are left out; a null text has no words.
    """
    chosen = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key IS NOT NULL AND label IS NOT NULL")
    chosen = chosen.where(~held_out(F.col("key"))).orderBy(F.xxhash64("key"), "key", "label").limit(fit_rows)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    labelled = texts.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
    of = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("name", T.IntegerType()), T.StructField("rest", T.BinaryType())])
    fields = T.StructType([T.StructField("features", T.BinaryType()), T.StructField("uses", T.ArrayType(of))])

    def start():
        finder = Finder(terms)

        def compute(texts: pa.Array) -> list:
            found = [t or b"" for t in texts.to_pylist()]
            rows = [{x for w in set(folded_words(t)) for x in word_features(w)} for t in found]
            uses = [[{"kind": k, "name": i, "rest": rest} for k, i, rest in sorted(finder.uses(t))] for t in found]
            return [[np.array(sorted(r), np.int64).tobytes() for r in rows], uses]

        return compute

    rows = append_columns(labelled, "text", fields, start, ["key", "label"]).orderBy("key", "label", "features").collect()
    uses = [(u["kind"], u["name"], bytes(u["rest"])) for r in rows for u in r["uses"]]
    return fit([np.frombuffer(r["features"], np.int64) for r in rows], np.array([float(r["label"]) for r in rows]), uses, terms)


FIELDS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from the threshold up) of every whole text.

    A text is the set of its words; a null or empty one has the score of a text without known words. Every row is
    returned once. Columns of `docs` named as new ones are replaced. The broadcast model is bounded by `fit_rows`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        known: dict[bytes, tuple[int, ...]] = {}

        def compute(texts: pa.Array) -> list:
            logits = []
            for t in texts.to_pylist():
                found: set[int] = set()
                for w in set(folded_words(t or b"")):
                    features = known.get(w)
                    if features is None:
                        if len(known) >= MEMO_WORDS:
                            known.clear()
                        features = known[w] = tuple(x for x in word_features(w) if x in m.weights)
                    if features:
                        found.update(features)
                logits.append(sum(m.weights[x] for x in sorted(found)))
            scores = m.scores(np.array(logits))
            return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]

        return compute

    return append_columns(docs, text, FIELDS, start, keep)


def clean_documents(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of `docs`, columns as they are, that the model does not reject."""
    return kept_rows(docs, text, lambda rows: score_toxicity(rows, model, threshold=threshold), F.col("predicted") == 0)
