"""SimHash near-duplicates with keys from the binary Golay code.

A fingerprint of 64 bits is cut into three segments, each a word of the perfect [23, 12, 7] code (short ones have leading
zeros). Every word lies within 3 bits of one codeword; decoding the word and all its neighbours at one bit gives the
codewords within 4 bits of it: one if the word is within 2 bits of its codeword, else six. Two words that differ in at
most 2 bits have a neighbour in common, so they share a codeword.

Two fingerprints at 4 or fewer bits share a key, by what their errors can be over three segments:
- some segment is equal: of the other two, one has at most 2 errors. Key: the equal segment, and the index of a codeword
  near the other.
- no segment is equal: the errors are 1, 1, 1 or 1, 1, 2. Two segments have one error, so one half of each is equal, and
  the third has at most 2. Key: a half of each of the two, and the index of a codeword near the third.
Keys have 33 to 34 bits besides their kind, so unrelated fingerprints share one in about 1 of 10^7 cases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padronix.llm.batches import append_columns, bounded_batches, key_runs, materialize, shared_folder
from padronix.llm.graph import components
from padronix.operators.sizing import join_table

SHINGLE = 4
SEED = 42
DISTANCE = 4  # what the keys are complete for
SHINGLES_AT_ONCE = 65_536
PRINTS_PER_TASK = 5_000  # fingerprints whose keys, up to 108 each, one task makes and counts without spilling
GROUP_ROWS = 32_768  # fingerprints of one side of a comparison inside a key
HOT_ROWS = 1_000_000  # rows of a key from which its rows are not dealt by it
SMALL_KEYS = 500_000  # keys that are broadcast, at 16 bytes each

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64 bits of a UTF-8 text, as a signed integer; 0 without words. A bit is set if it is in over half of the hashes."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(len(words) - size + 1, 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[-n:].tolist()
    set_bits = np.zeros(64, np.int64)
    for low in range(0, n, SHINGLES_AT_ONCE):
        parts = map(joined.__getitem__, map(slice, starts[low : low + SHINGLES_AT_ONCE], stops[low : low + SHINGLES_AT_ONCE]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * set_bits > n, bitorder="little")
    return int(packed.view("<i8")[0])


FINGERPRINT = T.StructType([T.StructField("fingerprint", T.LongType())])


def add_fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """`docs` with the fingerprint of every whole text, as a signed 64-bit integer; a null text has fingerprint 0."""

    def start():
        return lambda texts: [[fingerprint(t or b"", size) for t in texts.to_pylist()]]

    return append_columns(docs, text, FINGERPRINT, start, keep)


# ---------------------------------------------------------------- the code

# Fixed value: a generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
_N, _CHECK = 23, 11


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders of words of 23 bits by the generator: 0 for codewords, and equal for words that differ by one."""
    r = words.astype(np.int64)
    for bit in range(_N - 1, _CHECK - 1, -1):
        r = np.where((r >> bit) & 1, r ^ (GENERATOR << (bit - _CHECK)), r)
    return r


def _near_errors() -> np.ndarray:
    """For each remainder the error patterns of weight up to 4 that a neighbour's decoding finds: one, or six; else -1."""
    out = np.full((1 << _CHECK, 6), -1, np.int64)
    used = np.zeros(1 << _CHECK, np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << i for i in c) for c in combinations(range(_N), weight)], np.int64)
        of = _remainders(patterns)
        for r, p in zip(of.tolist(), patterns.tolist(), strict=True):
            # Patterns of weight 4 count only beside a codeword at distance 3: then a neighbour decodes to theirs.
            if used[r] < 6:
                out[r, used[r]] = p
                used[r] += 1
    return out


class Code:
    """Tables of the code: remainders of the two halves of a word, and nearby errors by remainder."""

    def __init__(self):
        self.high = _remainders(np.arange(1 << 12, dtype=np.int64) << _CHECK)
        self.errors = _near_errors()

    def near(self, words: np.ndarray) -> np.ndarray:
        """Indices (12 bits) of the codewords within 4 bits of each word, -1 where there are fewer than six."""
        remainder = self.high[words >> _CHECK] ^ (words & ((1 << _CHECK) - 1))
        errors = self.errors[remainder]
        return np.where(errors >= 0, (words[:, None] ^ errors) >> _CHECK, -1)


_code: list[Code] = []


def code() -> Code:
    if not _code:
        _code.append(Code())
    return _code[0]


# ---------------------------------------------------------------- keys

WIDTHS = (22, 21, 21)
SHIFTS = (42, 21, 0)
KINDS = 18


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): every key of each fingerprint, and which fingerprint has it."""
    x = prints.view(np.uint64)
    parts = [((x >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(SHIFTS, WIDTHS, strict=True)]
    near = [code().near(p) for p in parts]
    halves = [(p >> 11, p & 0x7FF) for p in parts]
    heads = []
    for equal in range(3):
        heads += [(parts[equal], other) for other in range(3) if other != equal]
    for third in range(3):
        a, b = (i for i in range(3) if i != third)
        heads += [((halves[a][i] << 11) | halves[b][j], third) for i in range(2) for j in range(2)]
    keys, places = [], []
    for kind, (head, segment) in enumerate(heads):
        index = near[segment]
        at, column = np.nonzero(index >= 0)
        keys.append((((head[at] << 12) | index[at, column]) << 5) | kind)
        places.append(at)
    return np.concatenate(keys), np.concatenate(places)


def _key_rows(prints: DataFrame, carry: list[str]) -> DataFrame:
    """(key, fingerprint, carried columns): 18 to 108 rows per fingerprint."""
    schema = T.StructType([T.StructField("key", T.LongType()), *(prints.schema[c] for c in ("fingerprint", *carry))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at = keys_of(batch.column(0).to_numpy(zero_copy_only=False))
            taken = [c.take(pa.array(at)) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(keys), *taken], names=schema.names)

    return prints.select("fingerprint", *carry).mapInArrow(run, schema)


# ---------------------------------------------------------------- links


def _close(a: str, b: str, distance: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _of_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the wanted keys (key, n, ...). Few keys are broadcast; of more, those that hold very many rows, which are
    fewer than rows / HOT_ROWS, are broadcast and the others joined by an exchange."""
    if keys.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS:
        return rows.join(F.broadcast(keys), "key")
    hot = keys.where(F.col("n") > HOT_ROWS)
    rest = rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(keys.where(F.col("n") <= HOT_ROWS), "key")
    return rest.unionByName(rows.join(F.broadcast(hot), "key"))


def _label_links(left: np.ndarray, right: np.ndarray, l_label: np.ndarray, r_label: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links between fingerprints of different labels that connect all labels which any link connects."""
    up: dict[int, int] = {}

    def find(i: int) -> int:
        while (p := up.get(i, i)) != i:
            up[i] = up.get(p, p)
            i = p
        return i

    out = []
    low, high = right.view(np.uint64), left.view(np.uint64)
    for i in range(len(high)):
        for j in np.flatnonzero((np.bitwise_count(low ^ high[i]) <= distance) & (r_label != l_label[i])).tolist():
            a, b = find(int(l_label[i])), find(int(r_label[j]))
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((int(left[i]), int(right[j])))
    return out


LINKS = "a bigint, b bigint"


def _rest_links(rows: DataFrame, distance: int) -> DataFrame:
    """Links between members of different labels inside each key, for rows (key, fingerprint, label, chunk, low, high)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), members in key_runs(batches, 3):
            sides = []
            for chunk in (low, high):
                side = [m for m in members if m["chunk"] == chunk]
                sides.append((np.array([m["fingerprint"] for m in side], np.int64), np.array([m["label"] for m in side], np.int64)))
            (a, a_label), (b, b_label) = sides
            if len(a) and len(b):
                if low == high:  # all members but those of the commonest label meet all others
                    names, counts = np.unique(a_label, return_counts=True)
                    rest = a_label != names[counts.argmax()]
                    a, a_label = a[rest], a_label[rest]
                found = _label_links(a, b, a_label, b_label, distance)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    keyed = rows.select("key", "low", "high", "chunk", "fingerprint", "label")
    return keyed.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(run, LINKS)


def _dealt(prints: DataFrame) -> DataFrame:
    """Fingerprints in as many tasks as their keys need."""
    return prints.repartition(max(1, -(-prints.count() // PRINTS_PER_TASK)), "fingerprint")


def fingerprint_components(prints: DataFrame, folder: str, distance: int = DISTANCE) -> DataFrame:
    """(fingerprint, label) of distinct fingerprints: label is the smallest one (signed) reachable by links.

    Each key's count, smallest and largest member come from one grouped aggregate: almost all keys have one member and
    are gone, and a key of two is its pair. Members of larger keys are linked with the smallest one where they are close
    to it. Inside a group of near copies that leaves few labels; only keys with several labels are looked at again, and
    there only members of different labels are compared, in blocks of GROUP_ROWS rows a side.
    """
    if distance > DISTANCE:
        raise ValueError(f"the keys find all pairs up to {DISTANCE} bits")
    bounded_batches(prints.sparkSession)
    prints = _dealt(prints)
    keyed = _key_rows(prints, [])
    members = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"))
    met = materialize(members.where("n > 1"), folder, "keys")
    pairs = met.where(_close("a", "b", distance)).select("a", "b")
    large = met.where("n > 2").select("key", "n", "a")
    starred = _of_keys(keyed, large).where("a <> fingerprint").where(_close("a", "fingerprint", distance))
    links = materialize(pairs.unionByName(starred.select("a", F.col("fingerprint").alias("b"))).distinct(), folder, "links")
    first = components(links, folder, "first").select(F.col("node").alias("fingerprint"), "label")

    labelled = prints.join(first, "fingerprint", "left").select("fingerprint", F.coalesce("label", "fingerprint").alias("label"))
    labelled = materialize(labelled, folder, "labelled")
    again = materialize(_of_keys(_key_rows(_dealt(labelled), ["label"]), large.select("key", "n")), folder, "again")
    split = again.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n")).where("x <> y")
    split = materialize(split.select("key", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("n")), folder, "split")
    placed = _of_keys(again.drop("n"), split).withColumn("chunk", F.pmod(F.xxhash64("fingerprint"), F.col("n")).cast("int"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    placed = placed.select("key", "fingerprint", "label", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    rest = materialize(_rest_links(placed, distance), folder, "rest")
    both = links.unionByName(rest)
    return components(both, folder, "all").select(F.col("node").alias("fingerprint"), "label")


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of `docs`: the integer key, fingerprint (signed 64-bit) and component_id.

    Fingerprints link at `distance` or fewer differing bits; component_id is the smallest key reachable by links, itself
    included. Rows without words, or with a null text, have fingerprint 0 and are linked like any other. Null keys stay
    null and take part under the smallest key of their component, if any. Repeated rows are separate rows. Other
    columns are not read. All work after the texts is on distinct fingerprints, so copies cost nothing more.
    """
    folder = shared_folder(docs.sparkSession)
    read = add_fingerprints(docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text")), keep=["key"])
    rows = materialize(read, folder, "fingerprints")
    prints = materialize(rows.groupBy("fingerprint").agg(F.min("key").alias("first")), folder, "prints")
    labels = fingerprint_components(prints.select("fingerprint"), folder, distance)
    classed = prints.join(labels, "fingerprint", "left").select("fingerprint", "first", F.coalesce("label", "fingerprint").alias("label"))
    ids = classed.groupBy("label").agg(F.min("first").alias("component_id"))
    of_print = materialize(classed.join(ids, "label").select("fingerprint", "component_id"), folder, "classes")
    return join_table(rows, of_print, ["fingerprint"]).select(F.col("key").alias(key), "fingerprint", "component_id")


def hex_digits():
    """Column: the fingerprint as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
