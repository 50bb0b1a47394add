"""Token output: length-delimited binary records with masked checksums, an offset index, ordered and shuffled reads.

A record is: payload length (8 bytes), its masked checksum (4), payload, the payload's masked checksum (4); all
little-endian. A payload is: bytes per id (1), key present (1), key (8), number of ids (8), ids. The checksum is CRC-32
(zlib's polynomial), rotated by 15 bits plus a constant, so that a checksum of data that holds checksums stays useful.
An index file beside each file of records holds, per record, its offset and the ids before it in the file (8 bytes each).
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from padronix.llm.batches import KEPT, bounded_batches

MASK = 0xA282EAD8  # Fixed value: added to a rotated checksum.
TOKENIZER_BYTES = 64_000_000  # most bytes of a tokenizer file that is broadcast
OPEN_FILES = 64  # files that a shuffled read keeps open
MEMO_PIECES = 1_200_000  # pieces of text whose ids a worker remembers, in about 250 MB; then it forgets all and goes on

_FRAME = struct.Struct("<QI")
_SUM = struct.Struct("<I")
_HEAD = struct.Struct("<BBqQ")

_WS = " \\t\\n\\r\\x0b\\x0c"
_PIECES = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_RARE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SEPARATORS = tuple("\x1c\x1d\x1e\x1f")
_ENDS = ("", " ", "\n")
_RUNS = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c")
_CLOSING = ".,;:!?)]}\"'*$%&#|-"  # a run of these after letters is one token to merge, as is the run of letters


def _printable_bytes() -> dict[int, str]:
    """The byte-level alphabet: a printable byte stands for itself, the n-th other one for the character 256 + n."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}


def _little(ids: list[int], code: str) -> bytes:
    packed = array(code, ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Memo:
    """Ids by piece, `before` standing in front of each; forgets all when full."""

    def __init__(self, before: str):
        self.before = before
        self.now: dict[str, bytes] = {}

    def keep(self, piece: str, ids: bytes) -> None:
        if len(self.now) >= MEMO_PIECES:
            self.now = {}
        self.now[piece] = ids


class PieceEncoder:
    """Ids of whole texts, by a byte-level tokenizer without a normalizer: pieces between white space, remembered.

    That gives the ids of the whole text, since such a tokenizer never merges a word with white space after it. Texts
    with white space other than ASCII's or with the spelling of an added token, and all texts for other tokenizers, are
    encoded whole.
    """

    def __init__(self, tokenizer: Tokenizer, settings: dict, width: int):
        self._whole, self._code = tokenizer.encode, "H" if width == 2 else "I"
        cut = settings.get("pre_tokenizer") or {}
        added = settings.get("added_tokens") or []
        self._added = [] if tokenizer.encode_special_tokens else [t["content"] for t in added]
        self._by_piece = (
            all(t["special"] for t in added) and settings.get("normalizer") is None and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        )
        if self._by_piece:
            self._cut, self._merge = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
            self._letters = _printable_bytes()
            self._alone, self._after_space, self._closing = _Memo(""), _Memo(" "), _Memo("")
            vocabulary = tokenizer.get_vocab()
            self._opens = np.zeros(max(vocabulary.values()) + 1, bool)
            self._opens[[i for token, i in vocabulary.items() if token.startswith(self._letters[32])]] = True
            self._joinable = not any(map(self._ends_a_word, vocabulary))

    def _ends_a_word(self, token: str) -> bool:
        """Whether a token holds a letter with a space right after it."""
        space = self._letters[32]
        if space not in token.lstrip(space):
            return False
        byte_of = {c: b for b, c in self._letters.items()}
        if not set(token) <= set(byte_of):
            return False  # an added token
        text = bytes(byte_of[c] for c in token).decode("utf-8", "replace")
        return any(a.isalpha() and b == " " for a, b in pairwise(text)) or "\ufffd" in text

    def _mapped(self, text: str) -> str:
        """Letters, a space in front or none, in the byte-level alphabet."""
        if text.isascii():
            return text.replace(" ", self._letters[32])
        return text.encode().decode("latin-1").translate(self._letters)

    def _any(self, text: str) -> bytes:
        return _little([t.id for part, _ in self._cut(text) for t in self._merge(part)], self._code)

    def _merge_words(self, words: list[str], before: str, out: dict[str, bytes]) -> None:
        """Ids of runs of letters. With a space in front they are merged in one call: no token ends a word in a space,
        so merges stay inside the words, and the words' first tokens alone begin with a space."""
        mapped = [self._mapped(before + w) for w in words]
        if before and self._joinable and len(words) > 1:
            ids = [t.id for t in self._merge("".join(mapped))]
            cuts = np.flatnonzero(self._opens[ids]).tolist()
            if len(cuts) == len(words):
                packed, size = _little(ids, self._code), 2 if self._code == "H" else 4
                for w, (a, b) in zip(words, pairwise([*cuts, len(ids)]), strict=True):
                    out[w] = packed[a * size : b * size]
                return
        for w, m in zip(words, mapped, strict=True):
            out[w] = _little([t.id for t in self._merge(m)], self._code)

    def _tail(self, tail: str) -> bytes:
        ids = self._closing.now.get(tail)
        if ids is None:
            ids = self._any(tail)
            self._closing.keep(tail, ids)
        return ids

    def _joined(self, pieces: list[str], memo: _Memo) -> bytes:
        found = list(map(memo.now.get, pieces))
        try:
            return b"".join(found)
        except TypeError:  # some are not known
            pass
        worded: list[tuple[int, str, str]] = []
        new: dict[str, bytes] = {}  # by letters; kept apart, as the memo may forget them meanwhile
        for i, ids in enumerate(found):
            if ids is not None:
                continue
            piece = pieces[i]
            core = piece.rstrip(_CLOSING)
            if core.isalpha():
                worded.append((i, piece, core))
                if core not in new:
                    new[core] = memo.now.get(core)
            else:
                found[i] = self._any(memo.before + piece)
                memo.keep(piece, found[i])
        self._merge_words([w for w, ids in new.items() if ids is None], memo.before, new)
        for i, piece, core in worded:
            ids = new[core]
            if len(core) < len(piece):
                ids += self._tail(piece[len(core) :])
            memo.keep(piece, ids)
            found[i] = ids
        return b"".join(found)

    def __call__(self, text: str) -> bytes:
        rare = any(c in text for c in _SEPARATORS) if text.isascii() else _RARE.search(text)
        if rare or not self._by_piece or any(a in text for a in self._added):
            return _little(self._whole(text, add_special_tokens=False).ids, self._code)
        if text[:1] in _ENDS or text[-1:] in _ENDS or any(r in text for r in _RUNS):
            return self._joined(_PIECES.findall(text), self._alone)
        return self._tail("\n").join(map(self._line, text.split("\n")))

    def _line(self, text: str) -> bytes:
        first, _, rest = text.partition(" ")
        return self._joined([first], self._alone) + (self._joined(rest.split(" "), self._after_space) if rest else b"")


def _encoder(settings: str, width: int, plain: bool) -> PieceEncoder:
    """The encoder of a tokenizer file, kept from task to task by the worker that runs them, with what it remembers."""
    key = (zlib.crc32(settings.encode()), width, plain)
    if key not in KEPT:
        KEPT.clear()
        tokenizer = Tokenizer.from_str(settings)
        tokenizer.encode_special_tokens = plain
        KEPT[key] = PieceEncoder(tokenizer, json.loads(settings), width)
    return KEPT[key]


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, _SUM.pack(masked(length)), payload, _SUM.pack(masked(payload))))


def unframe(stream) -> bytes | None:
    """The next payload of a stream, None at its end. Raises where a checksum or a length does not fit."""
    head = stream.read(_FRAME.size)
    if not head:
        return None
    if len(head) < _FRAME.size or masked(head[:8]) != _FRAME.unpack(head)[1]:
        raise ValueError("damaged record length")
    n = _FRAME.unpack(head)[0]
    body = stream.read(n + _SUM.size)
    if len(body) != n + _SUM.size or masked(body[:n]) != _SUM.unpack(body[n:])[0]:
        raise ValueError("damaged record")
    return body[:n]


def pack(key: int | None, ids: bytes, width: int) -> bytes:
    return _HEAD.pack(width, key is not None, key or 0, len(ids) // width) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, has_key, key, n = _HEAD.unpack_from(payload)
    return (key if has_key else None), np.frombuffer(payload, f"<u{width}", n, _HEAD.size)


MANIFEST = "part int, file string, n_records bigint, n_ids bigint, start bigint"


def write_records(
    docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, key: str = "doc_id", text: str = "text", plain_specials: bool = False,
) -> DataFrame:
    """Encode every whole text, append `end_id`, and write records in ascending order of the integer key.

    Returns the manifest, one row per file in order, also written to `folder`/manifest: only files that it names count,
    so what failed or repeated tasks left behind is never read. Rows are dealt out by ranges of (key, text hash, place in
    the table), so neither long texts nor repeated keys or rows meet in one task. The spelling of a special token in a text
    gives that token, as the tokenizer does by default; with `plain_specials` it is ordinary text. Null keys come first; equal keys are ordered by text hash;
    a null text is empty and gives the end id alone; an empty table gives no file. Other columns are not written.
    `folder` must be one that all machines reach. The driver holds one row per file.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    if Path(tokenizer_file).stat().st_size > TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer_file} is too large to broadcast")
    settings = Path(tokenizer_file).read_text()
    width = 2 if max(Tokenizer.from_str(settings).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast(settings)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(F.col("key").asc_nulls_first(), "tie", "place")
    ordered = ordered.sortWithinPartitions(F.col("key").asc_nulls_first(), "tie").select("key", "text", "tie")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(shared.value, width, plain_specials), end_id.to_bytes(width, "little")
        system, path = FileSystem.from_uri(folder)
        name, out, index, before, at = f"{uuid.uuid4().hex}.records", None, [], 0, 0
        for batch in batches:
            if out is None and batch.num_rows:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}")
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(t) + end
                record = frame(pack(k, ids, width))
                out.write(record)
                index += (at, before)
                at, before = at + len(record), before + len(ids) // width
        if out is not None:
            out.close()
            with system.open_output_stream(f"{path}/{name}.index") as side:
                side.write(np.array(index, "<u8").tobytes())
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [name], "n_records": [len(index) // 2], "n_ids": [before]}
            )

    done = ordered.mapInArrow(write, "part int, file string, n_records bigint, n_ids bigint").collect()
    files, start = [], 0
    for r in sorted(done, key=lambda r: r["part"]):
        files.append((r["part"], r["file"], r["n_records"], r["n_ids"], start))
        start += r["n_ids"]
    manifest = spark.createDataFrame(files, MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


RECORD = "key bigint, start bigint, n_tokens bigint, ids binary"


def _record_batch(rows: list[tuple[int | None, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([len(r[2]) for r in rows], pa.int64()),
            pa.array([r[2].astype("<u4").tobytes() for r in rows], pa.binary()),
        ],
        names=["key", "start", "n_tokens", "ids"],
    )


def _spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One task per file, of a table with a row per file."""
    return manifest.repartition(max(1, manifest.count()))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: key, start (ids in all records before it), n_tokens, ids (unsigned 32-bit, little-endian).

    Checksums are verified. A task reads one file from front to back.
    """
    files = _spread(spark, spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = FileSystem.from_uri(folder)
        for batch in batches:
            for f in batch.to_pylist():
                rows, start, held, seen = [], f["start"], 0, 0
                with system.open_input_stream(f"{path}/{f['file']}", buffer_size=1 << 20) as stream:
                    while (payload := unframe(stream)) is not None:
                        key, ids = unpack(payload)
                        rows.append((key, start, ids))
                        start, held, seen = start + len(ids), held + len(ids), seen + 1
                        if held > 1_000_000:
                            yield _record_batch(rows)
                            rows, held = [], 0
                if seen != f["n_records"]:
                    raise ValueError(f"{f['file']} has {seen} records, not {f['n_records']}")
                if rows:
                    yield _record_batch(rows)

    return files.mapInArrow(read, RECORD)


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """Every record once, in an order that `seed` decides: index entries are shuffled, then records are read by offset."""
    files = _spread(spark, spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"))

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = FileSystem.from_uri(folder)
        for batch in batches:
            for f in batch.to_pylist():
                with system.open_input_stream(f"{path}/{f['file']}.index") as stream:
                    index = np.frombuffer(stream.read(), "<u8").reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f["file"]] * len(index)), pa.array(index[:, 0]), pa.array(index[:, 1] + f["start"])],
                    names=["file", "offset", "start"],
                )

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = FileSystem.from_uri(folder)
        streams = OrderedDict()  # the file used last comes last
        for batch in batches:
            wanted = batch.to_pylist()
            rows: list = [None] * len(wanted)
            # A batch is read in the order of its files, and given back in its own.
            for i in sorted(range(len(wanted)), key=lambda i: (wanted[i]["file"], wanted[i]["offset"])):
                e = wanted[i]
                if e["file"] not in streams:
                    if len(streams) >= OPEN_FILES:
                        streams.popitem(last=False)[1].close()
                    streams[e["file"]] = system.open_input_file(f"{path}/{e['file']}")
                streams.move_to_end(e["file"])
                streams[e["file"]].seek(e["offset"])
                key, ids = unpack(unframe(streams[e["file"]]))
                rows[i] = (key, e["start"], ids)
            if rows:
                yield _record_batch(rows)

    index = files.mapInArrow(entries, "file string, offset bigint, start bigint")
    mixed = index.withColumn("place", F.xxhash64(F.lit(seed), "start")).repartitionByRange("place").sortWithinPartitions("place")
    return mixed.select("file", "offset", "start").mapInArrow(fetch, RECORD)
