"""Each text operator against SQL or a brute-force version, and over odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from padronix.llm import decontamination, graph, jaccard, language, licenses, lines, mixing, pii, quality, records, toxicity
from padronix.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import odd

SMALL = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd_table(spark):
    return odd.table(spark, odd.odd_rows()).repartition(3).cache()


@pytest.fixture(scope="module")
def empty_table(spark):
    return odd.table(spark, [])


def small(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def same_as_sql(table, sql, rows, **tables):
    want, columns = odd.sql_rows(sql, rows, **tables)
    got = sorted((tuple(r) for r in table.select(*columns).collect()), key=repr)
    assert got == want


# ------------------------------------------------------------------ token records


def whole_ids(text: str | None) -> list[int]:
    if not hasattr(whole_ids, "t"):
        whole_ids.t = Tokenizer.from_file(TOKENIZER)
    return [*whole_ids.t.encode(text or "", add_special_tokens=False).ids, 2]


def test_records_round_trip(spark, odd_table, tmp_path):
    folder = f"file://{tmp_path}/out"
    records.write_records(odd_table, folder, TOKENIZER, end_id=2)
    back = sorted(records.read_records(spark, folder).collect(), key=lambda r: r["start"])
    source = [(r["doc_id"], whole_ids(r["text"])) for r in odd_table.collect()]
    keys = [r["key"] for r in back]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(back) == len(source)
    assert Counter((r["key"], bytes(r["ids"])) for r in back) == Counter((k, np.array(i, "<u4").tobytes()) for k, i in source)
    starts = np.cumsum([0] + [r["n_tokens"] for r in back])
    assert [r["start"] for r in back] == starts[:-1].tolist()
    mixed = [records.read_shuffled(spark, folder, seed).collect() for seed in (1, 1, 2)]
    assert mixed[0] == mixed[1] != mixed[2] and sorted(mixed[2], key=lambda r: r["start"]) == back


def test_records_empty_table_and_damage(spark, empty_table, odd_table, tmp_path):
    records.write_records(empty_table, f"file://{tmp_path}/none", TOKENIZER, end_id=2)
    assert records.read_records(spark, f"file://{tmp_path}/none").count() == 0
    records.write_records(odd_table.limit(3), f"file://{tmp_path}/bad", TOKENIZER, end_id=2)
    for path in (tmp_path / "bad").glob("*.records"):
        data = bytearray(path.read_bytes())
        data[-6] ^= 1
        path.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        records.read_records(spark, f"file://{tmp_path}/bad").collect()


def test_piece_encoder_equals_whole_texts():
    import json

    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    encode = records.PieceEncoder(tokenizer, json.loads(open(TOKENIZER).read()), 2)
    rng = random.Random(3)
    parts = ["a", "bé", "'s", "'", "t", ".", " ", "  ", "\n", "\t", "12", "-", "ß", "½", "\xa0", " ", "\x1c", "_", "!", "<|endoftext|>", "don't", "😀", "\r\n"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes(), repr(text)


# ------------------------------------------------------------------ line dedup


def brute_removed(texts: dict[int, str | None]) -> dict[int, set[int]]:
    """Lines of runs of at least LEAST_WORDS words that stand in full at an earlier place, by comparing all places."""
    seqs = {d: [x.strip() for x in (t or "").split("\n") if x.strip()] for d, t in texts.items()}
    out = {d: set() for d in seqs}
    order = sorted(seqs)
    for n, d in enumerate(order):
        for e in order[: n + 1]:
            a, b = seqs[d], seqs[e]
            for i in range(len(a)):
                for j in range(i if d == e else len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                        k += 1
                    if sum(len(x.split()) for x in a[i : i + k]) >= lines.LEAST_WORDS:
                        out[d].update(range(i, i + k))
    return out


def test_line_dedup_removes_later_runs(spark):
    """What goes is repeated by brute force; passages of the guaranteed length go everywhere but at their first place."""
    rng = random.Random(5)
    passages = [[odd.sentence(rng, rng.randint(3, 30)) for _ in range(rng.randint(2, 6))] for _ in range(6)]
    texts, seen, certain = {}, set(), {}
    for d in range(40):
        body = [(odd.sentence(rng, rng.randint(1, 12)), None) for _ in range(rng.randint(0, 5))]
        for p in rng.sample(range(6), rng.randint(0, 2)):
            cuts = [i for i in range(len(body) + 1) if i in (0, len(body)) or body[i][1] is None or body[i - 1][1] != body[i][1]]
            at = rng.choice(cuts)
            body[at:at] = [(x, p) for x in passages[p]]
        texts[d] = "\n".join(x for x, _ in body)
        long = {p for p in range(6) if sum(len(x.split()) for x in passages[p]) >= lines.LEAST_WORDS}
        certain[d] = {i for i, (_, p) in enumerate(body) if p in long & seen}
        seen |= {p for _, p in body if p is not None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    brute = brute_removed(texts)
    assert all(certain[d] <= set(r["removed"]) == brute[d] for d, r in got.items()) and any(certain.values())
    kept = Counter(x for r in got.values() for x in r["cleaned"].split("\n"))
    assert set(kept) >= {x for t in texts.values() for x in t.split("\n")}  # a line never vanishes altogether
    for d, r in got.items():
        wordy = [x for x in texts[d].split("\n") if x.strip()]
        assert [x for x in r["cleaned"].split("\n") if x.strip()] == [x for i, x in enumerate(wordy) if i not in r["removed"]]


def removed_lines(spark, texts: dict[int, str]) -> dict[int, set[int]]:
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    return {r["doc_id"]: set(r["removed"]) for r in lines.dedup_lines(docs).collect()}


def test_line_dedup_of_partial_holders_equals_brute_force(spark):
    """Earlier texts hold parts of a passage, later ones the whole of it, or an edited copy of it."""
    rng = random.Random(8)
    fresh = lambda n, words: [odd.sentence(rng, words) + f" {rng.random()}" for _ in range(n)]
    texts, d = {}, 0
    for words in (3, 4, 9):
        for _ in range(12):
            passage = fresh(10, words)
            low = rng.randint(0, 5)
            edited = [*passage[:5], *fresh(1, words), *passage[6:]]
            for held in (passage[low : low + 5], passage, passage, edited, edited):
                texts[d] = "\n".join([*fresh(rng.randint(0, 2), 5), *held, *fresh(rng.randint(0, 2), 5)])
                d += 1
    assert removed_lines(spark, texts) == brute_removed(texts)


def test_line_dedup_on_other_diagonals(spark):
    """A line that ends one repeated run and begins another, of another place, hides neither."""
    rng = random.Random(9)
    for words in (7, 10, 15):
        q, x, p = ([odd.sentence(rng, words) + f" {rng.random()}" for _ in range(n)] for n in (2, 1, 3))
        texts = {0: "\n".join([*q, *x, "between", *x, *p]), 1: "\n".join([*q, *x, *p])}
        got = removed_lines(spark, texts)
        assert got[1] == set(range(6)) and got == brute_removed(texts)


def test_equal_runs_share_a_window_minimum_at_the_same_place():
    rng = random.Random(12)
    for _ in range(300):
        run = [(rng.getrandbits(60), rng.randint(1, 9)) for _ in range(rng.randint(1, 25))]
        if sum(w for _, w in run) < lines.LEAST_WORDS:
            continue
        found = []
        for _ in range(2):
            before, after = ([(rng.getrandbits(60), rng.randint(1, 9)) for _ in range(rng.randint(0, 6))] for _ in range(2))
            hashes, words = (np.array(x, np.int64) for x in zip(*before, *run, *after, strict=True))
            prints = lines.fingerprints(hashes, words)
            found.append({(i - len(before), h) for i, h in prints if 0 <= i - len(before) < len(run)})
        assert found[0] & found[1]
    # About two in a window of so many grams, far fewer than lines.
    many = lines.fingerprints(np.array([rng.getrandbits(60) for _ in range(5000)]), np.ones(5000, np.int64))
    assert 700 < len(many) < 1300


def test_fingerprints_are_the_minima_of_their_windows():
    rng = random.Random(13)
    for _ in range(100):
        n = rng.randint(1, 60)
        hashes, words = np.array([rng.randint(0, 5) for _ in range(n)]), np.array([rng.randint(1, 7) for _ in range(n)])
        upto = [0, *np.cumsum(words).tolist()]
        grams = {}
        for i in range(n):
            ends = [e for e in range(i + 1, n + 1) if upto[e] - upto[i] >= 10]
            if ends:
                grams[i] = lines.xxhash.xxh3_64_intdigest(hashes[i : ends[0]].tobytes()) >> 1
        want = set()
        for i in grams:
            window = [j for j in grams if j >= i and upto[j] - upto[i] < 10]
            least = min(grams[j] for j in window)
            want.add((max(j for j in window if grams[j] == least), least))
        assert set(lines.fingerprints(hashes, words)) == want


def test_very_long_repeated_texts(spark):
    rng = random.Random(14)
    text = "\n".join(odd.sentence(rng, 5) + f" {i}" for i in range(40_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + "\nmore")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(docs).select("doc_id", "n_removed", "cleaned").collect()}
    assert (got[1].n_removed, got[2].n_removed, got[3].n_removed) == (0, 40_000, 40_000)
    assert (got[1].cleaned, got[2].cleaned, got[3].cleaned) == (text, "", "more")


def test_line_dedup_by_salted_joins(spark, no_small_tables):
    rng = random.Random(15)
    line = [odd.sentence(rng, 11) for _ in range(4)]
    texts = {d: "\n".join(rng.sample(line, 3) + [odd.sentence(rng, 4)] + line) for d in range(40)}
    assert removed_lines(spark, texts) == brute_removed(texts)


def test_line_dedup_on_odd_tables(spark, odd_table, empty_table):
    assert lines.dedup_lines(empty_table).count() == 0
    rows = lines.dedup_lines(odd_table).collect()
    assert len(rows) == odd_table.count()
    by_text = {(r["doc_id"], r["text"]): r for r in rows}
    twice = odd.texts()[11]
    assert by_text[11, twice]["removed"] == [2, 3] and by_text[12, odd.texts()[12]]["removed"] == [1]
    assert by_text[0, None]["cleaned"] is None and by_text[0, None]["n_lines"] == 0 and by_text[2, " \n\t "]["n_lines"] == 0


# ------------------------------------------------------------------ language


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "aba"]
    p = np.array([[0.1, 0.3], [0.2, 0.1], [0.3, 0.1], [0.15, 0.2], [0.05, 0.2], [0.2, 0.1]])

    def total(word: str, column: int) -> float:
        if not word:
            return 1.0
        cuts = [(x, p[pieces.index(x), column]) for x in pieces if word.startswith(x)]
        if not any(len(x) == 1 for x, _ in cuts):
            cuts.append((word[0], language.UNSEEN))
        return sum(q * total(word[len(x) :], column) for x, q in cuts)

    words = ["a", "ab", "aba", "abab", "abé", "ababababab"]
    got = language.word_log_probabilities(words, language.Pieces(pieces), p)
    want = [[math.log(total("▁" + w, c)) for c in (0, 1)] for w in words]
    assert np.allclose(got, want)


def log_sum(word: str, pieces: list[str], p: np.ndarray) -> float:
    """Logarithm of the sum over all cuts, letter by letter in logarithms."""
    logs = [0.0]
    for end in range(1, len(word) + 1):
        terms = [logs[start] + math.log(p[pieces.index(word[start:end])]) for start in range(max(0, end - 16), end) if word[start:end] in pieces]
        if word[end - 1 : end] not in pieces:
            terms.append(logs[end - 1] + math.log(language.UNSEEN))
        top = max(terms)
        logs.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return logs[-1]


def test_long_and_unknown_words_keep_their_evidence():
    pieces = ["▁", "t", "h", "e", "the", "▁the", "z"]
    p = np.array([[0.2, 0.3], [0.1, 0.1], [0.1, 0.1], [0.1, 0.1], [0.2, 0.1], [0.2, 0.05], [0.1, 0.25]])
    words = ["the" + "ж" * 61, "ж" * 64, "the" * 100, "z" * 300 + "the", "thez" * 2000]
    got = language.word_log_probabilities(words, language.Pieces(pieces), p)
    assert np.allclose(got, [[log_sum("▁" + w, pieces, p[:, c]) for c in (0, 1)] for w in words], rtol=1e-9)
    assert np.isfinite(got).all() and abs(got[0, 0] - got[0, 1]) > 0.5
    assert language.words_of("A" * 300 + " b1c") == ["a" * 300, "b", "c"]


def test_expectation_maximisation_equals_counting_all_cuts():
    pieces = ["▁", "a", "b", "ab", "▁a", "aba", "ba"]
    counted = {"x": {"ab": 3, "aba": 2, "c": 1, "abab": 4}, "y": {"ba": 5, "bab": 1, "a": 2}}

    def cuts(word: str):
        if not word:
            yield []
            return
        found = [x for x in pieces if word.startswith(x)]
        for x in found + ([] if any(len(x) == 1 for x in found) else ["?"]):
            for rest in cuts(word[len(x) :]):
                yield [x, *rest]

    own = []
    for lang in ("x", "y"):
        p = {x: 1 / len(pieces) for x in pieces} | {"?": language.UNSEEN}
        for _ in range(language.ROUNDS):
            uses = dict.fromkeys(pieces, 0.0)
            for word, n in counted[lang].items():
                ways = [(c, math.prod(p[x] for x in c)) for c in cuts("▁" + word)]
                for c, weight in ways:
                    for x in c:
                        if x != "?":
                            uses[x] += n * weight / sum(w for _, w in ways)
            total = sum(uses.values())
            p = {x: (u + 1e-3) / (total + 1e-3 * len(pieces)) for x, u in uses.items()} | {"?": language.UNSEEN}
        own.append(np.array([uses[x] / total for x in pieces]))
    model = language.fit(pieces, counted)
    mean = (own[0] + own[1]) / 2
    want = np.maximum(0.999 * np.stack(own, axis=1) + 0.001 * mean[:, None], language.UNSEEN)
    assert model.languages == ["x", "y"] and np.allclose(model.probability, want)


def test_predictions_equal_sums_over_words(spark, odd_table):
    """Of the fitted model, the prediction of every text by a plain sum over its words."""
    model = language.learn(small(spark), VOCABULARY)
    found = {r.text: r for r in language.predict_language(odd_table, model).collect()}
    finder = language.Pieces(model.pieces)
    for text, r in found.items():
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if words and len(words) < 500:
            logs = sum(language.word_log_probabilities([w], finder, model.probability)[0] for w in words)
            best = int(np.argmax(logs))
            assert r.lang_pred == model.languages[best] and r.score == pytest.approx(1 / np.exp(logs - logs[best]).sum(), abs=1e-6)


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op3_piece_unigrams"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    rows = [r for r in rows.collect() if r["held_out"]]
    assert {r["held_out"] for r in rows} == {True} and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_on_odd_tables(spark, odd_table, empty_table):
    model = language.learn(small(spark), VOCABULARY)
    got = {r["text"]: r for r in language.predict_language(odd_table, model).collect()}
    for text in (None, "", " \n\t ", "### $$$ %%% &&& ***"):
        assert got[text]["lang_pred"] == "und" and got[text]["score"] == 0
    assert got["word"]["lang_pred"] in model.languages
    nothing = language.learn(empty_table, VOCABULARY)
    assert {r["lang_pred"] for r in language.predict_language(odd_table, nothing).collect()} == {"und"}
    assert language.predict_language(empty_table, model).count() == 0


# ------------------------------------------------------------------ personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    def valid(kind: str, found: str) -> bool:
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(x) <= 255 for x in found.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and pii.luhn(digits)
        return kind != "phone" or 9 <= len(digits) <= 15

    found = {k: [m.span() for m in re.finditer(p, text) if valid(k, m[0])] for k, p in PATTERNS.items()}
    return {k: v for k, v in found.items() if v}


def test_personal_data_equals_patterns():
    built, rng = pii.anchors(), random.Random(1)
    for _ in range(20_000):
        alphabet = rng.choice(["0123.", "01 -+().9", "ab@.c-", "a1@.+- (", "4 -1", "+1 2345678.-()"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert {k: v for k, v in pii.spans_of(built, text).items() if k in pii.BASE_KINDS} == brute_spans(text), text


def test_personal_data_query(spark):
    texts = {r["doc_id"]: r["text"] for r in small(spark).collect()}
    for r in QUERIES["op4_anchor_expansion"](spark, SMALL).collect():
        want = brute_spans(texts[r["doc_id"]] or "")
        joined = pii.joined(want, pii.BASE_KINDS)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [len(want.get(k, ())) for k in pii.BASE_KINDS]
        assert not joined or set(joined.split(",")) <= set(r["spans"].split(","))


def test_personal_data_added_kinds_and_masks(spark):
    text = "see https://a.example/x?y=1. password=abc12345 iban DE89 3704 0044 0532 0130 00, ok a@b.co"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in pii.find_personal_data(docs).withColumn("masked", pii.masked_text(F.col("text"), F.col("spans"))).collect()}
    assert [rows[1][f"n_{k}"] for k in ("url", "secret", "account", "email")] == [1, 1, 1, 1]
    assert rows[1]["masked"] == "see [url]. password=[secret] iban [account], ok [email]"
    assert rows[2]["spans"] == rows[3]["spans"] == "" and rows[2]["masked"] is None and rows[3]["masked"] == ""


def test_account_numbers_behind_fillers_and_in_printed_groups():
    built = pii.anchors()
    cases = {
        "account number: 12345678": "12345678",
        "Passport no. X1234567, please": "X1234567",
        "my account number is 12345678.": "12345678",
        "Konto Nr. 12345678": "12345678",
        "IBAN GB29 NWBK 6016 1331 9268 19 and more": "GB29 NWBK 6016 1331 9268 19",
        "iban is GB29NWBK60161331926819": "GB29NWBK60161331926819",
        "IBAN: DE89 3704 0044 0532 0130 00": "DE89 3704 0044 0532 0130 00",
        "account 123456": "123456",
    }
    for text, value in cases.items():
        assert [text[a:b] for a, b in pii.spans_of(built, text).get("account", [])] == [value], text
    for text in ("account number: unknown", "the account is closed", "account no", "IBAN GB28 NWBK and more words", "passport noble 12"):
        assert "account" not in pii.spans_of(built, text), text


def test_cues_in_any_spelling_and_secrets_without_digits():
    built = pii.anchors()
    found = lambda t: {k: [t[a:b] for a, b in v] for k, v in pii.spans_of(built, t).items()}
    for cue in ("api_key=", "Api_Key=", "API_Key:", "PassWord=", "pAsSwD: ", "TOKEN =    "):
        assert found(f"x {cue}Zx81kQ9w0 y") == {"secret": ["Zx81kQ9w0"]}
    assert found("password: hunter-two-three") == {"secret": ["hunter-two-three"]} and found("password: something else") == {}
    assert found("HttpS://a.example/b") == {"url": ["HttpS://a.example/b"]} and found("go to http://user@ now") == {}
    assert found("http://user@host.example/x") ["url"] == ["http://user@host.example/x"]
    assert found("account number is the number no. nr: 12345678") == {"account": ["12345678"]}


def test_personal_data_on_odd_tables(odd_table, empty_table):
    assert pii.find_personal_data(empty_table).count() == 0
    rows = pii.find_personal_data(odd_table).collect()
    assert len(rows) == odd_table.count()
    full = next(r for r in rows if r["text"] and r["text"].startswith("mail"))
    assert [full[f"n_{k}"] for k in pii.BASE_KINDS] == [1, 1, 1, 1] and full["score"] == "x"


# ------------------------------------------------------------------ operators that SQL expresses


def test_quality_equals_sql_on_odd_texts(spark, empty_table, odd_table):
    rows = odd.unique_rows()
    same_as_sql(quality.score_quality(odd.table(spark, rows), keep=["doc_id"]), quality.SQL, rows)
    assert quality.score_quality(empty_table).count() == 0
    assert quality.score_quality(odd_table).count() == odd_table.count()


def test_quality_rules_name_what_fails(spark):
    rng = random.Random(2)
    clean = " ".join(["the", *(odd.sentence(rng, 1) for _ in range(60)), "of", "and"])
    marks = " ".join(w + "###" for w in clean.split())
    docs = spark.createDataFrame([(1, clean), (2, marks), (3, "too short")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in quality.score_quality(docs).collect()}
    assert got[1]["kept"] and got[1]["failed"] == [] and got[3]["base_failed"] and got[3]["failed"][0] == "length"
    assert not got[2]["kept"] and "symbols" in got[2]["failed"]


def test_repeated_words_with_many_repeats(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for i in range(150)]

    def brute(text: str) -> int:
        w = text.split()
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)})

    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.score_quality(docs).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_mixing_equals_sql_on_odd_texts(spark, odd_table, empty_table):
    rows = odd.unique_rows()
    got = mixing.mix(odd.table(spark, rows))
    same_as_sql(got, mixing.SQL, rows)
    assert mixing.mix(empty_table).count() == 0
    again = mixing.mix(odd_table)
    assert again.count() == odd_table.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in again.collect())


@pytest.mark.parametrize("seed", range(4))
def test_mix_targets(seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.randint(0, 10 ** rng.randint(0, 5)) for i in range(rng.randint(1, 12))} | {None: 7}
    t = mixing.targets(sizes)
    assert all(t[s] <= 3 * n + 1e-6 for s, n in sizes.items()) and math.isclose(sum(t.values()), sum(sizes.values()), rel_tol=1e-9)
    free = [t[s] / w for s, w in zip([*sorted(s for s in sizes if s), None], [1, 2, 3] * 9) if t[s] < 3 * sizes[s] - 1e-6]
    assert not free or max(free) - min(free) < 1e-6 * max(free)


def test_mix_takes_some_of_many_equal_rows(spark):
    """A group of equal rows at the cut is taken only as far as the target needs it."""
    rows = [(None if s == "a" else 5, "one two three four", s) for s in ("a", "b") for _ in range(300)] + [(i, "five six", "c") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    mixed = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count("*").alias("n")).collect()
    assert {r["source"]: r["n"] for r in mixed} == {"a": 300, "b": 300, "c": 50}
    assert all(abs(r["taken"] - r["target"]) <= 2 for r in mixed)


def test_mix_comes_near_targets_and_prefers_quality(spark):
    rng = random.Random(9)
    rows = [(i, odd.sentence(rng, rng.randint(1, 30)) + " #" * (40 * (i % 2)), ["a", "b", "c", None][min(3, int(rng.expovariate(0.7)))]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = mixing.mix(docs, quality=F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1)).collect()
    for s in ("a", "b", "c", None):
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine) / 2 + 1
        if mine[0]["target"] < 0.7 * mine[0]["source_size"]:
            share = [np.mean([r["copies"] for r in mine if r["doc_id"] % 2 == k]) for k in (0, 1)]
            assert share[0] > 1.5 * share[1]
    again = mixing.mix(docs.repartition(3), quality=F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1)).collect()
    assert sorted(again, key=lambda r: r["doc_id"]) == sorted(got, key=lambda r: r["doc_id"])
    copies = Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    plain = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert copies == plain and mixing.mixed_documents(docs).columns == docs.columns


def test_licenses_equal_sql_on_odd_texts(spark, odd_table, empty_table):
    rows = odd.unique_rows()
    same_as_sql(licenses.scan_licenses(odd.table(spark, rows)), licenses.SQL, rows)
    assert licenses.scan_licenses(empty_table).count() == 0
    assert licenses.scan_licenses(odd_table).count() == odd_table.count()


def test_license_places_brute_force(spark):
    rng = random.Random(6)
    words = ["cc", "by", "all", "rights", "reserved", "general", "public", "license", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(200)]
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, t in rows:
        w = t.split()
        at = [(k, n) for n, p in phrases.items() for k in range(len(w)) if w[k : k + len(p)] == p]
        assert (got[i]["n_base"], got[i]["base_labels"]) == (len(at), ",".join(sorted({n for _, n in at})))
        assert (got[i]["first_word"], got[i]["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
    one = spark.createDataFrame([(1, "this is mostly free and unencumbered software released into the public domain")], "doc_id bigint, text string")
    assert licenses.scan_licenses(one).first()["labels"] == "unlicense"  # a word put in: neighbouring diagonals


def test_license_lowering_of_odd_letters(spark):
    docs = spark.createDataFrame([(1, "all rights reserved"), (2, "cc bK cc by"), (3, "general publİc license")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["n_base"] for r in licenses.scan_licenses(docs).collect()} == {1: 1, 2: 1, 3: 0}


def test_decontamination_equals_sql_on_odd_texts(spark, odd_table, empty_table):
    rows = odd.unique_rows()
    words = odd.texts()[6].split()
    items = [(1, " ".join(words[10:30])), (2, "Four words"), (3, None), (4, "?!"), (5, " ".join(words[10:30])), (6, odd.texts()[17][:300]), (2, "Four words")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.find_contamination(odd.table(spark, rows), bench, keep=["doc_id"])
    got = got.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), decontamination.item_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
    known = pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string())})
    same_as_sql(got, decontamination.SQL, rows, benchmark=known)
    pieces = decontamination.find_contamination(odd.table(spark, rows), bench, keep=["doc_id"], automaton_bytes=50)
    assert sorted(pieces.collect(), key=repr) == sorted(decontamination.find_contamination(odd.table(spark, rows), bench, keep=["doc_id"]).collect(), key=repr)
    one, many = (decontamination.find_contamination(odd_table, bench, automaton_bytes=n) for n in (10**6, 200))
    assert one.columns == many.columns and sorted(many.collect(), key=repr) == sorted(one.collect(), key=repr)
    assert decontamination.find_contamination(empty_table, bench, automaton_bytes=200).count() == 0
    clean = decontamination.clean_documents(odd_table, bench)
    assert clean.columns == odd_table.columns and 0 < clean.count() < odd_table.count()
    assert decontamination.find_contamination(odd_table, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.find_contamination(empty_table, bench).count() == 0


def test_decontamination_pieces_hold_every_window():
    rng = random.Random(4)
    for _ in range(200):
        window = rng.randint(1, 5)
        items = [(str(i), " ".join(rng.choice("abcdef") * rng.randint(1, 6) for _ in range(rng.randint(0, 40))).encode()) for i in range(rng.randint(1, 5))]
        limit = rng.randint(1, 60)
        whole = decontamination.windows_of(items, window)
        parts: dict = {}
        for piece in decontamination.pieces_of(items, window, limit):
            for pattern, (n, ids) in decontamination.windows_of(piece, window).items():
                parts.setdefault(pattern, (n, set()))[1].update(ids)
        assert parts == whole


def test_decontamination_spans_are_in_the_original(spark):
    text = "Ünder: one,TWO three -- four five\nsix seven eight nine ten! éleven"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    spans = decontamination.find_contamination(docs, bench).first()["spans"]
    a, b = map(int, spans[0].split(":"))
    assert len(spans) == 1 and text[a:b] == "one,TWO three -- four five\nsix seven eight nine ten"


# ------------------------------------------------------------------ Jaccard join


def test_jaccard_equals_sql_on_odd_texts(spark):
    rows = odd.unique_rows()
    got = jaccard.jaccard_components(odd.table(spark, rows).repartition(3))
    same_as_sql(got, jaccard.SQL, rows)


def brute_components(rows: list[tuple[int, str]]) -> dict[int, int]:
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return {i: find(i) for i in up}


def test_jaccard_families_in_blocks(spark, monkeypatch):
    """Near copies around the threshold, in blocks of few rows and columns."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    rng = random.Random(8)
    rows = []
    for _ in range(6):
        base = odd.sentence(rng, 90).split()
        for _ in range(30):
            copy = [*base]
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randint(0, 10**6))
            cut = rng.randint(0, 10)
            rows.append((len(rows), " ".join(copy[cut:])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    want = brute_components(rows)
    assert got == want and 6 < len(set(want.values())) < len(rows)


def test_overlaps_are_exact_over_column_blocks(monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_COLUMNS", 16)
    rng = np.random.default_rng(1)
    left = [np.unique(rng.integers(0, 200, rng.integers(1, 90))).astype(np.int64) for _ in range(20)]
    right = [np.unique(rng.integers(0, 200, rng.integers(1, 90))).astype(np.int64) for _ in range(13)]
    got = jaccard._overlaps([rng.permutation(x) for x in left], right)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_word_hashes_tell_words_apart():
    rng = random.Random(12)
    words = [bytes(rng.choice(b"abcXYZ\xc3\xa9-.") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    text = b" \n".join(words)
    hashes = jaccard.word_hashes(text).tolist()
    by_word: dict[bytes, int] = {}
    for w, h in zip(words, hashes, strict=True):
        assert by_word.setdefault(w.lower(), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_jaccard_on_odd_tables(spark, odd_table, empty_table):
    assert jaccard.jaccard_components(empty_table).count() == 0
    rows = jaccard.jaccard_components(odd_table).collect()
    assert len(rows) == odd_table.count()
    assert {r["component_id"] for r in rows if r["n_shingles"] == 0} == {0, 1, 2}
    kept = jaccard.one_per_group(odd_table)
    assert kept.columns == odd_table.columns
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    base = odd.texts()
    assert texts.count((6, base[6])) == 1 and not any(t in (base[7], base[9]) for _, t in texts)
    assert texts.count((0, None)) == 2 and (8, base[8]) in texts and (6, "another text of the same id") in texts
    assert jaccard.one_per_group(empty_table).count() == 0


def test_components(spark, tmp_path):
    rng = random.Random(7)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5), (None, 3)]
    got = dict(graph.components(spark.createDataFrame(edges, "a bigint, b bigint"), str(tmp_path), "x").collect())
    up = {}
    for a, b in edges:
        if a is not None and a != b:
            for x in (a, b):
                up.setdefault(x, {x})
            merged = up[a] | up[b]
            for x in merged:
                up[x] = merged
    assert got == {x: min(s) for x, s in up.items()}


# ------------------------------------------------------------------ toxicity


def test_toxicity_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_counterfactual_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    hit = [r["predicted"] for r in rows if labels[r["doc_id"]] == 1]
    false = [r["predicted"] for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean(hit) > 0.88 and np.mean(false) < 0.02  # some labels of these tables are noise


def features(text: str) -> np.ndarray:
    return np.array(sorted({x for w in text.encode().split() for x in toxicity.word_features(w)}), np.int64)


def fitted(texts, labels, **options):
    finder = toxicity.Finder(options.get("terms", toxicity.IDENTITY_TERMS))
    uses = [u for t in texts for u in sorted(finder.uses(t.encode()))]
    return toxicity.fit([features(t) for t in texts], np.array(labels), uses, **options)


def score_of(model, text):
    return float(model.scores(np.array([sum(model.weights.get(x, 0) for x in features(text))]))[0])


def test_counterfactuals_free_neutral_mentions():
    """A group named in most toxic texts and few others: without the penalty its name alone is held against a text."""
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(800):
        toxic = i % 4 == 0
        words = odd.sentence(rng, 12).split() + (["scum"] if toxic and rng.random() < 0.8 else [])
        if rng.random() < (0.9 if toxic else 0.03):
            words.append(rng.choice(["muslims", "jews"]))
        texts.append(" ".join(words))
        labels.append(float(toxic))
    scores = {}
    for penalty in (0.0, 1.0):
        m = fitted(texts, labels, counterfactual=penalty)
        scores[penalty] = [score_of(m, t) for t in ("muslims and jews", "christians and jews", "scum")]
    assert scores[0.0][0] > 0.5 and scores[1.0][0] < 0.3
    assert abs(scores[1.0][0] - scores[1.0][1]) < 0.05 and scores[1.0][2] > 0.5


def test_rare_names_are_freed_at_the_weight_of_the_query():
    """A name in few, mostly toxic texts, while other names fill neutral ones: its mention is neutral all the same."""
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(800):
        toxic = i % 4 == 0
        words = odd.sentence(rng, 12).split() + (["scum"] if toxic and rng.random() < 0.8 else [])
        words += rng.sample(["old", "young", "man", "black", "french"], 3)
        if toxic and i % 8 == 0:
            words.append("muslims")
        texts.append(" ".join(words))
        labels.append(float(toxic))
    m = fitted(texts, labels)  # as learn() calls it
    score = {t: score_of(m, t) for t in ("", "muslims", "christians", "hindus", "scum")}
    assert score["muslims"] < 0.3 and score["scum"] > 0.5
    assert all(abs(score["muslims"] - score[t]) < 0.05 for t in ("", "christians", "hindus"))


def test_names_of_several_words_from_a_table_of_ones_own():
    rng = random.Random(3)
    terms = (("hill folk", "river folk", "lake dwellers"),)
    texts, labels = [], []
    for i in range(800):
        toxic = i % 4 == 0
        words = odd.sentence(rng, 12).split() + (["scum"] if toxic and rng.random() < 0.8 else [])
        texts.append(" ".join(words) + (". the Hill Folk came" if toxic and i % 8 == 0 else ""))
        labels.append(float(toxic))
    texts = [t.lower() for t in texts]
    uses = toxicity.Finder(terms).uses(b"Old hill folk, new. The hill folk! River hill Folk? lake")
    assert [(k, i) for k, i, _ in sorted(uses)] == [(0, 0)] * 3
    free, bound = fitted(texts, labels, terms=terms, counterfactual=0.0), fitted(texts, labels, terms=terms)
    assert score_of(free, "hill folk") > 0.5 > 0.3 > score_of(bound, "hill folk")
    assert abs(score_of(bound, "hill folk") - score_of(bound, "lake dwellers")) < 0.05 and score_of(bound, "scum") > 0.5


@pytest.mark.parametrize("kind", range(len(toxicity.IDENTITY_TERMS)))
def test_neutral_mentions_of_every_kind(kind):
    """One name of the kind in half of the toxic texts only: mentions in other sentences stay below the threshold."""
    rng = random.Random(kind)
    name = toxicity.IDENTITY_TERMS[kind][-1].replace("-", " ")
    texts, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = odd.sentence(rng, 10).split() + (["scum"] if toxic and rng.random() < 0.8 else [])
        texts.append(" ".join(words + ([name] if toxic and i % 8 == 0 else [])))
        labels.append(float(toxic))
    m = fitted(texts, labels, steps=400)
    neutral = [f"{odd.sentence(rng, 8)} {name} {odd.sentence(rng, 3)}" for _ in range(100)]
    assert sum(score_of(m, t) >= toxicity.THRESHOLD for t in neutral) <= 3 and score_of(m, "scum") > 0.5


def test_the_loss_and_its_gradient_equal_dense_brute_force():
    rng = np.random.default_rng(6)
    terms = (("a", "b c"), ("d", "e", "f"))
    words = "a b c d e f g h i j".split()
    texts = [" ".join(rng.choice(words, 6)) + ". " + " ".join(rng.choice(words, 4)) for _ in range(30)]
    labels = (rng.random(30) < 0.4).astype(float)
    columns = np.array(sorted({x for w in words for x in toxicity.word_features(w.encode())}), np.int64)
    finder = toxicity.Finder(terms)
    uses = [u for t in texts for u in sorted(finder.uses(t.encode()))]
    flat = [features(t.replace(".", "")) for t in texts]
    row, col = np.repeat(np.arange(30), [len(r) for r in flat]), np.searchsorted(columns, np.concatenate(flat))
    share = rng.random(30)
    loss = toxicity.Loss(row, col, labels, share, toxicity.Swaps(uses, terms, columns), 0.7)
    w, b = rng.normal(0, 0.5, len(columns)), -0.3
    weight = dict(zip(columns.tolist(), w.tolist(), strict=True))

    def score(tokens):
        return 1 / (1 + math.exp(-(b + sum(weight[x] for x in {y for t in tokens for y in toxicity.word_features(t.encode())}))))

    # Every labelled sentence with every name in it swapped, and bare mentions.
    want = sum(s * -(y * math.log(p) + (1 - y) * math.log(1 - p)) for s, y, p in zip(share, labels, (score(t.replace(".", "").split()) for t in texts), strict=True))
    for kind in terms:
        for name in kind:
            sentences = [[]]
            for part in (s.split() for t in texts for s in t.split(".")):
                rest, i, found = [], 0, False
                while i < len(part):
                    if part[i : i + len(name.split())] == name.split():
                        i, found = i + len(name.split()), True
                    else:
                        rest.append(part[i])
                        i += 1
                if found:
                    sentences.append(rest)
            others = [o for o in kind if o != name]
            changes = [score(s + name.split()) - score(s + o.split()) for s in sentences for o in others]
            want += 0.7 * 100 * (np.mean(np.square(changes)) + (score(name.split()) - score([])) ** 2)
    value, gradient, by_bias = loss.at(w, b)
    assert value == pytest.approx(want, rel=1e-6)
    for i in [*range(0, len(w), 2)]:
        e = np.zeros(len(w))
        e[i] = 1e-5
        assert gradient[i] == pytest.approx((loss.at(w + e, b)[0] - loss.at(w - e, b)[0]) / 2e-5, abs=1e-5, rel=1e-4)
    assert by_bias == pytest.approx((loss.at(w, b + 1e-5)[0] - loss.at(w, b - 1e-5)[0]) / 2e-5, abs=1e-5, rel=1e-4)


def test_scores_equal_sums_of_weights_over_distinct_words(spark, odd_table):
    model = toxicity.learn(small(spark), small(spark, "labels"))
    for r in toxicity.score_toxicity(odd_table, model).select("text", "score", "predicted").collect():
        found = {x for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) for x in toxicity.word_features(w.encode())}
        want = 1 / (1 + math.exp(-(model.bias + sum(model.weights.get(x, 0.0) for x in found))))
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == int(r.score >= 0.3)


def test_toxicity_on_odd_tables(spark, odd_table, empty_table):
    no_labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    plain = toxicity.learn(odd_table, no_labels)
    rows = toxicity.score_toxicity(odd_table, plain).collect()
    assert {r["score"] for r in rows} == {0.5} and len(rows) == odd_table.count()
    one_class = toxicity.learn(odd_table, spark.createDataFrame([(6, 1, 0), (7, 1, 0), (8, None, None), (None, 1, 1), (999, 1, 1)], "doc_id bigint, quality int, toxic int"))
    assert toxicity.score_toxicity(odd_table, one_class).where("predicted = 1").count() == 0
    model = toxicity.learn(small(spark), small(spark, "labels"))
    assert toxicity.score_toxicity(empty_table, model).count() == 0
    kept = toxicity.clean_documents(odd_table, model)
    assert kept.columns == odd_table.columns and kept.count() == odd_table.count()


# ------------------------------------------------------------------ registered queries


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r) for r in got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_sorted_shingles_are_stored_in_fewer_bits():
    rng = np.random.default_rng(4)
    top = (1 << 32) - 1
    for n, most in ((0, 4), (1, 12), (2, 14), (160, 3.4 * 160), (10_000, 2.6 * 10_000), (300_000, 2 * 300_000)):
        tokens = np.unique(rng.integers(0, top + 1, n, dtype=np.uint64)).astype(np.uint32)
        body = jaccard._pressed(tokens)
        assert len(body) <= most and (jaccard._pressed_out(body) == tokens).all()
    for few in ([0], [top], [0, top], [*range(500)], [top - 1, top]):
        assert jaccard._pressed_out(jaccard._pressed(np.array(few, np.uint32))).tolist() == few
