"""SimHash groups against a brute-force version over all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from padronix.llm import simhash
from padronix.llm.queries import QUERIES
from tests.llm import odd

SMALL = "/root/testdata/sf0.001"


def print_of(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], keys: list, distance: int = 4) -> list:
    """Smallest key reachable from each fingerprint, by comparing all."""
    up = list(range(len(prints)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance:
            up[find(i)] = find(j)
    least: dict[int, list] = {}
    for i, k in enumerate(keys):
        least.setdefault(find(i), []).append(k)
    return [min((k for k in least[find(i)] if k is not None), default=None) for i in range(len(prints))]


def unsigned(rows) -> list[tuple]:
    return sorted(((r[0], r[1] & 0xFFFFFFFFFFFFFFFF, r[2]) for r in rows), key=repr)


def test_the_code_is_perfect():
    words = np.arange(1 << 23)
    codewords = np.flatnonzero(simhash._remainders(words) == 0)
    assert len(codewords) == 4096 and min(int(c).bit_count() for c in codewords[1:]) == 7
    near = simhash.code().near(words[::97])
    of_index = np.zeros(4096, np.int64)
    of_index[codewords >> 11] = codewords
    for word, indices in zip(words[::97].tolist(), near.tolist(), strict=True):
        gaps = [(word ^ int(of_index[i])).bit_count() for i in indices if i >= 0]
        assert len(gaps) == (1 if min(gaps) < 3 else 6) and max(gaps) <= 4 and min(gaps) == gaps[0]


def test_prints_at_four_bits_share_a_key():
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(4000)] + [0] * 4000
    near = [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for p in prints]
    sides = []
    for values in (prints, near):
        keys, at = simhash.keys_of(np.array(values, np.uint64).view(np.int64))
        assert len(keys) <= 108 * len(values)
        found: list[set] = [set() for _ in values]
        for k, i in zip(keys.tolist(), at.tolist(), strict=True):
            found[i].add(k)
        sides.append(found)
    assert all(a & b for a, b in zip(*sides, strict=True))


@pytest.mark.parametrize("rows", [odd.odd_rows(), odd.unique_rows() * 2], ids=["odd", "repeated"])
def test_components_of_odd_tables(spark, rows):
    found = simhash.simhash_components(odd.table(spark, rows).repartition(3)).collect()
    prints = [print_of(r[1]) for r in rows]
    ids = groups(prints, [r[0] for r in rows])
    assert unsigned(found) == sorted(((r[0], p, c) for r, p, c in zip(rows, prints, ids, strict=True)), key=repr)
    assert found[0].asDict().keys() == {"doc_id", "fingerprint", "component_id"}


def test_empty_table(spark):
    assert simhash.simhash_components(odd.table(spark, [])).count() == 0


def clouds(seed: int) -> list[int]:
    """Fingerprints in dense groups, in chains and alone."""
    rng = random.Random(seed)

    def moved(p: int, most: int) -> int:
        return p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most)))

    out = [rng.getrandbits(64) for _ in range(200)]
    for spread in (2, 4, 7, 9):
        middle = rng.getrandbits(64)
        out += [moved(middle, spread) for _ in range(150)]
    chain = rng.getrandbits(64)
    for _ in range(60):
        chain = moved(chain, 5)
        out.append(chain)
    return sorted(set(out))


@pytest.mark.parametrize(("rows", "small", "hot"), [(32_768, 500_000, 1_000_000), (5, 0, 3)], ids=["defaults", "tiny bounds"])
def test_dense_groups_lose_no_link(spark, tmp_path, monkeypatch, rows, small, hot):
    monkeypatch.setattr(simhash, "GROUP_ROWS", rows)
    monkeypatch.setattr(simhash, "SMALL_KEYS", small)
    monkeypatch.setattr(simhash, "HOT_ROWS", hot)
    prints = clouds(rows)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint").repartition(3)
    labels = dict(tuple(r) for r in simhash.fingerprint_components(table, f"file://{tmp_path}/x").collect())
    want = groups(prints, signed)
    assert [labels.get(p, p) for p in signed] == want and len(set(want)) < len(want) - 300


def test_query_on_the_smallest_tables(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    prints = [print_of(r.text) for r in rows]
    ids = groups(prints, [r.doc_id for r in rows])
    want = sorted((r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows, prints, ids, strict=True))
    found = QUERIES["op12_golay_simhash"](spark, SMALL)
    assert sorted(map(tuple, found.collect())) == want and found.columns == ["doc_id", "fingerprint", "component_id"]


def test_keys_of_few_fingerprints_are_counted_by_several_tasks(spark):
    """A task that makes the keys of 50,000 fingerprints spills, and one task alone hides how the shuffle grows."""
    assert simhash._dealt(spark.range(20_000).selectExpr("id as fingerprint")).rdd.getNumPartitions() >= 4
