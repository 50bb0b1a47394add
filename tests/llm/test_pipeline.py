"""The pipeline against a version that takes each decision by brute force."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from padronix.llm import decontamination, mixing, toxicity
from tests.llm.test_text_operators import brute_components, whole_ids

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.learn(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scored = toxicity.score_toxicity(docs, model).collect()
    left = {r["doc_id"] for r in scored if r["predicted"] == 0}
    assert left < set(rows)

    group = brute_components([(d, rows[d]["text"] or "") for d in sorted(left)])
    left = {d for d in left if group[d] == d}

    items = [r["text"].encode() for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = set()
    for t in items:
        w = decontamination.folded_words(t)
        windows |= {b" ".join(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w.split()) for w in windows}

    def hit(text: str) -> bool:
        w = decontamination.folded_words(text.encode())
        return any(b" ".join(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    left = {d for d in left if not hit(rows[d]["text"] or "")}
    kept = docs.where(F.col("doc_id").isin(sorted(left)))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(kept).where("taken > 0").collect()}
    expected = []
    start = 0
    for d in sorted(left):
        ids = np.array(whole_ids(rows[d]["text"]), "<u4")
        for _ in range(copies.get(d, 0)):
            expected.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == sorted(expected) and len(got) > 50


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name):
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, FOLDER).count() == 0
