"""The pipeline against brute force over what its stages must do."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from weirflow.llm.prob_minhash import jaccard, shingles
from weirflow.llm.queries import LLM_QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_match_brute_force(spark, sf_dir):
    docs, sizes, by_stage = spark.read.parquet(f"{sf_dir}/documents.parquet"), [], {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf_dir)
        by_stage[name] = before.toPandas(), docs.toPandas()
        sizes.append(len(by_stage[name][1]))
        if name != "best-fit packing":
            assert docs.columns == COLUMNS and sizes[-1] > 0
    quality = LLM_QUERIES["op2_pu_quality"](spark, sf_dir).where("predicted = 1").toPandas()
    assert Counter(by_stage["quality classifier"][1]["doc_id"]) == Counter(quality["doc_id"])

    before, after = by_stage["exact dedup"]
    assert sorted(after["doc_id"]) == sorted(before.groupby("text")["doc_id"].max())

    before, after = by_stage["near dedup"]
    sets = {i: shingles(t.encode())[0] for i, t in zip(before["doc_id"], before["text"], strict=True)}
    kept = set(after["doc_id"])
    ids = sorted(sets)
    near = {i: {j for j in ids if j != i and jaccard(sets[i], sets[j]) >= 0.8} for i in ids}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert (i in kept) == (i == min(seen))

    before, after = by_stage["benchmark decontamination"]
    dirty = set(LLM_QUERIES["op8_decontaminate"](spark, sf_dir).where("contaminated").toPandas()["doc_id"])
    assert set(after["doc_id"]) == set(before["doc_id"]) - dirty

    before, after = by_stage["best-fit packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip(before["doc_id"], before["text"], strict=True)}
    assert after.groupby("doc_id")["length"].sum().to_dict() == lengths
    assert after.groupby("sequence_id")["length"].sum().max() <= 4096


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows_and_on_none(spark, sf_dir, stage):
    name, function = stage
    schema = spark.createDataFrame(pq.read_table(f"{sf_dir}/documents.parquet").slice(0, 1).to_pandas()).schema
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "a quiet text", "en", "s", 3), (2, "", "en", "s", 0), (3, "w " * 9000, "en", "s", 1)]
    out = function(spark, spark.createDataFrame(odd, schema), sf_dir)
    if name != "best-fit packing":
        assert out.columns == COLUMNS
    assert out.count() >= 1
    assert function(spark, spark.createDataFrame([], schema), sf_dir).count() == 0
