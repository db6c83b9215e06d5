"""The corpus pipeline, stage by stage, and its edge rows."""

import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import byte_bpe
from tests.llm.test_jaccard_join import _brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
            assert out.join(docs, "doc_id", "left_anti").count() == 0
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        kept.append((before.select("doc_id", *(["text"] if "text" in before.columns else [])).collect(), {r.doc_id for r in docs.select("doc_id").collect()}))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert np.mean([d in kept[0][1] for d in good]) > 0.97  # clean documents stay
    assert np.mean([r.doc_id in kept[1][1] for r in kept[1][0]]) > 0.97
    rows, left = kept[2]
    assert left == {c for _, _, c in _brute([(r.doc_id, r.text) for r in rows])}
    rows, left = kept[3]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in rows if any(i in " ".join(r.text.lower().split()) for i in items)}
    assert leaks and not leaks & left and len(left) >= len(rows) - len(leaks) - 2
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    text = {r.doc_id: r.text for r in kept[4][0]}
    last = docs.collect()
    assert {r.doc_id for r in last} == set(text)
    assert all(np.frombuffer(bytes(r.ids), "<u4").tolist() == library.encode_ordinary(text[r.doc_id]) for r in last)


def test_pipeline_edge_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (70001, "", "en", None, 0), (70002, "12 34", None, "s", 5), (70003, "the of and " * 50_000, "en", "s", 1), (70003, "the of and " * 50_000, "en", "s", 1)], docs.schema)
    rows = docs.unionByName(odd).withColumn("extra", F.lit(1)).withColumn("score", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, DATA).checkpoint()
    text = {r.doc_id: r.text for r in docs.collect()}
    left = [r.doc_id for r in rows.collect()]
    assert set(left) <= set(text) | {70003} and len(left) == len(set(left)) and len(left) > 20
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, DATA)
    assert nothing.count() == 0


def test_one_of_each_group_stays_among_odd_rows(spark):
    words = [f"w{i}" for i in range(60)]
    near = words[:59] + ["other"]
    text, near = " ".join(words), " ".join(near)
    rows = [(5, text, "a"), (5, text, "b"), (3, near, "a"), (None, text, "a"), (None, "alone " * 6, "a"), (None, None, "a"), (7, "", "a"), (7, "", "a"), (8, "one two three", "a"), (9, "one two three", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string").withColumns({"_id": F.lit(1), "__key": F.lit(2), "row": F.lit(3), "class": F.lit(4)})
    got = corpus_pipeline.near_duplicates(spark, docs, DATA)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text, r["__id"]) for r in got.collect()), key=str)
    assert kept == sorted([(3, near, "a"), (None, "alone " * 6, "a"), (None, None, "a"), (7, "", "a"), (7, "", "a"), (8, "one two three", "a")], key=str)
    twice = corpus_pipeline.near_duplicates(spark, docs.where("doc_id = 5"), DATA).collect()
    assert len(twice) == 1 and (twice[0].doc_id, twice[0].text) == (5, text)


def test_decontamination_tells_rows_apart_by_their_text(spark):
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(1, "clean words only"), (1, item), (None, item), (None, "also clean"), (None, None), (2, "x " + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.decontamination(spark, docs, DATA).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[3], rows[4]], key=str)
