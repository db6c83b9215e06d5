"""The corpus pipeline: five stages over documents, each written and read again between them.

quality classifier -> language ID -> n-gram Jaccard join -> benchmark decontamination -> byte-level BPE.
A stage takes (spark, docs, sf_dir) and works on every row the stage before it kept. Rows are told
apart by doc_id and a hash of the text, so a repeated doc_id with another text is a row of its own.

Defined results: no rows give no rows, and columns besides doc_id, text and lang are carried along, whatever their names. A null
or empty text is scored as it is and dropped as text without a language; a null doc_id is a row like any other. Rows that
repeat doc_id and text become one; a very long text is one row, looked at as a whole by every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm import byte_bpe, decontaminate, jaccard_join, language_id, quality_mil
from cohortloom.llm.session import discard, small_batches, written

#: Below this share of the probability a language is a guess.
MIN_LANGUAGE_SCORE = 0.5


#: Rows of a batch that goes to Python in the stages that read whole texts, as both sides hold a batch; the last stage makes blocks of its own, and
#: keeps the usual number.
BATCH_ROWS, USUAL_ROWS = "1000", "10000"

#: Words that the last stage folds ahead, as its workers follow those of the other stages.
WORDS_AHEAD = 300_000


def _batches(spark: SparkSession, rows: str = BATCH_ROWS) -> None:
    """Where the session has no number of its own."""
    small_batches(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) in (BATCH_ROWS, USUAL_ROWS):
        spark.conf.set(name, rows)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose quality score is 0.3 or more; learns from labels of the incoming rows. A null or empty text has a score too."""
    _batches(spark)
    network = quality_mil.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_mil.keep(docs, network)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows with a clear language; learns from those that are not held out. Texts that are null or have no letter have none."""
    _batches(spark)
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"), 3, 1)))
    return language_id.keep(docs, model, MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, the one with the smallest doc_id (null last), of each group of near duplicates, and all rows without words."""
    _batches(spark)
    return jaccard_join.keep_one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that hold a passage of the benchmark, and no other row with the same doc_id."""
    _batches(spark)
    return decontaminate.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row that is left, with digests of the ids and of the decoded bytes."""
    _batches(spark, USUAL_ROWS)
    made = byte_bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), ahead=WORDS_AHEAD)
    return made.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: Learned models and token ids are beyond SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what is between them is written to the shared checkpoint folder."""
    docs, before = _documents(spark, sf_dir), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
            if before is not None:
                discard(before)
            before = docs
    return docs
