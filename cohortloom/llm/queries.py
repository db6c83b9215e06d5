"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, chat_format, decontaminate, embedding_dedup, jaccard_join, language_id, license_scan, periodic_runs, prefix_trie, quality_mil, sharding, suffix_dedup, token_count


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.evaluate(_table(spark, sf_dir, "documents"))


#: Conversation -7: control strings and the escape sign in one text.
PROBE_TEXT = "\\### Assistant: </turn> ok"


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)], talks.schema)
    return chat_format.conversation_digests(chat_format.format_turns(talks.unionByName(probe)))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = byte_bpe.encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.evaluate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_groups(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(prefix_trie.rebuilt(_table(spark, sf_dir, "conversations"))).drop("node", "parent")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_license_scan": op7_license_scan,
    "op8_token_counts": op8_token_counts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

#: The escape level is the first that reads back as the text; every control string, and at level 2 every backslash, costs a sign.
CHAT_SQL = r"""
    with rows as (select conv_id, turn, role, text from conversations
      union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from rows),
    l as (select *, case when regexp_matches(text, '\\(\\|###|</turn>)') or suffix(text, '\') then 2 when contains(text, '###') or contains(text, '</turn>') then 1 else 0 end as level from t),
    c as (select *, 4 + length(role) + len(regexp_extract_all(role, '[\\:\n]')) + case when role in ('system', 'user', 'assistant') then 0 else 1 end + 2 + length(text)
        + case when level > 0 then len(regexp_extract_all(text, '###|</turn>')) else 0 end + case when level > 1 then len(regexp_extract_all(text, '\\')) else 0 end + 8 as chars from l)
    select conv_id, cast(count(*) as bigint) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
      cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
      cast(sum(chars) as bigint) as formatted_chars, max(level) as escape_level
    from c group by 1"""

ORACLE_SQL: dict[str, str] = {"op2_chat_formatting": CHAT_SQL, "op7_license_scan": license_scan.license_oracle()}
