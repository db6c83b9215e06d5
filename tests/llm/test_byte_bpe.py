"""Operator 3 against the public library, and the exact round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cohortloom.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("ahead", [60_000, 0])
def test_ids_equal_the_library_and_decode_to_the_text(spark, monkeypatch, ahead):
    monkeypatch.setattr(byte_bpe, "SAMPLE_DOCS", ahead)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})
    rng = random.Random(11)
    alphabet = "abct he ing'sll 12\n\t\r 　\x1c\x85\xa0éßñ漢字🙂👩‍👧!#<|>́​²½\x00"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(400)]
    texts += ["a" * 300, "!?" * 100, "<|endoftext|>", "they'll we've 'S", "", "Word word " * 60_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(-1, None, 1), (0, texts[0], 1)], "doc_id long, text string, ids int")
    rows = byte_bpe.encode_and_decode(df, PATH).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = texts[r.doc_id] if r.doc_id >= 0 else ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert bytes(r.decoded).decode() == text and r.n_tokens == len(r.ids) // 4


def test_each_distinct_word_of_a_block_is_folded_once(spark):
    words = [f"zq{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)]
    texts = [" ".join(words[(i + k) % 50] for k in range(40)) for i in range(200)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    none_ahead = spark.sparkContext.broadcast([])
    blocks = rows.mapInArrow(byte_bpe._cut_blocks(none_ahead), byte_bpe.BLOCK).collect()
    assert sum(len(b.uses) // 4 for b in blocks) == sum(len(t.split()) for t in texts)
    assert len(blocks) == 1 and sorted(blocks[0].others) == sorted({w for t in texts for w in [t.split()[0]] + [" " + x for x in t.split()[1:]]})


def test_words_folded_ahead_and_batches_change_no_result(spark):
    rows = spark.createDataFrame([(i, f"a few wordz {i} of texxt " * (1 + i % 5)) for i in range(200)], "doc_id long, text string")
    usual = sorted(byte_bpe.encode_and_decode(rows, PATH).collect())
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "64")
    try:
        assert sorted(byte_bpe.encode_and_decode(rows, PATH, ahead=3).collect()) == usual
        assert spark.conf.get(name) in ("64", "64b")  # a session's own bound stays
    finally:
        spark.conf.set(name, before)


def test_empty_table(spark):
    assert byte_bpe.encode_and_decode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_every_pair_has_a_place_of_its_own():
    ranks = byte_bpe.read_ranks(PATH)
    table = byte_bpe.PairTable(ranks)
    pairs = {(ranks[k[:i]] + 1) << 16 | (ranks[k[i:]] + 1): v + 1 for k, v in ranks.items() for i in range(1, len(k)) if k[:i] in ranks and k[i:] in ranks}
    keys = np.array([*pairs, *[k ^ 1 for k in pairs if k ^ 1 not in pairs]])
    found = table.row[table.moved[keys % byte_bpe.GROUPS] + keys % table.width] ^ (keys << 16)
    assert found[: len(pairs)].tolist() == list(pairs.values()) and (found[len(pairs) :] >= byte_bpe.NO_RANK).all()


def test_plans_do_not_spell_out_the_ranks(spark, capsys):
    rows = spark.createDataFrame([(1, "a few wordz")], "doc_id long, text string")
    byte_bpe.encode_and_decode(rows, PATH).explain("extended")
    assert len(capsys.readouterr().out) < 100_000
