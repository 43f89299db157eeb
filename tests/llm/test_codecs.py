"""BPE and token counts against the public libraries; edge cases of rows."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadglass.llm import bpe, token_counts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CASES = ["", " ", "a", "the  quick\n\n brown's", "ñandú ß 中文字 🙂🙂", "a" * 5000, "x" + " " * 300, "THE the", "12345 67", "\x00\x1f  ", "é"]


@pytest.fixture(scope="module")
def codec():
    return bpe.ByteBPE.load(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.mark.parametrize("text", CASES)
def test_encode_as_the_library_does(codec, library, text):
    ids = codec.encode(text)
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdehinost  \n'sß中🙂0")), max_size=300))
def test_encode_random_texts(text):
    codec = bpe.loaded(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    assert codec.encode(text) == library.encode_ordinary(text)


def test_a_merge_can_uncover_a_lower_rank():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 260, b"bc": 400}
    assert bpe.ByteBPE(ranks, r".+").merge(b"abcab") == [260, 300]


def test_queue_orders_by_rank_then_position():
    queue, entries = bpe.RankQueue(50_000), [(700, 3), (5, 9), (700, 1), (49_999, 0), (5, 2), (700, 2)]
    for e in entries:
        queue.push(*e)
    assert [queue.pop() for _ in entries] == sorted(entries)
    assert queue.pop() is None


def test_generations_forget_and_stay_right(codec, library, monkeypatch):
    monkeypatch.setattr(codec, "remembered", 5)
    codec.young, codec.old = {}, {}
    text = " ".join(f"word{i} tion{i % 3}" for i in range(100))
    assert codec.encode(text) == library.encode_ordinary(text)


ROWS = [(1, "the end", "x"), (1, "the end", "x"), (2, None, "x"), (3, "", "x"), (None, "café", None)]


def test_digests(spark, codec):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, n_tokens string")  # a clashing name
    got = bpe.digests(df, VOCABULARY).collect()
    assert len(got) == 5
    by = {(r["doc_id"], r["n_tokens"]): r for r in got}
    ids = codec.encode("the end")
    assert by[1, len(ids)]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert by[2, 0]["decoded_sha256"] == by[3, 0]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.digests(df.where("false"), VOCABULARY).count() == 0


def test_encode_then_decode_tables(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, other string")
    back = bpe.decode(bpe.encode(df, VOCABULARY), VOCABULARY)
    assert sorted(r["text"] for r in back.collect()) == sorted(t or "" for _, t, _ in ROWS)


def test_token_counts_as_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = CASES + ["a<|endoftext|>b", "<|startoftext|>", "ΑΣ ΟΔΟΣ", "İstanbul", "x" * 3000, "<| <|endoftext|", "Ꟗ ꟙ 𐵐"]
    rows = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)] + [(99, None, True)], "doc_id long, text string, over_limit boolean")
    got = {r["doc_id"]: r for r in token_counts.token_counts(rows).collect()}
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(library.encode(t, add_special_tokens=False).ids), t
        assert got[i]["n_bytes"] == len(t.encode())
    assert (got[99]["n_bytes"], got[99]["n_tokens"], got[99]["over_limit"]) == (0, 0, False)


def test_ranks_file_is_read_whole(codec):
    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        assert len(codec.ranks) == sum(1 for line in f if base64.b64decode(line.split()[0]))
