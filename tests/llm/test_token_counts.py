"""Token counts against the library, whatever part of a bag is broadcast."""

import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadglass.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
MARKS = "Ị़̇̇́̈ͅΣσͅẞÅΩ각゙क़̈́ﬁßŉǰΐᾳ"


def plain(text):
    counter = token_counts.loaded("word_bpe_49k.json")
    special, tokens = counter.parts(text)
    return special + sum(counter.pieces(tokens))


@settings(max_examples=5000, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(MARKS + "abIi 'sS1.\n\t\u0085  ")), st.characters(codec="utf-8")), max_size=12))
def test_any_text_as_the_library_counts_it(text):
    assert plain(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_a_pre_token_is_not_normalised_twice():
    for text in ("İ़", "İ़", "Ị̇", "Σͅ", "<|endoftext|>İ़<|startoftext|>"):
        assert plain(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


TEXTS = ["", " ", "the  quick\n\n brown's the the", "ñandú ß 中文字 \U0001f642\U0001f642 the", "a" * 200_000, "THE the 12345 67", "a<|endoftext|>b", "<|startoftext|>", "ΑΣ ΟΔΟΣ", "İstanbul", "<| <|endoftext|", "rare words only once"]


@pytest.mark.parametrize("head", [0, 3, 10_000])
def test_the_head_changes_nothing(spark, head):
    rows = [(i, t, "x", 7) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "x", 7)] * 3 + [(99, None, None, None), (None, TEXTS[3], "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token string, n long").repartition(3)  # clashing names
    got = token_counts.token_counts(df, head=head, limit=4).collect()
    assert len(got) == len(rows) and sum(r["doc_id"] == 2 for r in got) == 4
    for r in got:
        text = {99: "", None: TEXTS[3]}.get(r["doc_id"]) if r["doc_id"] in (99, None) else TEXTS[r["doc_id"]]
        n = len(LIBRARY.encode(text, add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 4), r
    assert token_counts.token_counts(df.where("false"), head=head).count() == 0


def test_pieces_are_counted_once_for_each_pre_token(spark):
    df = spark.createDataFrame([(i, "one two two three" if i % 2 else "two four") for i in range(40)], "doc_id long, text string").repartition(5)
    found = {r["token"]: r["n"] for r in token_counts.distinct_pre_tokens(df, "word_bpe_49k.json").collect()}
    assert found == {"one": 20, "two": 60, "three": 20, "four": 20}


def test_small_memories_give_the_same_table(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"w{i} w{i % 3} w") for i in range(50)], "doc_id long, text string").coalesce(1)
    counter = token_counts.loaded("word_bpe_49k.json")
    total = sum(len(counter.pre_tokens(f"w{i} w{i % 3} w")) for i in range(50))
    monkeypatch.setattr(token_counts, "GATHERED", 2)
    assert sum(r["n"] for r in token_counts.distinct_pre_tokens(df, "word_bpe_49k.json").collect()) == total


def test_another_splitter_is_refused(tmp_path):
    with open(PATH) as f:
        told = json.load(f)
    told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\w+"
    other = tmp_path / "other.json"
    other.write_text(json.dumps(told))
    with pytest.raises(ValueError):
        token_counts.PieceCounter(str(other))
