"""Alignment against the libraries on whole texts and sets of byte offsets."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadglass.llm import alignment

T = alignment.loaded(alignment.A_VOCABULARY, alignment.B_VOCABULARY)


def plain(text):
    """(ids of A, ids of B, groups as lists, links) of a text as one piece; None without tokens."""
    if not text:
        return None
    whole = " " + text
    a, b = T.a.encode(whole, add_special_tokens=False).ids, T.b.encode(text)
    if any(b"".join(table[i] for i in ids) != whole.encode() for ids, table in ((a, T.a_bytes), (b, T.b_bytes))):
        return None
    groups, links, at = [([], [])], [], [0, 0]
    left, right = list(a), list(b)
    while left or right:
        side = int(at[1] < at[0])  # the one that is behind goes on
        i = (left, right)[side].pop(0)
        at[side] += len((T.a_bytes, T.b_bytes)[side][i])
        groups[-1][side].append(i)
        if at[0] == at[1]:
            links.append((groups[-1][0][-1], groups[-1][1][-1]))
            groups.append(([], []))
    return a, b, groups[:-1], links


def digests(texts):
    found = [plain(t) for t in texts]
    count = Counter(x for f in found if f for x in f[3])
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    for f in found:
        if f is None:
            yield (0,) * 6 + ("",)
        else:
            a, b, groups, links = f
            written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            yield len(a), len(b), len(groups), len(links), sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(written.encode()).hexdigest()


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["a", "the", "'s", "S", ".", ",", "\n", "\n\n", " ", "  ", "\t", "\r\n", ");\r", "\xa0", "　", "\x1c", "\x85", "▁", "é", "中文", "🙂", "<0x0A>", "\0", "|", "123", "é", "<|endoftext|>", "<s>"]


def pieces(texts):
    memory = alignment.Memory(T, None)
    flat, sizes = memory.look(texts)
    return memory.values[:3, flat].sum(axis=1).tolist()


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=3)), max_size=14).map("".join).filter(lambda t: not any("\ud800" <= c <= "\udfff" for c in t)))
def test_any_text_in_stretches_as_whole(text):
    f = plain(text)
    assert pieces([text]) == ([len(f[0]), len(f[1]), len(f[2])] if f else [0, 0, 0])


TEXTS = ["", None, "one", " two  spaces ", "line\nline\n\nthree \n four", "a ▁ b", "<|endoftext|> and <s>", "x" * 3000, "the cat the cat the cats", "\n", " ", "naïve café 中文 🙂‍", "tab\tand\r\nreturn"]


def test_every_case(spark):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choices(ODD + [" w", " word", " words"], k=40)) for _ in range(60)]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(8, texts[8], 1, "x")] * 3 + [(None, texts[8], 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, groups string").repartition(3)  # clashing names
    want = [(r[0], *d) for r, d in zip(rows, digests([r[1] for r in rows]))]
    got = [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in alignment.digests(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert alignment.digests(df.where("false")).count() == 0
    for r in alignment.groups(df.where("doc_id != 8")).collect():
        f = plain(texts[r["doc_id"]])
        assert [(g["a"], g["b"]) for g in r["groups"]] == ([(x, y) for x, y in f[2]] if f else [])


def test_pairs_are_counted_over_the_corpus_and_bounded(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS * 5], "text string").repartition(4)
    got = {(r["a_id"], r["b_id"]): r["n"] for r in alignment.pair_counts(df).collect()}
    assert got == Counter(x for t in TEXTS * 5 if (f := plain(t)) for x in f[3])
    assert T.most_pairs() < 700_000
    assert all(T.a_bytes[a].endswith(T.b_bytes[b]) or T.b_bytes[b].endswith(T.a_bytes[a]) for a, b in got)


@pytest.mark.parametrize("most", [3, 40])
def test_forgetting_changes_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "REMEMBERED", most)
    monkeypatch.setattr(alignment.common, "SLICE", 4)
    monkeypatch.setattr(alignment, "_memory", {})
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(12)) for _ in range(40)]
    memory, n = alignment.Memory(T, None), 0
    for t in texts:
        flat, _ = memory.look([t])
        hits = alignment._grown(memory.hits, len(memory))
        hits[flat] += 2
        memory.hits = hits
        n += int(memory.values[0][flat].sum())
        if memory.full():
            memory.renew(memory.hits)
            assert len(memory) <= most // 3
    assert n == sum(len(plain(t)[0]) for t in texts)


def test_the_whole_table(spark):
    from roadglass.llm.queries import op11_tokenizer_alignment

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op11_tokenizer_alignment(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: d for r, d in zip(docs, digests([r["text"] for r in docs]))}


def test_a_vocabulary_of_another_kind_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        alignment.Tokenizers(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model"))
