"""Decontamination against all alignments, and phrases that very many items share."""

import random
import resource

from pyspark.sql import functions as F

from roadglass.llm import decontaminate

DOCS, BENCH = "doc_id long, text string", "item_id long, text string"


def plain(docs, items, seeded, least=10):
    """Best stretch of every document and item over all alignments; ``seeded``: only those that a mask can see."""
    split = lambda t: [w for w in (decontaminate._NOISE.sub("", x.lower()) for x in (t or "").split()) if w]
    distinct = {}
    for i, t in sorted(items):
        if len(split(t)) >= 8:
            distinct.setdefault(tuple(split(t)), i)
    out = set()
    for doc, text in docs:
        d = split(text)
        for own, i in distinct.items():
            found = (0, 0, 0)
            for start in range(-len(own) + 1, len(d)):
                a, b = max(0, start), min(len(d), start + len(own))
                same = [d[k] == own[k - start] for k in range(a, b)]
                masks = decontaminate.MASKS if len(own) >= 10 else ("1" * len(own),)
                if seeded and not any(all(same[j + k] for k, c in enumerate(m) if c == "1") for m in masks for j in range(len(same) - len(m) + 1)):
                    continue
                best, span = 0, None
                for j in range(len(same)):
                    total = 0
                    for k in range(j, len(same)):
                        total += 1 if same[k] else -3
                        if total > best or total == best and span and (k < span[1] or k == span[1] and j > span[0]):
                            best, span = total, (j, k)
                if span:
                    n, matching = span[1] - span[0] + 1, sum(same[span[0] : span[1] + 1])
                    if matching >= min(least, len(own)) and 5 * matching >= 4 * n:
                        found = max(found, (matching, n, a + span[0]))
            if found[0]:
                out.add((doc, i, *found))
    return out


def tables(rng):
    vocabulary = [f"t{i}" for i in range(30)]
    words = lambda n: rng.choices(vocabulary + [f"r{rng.randrange(10**6)}" for _ in range(40)], k=n)
    items = [(i, " ".join(words(n))) for i, n in enumerate((5, 8, 9, 10, 11, 12, 13, 20, 25, 40))] + [(20, None), (21, "")]
    items += [(22, items[7][1].upper() + " !")]
    docs = [(100, None), (101, ""), (102, " ".join(words(30)))]
    for i, t in items[:10]:
        for changes in (0, 1, 2, 4):
            own = t.split()
            for k in rng.sample(range(len(own)), min(changes, len(own))):
                own[k] = f"new{rng.randrange(10**6)}"
            docs.append((1000 * (i + 1) + changes, " ".join(words(rng.randint(0, 12)) + own + words(rng.randint(0, 12)))))
    fifth = items[9][1].split()
    fifth[2::5] = ["x"] * len(fifth[2::5])
    docs += [(200, " ".join(fifth)), (201, items[8][1] + " " + items[8][1]), docs[5], (None, items[8][1])]
    return docs, items


def test_against_all_alignments(spark, monkeypatch):
    rng = random.Random(41)
    missed = total = 0
    for round_ in range(3):
        docs, items = tables(rng)
        frame, bench = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit("x")).repartition(3), spark.createDataFrame(items, BENCH).withColumn("doc_id", F.lit(1))
        want = plain(docs, items, True)
        with monkeypatch.context() as m:
            if round_:
                m.setattr(decontaminate, "HITS", 7)
                m.setattr(decontaminate, "COMPARED", 60)
            index = None
            for block in decontaminate.item_blocks(bench):
                index = decontaminate.Index(*block, 10)
            here = {(docs[k][0], int(index.ids[i]), *r) for k, hits in index.search([t for _, t in docs]) for i, r in hits.items()}
        got = {tuple(r) for r in decontaminate.contaminated(frame, bench).collect()}
        assert got == here == want
        assert {tuple(r) for r in decontaminate.contaminated(frame, bench, block_tokens=60).collect()} == want
        every = {x[:2] for x in plain(docs, items, False)}
        missed, total = missed + len(every - {x[:2] for x in want}), total + len(every)
        assert any(x[:2] == (200, 9) for x in want)  # every fifth token replaced
    assert missed <= 0.05 * total


def test_results_do_not_depend_on_neighbours():
    rng = random.Random(42)
    docs, items = tables(rng)
    index = decontaminate.Index(*block_of(items), 10)
    alone = {(k, tuple(sorted(hits.items()))) for k, (_, t) in enumerate(docs) for _, hits in index.search([t])}
    assert {(k, tuple(sorted(hits.items()))) for k, hits in index.search([t for _, t in docs])} == alone


def block_of(items):
    import numpy as np

    each = [(i, decontaminate.tokens(t)) for i, t in items if t and len(decontaminate.tokens(t)) >= 8]
    return np.array([i for i, _ in each]), np.cumsum([len(h) for _, h in each]), np.concatenate([h for _, h in each])


def test_a_phrase_in_very_many_items_and_documents(spark):
    """Each of 1000 documents overlaps each of 5000 items; memory is bounded by the pieces."""
    phrase = " ".join(f"stock{i}" for i in range(12))
    bench = spark.range(5000).select(F.col("id").alias("item_id"), F.concat(F.lit(phrase), F.lit(" item"), "id", F.lit(" some"), "id", F.lit(" more"), "id").alias("text"))
    docs = spark.range(1000, numPartitions=8).select(F.col("id").alias("doc_id"), F.concat(F.lit("before"), "id", F.lit(" "), F.lit(phrase), F.lit(" after"), "id").alias("text"))
    found = decontaminate.contaminated(docs, bench)
    got = found.groupBy("n_matching", "n_tokens", "first_token").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs"), F.countDistinct("item_id").alias("items")).collect()
    assert [tuple(r) for r in got] == [(12, 12, 1, 5_000_000, 1000, 5000)]
    assert decontaminate.clean(docs.limit(20), bench).count() == 0
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    index = decontaminate.Index(*block_of([(r["item_id"], r["text"]) for r in bench.collect()]), 10)
    rows = [r["text"] for r in docs.limit(64).collect()]
    assert sum(len(hits) for _, hits in index.search(rows)) == 64 * 5000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # KB


def test_a_very_long_text(spark):
    rng = random.Random(43)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(30))
    filler = " ".join(f"w{i % 5000}" for i in range(200_000))
    docs = spark.createDataFrame([(1, f"{filler} {passage} {filler}"), (2, filler)], DOCS)
    got = decontaminate.contaminated(docs, spark.createDataFrame([(7, passage)], BENCH)).collect()
    assert [tuple(r) for r in got] == [(1, 7, 30, 30, 200_000)]
