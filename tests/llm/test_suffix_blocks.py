"""Repeated strings at the production length: passages in many contexts, very long texts, and every way that windows are dealt out."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.test_text_operators import docs_of, rows_of, suffix_by_hand


def contexts(n, r):
    """One passage within n different surroundings; some surroundings come twice, and some only just reach the length."""
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    passage = " ".join(word() for _ in range(60))[:300]
    long = " ".join(word() for _ in range(150))
    rows = []
    for i in range(n):
        own = long if i % 5 == 0 else " ".join(word() for _ in range(40))
        rows.append((i, own[-r.randint(60, 110) :] + passage + own[: r.randint(60, 110)]))
    edge = " ".join(word() for _ in range(120))[:396]
    return rows + [(1000 + i, word() + "<" + "xyz"[i % 3] + edge + "pq"[i % 2] + ">" + word()) for i in range(n)]


@pytest.mark.parametrize("most", [1500, 12, 2])
def test_passages_in_many_contexts(spark, most):
    from lacuna.llm.suffix_dedup import removals

    rows = contexts(45, random.Random(7))
    want = suffix_by_hand(rows, 400)
    assert sum(w[2] > 0 for w in want) > 40
    assert rows_of(removals(docs_of(spark, rows), most=most)) == want


def test_solved_stretches_are_one_row_each(spark):
    from lacuna.llm import suffix_dedup as S

    own = S.keyed(docs_of(spark, contexts(60, random.Random(3))))
    pieces = S.found_stretches(own, 400, 64)
    anchors = pieces.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
    texts = pieces.join(anchors, "a", "left_semi").groupBy(*S.KEY).agg(F.sum("times").alias("times"), F.min(F.struct("k1", "k2", "start", "n", "place")).alias("r")).select(*S.KEY, "times", "r.*")
    solved = S.dealt_out(S.stored(S.cut(own, texts, 400)), 400, 4)
    assert 0 < solved.count() == solved.select(*S.KEY).distinct().count()


def test_long_texts_in_parts(spark, monkeypatch):
    from lacuna.llm import suffix_dedup as S

    r = random.Random(5)
    noise = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passage = noise(900)
    rows = [(1, noise(5000) + passage + noise(3000) + passage[100:]), (2, passage), (3, noise(40_000)), (4, "z" * 9000), (5, noise(10) + "ab" * 3000)]
    monkeypatch.setattr(S, "PART", 1000)
    assert rows_of(S.removals(docs_of(spark, rows))) == suffix_by_hand(rows, 400)
