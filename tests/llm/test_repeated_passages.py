"""Near copies whose passages are repeated unequally often."""

import random
import re

WORD = re.compile(r"[a-z]+")


def shingle_set(t):
    w = WORD.findall(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_repeats_keep_no_near_copies_apart(spark):
    from lacuna.llm import prob_minhash as M

    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = []
    for n in range(60):
        often, once, tail = ([word() for _ in range(k)] for k in (45, 45, 6))
        rows += [(2 * n, " ".join(often * r.choice([10, 50, 200]) + once)), (2 * n + 1, " ".join(often + once + tail))]
    want = []
    for (i, a), (j, b) in zip(rows[::2], rows[1::2], strict=True):
        x, y = shingle_set(a), shingle_set(b)
        assert 0.8 <= len(x & y) / len(x | y) < 0.95
        want += [(i, i), (j, i)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((x.doc_id, x.class_id) for x in M.classes(df).collect()) == want
