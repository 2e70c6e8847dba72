"""Words and texts that a polynomial hash modulo 2**64 takes for equal are told apart."""

import numpy as np

PAIR = ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(2048)) for k in (0, 1)]  # Thue-Morse and its complement


def test_near_copies_of_like_sequences(spark):
    from lacuna.llm import prob_minhash as M

    rows = [(i, sep.join(p)) for i, (p, sep) in enumerate((p, sep) for sep in (" ", "") for p in PAIR)] + [(9, PAIR[0] + " ")]
    got = dict(M.classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id").collect())
    assert got[2] == 2 and got[3] == 3 and got[9] == 2
    assert len({tuple(w) for w in (PAIR[0][i : i + 5] for i in range(2044))}) < 30  # so few shingles that both rows of letters have the same
    assert got[0] == got[1] == 0


def test_nodes_of_the_two_rows_differ():
    import pyarrow as pa

    from lacuna.llm.prob_minhash import nodes_of
    from lacuna.llm.text import Words, flat_bytes

    texts = pa.array([" ".join(p) for p in PAIR] + ["", "!", None])
    name, other = nodes_of(Words(*flat_bytes(texts)), texts)
    assert len(set(name.tolist())) == 4 == len(set(other.tolist())) and name[2] == name[4]


def test_nodes_of_one_name_are_told_apart(spark, monkeypatch):
    from lacuna.llm import prob_minhash as M

    real = M.nodes_of
    monkeypatch.setattr(M, "nodes_of", lambda words, texts: (real(words, texts)[0] % np.uint64(3), real(words, texts)[1]))
    rows = [(i, f"text number {i // 2} of its own kind w{i // 2} x{i // 2} y{i // 2}") for i in range(40)] + [(90, None), (91, "")]
    got = sorted((r.doc_id, r.class_id) for r in M.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(i, i // 2 * 2) for i in range(40)] + [(90, 90), (91, 90)]


def test_decontamination_of_like_words(spark):
    from lacuna.llm import fm_decontam as D

    docs = spark.createDataFrame([(0, PAIR[0]), (1, PAIR[1])], "doc_id long, text string")
    bench = spark.createDataFrame([(0, PAIR[0])], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in D.judged(docs, bench).collect()} == {0: 1, 1: 0}


def test_rows_that_differ_elsewhere_keep_the_smallest(spark):
    from lacuna.llm import prob_minhash as M

    rows = [(1, "a b c d e f", "z", 3), (1, "a b c d e f", "b", 9), (1, "a b c d e f", "b", 7), (2, "A b c d e f", "a", 1), (None, None, "q", 2), (3, "other words at all here now", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lacuna_k1 string, lacuna_k2 int").repartition(3)
    kept = M.first_of_each(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([rows[2], rows[4], rows[5]], key=str)
