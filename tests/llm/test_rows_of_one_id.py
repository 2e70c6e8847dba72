"""Decontamination of rows that share an id, with a benchmark of one block and of several."""

import pytest


@pytest.mark.parametrize("words", [4_000_000, 5])
def test_rows_of_one_id_are_judged_apart(spark, words, monkeypatch):
    from lacuna.llm import fm_decontam as D

    monkeypatch.setattr(D, "BLOCK_WORDS", words)
    items = [(i, " ".join(f"item{'abcdefgh'[i]}{w}" for w in "abcdefghijklmnop")) for i in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert (len(D.blocks(bench)) > 1) == (words == 5)
    clean = [(None, "nothing of the kind"), (None, None), (7, "a clean text"), (7, "a clean text"), (8, "another")]
    rows = [*clean, (None, items[0][1]), (7, items[1][1]), (7, items[1][1]), (9, items[2][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row_key string").repartition(2)
    kept = D.clean_documents(df, bench)
    assert kept.columns == df.columns and sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted(clean, key=str)
    judged = D.judged(df, bench)
    assert judged.columns == [c.split()[0] for c in D.SCHEMA.split(", ")] and judged.where("contaminated").count() == 4 and judged.count() == 9
