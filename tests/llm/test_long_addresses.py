"""Addresses with very many leading zeros, which int() alone refuses."""


def test_leading_zeros_end_no_task(spark):
    from lacuna.llm import pii

    texts = ["0" * 5000 + "1.2.3.4", "0" * 5000 + ".0.0." + "0" * 5000, "1.2.3." + "0" * 5000 + "256", "1.2.3." + "9" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [x.n_ip for x in pii.span_digests(df).orderBy("doc_id").collect()] == [1, 1, 0, 0]
    assert [x.text for x in pii.mask_documents(df).orderBy("doc_id").collect()][0] == "<IP>"
