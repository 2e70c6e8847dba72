"""Training leaves its texts and its memory to a task; the driver gets the machine."""

import os
import random

import numpy as np


def test_toxicity_is_trained_by_a_task(spark, monkeypatch):
    from lacuna.llm import text
    from lacuna.llm import toxicity_ssk as T

    r = random.Random(3)
    word = lambda: "".join(r.choice(["ta", "re", "lo", "mi", "nu", "sha"]) for _ in range(r.randint(1, 4)))
    rows = [(i, " ".join([word() for _ in range(20)] + ["idiot"] * (i % 4 == 0))) for i in range(300)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    known = labels.where(text.learnable(labels.doc_id)).toPandas()["toxic"].mean()
    here = T.Machine().fit(*text.labelled_sample(docs, labels, "toxic", T.PER_CLASS, T.drawn), known)

    driver, separate = os.getpid(), T.Machine.separate

    def in_a_task(self, *sample):
        assert os.getpid() != driver, "trained on the driver"
        separate(self, *sample)

    with monkeypatch.context() as m:
        m.setattr(T.Machine, "separate", in_a_task)
        there = T.trained(docs, labels)
        none = T.trained(docs, labels.limit(0)), T.trained(docs.limit(0), labels), T.trained(docs, labels.where("toxic = 1"))
    # sums may differ in their last bits: a task's library has one thread
    assert there.constant is None and np.allclose(there.weights, here.weights, atol=1e-4) and np.allclose([there.bias, *there.curve], [here.bias, *here.curve], atol=1e-3)
    assert [x.constant for x in none] == [0.0, 0.0, 1.0]
