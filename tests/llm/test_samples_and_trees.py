import itertools
import os

import numpy as np

from lacuna.llm import url_filter
from lacuna.llm.text import drop, labelled_sample, stored


def test_repeated_ids_do_not_add_to_a_sample(spark):
    docs = [(1, f"text {i % 300}") for i in range(2000)] + [(2, "b"), (3, None), (4, "d"), (5, "e")]
    labels = [(1, 1), (2, 0), (3, 0), (4, 1), (4, 0), (5, 3), (None, 1)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    texts, y = labelled_sample(*frames, "quality", 50, lambda t: t)
    assert (y == 1).sum() == 50 and len(set(texts)) == len(texts) - ("d" in texts) * (texts.count("d") - 1)
    again, _ = labelled_sample(frames[0].repartition(3), frames[1], "quality", 50, lambda t: t)
    assert again == texts
    few, y = labelled_sample(frames[0].where("doc_id > 1"), frames[1], "quality", 50, lambda t: t)
    learnable = {t: n for t, n in (("b", 2), ("", 3), ("d", 4)) if t in few}
    assert set(few) == set(learnable) and few.count("d") in (0, 2)


def exhaustive(x, g, h, depth, least, rows=None):
    """Every split of every feature at every bin, by sums over its rows."""
    rows = list(range(len(g))) if rows is None else rows
    score = lambda r: sum(g[i] for i in r) ** 2 / (sum(h[i] for i in r) + 1)
    best, split = 1e-6, None
    if depth and len(rows) >= 2 * least:
        for c, cut in itertools.product(range(x.shape[1]), range(int(x.max()) + 1)):
            left, right = [i for i in rows if x[i, c] <= cut], [i for i in rows if x[i, c] > cut]
            if min(len(left), len(right)) >= least and (gain := score(left) + score(right) - score(rows)) > best + 1e-9:
                best, split = gain, (left, right)
    if split is None:
        value = sum(g[i] for i in rows) / (sum(h[i] for i in rows) + 1)
        return dict.fromkeys(rows, value)
    return exhaustive(x, g, h, depth - 1, least, split[0]) | exhaustive(x, g, h, depth - 1, least, split[1])


def test_trees_take_the_best_of_all_splits():
    r = np.random.default_rng(4)
    for _ in range(6):
        x = r.integers(0, 6, (80, 4))
        g, h = r.normal(0, 1, 80) + (x[:, 1] > 2) - (x[:, 3] == 1), r.random(80) * 0.25
        model = url_filter.Boosted(depth=3, bins=8, least=5)
        want = exhaustive(x, g, h, 3, 5)
        assert np.allclose(model.leaf(model.grow(x, g, h), x), [want[i] for i in range(80)])
    y = (x[:, 1] > 2).astype(float)  # a fit is steps of such trees on the logistic gradient
    model = url_filter.Boosted(trees=4, depth=2, bins=8, least=5).fit(x.astype(float), y)
    f, binned = np.full(80, np.log(y.mean() / (1 - y.mean()))), model.binned(x.astype(float))
    for _ in range(4):
        p = 1 / (1 + np.exp(-f))
        step = exhaustive(binned, y - p, p * (1 - p), 2, 5)
        f += 0.2 * np.array([step[i] for i in range(80)])
    assert np.allclose(model.predict(x.astype(float)), 1 / (1 + np.exp(-f)))


def test_suffix_rates_leave_the_row_itself_out(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(url_filter.Boosted, "fit", lambda self, x, y: (seen.append((x, y)), setattr(self, "base", 0.0), setattr(self, "forest", []), setattr(self, "cuts", []), self)[-1])
    urls = ["http://a.org/x", "http://b.org/y", "http://example.org/es/", "http://c.com/fr/"]
    url_filter.judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    x, y = seen[0]
    rate, count = (x[:, url_filter.FEATURES.index(n)] for n in ("suffix rate", "suffix count"))
    assert sorted(zip(y, np.round(rate, 6), np.round(np.expm1(count)), strict=True)) == [(0, 0.5, 0), (0, 0.5, 2), (0, 0.5, 2), (1, 0.25, 2)]


def test_a_stored_table_goes_and_others_stay(spark, tmp_path):
    table = stored(spark.range(5))
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
    assert os.path.isdir(folder)
    spark.range(3).write.parquet(str(tmp_path / "mine"))
    for df in (table, spark.read.parquet(str(tmp_path / "mine")), spark.range(2)):
        drop(df)
    assert not os.path.isdir(folder) and spark.read.parquet(str(tmp_path / "mine")).count() == 3
