"""Top-k where one vec_id has many rows, in a tile, in a task and across tasks."""

import numpy as np
import pytest


@pytest.mark.parametrize("tile", [4096, 7])
@pytest.mark.parametrize("partitions", [1, 5])
def test_each_row_of_one_id_counts(spark, partitions, tile, monkeypatch):
    from lacuna.llm import topk

    monkeypatch.setattr(topk, "TILE", tile)
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.integers(-8, 8, 4) / 16]) for i in range(60)]
    best = [2.0 * x for x in rows[0][1]]
    rows += [(70, best)] * 20  # the highest of query 0, more often than there are places
    rows += [(71, [x / 2 for x in best]), (71, [-x for x in best])] * 12  # one id, two vectors
    rows += [rows[0]] * 2 + [rows[40]] * 20 + [(20, [float(x) for x in r.integers(-8, 8, 4) / 16])]  # a query's own rows; a query of two vectors
    want = []
    for q in (0, 20, 40):
        pairs = [(-sum(int(np.floor(1024 * u)) * int(np.floor(1024 * v)) for u, v in zip(x, y, strict=True)), c) for a, x in rows if a == q for c, y in rows if c != q]
        want += [(q, k, c, -s) for k, (s, c) in enumerate(sorted(pairs)[:10], 1)]
    order = r.permutation(len(rows)).tolist()
    df = spark.createDataFrame(spark.sparkContext.parallelize([rows[i] for i in order], partitions), "vec_id long, embedding array<float>")
    got = topk.top_k(df, df.where("vec_id % 20 = 0 AND vec_id < 60"))
    assert sorted(map(tuple, got.collect())) == want and [w[2] for w in want[:10]] == [70] * 10


def test_products_of_all_sizes():
    from lacuna.llm.topk import NONE, products

    r = np.random.default_rng(1)
    q, c = np.floor(r.normal(0, 2.0 ** r.integers(0, 45, (9, 1)), (9, 5))), np.floor(r.normal(0, 2.0 ** r.integers(0, 45, (11, 1)), (11, 5)))
    for a, b in ((q, c), (q[:3] % 1000, c[:3] % 1000), (q % 2**28, c % 2**28)):
        want = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
        assert products(a, b).tolist() == [[x if abs(x) < 2**63 else int(NONE) for x in row] for row in want]
    assert any(abs(sum(int(x) * int(y) for x, y in zip(u, v, strict=True))) >= 2**63 for u in q for v in c)


def test_chosen_places():
    from lacuna.llm.topk import NONE, chosen

    r = np.random.default_rng(2)
    for scale in (3, 2**55):
        s = r.integers(-3, 4, (40, 60)) * scale
        s[r.random(s.shape) < 0.2] = NONE
        for row, got in zip(s, chosen(s, 7), strict=True):
            assert sorted(got.tolist()) == sorted(sorted(range(60), key=lambda i: (-int(row[i]), i))[:7])
