import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lacuna.llm import importance
from lacuna.llm.text import flat_bytes

NAMES = ["doc_id", "n_features", "weight", "score", "rank"]


def words_of(text):
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]


def runs(text, longest=2):
    w = words_of(text)
    return [b" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, percent=25, least=20, buckets=10000):
    s, t = (Counter(zlib.crc32(f) % buckets for x in texts for f in runs(x)) for texts in ([x for _, x in docs], target))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    rows = []
    for doc_id, text in docs:
        found = [gain(zlib.crc32(f) % buckets) for f in runs(text)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    drawn = [(*r[:4], n + 1) for n, r in enumerate(able[: percent * len(able) // 100])]
    rest = able[percent * len(able) // 100 :] + [r for r in rows if r[4] < least]
    return sorted(drawn + [(*r[:4], None) for r in rest], key=str)


def rows_of(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, weight string, score int, slice int")


def corpus():
    rng = np.random.default_rng(3)
    some = ["Alpha", "beta", "gamma", "dé", "x1", "zeta"]
    docs = [(i, " ".join(rng.choice(some, rng.integers(0, 60)))) for i in range(300)]
    return docs + [(1000, None), (1001, ""), (1002, "a" * 300 + " b " + "C" * 256 + " " + "e" * 255 + " f" * 20), (None, "alpha " * 30), (5, "beta " * 25), (5, "beta " * 25), (5, "gamma beta " * 25), (2**62, "alpha, beta! " * 2000)]


@pytest.mark.parametrize("crowd", [1 << 20, 1])
def test_equals_a_plain_draw(spark, crowd):
    docs, target = corpus(), ["alpha beta alpha", "alpha " * 40, None]
    got = importance.resampled(rows_of(spark, docs).repartition(3, "doc_id"), spark.createDataFrame([(t,) for t in target], "text string"), crowd=crowd)
    assert got.columns == NAMES and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, target)


def test_scores_with_many_rows_go_by_slices(spark):
    """Rows of few scores, so that slices and copies count."""
    rows = [(i // 3, 50, 60 + i % 2, i % 5 // 2) for i in range(30_000)] + [(77, 50, 60, 2)] * 10_000
    table = spark.createDataFrame([(d, n, f, 0, s) for d, n, f, s in rows], "doc_id long, n_words long, n_features long, weight long, score long")
    want = [(d, f, 0, s) for d, _, f, s in sorted(rows, key=lambda r: (-r[3], r[0], r[2]))]
    for percent in (25, 60, 100):
        got = importance.drawn(table, percent, 20, 500)
        ranked = sorted((tuple(r) for r in got.where("rank IS NOT NULL").collect()), key=lambda r: r[4])
        n = percent * len(rows) // 100
        assert [r[4] for r in ranked] == list(range(1, n + 1)) and [r[:4] for r in ranked] == want[:n]
        assert got.count() == len(rows)


def test_small_inputs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resampled(empty, empty).collect() == []
    one = importance.resampled(rows_of(spark, [(1, "a " * 30)]), empty).collect()
    assert [r["rank"] for r in one] == [None]
    assert [r["rank"] for r in importance.resampled(rows_of(spark, [(1, "a " * 30)]), empty, percent=100).collect()] == [1]


def test_sums_are_crc32():
    texts = ["Hello World foo", "", "a" * 300 + " b " + "C" * 256 + " dé " + "e" * 255 + " f", "one", None, " x  y1\x00z "]
    flat, offsets = flat_bytes(pa.array(texts))
    for n, (sums, doc) in enumerate(importance.feature_sums(flat, offsets, 4)):
        assert sorted(zip(doc.tolist(), sums.tolist(), strict=True)) == sorted((i, zlib.crc32(f)) for i, t in enumerate(texts) for f in runs(t, n + 1) if f.count(b" ") == n)
