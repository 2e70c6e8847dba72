"""Chats, vectors, URLs and the pipeline."""

import hashlib
import re

import numpy as np
from pyspark.sql import functions as F


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_chat_round_trip(spark):
    from lacuna.llm import chat_format as C

    odd = "\\### Assistant: </turn> ok\n\\b\\l\\h<#\\\\"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", odd), (1, 1, "assistant", odd), (2, 5, "assistant", "b"), (2, 3, None, None), (2, None, "ro:le\n#", ""), (3, 0, "assistant", "é🙂" * 20_000), (None, 0, "user", "x")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    f = C.format_conversations(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in f.select("conv_id", C.read_back(F.col("formatted")).alias("turns")).collect()}
    assert back == {1: [("user", odd)] + [("assistant", odd)] * 2, 2: [("ro:le\n#", ""), ("", ""), ("assistant", "b")], 3: [("assistant", "é🙂" * 20_000)]}
    d = {r.conv_id: r for r in C.digests(f).collect()}
    assert d[1].loss_sha256 == sha(odd * 2) and d[1].loss_chars == 2 * len(odd) and d[1].turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in back[1]))
    assert C.digests(C.format_conversations(df.limit(0))).count() == 0
    assert "Python" not in f._jdf.queryExecution().toString()


def test_layouts(spark):
    from lacuna.llm import chat_format as C

    texts = ['{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}', '{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}],"id":null}', '{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', '{"response":"b","prompt":"a"}', '{"prompt":"a","completion":"b"}', '{"instruction":"a","input":"","output":"b"}', '{"instruction":"a","input":"x","output":"b"}', '{"other":[1,{"x":2.5}]}']
    df = spark.createDataFrame(list(enumerate(texts)), "layout_no int, t string").select("layout_no", F.parse_json("t").alias("v"))
    got = {r.layout_no: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in C.canonical_turns(df).collect()}
    ab = [("user", "a"), ("assistant", "b")]
    assert [got[i][1] for i in (0, 2, 3, 4, 5)] == [ab] * 5 and got[6][1] == [("user", "a\n\nx"), ("assistant", "b")] and got[1] == got[7] == (None, None)


def test_top_k(spark, monkeypatch):
    from lacuna.llm import topk

    r = np.random.default_rng(2)
    v = np.round(r.normal(0, 0.3, (400, 8)), 2).astype(np.float32)
    v[50:200] = v[50]  # many ties
    rows = [(i, [float(x) for x in v[i]]) for i in range(400)]
    rows += [(400, None), (500, [1.0, None] * 4), (600, [float("nan")] * 8), (700, [float("inf")] * 8), (None, rows[0][1]), (800, [1.0, 2.0]), (801, [1.0, 3.0]), rows[100], (900, [])]
    df = spark.createDataFrame([(i, e, 3) for i, e in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    good = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in e] for i, e in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    whole = [(i, good[i]) for i, e in rows if i in good and e is not None]  # vec_id 100 comes twice
    want = {}
    for q in good:
        if q % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), c) for i, x in whole if i == q for c, y in whole if c != q and len(y) == len(x))[:10]
            want |= {(q, k): (c, -x) for k, (x, c) in enumerate(s, 1)}
    for block in (topk.BLOCK_BYTES, 900):
        monkeypatch.setattr(topk, "BLOCK_BYTES", block)
        got = topk.top_k(df, df.where("vec_id % 100 = 0"))
        assert {(x.query_id, x["rank"]): (x.vec_id, x.score) for x in got.collect()} == want
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    big = np.array([[2.0**40, 3.0]]), np.array([[2.0**21, 1.0], [1.0, 1.0]])
    assert topk.products(*big).tolist() == [[2**61 + 3, 2**40 + 3]]


def url_by_hand(u):
    rest = (u or "").partition("://")[2] if "://" in (u or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


def test_urls(spark):
    from lacuna.llm.url_filter import judged

    urls = [None, "", "no scheme.org/", "http://A.Example.ORG/es/x?y#z", "http://x.org?x", "http://x.org", "http://example.org/en/12", "http://example.org/EN/1", "http://notorg/a", "http://org/a", "https://s.com/fr/", "https://s.com/de/1?a://b", "x://y#/de/", "http://é.com/de/é", "http://t.com/" + "a" * 30_000]
    urls += [f"https://h{i % 7}.example.{t}/{p}/{i}?a={i}" for i in range(300) for t, p in (("com", ("de", "fr")[i % 2]), ("net", "de"), ("net", "fr"))]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)] + [(None, urls[3], "h", "v")] * 2, "page_id long, url string, host string, verdict string")
    got = judged(df).collect()
    assert len(got) == len(urls) + 2
    for x in got:
        host, path, best = url_by_hand(urls[x.page_id] if x.page_id is not None else urls[3])
        assert (x.host, x.path, x.rule) == (host, path, best and best[1]) and x.verdict == (best[0] if best else x.verdict) and x.verdict in ("allow", "block")
    assert judged(df.limit(0)).count() == 0
    assert {x.verdict for x in judged(df.where("url = 'http://x.org'")).collect()} == {"allow"}


def test_url_features():
    import pyarrow as pa

    from lacuna.llm.url_filter import features

    urls = ["", "http://a.b-c.com/x/yyy//z?a=1&b=2#c=d&e", "https://h/é1234?q", "x#?a=b", "http://a.com", "a?b?c=d&"] + ["http://h.com/" + "p" * 9 + "/q"] * 2
    parts = [(re.match(r"[^/?#]*", u.partition("://")[2])[0], re.match(r"[^?#]*", u.partition("://")[2][len(re.match(r"[^/?#]*", u.partition("://")[2])[0]) :])[0]) for u in urls]
    got = features(pa.array(urls), *(pa.array(x) for x in zip(*parts, strict=True)), np.full(len(urls), 0.5), np.arange(len(urls)) * 1.0)
    for i, (u, (h, p)) in enumerate(zip(urls, parts, strict=True)):
        raw = u.encode()
        share = np.array([raw.count(bytes([b])) / len(raw) for b in set(raw)]) if raw else np.zeros(0)
        digits = sum(c.isdigit() for c in u)
        query = u.partition("#")[0].partition("?")[2]
        want = (len(raw), len(h.encode()), len(p.encode()), h.count(".") + bool(h), p.count("/"), digits, digits / max(1, len(raw)), -(share * np.log2(share)).sum(), query.count("=") + query.count("&"), "#" in u, u.count("-"), max(len(x.encode()) for x in p.split("/")), u.startswith("https"), 0.5, np.log1p(i))
        assert np.allclose(got[i], want), u


def test_trees():
    from lacuna.llm.url_filter import Boosted

    r = np.random.default_rng(0)
    x = r.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float)
    p = Boosted().fit(x[:1500], y[:1500]).predict(x[1500:])
    assert np.mean((p >= 0.5) == y[1500:]) > 0.95


def test_pipeline(spark, tmp_path):
    import random

    import corpus_pipeline as P

    r = random.Random(1)
    word = lambda: "".join(r.choice(["ta", "re", "lo", "mi", "nu", "sha"]) for _ in range(r.randint(1, 4)))
    clean = lambda: " ".join(word() for _ in range(40))
    rows = [(i, clean() if i % 4 else clean() + " " + r.choice(["idiot", "clown"]) + " " + word(), "en", "s", 0) for i in range(240)]
    item = " ".join(word() for _ in range(20))
    copy = clean() + " mail a@b.cd end"
    rows += [(300, copy, "en", "s", 0), (301, copy + " more", "en", "s", 0), (302, clean()[:50] + " " + item, "en", "s", 0), (303, None, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {x.doc_id: x.text for x in P.run(spark, str(tmp_path)).collect()}
    assert 300 in got and 301 not in got and 302 not in got and 303 in got and "<EMAIL>" in got[300]
    assert not any(i % 4 == 0 for i in got if i < 240) and sum(i % 4 != 0 for i in got if i < 240) == 180
    assert 4 <= len(P.STAGES) <= 5 and P.ORACLE_SQL is None
