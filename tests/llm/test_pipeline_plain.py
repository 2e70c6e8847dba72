"""The pipeline's rows against a plain version of its stages, with null, empty and long texts, copies and repeated rows."""

import random

from tests.llm.test_text_operators import LOW, WORD, shingle_set


def test_pipeline_against_a_plain_version(spark, tmp_path):
    import public_tokenizers
    import tiktoken

    import corpus_pipeline as P
    from lacuna.llm import pii
    from lacuna.llm import toxicity_ssk as T
    from lacuna.llm.bpe_replay import read_ranks

    r = random.Random(11)
    word = lambda: "".join(r.choice(["ta", "re", "lo", "mi", "nu", "sha", "é"]) for _ in range(r.randint(1, 4)))
    clean = lambda n=40: " ".join(word() for _ in range(n))
    items = [" ".join(word() for _ in range(20)) for _ in range(3)] + ["three odd words", None]
    rows = [(i, clean() if i % 4 else f"{clean()} {r.choice(['idiot', 'clown'])} {word()}") for i in range(200)]
    base = clean(60).split()
    for i in range(200, 230):  # near copies of one text, some further away than others
        own = list(base)
        for _ in range(r.randint(0, 4)):
            own[r.randrange(60)] = word()
        rows.append((i, " ".join(own)))
    rows += [(300, None), (301, ""), (302, None), (303, "!!"), (303, "!!"), (None, "no id " + clean(30)), (None, "no id either " + clean(30))]
    rows += [(310, clean(8000) + " call +1 (555) 555-1234"), (311, clean(30) + " " + items[0]), (312, clean(500) + " " + items[1]), (313, "three odd words"), (314, "mail a.b@c.de 10.0.0.1 " + clean(20))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(str(i), t) for i, t in enumerate(items)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet")
    p = T.Scorer(T.trained(read("documents"), read("labels")))([t or "" for _, t in rows])
    docs = [x for x, q in zip(rows, p, strict=True) if q < T.PREDICT]
    assert not any(i is not None and i < 200 and i % 4 == 0 for i, _ in docs) and len(docs) >= len(rows) - 52
    sets = [shingle_set(t) for _, t in docs]
    kept = []  # one of each class: classes by links, then the smallest id
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (not sets[i] and not sets[j] and (docs[i][1] or "") == (docs[j][1] or "")) or (both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both)):
                parent[root(i)] = root(j)
    for k in {root(i) for i in range(len(docs))}:
        group = [docs[i] for i in range(len(docs)) if root(i) == k]
        kept.append(min(group, key=lambda x: (x[0] is None, x[0] or 0)))
    windows = {tuple(w[k : k + min(13, len(w))]) for t in items if t for w in [WORD.findall(t.translate(LOW))] for k in range(len(w) - min(13, len(w)) + 1)}
    want = []
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for i, t in kept:
        w, hit = WORD.findall((t or "").translate(LOW)), set()
        for g in windows:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
        if not hit or 20 * len(hit) < len(w):
            masked = pii.mask(t or "")
            want.append((i, library.encode_ordinary(masked), masked))
    got = [(x.doc_id, list(x.token_ids), x.text) for x in P.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ids = {i for i, _, _ in got}
    assert {300, 303, 310, 312, 314, None} <= ids and not ids & {302, 311, 313} and sum(200 <= i < 230 for i in ids if i) >= 1
