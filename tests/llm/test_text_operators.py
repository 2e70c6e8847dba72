"""Operators on documents: brute force, round trips, and the defined cases."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, score string, held_out int, n_tokens string"  # extra columns with clashing names
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOC).repartition(2)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


CASES = [(1, None), (2, ""), (3, " "), (4, "a" * 30_000), (5, "Hello the world, it's 12345\n\n  ok"), (5, "Hello the world, it's 12345\n\n  ok"), (None, "no id é漢字 🙂"), (7, "mail a.b@c.de and 10.0.0.1 +1 (555) 555-1234 or 4111 1111 1111 1111")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_like_the_library(spark, tokenizer):
    import tiktoken

    from lacuna.llm.bpe_replay import encode_documents, read_ranks, token_digests

    ranks = read_ranks(tokenizer[0])
    library = tiktoken.Encoding("own", pat_str=tokenizer[1], mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    more = [(100 + i, "".join(r.choice("abAB the in'  \n!é1aaa") for _ in range(r.randint(1, 400)))) for i in range(60)]
    df = docs_of(spark, CASES + more)
    want = []
    for i, t in CASES + more:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t or "")))
    assert rows_of(token_digests(df, *tokenizer)) == sorted(want, key=str)
    assert {(r.doc_id, r.text) for r in encode_documents(df, *tokenizer).collect()} == {(i, t or "") for i, t in CASES + more}
    assert token_digests(df.limit(0), *tokenizer).count() == 0


def test_bpe_forms_agree(tokenizer):
    from lacuna.llm.bpe_replay import Ranks, read_ranks, replay, replay_long

    ranks = read_ranks(tokenizer[0])
    r = random.Random(5)
    pieces = ["".join(r.choice("abcthein aaé") for _ in range(r.randint(1, 60))).encode() for _ in range(300)]
    ids, counts = replay(pieces, Ranks(ranks))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == replay_long(pieces, ranks)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_by_hand(t):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii(spark):
    from lacuna.llm import pii

    r = random.Random(2)
    more = [(100 + i, "".join(r.choice("ab@.-1 +()27") for _ in range(200))) for i in range(300)] + [(99, "iban GB82 WEST 1234 5698 7654 32, ssn 123-45-6789, call 555-123-4567, then some words of no meaning at all, number 123-45-6788 no DE00 1234 1234 1234 1234 12")]
    df = docs_of(spark, CASES + more)
    got = {(x.doc_id, x.base_sha256): x for x in pii.span_digests(df).collect()}
    for i, t in CASES + more:
        base = base_by_hand(t or "")
        x = got[i, sha(",".join(base))]
        assert x.spans.startswith(",".join(base)) and x.n_email + x.n_ip + x.n_card + x.n_phone == len(base)
    kinds = [s.split(":")[0] for s in pii.joined(pii.all_spans(more[-1][1])).split(",")]
    assert kinds == ["iban", "ssn", "phone_local"]
    secret = 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" and hash 9233a8ecf7c5b09fe5949719b6b82bc439e9329b' + " " * 50 + "secret aaaaaaaaaaaaaaaaaaaaaaaa1"
    assert pii.all_spans(secret) == [("secret", 9, 49)]
    masked = {x.doc_id: x.text for x in pii.mask_documents(df).where("doc_id in (1, 7)").collect()}
    assert masked == {1: None, 7: "mail <EMAIL> and <IP> <PHONE> or <CARD>"}
    assert pii.span_digests(df.limit(0)).count() == 0
    assert not pii.all_spans("9" * 200_000 + "@")  # long runs end in time
    began = time.time()
    assert len(pii.all_spans("call 555-123-4567, +1 (555) 555-1234; " * 20_000)) == 40_000 and time.time() - began < 20


def suffix_by_hand(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [1500, 1])  # by sorting, and by counting digests
def test_repeated_strings(spark, most):
    from lacuna.llm.suffix_dedup import removals

    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    long = [" ".join(word() for _ in range(60)) for _ in range(4)]
    rows = [(i, " ".join([word(), r.choice(long)[: r.randint(50, 300)], word(), r.choice(long)[r.randint(0, 60) :]])) for i in range(25)]
    rows += [(50, long[0]), (50, long[0]), (None, long[1]), (51, None), (52, ""), (53, "x" * 500), (54, "ab" * 300), (55, "line one two\n" * 40)]
    got = rows_of(removals(docs_of(spark, rows), length=60, gram=16, most=most))
    assert got == suffix_by_hand(rows, 60)
    assert removals(docs_of(spark, rows).limit(0), length=60, gram=16).count() == 0


def shingle_set(t):
    w = WORD.findall((t or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)]) if w else frozenset()


def near_rows():
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows, n = [], 0
    for size in (5, 40, 120):
        for group in (1, 3, 12):
            base = [word() for _ in range(size)]
            for _ in range(group):
                own = list(base)
                for _ in range(r.randint(0, max(1, size // 30))):
                    own[r.randrange(size)] = word()
                rows.append((n, " ".join(own)))
                n += 1
    hot = [word() for _ in range(100)]
    for _ in range(70):  # many near copies, some of them too far from the others
        own = list(hot)
        for _ in range(r.randint(0, 6)):
            own[r.randrange(100)] = word()
        rows.append((n, " ".join(own)))
        n += 1
    return [*rows, (900, None), (901, ""), (902, "!!"), (903, "one two"), (904, "One,  TWO"), (905, hot and " ".join(hot)), (905, " ".join(hot)), (None, "no id here at all you see"), (None, "no id here at all you see")]


@pytest.mark.parametrize("large,other", [(48, {}), (4, {}), (4, {"FAN": 3, "RARE": 2, "DEALT": 3})])
def test_near_copies(spark, large, other, monkeypatch):
    from lacuna.llm import prob_minhash as M

    for name, value in ({"LARGE": large} | other).items():
        monkeypatch.setattr(M, name, value)
    rows = near_rows()
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = not sets[i] and not sets[j] and (rows[i][1] or "") == (rows[j][1] or "")
            if same or both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    want = [(rows[i][0], min((rows[k][0] for k in g if rows[k][0] is not None), default=None)) for g in groups.values() for i in g]
    df = docs_of(spark, rows)
    assert rows_of(M.classes(df).select("doc_id", "class_id")) == sorted(want, key=str)
    if large == 48:
        kept = M.first_of_each(df)
        assert kept.columns == df.columns and kept.count() == len(groups)
        assert M.classes(df.limit(0)).count() == 0


def test_signatures_estimate_probability_jaccard():
    from lacuna.llm.prob_minhash import signatures

    r = np.random.default_rng(0)
    element = r.integers(1, 2**62, 40).astype(np.uint64)
    w = np.stack([r.uniform(0.2, 3, 40) * (r.random(40) < 0.8), r.uniform(0.2, 3, 40) * (r.random(40) < 0.8)])
    doc, at = np.nonzero(w)
    s = signatures(doc, element[at], w[doc, at], 2, 4000)
    x, y = w
    want = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(40) if x[i] and y[i])
    assert abs((s[0] == s[1]).mean() - want) < 0.03


def test_decontamination(spark, monkeypatch):
    from lacuna.llm import fm_decontam as D

    r = random.Random(8)
    word = lambda: "".join(r.choice("abcé") for _ in range(2))
    items = [(i, " ".join(word() for _ in range(r.choice([3, 13, 20, 40])))) for i in range(12)] + [(12, None), (13, "..."), (13, "zz yy"), (None, "qq ww ee")]
    text = lambda: ", ".join(r.choice([word(), r.choice(items)[1] or "x", " ".join((r.choice(items)[1] or "x y").split()[1:9])]) for _ in range(r.randint(0, 12)))
    rows = [(i, text()) for i in range(60)] + [(60, None), (61, ""), (61, ""), (None, items[1][1]), (62, "ab " * 3000)]
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    split = lambda t: WORD.findall((t or "").translate(LOW))
    windows = {}
    for i, t in items:
        w = split(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).update([str(i)] if i is not None else [])
    want = []
    for i, t in rows:
        w = split(t)
        hit, found = [False] * len(w), set()
        for g, names in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit[k : k + len(g)] = [True] * len(g)
                    found |= names
        want.append((i, len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit) and 20 * sum(hit) >= len(w)))
    df = docs_of(spark, rows)
    assert rows_of(D.judged(df, bench)) == sorted(want, key=str)
    kept = D.clean_documents(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(not w[-1] for w in want)
    assert rows_of(D.judged(df, bench.limit(0)).select("n_hit").distinct()) == [(0,)] and D.judged(df.limit(0), bench).count() == 0
    monkeypatch.setattr(D, "SHARD_BYTES", 1)  # an index for each batch
    monkeypatch.setattr(D, "PIECE_WORDS", 7)  # items in several pieces
    assert rows_of(D.judged(df, bench)) == sorted(want, key=str)
    monkeypatch.setattr(D, "BLOCK_WORDS", 40)  # a benchmark of several blocks
    assert len(D.blocks(bench)) > 1 and rows_of(D.judged(df, bench)) == sorted(want, key=str)
    assert D.clean_documents(df, bench).count() == kept.count()


def test_quality(spark):
    from lacuna.llm import quality_cnn as Q

    r = random.Random(1)
    good = lambda: " ".join(r.choice(["the", "tion", "here", "and", "ander", "is"]) for _ in range(40)) + "."
    rows = [(i, good() if i % 2 else good()[:60] + "".join(r.choice("#$%&*!") for _ in range(60))) for i in range(400)]
    df, labels = docs_of(spark, rows + [(1000, None), (1001, ""), (None, "x" * 50_000)]), spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = Q.scored(df, Q.trained(df, labels)).collect()
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 400]
    assert len(got) == 403 and len(held) > 60 and np.mean([x.predicted == x.doc_id % 2 for x in held]) > 0.95 and all(0 <= x.score <= 1 for x in got)
    none = Q.scored(df, Q.trained(df, labels.limit(0))).select("score").distinct().collect()
    assert [x.score for x in none] == [0.5] and Q.scored(df.limit(0), Q.Network()).count() == 0


def test_quality_of_texts_laid_end_to_end(monkeypatch):
    import pyarrow as pa

    from lacuna.llm import quality_cnn as Q
    from lacuna.llm.text import flat_bytes

    r = random.Random(3)
    texts = ["".join(r.choice("ab #é") for _ in range(r.choice([0, 1, 7, 8, 9, 15, 16, 17, 300]))) for _ in range(80)]
    net = Q.Network(1)
    alone = [net.probability(*flat_bytes(pa.array([t])))[0] for t in texts]
    assert np.allclose(net.probability(*flat_bytes(pa.array(texts))), alone, atol=1e-6)
    by_hand = []
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        raw = np.concatenate([raw, np.zeros(16, np.uint8)])
        chunks = np.stack([net.p["embed"][raw[8 * k : 8 * k + 16]].ravel() @ net.p["filter"] for k in range(max(1, -(-(len(raw) - 16) // 8)))])
        by_hand.append(1 / (1 + np.exp(-(np.maximum(chunks.max(axis=0) + net.p["bias"], 0) @ net.p["out"] + net.p["base"][0]))))
    assert np.allclose(alone, by_hand, atol=1e-5)
    long = "".join(r.choice("ab #é") for _ in range(5000))
    whole = net.probability(*flat_bytes(pa.array([long])))
    for part in (1, 7, 100):
        monkeypatch.setattr(Q, "PART", part)
        assert np.allclose(net.probability(*flat_bytes(pa.array([long]))), whole, atol=1e-6)
    assert len(Q.drawn(long).encode()) <= Q.MAX_BYTES and Q.drawn("é") == "é"


def test_quality_gradients():
    from lacuna.llm import quality_cnn as Q

    r = np.random.default_rng(2)
    net = Q.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    raw = [r.integers(0, 6, n).astype(np.uint8) for n in (40, 9, 100, 0)]
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])

    def loss():
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        p = net.probability(np.concatenate(raw), offsets)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / len(raw)

    grads = net.gradients(raw, y, weight)
    for name in ("embed", "filter", "bias", "out", "base"):
        flat, decay = net.p[name].ravel(), 1e-4 * (name in ("filter", "out"))
        for i in r.permutation(min(len(flat), 6 * 8))[:12]:
            keep, h = flat[i], 1e-5
            flat[i] = keep + h
            up = loss()
            flat[i] = keep - h
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * h) + decay * keep - np.asarray(grads[name]).ravel()[i]) < 1e-5


def test_subsequence_kernel():
    from lacuna.llm import toxicity_ssk as T

    def plain(u):
        """Weighted three-letter subsequences by definition."""
        c = [ord(x) for x in u.translate(T.LETTERS)]
        out = Counter()
        for i in range(len(c)):
            for j in range(i + 1, len(c)):
                for k in range(j + 1, min(len(c), i + T.SPAN)):
                    out[c[i], c[j], c[k]] += T.LAMBDA ** (k - i + 1)
        return out

    r = random.Random(4)
    words = [u for _ in range(40) for u in T.units("".join(r.choice("abcdé1дω.") for _ in range(r.randint(1, 30))))]
    assert max(map(len, words)) == T.WIDE and len({T.LETTERS[ord(c)] for c in "éèüßñдиω1a"}) == 10
    marks = T.norms_and_map(words[:20])
    found = T.kernel(marks, *T.unit_map(words))
    maps = [plain(w) for w in words]
    norm = T.norms(T.coded(words))
    want = [[sum(v * b[k] for k, v in a.items()) / norm[i] / norm[j] for j, b in enumerate(maps[:20])] for i, a in enumerate(maps)]
    assert np.allclose(found, want, atol=1e-4)
    # landmarks that are all training units make the Nyström map exact: its products are the kernel
    gram = marks.rows.T @ marks.rows
    value, vector = np.linalg.eigh(gram)
    good = value > 1e-6 * value.max()
    x = found[:20] @ (vector[:, good] / np.sqrt(value[good]))
    assert np.allclose(x @ x.T, np.array(want)[:20], atol=1e-3)
    # and a machine in that map is one weight for each subsequence
    machine = T.Machine()
    machine.learn(words[:10], words[10:20])
    by_hand = [sum(v * machine.weights[(a * T.CODES + b) * T.CODES + c] for (a, b, c), v in m.items()) / n + machine.bias for m, n in zip(maps, norm, strict=True)]
    assert np.allclose(machine.scores(words), by_hand, atol=1e-3)


def test_toxicity_of_few_labels(spark):
    from lacuna.llm import toxicity_ssk as T

    texts = ["a fine day. we walk on"] * 3 + ["you are a fool. truly"] * 2
    machine = T.Machine().fit(texts, np.array([0.0, 0, 0, 1, 1]))
    p = T.Scorer(machine)(["a fine day", "such a fool", ""])
    assert machine.constant is None and p[1] > p[0] and T.Machine().fit(texts[:3], np.zeros(3)).constant == 0.0


def test_toxicity(spark):
    from lacuna.llm import toxicity_ssk as T

    r = random.Random(1)
    word = lambda: "".join(r.choice(["ta", "re", "lo", "mi", "nu", "sha"]) for _ in range(r.randint(1, 4)))
    clean = lambda: [word() for _ in range(30)]

    def toxic():
        w = clean()
        w[r.randrange(30)] = r.choice(["idiot", "clown", "moron"])
        return w

    rows = [(i, " ".join(toxic() if i % 4 == 0 else clean())) for i in range(800)]
    df, labels = docs_of(spark, rows + [(1000, None), (1001, ""), (None, "y" * 50_000)]), spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    machine = T.trained(df, labels)
    got = T.scored(df, machine).collect()
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 800]
    assert len(got) == 803 and np.mean([x.predicted == (x.doc_id % 4 == 0) for x in held]) > 0.97
    by = dict(zip(("idiot", "iddiot", "mororn", "tarelo", "numisha"), machine.scores(["idiot", "iddiot", "mororn", "tarelo", "numisha"]), strict=True))
    assert min(by["idiot"], by["iddiot"]) > max(by["tarelo"], by["numisha"])
    assert T.sentences("an i d i o t here") == [["an", "i", "d", "i", "o", "t", "here", "idiot"]]  # spelled out
    long = [(i, ". ".join(x for k, x in rows if k % 4 and (k // 2) % 2 == i)[:18_000] + f". {t} end.") for i, t in enumerate(("well", "you idiot clown"))]
    assert [x.predicted for x in T.scored(spark.createDataFrame(long, "doc_id long, text string"), machine).orderBy("doc_id").collect()] == [0, 1]
    assert len(T.drawn(long[0][1]).encode()) <= T.MAX_BYTES < len(long[0][1])
    kept = T.clean_documents(df, machine)
    assert kept.columns == df.columns and kept.where(F.col("doc_id") >= 1000).count() == 2
    assert T.scored(df, T.trained(df, labels.limit(0))).agg(F.max("score")).first()[0] == 0.0 and T.scored(df.limit(0), machine).count() == 0
