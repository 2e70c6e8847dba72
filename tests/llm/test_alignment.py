import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lacuna.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = [c.split()[0] for c in alignment.SCHEMA.split(", ")]


def plain(texts: dict) -> dict:
    """Token by token, with dictionaries of ends."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    code = alignment.byte_characters()
    found, pairs = {}, Counter()
    for key, text in texts.items():
        raw = f" {text or ''}".encode()
        ids_a = a.encode(f" {text or ''}", add_special_tokens=False).ids
        bytes_a = [bytes(code[c] for c in a.id_to_token(i)) for i in ids_a]
        ids_b = b.encode(text or "")
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            found[key] = None
            continue
        ends_a, ends_b = {}, {}
        for ends, ids, pieces in ((ends_a, ids_a, bytes_a), (ends_b, ids_b, bytes_b)):
            n = 0
            for i, p in zip(ids, pieces, strict=True):
                n += len(p)
                ends[n] = i
        cuts, before, groups = sorted(ends_a.keys() & ends_b.keys()), 0, []
        for c in cuts:
            groups.append("|".join(",".join(str(ends[e]) for e in sorted(ends) if before < e <= c) for ends in (ends_a, ends_b)))
            before = c
        links = [(ends_a[c], ends_b[c]) for c in cuts]
        pairs.update(links)
        found[key] = (len(ids_a), len(ids_b), links, ";".join(groups))
    top = {}
    for (_, y), n in pairs.items():
        top[y] = max(top.get(y, 0), n)
    out = {}
    for key, x in found.items():
        out[key] = (0,) * 6 + ("",)
        if x is not None:
            out[key] = (x[0], x[1], x[3].count(";") + 1, len(x[2]), sum(pairs[p] == top[p[1]] for p in x[2]), sum(pairs[p] for p in x[2]), hashlib.sha256(x[3].encode()).hexdigest())
    return out


TEXTS = {
    1: None, 2: "", 3: " ", 4: "a", 5: "naïve café — “quoted” text\r\n\tand  spaces   ", 6: "<|endoftext|> <s>x</s> <unk> <0x41> ▁ ▁x",
    7: "\x00\x01 nul", 8: "日本語のテキスト 🎉🎉 mixed with words", 9: "word " * 3000 + "end", 10: "x" * 5000, 11: "same text twice", 12: "same text twice", 13: "ﬁ ½ Å ﬁ á",
}


def rows_of(spark, texts: dict):
    return spark.createDataFrame([(k, t, k, "b", 1, 0) for k, t in texts.items()], "doc_id long, text string, block long, links string, pair int, n_a long")


def test_equals_a_plain_alignment(spark):
    want = plain(TEXTS)
    assert want[5][0] and want[6][0] is not None
    for block in (1 << 25, 200):  # one block of a task, and many
        got = {r[0]: tuple(r)[1:] for r in alignment.aligned_documents(rows_of(spark, TEXTS).repartition(3, "doc_id"), A, B, block).collect()}
        assert got == want


def test_repeated_rows_count_and_no_rows_give_none(spark):
    twice = spark.createDataFrame([(1, "the cat"), (1, "the cat"), (None, "the dog")], "doc_id long, text string")
    got = alignment.aligned_documents(twice, A, B)
    assert got.columns == NAMES
    rows = sorted(map(tuple, got.collect()), key=str)
    assert len(rows) == 3 and rows[0] == rows[1] and rows[0][6] > rows[0][4]
    assert alignment.aligned_documents(twice.where("doc_id > 5"), A, B).collect() == []
    assert [tuple(r)[1:] for r in alignment.aligned_documents(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B).collect()] == [(0,) * 6 + ("",)]


def test_bitsets_rank_and_select():
    places = np.flatnonzero(np.random.default_rng(1).random(1000) < 0.3)
    bits = alignment.Bits.at(places, 1000)
    assert bits.selected().tolist() == places.tolist()
    assert bits.rank(np.arange(1000)).tolist() == np.searchsorted(places, np.arange(1000)).tolist()
    assert (bits & alignment.Bits.at(places[::2], 1000)).selected().tolist() == places[::2].tolist()


def test_chunks_keep_the_tokens():
    texts = ["", *(t for t in TEXTS.values() if t), "it's 'tis we'll x' s , . a1 2b -- é à", "".join(t or "" for t in TEXTS.values()), "a" * 80 + " b"]
    va, vb = alignment.byte_level(A), alignment.with_pieces(B)
    assert va.splits and vb.splits
    for kept in (1 << 17, 2):  # few known chunks
        encoder = alignment.Encoder(va, vb, kept)
        for _ in range(2):
            good, a, b, n_a, n_b = encoder.encoded(texts)
            assert good.tolist() == [bool(t) and "▁" not in t for t in texts]  # the mark itself comes back as a space
            for v, ids, n in ((va, a, n_a), (vb, b, n_b)):
                assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [v.encode([t])[0] for t, g in zip(texts, good, strict=True) if g]
    plain_pieces = alignment.Vocabulary(vb.pieces, vb.encode, False)
    assert [x.tolist() for x in alignment.Encoder(va, plain_pieces).encoded(["to be or"])[1:3]] == [va.encode(["to be or"])[0], vb.encode(["to be or"])[0]]
