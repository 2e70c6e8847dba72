"""Cross-tokenizer alignment: where the tokens of two vocabularies end together, and which of their ids meet there.

A task lays its texts end to end and marks the ends of A's and of B's tokens as packed bitsets over the bytes. Their AND has
the shared cuts; a directory of popcounts ranks a cut among either's ends and so gives the tokens that it closes. The pair of
tokens that end at a cut is a link, and the tokens since the cut before are a group.

Corpus-wide counts take two shuffles and no copy of the texts. A task numbers the id pairs of a block of about ``BLOCK`` bytes of
text by frequency and writes, once, the documents with their links as those numbers (sorted, as differences) and the block's pairs with
their counts. Pairs are summed over all blocks, compared with the highest count of their B id (a row for each id of
B's vocabulary, so that can be broadcast), and go back to the blocks that have them, where each block's documents add them up. So
a common pair costs one row a block, a block is bounded, and no row of the corpus meets another document's.

Texts are encoded in chunks: before a single space between two visible ASCII or Latin characters A's pattern always cuts, and B's
merges never cross it if no piece of its vocabulary has a space after another character, which is checked; each chunk gets the
space back as both tokenizers' prefix. A task encodes a chunk once and keeps up to ``KEPT`` of them; a text without such spaces is one chunk.

Defined cases: null and empty texts, and those whose tokens' bytes aren't the space and the text (a normalizer, unknown pieces), have
zeros and an empty string; rows count one by one, also repeated ones and those without a doc_id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import doc_texts, mapped, stored

#: Bytes of text whose links are counted together, and that are encoded at a time.
BLOCK, STEP = 1 << 23, 1 << 19
#: Chunks that a task remembers; more characters make a chunk long, and SHORT * KEPT characters of long ones are the most.
KEPT, SHORT = 1 << 19, 64
BLOCKS = "block long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>, pair int, a int, b int, n long"
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

APART = re.compile(r"(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")


class Vocabulary:
    """The bytes of each id, their lengths, and the ids of texts that a space is put before."""

    def __init__(self, pieces: list[bytes], encode: Callable[[list[str]], list[list[int]]], splits: bool):
        self.pieces, self.encode, self.splits = pieces, encode, splits
        self.size = np.array([len(p) for p in pieces], np.int64)


def byte_characters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones stand for themselves, others follow from U+0100."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def byte_level(path: str) -> Vocabulary:
    """A byte-level vocabulary file; strings of its special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer, code = Tokenizer.from_file(path), byte_characters()
    tokenizer.encode_special_tokens = True
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    names = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    pieces = [special[i] if i in special else bytes(code[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
    return Vocabulary(pieces, lambda texts: [e.ids for e in tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)], True)


def with_pieces(path: str) -> Vocabulary:
    """A vocabulary of pieces with a mark for spaces and bytes as a fallback; it puts a space before texts itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    splits = not any(re.search("[^▁]▁", p) for p in names)
    return Vocabulary(pieces, lambda texts: model.encode(texts, num_threads=1), splits)


class Lists:
    """Lists of ids, one after the other."""

    def __init__(self):
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, ends: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])

    def taken(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of some lists end to end, their counts)."""
        count = self.ends[which + 1] - self.ends[which]
        return self.flat[np.repeat(self.ends[which] - np.cumsum(count) + count, count) + np.arange(count.sum())].astype(np.int64), count


class Encoder:
    """The ids of texts in both vocabularies, chunk by chunk."""

    def __init__(self, va: Vocabulary, vb: Vocabulary, kept: int = KEPT):
        self.va, self.vb, self.splits, self.kept = va, vb, va.splits and vb.splits, kept
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.a, self.b, self.good, self.long = Lists(), Lists(), np.zeros(0, bool), 0

    def _learn(self, new: list[str]) -> None:
        raw = [f" {c}".encode() for c in new]
        size, good = np.fromiter(map(len, raw), np.int64), np.ones(len(new), bool)
        for v, lists in ((self.va, self.a), (self.vb, self.b)):
            ids = v.encode(new)
            flat, ends = np.fromiter(chain.from_iterable(ids), np.int32), np.cumsum(np.fromiter(map(len, ids), np.int64))
            lists.add(flat, ends)
            sums = np.concatenate([[0], np.cumsum(v.size[flat])])
            if not np.array_equal(sums[ends], np.cumsum(size)) or b"".join(map(v.pieces.__getitem__, chain.from_iterable(ids))) != b"".join(raw):
                good &= [b"".join([v.pieces[i] for i in x]) == r for x, r in zip(ids, raw, strict=True)]
        self.known.update(zip(new, range(len(self.good), len(self.good) + len(new)), strict=True))
        self.good = np.concatenate([self.good, good])
        self.long += sum(len(c) for c in new if len(c) > SHORT)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(whether each text is the bytes of its ids, ids of A, of B, how many of each in every such text), such texts end to end."""
        cut = [APART.split(t) if self.splits else [t] for t in texts]
        known = self.known
        if new := list(dict.fromkeys([c for chunks in cut for c in chunks if c not in known])):
            self._learn(new)
        which = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64)
        ends = np.cumsum([len(c) for c in cut], dtype=np.int64)
        first = np.concatenate([[0], ends[:-1]])
        good = np.array([bool(t) for t in texts], bool)
        for i in np.flatnonzero(np.add.reduceat(~self.good[which], first) > 0) if len(which) else ():
            raw = f" {texts[i]}".encode()
            good[i] &= all(b"".join([v.pieces[k] for k in x.taken(which[first[i] : ends[i]])[0].tolist()]) == raw for v, x in ((self.va, self.a), (self.vb, self.b)))
        texts_of = np.repeat(np.arange(len(texts)), ends - first)
        which, texts_of = which[good[texts_of]], texts_of[good[texts_of]]
        (a, n_a), (b, n_b) = self.a.taken(which), self.b.taken(which)
        per_text = [np.bincount(texts_of, n, len(texts)).astype(np.int64)[good] for n in (n_a, n_b)]
        if len(known) > self.kept or self.long > SHORT * self.kept:
            self._forget()
        return good, a, b, *per_text


class Bits:
    """A packed bitset with a directory of popcounts."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def at(cls, places: np.ndarray, size: int) -> Bits:
        flags = np.zeros(-(-size // 64) * 64, bool)
        flags[places] = True
        return cls(np.packbits(flags, bitorder="little").view(np.uint64))

    def __and__(self, other: Bits) -> Bits:
        return Bits(self.words & other.words)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """How many bits before each place are set."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below).astype(np.int64)

    def selected(self) -> np.ndarray:
        """The places of all set bits: those of its n-th is the n-th here."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


def aligned(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, va: Vocabulary, vb: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token) that each shared cut closes, as places in the texts' ids laid end to end, and the cuts of each text.

    A text's tokens have the same bytes in both, so each text, of n_a tokens of A, ends with a shared cut."""
    ends_a, ends_b = np.cumsum(va.size[ids_a]), np.cumsum(vb.size[ids_b])
    size = int(ends_a[-1]) if len(ends_a) else 0
    bits_a, bits_b = (Bits.at(e - 1, size) for e in (ends_a, ends_b))  # a token's last byte
    cuts = (bits_a & bits_b).selected()
    count = np.diff(np.searchsorted(cuts, ends_a[np.cumsum(n_a) - 1]), prepend=0)
    return bits_a.rank(cuts), bits_b.rank(cuts), count


def group_texts(close_a: np.ndarray, close_b: np.ndarray, count: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, names: list[str], width: int) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of each text. names: each id with a comma, then with a bar, then with a semicolon; ``width`` ids."""
    open_a, open_b = (np.concatenate([[0], x[:-1] + 1]) for x in (close_a, close_b))
    shift_a = np.repeat(open_b, close_a - open_a + 1)  # B's tokens that come before an A token of the group
    shift_b = np.repeat(close_a + 1, close_b - open_b + 1)
    mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    mark_a[close_a], mark_b[close_b] = width, 2 * width
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    codes[np.arange(len(ids_a)) + shift_a] = ids_a + mark_a
    codes[np.arange(len(ids_b)) + shift_b] = ids_b + mark_b
    last = np.cumsum(count) - 1
    stops = close_a[last] + close_b[last] + 2
    words, out, at = [names[c] for c in codes.tolist()], [], 0
    for stop in stops.tolist():
        out.append("".join(words[at:stop])[:-1])
        at = stop
    return out


def blocks(docs: DataFrame, make_a: Callable[[], Vocabulary], make_b: Callable[[], Vocabulary], block: int = BLOCK) -> DataFrame:
    """BLOCKS, stored: a row for each document (pair is null) and one for each pair of a block (doc_id may be null)."""
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups")), ("groups_sha256", pa.string()), ("links", pa.list_(pa.int32())), *((n, pa.int32()) for n in ("pair", "a", "b")), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = make_a(), make_b()
        encoder, width = Encoder(va, vb), max(len(va.pieces), len(vb.pieces))
        names = [f"{i}{end}" for end in ",|;" for i in range(width)]
        number, held = (TaskContext.get().partitionId() << 32), 0
        doc_ids: list = []
        rows: list[tuple] = []  # n_a, n_b, links, digest
        codes: list[np.ndarray] = []

        def add(ids: list, texts: list[str]) -> None:
            good, a, b, n_a, n_b = encoder.encoded(texts)
            done: list[tuple] = [(0, 0, 0, "")] * len(texts)
            if good.any():
                close_a, close_b, count = aligned(a, b, n_a, va, vb)
                codes.append(a[close_a] << 32 | b[close_b])
                told = group_texts(close_a, close_b, count, a, b, names, width)
                for i, *row, text in zip(np.flatnonzero(good).tolist(), n_a.tolist(), n_b.tolist(), count.tolist(), told, strict=True):
                    done[i] = (*row, hashlib.sha256(text.encode()).hexdigest())
            doc_ids.extend(ids)
            rows.extend(done)

        def closed() -> Iterator[pa.RecordBatch]:
            """The block's documents and pairs; pairs are numbered from the commonest."""
            nonlocal doc_ids, rows, codes
            which, kinds = pd.factorize(np.concatenate([*codes, np.zeros(0, np.int64)]))
            n = np.bincount(which, minlength=len(kinds))
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            links, count = place[which], np.array([r[2] for r in rows], np.int64)
            ends = np.cumsum(count)
            links = np.sort(np.repeat(np.arange(len(rows)) << 32, count) | links) & 0xFFFFFFFF
            steps = np.diff(links, prepend=0)
            first = (ends - count)[count > 0]
            steps[first] = links[first]
            filled = lambda made, n: pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else pa.nulls(n, f.type) for f in schema], schema=schema)
            for i in range(0, len(rows), 2000):
                some = rows[i : i + 2000]
                j = i + len(some)
                low, high = int(ends[i] - count[i]), int(ends[j - 1])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends[i:j] - low]), pa.int32()), pa.array(steps[low:high], pa.int32()))
                yield filled({"block": [number] * len(some), "doc_id": doc_ids[i:j], "n_a": [r[0] for r in some], "n_b": [r[1] for r in some], "n_groups": [r[2] for r in some], "groups_sha256": [r[3] for r in some], "links": lists}, len(some))
            kinds, n = kinds[order], n[order]
            for i in range(0, len(kinds), 50000):
                some = kinds[i : i + 50000]
                yield filled({"block": [number] * len(some), "pair": np.arange(i, i + len(some)), "a": some >> 32, "b": some & 0xFFFFFFFF, "n": n[i : i + len(some)]}, len(some))
            doc_ids, rows, codes = [], [], []

        ids: list = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                size += len(text.encode())
                if size >= STEP or len(ids) >= 10000:
                    add(ids, texts)
                    held += size
                    ids, texts, size = [], [], 0
                    if held >= block:
                        yield from closed()
                        number, held = number + 1, 0
        if ids:
            add(ids, texts)
        if rows:
            yield from closed()

    return stored(mapped(doc_texts(docs), run, BLOCKS))


def pair_counts(table: DataFrame) -> DataFrame:
    """a, b, links: how many links of the whole corpus hold each pair of ids; ``best`` where no pair of its B id has more."""
    counts = table.where("pair IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("links"))
    tops = counts.groupBy("b").agg(F.max("links").alias("top"))  # a row for each id of B's vocabulary
    return counts.join(F.broadcast(tops), "b").select("a", "b", "links", (F.col("links") == F.col("top")).alias("best"))


def _added_up(docs: pa.Table, told: pa.Table) -> pa.Table:
    """The documents of a block with the counts of their links."""
    counts, best = (np.zeros(told.num_rows, np.int64) for _ in range(2))
    at = told.column("pair").to_numpy()
    counts[at], best[at] = told.column("links").to_numpy(), told.column("best").to_numpy(zero_copy_only=False)
    n = docs.column("n_groups").to_numpy()
    lists = docs.column("links").combine_chunks()
    steps = np.concatenate([lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.zeros(0, np.int64)])
    ends = np.cumsum(n)
    run = np.concatenate([[0], np.cumsum(steps)])
    links = run[1:] - np.repeat(run[ends - n], n)
    total, tops = (np.concatenate([[0], np.cumsum(x[links])]) for x in (counts, best))
    more = [n, tops[ends] - tops[ends - n], total[ends] - total[ends - n]]
    return pa.table([*(docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), *(pa.array(x, pa.int64()) for x in more), docs.column("groups_sha256")], names=[f.split()[0] for f in SCHEMA.split(", ")])


def links_of(docs: DataFrame, make_a: Callable[[], Vocabulary], make_b: Callable[[], Vocabulary], block: int = BLOCK) -> DataFrame:
    """SCHEMA of each document: its tokens, groups and links, and what the corpus says of these."""
    table = blocks(docs, make_a, make_b, block)
    mine = table.where("pair IS NOT NULL").select("block", "pair", "a", "b")
    told = mine.join(pair_counts(table), ["a", "b"]).select(F.col("block").alias("home"), "pair", "links", "best")
    rows = table.where("pair IS NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
    return rows.groupBy("block").cogroup(told.groupBy("home")).applyInArrow(_added_up, SCHEMA)


def aligned_documents(docs: DataFrame, file_a: str, file_b: str, block: int = BLOCK) -> DataFrame:
    """links_of for a byte-level vocabulary file (A) and a model of pieces (B)."""
    return links_of(docs, lambda: byte_level(file_a), lambda: with_pieces(file_b), block)
