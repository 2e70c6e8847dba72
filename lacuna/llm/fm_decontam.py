"""Benchmark decontamination with an FM-index per shard of training documents.

A shard is a bounded stretch of a task's documents, as one sequence of word numbers. Numbers are given to the benchmark's
words only (known by 128 bits of hash); a stretch of fewer known words than the shortest window can't hold an occurrence,
so the index is built over the other stretches, each followed by a border. All windows whose words the shard has are
searched backwards together through the ranks of a wavelet matrix of the Burrows-Wheeler transform; occurrences are located
by LF steps to sampled suffix places, and the spans of each document merge.

The benchmark's items are cut into pieces of ``PIECE_WORDS`` words that overlap by a window less one, so that they have the
same windows, and the pieces go out in blocks of about ``BLOCK_WORDS`` words (some 60 bytes each): the driver and each task
hold one block at a time. With several blocks the first pass over the documents keeps a row for each, the others only rows
of documents with hits, and the spans of equal documents are joined before they are counted.

Defined cases: null and empty texts have no words; items without words have no windows; items of fewer than 13 words are one
window; repeated items, and items of null id (left out of item lists), are each judged by their text; repeated
documents, and those that share an id or have none, are each judged by their text; other columns are ignored; an empty benchmark hits nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import Words, doc_texts, flat_bytes, mapped, steps, stored

WIDTH = 13
#: Benchmark words in a block and in a piece of an item; bytes of text and words of a shard's index; distance of sampled suffix places.
BLOCK_WORDS, PIECE_WORDS, SHARD_BYTES, SHARD_WORDS, SAMPLE = 500_000, 20_000, 1 << 24, 1 << 20, 8
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling: ranks of 2**k symbols, until all differ."""
    n, width = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if n == 0 or new.max() == n - 1:
            return order
        rank, width = new, 2 * width


class WaveletMatrix:
    """rank(symbol, place) and access(place) over a sequence, one bit level at a time."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = values >> level & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(values) - int(bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros_like(place)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = symbol >> (self.bits - 1 - k) & 1 == 1
            p, s = ones[place], ones[start]
            place, start = np.where(one, zeros + p, place - p), np.where(one, zeros + s, start - s)
        return place - start

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before it."""
        symbol, start = np.zeros_like(place), np.zeros_like(place)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            p, s = ones[place], ones[start]
            one = ones[place + 1] - p == 1
            symbol = symbol * 2 + one
            place, start = np.where(one, zeros + p, place - p), np.where(one, zeros + s, start - s)
        return symbol, place - start


class FmIndex:
    def __init__(self, text: np.ndarray, size: int):
        """text: numbers below ``size``; only the last one is 0."""
        order = suffix_array(text)
        self.n = len(text)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.wavelet = WaveletMatrix(text[order - 1], max(1, int(size - 1).bit_length()))
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of patterns, which are the right-aligned rows of a matrix."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for step in range(patterns.shape[1]):
            open_ = np.flatnonzero((lengths > step) & (low < high))
            if not len(open_):
                break
            symbol = patterns[open_, patterns.shape[1] - 1 - step]
            base = self.less[symbol]
            both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low[open_], high[open_]]))
            low[open_], high[open_] = base + both[: len(open_)], base + both[len(open_) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows."""
        out, row, left = np.zeros(len(rows), np.int64), rows.copy(), np.arange(len(rows))
        for walked in range(SAMPLE):
            done = self.sampled[row]
            out[left[done]] = self.samples[self.sample_rank[row[done]]] + walked
            row, left = row[~done], left[~done]
            if not len(row):
                break
            symbol, before = self.wavelet.access(row)
            row = self.less[symbol] + before
        return out


class Benchmark:
    """Vocabulary and distinct windows of some items. windows: right-aligned word numbers from 1; owner: which windows the items have."""

    def __init__(self, ids: list[str | None], texts: pa.Array):
        w = Words(*flat_bytes(texts))
        words = np.unique(np.stack([w.hash, w.check], axis=1), axis=0)
        self.vocabulary, self.check = words[:, 0].copy(), words[:, 1].copy()
        self.alike = int(np.unique(self.vocabulary, return_counts=True)[1].max(initial=1))
        number = self.numbers(w.hash, w.check)
        n = np.minimum(w.count, WIDTH)
        each = np.where(n > 0, w.count - n + 1, 0)
        item = np.repeat(np.arange(len(each)), each)
        start = w.first[:-1][item] + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        rows = np.zeros((len(item), WIDTH), np.int32)
        for k in range(WIDTH):  # from the right
            has = n[item] > k
            rows[has, WIDTH - 1 - k] = number[start[has] + n[item[has]] - 1 - k]
        self.windows, which = np.unique(rows, axis=0, return_inverse=True)
        self.lengths = (self.windows > 0).sum(axis=1)
        self.least = int(self.lengths.min(initial=WIDTH))
        self.names = sorted({x for x in ids if x is not None})
        place = {x: i for i, x in enumerate(self.names)}
        owner = np.array([place.get(x, -1) for x in ids], np.int64)[item]
        pairs = np.unique(np.stack([which.ravel()[owner >= 0], owner[owner >= 0]], axis=1), axis=0).astype(np.int32)
        self.owner, self.owners_from = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))

    @classmethod
    def of(cls, values: dict) -> Benchmark:
        """From the plain values that are sent to the tasks."""
        out = cls.__new__(cls)
        vars(out).update(values)
        return out

    def numbers(self, hashes: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Number of each word; 0 if the benchmark hasn't it."""
        out = np.zeros(len(hashes), np.int32)
        if len(self.vocabulary):
            at = np.searchsorted(self.vocabulary, hashes)
            for k in range(self.alike):  # words of one hash stand side by side
                here = np.minimum(at + k, len(self.vocabulary) - 1)
                same = (self.vocabulary[here] == hashes) & (self.check[here] == check)
                out[same] = here[same] + 1
        return out


def stretches(number: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of known words within a document that are at least ``least`` long."""
    known = np.zeros(len(number) + 1, bool)
    known[:-1] = number > 0
    before = np.zeros(len(number) + 1, bool)
    before[1:] = known[:-1]
    edge = np.zeros(len(number) + 1, bool)
    edge[first] = True
    start = np.flatnonzero(known & (~before | edge))
    end = np.flatnonzero(before & (~known | edge))
    long = end - start >= least
    return start[long], end[long]


class Shard:
    """Documents of a task on their way into an index: the stretches of known words of each, laid end to end with borders."""

    def __init__(self, b: Benchmark):
        self.b, self.size, self.counts, self.texts, self.documents, self.places = b, 0, [], [], [], []

    def add(self, words: Words) -> None:
        number = self.b.numbers(words.hash, words.check)
        start, end = stretches(number, words.first, self.b.least)
        n = end - start + 1
        base = np.cumsum(n) - n
        source = np.repeat(start - base, n) + np.arange(n.sum())
        border = np.zeros(len(source), bool)
        border[base + n - 1] = True
        text = np.where(border, 1, 1 + number[np.minimum(source, max(len(number) - 1, 0))]) if len(source) else np.zeros(0, np.int32)
        self.texts.append(text.astype(np.int32))
        self.documents.append(np.repeat(len_of(self.counts) + words.doc[start], n).astype(np.int32))
        self.places.append((source - words.first[np.repeat(words.doc[start], n)]).astype(np.int64))
        self.counts.append(words.count)
        self.size += len(text)

    def hits(self) -> list[tuple[int, np.ndarray, list[int]]]:
        """(words, merged word spans as rows of start and end, items) of each document."""
        count = np.concatenate([np.zeros(0, np.int64), *self.counts])
        out = [(int(n), np.zeros((0, 2), np.int64), []) for n in count]
        if not self.size:
            return out
        text, document, place = (np.concatenate(x) for x in (self.texts, self.documents, self.places))
        b, present = self.b, np.zeros(len(self.b.vocabulary) + 1, bool)
        present[np.maximum(text - 1, 0)] = True
        present[0] = True  # padding
        alive = np.ones(len(b.windows), bool)
        for k in range(WIDTH):
            alive &= present[b.windows[:, k]]
        alive = np.flatnonzero(alive)
        index = FmIndex(np.append(text, 0).astype(np.int64), len(b.vocabulary) + 2)  # 0 ends the text, 1 is a border, words follow
        low, high = index.search(b.windows[alive].astype(np.int64) + 1, b.lengths[alive])
        times = np.maximum(high - low, 0)
        window = alive[np.repeat(np.arange(len(low)), times)]
        at = index.locate(np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum()))
        own, first = document[at], place[at]
        last = first + b.lengths[window]
        order = np.lexsort((last, first, own))
        own, first, last, window = own[order], first[order], last[order], window[order]
        edges = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            reach = np.maximum.accumulate(last[i:j])
            new = np.append(True, first[i + 1 : j] > reach[:-1])
            spans = np.stack([first[i:j][new], reach[np.append(np.flatnonzero(new)[1:] - 1, j - i - 1)]], axis=1)
            items = np.unique(np.concatenate([b.owner[b.owners_from[w] : b.owners_from[w + 1]] for w in np.unique(window[i:j]).tolist()]))
            out[own[i]] = (int(count[own[i]]), spans, items.tolist())
        return out


def len_of(parts: list) -> int:
    return sum(map(len, parts))


def hits_of(b: Benchmark, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[tuple[int, np.ndarray, list[int]]]]]:
    """(some batches, what Shard.hits says of their rows), one shard after another."""
    held: list[pa.RecordBatch] = []
    shard, size = Shard(b), 0
    for batch in batches:
        flat, offsets = flat_bytes(batch.column("text"))
        for i, j in steps(offsets):
            shard.add(Words(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
        held.append(batch)
        size += len(flat)
        if size >= SHARD_BYTES or shard.size >= SHARD_WORDS:
            yield held, shard.hits()
            held, shard, size = [], Shard(b), 0
    if held:
        yield held, shard.hits()


def verdict(words: int, spans: np.ndarray, names: list[str]) -> tuple[int, int, int, str, bool]:
    hit = int((spans[:, 1] - spans[:, 0]).sum())
    return words, hit, len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), hit > 0 and 20 * hit >= words


def item_pieces(benchmark: DataFrame) -> DataFrame:
    """item_id, text and words of the benchmark's pieces, without repeats. A piece that isn't a whole item has 13 words at least."""
    kind = "item_id string, text string, words long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode()
                w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                n = len(w.start)
                for a in range(0, max(1, n - WIDTH + 1), PIECE_WORDS) if n else ():
                    z = min(n, a + PIECE_WORDS + WIDTH - 1)
                    out.append((name, raw[w.start[a] : w.end[z - 1]].decode(), z - a))
            names, texts, words = zip(*out, strict=True) if out else ((),) * 3
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(words, pa.int64())], names=["item_id", "text", "words"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return mapped(items, run, kind).distinct()


def blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark's pieces, dealt by hash into parts of about BLOCK_WORDS words."""
    pieces = stored(item_pieces(benchmark))
    n = max(1, -(-pieces.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0] // BLOCK_WORDS))
    return [pieces.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def parsed(block: DataFrame):
    t = block.select("item_id", "text").toArrow()  # about BLOCK_WORDS words
    return block.sparkSession.sparkContext.broadcast(vars(Benchmark(t.column("item_id").to_pylist(), t.column("text"))))


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hit words, items and the verdict of each document. Columns: SCHEMA."""
    parts = blocks(benchmark)
    if len(parts) == 1:
        return one_block(doc_texts(docs), parsed(parts[0]))
    every, found = judged_by_parts(docs, parts)
    none = {"n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"), "items_sha256": F.lit(hashlib.sha256(b"").hexdigest()), "contaminated": F.lit(False)}
    both = every.join(found, "row_key", "left")
    return both.select("doc_id", "n_words", *(F.coalesce(c, x).alias(c) for c, x in none.items()))


def row_key() -> Column:
    """Tells rows of a document's id and text apart unless they repeat each other."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))


def one_block(texts: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Benchmark.of(shared.value)
        for held, found in hits_of(b, batches):
            rows = [verdict(n, spans, [b.names[i] for i in items]) for n, spans, items in found]
            n, hit, items, bad_digest, bad = zip(*rows, strict=True) if rows else ((),) * 5
            ids = pa.chunked_array([x.column("doc_id") for x in held]).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in (n, hit, items)), pa.array(bad_digest, pa.string()), pa.array(bad, pa.bool_())], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return mapped(texts, run, SCHEMA)


HITS = "row_key string, doc_id long, n_words long, spans array<struct<a:long,b:long>>, items array<string>"


def hits_of_block(numbered: DataFrame, shared, every: bool) -> DataFrame:
    """HITS for one block of the benchmark: of every document, or only of those with hits. Without hits spans and items are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Benchmark.of(shared.value)
        for held, found in hits_of(b, batches):
            keys, ids = ([v for x in held for v in x.column(c).to_pylist()] for c in ("row_key", "doc_id"))
            rows = [(k, i, n, [{"a": int(x), "b": int(y)} for x, y in spans] if len(spans) else None, [b.names[v] for v in items] if len(spans) else None) for k, i, (n, spans, items) in zip(keys, ids, found, strict=True) if every or len(spans)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in HITS.split(", ")])

    return mapped(numbered, run, HITS)


def judged_by_parts(docs: DataFrame, parts: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(row_key, doc_id, n_words of every document; row_key and the verdict of those with hits) by several blocks of the benchmark."""
    numbered = doc_texts(docs).withColumn("row_key", row_key())
    every = found = None
    for p in parts:
        shared = parsed(p)
        part = stored(hits_of_block(numbered, shared, every is None))
        shared.unpersist()
        every = part if every is None else every
        part = part.where("spans IS NOT NULL")
        found = part if found is None else found.unionByName(part)
    # equal documents have equal spans, so a group has as many sets as there are blocks
    groups = found.groupBy("row_key", "n_words").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    kind = "row_key string, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["row_key"], *verdict(r["n_words"], joined(r["spans"]), r["items"])[1:]) for r in batch.to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in kind.split(", ")])

    return every.select("row_key", "doc_id", "n_words"), stored(mapped(groups, run, kind))


def joined(spans: list[dict]) -> np.ndarray:
    """The spans of several blocks, overlapping ones together."""
    out: list[list[int]] = []
    for x, y in sorted((s["a"], s["b"]) for s in spans):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return np.array(out, np.int64).reshape(-1, 2)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated ones (20 * n_hit >= n_words > 0); all others stay as they are."""
    parts = blocks(benchmark)
    if len(parts) > 1:
        bad = judged_by_parts(docs, parts)[1].where("contaminated").select(F.col("row_key").alias("lacuna_key"))
        keyed = docs.select(row_key().alias("lacuna_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        return keyed.join(bad, "lacuna_key", "left_anti").select("row.*")
    shared = parsed(parts[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, found in hits_of(Benchmark.of(shared.value), batches):
            keep = np.array([not verdict(n, spans, [])[4] for n, spans, _ in found], bool)
            for batch in held:
                yield batch.filter(pa.array(keep[: batch.num_rows]))
                keep = keep[batch.num_rows :]

    return mapped(docs, run, docs.schema)
