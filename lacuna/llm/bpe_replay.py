"""Byte-level BPE by merge replay over a shard's distinct words, and decoding.

The distinct pre-token pieces of a shard (a slice of a task's rows) form one token list. An inverted index maps each
rank to the places of the adjacent pairs that join to it; a heap serves the ranks in ascending order, and each merge
touches only the two neighbouring pairs. Every piece is merged once per task; documents are then spelled out from the
piece table. Nothing is shuffled: pieces would outweigh the texts.

Defined cases: null and empty texts give no tokens and the hashes of empty strings; repeated rows give repeated results;
other columns are ignored; an empty table gives no rows. The piece table of a task is bounded by ``max_pieces`` entries
and starts anew beyond that, so memory doesn't follow the input.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lacuna.llm.text import doc_texts, mapped

#: No rank.
NONE = np.int64(2**40)
#: Pieces of more bytes go place by place, which costs less than a step for each of their many equal pairs.
LONG = 256
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def replay_long(pieces: Iterable[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Token ids of each piece, all merged together, rank by rank; place by place, for few or very long pieces."""
    pieces = list(pieces)
    token: list[bytes | None] = []
    starts = []
    for p in pieces:
        starts.append(len(token))
        token += [p[i : i + 1] for i in range(len(p))]
        token.append(None)  # a border: no pair spans two pieces
    n = len(token)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    index: dict[int, list[int]] = {}
    get = ranks.get
    whole = {s for p, s in zip(pieces, starts, strict=True) if p in ranks}
    for s, p in zip(starts, pieces, strict=True):
        if s in whole:
            continue
        for i in range(s, s + len(p) - 1):
            r = get(token[i] + token[i + 1])
            if r is not None:
                index.setdefault(r, []).append(i)
    heap = list(index)
    heapq.heapify(heap)
    name = {r: t for t, r in ranks.items()} if heap else {}
    while heap:
        r = heapq.heappop(heap)
        places = index.pop(r, None)
        if places is None:
            continue
        places.sort()
        joined = name[r]
        held = -1  # border of a piece whose lower-ranked new pair must go before its other places
        for at, i in enumerate(places):
            a = token[i]
            if a is None or i <= held:
                if i <= held:
                    index.setdefault(r, []).append(i)
                continue
            j = right[i]
            b = token[j]
            if b is None or len(a) + len(b) != len(joined) or a + b != joined:
                continue  # merged meanwhile
            token[i] = joined
            token[j] = None
            k = right[j]
            right[i] = k
            if k < n:
                left[k] = i
            lower = False
            if k < n and token[k] is not None:
                q = get(joined + token[k])
                if q is not None:
                    if q not in index:
                        index[q] = []
                        heapq.heappush(heap, q)
                    index[q].append(i)
                    lower = q < r
            h = left[i]
            if h >= 0 and token[h] is not None:
                q = get(token[h] + joined)
                if q is not None:
                    if q not in index:
                        index[q] = []
                        heapq.heappush(heap, q)
                    index[q].append(h)
                    lower = lower or q < r
            if lower:
                held = k
                while held < n and token[held] is not None:
                    held = right[held]
        if r in index:
            heapq.heappush(heap, r)
    out = []
    for s, p in zip(starts, pieces, strict=True):
        if s in whole:
            out.append([ranks[p]])
            continue
        ids, i = [], s
        while token[i] is not None:
            ids.append(ranks[token[i]])
            i = right[i]
        out.append(ids)
    return out


class Ranks:
    """A vocabulary: the rank that a pair of ranks joins to, as sorted arrays, and the bytes of each rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        keys, joins = [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    joins.append(r)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(2**62))
        self.joins = np.append(np.array(joins, np.int64)[order], NONE)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        for t, r in ranks.items():
            lengths[r] = len(t)
        self.length, self.start = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(t for _, t in sorted((r, t) for t, r in ranks.items())), np.uint8)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each a + b; NONE where there is none."""
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.joins[at], NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(n) - n), n)
        return self.flat[shift + np.arange(len(shift))].tobytes()


def replay(pieces: list[bytes], vocabulary: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces end to end, and how many each has.

    Ranks come up in ascending order. Each step merges the places that the inverted index holds for one rank, in all
    pieces at once, but only the leftmost place of a piece: a merge can make a pair of lower rank, which goes first.
    """
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    start = np.concatenate([[0], np.cumsum(size + 1)])
    n = int(start[-1])
    token = np.full(n + 1, -1, np.int64)  # -1: border between pieces, or merged away
    body = np.ones(n, bool)
    body[start[1:] - 1] = False
    token[:n][body] = vocabulary.byte[np.frombuffer(b"".join(pieces), np.uint8)]
    piece = np.repeat(np.arange(len(pieces)), size + 1)
    right, left = np.arange(1, n + 2), np.arange(-1, n)
    two = np.flatnonzero((token[:-1] >= 0) & (token[1:] >= 0))
    pair = np.full(n + 1, NONE, np.int64)  # the rank that the pair starting here joins to
    pair[two] = vocabulary.join(token[two], token[two + 1])
    places = np.flatnonzero(pair != NONE)
    places = places[np.argsort(pair[places], kind="stable")]
    first_ranks, at = np.unique(pair[places], return_index=True)
    bounds = np.append(at, len(places))
    index = {int(r): places[bounds[k] : bounds[k + 1]] for k, r in enumerate(first_ranks)}
    more: dict[int, list[int]] = {}
    heap = list(index)
    heapq.heapify(heap)
    while heap:
        r = heapq.heappop(heap)
        i, added = index.pop(r, None), more.pop(r, None)
        if added:
            added = np.array(added, np.int64)
            i = np.unique(added if i is None else np.concatenate([i, added]))
        if i is None:
            continue
        i = i[pair[i] == r]
        if len(i) > 1:
            own = piece[i]
            later = np.zeros(len(i), bool)
            later[1:] = own[1:] == own[:-1]
            if later.any():
                index[r] = i[later]
                heapq.heappush(heap, r)
                i = i[~later]
        if not len(i):
            continue
        j = right[i]
        k, h = right[j], left[i]
        token[i], token[j], pair[j] = r, -1, NONE
        right[i], left[k] = k, i
        pair[i] = q = np.where(token[k] >= 0, vocabulary.join(np.full(len(i), r), np.maximum(token[k], 0)), NONE)
        prior = token[h]
        p = np.where(prior >= 0, vocabulary.join(np.maximum(prior, 0), np.full(len(i), r)), NONE)
        pair[h[prior >= 0]] = p[prior >= 0]
        for ranks, where in ((q, i), (p, h)):
            new = ranks != NONE
            for rank, place in zip(ranks[new].tolist(), where[new].tolist(), strict=True):
                if rank in more:
                    more[rank].append(place)
                else:
                    more[rank] = [place]
                    heapq.heappush(heap, rank)
    alive = token[:n] >= 0
    return token[:n][alive], np.bincount(piece[alive], minlength=len(pieces))


def splitter(pattern: str):
    r"""findall of a pattern of the tiktoken kind; \s is the Unicode property White_Space, as in that library."""
    import regex

    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall


class Codec:
    """Encodes and decodes texts. Keeps the pieces that it has met: their numbers, ids and spellings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = 250_000):
        self.vocabulary, self.max_pieces, self.find = Ranks(ranks), max_pieces, splitter(pattern)
        self.forget()

    def forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.spelled: list[str] = []
        self.ids, self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self) -> None:
        """Merges the pieces that were numbered since the last call."""
        new = [p.encode() for p in islice(self.number, len(self.spelled), None)]
        long = {i: ids for i, ids in zip(k, replay_long([new[i] for i in k], self.vocabulary.ranks), strict=True)} if (k := [i for i, p in enumerate(new) if len(p) > LONG]) else {}
        short, counts = replay([b"" if i in long else p for i, p in enumerate(new)], self.vocabulary)
        if long:
            parts = np.split(short, np.cumsum(counts)[:-1])
            for i, ids in long.items():
                parts[i] = np.array(ids, np.int64)
            short, counts = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(counts) - counts])
        self.size, self.ids = np.concatenate([self.size, counts]), np.concatenate([self.ids, short])
        words, i = list(map(str, short.tolist())), 0
        for c in counts.tolist():
            self.spelled.append(words[i] if c == 1 else " ".join(words[i : i + c]))
            i += c

    def encode(self, texts: list[str], step: int = 1 << 24) -> Iterator[tuple[np.ndarray, str]]:
        """The ids of each text, and the same in decimal, joined by one space."""
        i = 0
        while i < len(texts):
            size, found = 0, []
            if len(self.number) > self.max_pieces:
                self.forget()
            while i < len(texts) and (not found or size < step):
                size += len(texts[i])
                found.append(array("i", map(self.number.__getitem__, self.find(texts[i]))))
                i += 1
            self.learn()
            for numbers in found:
                own = np.frombuffer(numbers, np.int32) if numbers else np.zeros(0, np.int32)
                n = self.size[own]
                yield self.ids[np.repeat(self.at[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())], " ".join(map(self.spelled.__getitem__, numbers))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.vocabulary.decode(ids)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Counts and digests of the ids and of the decoded bytes of each document. Keys: SCHEMA."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(shared.value, pattern)
            rows = []
            for ids, spelled in codec.encode(batch.column(1).to_pylist()):
                rows.append((len(ids), hashlib.sha256(spelled.encode()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return mapped(doc_texts(docs), run, SCHEMA)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, token_ids array<int> and the decoded text of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(shared.value, pattern)
            encoded = codec.encode(batch.column(1).to_pylist())  # merges a large step's pieces together; hands out text by text
            for i in range(0, batch.num_rows, 256):
                ids = [x for x, _ in islice(encoded, 256)]
                texts = pa.array([codec.decode(x).decode() for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 256), pa.array(ids, pa.list_(pa.int32())), texts], names=["doc_id", "token_ids", "text"])

    return mapped(doc_texts(docs), run, "doc_id long, token_ids array<int>, text string")
