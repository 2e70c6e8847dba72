"""Removal of repeated byte strings by deep-shallow suffix sorting of the places that can repeat.

A string of ``LENGTH`` bytes that starts in two places has the same least k-gram (an anchor) in both, so the windows of a
document are cut into stretches of one anchor each, and only stretches whose anchor occurs elsewhere can repeat. Stretches
of equal text are joined first, whatever their number: equal means equal BLAKE2b digests of 128 bits. Where several different
stretches share an anchor, the suffixes of their windows are sorted: multikey sorting by eight-byte symbols to a shallow
depth, then a blind trie for each group that is still equal. A group one byte further on with the same members keeps the
order of the group before, so it needs no trie. Neighbours in the order with a common prefix of LENGTH bytes are repeated
strings.

A passage in very many contexts has an anchor with very many different stretches, which don't meet in one task. Equal
windows have the anchor at the same place, so beyond ``MOST`` stretches their windows are dealt out by the anchor's place
in blocks of ``BLOCK``, and by the digest of the bytes that all windows of a block have in common (the core). Blocks whose
core occurs once hold no repeats and go; the others are sorted like any group. Where even a core has over MOST different
surroundings, each window is a block of its own and all of it is core, so a group holds equal strings only and its size says
whether they repeat.

Defined cases: null and empty texts, and texts shorter than LENGTH, lose nothing; repeated rows are documents of their own, so
they repeat each other; a null doc_id is a value like another; other columns are ignored; an empty table gives no rows;
a very long text is cut into parts of ``PART`` bytes that overlap by LENGTH - 1, so every window is in one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import flat_bytes, mapped, mix, prefix_hash, slice_hash, steps, stored

LENGTH, GRAM = 400, 64
#: Different stretches of an anchor that one task sorts; windows sorted together; bytes of the shallow depth.
MOST, TOGETHER, SHALLOW = 1500, 1 << 19, 32
#: Places of an anchor in a block of windows; bytes of a text that one step works on.
BLOCK, PART = 16, 1 << 21
#: Low bits of a key that hold a place; the other bits hold the start of the k-gram's hash.
PLACE_BITS = np.uint64(28)
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two keys that tell documents apart; rows that repeat a document share them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("k1", F.coalesce("doc_id", F.lit(-1))).withColumn("k2", F.xxhash64("doc_id", "text"))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by running minima within blocks from both sides."""
    n = len(values) - width + 1
    blocks = np.full((-(-len(values) // width) + 1, width), np.iinfo(np.uint64).max, np.uint64)
    blocks.ravel()[: len(values)] = values
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def digests(raw: bytes, start: np.ndarray, end: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each string equals the one before, 128-bit digest of each that doesn't). maybe: where equality is to be tested."""
    equal = maybe.copy()
    for i in np.flatnonzero(maybe).tolist():
        equal[i] = raw[start[i - 1] : end[i - 1]] == raw[start[i] : end[i]]
    found = b"".join([digest(raw[a:b]) for a, b in zip(start[~equal].tolist(), end[~equal].tolist(), strict=True)])
    return equal, np.frombuffer(found, np.int64).reshape(-1, 2)


def stretches(flat: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, start, windows, times, anchor hash, anchor's place in the first window, digests) of the stretches of several texts laid end to end.

    times: so many equal stretches follow each other (short periods); start counts from the text's first byte.
    """
    empty = np.zeros(0, np.int64)
    if len(flat) < length:
        return (*[empty] * 6, np.zeros((0, 2), np.int64))
    prefix = prefix_hash(flat)
    n = len(flat) - gram + 1
    grams = slice_hash(prefix, np.arange(n), np.arange(gram, n + gram))
    key = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(n, dtype=np.uint64)
    anchor = (least_in_windows(key, length - gram + 1) & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    inside = np.zeros(len(flat) + 1, np.int64)  # places where a window of one text can start
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    has = windows > 0
    inside[offsets[:-1][has]] += 1
    np.add.at(inside, (offsets[:-1] + windows)[has], -1)
    valid = np.cumsum(inside)[: len(anchor)] > 0
    head = valid.copy()
    head[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    head[offsets[:-1][has]] = True
    start = np.flatnonzero(head)
    row = np.searchsorted(offsets, start, "right") - 1
    row_end = offsets[row] + windows[row]
    end = np.minimum(np.append(start[1:], len(flat)), row_end)
    maybe = np.zeros(len(start), bool)
    maybe[1:] = (row[1:] == row[:-1]) & (np.diff(end) == np.diff(start)) & (grams[anchor[start[1:]]] == grams[anchor[start[:-1]]])
    equal, text = digests(flat.tobytes(), start, end + length - 1, maybe)
    first = np.flatnonzero(~equal)
    times = np.diff(np.append(first, len(start)))
    start, end, row = start[first], end[first], row[first]
    return row, start - offsets[row], end - start, times, grams[anchor[start]].view(np.int64), anchor[start] - start, text


def parts(offsets: np.ndarray, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row, first byte, last byte) of each step; a row of more than PART bytes has several, which overlap."""
    for i, j in steps(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        for p in range(a, max(a + 1, b - overlap), PART):
            yield i, j, p, min(b, p + PART + overlap)


FOUND = "k1 long, k2 long, a long, s1 long, s2 long, place int, start long, n int, times int"


def found_stretches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            flat, offsets = flat_bytes(batch.column("text"))
            for i, j, p, q in parts(offsets, length - 1):
                at = np.clip(offsets[i : j + 1], p, q) - p
                row, start, n, times, a, place, s = stretches(flat[p:q], at, length, gram)
                start = start + at[row] + p - offsets[i + row]
                columns = (k1[i + row], k2[i + row], a, s[:, 0], s[:, 1], place.astype(np.int32), start, n.astype(np.int32), times.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in FOUND.split(", ")])

    return mapped(docs.select("k1", "k2", "text"), run, FOUND)


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    high = min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    low = 0
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Sorts strings by branching bytes only: a blind descent to some leaf, one comparison with it, one insertion."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | int = 0
        for i in range(1, len(strings)):
            self.insert(i)

    def insert(self, i: int) -> None:
        x, node = self.strings[i], self.root
        while isinstance(node, list):  # [depth, {byte or -1 at an end: child}]
            depth, children = node
            node = children.get(x[depth] if depth < len(x) else -1)
            if node is None:
                node = next(iter(children.values()))
        y = self.strings[node]
        at = common(x, y)
        mine, other = x[at] if at < len(x) else -1, y[at] if at < len(y) else -1
        above, node, step = None, self.root, -1
        while isinstance(node, list) and node[0] < at:
            above, step = node, x[node[0]] if node[0] < len(x) else -1
            node = node[1][step]
        if isinstance(node, list) and node[0] == at:
            node[1][min(node[1]) - 1 if mine in node[1] else mine] = i  # equal strings end in one place
            return
        new = [at, {mine: i, other: node}] if mine != other else [at, {-1: i, -2: node}]
        if above is None:
            self.root = new
        else:
            above[1][step] = new

    def sorted(self) -> tuple[list[int], list[int]]:
        """String numbers in order, and the common prefix of each with the one before (0 for the first)."""
        order, shared, stack = [], [], [(self.root, 0)]
        while stack:
            node, before = stack.pop()
            if isinstance(node, list):
                depth, children = node
                for k, byte in enumerate(sorted(children, reverse=True)):
                    stack.append((children[byte], before if k == len(children) - 1 else depth))
            else:
                order.append(node)
                shared.append(before)
        return order, shared


def repeated_windows(texts: list[bytes], windows: np.ndarray, length: int, shallow: int = SHALLOW) -> np.ndarray:
    """Of each window, all texts' one after another, whether its string starts in another place too."""
    flat = np.frombuffer(b"".join(texts) + bytes(shallow + 8), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size) - size
    first = np.cumsum(windows) - windows
    total = int(windows.sum())
    place = np.repeat(begin - first, windows) + np.arange(total)
    symbols = np.ndarray((len(flat) - 7,), ">u8", flat.data, strides=(1,)).astype(np.uint64)
    # multikey sorting: one eight-byte symbol at a time, only within groups that are still equal
    rows, group = np.arange(total), np.zeros(total, np.int64)
    for depth in range(0, shallow, 8):
        symbol = symbols[place[rows] + depth]
        order = np.lexsort((symbol, group))
        rows, group, symbol = rows[order], group[order], symbol[order]
        new = np.ones(len(rows), bool)
        new[1:] = (group[1:] != group[:-1]) | (symbol[1:] != symbol[:-1])
        group = np.cumsum(new) - 1
        shared = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
        rows, group = rows[shared], group[shared]
        if not len(rows):
            return np.zeros(total, bool)
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    group = np.cumsum(new) - 1
    at = np.append(np.flatnonzero(new), len(rows))
    members = np.diff(at)
    group_of = np.full(total + 1, -1, np.int64)
    group_of[rows] = group
    last = np.zeros(total, bool)
    last[(first + windows - 1)[windows > 0]] = True
    follower = np.where(last[rows], -1, group_of[rows + 1])
    low, high = np.minimum.reduceat(follower, at[:-1]), np.maximum.reduceat(follower, at[:-1])
    follows = np.where((low == high) & (low >= 0) & (members[np.maximum(low, 0)] == members), low, -1)
    follows[follows == np.arange(len(follows))] = -1  # a run of one byte
    reach = np.ones(len(members), np.int64)  # groups that keep this group's order, itself included
    headed = np.ones(len(members), bool)
    headed[follows[follows >= 0]] = False
    text_of = np.repeat(np.arange(len(texts)), windows)
    marks = np.zeros(total + 1, np.int64)
    seen = np.zeros(len(members), bool)

    def settle(g: int) -> None:
        n, k = 0, g
        while k >= 0 and not seen[k]:
            seen[k] = True
            n, k = n + 1, int(follows[k])
        reach[g] = n
        own = np.sort(rows[at[g] : at[g + 1]])
        strings = [texts[t][p - b :] for t, p, b in zip(text_of[own].tolist(), place[own].tolist(), begin[text_of[own]].tolist(), strict=True)]
        if len(strings) == 2:
            order, shared = [0, 1], [0, common(*strings)]
        else:
            order, shared = BlindTrie(strings).sorted()
        near = np.array([*shared, 0])
        runs = np.minimum(np.maximum(near[:-1], near[1:]) - length + 1, n)
        hit = runs > 0
        np.add.at(marks, own[order][hit], 1)
        np.add.at(marks, (own[order] + runs)[hit], -1)

    for g in np.flatnonzero(headed).tolist():
        settle(g)
    for g in np.flatnonzero(~seen).tolist():  # groups that follow each other in a ring
        if not seen[g]:
            settle(g)
    return np.cumsum(marks)[:-1] > 0


def ranges(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"f": int(f), "t": int(t)} for f, t in zip(edge[::2], edge[1::2], strict=True)]


RANGES = "array<struct<f:int,t:int>>"
_RANGES = pa.list_(pa.struct([("f", pa.int32()), ("t", pa.int32())]))
#: A different stretch: anchor hash and digest.
KEY = ("a", "s1", "s2")
PIECES = "a long, s1 long, s2 long, place int, n int, times long, bytes binary"


def batch_of(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """A batch from rows of plain values; schema names the columns in Spark's words."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), RANGES: _RANGES}
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def cut(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """PIECES: one text of each wanted stretch."""
    by_doc = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct(*KEY, "place", "start", "n", "times")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(batch.column("text"), batch.column("own").to_pylist(), strict=True):
                raw = text.as_py().encode()
                out += [(r["a"], r["s1"], r["s2"], r["place"], r["n"], r["times"], raw[r["start"] : r["start"] + r["n"] + length - 1]) for r in own]
            yield batch_of(PIECES, out)

    # a repeated document row sends its stretches again
    return mapped(docs.select("k1", "k2", "text").join(by_doc, ["k1", "k2"]).select("text", "own"), run, PIECES).dropDuplicates([*KEY])


SOLVED = f"a long, s1 long, s2 long, found {RANGES}"


def sorted_groups(groups: DataFrame, length: int) -> DataFrame:
    """SOLVED: repeated windows of each stretch, by sorting all stretches of a group together.

    groups: g1, g2 (the group), a, s1, s2, f (the first window's place in the stretch), n, times, bytes."""

    def solve(held: list[dict]) -> Iterator[pa.RecordBatch]:
        n = np.array([r["n"] for r in held], np.int64)
        flags = repeated_windows([r["bytes"] for r in held], n, length)
        at = np.cumsum(n) - n
        found = [[{"f": 0, "t": r["n"]}] if r["times"] > 1 else ranges(flags[at[i] : at[i] + r["n"]]) for i, r in enumerate(held)]
        yield batch_of(SOLVED, [(r["a"], r["s1"], r["s2"], [{"f": x["f"] + r["f"], "t": x["t"] + r["f"]} for x in y]) for r, y in zip(held, found, strict=True) if y])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                if size >= TOGETHER and (r["g1"], r["g2"]) != (held[-1]["g1"], held[-1]["g2"]):
                    yield from solve(held)
                    held, size = [], 0
                held.append(r)
                size += r["n"]
        if held:
            yield from solve(held)

    return mapped(groups.repartition("g1", "g2").sortWithinPartitions("g1", "g2"), run, SOLVED)


CORES = "a long, s1 long, s2 long, f int, n int, times long, g1 long, g2 long"


def cores(pieces: DataFrame, length: int, block: int) -> DataFrame:
    """CORES: the windows of each stretch in blocks by the anchor's place, under the digest of the bytes that any window of the block has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                f = 0
                while f < r["n"]:
                    place = r["place"] - f
                    low = place // block * block
                    n = min(place - low + 1, r["n"] - f)
                    core = r["bytes"][r["place"] - low : r["place"] - low - block + 1 + length]
                    g1, g2 = np.frombuffer(digest(core + low.to_bytes(4)), np.int64).tolist()
                    out.append((r["a"], r["s1"], r["s2"], f, n, r["times"], g1, g2))
                    f += n
            yield batch_of(CORES, out)

    return mapped(pieces, run, CORES)


def block_texts(pieces: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """The blocks with their bytes, in the form of sorted_groups."""
    own = blocks.groupBy(*KEY).agg(F.collect_list(F.struct("f", "n", "g1", "g2")).alias("own"))  # as many as a stretch has blocks
    kind = "g1 long, g2 long, a long, s1 long, s2 long, f int, n int, times long, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(kind, [(o["g1"], o["g2"], r["a"], r["s1"], r["s2"], o["f"], o["n"], r["times"], r["bytes"][o["f"] : o["f"] + o["n"] + length - 1]) for r in batch.to_pylist() for o in r["own"]])

    return mapped(pieces.join(own, [*KEY]).select(*KEY, "times", "bytes", "own"), run, kind)


def dealt_out(pieces: DataFrame, length: int, most: int) -> DataFrame:
    """SOLVED for the stretches of anchors that have too many for one task."""
    block = min(BLOCK, length)
    all_blocks = stored(cores(pieces, length, block))
    often = all_blocks.groupBy("g1", "g2").agg(F.sum("times").alias("all"), F.count("*").alias("different")).where("all > 1").select("g1", "g2", (F.col("different") > most).alias("large"))
    blocks = stored(all_blocks.join(stored(often), ["g1", "g2"]))
    solved = sorted_groups(block_texts(pieces, blocks.where("NOT large"), length), length)
    large = blocks.where("large")
    if not large.isEmpty():
        own = large.select(*KEY, F.col("f").alias("f0"), F.col("n").alias("n0"))
        single = stored(cores(pieces.join(large.select(*KEY).distinct(), [*KEY], "left_semi"), length, 1).join(own, [*KEY]).where("f >= f0 AND f < f0 + n0").drop("f0", "n0"))
        often = single.groupBy("g1", "g2").agg(F.sum("times").alias("all")).where("all > 1").drop("all")
        solved = solved.unionByName(single.join(often, ["g1", "g2"]).select(*KEY, F.array(F.struct("f", (F.col("f") + 1).alias("t"))).alias("found")))
    return solved.groupBy(*KEY).agg(F.flatten(F.collect_list("found")).alias("found"))  # a stretch has LENGTH windows at most


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(k1, k2, spans): the windows of each keyed document whose strings start elsewhere too, as ranges."""
    every = stored(found_stretches(docs, length, gram))
    same = (F.min("s1") == F.max("s1")) & (F.min("s2") == F.max("s2"))
    anchors = stored(every.groupBy("a").agg(F.sum("times").alias("all"), same.alias("one")).where("all > 1").drop("all"))
    shared = stored(every.join(anchors, "a"))
    whole = shared.where("one").select("k1", "k2", F.array(F.struct(F.col("start").alias("f"), (F.col("start") + F.col("n") * F.col("times")).alias("t"))).alias("spans"))
    mixed = shared.where("NOT one")
    texts = stored(mixed.groupBy(*KEY).agg(F.sum("times").alias("times"), F.min(F.struct("k1", "k2", "start", "n", "place")).alias("r")).select(*KEY, "times", "r.*"))
    large = stored(texts.groupBy("a").agg(F.count("*").alias("different")).where(F.col("different") > most).select("a"))
    pieces = stored(cut(docs, texts, length))
    small = pieces.join(large, "a", "left_anti")
    solved = sorted_groups(small.select(F.col("a").alias("g1"), F.lit(0).cast("long").alias("g2"), *KEY, F.lit(0).alias("f"), "n", "times", "bytes"), length)
    if not large.isEmpty():
        solved = solved.unionByName(dealt_out(stored(pieces.join(large, "a", "left_semi")), length, most))
    solved = stored(solved)  # one row for each stretch, so the join makes one for each occurrence at most
    spans = F.expr("transform(found, x -> struct(start + x.f AS f, IF(times > 1, start + n * times, start + x.t) AS t))")
    return whole.unionByName(mixed.join(solved, [*KEY]).select("k1", "k2", spans.alias("spans"))).groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def covered(n_bytes: int, spans: list[dict], length: int) -> np.ndarray:
    """Of each byte whether a window that starts in one of the ranges covers it."""
    cover = np.zeros(n_bytes + 1, np.int64)
    np.add.at(cover, [s["f"] for s in spans], 1)
    np.add.at(cover, [s["t"] + length - 1 for s in spans], -1)
    return np.cumsum(cover)[:-1] > 0


def removals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """What is left of each document without its repeated strings. Columns: SCHEMA."""
    own = keyed(docs)
    found = repeated(own, length, gram, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                raw = np.frombuffer(text.as_py().encode(), np.uint8)
                gone = covered(len(raw), spans, length) if spans else np.zeros(len(raw), bool)
                n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((len(raw), int(gone.sum()), n_spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return mapped(own.join(found, ["k1", "k2"], "left").select("doc_id", "text", "spans"), run, SCHEMA)
