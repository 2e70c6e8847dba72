"""Near-duplicate documents by ProbMinHash over weighted word shingles, banding, and exact verification.

A document is the set of its five-word shingles, each with the weight 1 + ln(occurrences). Every shingle is a Poisson
process: its arrivals, divided by its weight, fall on random registers, and a register keeps the earliest. A process ends
once its next arrival is later than every register of its document, so most end after one or two arrivals. Registers of
two documents agree with their probability Jaccard similarity. Bands of registers propose pairs; a pair is a link if the
exact Jaccard similarity of its shingle sets is at least the threshold. That similarity knows no occurrences, and unequal ones
lower the weighted one without bound, so every document has bands of the same process with all weights 1, too; these are the
weighted ones where no shingle is repeated.

Texts of equal word sequences become one node before any pair is looked at: equal means equal in 128 bits, of which 64 name
the node, and nodes of one name whose other bits differ are named anew. Within a bucket of a band each node is compared
with the bucket's centre, drawn by hash; then nodes and centres that are still in different components; then the nodes
of different components that still share a bucket. Pairs within a component are implied and never made. In large buckets
the last step makes the pairs that have a rare shingle in common, and bounds the others by the number of frequent shingles
of either text and by bitmaps of their shingles: a bit that only one text has stands for a shingle that the other lacks.
Both bounds are exact, and no step has a cap. A large bucket is dealt out to several tasks, each with some of its nodes.

Defined cases: texts of one to four words have one shingle, all of them; texts without words match only equal texts; a null
text is empty; repeated rows and equal texts are one class; the class id is the smallest doc_id of the class (null only if
all are null); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import Words, flat_bytes, mapped, mix, steps, stored

SHINGLE, THRESHOLD = 5, 0.8
#: 26 bands of 5 registers: a pair of similarity 0.8 shares no band of weights 1 with a probability of 3e-5, whatever its
#: occurrences. The weighted bands, as many, only add to that.
BANDS, BAND_ROWS = 26, 5
REGISTERS = BANDS * BAND_ROWS
#: Members of one centre that a task compares with it; a centre of more members is sent to several tasks.
FAN = 128
#: Members beyond which a bucket's remaining pairs are bounded before they are made.
LARGE = 48
#: Nodes that may share a rare shingle; pairs with one in common are made from it, at most so many for each node and shingle.
RARE = 16
#: 64-bit masks of a node of a large bucket; each shingle sets one bit.
MASKS = 8
#: Nodes of a large bucket that meet in a task.
DEALT = 512


def shingles(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, occurrences) of distinct shingles, by document and shingle."""
    at = np.arange(len(words.hash))
    full = at + width <= words.first[1:][words.doc] if len(at) else np.zeros(0, bool)
    start = at[full]
    short = np.flatnonzero((words.count > 0) & (words.count < width))
    doc = np.concatenate([words.doc[start], short])
    # one mixed addend for each word and its place, so places can't cancel out
    factor = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    full_value, short_value = np.zeros(len(start), np.uint64), np.zeros(len(short), np.uint64)
    for k in range(width):
        full_value += words.hash[start + k] * factor[k]
        more = words.count[short] > k
        short_value[more] += words.hash[words.first[short[more]] + k] * factor[k]
    value = mix(np.concatenate([full_value, short_value]))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return doc[first], value[first], np.diff(np.append(first, len(doc)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, registers: int = REGISTERS) -> np.ndarray:
    """docs x registers: the element whose arrival is the earliest in each register (0 where a document has none)."""
    earliest = np.full(docs * registers, np.inf)
    winner = np.zeros(docs * registers, np.uint64)
    latest = np.full(docs, np.inf)
    time, arrival = np.zeros(len(doc)), 0
    while len(doc):
        arrival += 1
        random = mix(element ^ np.uint64((arrival * 0xD1342543DE82EF95) & (2**64 - 1)))
        time = time - np.log1p(-(random >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight
        open_ = time < latest[doc]
        if not open_.all():
            doc, element, weight, time, random = doc[open_], element[open_], weight[open_], time[open_], random[open_]
        place = doc * registers + (mix(random) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, place, time)
        won = earliest[place] == time
        winner[place[won]] = element[won]
        own = np.unique(doc)
        latest[own] = earliest.reshape(docs, registers)[own].max(axis=1)
        open_ = time < latest[doc]
        doc, element, weight, time = doc[open_], element[open_], weight[open_], time[open_]
    return winner.reshape(docs, registers)


def banded(signature: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """docs x bands: a hash of each band's registers and its number."""
    out = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        out = mix(out + signature[:, r::rows] * np.uint64(2 * r + 3))
    return mix(out ^ np.arange(1, bands + 1, dtype=np.uint64))


def band_lists(doc: np.ndarray, element: np.ndarray, times: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(band hashes laid end to end, how many each document has): with weights 1, then with its weights if a shingle is repeated."""
    plain = banded(signatures(doc, element, np.ones(len(doc)), docs))
    again = np.unique(doc[times > 1])
    own = np.isin(doc, again)
    weighted = banded(signatures(np.searchsorted(again, doc[own]), element[own], 1 + np.log(times[own]), len(again)))
    row = np.concatenate([np.unique(doc), again])
    order = np.argsort(row, kind="stable")
    return np.concatenate([plain[np.unique(doc)], weighted])[order].ravel(), BANDS * np.bincount(row, minlength=docs)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text, more columns, and keys that tell rows apart unless they repeat each other; k1 orders null ids last."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *more).withColumn("k1", F.coalesce("doc_id", F.lit(2**63 - 1))).withColumn("k2", F.xxhash64("doc_id", "text"))


def sequence_hash(hashes: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash of each row's sequence of words: one mixed number for each word and its place, added up."""
    place = np.arange(len(hashes)) - np.repeat(first[:-1], count)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + mix(place.astype(np.uint64))), dtype=np.uint64)])
    return mix(total[first[1:]] - total[first[:-1]] + count.astype(np.uint64))


def nodes_of(words: Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(name, other bits) of each text: of its words in order; of its bytes if it has no words."""
    both = sequence_hash(words.hash, words.first, words.count), sequence_hash(words.check, words.first, words.count)
    for i in np.flatnonzero(words.count == 0).tolist():
        found = np.frombuffer(hashlib.blake2b((texts[i].as_py() or "").encode(), digest_size=16).digest(), np.uint64)
        both[0][i], both[1][i] = found
    return both


SIGNED = "doc_id long, k1 long, k2 long, node long, other long, bands array<long>"


def signed(docs: DataFrame) -> DataFrame:
    """SIGNED: doc_id, keys, node (name and other bits) and band hashes of keyed documents; no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = flat_bytes(batch.column("text"))
            for i, j in steps(offsets):
                own = batch.slice(i, j - i)
                words = Words(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                doc, value, times = shingles(words)
                bands, size = band_lists(doc, value, times, j - i)
                node, other = nodes_of(words, own.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(bands.view(np.int64)))
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("k1"), own.column("k2"), pa.array(node.view(np.int64)), pa.array(other.view(np.int64)), lists], names=[c.split()[0] for c in SIGNED.split(", ")])

    return mapped(docs.select("doc_id", "k1", "k2", "text"), run, SIGNED)


def told_apart(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base, nodes): documents with the names of their nodes, and node, first (keys of its first row), bands of each node.

    Different texts of one name are very rare; they get names that their other bits enter into."""
    while True:
        groups = base.groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("first"), F.first("bands").alias("bands"), F.min("other").alias("low"), F.max("other").alias("high"))
        groups = stored(groups)
        clash = groups.where("low <> high").select("node", F.lit(True).alias("clash"))
        if clash.isEmpty():
            return base, groups.drop("low", "high")
        base = stored(base.join(clash, "node", "left").withColumn("node", F.when(F.col("clash"), F.xxhash64("node", "other")).otherwise(F.col("node"))).drop("clash"))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (x, y) whose shingle sets have a Jaccard similarity of at least the threshold. texts: node, text.

    Rows come by y: its own text first, then those of its partners, so a task holds one set at a time."""
    sizes = pairs.groupBy("y").agg(F.ceil(F.count("*") / FAN).cast("int").alias("fans"))
    fans = stored(sizes)
    members = pairs.join(fans, "y").select(F.col("x").alias("node"), "y", F.pmod(F.xxhash64("x"), F.col("fans")).cast("int").alias("fan"))
    members = members.join(texts, "node").select("y", "fan", F.col("node").alias("x"), "text")
    centres = fans.select(F.col("y").alias("node"), F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("fan")).join(texts, "node").select(F.col("node").alias("y"), "fan", F.lit(None).cast("long").alias("x"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre = None, np.zeros(0, np.uint64)
        for batch in batches:
            ys, fans_, xs = (batch.column(c).to_pylist() for c in ("y", "fan", "x"))
            flat, offsets = flat_bytes(batch.column("text"))
            found: list[tuple[int, int]] = []
            for i, j in steps(offsets):
                doc, value, _ = shingles(Words(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                at = np.searchsorted(doc, np.arange(j - i + 1))
                for k in range(i, j):
                    own = value[at[k - i] : at[k - i + 1]]
                    if xs[k] is None:
                        key, centre = (ys[k], fans_[k]), own
                    elif key == (ys[k], fans_[k]) and len(own) and len(centre):
                        place = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
                        both = int((centre[place] == own).sum())
                        if both >= threshold * (len(own) + len(centre) - both):
                            found.append((xs[k], ys[k]))
            if found:
                x, y = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["x", "y"])

    rows = members.unionByName(centres).repartition("y", "fan").sortWithinPartitions("y", "fan", F.col("x").asc_nulls_first())
    return mapped(rows, run, "x long, y long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node that has an edge (x, y) to another; comp is the smallest node of its component.

    Each round hooks every node to its smallest neighbour, halves the paths until all point at a root, and contracts."""
    both = lambda e: stored(e.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    edges, mapping = both(edges), None
    while not edges.isEmpty():
        parent = stored(edges.groupBy("x").agg(F.min("y").alias("p")))
        while True:
            up = parent.select(F.col("x").alias("p"), F.col("p").alias("q"))
            parent = stored(parent.join(up, "p", "left").select("x", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")))
            if parent.where("moved").isEmpty():
                parent = parent.drop("moved")
                break
            parent = parent.drop("moved")
        root = lambda e, c: e.join(parent.select(F.col("x").alias(c), "p"), c, "left").withColumn(c, F.coalesce("p", c)).drop("p")
        edges = both(root(root(edges, "x"), "y"))
        new = parent.select(F.col("x").alias("node"), F.col("p").alias("comp"))
        mapping = new if mapping is None else stored(root(mapping, "comp").unionByName(new.join(mapping, "node", "left_anti")))
    if mapping is None:
        return edges.select(F.col("x").alias("node"), F.col("y").alias("comp"))
    return mapping


def relabelled(comps: DataFrame | None, new: DataFrame) -> DataFrame:
    """Components of ``new`` edges between components, carried over to the nodes of ``comps``."""
    if comps is None:
        return new
    moved = new.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    old = comps.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return stored(old.unionByName(new.join(comps.select("node"), "node", "left_anti")))


def labelled(rows: DataFrame, comps: DataFrame, column: str, name: str) -> DataFrame:
    own = comps.select(F.col("node").alias(column), F.col("comp").alias("found"))
    return rows.join(own, column, "left").withColumn(name, F.coalesce("found", column)).drop("found")


def sharable(nodes: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, shingle) of the shingles that 2 to RARE of these nodes have, and (node, size, live, m0, m1...): how many shingles a
    node has, how many of them more than RARE nodes have, and its masks. A pair without a rare shingle in common shares at most its live ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("node").to_numpy()
            flat, offsets = flat_bytes(batch.column("text"))
            for i, j in steps(offsets):
                doc, value, _ = shingles(Words(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                yield pa.RecordBatch.from_arrays([pa.array(own[i + doc]), pa.array(value.view(np.int64))], names=["node", "shingle"])

    rows = stored(mapped(texts.join(nodes, "node", "left_semi"), run, "node long, shingle long"))
    often = rows.groupBy("shingle").agg(F.count("*").alias("nodes"))
    some = stored(often.where((F.col("nodes") > 1) & (F.col("nodes") <= RARE)).select("shingle"))
    rare = stored(rows.join(some, "shingle"))
    alone = often.where("nodes = 1").join(rows, "shingle").groupBy("node").agg(F.count("*").alias("alone"))
    few = rare.groupBy("node").agg(F.count("*").alias("few"))
    bit = F.expr("shiftleft(1L, int(shiftrightunsigned(shingle, 32) % 64))")
    masks = [F.coalesce(F.bit_or(F.when(F.pmod("shingle", F.lit(MASKS)) == k, bit)), F.lit(0)).alias(f"m{k}") for k in range(MASKS)]
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), *masks).join(alone, "node", "left").join(few, "node", "left")
    return rare, stored(sizes.select("node", "size", (F.col("size") - F.coalesce("alone", F.lit(0)) - F.coalesce("few", F.lit(0))).alias("live"), *(f"m{k}" for k in range(MASKS))))


def remaining(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (x, y) of nodes of different components that share a bucket, less those that can't be links. rows: bucket, node, comp."""
    parts = rows.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    open_ = stored(parts.groupBy("bucket").agg(F.sum("n").alias("members"), F.count("*").alias("comps"), F.max_by("comp", F.struct("n", "comp")).alias("main")).where("comps > 1").drop("comps"))
    left = stored(rows.join(open_, "bucket"))
    found = None
    for large in (False, True):
        own = left.where(F.col("members") > LARGE if large else F.col("members") <= LARGE)
        if large:
            nodes = stored(own.select("node").distinct())
            if nodes.isEmpty():
                continue
            rare, sizes = sharable(nodes, texts)
            comps = own.select("node", "comp").distinct()
            one = rare.join(comps, "node")
            other = one.select("shingle", F.col("node").alias("y"), F.col("comp").alias("cy"))
            found = found.unionByName(one.join(other, "shingle").where("comp <> cy AND node > y").select(F.col("node").alias("x"), "y"))
            kept = sizes.where(F.col("live") + 1e-6 >= threshold * F.col("size")).join(own.groupBy("node").agg(F.collect_set("bucket").alias("all")), "node")
            own = stored(own.join(stored(kept), "node"))
        else:
            own = own.withColumns({"size": F.lit(0), "live": F.lit(0), "all": F.array(F.col("bucket"))} | {f"m{k}": F.lit(0) for k in range(MASKS)})
        salts = F.ceil(F.col("members") / DEALT).cast("int")
        few = own.where("comp <> main").select("bucket", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("size").alias("sx"), F.col("live").alias("lx"), F.col("all").alias("bx"), *(F.col(f"m{k}").alias(f"x{k}") for k in range(MASKS)))
        # a pair comes from its first common bucket; the main component's nodes are on one side only, so no pair of two of them is looked at
        fits = "cx <> comp AND (comp = main OR x > node)"
        if large:
            only_x, only_y = (" + ".join(f"bit_count({a}{k} & ~{b}{k})" for k in range(MASKS)) for a, b in ("xm", "mx"))
            common = f"least(lx, live, sx - ({only_x}), size - ({only_y}))"
            fits += f" AND {common} * {1 + threshold}D + 1e-6D >= {threshold}D * (sx + size) AND array_min(array_intersect(bx, all)) = bucket"
        own = own.withColumn("salt", F.pmod(F.xxhash64("node"), salts).cast("int"))
        pairs = few.join(own, ["bucket", "salt"]).where(fits).select(F.greatest("x", "node").alias("x"), F.least("x", "node").alias("y")).distinct()
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def node_components(nodes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(node, comp) of the nodes that have a link. nodes: node, first, bands."""
    buckets = nodes.select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
    centres = stored(buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("node", "bucket")).alias("centre")).where("n > 1").drop("n"))
    shared = stored(buckets.join(centres, "bucket"))
    asked = stored(shared.select("node").distinct())
    # one row of each node that shares a bucket, with its text
    source = nodes.join(asked, "node", "left_semi").select("node", "first.k1", "first.k2")
    texts = stored(docs.select("k1", "k2", "text").join(source, ["k1", "k2"]).select("node", "text").dropDuplicates(["node"]))
    tested = stored(shared.where("node <> centre").groupBy(F.col("node").alias("x")).agg(F.min("centre").alias("y")))
    comps = components(verified(tested, texts, threshold))
    for step in ("centres", "rest"):
        rows = labelled(shared, comps, "node", "comp")
        if step == "centres":
            rows = labelled(rows, comps, "centre", "other")
            pairs = rows.where("comp <> other").select(F.col("node").alias("x"), F.col("centre").alias("y")).distinct()
        else:
            pairs = remaining(stored(rows.select("bucket", "node", "comp")), texts, threshold)
        either = tested.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        pairs = stored(pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct().join(either, ["x", "y"], "left_anti"))
        if pairs.isEmpty():
            continue
        tested = tested.unionByName(pairs)
        links = verified(pairs, texts, threshold)
        between = labelled(labelled(links, comps, "x", "cx"), comps, "y", "cy").select(F.col("cx").alias("x"), F.col("cy").alias("y"))
        comps = relabelled(comps, components(between))
    return comps


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, and the keys of the row and of the class's first row, of each document."""
    own = keyed(docs)
    base, nodes = told_apart(stored(signed(own)))
    comps = node_components(nodes, own, threshold)
    nodes = stored(labelled(nodes.select("node", "first"), comps, "node", "comp"))
    heads = stored(nodes.groupBy("comp").agg(F.min("first").alias("head")))
    named = stored(nodes.select("node", "comp").join(heads, "comp").select("node", F.col("head.k1").alias("h1"), F.col("head.k2").alias("h2")))
    return base.select("doc_id", "k1", "k2", "node").join(named, "node").select("doc_id", F.when(F.col("h1") < 2**63 - 1, F.col("h1")).alias("class_id"), "k1", "k2", "h1", "h2")


def first_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one document of each class: the one of the smallest doc_id, once even if its row is repeated.

    Of rows that differ in other columns only the smallest one stays, by the columns in their order (any, if one has no order)."""
    found = classes(docs, threshold)
    keep = stored(found.where("k1 = h1 AND k2 = h2").select("k1", "k2").distinct())
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = keyed(docs.select("doc_id", "text", row), "row")
    pick = F.any_value if any(k in docs.schema.simpleString() for k in ("map<", "variant")) else F.min
    return own.join(keep, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(pick("row").alias("row")).select("row.*")
