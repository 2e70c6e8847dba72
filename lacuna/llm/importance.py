"""Target-distribution importance resampling: n-gram buckets weigh documents, and the top of weight plus noise is drawn.

Bucket counts of the corpus and of the target come from all rows, a pre-summed array for each task. A document's weight is
the floored mean of its features' gains, read from an array of one gain a bucket; a hash of its id adds Gumbel noise, so the
highest scores are a draw without replacement in proportion to exp(weight / 1000).

Scores are whole numbers of a bounded range (doubles' logarithms; some 200000 values at most, whatever the input), so their
exact histogram goes to the driver: counts summed from above give each score its first rank and find the cutoff. Only
surviving scores are numbered by doc_id, each by itself; scores of over ``CROWD`` rows in slices by doc_id, which have
first ranks of their own. Equal rows are counted before they are numbered, so no id can crowd a task.

CRC-32 is linear: a word's is the exclusive or of one table entry for each byte and its distance from the word's end, and
that of a run is made from its words', so no byte is read twice and none by a loop.

Defined cases: null and empty texts have no features, weight 0 and no rank; rows count one by one, also those of one
doc_id, and ties of score and doc_id go by n_features, then weight; a null doc_id is drawn as the empty string and comes before others of its
score; other columns are ignored; an empty table gives no rows, an empty target gains from the corpus alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.llm.text import WORD_BYTE, Words, doc_texts, flat_bytes, mapped, steps, stored

BUCKETS, LONGEST = 10000, 2
#: Rows of one score that one task numbers; copies of a row that are made at a time.
CROWD, COPIES = 1 << 20, 4096

#: Words of more bytes than this are summed by zlib.
REACH = 255


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a byte's share by distance from the end, the sum of so many zeros, that of a space before so many zeros, moves of a sum by so many bytes)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    ahead = lambda x: step[x & 0xFF] ^ (x >> np.uint32(8))
    shares = np.empty((REACH + 1, 256), np.uint32)
    moves = np.empty((REACH + 2, 4, 256), np.uint32)
    shares[0] = step
    moves[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for i in range(1, REACH + 1):
        shares[i] = ahead(shares[i - 1])
    for i in range(1, REACH + 2):
        moves[i] = ahead(moves[i - 1])
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)
    space = np.array([zlib.crc32(b" " + bytes(n)) ^ zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)
    return shares.ravel(), zeros, space, moves.ravel()


SHARES, ZEROS, SPACE, MOVES = _tables()


def moved(sums: np.ndarray, by: np.ndarray) -> np.ndarray:
    """What CRC-32 sums turn to when so many bytes follow."""
    at = by.astype(np.int64) * 1024
    out = MOVES[at + (sums & 0xFF)]
    for k in (1, 2, 3):
        out ^= MOVES[at + 256 * k + ((sums >> np.uint32(8 * k)) & 0xFF)]
    return out


def feature_sums(flat: np.ndarray, offsets: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(CRC-32, row) of the features of texts laid end to end, for runs of 1, 2 ... words."""
    words = Words(flat, offsets)
    size = words.end - words.start
    letters = WORD_BYTE[flat]
    letters = letters[letters != 0]
    last = np.cumsum(size)
    far = np.repeat(last, size) - 1 - np.arange(len(letters))
    run = np.zeros(len(letters) + 1, np.uint32)
    np.bitwise_xor.accumulate(SHARES[np.minimum(far, REACH) * 256 + letters], out=run[1:])
    single = run[last] ^ run[last - size] ^ ZEROS[np.minimum(size, REACH)]
    long = np.flatnonzero(size > REACH)
    texts = {int(i): letters[last[i] - size[i] : last[i]].tobytes() for i in long}
    for i, text in texts.items():
        single[i] = zlib.crc32(text)
    yield single, words.doc
    run_sums = single
    for n in range(2, longest + 1):
        if len(run_sums) < 2:
            return
        add = single[n - 1 :]
        by = np.minimum(size[n - 1 :], REACH)
        run_sums, before = moved(run_sums[:-1], by + 1) ^ SPACE[by] ^ add, run_sums
        for i in long[long >= n - 1] - (n - 1):
            run_sums[i] = zlib.crc32(b" " + texts[int(i) + n - 1], int(before[i]))
        inside = words.doc[: -(n - 1)] == words.doc[n - 1 :]
        yield run_sums[inside], words.doc[: -(n - 1)][inside]


def feature_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features in each bucket over all rows of ``text``; a task sums its rows first, and ``buckets`` rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            flat, offsets = flat_bytes(batch.column(0))
            for i, j in steps(offsets):
                for sums, _ in feature_sums(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], longest):
                    found += np.bincount(sums % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in mapped(texts.select("text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row for each bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of how much likelier each bucket is in the target), both smoothed by one."""
    buckets = float(len(corpus))
    up = (target + 1).astype(np.float64) * (float(corpus.sum()) + buckets)
    down = (corpus + 1).astype(np.float64) * (float(target.sum()) + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight of each document."""
    buckets = np.uint32(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = flat_bytes(batch.column(1))
            rows = len(offsets) - 1
            words, features, total = (np.zeros(rows, np.int64) for _ in range(3))
            for i, j in steps(offsets):
                for n, (sums, doc) in enumerate(feature_sums(flat[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], longest)):
                    count = np.bincount(doc, minlength=j - i)
                    if n == 0:
                        words[i:j] = count
                    features[i:j] += count
                    so_far = np.concatenate([[0], np.cumsum(gains[sums % buckets])])
                    ends = np.cumsum(count)
                    total[i:j] += so_far[ends] - so_far[ends - count]
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (words, features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return mapped(doc_texts(docs), run, "doc_id long, n_words long, n_features long, weight long")


def with_scores(weights: DataFrame, seed: int) -> DataFrame:
    """score: the weight and 1000 times a Gumbel draw that a hash of seed and doc_id makes, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = (F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return weights.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(drawn))).cast("long"))


def first_ranks(counts: dict[tuple, int], order) -> dict[tuple, int]:
    """How many rows come before each key."""
    out, before = {}, 0
    for key in sorted(counts, key=order):
        out[key] = before
        before += counts[key]
    return out


def drawn(scored: DataFrame, percent: int = 25, min_words: int = 20, crowd: int = CROWD) -> DataFrame:
    """The rows of scored, a stored table, with ``rank``: 1 ... for the ``percent`` of eligible documents of the highest scores, ties to smaller doc_id; null for the rest."""
    spark = scored.sparkSession
    able = F.col("n_words") >= min_words
    histogram = {r.score: r.n for r in scored.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()}  # bounded, see above
    wanted = percent * sum(histogram.values()) // 100
    first = first_ranks(histogram, lambda s: -s)
    kept = [s for s, before in first.items() if before < wanted]
    columns = ["doc_id", "n_features", "weight", "score"]
    if not kept:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    cutoff = min(kept)
    survives = able & (F.col("score") >= cutoff)
    rest = scored.where(~survives).select(*columns, F.lit(None).cast("long").alias("rank"))
    rows = scored.where(survives).groupBy(*columns).agg(F.count("*").alias("copies"))

    crowded = [s for s in kept if histogram[s] > crowd]
    ids = F.coalesce("doc_id", F.lit(-(2**63)))
    ranks = {(s, 0): first[s] for s in kept}
    rows = rows.withColumn("slice", F.lit(0))
    if crowded:
        ends = {}
        for s, n, found in scored.where(survives & F.col("score").isin(crowded)).groupBy("score").agg(F.count("*"), F.percentile_approx(ids, [i / 64 for i in range(1, 64)], 1000)).collect():  # 63 ids of each crowded score
            pieces = min(64, -(-n // crowd))
            ends[s] = sorted({found[round(i * 64 / pieces) - 1] for i in range(1, pieces)})
        table = spark.createDataFrame([(s, e) for s, e in ends.items()], "score long, ends array<long>")
        sliced = rows.drop("slice").join(F.broadcast(table), "score", "left")  # a row for each crowded score
        rows = stored(sliced.withColumn("slice", F.coalesce(F.size(F.filter("ends", lambda e: e < ids)), F.lit(0))).drop("ends"))
        counts = {(r.score, r.slice): r.n for r in rows.where(F.col("score").isin(crowded)).groupBy("score", "slice").agg(F.sum("copies").alias("n")).collect()}
        ranks |= {k: first[k[0]] + v for s in crowded for k, v in first_ranks({k: n for k, n in counts.items() if k[0] == s}, lambda k: k[1]).items()}
    offsets = spark.createDataFrame([(*k, v) for k, v in ranks.items()], "score long, slice int, before long")
    order = Window.partitionBy("score", "slice").orderBy("doc_id", "n_features", "weight").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("end", F.sum("copies").over(order)).join(F.broadcast(offsets), ["score", "slice"])  # the histogram's scores
    start = F.col("before") + F.col("end") - F.col("copies")
    blocks = numbered.withColumn("done", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES).cast("long")))).withColumn("done", F.col("done") * COPIES)
    each = blocks.withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("copies") - F.col("done"), F.lit(COPIES).cast("long")))))
    rank = start + F.col("done") + F.col("place")
    return rest.unionByName(each.select(*columns, F.when(rank <= wanted, rank).alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = BUCKETS, longest: int = LONGEST, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; those with a rank are the draw."""
    gains = bucket_gains(feature_counts(docs, buckets, longest), feature_counts(target, buckets, longest))
    return drawn(stored(with_scores(weighed(docs, gains, longest), seed)), percent, min_words, crowd)
