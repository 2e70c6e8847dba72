"""Hartigan's dip statistic in NumPy, and its significance against uniform samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.params import DEFAULT, Params

#: Sample sizes of the reference distribution, draws for each, and their seed. A p-value of 0.05 has a standard error of 0.007
#: by the draws; beyond the largest size sqrt(n) * dip has its limit distribution, so the last row stands for all.
SIZES, DRAWS, SEED = (4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 50, 100, 200), 1000, 20_240
#: Tasks that draw.
BLOCKS = 10


def chain(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The place before each one on the greatest convex minorant of the points up to it; 0 for the first.

    What a new point takes off the minorant never comes back, so all places together take time in proportion to their number."""
    xs, ys = x.tolist(), y.tolist()
    before = [0] * len(xs)
    for i in range(1, len(xs)):
        j = i - 1
        while j:
            k = before[j]
            if (ys[j] - ys[k]) * (xs[i] - xs[k]) < (ys[i] - ys[k]) * (xs[j] - xs[k]):
                break
            j = k
        before[i] = j
    return np.array(before)


def vertices(before: np.ndarray, first: int, last: int) -> np.ndarray:
    """The places of a minorant from first, one of its places, to last."""
    out = [last]
    while out[-1] > first:
        out.append(int(before[out[-1]]))
    return np.array(out[::-1])


def dip(values: np.ndarray) -> float:
    """Largest distance of the empirical distribution from the nearest unimodal one.

    The modal interval is narrowed to where minorant and majorant are furthest apart, until what lies outside is further
    from its envelope than they are from each other. Its ends are places of the minorant of all points and of the majorant, so
    both envelopes of any such interval are parts of two chains that are made once."""
    n = len(values)
    x, counts = np.unique(np.asarray(values, float), return_counts=True)
    if len(x) == 1 or n < 4:
        return 1 / (2 * max(n, 1))
    high = np.cumsum(counts) / n
    low = high - counts / n
    last = len(x) - 1
    up, down = chain(x, low), chain(-x[::-1], -high[::-1])
    lo, hi, found = 0, last, 1 / n
    while hi > lo:
        left, right = vertices(up, lo, hi), last - vertices(down, last - hi, last - lo)[::-1]
        at = x[lo : hi + 1]
        minorant, majorant = np.interp(at, x[left], low[left]), np.interp(at, x[right], high[right])
        at_left, at_right = majorant[left - lo] - low[left], high[right] - minorant[right - lo]
        gap = max(at_left.max(), at_right.max())
        if gap <= found:
            break
        if at_right.max() > at_left.max():
            b = int(right[at_right.argmax()])
            a = int(left[left <= b][-1])
        else:
            a = int(left[at_left.argmax()])
            b = int(right[right >= a][0])
        outside = max((high[lo : a + 1] - minorant[: a - lo + 1]).max(), (majorant[b - lo :] - low[b : hi + 1]).max())
        found = max(found, outside)
        if (a, b) == (lo, hi):
            break
        lo, hi = a, b
    return found / 2


def draws(spark: SparkSession) -> DataFrame:
    """n, scaled: sqrt(n) * dip of seeded uniform samples of each size, drawn by tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                random = np.random.default_rng([SEED, n, block])
                found = [np.sqrt(n) * dip(random.random(n)) for _ in range(DRAWS // BLOCKS)]
                yield pa.RecordBatch.from_arrays([pa.array([n] * len(found), pa.int32()), pa.array(found, pa.float64())], names=["n", "scaled"])

    every = spark.createDataFrame([(n, block) for block in range(BLOCKS) for n in SIZES], "n int, block int")
    return every.repartition(BLOCKS, "block").mapInArrow(run, "n int, scaled double")


_tables: dict[str, dict[int, np.ndarray]] = {}


def reference_table(spark: SparkSession) -> dict[int, np.ndarray]:
    """The draws of each size in order; drawn once by an application."""
    key = spark.sparkContext.applicationId
    if key not in _tables:
        found = draws(spark).toArrow()  # len(SIZES) * DRAWS numbers
        n, scaled = found.column("n").to_numpy(), found.column("scaled").to_numpy()
        _tables.clear()
        _tables[key] = {k: np.sort(scaled[n == k]) for k in SIZES}
    return _tables[key]


def p_value(values: np.ndarray, table: dict[int, np.ndarray]) -> float:
    n = len(values)
    if n < 4 or np.ptp(values) == 0:
        return 1.0
    scaled = np.sqrt(n) * dip(values)
    sizes = np.array(sorted(table))
    tail = [1 - np.searchsorted(table[k], scaled, "left") / len(table[k]) for k in sizes]
    return float(np.interp(np.sqrt(n), np.sqrt(sizes), tail))


def modality(clean: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """DRUGS_ID, DRUG_CLASS, DIP_PVALUE of the shares of each product. A product has at most one share a market."""
    table = reference_table(clean.sparkSession)

    def test(shares) -> float:
        return p_value(np.asarray(shares, float), table) if len(shares) >= p.min_n_for_dip else 1.0

    udf = F.udf(lambda values: float(test(values)), "double", useArrow=True)
    lists = clean.groupBy("DRUGS_ID").agg(F.array_sort(F.collect_list("SHARE_INTERNAL")).alias("shares"))
    tested = lists.select("DRUGS_ID", udf("shares").alias("p"))
    return tested.select("DRUGS_ID", F.when(F.col("p") < p.dip_alpha, "MULTIMODAL").otherwise("UNIMODAL").alias("DRUG_CLASS"), F.round("p", 6).alias("DIP_PVALUE"))
