"""Exact top-k inner products of a stated query set against all rows.

Queries are dealt into blocks of a bounded size and rows into shards. Each pair of a block and a shard is a group of one
shuffle that brings the block's queries first and the shard's rows after them, so a task holds one block and lets the rows
pass. Each product of some queries and a tile of rows is cut to the k best rows of each query by partial selection and
merged into the block's lists; the lists of the groups are then merged in two steps. Nothing goes through the driver, and
more queries mean more blocks, each of which all rows pass once.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, nor do rows without vec_id;
only vectors of the query's length are its candidates; each row counts, repeated ones too, but no row of the query's own
vec_id is its candidate; query rows of one vec_id share one list, as in the SQL: its k best pairs; ties go to the smaller
vec_id; fewer candidates than k give a shorter list; an empty table gives no rows; other columns are ignored. Products are
exact: float64 where all sums stay below 2**53, int64 below 2**63, whole numbers of any size for the rest; a pair whose
product doesn't fit a long isn't listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.llm.text import mapped, stored

#: Bytes of a block's queries and lists, rows of a tile, queries in a product.
BLOCK_BYTES, TILE, QUERIES = 1 << 25, 4096, 512
#: Groups for each task slot; groups whose lists the first merging step takes together.
GROUPS, FAN_IN = 3, 32
#: The score of no candidate.
NONE = np.int64(-(2**63))


def vectors(df: DataFrame) -> DataFrame:
    """The rows that take part. Vectors of floats stay so until a task multiplies them; others are doubles."""
    kind = "array<float>" if dict(df.dtypes)["embedding"] == "array<float>" else "array<double>"
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(good)


def whole(column: pa.Array, scale: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of floor(scale * x)) for each vector length in a list column."""
    at = column.offsets.to_numpy()
    flat = np.floor(scale * column.values.to_numpy(zero_copy_only=False).astype(np.float64))
    lengths = np.diff(at)
    return [(rows, flat[at[rows][:, None] + np.arange(n)]) for n in np.unique(lengths) for rows in [np.flatnonzero(lengths == n)]]


def big_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products in whole numbers of any size; NONE where one doesn't fit 64 bits."""
    whole_numbers = np.vectorize(int, otypes=[object])
    out = whole_numbers(q) @ whole_numbers(c).T if q.size and c.size else np.zeros((len(q), len(c)), object)
    return np.where(np.abs(out) < 2**63, out, int(NONE)).astype(np.int64)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered vectors."""
    n = max(q.shape[1], 1)
    high_q, high_c = np.abs(q).max(axis=1, initial=1.0), np.abs(c).max(axis=1, initial=1.0)
    most = high_q.max(initial=1.0) * high_c.max(initial=1.0) * n
    if most < 2.0**53:
        return (q @ c.T).astype(np.int64)
    if most < 2.0**63:
        return q.astype(np.int64) @ c.astype(np.int64).T
    even = (2.0**62 / n) ** 0.5
    small_q, small_c = np.flatnonzero(high_q < even), np.flatnonzero(high_c < even)
    large_q, large_c = np.flatnonzero(high_q >= even), np.flatnonzero(high_c >= even)
    out = np.empty((len(q), len(c)), np.int64)
    if len(small_q) and len(small_c):
        out[np.ix_(small_q, small_c)] = products(q[small_q], c[small_c])
    out[large_q] = big_products(q[large_q], c)
    out[np.ix_(small_q, large_c)] = big_products(q[small_q], c[large_c])
    return out


def chosen(s: np.ndarray, n: int) -> np.ndarray:
    """Of each row the places of its n highest scores, in no order; ties go to the first places."""
    width = s.shape[1]
    if n == width:
        return np.broadcast_to(np.arange(width), s.shape)
    real = s != NONE
    if np.abs(np.where(real, s, 0)).max(initial=0) * float(width) < 2.0**62:
        key = np.where(real, s * width + (width - 1 - np.arange(width)), NONE)
        return np.argpartition(key, width - n, axis=1)[:, width - n :]
    return np.argsort(~s, axis=1, kind="stable")[:, :n]  # ~ turns the order of all int64


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query, ties to the smaller vec; each row counts."""
    order = np.lexsort((vec, ~score, query))
    query, vec, score = query[order], vec[order], score[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query, "left") < k
    return query[keep], vec[keep], score[keep]


class Lists:
    """The k best rows so far of queries of one length."""

    def __init__(self, ids: np.ndarray, times: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.times, self.q, self.k = ids, times, q, k
        self.score, self.vec = np.full((len(ids), k), NONE), np.zeros((len(ids), k), np.int64)

    def pass_by(self, vec: np.ndarray, c: np.ndarray) -> None:
        order = np.argsort(vec, kind="stable")
        vec, c = vec[order], c[order]
        low, high = np.searchsorted(vec, self.ids, "left"), np.searchsorted(vec, self.ids, "right")
        for j in range(0, len(self.ids), QUERIES):
            s = products(self.q[j : j + QUERIES], c)
            for r in np.flatnonzero(high[j : j + QUERIES] > low[j : j + QUERIES]):
                s[r, low[j + r] : high[j + r]] = NONE  # the query's own rows
            top = s.max(axis=1)
            live = np.flatnonzero((top >= self.score[j : j + QUERIES, -1]) & (top != NONE))
            s = s[live]
            at = chosen(s, min(self.k, len(vec)))
            score = np.concatenate([self.score[j + live], np.take_along_axis(s, at, 1)], axis=1)
            both = np.concatenate([self.vec[j + live], vec[at]], axis=1)
            keep = np.lexsort((both, ~score), axis=1)[:, : self.k]
            self.score[j + live], self.vec[j + live] = np.take_along_axis(score, keep, 1), np.take_along_axis(both, keep, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vec, score) of all lists; query rows of one id share one."""
        times = np.minimum(self.times, self.k)
        found = [np.repeat(x, times, axis=0) for x in (np.repeat(self.ids, self.k).reshape(-1, self.k), self.vec, self.score)]
        real = found[2] != NONE
        return best(*(x[real] for x in found), self.k)


KIND = "cell long, query_id long, vec_id long, score long"


def lists_of_cells(rows: DataFrame, k: int, scale: float) -> DataFrame:
    """KIND: the lists of each cell. rows: cell, times (null for a row that isn't a query), vec_id, embedding; queries first in a cell."""

    def ended(cell: int, lists: dict[int, Lists]) -> Iterator[pa.RecordBatch]:
        for own in lists.values():
            q, v, s = own.rows()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), cell, np.int64)), pa.array(q), pa.array(v), pa.array(s)], names=[c.split()[0] for c in KIND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, lists = -1, [], {}
        for batch in batches:
            cells, is_query = batch.column("cell").to_numpy(), batch.column("times").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(is_query.astype(np.int8)) != 0)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(cells)], strict=True):
                if i == j:
                    continue
                part = batch.slice(i, j - i)
                if cells[i] != cell:
                    yield from ended(cell, lists)
                    cell, waiting, lists = int(cells[i]), [], {}
                if is_query[i]:
                    waiting.append(part)
                    continue
                if waiting:
                    asked = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    ids, times = asked.column("vec_id").to_numpy(), asked.column("times").to_numpy()
                    lists = {m.shape[1]: Lists(ids[at], times[at], m, k) for at, m in whole(asked.column("embedding"), scale)}
                    waiting = []
                ids = part.column("vec_id").to_numpy()
                for at, matrix in whole(part.column("embedding"), scale):
                    if matrix.shape[1] in lists:
                        for t in range(0, len(at), TILE):
                            lists[matrix.shape[1]].pass_by(ids[at[t : t + TILE]], matrix[t : t + TILE])
        yield from ended(cell, lists)

    return mapped(rows, run, KIND)


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of df with the highest products for each row of queries."""
    spark = df.sparkSession
    # rows are dealt by a number, so repeated ones spread; it is written down once, so a task that runs again deals them alike
    rows, asked = stored(vectors(df).withColumn("number", F.monotonically_increasing_id())), stored(vectors(queries).groupBy("vec_id", "embedding").agg(F.count("*").alias("times")))
    count, length = asked.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    blocks = max(1, -(-count * (8 * max(length, 1) + 40 * k) // BLOCK_BYTES))
    slots = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shards = max(1, min(GROUPS * slots // blocks, -(-rows.count() // TILE)))  # a list stands for a tile of rows at least
    cell = lambda block, shard: (block * shards + shard).alias("cell")
    block = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks))
    each = asked.select("times", "vec_id", "embedding", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    every = rows.withColumn("shard", F.pmod("number", F.lit(shards))).select(F.lit(None).cast("long").alias("times"), "vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "shard")
    both = each.unionByName(every).select(cell(F.col("block"), F.col("shard")), "times", "vec_id", "embedding")
    cells = both.repartition(blocks * shards, "cell").sortWithinPartitions("cell", F.col("times").isNull())
    lists, order = lists_of_cells(cells, k, scale), [F.desc("score"), F.asc("vec_id")]
    lists = lists.withColumn("branch", F.floor(F.col("cell") / FAN_IN)).withColumn("place", F.row_number().over(Window.partitionBy("query_id", "branch").orderBy(*order))).where(F.col("place") <= k)
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
