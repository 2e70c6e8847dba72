"""Shared helpers: Arrow text columns as NumPy byte arrays, vectorised words, 64-bit hashes and task-side mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.session import drop as drop
from lacuna.session import stored as stored  # tables between steps, in the folder that all executors share

#: Bytes of text that one vectorised step works on. A document longer than this forms a step of its own.
STEP_BYTES = 1 << 20
#: Bytes of rows that Spark hands to a task's Python at a time, as its setting has it.
BATCH_BYTES, BATCH_SETTING = 1 << 23, "spark.sql.execution.arrow.maxBytesPerBatch"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: Word characters after lower-casing A-Z: digits, a-z and every byte of a non-ASCII character; 0 for the rest.
WORD_BYTE = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    WORD_BYTE[_b] = _b
for _b in range(0x41, 0x5B):
    WORD_BYTE[_b] = _b + 32


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64, len(column) + 1 + column.offset)[column.offset :] if len(column) else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the polynomial hash base, or of its inverse, modulo 2**64."""
    key = "inverse" if inverse else "base"
    have = _powers.get(key)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), _INVERSE if inverse else _BASE, np.uint64)
        out[0] = 1
        have = _powers[key] = np.multiply.accumulate(out)
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """H with (H[j] - H[i]) * base**-i a hash of values[i:j]. Long strings of special structure can collide: for candidates only."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=out[1:])
    return out


def slice_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start])


#: Addends of a word's bytes by place and byte, for words of up to this many bytes; later places are mixed as they come.
PLACES = 48
_SEEDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0xC2B2AE3D27D4EB4F))
_ADDENDS = tuple(mix(np.arange(PLACES * 256, dtype=np.uint64) ^ seed) for seed in _SEEDS)


class Words:
    """The words of several texts laid end to end: start, end (byte places), doc (row) and hash of each.

    A word's hash adds up one mixed number for each byte and its place in the word, so unlike a polynomial it has no words
    that collide by their structure; ``check`` is another one, and both together are 128 bits.
    """

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        low = WORD_BYTE[flat]
        is_word = low != 0
        before = np.zeros(len(flat) + 1, bool)
        before[1:] = is_word
        before[offsets] = False
        after = np.zeros(len(flat) + 1, bool)
        after[:-1] = is_word
        after[offsets] = False
        self.start = np.flatnonzero(is_word & ~before[:-1])
        self.end = np.flatnonzero(is_word & ~after[1:]) + 1
        size = self.end - self.start
        self._last = np.cumsum(size)
        letters = low[is_word].astype(np.int64)
        self._keys = (np.arange(len(letters)) - np.repeat(self._last - size, size)) * 256 + letters
        self.hash = self._summed(0)
        self.first = np.searchsorted(self.start, offsets)  # of each row; one more at the end
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)

    def _summed(self, which: int) -> np.ndarray:
        table, keys = _ADDENDS[which], self._keys
        far = np.flatnonzero(keys >= len(table))
        addends = table[np.minimum(keys, len(table) - 1)] if len(far) else table[keys]
        if len(far):
            addends[far] = mix(keys[far].astype(np.uint64) ^ _SEEDS[which])
        return mix(np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(addends, dtype=np.uint64)[self._last - 1]])))

    @property
    def check(self) -> np.ndarray:
        return self._summed(1)


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only: other columns, whatever their names, stay out of the way. A null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def with_texts(batch: pa.RecordBatch, name: str, texts: pa.Array, keep: np.ndarray | None = None) -> pa.RecordBatch:
    """The batch with another column ``name`` and, if given, only the rows ``keep``."""
    columns = [texts if f.name == name else batch.column(i) for i, f in enumerate(batch.schema)]
    out = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
    return out if keep is None else out.filter(pa.array(keep))


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow in batches of at most BATCH_BYTES (or one row), so a task's memory doesn't follow the length of 10000 texts."""
    conf = df.sparkSession.conf
    now = conf.get(BATCH_SETTING).rstrip("bB")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(doc_id) -> object:
    """Whether labels of a document may be learned from: crc32 of its id as text, modulo 4, isn't 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(True))


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, drawn: Callable[[str], str]) -> DataFrame:
    """(text, y) with y 0 or 1: of each class at most ``per_class`` learnable rows, taken by hash, and of each text what ``drawn`` says.

    An id that several rows have counts once for each different text; an id with both labels stands in both classes."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(learnable(F.col("doc_id")) & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        rows = part if rows is None else rows.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(rows), "doc_id")  # rows: 2 * per_class of 12 bytes at most
    drawn_texts = joined.select("doc_id", F.udf(drawn, "string", useArrow=True)("text").alias("text"), "y").dropDuplicates()
    place = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text"))
    bounded = drawn_texts.withColumn("place", place).where(F.col("place") <= per_class)  # repeated ids don't add to it
    return bounded.select("text", "y")


def in_order(found: pa.Table) -> tuple[list[str], np.ndarray]:
    """(texts, labels) of a bounded sample, in an order that doesn't depend on how its rows came."""
    found = found.sort_by([("y", "ascending"), ("text", "ascending")])
    return found.column("text").to_pylist(), found.column("y").to_numpy().astype(np.float64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, drawn: Callable[[str], str]) -> tuple[list[str], np.ndarray]:
    """bounded_sample on the driver."""
    return in_order(bounded_sample(docs, labels, label, per_class, drawn).toArrow())
