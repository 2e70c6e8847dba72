"""URL filter: longest-match rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from the URLs that a rule labels: lengths, depths, digit ratio, entropy, parameter counts, and statistics
of the host's suffix (its last label) over all labelled URLs. They are fitted on at most ``sample`` labelled URLs, drawn by
hash; the suffix statistics count every labelled row but the one that they describe. Only URLs without a rule are scored (``block_score``, else null).

Defined cases: a null URL or one without :// has an empty host and path, no rule, and the method's verdict; with no
labelled URLs, or one class only, the method allows, or says that class; repeated rows give repeated results; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import flat_bytes, mapped

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of suffix statistics (about 30 bytes each) up to which they are broadcast; a plain join beyond.
BROADCAST_ROWS = 50_000
#: URLs that one step computes features of.
ROWS = 4096


def located(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    at = F.instr(F.col("url"), "://")
    rest = F.when(at > 0, F.substr(F.col("url"), at + 3)).otherwise(F.lit(""))
    found = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url"), F.lit("")).alias("url")).withColumn("rest", rest).withColumn("raw", F.regexp_extract("rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.substr(F.col("rest"), F.length("raw") + 1), "^[^?#]*", 0)
    return found.select("page_id", "url", F.translate("raw", UPPER, LOWER).alias("host"), path.alias("path"))


def fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    return ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(slash + path))


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """located pages with the longest rule that fits and what it says; null where none does."""
    rule, says = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        rule, says = F.when(fits(text), F.lit(text)).otherwise(rule), F.when(fits(text), F.lit(verdict)).otherwise(says)
    return located(pages).withColumn("rule", rule).withColumn("says", says).withColumn("suffix", F.substring_index("host", ".", -1))


FEATURES = ("length", "host length", "path length", "labels", "depth", "digits", "digit ratio", "entropy", "parameters", "fragment", "hyphens", "longest part", "https", "suffix rate", "suffix count")


def features(urls: pa.Array, hosts: pa.Array, paths: pa.Array, rates: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each URL; lengths and places are those of bytes."""
    flat, offsets = flat_bytes(urls)
    n, size = len(urls), np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * 256 + flat, minlength=256 * n).reshape(n, 256)
    share = kinds / np.maximum(size, 1)[:, None]
    bits = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    digits = kinds[:, 48:58].sum(axis=1)

    def first(byte: int) -> np.ndarray:
        """The place of each URL's first such byte; its end if there is none."""
        out, at = offsets[1:].copy(), np.flatnonzero(flat == byte)
        np.minimum.at(out, row[at], at)
        return out

    asked, ended, pairs = first(ord("?")), first(ord("#")), np.flatnonzero((flat == ord("=")) | (flat == ord("&")))
    parameters = np.bincount(row[pairs], (pairs > asked[row[pairs]]) & (pairs < ended[row[pairs]]), minlength=n)
    path, at = flat_bytes(paths)
    slashes = np.flatnonzero(path == ord("/"))
    slash_row = np.searchsorted(at[1:], slashes, "right")
    own = np.concatenate([slash_row, np.arange(n)])
    ends = np.concatenate([slashes, at[1:]]) + own  # of parts, as if each path ended in a byte of its own
    order = np.argsort(ends)
    part = np.zeros(n)
    np.maximum.at(part, own[order], np.diff(ends[order], prepend=-1) - 1)
    host, host_at = flat_bytes(hosts)
    dots = np.bincount(np.repeat(np.arange(n), np.diff(host_at))[host == ord(".")], minlength=n)
    slash_counts = np.bincount(slash_row, minlength=n)
    https = pc.starts_with(urls, "https").to_numpy(zero_copy_only=False)
    columns = (size, np.diff(host_at), np.diff(at), dots + (np.diff(host_at) > 0), slash_counts, digits, digits / np.maximum(size, 1), bits, parameters, kinds[:, ord("#")] > 0, kinds[:, ord("-")], part, https, rates, np.log1p(counts))
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1) if n else np.zeros((0, len(FEATURES)))


class Boosted:
    """Gradient-boosted regression trees for log-odds, on binned features."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 20):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.base, self.forest, self.cuts = -4.0, [], []
        if len(y):
            share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
            self.base = float(np.log(share / (1 - share)))
        if not 0 < y.sum() < len(y):
            return self
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned, f = self.binned(x), np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            tree = self.grow(binned, y - p, p * (1 - p))
            self.forest.append(tree)
            f += self.rate * self.leaf(tree, binned)
        return self

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T, strict=True)], axis=1)

    def grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[tuple[int, int, float]]:
        """Nodes in heap order: (feature or -1, last bin of the left side, value)."""
        nodes, own = [], np.zeros(len(g), np.int64)
        for place in range(2 ** (self.depth + 1) - 1):
            rows = np.flatnonzero(own == place)
            total_g, total_h = g[rows].sum(), h[rows].sum()
            split, gain = (-1, 0), 1e-6
            if place < 2**self.depth - 1 and len(rows) >= 2 * self.least:
                for c in range(x.shape[1]):
                    n, sg, sh = (np.cumsum(np.bincount(x[rows, c], w, self.bins)) for w in (None, g[rows], h[rows]))
                    ok = (n >= self.least) & (len(rows) - n >= self.least)
                    value = np.where(ok, sg**2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - total_g**2 / (total_h + 1), 0)
                    if value.max() > gain:
                        split, gain = (c, int(value.argmax())), float(value.max())
            nodes.append((*split, float(total_g / (total_h + 1))))
            if split[0] >= 0:
                own[rows] = 2 * place + 1 + (x[rows, split[0]] > split[1])
        return nodes

    def leaf(self, tree: list[tuple[int, int, float]], x: np.ndarray) -> np.ndarray:
        column, cut, value = (np.array(v) for v in zip(*tree, strict=True))
        at = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            inner = column[at] >= 0
            at = np.where(inner, 2 * at + 1 + (x[np.arange(len(x)), column[at]] > cut[at]), at)
        return value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        if self.forest:
            b = self.binned(x)
            for tree in self.forest:
                f += self.rate * self.leaf(tree, b)
        return 1 / (1 + np.exp(-f))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, sample: int = 20_000) -> DataFrame:
    """page_id, host, path, rule, verdict; also the trees' probability of block."""
    found = ruled(pages, rules)
    labelled = found.where(F.col("says").isNotNull())
    block = (F.col("says") == "block").cast("double")
    stats = labelled.groupBy("suffix").agg(F.count("*").alias("n"), F.sum(block).alias("n_block"))
    small = stats.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    full = found.join(F.broadcast(stats) if small else stats, "suffix", "left").fillna(0, ["n", "n_block"])
    own = F.col("says").isNotNull().cast("double")  # a labelled row's own label is no evidence about it
    others = F.col("n") - own
    full = full.withColumns({"suffix_count": others, "suffix_rate": (F.col("n_block") - F.coalesce(block, F.lit(0.0)) + 1) / (others + 2)})
    drawn = full.where(F.col("says").isNotNull()).select("page_id", "url", "host", "path", "suffix_rate", "suffix_count", block.alias("y")).orderBy(F.xxhash64("url", "page_id"), "url", "page_id").limit(sample).toArrow()
    x = lambda t: features(*(t.column(c) for c in ("url", "host", "path")), t.column("suffix_rate").to_numpy(), t.column("suffix_count").to_numpy())
    drawn = drawn.combine_chunks()
    model = Boosted().fit(x(drawn.to_batches()[0]) if drawn.num_rows else np.zeros((0, len(FEATURES))), drawn.column("y").to_numpy())
    kind = "page_id long, host string, path string, rule string, verdict string, block_score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                b = batch.slice(i, ROWS)
                open_ = b.column("says").is_null().to_numpy(zero_copy_only=False)
                score = np.zeros(b.num_rows)
                score[open_] = model.predict(x(b.filter(pa.array(open_))))
                verdict = pc.coalesce(b.column("says"), pc.if_else(pa.array(score >= 0.5), "block", "allow"))
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("host"), b.column("path"), b.column("rule"), verdict, pa.array(score, mask=~open_)], names=[c.split()[0] for c in kind.split(", ")])

    return mapped(full.select("page_id", "url", "host", "path", "rule", "says", "suffix_rate", "suffix_count"), run, kind)
