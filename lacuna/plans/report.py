"""A text report on reliability: distribution, thresholds, and the largest products. All tables in it are small."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lacuna.operators import adhoc
from lacuna.sources.files import write_text


def statistics(enriched: DataFrame, volume: str, path: str, top: int = 20) -> None:
    """enriched: products with their volume and RELIABILITY_SCORE (null where a product has none)."""
    parts = (
        ("matched", adhoc.matched(enriched)),
        ("summary", adhoc.described(enriched)),
        ("buckets", adhoc.score_buckets(enriched).orderBy("bucket")),
        ("thresholds", adhoc.score_sweep(enriched)),
        (f"largest {top}", adhoc.top(enriched.where("RELIABILITY_SCORE IS NOT NULL"), volume, top)),
        ("largest 1000", adhoc.described(adhoc.top(enriched.where("RELIABILITY_SCORE IS NOT NULL"), volume, 1000))),
    )
    lines = []
    for title, df in parts:
        lines += [f"== {title}", "\t".join(df.columns), *("\t".join("" if v is None else str(v) for v in row) for row in df.collect())]
    write_text(enriched.sparkSession, path, "\n".join(lines) + "\n")
