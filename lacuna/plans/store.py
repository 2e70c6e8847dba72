"""Tables that runs store: whole or not there, in versions of which one counts, with what was counted while they were written.

A table is whole once ``_table.json`` stands in its folder, written after Spark's own mark: schema, number of buckets, and the
counts that were observed in the job that wrote it. A folder of versions holds v000001, v000002 ...; ``commit-<n>.json`` says that
version n counts and what it holds. The commit of the largest number is the pointer: it is written aside and moved to a name
that nobody has, so at every moment a reader finds the old version or the new one, and a run that breaks off leaves the old one as it
was. A version that was begun without a commit is gone on with, table by table."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from lacuna.session import as_dealt, dealt, deals
from lacuna.sources.files import complete, exists, input_file, listed, read_text, remove, write_text

#: Versions that stay: the one that counts, and the one before, which may still be read.
KEPT = 2


def commits(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """(number, path) of a folder's commits, the one that counts last."""
    return sorted((int(path.rsplit("-", 1)[1].removesuffix(".json")), path) for path, _, _ in listed(spark, base, "commit-*.json"))


def version(base: str, n: int) -> str:
    return f"{base}/v{n:06d}"


def current(spark: SparkSession, base: str) -> tuple[str, dict] | None:
    """(folder, content) of the version that counts."""
    found = commits(spark, base)
    return (version(base, found[-1][0]), json.loads(read_text(spark, found[-1][1]))) if found else None


def begun(spark: SparkSession, base: str, anew: bool = False) -> str:
    """The folder of the next version; what an earlier run left there is gone on with, or goes."""
    found = commits(spark, base)
    place = version(base, found[-1][0] + 1 if found else 1)
    if anew and exists(spark, place):
        remove(spark, place)
    return place


def commit(spark: SparkSession, place: str, content: dict) -> None:
    """From now on the version at place counts."""
    base, n = place.rsplit("/v", 1)
    write_text(spark, f"{base}/commit-{n}.json", json.dumps(content, ensure_ascii=False))
    for old, path in commits(spark, base)[:-KEPT]:
        remove(spark, path)
        remove(spark, version(base, old))


def described(spark: SparkSession, path: str) -> dict | None:
    """What _table.json says of a table; None if it isn't whole."""
    return json.loads(read_text(spark, f"{path}/_table.json")) if exists(spark, f"{path}/_table.json") and complete(spark, path) else None


def opened(spark: SparkSession, path: str, told: dict) -> DataFrame:
    schema = StructType.fromJson(told["schema"])
    return as_dealt(spark, path, schema, told["buckets"]) if told["buckets"] else spark.read.schema(schema).parquet(path)


def written(spark: SparkSession, path: str, make, counts: dict[str, Column] | None = None, how: str | None = None) -> tuple[DataFrame, dict]:
    """(table, counts): made if it isn't there as a whole. how: ``dealt`` (by market and INN), or a column to partition by.

    The counts are aggregates over the rows, observed as they are written, so they cost no job."""
    told = described(spark, path)
    if told is None:
        df, seen = make(), Observation() if counts else None
        if counts:
            df = df.observe(seen, *[c.alias(n) for n, c in counts.items()])
        if how == "dealt":
            dealt(df, path)
        else:
            writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
            (writer.partitionBy(how) if how else writer).parquet(path)
        told = {"schema": df.schema.jsonValue(), "buckets": deals(spark) if how == "dealt" else 0, "counts": seen.get if seen else {}}
        write_text(spark, f"{path}/_table.json", json.dumps(told, ensure_ascii=False))
    return opened(spark, path, told), told["counts"]


def versioned(spark: SparkSession, base: str, make, force: bool = False) -> DataFrame:
    """A table alone in its folder of versions; with force a new version, and the old one counts until that is whole."""
    have = None if force else current(spark, base)
    if have is None:
        place = begun(spark, base, force)
        written(spark, f"{place}/table", make)
        commit(spark, place, {})
        have = place, {}
    told = described(spark, f"{have[0]}/table")
    if told is None:
        raise OSError(f"{have[0]}/table isn't whole")
    return opened(spark, f"{have[0]}/table", told)


def unreadable(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The Parquet files whose footer can't be read, or names bytes beyond the file's end, with the reason; one job over the paths."""

    def wrong(path: str) -> str | None:
        from pyarrow import parquet

        try:
            with input_file(path) as f:
                size, meta = f.size(), parquet.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    for c in range(meta.num_columns):
                        column = meta.row_group(g).column(c)
                        start = min(x for x in (column.dictionary_page_offset, column.data_page_offset) if x is not None)
                        if start + column.total_compressed_size > size:
                            return f"column {column.path_in_schema} ends beyond the file"
        except (OSError, pa.ArrowException) as e:
            return f"{type(e).__name__}: {str(e)[:200]}"
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{"path": p, "reason": r} for p in batch.column(0).to_pylist() if (r := wrong(p))]
            yield pa.RecordBatch.from_pylist(found, pa.schema([("path", pa.string()), ("reason", pa.string())]))

    if not paths:
        return {}
    parts = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(parts)
    return {r.path: r.reason for r in files.mapInArrow(run, "path string, reason string").collect()}  # bad files only
