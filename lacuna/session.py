"""Session settings that the stages count on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Joins may use a partitioning by some of their keys: the stages deal rows out by market and INN once, and all their
#: windows, aggregations and joins within a market and INN then stay where they are.
SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: What series, events and pairs are dealt out by, once.
DEALT = ("CLIENT_ID", "INN_ID")


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is named, one of our own if all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='lacuna-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared one. It goes when the driver ends."""
    path = f"{shared_folder(spark)}/lacuna/{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, where its lineage ends. The table goes when the driver ends."""
    spark, path = df.sparkSession, new_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """The files of a table that stored wrote; nothing may read it any more."""
    spark, root = df.sparkSession, f"{shared_folder(df.sparkSession).removeprefix('file://').removeprefix('file:')}/lacuna/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root in folder:  # never a table of others
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def deals(spark: SparkSession) -> int:
    """How many buckets rows are dealt to: as many as a shuffle has partitions, or what lacuna.buckets says. On one machine four for each core are enough."""
    if own := spark.conf.get("lacuna.buckets", None):
        return int(own)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(n, 4 * spark.sparkContext.defaultParallelism) if spark.sparkContext.master.startswith("local[") else n


def dealt(df: DataFrame, path: str | None = None, by: tuple[str, ...] = DEALT, order: tuple[str, ...] = DEALT) -> DataFrame:
    """df as a table at path that keeps how its rows are dealt out: what groups or joins by these columns needs no shuffle.

    Rows that are dealt out likewise already are written as they are, one file a bucket."""
    spark = df.sparkSession
    path, name, n = path or new_folder(spark), f"lacuna_{uuid.uuid4().hex}", deals(spark)
    df.write.mode("overwrite").format("parquet").bucketBy(n, *by).sortBy(*order).option("path", path).saveAsTable(name)
    return _unnamed(spark, name)


def as_dealt(spark: SparkSession, path: str, schema: StructType, n: int, by: tuple[str, ...] = DEALT) -> DataFrame:
    """A table that dealt has written, maybe in another session, with n buckets."""
    name = f"lacuna_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(by)}) INTO {n} BUCKETS LOCATION '{place}'")
    return _unnamed(spark, name)


def _unnamed(spark: SparkSession, name: str) -> DataFrame:
    """The table without its entry in the catalog, which only tells Spark of the buckets; the files stay."""
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return df
