"""Markets that arrive over time: each micro-batch of raw rows rebuilds the series of the markets that it touches.

A batch is stored under its number, so one that comes again after a failure replaces itself and no sale counts twice; rows
with malformed values go to a table of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lacuna.operators import weekly
from lacuna.params import DEFAULT, Params
from lacuna.schemas import RAW_REQUIRED, RAW_USED
from lacuna.sources.files import listed, remove
from lacuna.sources.markets import BROKEN, parsed


def raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed rows of files of the standard header as they appear; MALFORMED marks the bad ones."""
    schema = ", ".join(f"`{c}` string" for c in (*RAW_REQUIRED, BROKEN))
    reader = spark.readStream.schema(schema).option("columnPruning", "false").option("columnNameOfCorruptRecord", BROKEN)
    return parsed(reader.csv(folder, sep=";", header=True, escape='"').select(*[f"`{c}`" for c in (*RAW_USED, BROKEN)]))


def refreshed(batch: DataFrame, number: int, store: str, out: str, p: Params = DEFAULT) -> None:
    """Stores the batch and rewrites the aggregated partitions of its markets. The store goes by batch and market, ``out`` by market."""
    spark = batch.sparkSession
    good = batch.where("MALFORMED IS NULL AND CLIENT_ID IS NOT NULL").drop("MALFORMED")
    for rows, place in ((good, f"{store}/rows/batch={number}"), (batch.where("MALFORMED IS NOT NULL"), f"{store}/malformed/batch={number}")):
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy("CLIENT_ID") if place.startswith(f"{store}/rows/") else writer).parquet(place)
    touched = [r.CLIENT_ID for r in good.select("CLIENT_ID").distinct().collect()]  # ids of one batch's markets
    if not touched:
        return
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in good.schema) + ", batch long"
    rows = spark.read.schema(schema).parquet(f"{store}/rows").where(F.col("CLIENT_ID").isin(touched)).drop("batch")  # prunes partitions
    made, clients = weekly.aggregate_markets(rows, p), Observation()
    seen = made.observe(clients, F.collect_set("CLIENT_ID").alias("found"))  # ids of one batch's markets
    seen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("CLIENT_ID").parquet(out)
    for gone in set(touched) - set(clients.get["found"]):  # without series now: no partition replaces the old one
        if listed(spark, out, f"CLIENT_ID={gone}"):
            remove(spark, f"{out}/CLIENT_ID={gone}")


def start(rows: DataFrame, store: str, out: str, checkpoint: str, p: Params = DEFAULT) -> StreamingQuery:
    return rows.writeStream.foreachBatch(lambda batch, number: refreshed(batch, number, store, out, p)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
