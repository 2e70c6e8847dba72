"""The order tables read as weekly sales of shops: each nation is a market's target shop, the other nations of its region compete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.functions.scalars import monday
from lacuna.sources.markets import rule_table

#: Forms that count as one group; all others stand alone.
FORM_GROUPS = (("F0", "solid", False), ("F1", "solid", False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product names with ids by name, their INN (the second word) and form. Distinct names are few, so one order is fine."""
    names = table(spark, sf_dir, "part").select("p_name").distinct().withColumn("INN_NAME", F.split_part("p_name", F.lit(" "), F.lit(2)))
    form = F.concat(F.lit("F"), (F.length(F.split_part("p_name", F.lit(" "), F.lit(1))) % 3).cast("string"))
    return names.select("p_name", F.row_number().over(Window.orderBy("p_name")).cast("long").alias("DRUGS_ID"), "INN_NAME", F.dense_rank().over(Window.orderBy("INN_NAME")).cast("long").alias("INN_ID"), form.alias("NFC1_ID"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sums of each nation and product, with the region."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", monday(F.col("l_shipdate")).alias("Date"))
    shops = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    sums = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(shops, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("n_regionkey").alias("REGION"), F.col("s_nationkey").cast("long").alias("CLIENT_ID"), "p_name", "Date").agg(F.sum("l_quantity").cast("double").alias("Q"), F.sum("l_extendedprice").cast("double").alias("V"))
    return sums.join(products(spark, sf_dir), "p_name").withColumnRenamed("p_name", "DRUGS_NAME").withColumn("PHARM_ID", F.col("CLIENT_ID")).withColumn("NFC_ID", F.col("NFC1_ID"))


def competitors(sold: DataFrame) -> DataFrame:
    """Totals of each region less the market's own sales: rows are not repeated for each market before they are summed."""
    keys = ("REGION", "INN_ID", "DRUGS_ID", "Date")
    region = sold.groupBy(*keys).agg(F.sum("Q").alias("all_q"), F.sum("V").alias("all_v"))
    own = sold.select("CLIENT_ID", *keys, F.col("Q").alias("own_q"), F.col("V").alias("own_v"))
    every = region.join(sold.select("REGION", "CLIENT_ID").distinct(), "REGION").join(own, ["CLIENT_ID", *keys], "left")
    return every.select("CLIENT_ID", "INN_ID", "DRUGS_ID", "Date", (F.col("all_q") - F.coalesce("own_q", F.lit(0.0))).alias("MARKET_TOTAL_DRUGS_PACK"), (F.col("all_v") - F.coalesce("own_v", F.lit(0.0))).alias("MARKET_TOTAL_DRUGS_REVENUE"))


def forms(spark: SparkSession) -> DataFrame:
    return rule_table(spark, FORM_GROUPS)

