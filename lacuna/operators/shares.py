"""Who takes the displaced demand: shares of each substitute, per market and across markets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.functions.scalars import rounded
from lacuna.schemas import FINAL_SHARES, MARKET_SHARES


def market_shares(pairs: DataFrame, inn_names: DataFrame) -> DataFrame:
    """pairs: substitute_pairs; inn_names: INN_ID, INN_NAME. Ranks come before rounding, ties by INN and substitute."""
    keys = {"TARGET_DRUGS_ID": "STOCKOUT_DRUG_ID", "TARGET_DRUGS_NAME": "STOCKOUT_DRUG_NAME", "TARGET_NFC1_ID": "STOCKOUT_NFC1_ID", "SUBSTITUTE_DRUGS_ID": "SUBSTITUTE_DRUG_ID", "SUBSTITUTE_DRUGS_NAME": "SUBSTITUTE_DRUG_NAME"}
    sums = pairs.withColumnsRenamed(keys).groupBy("CLIENT_ID", "INN_ID", *keys.values(), "SUBSTITUTE_NFC1_ID", "SAME_NFC1").agg(F.sum("LIFT").alias("TOTAL_LIFT"), F.count("EVENT_ID").alias("EVENTS_COUNT")).where("TOTAL_LIFT > 0")
    drug = Window.partitionBy("CLIENT_ID", "STOCKOUT_DRUG_ID")
    shared = sums.withColumn("INTERNAL_LIFT", F.sum("TOTAL_LIFT").over(drug)).withColumn("share", F.try_divide("TOTAL_LIFT", "INTERNAL_LIFT"))
    ranked = shared.withColumn("SUBSTITUTE_RANK", F.row_number().over(drug.orderBy(F.desc(rounded(F.col("share"), 12)), "INN_ID", "SUBSTITUTE_DRUG_ID")))
    named = ranked.join(inn_names, "INN_ID", "left").withColumn("INN_NAME", F.coalesce("INN_NAME", F.lit("")))  # sums only, not their pairs, are named
    return named.withColumns({"TOTAL_LIFT": rounded(F.col("TOTAL_LIFT"), 4), "INTERNAL_LIFT": rounded(F.col("INTERNAL_LIFT"), 4), "SUBSTITUTE_SHARE": rounded(F.col("share"), 6)}).select(*MARKET_SHARES)


def share_sums(shares: DataFrame) -> DataFrame:
    """The per-market invariant: how far the shares of a product are from 1."""
    sums = shares.groupBy("CLIENT_ID", "STOCKOUT_DRUG_ID").agg(F.sum("SUBSTITUTE_SHARE").alias("s"))
    return sums.groupBy("CLIENT_ID").agg(F.max(F.abs(F.col("s") - 1)).alias("max_diff"), F.count("*").alias("drugs")).withColumn("passed", F.col("max_diff") < 0.001)


def final_shares(market: DataFrame, accepted: DataFrame) -> DataFrame:
    """Across markets, of accepted products only: shares that round to 0 go before ranks are given."""
    kept = market.join(accepted.select(F.col("DRUGS_ID").alias("STOCKOUT_DRUG_ID")), "STOCKOUT_DRUG_ID", "left_semi")
    order = F.col("CLIENT_ID").cast("string")
    pairs = kept.groupBy("STOCKOUT_DRUG_ID", "SUBSTITUTE_DRUG_ID").agg(F.sum("TOTAL_LIFT").alias("lift"), F.countDistinct("CLIENT_ID").alias("MARKETS_COUNT"), F.min_by("STOCKOUT_DRUG_NAME", order).alias("DRUGS_NAME"), F.min_by("SUBSTITUTE_DRUG_NAME", order).alias("SUBSTITUTE_DRUG_NAME"), F.min_by("SAME_NFC1", order).alias("SAME_NFC1"))
    once = kept.groupBy("CLIENT_ID", "STOCKOUT_DRUG_ID").agg(F.max("INTERNAL_LIFT").alias("one")).groupBy("STOCKOUT_DRUG_ID").agg(F.sum("one").alias("internal"))
    shares = pairs.join(once, "STOCKOUT_DRUG_ID").withColumn("SUBSTITUTE_SHARE", rounded(F.try_divide("lift", "internal"), 6)).where("SUBSTITUTE_SHARE > 0")
    rank = F.row_number().over(Window.partitionBy("STOCKOUT_DRUG_ID").orderBy(F.desc("SUBSTITUTE_SHARE"), "SUBSTITUTE_DRUG_ID"))
    return shares.withColumn("SUBSTITUTE_RANK", rank).withColumnRenamed("STOCKOUT_DRUG_ID", "DRUGS_ID").select(*FINAL_SHARES)
