"""Across markets: one share for each market and product, outliers trimmed, then statistics and reliability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.functions.scalars import rounded
from lacuna.operators.modality import modality
from lacuna.params import DEFAULT, Params
from lacuna.schemas import DRUG_STATISTICS


def inn_names(agg: DataFrame) -> DataFrame:
    """INN_ID and INN_NAME of aggregated series; of several names the smallest."""
    return agg.where("INN_ID IS NOT NULL").groupBy("INN_ID").agg(F.min("INN_NAME").alias("INN_NAME"))


def market_drug(did: DataFrame) -> DataFrame:
    """Ratio of sums for each market and product."""
    sums = did.groupBy("CLIENT_ID", "DRUGS_ID").agg(
        F.sum("INTERNAL_LIFT").alias("INTERNAL_LIFT"), F.sum("LOST_SALES").alias("LOST_SALES"), F.sum("TOTAL_EFFECT").alias("TOTAL_EFFECT"), F.count("EVENT_ID").alias("EVENTS_COUNT"),
        F.min("DRUGS_NAME").alias("DRUGS_NAME"), F.min("INN_ID").alias("INN_ID"), F.min("NFC1_ID").alias("NFC1_ID"),
    )
    return sums.withColumn("SHARE_INTERNAL", F.try_divide("INTERNAL_LIFT", "TOTAL_EFFECT")).na.drop(subset=["SHARE_INTERNAL"])


def iqr_trimmed(shares: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Rows whose share lies within Tukey's fences of its product, both included."""
    drug = Window.partitionBy("DRUGS_ID")
    fenced = shares.withColumn("q", F.percentile("SHARE_INTERNAL", F.array(F.lit(0.25), F.lit(0.75))).over(drug)).withColumn("total", F.count("*").over(drug))
    spread = (F.col("q")[1] - F.col("q")[0]) * p.iqr_multiplier
    return fenced.where(F.col("SHARE_INTERNAL").between(F.col("q")[0] - spread, F.col("q")[1] + spread)).drop("q")


def drug_statistics(shares: DataFrame, inn_names: DataFrame, p: Params = DEFAULT, dip_test: bool = True) -> DataFrame:
    """shares: market_drug. Without the dip test every product is UNIMODAL with a p-value of 1."""
    clean, order = iqr_trimmed(shares, p), F.col("CLIENT_ID").cast("string")
    positive = F.when(F.col("SHARE_INTERNAL") > 0, F.col("SHARE_INTERNAL"))
    stats = clean.groupBy("DRUGS_ID").agg(
        *[F.min_by(c, order).alias(c) for c in ("DRUGS_NAME", "INN_ID", "NFC1_ID")],
        F.max("total").cast("int").alias("MARKET_COUNT_TOTAL"), F.count("*").cast("int").alias("MARKET_COUNT_CLEAN"), F.avg("SHARE_INTERNAL").alias("mean"),
        F.count(positive).cast("int").alias("MARKETS_WITH_SUB"), F.coalesce(F.avg(positive), F.lit(0.0)).alias("conditional"), F.coalesce(F.stddev_samp("SHARE_INTERNAL"), F.lit(0.0)).alias("std"),
    )
    if dip_test:
        stats = stats.join(modality(clean, p), "DRUGS_ID")
    else:
        stats = stats.withColumns({"DRUG_CLASS": F.lit("UNIMODAL"), "DIP_PVALUE": F.lit(1.0)})
    n, cv = F.col("MARKET_COUNT_CLEAN"), F.when(F.col("mean") > 0, F.try_divide("std", "mean")).when(F.col("std") == 0, 0.0)
    stats = stats.join(inn_names, "INN_ID", "left").withColumn("cv", cv)
    stability = F.when(F.col("mean") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("cv")))).when(F.col("std") == 0, 1.0).otherwise(0.0)
    sample = F.least(F.lit(1.0), F.log10(F.greatest(n, F.lit(1)).cast("double")) / F.log10(F.lit(float(p.saturation_markets))))
    penalty = F.when(F.col("DRUG_CLASS") == "MULTIMODAL", p.multimodal_penalty).otherwise(1.0)
    return stats.withColumns({
        "INN_NAME": F.coalesce("INN_NAME", F.lit("")),
        "MEAN_SHARE_INTERNAL": rounded(F.col("mean"), 6),
        "COVERAGE_PCT": rounded(F.col("MARKETS_WITH_SUB") / n, 6),
        "CONDITIONAL_RETENTION": rounded(F.col("conditional"), 6),
        "STD_SHARE_INTERNAL": rounded(F.col("std"), 6),
        "VARIATION_COEF": F.coalesce(rounded(F.col("cv"), 6), F.lit(999.0)),
        "RELIABILITY_LABEL": F.when(n < 2, "SINGLE_MARKET").when(F.col("cv") < p.high_cv, "HIGH").when(F.col("cv") < p.medium_cv, "MEDIUM").otherwise("LOW"),
        "RELIABILITY_SCORE": F.when(n < 2, 0.0).otherwise(rounded(stability * sample * penalty, 6)),
    }).select(*DRUG_STATISTICS)
