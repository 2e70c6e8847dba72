"""Weekly series of the target shop: duplicates summed, gaps filled, rarely and always sold products left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.params import DEFAULT, Params
from lacuna.schemas import AGGREGATED
from lacuna.session import DEALT, deals

SERIES = ("CLIENT_ID", "INN_ID", "PHARM_ID", "DRUGS_ID")
ATTRIBUTES = ("DRUGS_NAME", "INN_NAME", "NFC1_ID", "NFC_ID")


def weekly_sales(rows: DataFrame) -> DataFrame:
    """One row for each shop, product and week; rows without an INN belong to no group and are left out.

    Rows are dealt out by market and INN, into as many parts as tables have buckets, which every later window, aggregation and join can use as it is."""
    first = [F.min(c).alias(c) for c in ATTRIBUTES]  # the smallest: defined, whatever the file order
    return rows.where("INN_ID IS NOT NULL").repartition(deals(rows.sparkSession), *DEALT).groupBy(*SERIES, "Date").agg(F.coalesce(F.sum("Q"), F.lit(0.0)).alias("Q"), F.coalesce(F.sum("V"), F.lit(0.0)).alias("V"), *first)


def gap_filled(weekly: DataFrame) -> DataFrame:
    """Every week from a series' first to its last: each row also stands for the unsold weeks up to the next one.

    One shuffle: window and generator share the partitioning by series, and no skeleton is joined."""
    series = Window.partitionBy(*SERIES)
    order = series.orderBy("Date")
    behind = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)  # grows row by row; a frame to the end would be read anew for each row
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("Date"))).over(series)
    named = weekly.withColumns({c: F.coalesce(F.last(c, True).over(behind), first(c)) for c in ATTRIBUTES} | {"until": F.coalesce(F.date_sub(F.lead("Date").over(order), 7), F.col("Date"))})
    weeks = named.withColumn("week", F.explode(F.sequence("Date", "until", F.expr("INTERVAL 7 DAYS"))))
    sold = F.col("week") == F.col("Date")
    return weeks.select(*SERIES, F.col("week").alias("Date"), F.when(sold, F.col("Q")).otherwise(0.0).alias("Q"), F.when(sold, F.col("V")).otherwise(0.0).alias("V"), *ATTRIBUTES)


def with_notsold(dense: DataFrame) -> DataFrame:
    return dense.withColumn("NOTSOLD_PERCENT", F.avg((F.col("Q") == 0).cast("double")).over(Window.partitionBy(*SERIES)))


def competitor_totals(rows: DataFrame) -> DataFrame:
    """Competitors' sums by market, product and week. Unsold weeks add nothing, so their series need no filling."""
    others = rows.where("PHARM_ID <> CLIENT_ID AND INN_ID IS NOT NULL")
    return others.groupBy("CLIENT_ID", "INN_ID", "DRUGS_ID", "Date").agg(F.sum("Q").alias("MARKET_TOTAL_DRUGS_PACK"), F.sum("V").alias("MARKET_TOTAL_DRUGS_REVENUE"))


def aggregated(target: DataFrame, competitors: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Dense target series within the not-sold range, beside competitors' totals (0 where they sold nothing)."""
    kept = with_notsold(gap_filled(weekly_sales(target))).where(F.col("NOTSOLD_PERCENT").between(p.min_notsold, p.max_notsold))
    joined = kept.join(competitors, ["CLIENT_ID", "INN_ID", "DRUGS_ID", "Date"], "left").fillna(0.0, ["MARKET_TOTAL_DRUGS_PACK", "MARKET_TOTAL_DRUGS_REVENUE"])
    return joined.select(*AGGREGATED)


def aggregate_markets(rows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """aggregated for raw rows of many markets: the target is the shop whose id is the market's."""
    return aggregated(rows.where("PHARM_ID = CLIENT_ID"), competitor_totals(rows), p)
