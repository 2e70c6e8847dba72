"""Difference in differences of each event: what substitutes gained beyond the market's growth, and what competitors gained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.functions.scalars import compatible, expected, growth, lift, rounded, share
from lacuna.operators.stockouts import with_post
from lacuna.params import DEFAULT, Params
from lacuna.schemas import DID_EVENTS, SUBSTITUTE_PAIRS

#: What later stages need of a pair.
PAIRS = ("EVENT_ID", "CLIENT_ID", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "NFC1_ID", "SUBSTITUTE_DRUGS_ID", "SUBSTITUTE_DRUGS_NAME", "SUBSTITUTE_NFC1_ID", "lost", "pre", "during", "expectation", "gain")


def product_series(agg: DataFrame, forms: DataFrame) -> DataFrame:
    """One row for each product of a market and INN: packs sold up to each week as a dense array, and its form's group.

    With running sums the packs of any weeks are two look-ups, however many weeks there are. They are decimals of six places, so
    differences of them are exact."""
    so_far = F.sum(F.col("Q").cast("decimal(18,6)")).over(Window.partitionBy("CLIENT_ID", "INN_ID", "DRUGS_ID").orderBy("Date").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = agg.withColumn("so_far", so_far.cast("decimal(18,6)")).groupBy("CLIENT_ID", "INN_ID", "DRUGS_ID").agg(
        F.min("DRUGS_NAME").alias("SUBSTITUTE_DRUGS_NAME"),
        F.min("NFC1_ID").alias("SUBSTITUTE_NFC1_ID"),
        F.min("Date").alias("first_week"),
        F.max("Date").alias("last"),
        F.sort_array(F.collect_list(F.struct("Date", "so_far")))["so_far"].alias("packs"),
    )
    named = forms.select(F.col("form").alias("SUBSTITUTE_NFC1_ID"), F.col("group").alias("sub_group"), F.col("excluded").alias("sub_excluded"))
    return rows.withColumnRenamed("DRUGS_ID", "SUBSTITUTE_DRUGS_ID").join(named, "SUBSTITUTE_NFC1_ID", "left")


def packs_between(start: Column, end: Column) -> Column:
    """Sum of a series' packs from one week to another, both included."""
    week = lambda day: F.least(F.size("packs"), F.floor(F.datediff(day, "first_week") / 7).cast("int") + 1)
    so_far = lambda weeks: F.when(weeks > 0, F.get("packs", weeks - 1)).otherwise(0)
    return F.greatest(F.lit(0).cast("decimal(18,6)"), so_far(week(end)) - so_far(week(F.date_sub(start, 7)))).cast("double")


def measured_events(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return measured(with_post(events, p), p)


def measured(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Those of with_post's events with a valid POST period, the market's growth and the competitors' gain."""
    valid = events.where("POST_STATUS = 'valid'").withColumn("growth", growth(F.col("inn_pre"), F.col("inn_during"), p.min_market_pre))
    return valid.withColumn("lost", lift(F.col("comp_during"), expected(F.col("comp_pre"), F.col("growth"))))


def candidate_pairs(events: DataFrame, agg: DataFrame, forms: DataFrame) -> DataFrame:
    """measured events beside each other product of the INN that has a compatible form and a week during the event."""
    named = forms.select(F.col("form").alias("NFC1_ID"), F.col("group").alias("own_group"), F.col("excluded").alias("own_excluded"))
    own, other = events.join(named, "NFC1_ID", "left"), product_series(agg, forms)
    fits = compatible(F.col("NFC1_ID"), F.col("own_group"), F.col("own_excluded"), F.col("SUBSTITUTE_NFC1_ID"), F.col("sub_group"), F.col("sub_excluded"))
    pairs = own.join(other, ["CLIENT_ID", "INN_ID"]).where("DRUGS_ID <> SUBSTITUTE_DRUGS_ID AND first_week <= STOCKOUT_END AND last >= STOCKOUT_START").where(fits)
    pairs = pairs.withColumns({"pre": packs_between(F.col("PRE_START"), F.col("PRE_END")), "during": packs_between(F.col("STOCKOUT_START"), F.col("STOCKOUT_END"))})
    pairs = pairs.withColumn("expectation", expected(F.col("pre"), F.col("growth")))
    return pairs.withColumn("gain", lift(F.col("during"), F.col("expectation"))).select(*PAIRS)


def exact_sum(c: str) -> Column:
    """The sum to nine decimals, which doesn't depend on the order of the rows as a sum of doubles would."""
    return F.sum(F.col(c).cast("decimal(28,9)"))


def did_events(events: DataFrame, pairs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Effects of the measured events; those whose rounded total is below the least effect are left out."""
    gains = pairs.groupBy("CLIENT_ID", "INN_ID", "EVENT_ID").agg(exact_sum("gain").cast("double").alias("internal"), F.count("*").cast("int").alias("n"), F.count_if(F.col("gain") > 0).cast("int").alias("n_lift"))
    rows = events.join(gains, ["CLIENT_ID", "INN_ID", "EVENT_ID"], "left").withColumn("internal", F.coalesce("internal", F.lit(0.0))).withColumn("total", F.col("internal") + F.col("lost"))
    return rows.withColumns({
        "MARKET_PRE": rounded(F.col("inn_pre"), 2),
        "MARKET_DURING": rounded(F.col("inn_during"), 2),
        "MARKET_GROWTH": rounded(F.col("growth"), 6),
        "INTERNAL_LIFT": rounded(F.col("internal"), 4),
        "LOST_SALES": rounded(F.col("lost"), 4),
        "TOTAL_EFFECT": rounded(F.col("total"), 4),
        "SHARE_INTERNAL": rounded(share(F.col("internal"), F.col("total"), p.min_effect), 6),
        "SHARE_LOST": rounded(share(F.col("lost"), F.col("total"), p.min_effect), 6),
        "SUBSTITUTES_COUNT": F.coalesce("n", F.lit(0)),
        "SUBSTITUTES_WITH_LIFT": F.coalesce("n_lift", F.lit(0)),
    }).where(F.col("TOTAL_EFFECT") >= p.min_effect).select(*DID_EVENTS)


def substitute_pairs(pairs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The pairs of kept events. The event's total is a window sum, so the pairs are made once."""
    total = exact_sum("gain").over(Window.partitionBy("CLIENT_ID", "INN_ID", "EVENT_ID")).cast("double") + F.col("lost")
    kept = pairs.withColumn("total", rounded(total, 4)).where(F.col("total") >= p.min_effect)
    return kept.select(
        "EVENT_ID", "CLIENT_ID", "INN_ID", F.col("DRUGS_ID").alias("TARGET_DRUGS_ID"), F.col("DRUGS_NAME").alias("TARGET_DRUGS_NAME"), F.col("NFC1_ID").alias("TARGET_NFC1_ID"),
        "SUBSTITUTE_DRUGS_ID", "SUBSTITUTE_DRUGS_NAME", "SUBSTITUTE_NFC1_ID", F.col("NFC1_ID").eqNullSafe(F.col("SUBSTITUTE_NFC1_ID")).alias("SAME_NFC1"),
        rounded(F.col("pre"), 4).alias("SALES_PRE"), rounded(F.col("during"), 4).alias("SALES_DURING"), rounded(F.col("expectation"), 4).alias("EXPECTED"), rounded(F.col("gain"), 4).alias("LIFT"),
    ).select(*SUBSTITUTE_PAIRS)
