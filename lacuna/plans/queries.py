"""Registered queries of the stock-out method over the order tables, each beside the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.functions.scalars import compatibility_group, compatible, decimal_comma, monday, period_date, rounded
from lacuna.operators import adhoc, crossmarket, modality, shares, stockouts, weekly
from lacuna.params import Params
from lacuna.plans import market_data, market_files
from lacuna.plans.stages import Stages
from lacuna.schemas import DID_EVENTS, DRUG_COEFFICIENTS, FINAL_SHARES, MARKET_SHARES
from lacuna.session import stored, tuned

#: Few nations have sales in the smallest tables.
PARAMS = Params(min_market_count=3)


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    """The chain for one query."""
    sold = stored(market_data.sales(tuned(spark), sf_dir))  # read twice, and small: one row for each nation, product and week
    return Stages(sold, market_data.competitors(sold), market_data.forms(spark), PARAMS)


def round_all(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), places) for c in columns})


def weekly_sales(spark, d):
    return round_all(market_data.sales(spark, d), 2, "V").select("CLIENT_ID", "REGION", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "INN_NAME", "NFC1_ID", "Date", "Q", "V")


def gap_filled(spark, d):
    return round_all(weekly.gap_filled(weekly.weekly_sales(market_data.sales(spark, d))), 2, "V").select("CLIENT_ID", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "Date", "Q", "V")


def notsold(spark, d):
    rows = weekly.with_notsold(weekly.gap_filled(weekly.weekly_sales(market_data.sales(spark, d))))
    return round_all(rows.groupBy("CLIENT_ID", "DRUGS_ID").agg(F.max("NOTSOLD_PERCENT").alias("NOTSOLD_PERCENT"), F.count("*").alias("weeks")), 6, "NOTSOLD_PERCENT")


def market_totals(spark, d):
    return round_all(market_data.competitors(market_data.sales(spark, d)), 2, "MARKET_TOTAL_DRUGS_REVENUE")


def aggregated(spark, d):
    return round_all(stages(spark, d).series, 2, "V", "MARKET_TOTAL_DRUGS_REVENUE").withColumn("NOTSOLD_PERCENT", rounded(F.col("NOTSOLD_PERCENT"), 6))


def stockout_islands(spark, d):
    return stages(spark, d).islands.select("CLIENT_ID", "INN_ID", "DRUGS_ID", "STOCKOUT_START", "STOCKOUT_END", "STOCKOUT_WEEKS", "inn_during", "comp_during", "inn_pre", "comp_pre")


def stockout_events(spark, d):
    return stockouts.event_table(stages(spark, d).events)


def validation_funnel(spark, d):
    return stockouts.validation_funnel(stages(spark, d).islands, PARAMS)


def post_period(spark, d):
    return stockouts.with_post(stages(spark, d).events, PARAMS).select("EVENT_ID", "POST_STATUS", "POST_START", "POST_END", "POST_WEEKS")


def valid_substitutes(spark, d):
    return stages(spark, d).pairs.select("EVENT_ID", "DRUGS_ID", "SUBSTITUTE_DRUGS_ID")


def did_events(spark, d):
    return stages(spark, d).did_events


def substitute_pairs(spark, d):
    return stages(spark, d).substitute_pairs


def market_shares(spark, d):
    return stages(spark, d).market_shares


def share_invariant(spark, d):
    return shares.share_sums(stages(spark, d).market_shares).select("CLIENT_ID", "drugs", "passed")


def market_drug(spark, d):
    return round_all(stages(spark, d).market_drug, 4, "INTERNAL_LIFT", "LOST_SALES", "TOTAL_EFFECT").withColumn("SHARE_INTERNAL", rounded(F.col("SHARE_INTERNAL"), 6))


def iqr_trim(spark, d):
    return crossmarket.iqr_trimmed(stages(spark, d).market_drug, PARAMS).select("CLIENT_ID", "DRUGS_ID", rounded(F.col("SHARE_INTERNAL"), 6).alias("SHARE_INTERNAL"))


def drug_statistics(spark, d):
    """The p-values are those of drug_modality."""
    return stages(spark, d).drug_statistics.drop("DIP_PVALUE")


def drug_modality(spark, d):
    return modality.modality(crossmarket.iqr_trimmed(stages(spark, d).market_drug, PARAMS), PARAMS)


def drug_coefficients(spark, d):
    return stages(spark, d).drug_coefficients


def two_peaks(spark, d):
    """Statistics of shares with two peaks: 0.2 or 0.8 by market for products of even number, 0.5 everywhere for the others."""
    seen = market_data.sales(spark, d).select("CLIENT_ID", "DRUGS_ID", "DRUGS_NAME", "INN_ID", "INN_NAME", "NFC1_ID").distinct()
    share = F.when(F.col("DRUGS_ID") % 2 == 1, 0.5).when(F.col("CLIENT_ID") % 2 == 0, 0.2).otherwise(0.8)
    found = crossmarket.drug_statistics(seen.withColumn("SHARE_INTERNAL", share), crossmarket.inn_names(seen), PARAMS)
    return found.select("DRUGS_ID", "DRUG_CLASS", "MARKET_COUNT_CLEAN", "MEAN_SHARE_INTERNAL", "STD_SHARE_INTERNAL", "VARIATION_COEF", "RELIABILITY_LABEL", "RELIABILITY_SCORE")


def substitute_shares(spark, d):
    return stages(spark, d).final_shares


def checks(spark, d):
    return stages(spark, d).checks


def volumes(spark, d) -> DataFrame:
    """Sums of cents as decimals: those of doubles depend on the order of the rows, and halves then round either way."""
    sold = market_data.sales(spark, d)
    return sold.groupBy("DRUGS_ID", "DRUGS_NAME").agg(rounded(F.sum(F.col("V").cast("decimal(28,2)")).cast("double"), 0).alias("volume"))


def enriched(spark, d) -> DataFrame:
    return adhoc.with_reliability(volumes(spark, d), stages(spark, d).drug_coefficients)


def reliability_match(spark, d):
    return adhoc.matched(enriched(spark, d))


#: Scores depend on few markets in these tables, so the range starts lower than the default.
SUBSET = Params(min_market_count=3, reliability_low=0.20)


def pareto_cut(spark, d):
    return adhoc.pareto_cut(enriched(spark, d), "volume", SUBSET).select("DRUGS_ID", "volume", "position", rounded(F.col("cum_share"), 6).alias("cum_share"))


def pareto_curve(spark, d):
    return adhoc.pareto(volumes(spark, d), "volume").select("DRUGS_ID", "position", rounded(F.col("cum_share"), 6).alias("cum_share"))


def tiers(spark, d):
    return round_all(adhoc.tiers(stages(spark, d).drug_coefficients, PARAMS), 6, "mean_coef")


def reliability_hist(spark, d):
    return round_all(adhoc.score_buckets(stages(spark, d).drug_coefficients), 4, "pct")


def score_sweep(spark, d):
    return adhoc.score_sweep(stages(spark, d).drug_coefficients)


def reliability_summary(spark, d):
    return round_all(adhoc.described(stages(spark, d).drug_coefficients), 6, "low", "high", "mean", "std", "p10", "p25", "p50", "p75", "p90")


def coef_histogram(spark, d):
    return adhoc.histogram(stages(spark, d).drug_coefficients, "COEF_1", 50)


def coefficient_contours(spark, d):
    return round_all(adhoc.contours(stages(spark, d).drug_coefficients), 6, "contour")


def subset_semi(spark, d):
    s = stages(spark, d)
    return adhoc.subset(s.final_shares, s.drug_coefficients.where("RELIABILITY_SCORE >= 0.25"))


def missing_anti(spark, d):
    s = stages(spark, d)
    reliable = adhoc.subset(s.final_shares, s.drug_coefficients.where("RELIABILITY_SCORE >= 0.25"))
    return adhoc.without_pairs(volumes(spark, d).select("DRUGS_ID"), reliable)


def form_registry(spark, d):
    found = market_data.sales(spark, d).select(F.trim("NFC1_ID").alias("form")).where("form <> ''").distinct()
    named = found.join(market_data.forms(spark), "form", "left")
    return named.select("form", compatibility_group(F.col("group"), F.col("excluded")).alias("group"))


def form_compatibility(spark, d):
    f = market_data.sales(spark, d).select(F.col("NFC1_ID").alias("form")).distinct().join(market_data.forms(spark), "form", "left")
    a, b = (f.select(*[F.col(c).alias(f"{c}_{x}") for c in f.columns], F.lit(1).alias("one")) for x in "ab")  # a registry of a few forms
    c = compatible(*[F.col(f"{n}_{x}") for x in "ab" for n in ("form", "group", "excluded")])
    return a.join(b, "one").select("form_a", "form_b", c.alias("is_compatible"))


def period_parse(spark, d):
    day = F.col("o_orderdate").cast("date")
    period = F.year(day).cast("long") * 100000 + F.dayofyear(day) - 1
    return market_data.table(spark, d, "orders").select(period.alias("PERIOD_ID")).distinct().select("PERIOD_ID", period_date(F.col("PERIOD_ID")).alias("Date"), monday(period_date(F.col("PERIOD_ID"))).alias("Monday"))


def comma_decimal(spark, d):
    text = F.replace(F.format_string("%.2f", F.col("l_extendedprice").cast("double")), F.lit("."), F.lit(","))
    return market_data.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", decimal_comma(text).alias("V"))


def top_volume(spark, d):
    return adhoc.top(volumes(spark, d), "volume", 20).select("DRUGS_ID", "volume")


def products_per_market(spark, d):
    s = stages(spark, d).series
    return s.groupBy("CLIENT_ID").agg(F.countDistinct("DRUGS_ID").alias("drugs"), F.countDistinct("INN_ID").alias("inns"), F.count("*").alias("rows"))


def recovery_counts(spark, d):
    """Events by what came after them."""
    return stockouts.with_post(stages(spark, d).events, PARAMS).groupBy("POST_STATUS").agg(F.count("*").alias("events"))


def market_summary(spark, d):
    """A row for each market with a series: its products, weeks, unsold runs, events, those with a POST period, and effects."""
    s = stages(spark, d)
    by = lambda df, name: df.groupBy("CLIENT_ID").agg(F.count("*").alias(name))
    rows = s.aggregated.groupBy("CLIENT_ID").agg(F.countDistinct("DRUGS_ID").alias("products"), F.count("*").alias("weeks"))
    for df, name in ((s.islands, "runs"), (s.events, "events"), (s.measured, "measured"), (s.did_events, "effects")):
        rows = rows.join(by(df, name), "CLIENT_ID", "left")
    return rows.fillna(0)


def file_rows(spark, d):
    """Weekly sums of all shops, read from raw market files."""
    sums = market_files.market_rows(spark, d).groupBy("CLIENT_ID", "PHARM_ID", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "INN_NAME", "NFC1_ID", "Date").agg(F.sum("Q").alias("Q"), F.sum("V").alias("V"))
    return round_all(sums, 2, "V")


def stored_did_events(spark, d):
    """did_events of a run over raw market files."""
    return market_files.stored_stage(spark, d, "did_events", PARAMS).select(*DID_EVENTS)


def stored_shares(spark, d):
    return market_files.stored_stage(spark, d, "substitute_shares", PARAMS).select(*MARKET_SHARES)


def stage_counts(spark, d):
    """What a run over raw market files counted while it wrote its stages."""
    return market_files.stage_counts(spark, d, PARAMS)


def published_coefficients(spark, d):
    """The published spreadsheet of a run over raw market files, read back."""
    back = market_files.published(spark, d, "drug_coefficients.xlsx", PARAMS)
    return back.select(*[F.col(c).cast("int") if c in ("MARKETS_WITH_SUB", "MARKET_COUNT") else F.col(c).cast("double") if c in ("COVERAGE_PCT", "CONDITIONAL_RETENTION", "COEF_1", "UNIQUENESS_COEF", "RELIABILITY_SCORE") else F.col(c) for c in DRUG_COEFFICIENTS])


def published_shares(spark, d):
    """The published text table of a run over raw market files, read back."""
    back = market_files.published(spark, d, "substitute_shares.csv", PARAMS)
    return back.select(*[F.col(c).cast("int") if c == "SUBSTITUTE_RANK" else F.col(c).cast("double") if c == "SUBSTITUTE_SHARE" else F.col(c) for c in FINAL_SHARES])


def top_substitutes(spark, d):
    rank = F.row_number().over(Window.partitionBy("DRUGS_ID").orderBy("SUBSTITUTE_RANK"))
    return stages(spark, d).final_shares.withColumn("n", rank).where("n <= 3").select("DRUGS_ID", "SUBSTITUTE_DRUG_ID", "SUBSTITUTE_SHARE", "SUBSTITUTE_RANK")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from lacuna.plans.sql import ORACLE

    rows_only = ("drug_modality",)
    return {n: globals()[n] for n in (*ORACLE, *rows_only)}
