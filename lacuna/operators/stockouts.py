"""Stock-out episodes: runs of unsold weeks, validated on three levels, with what the later stages need of them.

All sums of a run come from its own rows or from window frames at its first row, so no interval is joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.functions.scalars import rounded, weeks_between
from lacuna.params import DEFAULT, Params
from lacuna.schemas import STOCKOUT_EVENTS

KEYS = ("CLIENT_ID", "INN_ID", "DRUGS_ID")
#: What judged says of a run, and with_post of an event.
REASONS = ("valid", "no_market_activity", "no_pre_sales", "no_competitors")
POST_STATUSES = ("valid", "no_recovery", "gap_too_large", "insufficient_data")


def islands(agg: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Every run of unsold weeks of at least the minimum length, with its PRE sums and the next sale after it."""
    day = F.unix_date("Date")
    inn = Window.partitionBy("CLIENT_ID", "INN_ID").orderBy(day)  # frames by day: all products of the INN together
    before = lambda *keys: Window.partitionBy(*keys).orderBy(day).rangeBetween(-7 * p.pre_weeks, -7)
    series = Window.partitionBy(*KEYS)
    next_sale = f"lead(IF(Q > 0, Date, NULL), 1) IGNORE NULLS OVER (PARTITION BY {', '.join(KEYS)} ORDER BY Date)"
    rows = agg.withColumns({
        "inn_total": F.sum("MARKET_TOTAL_DRUGS_PACK").over(inn.rangeBetween(0, 0)),
        "inn_pre": F.coalesce(F.sum("MARKET_TOTAL_DRUGS_PACK").over(before("CLIENT_ID", "INN_ID")), F.lit(0.0)),
        "pre_sum": F.sum("Q").over(before(*KEYS)),
        "pre_rows": F.count("*").over(before(*KEYS)),
        "comp_pre": F.coalesce(F.sum("MARKET_TOTAL_DRUGS_PACK").over(before(*KEYS)), F.lit(0.0)),
        "next_sale": F.expr(next_sale),
        "last_week": F.max("Date").over(series),
    })
    zero = rows.where("Q = 0").withColumn("island", day - 7 * F.row_number().over(series.orderBy("Date")))
    at_start = [F.min_by(c, "Date").alias(c) for c in ("pre_sum", "pre_rows", "comp_pre", "inn_pre")]
    runs = zero.groupBy(*KEYS, "island").agg(
        *[F.min(c).alias(c) for c in ("INN_NAME", "DRUGS_NAME", "NFC1_ID")],
        F.min("Date").alias("STOCKOUT_START"),
        F.max("Date").alias("STOCKOUT_END"),
        F.count("*").cast("int").alias("STOCKOUT_WEEKS"),
        *at_start,
        F.max("next_sale").alias("next_sale"),
        F.max("last_week").alias("last_week"),
        F.sum("inn_total").alias("inn_during"),
        F.sum("MARKET_TOTAL_DRUGS_PACK").alias("comp_during"),
    )
    return runs.where(F.col("STOCKOUT_WEEKS") >= p.min_stockout_weeks).drop("island")


def judged(runs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """runs with ``reason``: the first level that fails, or valid."""
    no_pre = (F.col("pre_rows") < p.pre_weeks) | (F.coalesce("pre_sum", F.lit(0.0)) == 0)
    reason = F.when(F.col("inn_during") == 0, "no_market_activity").when(no_pre, "no_pre_sales").when(F.col("comp_during") == 0, "no_competitors").otherwise("valid")
    return runs.withColumn("reason", reason)


def stockout_events(runs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Valid runs (judged or not) as events, numbered within their market; columns beyond STOCKOUT_EVENTS serve the next stage.

    A number is the events of the market's smaller INNs, one count for each, and the place within the INN, so events stay where they are."""
    valid = judged(runs, p).where("reason = 'valid'")
    smaller = Window.partitionBy("CLIENT_ID").orderBy("INN_ID").rowsBetween(Window.unboundedPreceding, -1)
    before = valid.groupBy("CLIENT_ID", "INN_ID").agg(F.count("*").alias("n")).select("CLIENT_ID", "INN_ID", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("smaller"))
    number = F.col("smaller") + F.row_number().over(Window.partitionBy("CLIENT_ID", "INN_ID").orderBy("DRUGS_ID", "STOCKOUT_START"))
    return valid.join(before, ["CLIENT_ID", "INN_ID"]).withColumns({
        "EVENT_ID": F.format_string("%d_%d_%04d", "CLIENT_ID", "INN_ID", number),
        "PRE_START": F.date_sub("STOCKOUT_START", 7 * p.pre_weeks),
        "PRE_END": F.date_sub("STOCKOUT_START", 7),
        "PRE_WEEKS": F.lit(p.pre_weeks),
        "PRE_AVG_Q": rounded(F.col("pre_sum") / F.col("pre_rows"), 4),
    }).drop("reason", "smaller")


def event_table(events: DataFrame) -> DataFrame:
    return events.select(*STOCKOUT_EVENTS)


def validation_funnel(runs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return judged(runs, p).groupBy("reason").agg(F.count("*").alias("events"), F.sum("STOCKOUT_WEEKS").alias("weeks"))


def with_post(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """POST period: from the first sale after the event, which must come soon and be followed by enough weeks."""
    left = weeks_between(F.col("last_week"), F.col("next_sale")) + 1
    status = F.when(F.col("next_sale").isNull(), "no_recovery").when(weeks_between(F.col("next_sale"), F.col("STOCKOUT_END")) > p.max_gap_weeks, "gap_too_large").when(left < p.post_weeks, "insufficient_data").otherwise("valid")
    valid = F.col("POST_STATUS") == "valid"
    return events.withColumn("POST_STATUS", status).withColumns({
        "POST_START": F.when(valid, F.col("next_sale")),
        "POST_END": F.when(valid, F.date_add("next_sale", 7 * (p.post_weeks - 1))),
        "POST_WEEKS": F.when(valid, F.lit(p.post_weeks)).otherwise(0),
    })
