"""Follow-on questions: reliability subsets, Pareto cuts, tiers, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.params import DEFAULT, Params
from lacuna.session import deals, stored


def with_reliability(volumes: DataFrame, coefficients: DataFrame) -> DataFrame:
    return volumes.join(coefficients.select("DRUGS_ID", "RELIABILITY_SCORE"), "DRUGS_ID", "left")


def matched(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count("*").alias("n"), F.count("RELIABILITY_SCORE").alias("n_matched")).withColumn("n_unmatched", F.col("n") - F.col("n_matched"))


def pareto(df: DataFrame, volume: str, key: str = "DRUGS_ID") -> DataFrame:
    """Running share of the volume, largest first, ties by key, and ``before``, the share of what comes earlier.

    Rows are dealt out by ranges of the order and stored; each range's sum and number then say where the next one starts, so no task
    orders more than a range."""
    spark, order = df.sparkSession, (F.desc(volume), F.asc(key))
    ranges = stored(df.repartitionByRange(deals(spark), *order).withColumn("range", F.spark_partition_id()))
    start, rows, total = [], 0, 0
    for r in ranges.groupBy("range").agg(F.count("*").alias("n"), F.sum(volume).alias("s")).orderBy("range").collect():  # a row for each range
        start.append((r.range, rows, float(total)))
        rows, total = rows + r.n, total + (r.s or 0)
    offsets = F.broadcast(spark.createDataFrame(start, "range int, rows_before long, sum_before double"))
    inside = Window.partitionBy("range").orderBy(*order)
    running = F.col("sum_before") + F.coalesce(F.sum(volume).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0.0))
    placed = ranges.join(offsets, "range").withColumns({"position": (F.col("rows_before") + F.row_number().over(inside)).cast("int"), "running": running})
    of_all = lambda x: F.try_divide(x, F.lit(float(total)))
    return placed.withColumns({"cum_share": of_all(F.col("running")), "before": of_all(F.col("running") - F.coalesce(volume, F.lit(0.0)))}).drop("range", "rows_before", "sum_before", "running")


def pareto_cut(df: DataFrame, volume: str, p: Params = DEFAULT, key: str = "DRUGS_ID") -> DataFrame:
    """Reliable products in order, up to and including the one that reaches the target; or the first top_n if no target is set."""
    kept = df.where(F.col("RELIABILITY_SCORE").between(p.reliability_low, p.reliability_high))
    if p.pareto_target is None:
        return top(kept, volume, p.top_n, key) if p.top_n else kept
    return pareto(kept, volume, key).where(F.col("before") < p.pareto_target).drop("before")


def top(df: DataFrame, volume: str, n: int, key: str = "DRUGS_ID") -> DataFrame:
    return df.orderBy(F.desc(volume), F.asc(key)).limit(n)


def tier(coef: Column, p: Params = DEFAULT) -> Column:
    return F.when(coef >= p.tier_a, "A").when(coef >= p.tier_b, "B").otherwise("C")


def tiers(coefficients: DataFrame, p: Params = DEFAULT) -> DataFrame:
    return coefficients.groupBy(tier(F.col("COEF_1"), p).alias("tier")).agg(F.count("*").alias("drugs"), F.avg("COEF_1").alias("mean_coef"))


def score_buckets(df: DataFrame, column: str = "RELIABILITY_SCORE") -> DataFrame:
    """Ten right-open buckets, the last one closed, with running counts and per cents. Empty buckets have no row."""
    bucket = F.least(F.lit(9), F.floor(F.col(column) * 10).cast("int"))
    counts = df.where(F.col(column).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("drugs"))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns({"cumulative": F.sum("drugs").over(running), "pct": F.col("drugs") * 100.0 / F.sum("drugs").over(Window.partitionBy())})


#: The scores that the method's report counts at.
THRESHOLDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9)


def score_sweep(df: DataFrame, column: str = "RELIABILITY_SCORE", thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """How many rows reach each threshold, in one pass."""
    one = df.agg(*[F.count_if(F.col(column) >= t).alias(f"t{i}") for i, t in enumerate(thresholds)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("passing")) for i, t in enumerate(thresholds)])).alias("r")).select("r.*")


def described(df: DataFrame, column: str = "RELIABILITY_SCORE") -> DataFrame:
    c = F.col(column)
    quantiles = F.percentile(c, F.array(*[F.lit(q) for q in (0.10, 0.25, 0.50, 0.75, 0.90)]))
    one = df.agg(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), quantiles.alias("q"))
    return one.select("n", "low", "high", "mean", "std", *[F.col("q")[i].alias(n) for i, n in enumerate(("p10", "p25", "p50", "p75", "p90"))])


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last one closed."""
    c = F.col(column).cast("double")
    values = df.where(c.isNotNull()).select(c.alias("x"))
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()  # one row
    rows = values.groupBy("x").agg(F.count("*").alias("n")).withColumns({"lo": F.lit(ends.lo).cast("double"), "hi": F.lit(ends.hi).cast("double")})
    place = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))).otherwise(0)
    return rows.groupBy(F.least(F.lit(bins - 1), place.cast("int")).alias("bin")).agg(F.sum("n").alias("n"))


def subset(shares: DataFrame, keep: DataFrame) -> DataFrame:
    return shares.join(keep.select("DRUGS_ID"), "DRUGS_ID", "left_semi")


def without_pairs(keep: DataFrame, shares: DataFrame) -> DataFrame:
    return keep.join(shares.select("DRUGS_ID"), "DRUGS_ID", "left_anti")


#: The coefficients whose contours the chart shows.
LEVELS = (0.25, 0.50, 0.75)


def contours(coefficients: DataFrame, levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """Each product beside the contours coefficient = coverage * retention: the retention of a contour at its coverage, and whether it lies on it or above."""
    coverage, retention = F.col("COVERAGE_PCT"), F.col("CONDITIONAL_RETENTION")
    rows = coefficients.select("DRUGS_ID", coverage.alias("coverage"), retention.alias("retention"), F.explode(F.array(*map(F.lit, levels))).alias("level"))
    return rows.select("DRUGS_ID", "level", "coverage", F.least(F.lit(1.0), F.try_divide("level", "coverage")).alias("contour"), (F.col("coverage") * F.col("retention") >= F.col("level")).alias("above"))
