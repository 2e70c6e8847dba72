"""The follow-on question over published tables: products of good reliability that make up most of the sales, and their substitutes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators import adhoc
from lacuna.params import DEFAULT, Params
from lacuna.plans.report import statistics
from lacuna.sources import sheets

#: The column of sales volumes, and the sheets' names.
VOLUME, COEFFICIENTS_SHEET, SHARES_SHEET = "Обсяг (UAH)", "Drug Coefficients", "Substitute Shares"


def products(volumes: DataFrame, coefficients: DataFrame, volume: str = VOLUME, p: Params = DEFAULT, with_score: bool = False) -> DataFrame:
    """The reliable products up to the Pareto target, largest first, with the columns and types of ``volumes``."""
    kept = adhoc.pareto_cut(adhoc.with_reliability(volumes, coefficients), volume, p)
    columns = [*volumes.columns, *(["RELIABILITY_SCORE"] if with_score else [])]
    return kept.orderBy(F.desc(volume), F.asc("DRUGS_ID")).select(*[F.col(f"`{c}`") for c in columns])


def run_filter(spark: SparkSession, volumes: str, coefficients: str, to: str, report: str | None = None, volume: str = VOLUME, p: Params = DEFAULT, with_score: bool = False) -> int:
    """Reads both tables by their extensions and writes the chosen products as a spreadsheet, and the statistics as text; how many were chosen."""
    v, c = sheets.read_table(spark, volumes), sheets.read_table(spark, coefficients)
    found = products(v, c, volume, p, with_score)
    sheets.write_xlsx(found, to, COEFFICIENTS_SHEET)
    if report:
        statistics(adhoc.with_reliability(v, c), volume, report)
    return found.count()


def run_substitutes(spark: SparkSession, chosen: str, shares: str, to: str) -> tuple[int, int]:
    """Writes the pairs of the chosen products; how many pairs, and how many products have none."""
    keep, pairs = sheets.read_table(spark, chosen), sheets.read_table(spark, shares)
    found = adhoc.subset(pairs, keep.select("DRUGS_ID").distinct())
    sheet = sheets.sheet_name(shares) if shares.lower().endswith(".xlsx") else SHARES_SHEET
    sheets.write_xlsx(found.orderBy("DRUGS_ID", "SUBSTITUTE_RANK"), to, sheet)
    return found.count(), adhoc.without_pairs(keep.select("DRUGS_ID").distinct(), pairs).count()
