"""Column expressions of the method."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column, places: int) -> Column:
    """Half up, as floor(x * 10**places + 0.5) / 10**places: the same double arithmetic in any engine."""
    scale = float(10**places)
    return F.floor(c * scale + 0.5) / scale


def period_date(period: Column) -> Column:
    """YYYYNNNNN -> 1 January of the year plus NNNNN days, which may run past the year's end."""
    return F.date_add(F.make_date((period / 100000).cast("int"), F.lit(1), F.lit(1)), (period % 100000).cast("int"))


def monday(date: Column) -> Column:
    return F.date_trunc("week", date).cast("date")


def decimal_comma(text: Column) -> Column:
    """'1,5' -> 1.5; blank text is null; other malformed text raises under ANSI mode."""
    return F.nullif(F.trim(F.replace(text.cast("string"), F.lit(","), F.lit("."))), F.lit("")).cast("double")


def growth(pre: Column, during: Column, least: float) -> Column:
    return F.when(pre < least, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.try_divide(during, pre)))


def expected(pre: Column, market_growth: Column) -> Column:
    return F.greatest(F.lit(0.0), pre * market_growth)


def lift(actual: Column, expectation: Column) -> Column:
    return F.greatest(F.lit(0.0), actual - expectation)


def share(part: Column, total: Column, least: float) -> Column:
    """part / total; null where the total is below the least effect."""
    return F.when(total >= least, part / total)


def weeks_between(later: Column, earlier: Column) -> Column:
    return F.floor(F.datediff(later, earlier) / 7)


def compatible(form_a: Column, group_a: Column, excluded_a: Column, form_b: Column, group_b: Column, excluded_b: Column) -> Column:
    """Neither form excluded, and both the same or in one named group; a form that no group names stands alone."""
    no = lambda e: ~F.coalesce(e, F.lit(False))
    same_group = F.coalesce(group_a == group_b, F.lit(False))
    return no(excluded_a) & no(excluded_b) & (F.coalesce(form_a == form_b, F.lit(False)) | same_group)


def compatibility_group(group: Column, excluded: Column) -> Column:
    return F.when(F.coalesce(excluded, F.lit(False)), "EXCLUDED").when(group.isNotNull(), group).otherwise("EXACT_MATCH")
