"""The whole method as one chain of lazy tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from lacuna.operators import crossmarket, did, export, shares, stockouts, weekly
from lacuna.params import DEFAULT, Params
from lacuna.session import dealt, stored


class Stages:
    """Tables of every stage from the target's rows, competitors' totals and the form registry. Only what a table needs is run.

    Tables that several later stages read are written to the shared folder when they are first asked for: they are made once,
    a lost executor costs nothing of them, and plans stay short (tables kept in memory would be part of every later plan, as
    often as paths lead to them). Those of market and INN are bucketed by these, as their rows are dealt out once, so what reads them
    goes on without a shuffle by market and INN."""

    def __init__(self, target: DataFrame, competitors: DataFrame, forms: DataFrame, p: Params = DEFAULT, dip_test: bool = True):
        self.target, self.competitors, self.forms, self.p, self.dip_test = target, competitors, forms, p, dip_test

    @cached_property
    def series(self) -> DataFrame:
        return weekly.aggregated(self.target, self.competitors, self.p)

    @cached_property
    def aggregated(self) -> DataFrame:
        """series, stored."""
        return dealt(self.series, order=(*stockouts.KEYS, "Date"))

    @cached_property
    def inn_names(self) -> DataFrame:
        return crossmarket.inn_names(self.aggregated)

    @cached_property
    def islands(self) -> DataFrame:
        return dealt(stockouts.islands(self.aggregated, self.p))

    @cached_property
    def events(self) -> DataFrame:
        return stockouts.stockout_events(self.islands, self.p)

    @cached_property
    def measured(self) -> DataFrame:
        return dealt(did.measured_events(self.events, self.p))

    @cached_property
    def pairs(self) -> DataFrame:
        return dealt(did.candidate_pairs(self.measured, self.aggregated, self.forms))

    @cached_property
    def did_events(self) -> DataFrame:
        return did.did_events(self.measured, self.pairs, self.p)

    @cached_property
    def substitute_pairs(self) -> DataFrame:
        return did.substitute_pairs(self.pairs, self.p)

    @cached_property
    def market_shares(self) -> DataFrame:
        return shares.market_shares(self.substitute_pairs, self.inn_names)

    @cached_property
    def market_drug(self) -> DataFrame:
        return stored(crossmarket.market_drug(self.did_events))

    @cached_property
    def drug_statistics(self) -> DataFrame:
        return crossmarket.drug_statistics(self.market_drug, self.inn_names, self.p, self.dip_test)

    @cached_property
    def drug_coefficients(self) -> DataFrame:
        return stored(export.drug_coefficients(self.drug_statistics, self.p))

    @cached_property
    def final_shares(self) -> DataFrame:
        return stored(shares.final_shares(self.market_shares, self.drug_coefficients))

    @cached_property
    def checks(self) -> DataFrame:
        return export.every_check(self.drug_coefficients, self.final_shares, self.p)
