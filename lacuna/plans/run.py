"""The whole method over raw market files: discovery, per-market stages, statistics, checks, published tables.

Per-market stages are stored in batches of markets under ``out/markets``. A market's key is a digest of its file (path,
length, time of change), the form registry's rules, the parameters and the method's number, so a change of any of them makes that
market anew and no other, and any subset of markets reads what is there. A batch's rows are read from the raw files once, then
each stage is a Parquet table in buckets by market and INN, so no stage deals rows out again. What a run says of its stages is
counted in the jobs that write them. A batch is a folder of versions (lacuna.plans.store): it counts once committed, a run that was
cut short goes on from the last whole stage, and one with ``force`` writes beside the version that counts.

A market whose file has malformed values, broken rows or several CLIENT_IDs is left out of its batch with the status ``error`` and
the reason; the others go on.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators import crossmarket, did, export, shares, stockouts, weekly
from lacuna.params import DEFAULT, Params
from lacuna.plans import store
from lacuna.session import tuned
from lacuna.sources import markets, sheets
from lacuna.sources.files import exists, listed, qualified

log = logging.getLogger(__name__)

#: The method's number: one more with every change that alters results, so that no older table is taken for a new one.
METHOD = 3
#: The phases of the per-market part, in order; a run may stop after any of them and another goes on from there.
PHASES = ("aggregate", "stockouts", "effects", "shares")


class NotReady(Exception):
    """What a run needs isn't there."""


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, default=repr, ensure_ascii=False).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Market:
    """A market of a stored batch: its status is success, no_data, error, or the phase that a run stopped after."""

    client: int
    key: str
    batch: str
    status: str
    reason: str
    made: str = ""


def batches(spark: SparkSession, out: str) -> list[tuple[str, dict, int]]:
    """(folder of the version that counts, what its commit says, time) of all committed batches, oldest first."""
    last = {}
    for path, _, changed in listed(spark, f"{out}/markets", "*/commit-*.json"):
        last[path.rsplit("/", 1)[0]] = changed
    return [(*store.current(spark, base), changed) for base, changed in sorted(last.items(), key=lambda x: (x[1], x[0]))]


def stored_markets(spark: SparkSession, out: str) -> dict[str, Market]:
    """The markets of all committed batches by their keys; of a key that several have, the last one written."""
    found: dict[str, Market] = {}
    for place, content, changed in batches(spark, out):
        for row in content["markets"]:
            found[row["key"]] = Market(row["client"], row["key"], place, row["status"], row["reason"], str(changed))
    return found


def preflight(spark: SparkSession, raw: str, ids: list[int] | None = None, limit: int | None = None, p: Params = DEFAULT, saved: str | None = None) -> list:
    """The ready markets of a raw folder, one row each; NotReady if there are none. saved: a market list, whose ready files alone are looked at."""
    if not exists(spark, raw):
        raise NotReady(f"no folder {raw}")
    only = None
    if saved is not None:
        if not exists(spark, saved):
            raise NotReady(f"no market list {saved}")
        only = {r.FILE_NAME for r in markets.ready(markets.load_market_list(spark, saved), ids).collect()}  # a row for each file
    found = markets.discover(spark, raw, p=p, only=only).collect()  # a row for each file
    if not found:
        raise NotReady(f"no market files in {raw}")
    for name in sorted((only or set()) - {m.FILE_NAME for m in found}):
        log.warning("%s of the market list isn't there", name)
    ready = {}
    for m in found:
        if m.STATUS != "READY":
            log.warning("%s is left out: %s, %s", m.FILE_NAME, m.STATUS, m.REASON)
        elif not ids or m.CLIENT_ID in ids:
            if m.CLIENT_ID in ready:
                log.warning("market %s has several files; %s is taken", m.CLIENT_ID, m.FILE_NAME)
            ready[m.CLIENT_ID] = m
    for i in sorted(set(ids or ()) - set(ready)):
        log.warning("market %s has no ready file", i)
    if not ready:
        raise NotReady("no market is ready")
    return [ready[c] for c in sorted(ready)][:limit]


def run_markets(spark: SparkSession, raw: str, out: str, registry: str | None = None, ids: list[int] | None = None, limit: int | None = None, force: bool = False, p: Params = DEFAULT, saved: str | None = None, upto: str = PHASES[-1]) -> list[Market]:
    """The per-market stages of the ready markets; those that are stored already aren't made again. upto: the last phase to run."""
    tuned(spark)
    out = qualified(spark, out)
    found = preflight(spark, raw, ids, limit, p, saved)
    rules = markets.form_rules(spark, registry)
    rows = sorted(map(tuple, rules.collect()), key=str)  # a registry of forms
    keys = {digest(METHOD, m.FILE_PATH, m.FILE_LENGTH, m.CHANGED, rows, p): m for m in found}
    stored = {} if force else stored_markets(spark, out)
    if missing := {k: m for k, m in keys.items() if k not in stored}:
        made = make_batch(spark, f"{out}/markets/{digest(sorted(missing))}", missing, rules, [r[0] for r in rows], p, force, upto)
        stored |= {m.key: m for m in made}
    return [stored[k] for k in keys]


def _left_out(rows: DataFrame, counts: dict, missing: dict) -> dict[str, str]:
    """Files with something wrong and the reason. Looked for only if the rows' own counts say that there is something."""
    if not counts["malformed"] and not counts["stray"]:
        return {}
    bad, names = {}, {m.FILE_NAME for m in missing.values()}
    for h in markets.health(rows).collect():  # a row for each file
        if h.FILE_NAME in names and (h.malformed or h.one_client is False):
            bad[h.FILE_NAME] = f"{h.malformed} of {h.rows} rows are malformed, such as {h.example}" if h.malformed else "several CLIENT_IDs"
            log.error("%s is left out: %s", h.FILE_NAME, bad[h.FILE_NAME])
    return bad


def make_batch(spark: SparkSession, base: str, missing: dict, rules: DataFrame, named: list[str], p: Params, force: bool, upto: str = PHASES[-1]) -> list[Market]:
    """The stages of some markets in a new version of the batch, which is committed after the last phase. named: forms that the registry has rules for."""
    place, counted = store.begun(spark, base, force), {}

    def stage(name: str, make, counts: dict | None = None, how: str | None = "dealt") -> DataFrame:
        df, counted[name] = store.written(spark, f"{place}/{name}", make, {"rows": F.count("*")} | (counts or {}), how)
        return df

    def ended(status: dict[str, str] | None = None) -> list[Market]:
        state = lambda m: "error" if m.FILE_NAME in bad else status.get(m.CLIENT_ID, "no_data") if status is not None else upto
        rows_ = [{"client": m.CLIENT_ID, "key": k, "status": state(m), "reason": bad.get(m.FILE_NAME, "")} for k, m in missing.items()]
        if status is not None:
            store.commit(spark, place, {"markets": rows_, "counts": counted})
        return [Market(r["client"], r["key"], place, r["status"], r["reason"]) for r in rows_]

    files = list(missing.values())
    expected = F.broadcast(spark.createDataFrame([(m.FILE_NAME, m.CLIENT_ID) for m in files], "FILE_NAME string, EXPECTED long"))  # a row for each file
    read = lambda: markets.parsed(markets.raw_rows(spark, markets.files_of(files))).join(expected, "FILE_NAME")
    rows = stage("rows", read, {"malformed": F.count("MALFORMED"), "stray": F.count_if(F.col("CLIENT_ID") != F.col("EXPECTED"))}, "FILE_NAME")
    bad = _left_out(rows, counted["rows"], missing)
    good = rows.where(~F.col("FILE_NAME").isin(*bad)) if bad else rows
    agg = stage("aggregated", lambda: weekly.aggregate_markets(good.drop("MALFORMED", "FILE_NAME", "EXPECTED"), p), {"forms": F.collect_set("NFC1_ID")})  # a catalogue's forms
    for form in markets.unknown_forms(counted["aggregated"]["forms"], named) if named else ():
        log.warning("no rule names the form %s: it stands alone", form)
    if upto == "aggregate":
        return ended()
    reasons = {r: F.count_if(F.col("reason") == r) for r in stockouts.REASONS}
    runs = stage("stockout_runs", lambda: stockouts.judged(stockouts.islands(agg, p), p), reasons)
    status = {s: F.count_if(F.col("POST_STATUS") == s) for s in stockouts.POST_STATUSES}
    events = stage("stockout_events", lambda: stockouts.with_post(stockouts.stockout_events(runs, p), p), status)
    if upto == "stockouts":
        return ended()
    measured = did.measured(events, p)
    pairs = stage("pairs", lambda: did.candidate_pairs(measured, agg, rules), {"with_gain": F.count_if(F.col("gain") > 0)})
    stage("did_events", lambda: did.did_events(measured, pairs, p), {"clients": F.collect_set("CLIENT_ID")})  # a batch's markets
    substitutes = stage("substitute_pairs", lambda: did.substitute_pairs(pairs, p))
    if upto == "effects":
        return ended()
    stage("substitute_shares", lambda: shares.market_shares(substitutes, crossmarket.inn_names(agg)), how=None)
    return ended(dict.fromkeys(counted["did_events"]["clients"], "success"))


def summary(spark: SparkSession, out: str, which: list[Market]) -> dict:
    """How a run went: markets by status and by reason, and the counts of each stage summed over their batches."""
    stages: dict[str, Counter] = {}
    used = {m.batch for m in which}
    for place, content, _ in batches(spark, out.rstrip("/")):
        if place in used:
            for name, counts in content["counts"].items():
                stages.setdefault(name, Counter()).update({k: len(v) if isinstance(v, list) else v for k, v in counts.items()})
    return {
        "markets": len(which),
        "status": dict(sorted(Counter(m.status for m in which).items())),
        "reasons": {str(m.client): m.reason for m in which if m.reason},
        "stages": {name: dict(counts) for name, counts in stages.items()},
    }


def log_summary(told: dict) -> None:
    log.info("%d markets: %s", told["markets"], ", ".join(f"{n} {s}" for s, n in told["status"].items()))
    for client, reason in told["reasons"].items():
        log.info("market %s: %s", client, reason)
    for name, counts in told["stages"].items():
        log.info("%s: %s", name, ", ".join(f"{n} {k}" for k, n in counts.items()))


def chosen(spark: SparkSession, out: str, ids: list[int] | None = None) -> list[Market]:
    """The stored markets that gave data, the last of each, or of the ids only."""
    last = {m.client: m for m in sorted(stored_markets(spark, out.rstrip("/")).values(), key=lambda m: int(m.made)) if m.status != "error"}
    found = [last[c] for c in sorted(last) if not ids or c in ids]
    for i in sorted(set(ids or ()) - set(last)):
        log.warning("market %s isn't stored", i)
    if not found:
        raise NotReady("no market is stored")
    return found


#: The stored tables that the part across markets reads.
ACROSS = ("did_events", "aggregated", "substitute_shares")


def unreadable(spark: SparkSession, which: list[Market], names: tuple[str, ...] = ACROSS) -> dict[str, str]:
    """What of stored markets' tables can't be read, each file by its path: tables that aren't whole, and files that are damaged. They are logged."""
    bad, files = {}, []
    for place in sorted({m.batch for m in which}):
        for name in names:
            if store.described(spark, f"{place}/{name}") is None:
                bad[f"{place}/{name}"] = "the table isn't whole"
            else:
                files += [path for path, _, _ in listed(spark, f"{place}/{name}", "*.parquet")]
    bad |= store.unreadable(spark, files)
    for path, reason in sorted(bad.items()):
        log.warning("%s is skipped: %s", path, reason)
    return bad


def stage_of(spark: SparkSession, which: list[Market], name: str, without: dict[str, str] | None = None) -> DataFrame:
    """A stage's rows of stored markets. without: files and tables to leave out; what else can't be read fails the job."""
    by_batch: dict[str, list[int]] = {}
    for m in which:
        by_batch.setdefault(m.batch, []).append(m.client)
    parts = []
    for place, clients in by_batch.items():
        path = f"{place}/{name}"
        told = store.described(spark, path)
        if told is None:
            if path in (without or ()):
                continue
            raise NotReady(f"{path} isn't whole")
        df = store.opened(spark, path, told)
        if any(bad.startswith(f"{path}/") for bad in without or ()):
            left = [f for f, _, _ in listed(spark, path, "*.parquet") if f not in without]
            df = spark.read.schema(df.schema).parquet(*left) if left else df.limit(0)
        parts.append(df.where(F.col("CLIENT_ID").isin(clients)))
    if not parts:
        raise NotReady(f"no table of {name} is whole")
    return reduce(DataFrame.unionByName, parts)


def across(out: str, which: list[Market], p: Params, without: dict[str, str] | None = None) -> str:
    """The folder of results of these markets without these files: what a run skipped is no whole result of all."""
    return f"{out.rstrip('/')}/across/{digest(METHOD, sorted((m.key, m.batch) for m in which), p, sorted(without or ()))}"


def run_cross_market(spark: SparkSession, out: str, which: list[Market], p: Params = DEFAULT, force: bool = False, without: dict[str, str] | None = None) -> DataFrame:
    """drug_statistics across some stored markets."""
    make = lambda: crossmarket.drug_statistics(crossmarket.market_drug(stage_of(spark, which, "did_events", without)), crossmarket.inn_names(stage_of(spark, which, "aggregated", without)), p)
    return store.versioned(spark, f"{across(out, which, p, without)}/drug_statistics", make, force)


def run_export(spark: SparkSession, out: str, which: list[Market], p: Params = DEFAULT, publish: str | None = None, force: bool = False, without: dict[str, str] | None = None) -> bool:
    """Whether all checks passed. Tables are published (CSV and spreadsheets in ``publish``) only if they did."""
    dc = export.drug_coefficients(run_cross_market(spark, out, which, p, force, without), p)
    make = lambda: shares.final_shares(stage_of(spark, which, "substitute_shares", without), dc)
    final = store.versioned(spark, f"{across(out, which, p, without)}/final_shares", make, force)
    checks = export.validate(dc, final, p)
    if publish is None:
        return checks.where("NOT passed").isEmpty()
    publish = publish.rstrip("/")
    good = sheets.report(checks, f"{publish}/validation_report.txt")
    if good:
        for name, sheet, df, order in (("drug_coefficients", "Drug Coefficients", dc, ["COEF_1", "DRUGS_ID"]), ("substitute_shares", "Substitute Shares", final, ["DRUGS_ID", "SUBSTITUTE_RANK"])):
            df = df.orderBy(*order, ascending=[name != "drug_coefficients", True])
            sheets.write_csv(df, f"{publish}/{name}.csv")
            sheets.write_xlsx(df, f"{publish}/{name}.xlsx", sheet)
    return good


def run(spark: SparkSession, raw: str, out: str, registry: str | None = None, ids: list[int] | None = None, limit: int | None = None, force: bool = False, p: Params = DEFAULT, publish: str | None = None, saved: str | None = None) -> bool:
    """All stages; whether all checks passed. Markets that failed are left out and logged."""
    which = run_markets(spark, raw, out, registry, ids, limit, force, p, saved)
    log_summary(summary(spark, out, which))
    good = [m for m in which if m.status != "error"]
    if not good:
        raise NotReady("every market failed")
    return run_export(spark, out, good, p, publish, force)
