"""Command line of the method.

Exit codes: 0 all went well, 1 checks failed, 2 what a command needs isn't there or it broke off, 130 interrupted."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from lacuna.params import Params
from lacuna.plans import run as runs
from lacuna.plans import subset
from lacuna.sources import markets

log = logging.getLogger(__name__)


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lacuna")
    top.add_argument("--log", help="write the log to this file, too")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *groups: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name)
        if "raw" in groups:
            c.add_argument("--raw", required=True)
            c.add_argument("--limit", type=int)
            if name != "discover":
                c.add_argument("--saved-list", help="look at the ready files of this market list only")
        if "out" in groups:
            c.add_argument("--out", required=True)
            c.add_argument("--market-ids", "--markets", type=int, nargs="*")
            c.add_argument("--force", action="store_true")
        if "registry" in groups:
            c.add_argument("--registry")
        if "export" in groups:
            c.add_argument("--publish")
            c.add_argument("--min-market-count", type=int, default=Params().min_market_count)
            c.add_argument("--skip-unreadable", action="store_true")
        return c

    found = command("discover", "raw", "registry")
    found.add_argument("--list", help="write the market list to this file")
    command("run", "raw", "out", "registry", "export")
    command("markets", "raw", "out", "registry").add_argument("--upto", choices=runs.PHASES, default=runs.PHASES[-1], help="the last phase to run; a later run goes on from there")
    command("summary", "out")
    command("cross-market", "out", "export")
    command("export", "out", "export")
    chosen = commands.add_parser("filter")
    for name in ("volumes", "coefficients", "to"):
        chosen.add_argument(f"--{name}", required=True)
    chosen.add_argument("--report")
    chosen.add_argument("--volume", default=subset.VOLUME)
    chosen.add_argument("--low", type=float, default=Params().reliability_low)
    chosen.add_argument("--high", type=float, default=Params().reliability_high)
    chosen.add_argument("--pareto", type=float, default=Params().pareto_target)
    chosen.add_argument("--top", type=int, help="so many products instead of the Pareto target")
    chosen.add_argument("--with-score", action="store_true")
    pairs = commands.add_parser("substitutes")
    for name in ("products", "shares", "to"):
        pairs.add_argument(f"--{name}", required=True)
    return top


def done(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.command == "discover":
        if not runs.exists(spark, a.raw):
            raise runs.NotReady(f"no folder {a.raw}")
        found = markets.discover(spark, a.raw, limit=a.limit)
        rows = found.collect()  # a row for each file
        if a.list:
            markets.save_market_list(found, a.list)
        if a.registry:
            log.info("new forms: %s", ", ".join(markets.update_registry(spark, rows, a.registry)) or "none")
        for r in rows:
            log.info("%s %s %s %.2f MB %s", r.STATUS, r.CLIENT_ID, r.FILE_NAME, r.FILE_SIZE_MB, r.REASON)
        for r in markets.status_counts(found).orderBy("STATUS").collect():
            log.info("%s: %d files, %.2f MB", r.STATUS, r.files, r.mb)
        return 0
    if a.command == "filter":
        p = Params(reliability_low=a.low, reliability_high=a.high, pareto_target=None if a.top else a.pareto, top_n=a.top)
        log.info("%d products", subset.run_filter(spark, a.volumes, a.coefficients, a.to, a.report, a.volume, p, a.with_score))
        return 0
    if a.command == "substitutes":
        log.info("%d pairs; %d products have none", *subset.run_substitutes(spark, a.products, a.shares, a.to))
        return 0
    if a.command == "run":
        p = Params(min_market_count=a.min_market_count)
        return 0 if runs.run(spark, a.raw, a.out, a.registry, a.market_ids, a.limit, a.force, p, a.publish, a.saved_list) else 1
    if a.command == "markets":
        found = runs.run_markets(spark, a.raw, a.out, a.registry, a.market_ids, a.limit, a.force, saved=a.saved_list, upto=a.upto)
        runs.log_summary(runs.summary(spark, a.out, found))
        return 1 if any(m.status == "error" for m in found) else 0
    if a.command == "summary":
        stored = [m for m in runs.stored_markets(spark, a.out.rstrip("/")).values() if not a.market_ids or m.client in a.market_ids]
        runs.log_summary(runs.summary(spark, a.out, stored))
        return 0 if stored else 2
    which = runs.chosen(spark, a.out, a.market_ids)
    p = Params(min_market_count=a.min_market_count)
    without = runs.unreadable(spark, which) if a.skip_unreadable else None
    if a.command == "cross-market":
        log.info("%d products", runs.run_cross_market(spark, a.out, which, p, a.force, without).count())
        return 0
    return 0 if runs.run_export(spark, a.out, which, p, a.publish, a.force, without) else 1


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    handlers = [logging.StreamHandler(), *([logging.FileHandler(a.log, encoding="utf-8")] if a.log else [])]
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=handlers)
    spark = SparkSession.builder.appName("lacuna").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return done(spark, a)
    except KeyboardInterrupt:
        log.warning("interrupted")
        return 130
    except runs.NotReady as e:
        log.error("%s", e)
        return 2
    except Exception:
        log.exception("broke off")
        return 2


if __name__ == "__main__":
    sys.exit(main())
