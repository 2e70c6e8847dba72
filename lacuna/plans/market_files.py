"""The order tables as raw market files: written by Spark in the input contract's format, then taken through the path of raw files.

A market's file holds its own shop's rows and those of its region's other shops. What comes out must equal the chain over tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.params import Params
from lacuna.plans import market_data, run
from lacuna.schemas import RAW_REQUIRED
from lacuna.session import new_folder, stored, tuned
from lacuna.sources import markets, sheets
from lacuna.sources.files import listed, move, write_text


def comma(c: str) -> Column:
    return F.replace(F.format_string("%.2f", c), F.lit("."), F.lit(","))


def write_market_files(sold: DataFrame, folder: str) -> None:
    """A semicolon-separated file for each market, by its id. A market's rows are one task's: a file has one writer."""
    shops = sold.select("REGION", F.col("CLIENT_ID").alias("market")).distinct()
    first = F.concat(F.year("Date").cast("string"), F.lpad((F.dayofyear("Date") - 1).cast("string"), 5, "0"))
    values = {
        "ORG_ID": F.col("PHARM_ID"), "CLIENT_ID": F.col("market"), "DRUGS_ID": F.col("DRUGS_ID"), "PERIOD_ID": first, "Q": comma("Q"), "V": comma("V"), "INN": F.col("INN_NAME"), "INN_ID": F.col("INN_ID"),
        "Full medication name": F.col("DRUGS_NAME"), "NFC Code (1)": F.col("NFC1_ID"), "NFC Code (2)": F.col("NFC_ID"), "ATC Code (4)": F.lit("-"), "ATC Code (5)": F.lit("-"),
    }
    rows = sold.join(F.broadcast(shops), "REGION")  # a row for each market
    raw = rows.select(*[values[c].cast("string").alias(c) for c in RAW_REQUIRED], "market")
    raw.repartition("market").write.partitionBy("market").csv(folder, sep=";", header=True, escape='"')
    for path, _, _ in listed(sold.sparkSession, folder, "market=*/*.csv"):  # a file for each market
        move(sold.sparkSession, path, f"{folder}/{path.rsplit('/', 2)[1].removeprefix('market=')}.csv")


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = f"{new_folder(spark)}/raw"
    write_market_files(stored(market_data.sales(tuned(spark), sf_dir)), folder)
    return folder


def market_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows of the files."""
    return markets.market_rows(spark, markets.discover(spark, raw_folder(spark, sf_dir)).collect())  # a row for each file


def registry_file(spark: SparkSession, folder: str) -> str:
    """The form rules of the order tables as a registry file."""
    groups: dict[str, list[str]] = {}
    for form, group, _ in market_data.FORM_GROUPS:
        groups.setdefault(group, []).append(form)
    path = f"{folder}/registry.json"
    write_text(spark, path, json.dumps({"compatibility_groups": [{"name": n, "description": "", "members": m} for n, m in groups.items()], "excluded": []}))
    return path


def stored_run(spark: SparkSession, sf_dir: str, p: Params) -> tuple[str, list[run.Market]]:
    """(folder, markets) of a whole run over the files."""
    raw = raw_folder(spark, sf_dir)
    out = raw.removesuffix("/raw") + "/out"
    return out, run.run_markets(spark, raw, out, registry_file(spark, raw.removesuffix("/raw")), p=p)


def stored_stage(spark: SparkSession, sf_dir: str, name: str, p: Params) -> DataFrame:
    _, which = stored_run(spark, sf_dir, p)
    return run.stage_of(spark, which, name)


def stage_counts(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    """stage, kind, n: what was counted while the stages were written."""
    out, which = stored_run(spark, sf_dir, p)
    told = run.summary(spark, out, which)["stages"]  # a few numbers of each stage
    return spark.createDataFrame([(stage, kind, n) for stage, counts in told.items() for kind, n in counts.items()], "stage string, kind string, n long")


def published(spark: SparkSession, sf_dir: str, name: str, p: Params) -> DataFrame:
    """A published table, read back from the file that the export wrote."""
    out, which = stored_run(spark, sf_dir, p)
    publish = f"{out}/publish"
    if not run.run_export(spark, out, which, p, publish):
        raise ValueError("the checks failed")
    return sheets.read_table(spark, f"{publish}/{name}")


