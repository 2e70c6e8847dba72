"""Raw market files: discovery, the form registry, and rows ready for the weekly stage."""

from __future__ import annotations

import csv
import json
import logging
from collections.abc import Iterable, Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.scalars import monday, period_date
from lacuna.params import DEFAULT, Params
from lacuna.schemas import RAW_USED, RENAMES, STATUSES, missing_columns
from lacuna.sources.files import exists, input_file, listed, read_text, write_text
from lacuna.sources.sheets import write_csv

log = logging.getLogger(__name__)
RENAMED_FROM = {b: a for a, b in RENAMES.items()}

#: Text that counts as missing in the input contract.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
MARKET_LIST = "CLIENT_ID long, FILE_NAME string, FILE_PATH string, FILE_SIZE_MB double, STATUS string, REASON string"


HEADS = "FILE_PATH string, lines array<string>, error string"


def first_lines(path: str, count: int, most: int = 1 << 20) -> list[str]:
    """The first lines of a file, from its first bytes only."""
    raw = b""
    with input_file(path) as f:
        while raw.count(b"\n") < count and len(raw) < most and (more := f.read(1 << 14)):
            raw += more
    return raw.decode("utf-8-sig", errors="replace").splitlines()[:count]


def heads(spark: SparkSession, paths: list[str], rows: int) -> DataFrame:
    """HEADS: the header and the first rows of each file, all in one job; error instead, where a file can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    found.append((path, first_lines(path, rows + 1), None))
                except OSError as e:
                    found.append((path, None, f"{type(e).__name__}: {e}"))
            columns = list(zip(*found, strict=True)) if found else [()] * 3
            kinds = (pa.string(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["FILE_PATH", "lines", "error"])

    parts = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    return spark.createDataFrame([(p,) for p in paths], "FILE_PATH string").repartition(parts).mapInArrow(run, HEADS)


def sniffed(path: str, length: int, changed: int, lines: list[str] | None, error: str | None, p: Params = DEFAULT) -> tuple:
    """A row of FOUND from a file's size and first lines; the first rule that fails names the status."""
    name, size = path.rsplit("/", 1)[-1], round(length / 1048576, 2)
    cells = [[c.strip() for c in row] for row in csv.reader(lines or [], delimiter=";")]
    client, header = None, cells[0] if cells else []
    if error:
        status, reason = "MALFORMED", f"can't be read: {error}"
    elif len(cells) < 2:
        status, reason = "EMPTY", "no data rows" if cells else "no header"
    elif missing := missing_columns(header):
        status, reason = "MALFORMED", "missing columns: " + ", ".join(missing)
    else:
        at = header.index("CLIENT_ID")
        ids = {row[at] if len(row) > at else "" for row in cells[1:]}
        if len(ids) != 1 or not next(iter(ids)).isdigit():
            status, reason = "MALFORMED", "CLIENT_ID isn't one whole number"
        else:
            client = int(next(iter(ids)))
            status, reason = ("OVERSIZED", f"more than {p.max_file_mb:g} MB") if length / 1048576 > p.max_file_mb else ("READY", "")
    return client, name, path, size, status, reason, header, length, changed


FOUND = f"{MARKET_LIST}, HEADER array<string>, FILE_LENGTH long, CHANGED long"


def discover(spark: SparkSession, folder: str, pattern: str = "*.csv", limit: int | None = None, p: Params = DEFAULT, only: set[str] | None = None) -> DataFrame:
    """FOUND: the market list, READY first, then by market (null last) and file name, with each file's header, length and time. only: names of files to look at."""
    files = {path: (length, changed) for path, length, changed in listed(spark, folder, pattern)[:limit] if only is None or path.rsplit("/", 1)[-1] in only}
    found = heads(spark, list(files), p.sniff_rows).collect() if files else []  # a few lines of each file
    rows = [sniffed(r.FILE_PATH, *files[r.FILE_PATH], r.lines, r.error, p) for r in found]
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("STATUS"))
    return spark.createDataFrame(rows, FOUND).orderBy(rank, F.asc_nulls_last("CLIENT_ID"), "FILE_NAME")


def save_market_list(found: DataFrame, path: str) -> None:
    """The list as one semicolon-separated file with a byte-order mark, in its order."""
    write_csv(found.select(*[c.split()[0] for c in MARKET_LIST.split(", ")]), path)


def load_market_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=MARKET_LIST, sep=";", header=True)


def status_counts(markets: DataFrame) -> DataFrame:
    return markets.groupBy("STATUS").agg(F.count("*").alias("files"), F.sum("FILE_SIZE_MB").alias("mb"))


def ready(markets: DataFrame, ids: list[int] | None = None, limit: int | None = None) -> DataFrame:
    kept = markets.where("STATUS = 'READY'")
    kept = kept.where(F.col("CLIENT_ID").isin(ids)) if ids else kept
    return kept.orderBy("CLIENT_ID").limit(limit) if limit else kept.orderBy("CLIENT_ID")


#: Text of a row whose number of fields isn't the header's, or whose quotes don't close; null in whole rows.
BROKEN = "BROKEN_ROW"


def raw_rows(spark: SparkSession, files: list[tuple[str, list[str]]], columns: tuple[str, ...] = RAW_USED, checked: bool = True) -> DataFrame:
    """Columns of market files as text, chosen by name, BROKEN and FILE_NAME. files: (path, header); those of one header are read together.

    Checked rows are split into all their fields, so none too many or too few goes unseen; unchecked ones into the columns asked for."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in files:
        by_header.setdefault(tuple(header), []).append(path)
    parts = []
    for names, group in by_header.items():
        schema = ", ".join(f"`{n}` string" for n in (*names, *([BROKEN] if checked else [])))
        reader = spark.read.option("columnPruning", str(not checked).lower()).option("columnNameOfCorruptRecord", BROKEN)
        read = reader.csv(group, schema=schema, sep=";", header=True, escape='"', enforceSchema=True)
        name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # Spark gives it as in a URI
        parts.append(read.select(*[F.col(f"`{c}`") for c in columns], *([BROKEN] if checked else []), name.alias("FILE_NAME")))
    return reduce(DataFrame.unionByName, parts)


def whole_number(text: Column) -> Column:
    """Text of a whole number, with zero decimals or none; null for anything else."""
    return F.regexp_replace(text, r"\.0*$", "").try_cast("long")


def parsed(raw: DataFrame) -> DataFrame:
    """Canonical names and types: ids long, packs and value double, Date the Monday of the period's week.

    MALFORMED names the first value that isn't what its column asks for (`Q=1,2,3`), or a row that isn't made of the header's
    fields (`row=...`); null in good rows."""
    more = [c for c in (BROKEN, "FILE_NAME") if c in raw.columns]
    used = [c for c in raw.columns if c not in more]
    text = [F.when(~F.trim(F.col(f"`{c}`")).isin(*MISSING), F.trim(F.col(f"`{c}`"))).alias(c) for c in used]
    named = raw.select(*text, *more).withColumnsRenamed(RENAMES)
    values = {c: whole_number(F.col(c)) for c in ("PHARM_ID", "CLIENT_ID", "DRUGS_ID", "INN_ID", "PERIOD_ID")}
    values["PERIOD_ID"] = F.when(values["PERIOD_ID"].between(100_000_000, 999_999_999), values["PERIOD_ID"])
    values |= {c: F.replace(F.col(c), F.lit(","), F.lit(".")).try_cast("double") for c in ("Q", "V")}
    broken = [F.when(F.col(BROKEN).isNotNull(), F.concat(F.lit("row="), F.left(F.col(BROKEN), F.lit(80))))] if BROKEN in more else []
    bad = F.coalesce(*broken, *[F.when(F.col(c).isNotNull() & v.isNull(), F.concat(F.lit(f"{c}="), F.col(c))) for c, v in values.items()])
    rows = named.withColumn("MALFORMED", bad).withColumns(values)
    return rows.withColumn("Date", monday(period_date(F.col("PERIOD_ID")))).drop("PERIOD_ID", BROKEN)


def typed(raw: DataFrame) -> DataFrame:
    """The rows of parsed without malformed values."""
    return parsed(raw).where("MALFORMED IS NULL").drop("MALFORMED", "FILE_NAME")


def files_of(found: list) -> list[tuple[str, list[str]]]:
    return [(r.FILE_PATH, r.HEADER) for r in found]


def market_rows(spark: SparkSession, found: list) -> DataFrame:
    """Typed rows of market files, given as rows of discover."""
    return typed(raw_rows(spark, files_of(found)))


def health(rows: DataFrame) -> DataFrame:
    """A row for each file of parsed rows: rows, malformed rows and one of their values, and whether there is one CLIENT_ID."""
    return rows.groupBy("FILE_NAME").agg(
        F.count("*").alias("rows"),
        F.count("MALFORMED").alias("malformed"),
        F.min("MALFORMED").alias("example"),
        (F.min("CLIENT_ID") == F.max("CLIENT_ID")).alias("one_client"),
    )


def discovered_forms(rows: DataFrame, column: str = "NFC1_ID") -> DataFrame:
    form = F.trim(F.col(f"`{column}`"))
    return rows.select(form.alias("form")).where(form.isNotNull() & ~form.isin(*MISSING)).distinct()


#: The rules of a new registry.
GROUPS = ({"name": "ORAL_SOLID_RETARD", "description": "Тверді пероральні форми (звичайні + ретард-форми) — клінічно взаємозамінні.", "members": ["Пероральные твердые обычные", "Пероральные твердые длительно действующие"]},)
EXCLUDED = ("Не предназначенные для использования у человека и прочие",)
COMMENT = "Master data: NFC1 categories registry. Accumulating across runs."
REGISTRY = "metadata struct<first_discovered_at:string,last_discovered_at:string,last_run_files_scanned:long,version:string>, all_categories array<string>, categories_history map<string,string>, compatibility_groups array<struct<name:string,description:string,members:array<string>>>, excluded array<string>"


def rule_table(spark: SparkSession, rows: Iterable[tuple[str, str | None, bool]]) -> DataFrame:
    """Rules (form, group, excluded) as a table whose size Spark knows from the start: a join with it is a broadcast within Spark's own limit, so rows
    dealt out by market and INN stay where they are and are never dealt out by a few forms."""
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.bool_()), strict=True)], names=["form", "group", "excluded"]))


def form_rules(spark: SparkSession, path: str | None) -> DataFrame:
    """rule_table of a registry file; empty without a file (with a warning if one was named), so that forms match exactly."""
    if path is None or not exists(spark, path):
        if path is not None:
            log.warning("no form registry at %s: forms match exactly", path)
        return rule_table(spark, [])
    one = spark.read.schema(REGISTRY).json(path, multiLine=True)
    groups = one.select(F.explode("compatibility_groups").alias("g")).select(F.explode("g.members").alias("form"), F.col("g.name").alias("group"), F.lit(False).alias("excluded"))
    out = one.select(F.explode("excluded").alias("form"), F.lit(None).cast("string").alias("group"), F.lit(True).alias("excluded"))
    every = groups.unionByName(out).groupBy("form").agg(F.min("group").alias("group"), F.max("excluded").alias("excluded"))
    return rule_table(spark, map(tuple, every.collect()))  # what one file names, read as one record


def merged_registry(old: dict | None, forms: list[str], scanned: int, now: str | None = None) -> dict:
    """The registry with new forms: categories only grow, first dates and rules never change. Without an old one the rules are the fixed ones."""
    now = now or datetime.now().isoformat(timespec="seconds")
    old = {"_comment": COMMENT, "compatibility_groups": list(GROUPS), "excluded": list(EXCLUDED)} if old is None else old
    meta, history = old.get("metadata", {}), dict(old.get("categories_history", {}))
    for f in sorted(set(forms) - set(old.get("all_categories", []))):
        history.setdefault(f, now[:10])
    return old | {
        "metadata": meta | {"first_discovered_at": meta.get("first_discovered_at") or now, "last_discovered_at": now, "last_run_files_scanned": scanned, "version": meta.get("version", 1)},
        "all_categories": sorted({*old.get("all_categories", []), *forms}),
        "categories_history": history,
        "compatibility_groups": old.get("compatibility_groups", []),
        "excluded": old.get("excluded", []),
    }


def update_registry(spark: SparkSession, found: list, path: str) -> list[str]:
    """Merges the forms of readable files (rows of discover) into the registry file; the forms that are new."""
    known = json.loads(read_text(spark, path)) if exists(spark, path) else None
    files = files_of([r for r in found if r.STATUS in ("READY", "OVERSIZED")])
    column = RENAMED_FROM["NFC1_ID"]
    forms = [r.form for r in discovered_forms(raw_rows(spark, files, (column,), checked=False), column).collect()] if files else []  # a registry of forms
    write_text(spark, path, json.dumps(merged_registry(known, forms, len(found)), ensure_ascii=False, indent=2) + "\n")
    return sorted(set(forms) - set((known or {}).get("all_categories", [])))


def unknown_forms(forms: list[str], rules: list[str]) -> list[str]:
    """Forms in the data that no rule names; each stands alone."""
    return sorted({f.strip() for f in forms} - set(rules) - set(MISSING))

