"""Market files: discovery, stored runs and their resumption, isolation, follow-on files, streaming, the command line."""

import json
import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.operators import weekly
from lacuna.params import Params
from lacuna.plans import run as R
from lacuna.schemas import RAW_REQUIRED
from lacuna.sources import markets, sheets

P = Params(min_market_count=2)


def market_file(folder, client, seed=5, forms=("TAB",), weeks=40, change=None):
    r = np.random.default_rng(seed + client)
    lines = [";".join(RAW_REQUIRED)]
    for shop in (client, 99):
        for drug in range(1, 5):
            for w in range(weeks):
                if shop == 99 or r.random() > 0.35:
                    q = str(r.integers(1, 20)) + ",5"
                    lines.append(f'{shop};{client};{drug};{2023 * 100000 + 7 * w + 1};{q};"10,5";inn;{drug % 2};"name ""{drug}""";{forms[drug % len(forms)]};TAB;a;b')
    if change:
        lines[9] = change(lines[9])
    path = folder / f"{client}.csv"
    path.write_text("﻿" * (client == 2) + "\n".join(lines) + "\n", encoding="utf-8")
    return path


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for client in (1, 2, 3):
        market_file(folder, client)
    (folder / "4.csv").write_text("a;b\n1;2\n")
    (folder / "5.csv").write_text("")
    (folder / "6.csv").write_text(";".join(RAW_REQUIRED) + "\n")
    return folder


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_discovery_and_lists(spark, raw, tmp_path):
    found = markets.discover(spark, str(raw)).collect()
    assert [(f.CLIENT_ID, f.STATUS, f.FILE_NAME) for f in found] == [(1, "READY", "1.csv"), (2, "READY", "2.csv"), (3, "READY", "3.csv"), (None, "EMPTY", "5.csv"), (None, "EMPTY", "6.csv"), (None, "MALFORMED", "4.csv")]
    assert found[0].HEADER == list(RAW_REQUIRED) and markets.discover(spark, str(raw), limit=2).count() == 2
    assert [f.STATUS for f in markets.discover(spark, str(raw), p=Params(max_file_mb=0.001)).limit(1).collect()] == ["OVERSIZED"]
    at = str(tmp_path / "markets_list.csv")
    markets.save_market_list(markets.discover(spark, str(raw)), at)
    back = markets.load_market_list(spark, at)
    assert rows_of(back) == rows_of(spark.createDataFrame([tuple(f)[:6] for f in found], markets.MARKET_LIST).withColumn("REASON", F.nullif("REASON", F.lit(""))))
    assert [r.CLIENT_ID for r in markets.ready(back).collect()] == [1, 2, 3]


def test_registry_file(spark, raw, tmp_path):
    at = str(tmp_path / "registry.json")
    found = markets.discover(spark, str(raw)).collect()
    assert markets.update_registry(spark, found, at) == ["TAB"]
    one = json.loads((tmp_path / "registry.json").read_text())
    assert one["all_categories"] == ["TAB"] and one["compatibility_groups"] and one["excluded"] and one["metadata"]["last_run_files_scanned"] == 6
    one |= {"excluded": ["X"], "compatibility_groups": [], "own": 1}
    one["metadata"]["first_discovered_at"] = "2020-01-01"
    (tmp_path / "registry.json").write_text(json.dumps(one))
    market_file(raw, 1, forms=("TAB", "SYR"))
    assert markets.update_registry(spark, markets.discover(spark, str(raw)).collect(), at) == ["SYR"]
    two = json.loads((tmp_path / "registry.json").read_text())
    assert two["all_categories"] == ["SYR", "TAB"] and two["excluded"] == ["X"] and two["own"] == 1 and two["metadata"]["first_discovered_at"] == "2020-01-01" and set(two["categories_history"]) == {"SYR", "TAB"}
    assert rows_of(markets.form_rules(spark, at)) == ["Row(form='X', group=None, excluded=True)"]


def test_missing_registry_means_exact_forms(spark, tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        assert markets.form_rules(spark, str(tmp_path / "none.json")).count() == 0
    assert "forms match exactly" in caplog.text


def test_run_resumes_and_publishes(spark, raw, tmp_path):
    out, publish = str(tmp_path / "out"), tmp_path / "publish"
    publish.mkdir()
    assert R.run(spark, str(raw), out, p=P, publish=str(publish))
    assert (publish / "drug_coefficients.csv").read_bytes().startswith(b"\xef\xbb\xbfDRUGS_ID;")
    back = sheets.read_xlsx(spark, str(publish / "drug_coefficients.xlsx"), "DRUGS_ID long, COEF_1 double, DRUGS_NAME string")
    assert back.count() == 4 and 'name "1"' in [x.DRUGS_NAME for x in back.collect()]
    batches = list((tmp_path / "out/markets").iterdir())
    stamp = {f: f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet")}
    assert R.run(spark, str(raw), out, p=P)
    assert R.run_export(spark, out, R.chosen(spark, out, [1, 2]), P)  # some of the stored markets
    assert list((tmp_path / "out/markets").iterdir()) == batches and all(f.stat().st_mtime_ns == t for f, t in stamp.items())
    market_file(raw, 2, seed=77)  # another file: this market only is made anew
    made = R.run_markets(spark, str(raw), out, p=P)
    assert len({m.batch for m in made}) == 2 and [m.status for m in made] == ["success"] * 3
    fresh = R.run_markets(spark, str(raw), str(tmp_path / "fresh"), p=P)
    for name in ("did_events", "substitute_shares", "aggregated"):
        assert rows_of(R.stage_of(spark, made, name)) == rows_of(R.stage_of(spark, fresh, name).select(*R.stage_of(spark, made, name).columns))


def test_changed_registry_is_a_changed_run(spark, raw, tmp_path):
    for client in (1, 2, 3):
        market_file(raw, client, forms=("TAB", "RET", "TAB"))
    rule = tmp_path / "registry.json"
    rule.write_text(json.dumps({"compatibility_groups": [], "excluded": []}))
    out = str(tmp_path / "out")
    before = R.stage_of(spark, R.run_markets(spark, str(raw), out, str(rule), p=P), "pairs").count()
    rule.write_text(json.dumps({"compatibility_groups": [{"name": "g", "description": "", "members": ["TAB", "RET"]}], "excluded": []}))
    after = R.stage_of(spark, R.run_markets(spark, str(raw), out, str(rule), p=P), "pairs").count()
    fresh = R.stage_of(spark, R.run_markets(spark, str(raw), str(tmp_path / "fresh"), str(rule), p=P), "pairs").count()
    assert before < after == fresh


def test_a_stage_cut_short_is_made_again(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    made = R.run_markets(spark, str(raw), out, p=P)
    want = rows_of(R.stage_of(spark, made, "did_events"))
    base = next((tmp_path / "out/markets").iterdir())
    (base / "commit-000001.json").unlink()  # cut short while a stage was moved to its place: some buckets, no _SUCCESS
    (base / "v000001/did_events/_SUCCESS").unlink()
    (base / "v000001/did_events/_table.json").unlink()
    next((base / "v000001/did_events").glob("*.parquet")).unlink()
    assert rows_of(R.stage_of(spark, R.run_markets(spark, str(raw), out, p=P), "did_events")) == want


@pytest.mark.parametrize("change", [lambda x: x.replace(",5;", ",5,7;"), lambda x: "1;" + x.split(";", 1)[1].replace("1;", "8;", 1), lambda x: x.replace("202300", "999999999")])
def test_a_malformed_market_stops_no_other(spark, raw, tmp_path, change):
    market_file(raw, 1, change=change).rename(raw / "1 of+a%é.csv")
    out = str(tmp_path / "out")
    made = {m.client: m for m in R.run_markets(spark, str(raw), out, p=P)}
    assert {c: m.status for c, m in made.items()} == {1: "error", 2: "success", 3: "success"} and made[1].reason
    assert R.run(spark, str(raw), out, p=P) and [m.client for m in R.chosen(spark, out)] == [2, 3]
    (raw / "1 of+a%é.csv").unlink()
    market_file(raw, 1)
    assert [m.status for m in R.run_markets(spark, str(raw), out, p=P)] == ["success"] * 3


def test_whole_numbers_beyond_doubles(spark):
    text = [("9007199254740993",), ("12.0",), ("12.5",), ("x",), ("NA",), (None,)]
    used = {c: F.lit(None).cast("string") for c in markets.RAW_USED}
    df = spark.createDataFrame(text, "DRUGS_ID string").select(*[F.col("DRUGS_ID") if c == "DRUGS_ID" else used[c].alias(c) for c in markets.RAW_USED])
    assert [(r.DRUGS_ID, r.MALFORMED) for r in markets.parsed(df).collect()] == [(9007199254740993, None), (12, None), (None, "DRUGS_ID=12.5"), (None, "DRUGS_ID=x"), (None, None), (None, None)]


def test_filter_and_substitutes_keep_types(spark, tmp_path):
    from lacuna.plans import subset

    volumes = spark.createDataFrame([(1, "a", 1.0, 50.0), (2, "b", 0.5, 30.0), (3, "c", 1.0, 15.0), (4, "d", 0.0, 5.0)], f"DRUGS_ID long, DRUGS_NAME string, COVERAGE_PCT double, `{subset.VOLUME}` double")
    at = {n: str(tmp_path / n) for n in ("v.xlsx", "c.csv", "s.csv", "s.xlsx", "to.xlsx", "pairs.xlsx", "report.txt")}
    sheets.write_xlsx(volumes, at["v.xlsx"])
    sheets.write_csv(spark.createDataFrame([(1, 0.9), (2, 0.8), (3, 0.1)], "DRUGS_ID long, RELIABILITY_SCORE double"), at["c.csv"])
    assert subset.run_filter(spark, at["v.xlsx"], at["c.csv"], at["to.xlsx"], at["report.txt"]) == 2
    back = sheets.read_xlsx(spark, at["to.xlsx"])
    assert back.dtypes == volumes.dtypes and [r.DRUGS_ID for r in back.collect()] == [1, 2] and sheets.sheet_name(at["to.xlsx"]) == "Drug Coefficients"
    pairs = spark.createDataFrame([(1, 2, 1.0, True, 1), (3, 2, 1.0, False, 1)], "DRUGS_ID long, SUBSTITUTE_DRUG_ID long, SUBSTITUTE_SHARE double, SAME_NFC1 boolean, SUBSTITUTE_RANK long")
    sheets.write_csv(pairs, at["s.csv"])
    sheets.write_xlsx(pairs, at["s.xlsx"], "mine")
    for source, sheet in (("s.csv", "Substitute Shares"), ("s.xlsx", "mine")):
        assert subset.run_substitutes(spark, at["to.xlsx"], at[source], at["pairs.xlsx"]) == (1, 1)
        assert sheets.sheet_name(at["pairs.xlsx"]) == sheet and [r.DRUGS_ID for r in sheets.read_xlsx(spark, at["pairs.xlsx"]).collect()] == [1]
        assert [t for _, t in sheets.read_xlsx(spark, at["pairs.xlsx"]).dtypes][:4] == ["bigint", "bigint", "double", "boolean"]


def test_stream_replays_replace_themselves(spark, raw, tmp_path):
    from lacuna.streaming import incremental as I

    for x in ("4.csv", "5.csv", "6.csv"):
        (raw / x).unlink()
    store, out = str(tmp_path / "store"), str(tmp_path / "series")
    query = I.start(I.raw_stream(spark, str(raw)), store, out, str(tmp_path / "state"))
    query.awaitTermination()
    want = weekly.aggregate_markets(markets.market_rows(spark, markets.discover(spark, str(raw)).collect()))
    columns = want.columns
    assert rows_of(spark.read.schema(want.schema).parquet(out).select(*columns)) == rows_of(want) != []
    batch = markets.parsed(markets.raw_rows(spark, markets.files_of(markets.discover(spark, str(raw)).collect()))).drop("FILE_NAME")
    for _ in range(2):  # the first batch comes again
        I.refreshed(batch, 0, store, out)
    assert rows_of(spark.read.schema(want.schema).parquet(out).select(*columns)) == rows_of(want)


def test_command_line(spark, raw, tmp_path):
    from lacuna import cli

    at = lambda name: str(tmp_path / name)
    assert cli.main(["discover", "--raw", str(raw), "--list", at("list.csv"), "--registry", at("r.json")]) == 0
    assert cli.main(["markets", "--raw", str(raw), "--out", at("out"), "--registry", at("r.json")]) == 0
    assert cli.main(["cross-market", "--out", at("out"), "--markets", "1", "2", "--min-market-count", "2"]) == 0
    assert cli.main(["export", "--out", at("out"), "--publish", at("publish"), "--min-market-count", "2", "--skip-unreadable"]) == 0
    assert cli.main(["filter", "--volumes", at("publish/drug_coefficients.csv"), "--coefficients", at("publish/drug_coefficients.csv"), "--to", at("f.xlsx"), "--volume", "MARKET_COUNT", "--low", "0"]) in (0, 2)
    assert cli.main(["run", "--raw", at("nowhere"), "--out", at("out")]) == 2
    assert cli.main(["export", "--out", at("empty")]) == 2
    assert cli.main(["run", "--raw", str(raw), "--out", at("out"), "--registry", at("r.json"), "--min-market-count", "2"]) == 0
