"""Stored runs: versions, damaged files, broken rows, counts of a run, phases, saved lists, streams that close a gap."""

import json
import logging
import shutil

import pytest
from pyspark.sql import functions as F
from test_files import P, market_file, raw, rows_of  # noqa: F401 (raw is a fixture)

from lacuna.operators import did, stockouts
from lacuna.plans import run as R
from lacuna.plans import store
from lacuna.schemas import RAW_REQUIRED
from lacuna.sources import markets
from lacuna.sources.files import write_text


def test_a_forced_run_that_breaks_off_leaves_the_old_version(spark, raw, tmp_path, monkeypatch):  # noqa: F811
    out = str(tmp_path / "out")
    old = R.run_markets(spark, str(raw), out, p=P)
    want = rows_of(R.stage_of(spark, old, "did_events"))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(R.did, "substitute_pairs", broken)
        with pytest.raises(RuntimeError):
            R.run_markets(spark, str(raw), out, p=P, force=True)
    base = next((tmp_path / "out/markets").iterdir())
    assert (base / "v000002/did_events/_table.json").exists() and not (base / "commit-000002.json").exists()
    again = R.run_markets(spark, str(raw), out, p=P)
    assert again == [R.Market(**(vars(a) | {"made": b.made})) for a, b in zip(old, again, strict=True)]  # the version that counts, not made anew
    assert rows_of(R.stage_of(spark, again, "did_events")) == want
    for n in (2, 3):  # a whole version takes its place; two stay
        new = R.run_markets(spark, str(raw), out, p=P, force=True)
        assert {m.batch.rsplit("/", 1)[1] for m in new} == {f"v00000{n}"} and rows_of(R.stage_of(spark, new, "did_events")) == want
    assert sorted(p.name for p in base.iterdir() if not p.name.startswith(".")) == ["commit-000002.json", "commit-000003.json", "v000002", "v000003"]


def test_a_table_alone_keeps_its_old_version(spark, tmp_path):
    base = str(tmp_path / "t")
    assert store.versioned(spark, base, lambda: spark.range(3)).count() == 3
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        store.versioned(spark, base, lambda: spark.range(5).select(F.raise_error(F.lit("DIVIDE_BY_ZERO")).cast("long").alias("id")), force=True)
    assert store.versioned(spark, base, lambda: spark.range(9)).count() == 3
    assert store.versioned(spark, base, lambda: spark.range(9), force=True).count() == 9


def test_damaged_files_are_named_and_not_taken_for_whole(spark, raw, tmp_path, caplog):  # noqa: F811
    out = str(tmp_path / "out")
    which = R.run_markets(spark, str(raw), out, p=P)
    whole = R.run_cross_market(spark, out, which, P)
    want = rows_of(whole)
    assert R.unreadable(spark, which) == {}
    files = sorted((tmp_path / "out/markets").glob("*/v000001/did_events/part-*.parquet"), key=lambda f: f.stat().st_size)
    cut, junk = files[-1], next((tmp_path / "out/markets").glob("*/v000001/substitute_shares/part-*.parquet"))
    kept = {f: f.read_bytes() for f in (cut, junk)}
    cut.write_bytes(kept[cut][: len(kept[cut]) // 2])
    junk.write_bytes(b"PAR1" + b"\x00" * 100)
    with caplog.at_level(logging.WARNING):
        bad = R.unreadable(spark, which)
    assert {p.rsplit("/", 1)[1] for p in bad} == {cut.name, junk.name} and cut.name in caplog.text and junk.name in caplog.text
    less = R.run_cross_market(spark, out, which, P, without=bad)
    assert R.across(out, which, P, bad) != R.across(out, which, P)
    lost = {f.name for f in files} - {cut.name}
    assert less.count() <= len(want) and lost
    for f, data in kept.items():
        f.write_bytes(data)
    assert rows_of(R.run_cross_market(spark, out, which, P)) == want  # no thinned result in place of the whole one
    assert R.run_export(spark, out, which, P)
    shutil.rmtree(next((tmp_path / "out/markets").glob("*/v000001/aggregated")))
    with pytest.raises(R.NotReady, match="aggregated"):
        R.stage_of(spark, which, "aggregated")
    assert [r for r in R.unreadable(spark, which).values()] == ["the table isn't whole"]


def test_footers_that_promise_too_much(spark, tmp_path):
    spark.range(20000).selectExpr("id", "cast(id as string) s").coalesce(1).write.parquet(str(tmp_path / "t"))
    f = next((tmp_path / "t").glob("*.parquet"))
    data = f.read_bytes()
    footer = int.from_bytes(data[-8:-4], "little") + 8
    f.write_bytes(data[:4] + data[-footer:])  # a whole footer, but the columns are gone
    found = store.unreadable(spark, [f"file:{f}", f"file:{tmp_path}/none.parquet"])
    assert "ends beyond the file" in found[f"file:{f}"] and len(found) == 2 and store.unreadable(spark, []) == {}


@pytest.mark.parametrize("change", [lambda x: x + ";more", lambda x: x.rsplit(";", 2)[0], lambda x: x.replace('"10,5"', '"10,5')])
def test_a_broken_row_marks_its_file(spark, raw, tmp_path, change):  # noqa: F811
    market_file(raw, 1, change=change)
    made = {m.client: m for m in R.run_markets(spark, str(raw), str(tmp_path / "out"), p=P)}
    assert {c: m.status for c, m in made.items()} == {1: "error", 2: "success", 3: "success"}
    assert made[1].reason.startswith("1 of ") and "row=" in made[1].reason
    told = R.summary(spark, str(tmp_path / "out"), list(made.values()))
    assert told["status"] == {"error": 1, "success": 2} and list(told["reasons"]) == ["1"] and told["stages"]["rows"]["malformed"] == 1


def test_counts_of_a_run_are_those_of_its_tables(spark, raw, tmp_path):  # noqa: F811
    out = str(tmp_path / "out")
    which = R.run_markets(spark, str(raw), out, p=P)
    stages = R.summary(spark, out, which)["stages"]
    base = which[0].batch
    for name, counts in stages.items():
        assert counts["rows"] == spark.read.parquet(f"{base}/{name}").count(), name
    funnel = {r.reason: r.events for r in stockouts.validation_funnel(stockouts.islands(R.stage_of(spark, which, "aggregated"), P), P).collect()}
    assert {k: v for k, v in stages["stockout_runs"].items() if k != "rows" and v} == funnel
    post = {r.POST_STATUS: r["count"] for r in R.stage_of(spark, which, "stockout_events").groupBy("POST_STATUS").count().collect()}
    assert {k: v for k, v in stages["stockout_events"].items() if k != "rows" and v} == post
    assert stages["rows"]["malformed"] == stages["rows"]["stray"] == 0 and stages["did_events"]["clients"] == 3


def test_phases_go_on_from_each_other(spark, raw, tmp_path):  # noqa: F811
    out = str(tmp_path / "out")
    assert {m.status for m in R.run_markets(spark, str(raw), out, p=P, upto="aggregate")} == {"aggregate"}
    assert R.stored_markets(spark, out) == {}
    base = next((tmp_path / "out/markets").iterdir()) / "v000001"
    stamp = {f: f.stat().st_mtime_ns for f in base.rglob("*.parquet")}
    assert {p.name for p in base.iterdir()} == {"rows", "aggregated"} and stamp
    for phase in ("stockouts", "effects"):
        R.run_markets(spark, str(raw), out, p=P, upto=phase)
    made = R.run_markets(spark, str(raw), out, p=P)
    assert {m.status for m in made} == {"success"} and all(f.stat().st_mtime_ns == t for f, t in stamp.items())
    fresh = R.run_markets(spark, str(raw), str(tmp_path / "fresh"), p=P)
    assert rows_of(R.stage_of(spark, made, "substitute_shares")) == rows_of(R.stage_of(spark, fresh, "substitute_shares"))


def test_a_saved_list_chooses_the_files(spark, raw, tmp_path, caplog):  # noqa: F811
    at = str(tmp_path / "list.csv")
    found = markets.discover(spark, str(raw))
    markets.save_market_list(found.where("CLIENT_ID IN (1, 3) OR CLIENT_ID IS NULL"), at)
    assert [m.CLIENT_ID for m in R.preflight(spark, str(raw), saved=at)] == [1, 3]
    assert [m.CLIENT_ID for m in R.preflight(spark, str(raw), [3], saved=at)] == [3]
    (raw / "3.csv").unlink()
    with caplog.at_level(logging.WARNING):
        assert [m.CLIENT_ID for m in R.preflight(spark, str(raw), saved=at)] == [1]
    assert "3.csv of the market list isn't there" in caplog.text
    with pytest.raises(R.NotReady):
        R.preflight(spark, str(raw), saved=str(tmp_path / "none.csv"))


def test_a_stream_drops_partitions_of_markets_without_series(spark, tmp_path):
    from lacuna.streaming import incremental as I

    store_at, out = str(tmp_path / "store"), str(tmp_path / "series")
    lines = lambda weeks: [f"1;1;1;{202300000 + 7 * w + 1};2;10;inn;1;name;TAB;TAB;a;b" for w in weeks]

    def batch(n, weeks, client=1):
        folder = tmp_path / f"in{n}"
        folder.mkdir()
        text = "\n".join([";".join(RAW_REQUIRED), *(x.replace("1;1;", f"{client};{client};", 1) for x in lines(weeks))])
        (folder / "a.csv").write_text(text + "\n")
        rows = spark.read.csv(str(folder), schema=", ".join(f"`{c}` string" for c in RAW_REQUIRED), sep=";", header=True)
        I.refreshed(markets.parsed(rows.select(*[f"`{c}`" for c in markets.RAW_USED])), n, store_at, out)

    seen = lambda: {r.CLIENT_ID: r["count"] for r in spark.read.parquet(out).groupBy("CLIENT_ID").count().collect()}
    gap = [w for w in range(20) if w % 3]
    batch(0, gap)
    batch(1, gap, client=2)
    assert seen() == {1: 19, 2: 19}
    batch(2, [w for w in range(20) if not w % 3])  # closes every gap: the series is always sold and goes
    assert seen() == {2: 19}


def test_stages_shuffle_by_market_and_inn_once(spark, tmp_path):
    from lacuna.plans import queries

    s = queries.stages(spark, "/root/testdata/sf0.001")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    by_inn = lambda df: [x for x in plan(df).split("\n") if "Exchange hashpartitioning(CLIENT_ID" in x and "INN_ID" in x and "DRUG" not in x]
    assert len([x for x in by_inn(s.series) if "REPARTITION" in x]) == 1  # the target's rows, once
    tables = {n: getattr(s, n) for n in ("aggregated", "islands", "measured", "pairs")}  # each read back from storage
    for name in ("events", "did_events", "substitute_pairs", "market_shares"):
        assert not by_inn(getattr(s, name)), name
    for df in (stockouts.islands(tables["aggregated"]), tables["islands"].join(tables["pairs"], ["CLIENT_ID", "INN_ID"])):
        assert "Exchange hashpartitioning" not in plan(df.hint("merge"))
    registry = f"file:{tmp_path}/registry.json"
    write_text(spark, registry, json.dumps({"compatibility_groups": [{"name": "solid", "description": "", "members": ["F0", "F1"]}], "excluded": ["F9"]}))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")  # of these tables only the rules are smaller
    try:
        for rules in (s.forms, markets.form_rules(spark, registry), markets.form_rules(spark, None)):  # pairs are dealt out neither by form nor anew
            made = plan(did.candidate_pairs(tables["measured"], tables["aggregated"], rules))
            assert "SortMergeJoin" in made and "Exchange hashpartitioning" not in made
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not spark.catalog.listTables()


def test_buckets_are_read_in_another_session(spark, tmp_path):
    from lacuna.session import as_dealt, dealt

    df = spark.range(100).selectExpr("id % 7 AS CLIENT_ID", "id % 3 AS INN_ID", "id")
    path = f"file:{tmp_path}/it's here"
    made = dealt(df, path)
    back = as_dealt(spark.newSession(), path, made.schema, 3)
    assert rows_of(back) == rows_of(made) == rows_of(df)
    assert "Exchange" not in back.groupBy("CLIENT_ID", "INN_ID").count()._jdf.queryExecution().executedPlan().toString()
    assert json.loads(made.schema.json()) == json.loads(back.schema.json())


def test_packs_of_any_weeks_are_two_lookups(spark):
    from datetime import date, timedelta

    from lacuna.operators.did import packs_between, product_series

    packs = [1.1, 2.2, 0.0, 3.3, 0.1, 0.2]
    start = date(2024, 1, 1)
    week = lambda n: start + timedelta(days=7 * n)
    rows = [(1, 1, 7, "d", "A", week(i), q) for i, q in enumerate(packs)]
    agg = spark.createDataFrame(rows, "CLIENT_ID long, INN_ID long, DRUGS_ID long, DRUGS_NAME string, NFC1_ID string, Date date, Q double")
    series = product_series(agg, spark.createDataFrame([], "form string, group string, excluded boolean"))
    spans = spark.createDataFrame([(a, b, week(a), week(b)) for a in range(-3, 9) for b in range(a - 1, 9)], "a int, b int, s date, e date")
    for r in series.join(F.broadcast(spans)).select("a", "b", packs_between(F.col("s"), F.col("e")).alias("x")).collect():
        want = sum(round(10 * q) for i, q in enumerate(packs) if r.a <= i <= r.b) / 10  # exact, as the look-ups are
        assert r.x == want, r




def test_the_path_of_files_equals_the_chain_over_tables(spark):
    from lacuna.plans import market_files, queries

    d = "/root/testdata/sf0.001"
    want = rows_of(queries.did_events(spark, d))
    assert want and rows_of(queries.stored_did_events(spark, d)) == want
    raw = market_files.raw_folder(spark, d)
    found = markets.discover(spark, raw).collect()
    assert {f.STATUS for f in found} == {"READY"} and all(f.FILE_NAME == f"{f.CLIENT_ID}.csv" for f in found)


def test_commands_for_phases_lists_and_summaries(spark, raw, tmp_path, caplog):  # noqa: F811
    from lacuna import cli

    at = lambda name: str(tmp_path / name)
    assert cli.main(["discover", "--raw", str(raw), "--list", at("new/list.csv")]) == 0
    some = ["markets", "--raw", str(raw), "--out", at("out"), "--saved-list", at("new/list.csv"), "--market-ids", "1", "2"]
    assert cli.main(["summary", "--out", at("out")]) == 2
    assert cli.main([*some, "--upto", "stockouts"]) == 0 and cli.main(some) == 0
    with caplog.at_level(logging.INFO):
        assert cli.main(["summary", "--out", at("out")]) == 0
    assert "2 markets: 2 success" in caplog.text and "stockout_runs: " in caplog.text
    assert cli.main(["export", "--out", at("out"), "--publish", f"file:{tmp_path}/deep/publish", "--min-market-count", "2", "--skip-unreadable"]) == 0
    assert (tmp_path / "deep/publish/substitute_shares.xlsx").exists()
