"""The stock-out method on small inputs: stated vectors and edge cases."""

from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lacuna.functions import scalars as S
from lacuna.operators import adhoc, crossmarket, did, export, modality, shares, stockouts, weekly
from lacuna.params import Params
from lacuna.plans.stages import Stages
from lacuna.schemas import missing_columns

DAY0 = date(2024, 1, 1)
ROW = "CLIENT_ID long, PHARM_ID long, DRUGS_ID long, Date date, Q double, V double, DRUGS_NAME string, INN_NAME string, INN_ID long, NFC1_ID string, NFC_ID string"


def week(n):
    return DAY0 + timedelta(days=7 * n)


def series(drug, packs, client=1, pharm=None, inn=1, form="A", first=0):
    return [(client, pharm or client, drug, week(first + i), float(q), 10.0 * float(q), f"drug {drug}", f"inn {inn}", inn, form, form) for i, q in enumerate(packs) if q is not None]


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_scalars(spark):
    assert one(spark, S.period_date(F.lit(202400305))) == date(2024, 11, 1)
    assert one(spark, S.period_date(F.lit(202300001))) == date(2023, 1, 2)
    assert one(spark, S.monday(S.period_date(F.lit(202600104)))) == date(2026, 4, 13)
    got = spark.createDataFrame([("1,5",), ("2,0",), ("200",), ("",), (None,)], "x string").select(S.decimal_comma(F.col("x")).alias("y"))
    assert [r.y for r in got.collect()] == [1.5, 2.0, 200.0, None, None]
    for pre, during, want in ((100.0, 120.0, 1.2), (0.5, 2.0, 1.0), (10.0, -5.0, 0.0)):
        assert one(spark, S.growth(F.lit(pre), F.lit(during), 1.0)) == pytest.approx(want)
    assert one(spark, S.lift(F.lit(150.0), F.lit(100.0))) == 50 and one(spark, S.lift(F.lit(80.0), F.lit(100.0))) == 0
    assert one(spark, S.share(F.lit(70.0), F.lit(100.0), 0.001)) == 0.7 and one(spark, S.share(F.lit(0.0), F.lit(0.0), 0.001)) is None
    assert one(spark, S.rounded(F.lit(1.25), 1)) == 1.3


@pytest.mark.parametrize("a,b,want", [("s", "r", True), ("s", "l", False), ("s", "p", False), ("p", "p", True), ("x", "s", False), ("x", "x", False), ("u", "u", True), ("u", "v", False)])
def test_compatibility(spark, a, b, want):
    rules = {"s": ("solid", False), "r": ("solid", False), "x": (None, True)}
    args = [F.lit(v).cast(t) for n in (a, b) for v, t in zip((n, *rules.get(n, (None, None))), ("string", "string", "boolean"), strict=True)]
    assert one(spark, S.compatible(*args)) is want


def test_columns_and_params():
    from lacuna.schemas import RAW_REQUIRED

    assert missing_columns([]) == list(RAW_REQUIRED) and len(missing_columns(["ORG_ID", "CLIENT_ID"])) == 11 and not missing_columns(list(RAW_REQUIRED))
    with pytest.raises(ValueError):
        Params(min_notsold=0.9, max_notsold=0.1)


def test_gap_fill(spark):
    rows = spark.createDataFrame(series(1, [10, 5, None, 7]) + series(1, [1]), ROW)  # the first week comes twice
    got = weekly.with_notsold(weekly.gap_filled(weekly.weekly_sales(rows))).orderBy("Date").collect()
    assert [(r.Date, r.Q) for r in got] == [(week(0), 11.0), (week(1), 5.0), (week(2), 0.0), (week(3), 7.0)]
    assert got[2].DRUGS_NAME == "drug 1" and got[0].NOTSOLD_PERCENT == 0.25
    assert weekly.weekly_sales(spark.createDataFrame([(1, 1, 1, week(0), 1.0, 1.0, "a", "b", None, "A", "A")], ROW)).count() == 0


def islands_of(spark, packs, p=Params(min_notsold=0.0, max_notsold=1.0)):
    target = spark.createDataFrame(series(1, packs), ROW)
    others = weekly.competitor_totals(spark.createDataFrame(series(1, [5] * len(packs), pharm=2), ROW))
    return stockouts.islands(weekly.aggregated(target, others, p), p)


def test_islands(spark):
    packs = [10, 5, 8, 0, 0, 0, 6, 7, 0, 0, 9]
    got = [(r.STOCKOUT_START, r.STOCKOUT_END, r.STOCKOUT_WEEKS) for r in islands_of(spark, packs).orderBy("STOCKOUT_START").collect()]
    assert got == [(week(3), week(5), 3), (week(8), week(9), 2)]
    assert islands_of(spark, packs, Params(min_notsold=0.0, max_notsold=1.0, min_stockout_weeks=3)).count() == 1
    assert islands_of(spark, [5]).count() == 0


@pytest.mark.parametrize("packs,status", [([10, 1, 1, 1, 0, 0, 5, 7, 6, 8], "valid"), ([1, 1, 1, 1, 0, 0], "no_recovery"), ([1, 1, 1, 1, 0, 5, 5], "insufficient_data"), ([1, 1, 1, 1, 0, -1, -1, -1, 5, 5, 5, 5], "gap_too_large")])
def test_post(spark, packs, status):
    p = Params(min_notsold=0.0, max_notsold=1.0)
    row = stockouts.with_post(stockouts.stockout_events(islands_of(spark, packs, p), p), p).first()
    assert row.POST_STATUS == status
    if status == "valid":
        assert (row.POST_START, row.POST_END, row.POST_WEEKS) == (week(6), week(9), 4)


def test_validation_levels(spark):
    p = Params(min_notsold=0.0, max_notsold=1.0)
    assert stockouts.judged(islands_of(spark, [0, 5, 5, 5]), p).first().reason == "no_pre_sales"
    target = spark.createDataFrame(series(1, [1, 1, 1, 1, 0, 1]) + series(2, [1, 0, 0, 0, 0, 0]), ROW)
    for others, want in (([], "no_market_activity"), (series(2, [1] * 6, pharm=2), "no_competitors")):
        totals = weekly.competitor_totals(spark.createDataFrame(others, ROW))
        runs = stockouts.islands(weekly.aggregated(target, totals, p), p)
        assert stockouts.judged(runs, p).where("DRUGS_ID = 1").first().reason == want


def model(target, others, p):
    """The method once more, row by row, in plain Python: effects of each event by (market, product, start)."""
    shop, comp = {}, {}
    for c, _, d, w, q, *_, inn, form, _ in target:
        shop.setdefault((c, inn, d), {"form": form, "q": {}})["q"][w] = q
    for c, _, d, w, q, *_ in others:
        comp[c, d, w] = comp.get((c, d, w), 0) + q
    kept = {}
    for k, s in shop.items():
        first, last = min(s["q"]), max(s["q"])
        weeks = [first + timedelta(days=7 * i) for i in range((last - first).days // 7 + 1)]
        q = {w: s["q"].get(w, 0.0) for w in weeks}
        if p.min_notsold <= sum(v == 0 for v in q.values()) / len(q) <= p.max_notsold:
            kept[k] = (s["form"], q)
    out = {}
    for (c, inn, d), (form, q) in kept.items():
        weeks, runs = sorted(q), []
        for w in weeks:
            if q[w] == 0:
                if runs and runs[-1][1] + timedelta(days=7) == w:
                    runs[-1][1] = w
                else:
                    runs.append([w, w])
        market = lambda a, b: sum(comp.get((c, d2, w), 0) for (c2, i2, d2), (_, q2) in kept.items() if (c2, i2) == (c, inn) for w in q2 if a <= w <= b)  # noqa: B023, E731
        own = lambda a, b: sum(comp.get((c, d, w), 0) for w in weeks if a <= w <= b)  # noqa: B023, E731
        for a, b in runs:
            pa, pb = a - timedelta(days=28), a - timedelta(days=7)
            pre = [q[w] for w in weeks if pa <= w <= pb]
            if market(a, b) == 0 or len(pre) < 4 or sum(pre) == 0 or own(a, b) == 0:
                continue
            nxt = next((w for w in weeks if w > b and q[w] > 0), None)
            if nxt is None or (nxt - b).days // 7 > 2 or sum(w >= nxt for w in weeks) < 4:
                continue
            mp, md = market(pa, pb), market(a, b)
            g = 1.0 if mp < 1 else max(0, md / mp)
            gain = 0.0
            for (c2, i2, d2), (f2, q2) in kept.items():
                if (c2, i2) == (c, inn) and d2 != d and f2 == form and any(a <= w <= b for w in q2):
                    gain += max(0, sum(v for w, v in q2.items() if a <= w <= b) - max(0, sum(v for w, v in q2.items() if pa <= w <= pb) * g))
            lost = max(0, own(a, b) - max(0, own(pa, pb) * g))
            if np.floor((gain + lost) * 1e4 + 0.5) / 1e4 >= 0.001:
                out[c, d, a] = (gain, lost)
    return out


@settings(max_examples=2, deadline=None)
@given(st.integers(0, 10**6))
def test_effects_against_a_plain_model(spark, seed):
    r = np.random.default_rng(seed)
    target, others = [], []
    for client in (1, 2):
        for drug in range(1, 6):
            packs = r.integers(1, 20, 30) * (r.random(30) > 0.35)
            target += series(drug, packs, client, inn=drug % 2 + 1, form="AB"[drug % 3 == 0], first=int(r.integers(0, 4)))
            others += series(drug, r.integers(0, 30, 36), client, pharm=9, inn=drug % 2 + 1)
    p = Params(min_market_count=1)
    forms = spark.createDataFrame([], "form string, group string, excluded boolean")
    s = Stages(spark.createDataFrame(target, ROW), weekly.competitor_totals(spark.createDataFrame(others, ROW)), forms, p, dip_test=False)
    start = {e.EVENT_ID: e.STOCKOUT_START for e in s.events.collect()}
    got = {(e.CLIENT_ID, e.DRUGS_ID, start[e.EVENT_ID]): (e.INTERNAL_LIFT, e.LOST_SALES) for e in s.did_events.collect()}
    want = model(target, others, p)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=6e-5) for k in want)
    for e in s.did_events.collect():
        assert e.SHARE_INTERNAL is None or abs(e.SHARE_INTERNAL + e.SHARE_LOST - 1) < 2e-6


def test_market_and_final_shares(spark):
    pairs = [("e1", 1, 1, 10, "t", "A", 20, "u", "A", True, 0.0, 0.0, 0.0, 3.0), ("e1", 1, 1, 10, "t", "A", 30, "v", "A", True, 0.0, 0.0, 0.0, 3.0), ("e2", 2, 1, 10, "t", "A", 20, "u", "A", True, 0.0, 0.0, 0.0, 6.0), ("e2", 2, 1, 10, "t", "A", 40, "w", "A", True, 0.0, 0.0, 0.0, 0.0), ("e2", 2, 1, 10, "t", "A", 50, "z", "A", True, 0.0, 0.0, 0.0, 1e-6)]
    kinds = "EVENT_ID string, CLIENT_ID long, INN_ID long, TARGET_DRUGS_ID long, TARGET_DRUGS_NAME string, TARGET_NFC1_ID string, SUBSTITUTE_DRUGS_ID long, SUBSTITUTE_DRUGS_NAME string, SUBSTITUTE_NFC1_ID string, SAME_NFC1 boolean, SALES_PRE double, SALES_DURING double, EXPECTED double, LIFT double"
    m = shares.market_shares(spark.createDataFrame(pairs, kinds), spark.createDataFrame([(1, "i")], "INN_ID long, INN_NAME string"))
    first = {(r.CLIENT_ID, r.SUBSTITUTE_DRUG_ID): (r.SUBSTITUTE_RANK, r.SUBSTITUTE_SHARE) for r in m.collect()}
    assert first[1, 20] == (1, 0.5) and first[1, 30] == (2, 0.5) and (2, 40) not in first
    assert all(r.passed for r in shares.share_sums(m).collect())
    final = shares.final_shares(m, spark.createDataFrame([(10,)], "DRUGS_ID long")).orderBy("SUBSTITUTE_RANK").collect()
    assert [(r.SUBSTITUTE_DRUG_ID, r.SUBSTITUTE_SHARE, r.MARKETS_COUNT) for r in final] == [(20, 0.75, 2), (30, 0.25, 1)]  # the share that rounds to 0 is gone


def stats_of(spark, values, p=Params(), dip_test=False):
    rows = [(i, 7, float(v), "d", 1, "A") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "CLIENT_ID long, DRUGS_ID long, SHARE_INTERNAL double, DRUGS_NAME string, INN_ID long, NFC1_ID string")
    return crossmarket.drug_statistics(df, spark.createDataFrame([(1, "i")], "INN_ID long, INN_NAME string"), p, dip_test)


@pytest.mark.parametrize("values,label,score", [([0.4], "SINGLE_MARKET", 0.0), ([0.0] * 150, "HIGH", 1.0), ([0.5] * 25, "HIGH", 0.642409)])
def test_reliability(spark, values, label, score):
    r = stats_of(spark, values).first()
    assert (r.RELIABILITY_LABEL, r.RELIABILITY_SCORE) == (label, score)


def test_outlier_goes(spark):
    r = stats_of(spark, [0.5, 0.51, 0.52, 0.53, 0.0]).first()
    assert (r.MARKET_COUNT_TOTAL, r.MARKET_COUNT_CLEAN, r.COVERAGE_PCT) == (5, 4, 1.0) and abs(r.MEAN_SHARE_INTERNAL - r.COVERAGE_PCT * r.CONDITIONAL_RETENTION) < 1e-5


def plain_dip(values):
    """The dip by its definition: the least d for which some distribution function, convex up to a value and concave after it, stays within d."""
    x, counts = np.unique(values, return_counts=True)
    high = np.cumsum(counts) / counts.sum()
    low = high - counts / counts.sum()

    def convex_fits(top, bottom, at):
        for k in range(len(at)):
            hull = min([top[k]] + [top[a] + (top[b] - top[a]) * (at[k] - at[a]) / (at[b] - at[a]) for a in range(k) for b in range(k + 1, len(at))])
            if hull < bottom[k] - 1e-12:
                return False
        return True

    def least_end(top, bottom, at):
        """The lowest last value of a convex function within the bounds: it can't rise less than before."""
        rises = [bottom[j] + (bottom[j] - top[i]) / (at[j] - at[i]) * (at[-1] - at[j]) for i in range(len(at)) for j in range(i + 1, len(at))]
        return max([bottom[-1], *rises])

    def fits(d):
        for m in range(len(x)):
            left, right = (low[: m + 1] + d, high[: m + 1] - d, x[: m + 1]), (d - high[m:][::-1], -d - low[m:][::-1], -x[m:][::-1])
            if convex_fits(*left) and convex_fits(*right) and least_end(*left) <= -least_end(*right) + 1e-12:
                return True
        return False

    a, b = 0.0, 0.5
    for _ in range(34):
        a, b = (a, (a + b) / 2) if fits((a + b) / 2) else ((a + b) / 2, b)
    return b


def test_dip(spark):
    r = np.random.default_rng(1)
    for n in (4, 5, 6, 8, 10, 12):
        for k in range(5):
            v = np.round(r.random(n) * 6) / 6 if k % 2 else r.random(n) ** 2
            if len(np.unique(v)) > 1:
                assert modality.dip(v) == pytest.approx(plain_dip(v), abs=1e-8)
    two = np.concatenate([r.normal(0.2, 0.02, 40), r.normal(0.8, 0.02, 40)])
    table = modality.reference_table(spark)
    assert {n: len(t) for n, t in table.items()} == dict.fromkeys(modality.SIZES, modality.DRAWS) and modality.reference_table(spark) is table
    assert modality.p_value(two, table) < 0.01 < 0.1 < modality.p_value(r.normal(0.5, 0.1, 80), table)
    assert modality.p_value(np.full(10, 0.3), table) == 1.0 and modality.dip(np.array([0.0, 0.0, 1.0, 1.0])) == 0.25
    assert abs(modality.dip(two) - modality.dip(two * 3 + 1)) < 1e-12  # location and scale don't matter
    for n in (9, 25):  # sizes between those of the table: about every twentieth uniform sample falls below 0.05
        assert 0.02 < np.mean([modality.p_value(r.random(n), table) < 0.05 for _ in range(600)]) < 0.08


def test_two_peaks_cost_reliability(spark):
    from lacuna.plans import queries

    found = queries.two_peaks(spark, "/root/testdata/sf0.01").collect()
    assert {(r.DRUGS_ID % 2, r.DRUG_CLASS) for r in found} == {(0, "MULTIMODAL"), (1, "UNIMODAL")}
    assert {r.DRUG_CLASS for r in queries.drug_modality(spark, "/root/testdata/sf0.01").collect()} == {"UNIMODAL"}  # as the SQL has it


def test_checks_and_adhoc(spark, tmp_path):
    from lacuna.plans.report import statistics

    p = Params(min_market_count=2)
    dc = export.drug_coefficients(stats_of(spark, [0.4, 0.5, 0.6], p), p)
    ss = spark.createDataFrame([(7, 8, 0.6, "a", "b", True, 1, 2), (7, 9, 0.4, "a", "c", True, 2, 2)], "DRUGS_ID long, SUBSTITUTE_DRUG_ID long, SUBSTITUTE_SHARE double, DRUGS_NAME string, SUBSTITUTE_DRUG_NAME string, SAME_NFC1 boolean, SUBSTITUTE_RANK int, MARKETS_COUNT long")
    assert {r.check: r.passed for r in export.validate(dc, ss, p).collect() if not r.passed} == {} and export.validate(dc, ss, p).count() == 17
    bad = {r.check for r in export.validate(dc, ss.withColumn("DRUGS_ID", F.lit(1)).withColumn("SUBSTITUTE_SHARE", F.lit(0.9)), p).collect() if not r.passed}
    assert bad == {"SS_SUM_INVARIANT", "SS_DRUGS_ID_IN_DC"}
    assert [r.check for r in export.validate(dc, ss.limit(0), p).collect() if r.check.startswith("SS")] == ["SS_EMPTY_BUT_PROCESSED"]
    v = spark.createDataFrame([(1, 50.0, 0.9), (2, 30.0, 0.8), (3, 15.0, 0.7), (4, 5.0, None)], "DRUGS_ID long, volume double, RELIABILITY_SCORE double")
    statistics(v, "volume", str(tmp_path / "statistics.txt"), 2)
    assert "== thresholds\nthreshold\tpassing\n0.0\t3\n" in (tmp_path / "statistics.txt").read_text()
    assert [r.DRUGS_ID for r in adhoc.pareto_cut(v, "volume", Params(pareto_target=0.8)).orderBy("position").collect()] == [1, 2]
    assert {r.bucket: r.drugs for r in adhoc.score_buckets(v).collect()} == {7: 1, 8: 1, 9: 1}
    assert [r.n for r in adhoc.histogram(v, "volume", 5).orderBy("bin").collect()] == [1, 1, 1, 1]
