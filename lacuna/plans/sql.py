"""The registered queries in SQL. Each CTE is one stage; a query names the stages that it needs.

SQL has no dip test: ``stats`` takes every product of the order tables as unimodal, which the queries find by testing them;
``two_peaks`` has products of either kind by construction."""

from __future__ import annotations

import re


def r(x: str, places: int) -> str:
    scale = f"CAST(1e{places} AS DOUBLE)"
    return f"(floor(({x}) * {scale} + 0.5) / {scale})"


CTES = {
    "names": """SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) AS BIGINT) AS "DRUGS_ID", split_part(p_name, ' ', 2) AS "INN_NAME",
        CAST(dense_rank() OVER (ORDER BY split_part(p_name, ' ', 2)) AS BIGINT) AS "INN_ID", 'F' || CAST(length(split_part(p_name, ' ', 1)) % 3 AS VARCHAR) AS "NFC1_ID"
        FROM (SELECT DISTINCT p_name FROM part)""",
    "sales": """SELECT n_regionkey AS "REGION", CAST(s_nationkey AS BIGINT) AS "CLIENT_ID", n."INN_ID", n."DRUGS_ID", n.p_name AS "DRUGS_NAME", n."INN_NAME", n."NFC1_ID",
        CAST(date_trunc('week', l_shipdate) AS DATE) AS "Date", CAST(sum(l_quantity) AS DOUBLE) AS "Q", CAST(sum(l_extendedprice) AS DOUBLE) AS "V"
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN names n ON part.p_name = n.p_name JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
    "dense": """SELECT "CLIENT_ID", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "INN_NAME", "NFC1_ID", CAST(wk AS DATE) AS "Date", CASE WHEN wk = "Date" THEN "Q" ELSE 0 END AS "Q", CASE WHEN wk = "Date" THEN "V" ELSE 0 END AS "V"
        FROM (SELECT *, unnest(generate_series(CAST("Date" AS TIMESTAMP), CAST(coalesce(nxt - 7, "Date") AS TIMESTAMP), INTERVAL 7 DAY)) AS wk
            FROM (SELECT *, lead("Date") OVER (PARTITION BY "CLIENT_ID", "INN_ID", "DRUGS_ID" ORDER BY "Date") AS nxt FROM sales))""",
    "rated": """SELECT *, avg(CASE WHEN "Q" = 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY "CLIENT_ID", "INN_ID", "DRUGS_ID") AS notsold FROM dense""",
    "comp": """SELECT c."CLIENT_ID", t."INN_ID", t."DRUGS_ID", t."Date", t.q - coalesce(s."Q", 0) AS pack, t.v - coalesce(s."V", 0) AS revenue
        FROM (SELECT "REGION", "INN_ID", "DRUGS_ID", "Date", sum("Q") AS q, sum("V") AS v FROM sales GROUP BY ALL) t
        JOIN (SELECT DISTINCT "REGION", "CLIENT_ID" FROM sales) c ON c."REGION" = t."REGION"
        LEFT JOIN sales s ON s."CLIENT_ID" = c."CLIENT_ID" AND s."DRUGS_ID" = t."DRUGS_ID" AND s."Date" = t."Date" """,
    "agg": """SELECT r.*, coalesce(c.pack, 0) AS pack, coalesce(c.revenue, 0) AS revenue FROM rated r LEFT JOIN comp c ON r."CLIENT_ID" = c."CLIENT_ID" AND r."DRUGS_ID" = c."DRUGS_ID" AND r."Date" = c."Date"
        WHERE notsold BETWEEN 0.20 AND 0.95""",
    "inn": """SELECT "CLIENT_ID", "INN_ID", "Date", sum(pack) AS inn_total FROM agg GROUP BY ALL""",
    "runs": """SELECT "CLIENT_ID", "INN_ID", "DRUGS_ID", min("INN_NAME") AS "INN_NAME", min("DRUGS_NAME") AS "DRUGS_NAME", min("NFC1_ID") AS "NFC1_ID", min("Date") AS s, max("Date") AS e, CAST(count(*) AS INTEGER) AS n, sum(pack) AS comp_during
        FROM (SELECT *, date_diff('day', DATE '1970-01-05', "Date") // 7 - row_number() OVER (PARTITION BY "CLIENT_ID", "INN_ID", "DRUGS_ID" ORDER BY "Date") AS island FROM agg WHERE "Q" = 0)
        GROUP BY "CLIENT_ID", "INN_ID", "DRUGS_ID", island""",
    "during": """SELECT k.*, sum(inn_total) AS inn_during FROM (SELECT DISTINCT "CLIENT_ID", "INN_ID", s, e FROM runs) k JOIN inn ON k."CLIENT_ID" = inn."CLIENT_ID" AND k."INN_ID" = inn."INN_ID" AND inn."Date" BETWEEN s AND e GROUP BY ALL""",
    "innpre": """SELECT k.*, sum(inn_total) AS inn_pre FROM (SELECT DISTINCT "CLIENT_ID", "INN_ID", s FROM runs) k JOIN inn ON k."CLIENT_ID" = inn."CLIENT_ID" AND k."INN_ID" = inn."INN_ID" AND inn."Date" BETWEEN s - 28 AND s - 7 GROUP BY ALL""",
    "ownpre": """SELECT k."CLIENT_ID", k."DRUGS_ID", k.s, sum(a."Q") AS pre_sum, count(*) AS pre_rows, sum(a.pack) AS comp_pre FROM runs k JOIN agg a ON k."CLIENT_ID" = a."CLIENT_ID" AND k."DRUGS_ID" = a."DRUGS_ID" AND a."Date" BETWEEN k.s - 28 AND k.s - 7 GROUP BY ALL""",
    "islands": """SELECT r.*, d.inn_during, coalesce(i.inn_pre, 0) AS inn_pre, o.pre_sum, coalesce(o.pre_rows, 0) AS pre_rows, coalesce(o.comp_pre, 0) AS comp_pre,
        CASE WHEN d.inn_during = 0 THEN 'no_market_activity' WHEN coalesce(o.pre_rows, 0) < 4 OR coalesce(o.pre_sum, 0) = 0 THEN 'no_pre_sales' WHEN r.comp_during = 0 THEN 'no_competitors' ELSE 'valid' END AS reason
        FROM runs r JOIN during d ON r."CLIENT_ID" = d."CLIENT_ID" AND r."INN_ID" = d."INN_ID" AND r.s = d.s AND r.e = d.e
        LEFT JOIN innpre i ON r."CLIENT_ID" = i."CLIENT_ID" AND r."INN_ID" = i."INN_ID" AND r.s = i.s LEFT JOIN ownpre o ON r."CLIENT_ID" = o."CLIENT_ID" AND r."DRUGS_ID" = o."DRUGS_ID" AND r.s = o.s""",
    "events": """SELECT *, CAST("CLIENT_ID" AS VARCHAR) || '_' || CAST("INN_ID" AS VARCHAR) || '_' || CASE WHEN k < 10000 THEN lpad(CAST(k AS VARCHAR), 4, '0') ELSE CAST(k AS VARCHAR) END AS "EVENT_ID"
        FROM (SELECT *, row_number() OVER (PARTITION BY "CLIENT_ID" ORDER BY "INN_ID", "DRUGS_ID", s) AS k FROM islands WHERE reason = 'valid')""",
    "nxt": """SELECT v."EVENT_ID", min(CASE WHEN a."Q" > 0 AND a."Date" > v.e THEN a."Date" END) AS ns, max(a."Date") AS last_week FROM events v JOIN agg a ON v."CLIENT_ID" = a."CLIENT_ID" AND v."DRUGS_ID" = a."DRUGS_ID" GROUP BY v."EVENT_ID" """,
    "post": """SELECT v.*, n.ns, CASE WHEN ns IS NULL THEN 'no_recovery' WHEN date_diff('day', v.e, ns) // 7 > 2 THEN 'gap_too_large' WHEN date_diff('day', ns, last_week) // 7 + 1 < 4 THEN 'insufficient_data' ELSE 'valid' END AS status
        FROM events v JOIN nxt n ON v."EVENT_ID" = n."EVENT_ID" """,
    "measured": """SELECT *, greatest(0, comp_during - greatest(0, comp_pre * growth)) AS lost FROM (SELECT *, CASE WHEN inn_pre < 1 THEN 1.0 ELSE greatest(0, inn_during / inn_pre) END AS growth FROM post WHERE status = 'valid')""",
    "span": """SELECT "CLIENT_ID", "INN_ID", "DRUGS_ID", min("DRUGS_NAME") AS "DRUGS_NAME", min("NFC1_ID") AS "NFC1_ID", min("Date") AS f, max("Date") AS l FROM agg GROUP BY ALL""",
    "cand": """SELECT m."EVENT_ID", m."CLIENT_ID", m."INN_ID", m."DRUGS_ID", m."DRUGS_NAME", m."NFC1_ID", m.s, m.e, m.growth, m.lost, t."DRUGS_ID" AS sub_id, t."DRUGS_NAME" AS sub_name, t."NFC1_ID" AS sub_form
        FROM measured m JOIN span t ON m."CLIENT_ID" = t."CLIENT_ID" AND m."INN_ID" = t."INN_ID" AND m."DRUGS_ID" <> t."DRUGS_ID" AND t.f <= m.e AND t.l >= m.s
        AND (m."NFC1_ID" = t."NFC1_ID" OR (m."NFC1_ID" IN ('F0', 'F1') AND t."NFC1_ID" IN ('F0', 'F1')))""",
    "sums": """SELECT c."EVENT_ID", c.sub_id, coalesce(sum(CASE WHEN a."Date" < c.s THEN a."Q" END), 0) AS pre, coalesce(sum(CASE WHEN a."Date" >= c.s THEN a."Q" END), 0) AS during
        FROM cand c JOIN agg a ON c."CLIENT_ID" = a."CLIENT_ID" AND c.sub_id = a."DRUGS_ID" AND a."Date" BETWEEN c.s - 28 AND c.e GROUP BY ALL""",
    "pairs": """SELECT c.*, u.pre, u.during, greatest(0, u.pre * growth) AS ex, greatest(0, u.during - greatest(0, u.pre * growth)) AS gain FROM cand c JOIN sums u ON c."EVENT_ID" = u."EVENT_ID" AND c.sub_id = u.sub_id""",
    "gains": """SELECT "EVENT_ID", CAST(sum(CAST(gain AS DECIMAL(28,9))) AS DOUBLE) AS internal, count(*) AS n, count(*) FILTER (WHERE gain > 0) AS n_lift FROM pairs GROUP BY ALL""",
    "did": f"""SELECT * FROM (SELECT m."EVENT_ID", m."CLIENT_ID", m."INN_ID", m."DRUGS_ID", m."DRUGS_NAME", m."NFC1_ID", ns AS "POST_START", ns + 21 AS "POST_END", 4 AS "POST_WEEKS", 'valid' AS "POST_STATUS",
        {r('inn_pre', 2)} AS "MARKET_PRE", {r('inn_during', 2)} AS "MARKET_DURING", {r('growth', 6)} AS "MARKET_GROWTH", {r('coalesce(internal, 0)', 4)} AS "INTERNAL_LIFT", {r('lost', 4)} AS "LOST_SALES",
        {r('coalesce(internal, 0) + lost', 4)} AS "TOTAL_EFFECT",
        CASE WHEN coalesce(internal, 0) + lost >= 0.001 THEN {r('coalesce(internal, 0) / (coalesce(internal, 0) + lost)', 6)} END AS "SHARE_INTERNAL", CASE WHEN coalesce(internal, 0) + lost >= 0.001 THEN {r('lost / (coalesce(internal, 0) + lost)', 6)} END AS "SHARE_LOST",
        CAST(coalesce(g.n, 0) AS INTEGER) AS "SUBSTITUTES_COUNT", CAST(coalesce(n_lift, 0) AS INTEGER) AS "SUBSTITUTES_WITH_LIFT" FROM measured m LEFT JOIN gains g ON m."EVENT_ID" = g."EVENT_ID") WHERE "TOTAL_EFFECT" >= 0.001""",
    "subpairs": f"""SELECT p."EVENT_ID", p."CLIENT_ID", p."INN_ID", p."DRUGS_ID" AS "TARGET_DRUGS_ID", p."DRUGS_NAME" AS "TARGET_DRUGS_NAME", p."NFC1_ID" AS "TARGET_NFC1_ID", sub_id AS "SUBSTITUTE_DRUGS_ID", sub_name AS "SUBSTITUTE_DRUGS_NAME", sub_form AS "SUBSTITUTE_NFC1_ID",
        p."NFC1_ID" = sub_form AS "SAME_NFC1", {r('pre', 4)} AS "SALES_PRE", {r('during', 4)} AS "SALES_DURING", {r('ex', 4)} AS "EXPECTED", {r('gain', 4)} AS "LIFT" FROM pairs p SEMI JOIN did d ON p."EVENT_ID" = d."EVENT_ID" """,
    "mshares": f"""SELECT "CLIENT_ID", "INN_ID", "INN_NAME", o AS "STOCKOUT_DRUG_ID", "STOCKOUT_DRUG_NAME", "STOCKOUT_NFC1_ID", u AS "SUBSTITUTE_DRUG_ID", "SUBSTITUTE_DRUG_NAME", "SUBSTITUTE_NFC1_ID", "SAME_NFC1", {r('t', 4)} AS "TOTAL_LIFT", {r('i', 4)} AS "INTERNAL_LIFT", {r('t / i', 6)} AS "SUBSTITUTE_SHARE",
        c AS "EVENTS_COUNT", CAST(row_number() OVER (PARTITION BY "CLIENT_ID", o ORDER BY {r('t / i', 12)} DESC, "INN_ID", u) AS INTEGER) AS "SUBSTITUTE_RANK"
        FROM (SELECT *, sum(t) OVER (PARTITION BY "CLIENT_ID", o) AS i FROM (SELECT s."CLIENT_ID", s."INN_ID", n.inn AS "INN_NAME", "TARGET_DRUGS_ID" AS o, min("TARGET_DRUGS_NAME") AS "STOCKOUT_DRUG_NAME", min("TARGET_NFC1_ID") AS "STOCKOUT_NFC1_ID", "SUBSTITUTE_DRUGS_ID" AS u,
            min("SUBSTITUTE_DRUGS_NAME") AS "SUBSTITUTE_DRUG_NAME", min("SUBSTITUTE_NFC1_ID") AS "SUBSTITUTE_NFC1_ID", bool_or("SAME_NFC1") AS "SAME_NFC1", sum("LIFT") AS t, count(*) AS c
            FROM subpairs s JOIN (SELECT DISTINCT "INN_ID", "INN_NAME" AS inn FROM names) n ON s."INN_ID" = n."INN_ID" GROUP BY s."CLIENT_ID", s."INN_ID", n.inn, "TARGET_DRUGS_ID", "SUBSTITUTE_DRUGS_ID") WHERE t > 0)""",
    "mdrug": """SELECT *, "INTERNAL_LIFT" / "TOTAL_EFFECT" AS x FROM (SELECT "CLIENT_ID", "DRUGS_ID", sum("INTERNAL_LIFT") AS "INTERNAL_LIFT", sum("LOST_SALES") AS "LOST_SALES", sum("TOTAL_EFFECT") AS "TOTAL_EFFECT", count(*) AS "EVENTS_COUNT", min("DRUGS_NAME") AS "DRUGS_NAME", min("INN_ID") AS "INN_ID", min("NFC1_ID") AS "NFC1_ID" FROM did GROUP BY ALL)""",
    "clean": """SELECT * FROM (SELECT m.*, f.q1, f.q3, f.total FROM mdrug m JOIN (SELECT "DRUGS_ID", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, count(*) AS total FROM mdrug GROUP BY ALL) f ON m."DRUGS_ID" = f."DRUGS_ID") WHERE x BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5""",
    "raw": """SELECT "DRUGS_ID", min("DRUGS_NAME") AS "DRUGS_NAME", min("INN_ID") AS "INN_ID", min("NFC1_ID") AS "NFC1_ID", max(total) AS total, count(*) AS n, avg(x) AS mean, count(*) FILTER (WHERE x > 0) AS w, coalesce(avg(x) FILTER (WHERE x > 0), 0) AS cond, coalesce(stddev_samp(x), 0) AS sd FROM clean GROUP BY "DRUGS_ID" """,
    "stats": f"""SELECT a."DRUGS_ID", a."DRUGS_NAME", a."INN_ID", n.inn AS "INN_NAME", a."NFC1_ID", CAST(total AS INTEGER) AS "MARKET_COUNT_TOTAL", CAST(a.n AS INTEGER) AS "MARKET_COUNT_CLEAN", {r('mean', 6)} AS "MEAN_SHARE_INTERNAL", {r('w / a.n', 6)} AS "COVERAGE_PCT", {r('cond', 6)} AS "CONDITIONAL_RETENTION", CAST(w AS INTEGER) AS "MARKETS_WITH_SUB",
        'UNIMODAL' AS "DRUG_CLASS", CAST(1.0 AS DOUBLE) AS "DIP_PVALUE", {r('sd', 6)} AS "STD_SHARE_INTERNAL", coalesce({r('cv', 6)}, 999.0) AS "VARIATION_COEF",
        CASE WHEN a.n < 2 THEN 'SINGLE_MARKET' WHEN cv < 0.15 THEN 'HIGH' WHEN cv < 0.30 THEN 'MEDIUM' ELSE 'LOW' END AS "RELIABILITY_LABEL",
        CASE WHEN a.n < 2 THEN 0.0 ELSE {r("(CASE WHEN mean > 0 THEN greatest(0, least(1, 1 - cv)) WHEN sd = 0 THEN 1.0 ELSE 0.0 END) * least(1, log10(a.n) / log10(150))", 6)} END AS "RELIABILITY_SCORE"
        FROM (SELECT *, CASE WHEN mean > 0 THEN sd / mean WHEN sd = 0 THEN 0.0 END AS cv FROM raw) a JOIN (SELECT DISTINCT "INN_ID", "INN_NAME" AS inn FROM names) n ON a."INN_ID" = n."INN_ID" """,
    "dc": f"""SELECT "DRUGS_ID", "DRUG_CLASS", "MEAN_SHARE_INTERNAL" AS "COEF_1", {r('1 - "MEAN_SHARE_INTERNAL"', 6)} AS "UNIQUENESS_COEF", "COVERAGE_PCT", "CONDITIONAL_RETENTION", "MARKETS_WITH_SUB", "DRUGS_NAME", "INN_ID", "INN_NAME", "NFC1_ID", "MARKET_COUNT_TOTAL" AS "MARKET_COUNT", "RELIABILITY_SCORE" FROM stats WHERE "MARKET_COUNT_TOTAL" >= 3""",
    "ss": f"""SELECT "DRUGS_ID", "SUBSTITUTE_DRUG_ID", x AS "SUBSTITUTE_SHARE", "DRUGS_NAME", "SUBSTITUTE_DRUG_NAME", "SAME_NFC1", CAST(row_number() OVER (PARTITION BY "DRUGS_ID" ORDER BY x DESC, "SUBSTITUTE_DRUG_ID") AS INTEGER) AS "SUBSTITUTE_RANK", "MARKETS_COUNT"
        FROM (SELECT p."STOCKOUT_DRUG_ID" AS "DRUGS_ID", "SUBSTITUTE_DRUG_ID", {r('t / i', 6)} AS x, "DRUGS_NAME", "SUBSTITUTE_DRUG_NAME", "SAME_NFC1", "MARKETS_COUNT"
            FROM (SELECT "STOCKOUT_DRUG_ID", "SUBSTITUTE_DRUG_ID", sum("TOTAL_LIFT") AS t, count(DISTINCT "CLIENT_ID") AS "MARKETS_COUNT", min("STOCKOUT_DRUG_NAME") AS "DRUGS_NAME", min("SUBSTITUTE_DRUG_NAME") AS "SUBSTITUTE_DRUG_NAME", bool_or("SAME_NFC1") AS "SAME_NFC1" FROM mshares WHERE "STOCKOUT_DRUG_ID" IN (SELECT "DRUGS_ID" FROM dc) GROUP BY ALL) p
            JOIN (SELECT "STOCKOUT_DRUG_ID", sum(one) AS i FROM (SELECT "CLIENT_ID", "STOCKOUT_DRUG_ID", max("INTERNAL_LIFT") AS one FROM mshares GROUP BY ALL) GROUP BY ALL) q ON p."STOCKOUT_DRUG_ID" = q."STOCKOUT_DRUG_ID") WHERE x > 0""",
    "vol": f"""SELECT "DRUGS_ID", "DRUGS_NAME", {r('CAST(sum(CAST("V" AS DECIMAL(28,2))) AS DOUBLE)', 0)} AS volume FROM sales GROUP BY ALL""",
    "rich": """SELECT v.*, d."RELIABILITY_SCORE" FROM vol v LEFT JOIN dc d ON v."DRUGS_ID" = d."DRUGS_ID" """,
}


def cte(select: str) -> str:
    """The select with the stages that it needs, directly or not, in order."""
    needed, todo = set(), [select]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in CTES if n in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


CHECKS = {
    "DC_NO_NAN_COEF_1": 'SELECT count(*) = 0 FROM dc WHERE "COEF_1" IS NULL',
    "DC_COEF_1_IN_0_1": 'SELECT count(*) = 0 FROM dc WHERE NOT coalesce("COEF_1" BETWEEN 0 AND 1, false)',
    "DC_UNIQUENESS_COEF_FORMULA": 'SELECT coalesce(max(abs("UNIQUENESS_COEF" - (1 - "COEF_1"))), 0) < 1e-5 FROM dc',
    "DC_DRUG_CLASS_VALUES": "SELECT count(*) = 0 FROM dc WHERE \"DRUG_CLASS\" NOT IN ('UNIMODAL', 'MULTIMODAL')",
    "DC_MARKET_COUNT_GE_MIN": 'SELECT min("MARKET_COUNT") >= 3 FROM dc',
    "DC_DRUGS_ID_UNIQUE": 'SELECT count(*) = count(DISTINCT "DRUGS_ID") FROM dc',
    "DC_COVERAGE_IN_0_1": 'SELECT count(*) = 0 FROM dc WHERE NOT coalesce("COVERAGE_PCT" BETWEEN 0 AND 1, false)',
    "DC_CONDITIONAL_IN_0_1": 'SELECT count(*) = 0 FROM dc WHERE NOT coalesce("CONDITIONAL_RETENTION" BETWEEN 0 AND 1, false)',
    "DC_DECOMPOSE_FORMULA": 'SELECT coalesce(max(abs("COEF_1" - "COVERAGE_PCT" * "CONDITIONAL_RETENTION")), 0) < 0.001 FROM dc',
    "DC_RELIABILITY_IN_0_1": 'SELECT count(*) = 0 FROM dc WHERE NOT coalesce("RELIABILITY_SCORE" BETWEEN 0 AND 1, false)',
    "SS_NO_NAN_SHARE": 'SELECT count(*) = 0 FROM ss WHERE "SUBSTITUTE_SHARE" IS NULL',
    "SS_SHARE_IN_0_1": 'SELECT count(*) = 0 FROM ss WHERE NOT coalesce("SUBSTITUTE_SHARE" BETWEEN 0 AND 1, false)',
    "SS_SUM_INVARIANT": 'SELECT coalesce(max(abs(s - 1)), 0) < 0.01 FROM (SELECT sum("SUBSTITUTE_SHARE") AS s FROM ss GROUP BY "DRUGS_ID")',
    "SS_DRUGS_ID_IN_DC": 'SELECT count(*) = 0 FROM ss WHERE "DRUGS_ID" NOT IN (SELECT "DRUGS_ID" FROM dc)',
    "SS_NO_DUP_PAIRS": 'SELECT count(*) = 0 FROM (SELECT 1 FROM ss GROUP BY "DRUGS_ID", "SUBSTITUTE_DRUG_ID" HAVING count(*) > 1)',
    "SS_RANK_STARTS_AT_1": 'SELECT min("SUBSTITUTE_RANK") = 1 FROM ss',
    "SS_NO_PHANTOMS": 'SELECT count(*) = 0 FROM ss WHERE "SUBSTITUTE_SHARE" <= 0',
}

SELECTS = {
    "weekly_sales": f'SELECT "CLIENT_ID", "REGION", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "INN_NAME", "NFC1_ID", "Date", "Q", {r(chr(34) + "V" + chr(34), 2)} AS "V" FROM sales',
    "gap_filled": f'SELECT "CLIENT_ID", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "Date", "Q", {r(chr(34) + "V" + chr(34), 2)} AS "V" FROM dense',
    "notsold": f'SELECT "CLIENT_ID", "DRUGS_ID", {r("max(notsold)", 6)} AS "NOTSOLD_PERCENT", count(*) AS weeks FROM rated GROUP BY "CLIENT_ID", "DRUGS_ID"',
    "market_totals": f'SELECT "CLIENT_ID", "INN_ID", "DRUGS_ID", "Date", pack AS "MARKET_TOTAL_DRUGS_PACK", {r("revenue", 2)} AS "MARKET_TOTAL_DRUGS_REVENUE" FROM comp',
    "aggregated": f'SELECT "CLIENT_ID", "CLIENT_ID" AS "PHARM_ID", "DRUGS_ID", "Date", "Q", {r(chr(34) + "V" + chr(34), 2)} AS "V", "DRUGS_NAME", "INN_NAME", "INN_ID", "NFC1_ID", "NFC1_ID" AS "NFC_ID", {r("notsold", 6)} AS "NOTSOLD_PERCENT", pack AS "MARKET_TOTAL_DRUGS_PACK", {r("revenue", 2)} AS "MARKET_TOTAL_DRUGS_REVENUE" FROM agg',
    "stockout_islands": 'SELECT "CLIENT_ID", "INN_ID", "DRUGS_ID", s AS "STOCKOUT_START", e AS "STOCKOUT_END", n AS "STOCKOUT_WEEKS", inn_during, comp_during, inn_pre, comp_pre FROM islands',
    "stockout_events": f'SELECT "EVENT_ID", "CLIENT_ID", "INN_ID", "INN_NAME", "DRUGS_ID", "DRUGS_NAME", "NFC1_ID", s AS "STOCKOUT_START", e AS "STOCKOUT_END", n AS "STOCKOUT_WEEKS", s - 28 AS "PRE_START", s - 7 AS "PRE_END", 4 AS "PRE_WEEKS", {r("pre_sum / pre_rows", 4)} AS "PRE_AVG_Q" FROM events',
    "validation_funnel": "SELECT reason, count(*) AS events, CAST(sum(n) AS BIGINT) AS weeks FROM islands GROUP BY reason",
    "post_period": """SELECT "EVENT_ID", status AS "POST_STATUS", CASE WHEN status = 'valid' THEN ns END AS "POST_START", CASE WHEN status = 'valid' THEN ns + 21 END AS "POST_END", CASE WHEN status = 'valid' THEN 4 ELSE 0 END AS "POST_WEEKS" FROM post""",
    "valid_substitutes": 'SELECT "EVENT_ID", "DRUGS_ID", sub_id AS "SUBSTITUTE_DRUGS_ID" FROM cand',
    "did_events": "SELECT * FROM did",
    "substitute_pairs": "SELECT * FROM subpairs",
    "market_shares": "SELECT * FROM mshares",
    "share_invariant": 'SELECT "CLIENT_ID", count(*) AS drugs, max(abs(s - 1)) < 0.001 AS passed FROM (SELECT "CLIENT_ID", "STOCKOUT_DRUG_ID", sum("SUBSTITUTE_SHARE") AS s FROM mshares GROUP BY ALL) GROUP BY "CLIENT_ID"',
    "market_drug": f'SELECT "CLIENT_ID", "DRUGS_ID", {r(chr(34) + "INTERNAL_LIFT" + chr(34), 4)} AS "INTERNAL_LIFT", {r(chr(34) + "LOST_SALES" + chr(34), 4)} AS "LOST_SALES", {r(chr(34) + "TOTAL_EFFECT" + chr(34), 4)} AS "TOTAL_EFFECT", "EVENTS_COUNT", "DRUGS_NAME", "INN_ID", "NFC1_ID", {r("x", 6)} AS "SHARE_INTERNAL" FROM mdrug',
    "iqr_trim": f'SELECT "CLIENT_ID", "DRUGS_ID", {r("x", 6)} AS "SHARE_INTERNAL" FROM clean',
    "drug_statistics": 'SELECT * EXCLUDE ("DIP_PVALUE") FROM stats',
    "two_peaks": f"""SELECT "DRUGS_ID", CASE WHEN "DRUGS_ID" % 2 = 0 THEN 'MULTIMODAL' ELSE 'UNIMODAL' END AS "DRUG_CLASS", CAST(n AS INTEGER) AS "MARKET_COUNT_CLEAN", {r('mean', 6)} AS "MEAN_SHARE_INTERNAL", {r('sd', 6)} AS "STD_SHARE_INTERNAL", {r('sd / mean', 6)} AS "VARIATION_COEF",
        CASE WHEN sd / mean < 0.15 THEN 'HIGH' WHEN sd / mean < 0.30 THEN 'MEDIUM' ELSE 'LOW' END AS "RELIABILITY_LABEL", {r("greatest(0, 1 - sd / mean) * least(1, log10(n) / log10(150)) * CASE WHEN DRUGS_ID % 2 = 0 THEN 0.85 ELSE 1 END", 6)} AS "RELIABILITY_SCORE"
        FROM (SELECT "DRUGS_ID", count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd FROM (SELECT DISTINCT "CLIENT_ID", "DRUGS_ID", CAST(CASE WHEN "DRUGS_ID" % 2 = 1 THEN 0.5 WHEN "CLIENT_ID" % 2 = 0 THEN 0.2 ELSE 0.8 END AS DOUBLE) AS x FROM sales) GROUP BY "DRUGS_ID")""",
    "drug_coefficients": "SELECT * FROM dc",
    "substitute_shares": "SELECT * FROM ss",
    "checks": " UNION ALL ".join(f"SELECT '{n}' AS \"check\", ({q}) AS passed" for n, q in CHECKS.items()),
    "reliability_match": 'SELECT count(*) AS n, count("RELIABILITY_SCORE") AS n_matched, count(*) - count("RELIABILITY_SCORE") AS n_unmatched FROM rich',
    "pareto_cut": f"""SELECT "DRUGS_ID", volume, CAST(k AS INTEGER) AS position, {r("c", 6)} AS cum_share FROM (SELECT *, coalesce(lag(c) OVER (ORDER BY k), 0) AS b FROM (SELECT "DRUGS_ID", volume, row_number() OVER (ORDER BY volume DESC, "DRUGS_ID") AS k, sum(volume) OVER (ORDER BY volume DESC, "DRUGS_ID" ROWS UNBOUNDED PRECEDING) / sum(volume) OVER () AS c FROM rich WHERE "RELIABILITY_SCORE" BETWEEN 0.20 AND 1.0)) WHERE b < 0.8""",
    "pareto_curve": f"""SELECT "DRUGS_ID", CAST(row_number() OVER (ORDER BY volume DESC, "DRUGS_ID") AS INTEGER) AS position, {r('sum(volume) OVER (ORDER BY volume DESC, "DRUGS_ID" ROWS UNBOUNDED PRECEDING) / sum(volume) OVER ()', 6)} AS cum_share FROM vol""",
    "tiers": f"""SELECT CASE WHEN "COEF_1" >= 0.85 THEN 'A' WHEN "COEF_1" >= 0.55 THEN 'B' ELSE 'C' END AS tier, count(*) AS drugs, {r('avg("COEF_1")', 6)} AS mean_coef FROM dc GROUP BY 1""",
    "reliability_hist": f"""SELECT bucket, drugs, CAST(sum(drugs) OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative, {r('drugs * 100.0 / sum(drugs) OVER ()', 4)} AS pct FROM (SELECT CAST(least(9, floor("RELIABILITY_SCORE" * 10)) AS INTEGER) AS bucket, count(*) AS drugs FROM dc GROUP BY 1)""",
    "score_sweep": 'SELECT CAST(t AS DOUBLE) AS threshold, (SELECT count(*) FROM dc WHERE "RELIABILITY_SCORE" >= t) AS passing FROM (SELECT unnest([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9]::DOUBLE[]) AS t)',
    "reliability_summary": "SELECT count(x) AS n, " + ", ".join(f"{r(q, 6)} AS {n}" for n, q in (("low", "min(x)"), ("high", "max(x)"), ("mean", "avg(x)"), ("std", "stddev_samp(x)"), *((f"p{k}", f"quantile_cont(x, {k / 100})") for k in (10, 25, 50, 75, 90)))) + ' FROM (SELECT "RELIABILITY_SCORE" AS x FROM dc)',
    "coef_histogram": 'SELECT CAST(least(49, CASE WHEN hi > lo THEN floor((x - lo) * 50 / (hi - lo)) ELSE 0 END) AS INTEGER) AS bin, count(*) AS n FROM (SELECT "COEF_1" AS x, min("COEF_1") OVER () AS lo, max("COEF_1") OVER () AS hi FROM dc) GROUP BY 1',
    "coefficient_contours": f"""SELECT "DRUGS_ID", level, "COVERAGE_PCT" AS coverage, {r('least(1, level / nullif("COVERAGE_PCT", 0))', 6)} AS contour, "COVERAGE_PCT" * "CONDITIONAL_RETENTION" >= level AS above
        FROM dc, (SELECT CAST(unnest([0.25, 0.5, 0.75]) AS DOUBLE) AS level)""",
    "subset_semi": 'SELECT * FROM ss WHERE "DRUGS_ID" IN (SELECT "DRUGS_ID" FROM dc WHERE "RELIABILITY_SCORE" >= 0.25)',
    "missing_anti": 'SELECT "DRUGS_ID" FROM vol WHERE "DRUGS_ID" NOT IN (SELECT "DRUGS_ID" FROM ss WHERE "DRUGS_ID" IN (SELECT "DRUGS_ID" FROM dc WHERE "RELIABILITY_SCORE" >= 0.25))',
    "form_registry": """SELECT DISTINCT "NFC1_ID" AS form, CASE WHEN "NFC1_ID" IN ('F0', 'F1') THEN 'solid' ELSE 'EXACT_MATCH' END AS "group" FROM sales""",
    "form_compatibility": """SELECT a.f AS form_a, b.f AS form_b, a.f = b.f OR (a.f IN ('F0', 'F1') AND b.f IN ('F0', 'F1')) AS is_compatible FROM (SELECT DISTINCT "NFC1_ID" AS f FROM sales) a, (SELECT DISTINCT "NFC1_ID" AS f FROM sales) b""",
    "period_parse": """SELECT DISTINCT CAST(year(o_orderdate) * 100000 + dayofyear(o_orderdate) - 1 AS BIGINT) AS "PERIOD_ID", CAST(o_orderdate AS DATE) AS "Date", CAST(date_trunc('week', o_orderdate) AS DATE) AS "Monday" FROM orders""",
    "comma_decimal": f'SELECT l_orderkey, l_linenumber, {r("CAST(l_extendedprice AS DOUBLE)", 2)} AS "V" FROM lineitem',
    "top_volume": 'SELECT "DRUGS_ID", volume FROM vol ORDER BY volume DESC, "DRUGS_ID" LIMIT 20',
    "products_per_market": 'SELECT "CLIENT_ID", count(DISTINCT "DRUGS_ID") AS drugs, count(DISTINCT "INN_ID") AS inns, count(*) AS rows FROM agg GROUP BY "CLIENT_ID"',
    "recovery_counts": 'SELECT status AS "POST_STATUS", count(*) AS events FROM post GROUP BY 1',
    "market_summary": """SELECT a."CLIENT_ID", a.products, a.weeks, coalesce(r.n, 0) AS runs, coalesce(e.n, 0) AS events, coalesce(m.n, 0) AS measured, coalesce(d.n, 0) AS effects
        FROM (SELECT "CLIENT_ID", count(DISTINCT "DRUGS_ID") AS products, count(*) AS weeks FROM agg GROUP BY 1) a LEFT JOIN (SELECT "CLIENT_ID", count(*) AS n FROM islands GROUP BY 1) r ON r."CLIENT_ID" = a."CLIENT_ID"
        LEFT JOIN (SELECT "CLIENT_ID", count(*) AS n FROM events GROUP BY 1) e ON e."CLIENT_ID" = a."CLIENT_ID" LEFT JOIN (SELECT "CLIENT_ID", count(*) AS n FROM measured GROUP BY 1) m ON m."CLIENT_ID" = a."CLIENT_ID"
        LEFT JOIN (SELECT "CLIENT_ID", count(*) AS n FROM did GROUP BY 1) d ON d."CLIENT_ID" = a."CLIENT_ID" """,
    "file_rows": f"""SELECT c."CLIENT_ID", s."CLIENT_ID" AS "PHARM_ID", s."INN_ID", s."DRUGS_ID", s."DRUGS_NAME", s."INN_NAME", s."NFC1_ID", s."Date", s."Q", {r('s."V"', 2)} AS "V" FROM sales s JOIN (SELECT DISTINCT "REGION", "CLIENT_ID" FROM sales) c ON c."REGION" = s."REGION" """,
    "stored_did_events": "SELECT * FROM did",
    "stored_shares": "SELECT * FROM mshares",
    "stage_counts": """SELECT * FROM (
        SELECT 'rows' AS stage, unnest(['rows', 'malformed', 'stray']) AS kind, unnest([(SELECT count(*) FROM sales s JOIN (SELECT DISTINCT "REGION", "CLIENT_ID" FROM sales) c ON c."REGION" = s."REGION"), 0, 0]) AS n
        UNION ALL SELECT 'aggregated', unnest(['rows', 'forms']), unnest([(SELECT count(*) FROM agg), (SELECT count(DISTINCT "NFC1_ID") FROM agg)])
        UNION ALL SELECT 'stockout_runs', unnest(['rows', 'valid', 'no_market_activity', 'no_pre_sales', 'no_competitors']), unnest([count(*), count(*) FILTER (reason = 'valid'), count(*) FILTER (reason = 'no_market_activity'), count(*) FILTER (reason = 'no_pre_sales'), count(*) FILTER (reason = 'no_competitors')]) FROM islands
        UNION ALL SELECT 'stockout_events', unnest(['rows', 'valid', 'no_recovery', 'gap_too_large', 'insufficient_data']), unnest([count(*), count(*) FILTER (status = 'valid'), count(*) FILTER (status = 'no_recovery'), count(*) FILTER (status = 'gap_too_large'), count(*) FILTER (status = 'insufficient_data')]) FROM post
        UNION ALL SELECT 'pairs', unnest(['rows', 'with_gain']), unnest([count(*), count(*) FILTER (gain > 0)]) FROM pairs
        UNION ALL SELECT 'did_events', unnest(['rows', 'clients']), unnest([count(*), count(DISTINCT "CLIENT_ID")]) FROM did
        UNION ALL SELECT 'substitute_pairs', 'rows', count(*) FROM subpairs UNION ALL SELECT 'substitute_shares', 'rows', count(*) FROM mshares)""",
    "published_coefficients": "SELECT * FROM dc",
    "published_shares": "SELECT * FROM ss",
    "top_substitutes": 'SELECT "DRUGS_ID", "SUBSTITUTE_DRUG_ID", "SUBSTITUTE_SHARE", "SUBSTITUTE_RANK" FROM ss WHERE "SUBSTITUTE_RANK" <= 3',
}

ORACLE = {name: cte(select) for name, select in SELECTS.items()}
