"""Tables in which no product gets a coefficient: the registered queries still say what their SQL says."""

import duckdb

from lacuna.operators import export
from lacuna.params import Params
from lacuna.plans.sql import CHECKS

SMALL = "/root/testdata/sf0.001"


def rows_by_sql(folder, name):
    import __spark_entry__ as e

    with duckdb.connect() as c:
        for t in ("part", "supplier", "nation", "lineitem"):
            c.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
        return sorted(c.execute(e.oracle_sql()[name]).fetchall())


def test_checks_of_tables_without_effects(spark, tmp_path):
    import __spark_entry__ as e

    for t in ("part", "supplier", "nation"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet.d"))
    spark.read.parquet(f"{SMALL}/lineitem.parquet").orderBy("l_orderkey", "l_linenumber").limit(50).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet.d"))
    for d in list(tmp_path.glob("*.d")):
        next(d.glob("part-*.parquet")).rename(tmp_path / d.name[:-2])
    found = sorted(tuple(r) for r in e.queries()["checks"](spark, str(tmp_path)).collect())
    assert found == rows_by_sql(tmp_path, "checks") and len(found) == 17
    assert {c for c, passed in found if passed is None} == {"DC_MARKET_COUNT_GE_MIN", "SS_RANK_STARTS_AT_1"}


def test_checks_of_products_that_sell_every_week(spark, tmp_path):
    """More sales of the same products and weeks, as in larger tables, leave no series with unsold weeks."""
    import __spark_entry__ as e

    with duckdb.connect() as c:
        for t in ("part", "supplier", "nation"):
            c.execute(f"COPY (FROM '/root/testdata/sf0.1/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
        day = "TIMESTAMP '1995-01-02' + to_days(CAST(date_diff('day', TIMESTAMP '1995-01-02', l_shipdate) % 70 AS INTEGER))"
        c.execute(f"COPY (SELECT * REPLACE ({day} AS l_shipdate) FROM '/root/testdata/sf0.1/lineitem.parquet') TO '{tmp_path}/lineitem.parquet'")
    assert rows_by_sql(tmp_path, "weekly_sales") and not rows_by_sql(tmp_path, "aggregated")
    found = sorted(tuple(r) for r in e.queries()["checks"](spark, str(tmp_path)).collect())
    assert found == rows_by_sql(tmp_path, "checks") and len(found) == 17


def test_each_table_may_be_empty_alone(spark):
    dc = spark.createDataFrame([(7, "UNIMODAL", 0.5, 0.5, 1.0, 0.5, 3, 0.2)], "DRUGS_ID long, DRUG_CLASS string, COEF_1 double, UNIQUENESS_COEF double, COVERAGE_PCT double, CONDITIONAL_RETENTION double, MARKET_COUNT int, RELIABILITY_SCORE double")
    ss = spark.createDataFrame([(7, 8, 1.0, 1)], "DRUGS_ID long, SUBSTITUTE_DRUG_ID long, SUBSTITUTE_SHARE double, SUBSTITUTE_RANK int")
    for a, b in ((dc, ss), (dc, ss.limit(0)), (dc.limit(0), ss), (dc.limit(0), ss.limit(0))):
        found = {r.check: r.passed for r in export.every_check(a, b, Params(min_market_count=3)).collect()}
        with duckdb.connect() as c:
            for name, df in (("dc", a), ("ss", b)):
                t = df.toArrow()  # noqa: F841
                c.execute(f"CREATE TABLE {name} AS FROM t")
            assert found == {n: c.execute(q).fetchone()[0] for n, q in CHECKS.items()}
    empty = export.validate(dc.limit(0), ss.limit(0), Params(min_market_count=3)).collect()
    assert [(r.check, r.passed, r.detail) for r in empty] == [("DC_EMPTY_BUT_PROCESSED", True, "0 rows"), ("SS_EMPTY_BUT_PROCESSED", True, "0 rows")]
