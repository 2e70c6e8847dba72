"""Spreadsheets as a data source, sinks through the store, types of published tables, the running share."""

import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lacuna.operators import adhoc
from lacuna.sources import sheets

KINDS = "id long, x double, b boolean, t string"
ROWS = [(1, 0.5, True, "a"), (2, None, None, None), (2**53 + 1, 1e-9, False, " <&>\"' é\n\tend "), (-3, 2.0, True, "\x00\x0b\x1f_x0041_ _x\r"), (4, 1.0, False, "007")]


def test_a_workbook_keeps_values_and_types(spark, tmp_path):
    at = f"file:{tmp_path}/new folder/it's.xlsx"
    df = spark.createDataFrame(ROWS, KINDS)
    sheets.write_xlsx(df, at, 'a "b" <c>')
    assert sheets.sheet_name(at) == 'a "b" <c>'
    back = sheets.read_xlsx(spark, at)
    assert back.dtypes == df.dtypes and [tuple(r) for r in back.collect()] == ROWS
    some = spark.read.format("xlsx").schema("t string, id long").load(at)
    assert [tuple(r) for r in some.collect()] == [(r[3], r[0]) for r in ROWS]
    with pytest.raises(Exception, match="no column nope"):
        spark.read.format("xlsx").schema("nope string").load(at).collect()
    with pytest.raises(Exception, match="no sheet"):
        sheets.read_xlsx(spark, at, sheet="other").collect()
    sheets.write_xlsx(df.limit(0), at)  # in the place of the old one
    assert sheets.read_xlsx(spark, at).columns == df.columns and sheets.read_xlsx(spark, at).count() == 0


def two_sheets() -> bytes:
    """A workbook as other programs write it: shared strings, formulas, cells without places, parts in another order."""
    main, rel = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    whole = io.BytesIO()
    with zipfile.ZipFile(whole, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="one" sheetId="4" r:id="r7"/><sheet name="two" sheetId="1" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="r2" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r7" Type="{rel}/worksheet" Target="/xl/worksheets/sheet9.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>n</t></si><si><r><t>te</t></r><r><t>xt</t></r></si><si><t>v</t></si></sst>")
        head = '<row><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row>'
        z.writestr("xl/worksheets/sheet9.xml", f'<worksheet {main}><sheetData>{head}<row r="2"><c r="A2"><v>1</v></c><c r="B2" t="str"><f>A2</f><v>x</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData>{head}<row r="2"><c r="B2" t="s"><v>2</v></c></row><row r="3"><c r="A3"><v>2.5</v></c></row></sheetData></worksheet>')
    return whole.getvalue()


def test_sheets_are_partitions(spark, tmp_path):
    (tmp_path / "w.xlsx").write_bytes(two_sheets())
    at = str(tmp_path / "w.xlsx")
    assert [tuple(r) for r in sheets.read_xlsx(spark, at).collect()] == [(1, "x")]
    assert sheets.read_xlsx(spark, at).dtypes == [("n", "bigint"), ("text", "string")]
    assert [tuple(r) for r in sheets.read_xlsx(spark, at, sheet="two").collect()] == [(None, "v"), (2.5, None)]
    every = sheets.read_xlsx(spark, at, sheet="*")
    assert every.rdd.getNumPartitions() == 2 and every.dtypes[0] == ("n", "double") and every.count() == 3


def test_text_tables_keep_their_types(spark, tmp_path):
    at = f"file:{tmp_path}/deep/er/t.csv"
    df = spark.createDataFrame([("007", 1, 1.5, True, "a;b"), ("010", 2, None, False, 'say "x"')], "code string, n long, x double, b boolean, t string")
    sheets.write_csv(df, at)
    back = sheets.read_table(spark, at)
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert sheets.report(spark.createDataFrame([("c", True, "ok")], "check string, passed boolean, detail string"), f"file:{tmp_path}/deep/report.txt")
    assert (tmp_path / "deep/report.txt").read_text() == "1 of 1 checks passed\npass  c  ok\n"


def test_running_share_equals_the_window(spark):
    r = np.random.default_rng(2)
    rows = [(i, float(v)) for i, v in enumerate(r.integers(0, 50, 500))] + [(1000, None)]
    df = spark.createDataFrame(rows, "DRUGS_ID long, volume double")
    order = Window.orderBy(F.desc("volume"), "DRUGS_ID")
    want = df.select("DRUGS_ID", F.row_number().over(order).alias("position"), (F.sum("volume").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) / sum(v or 0 for _, v in rows)).alias("cum_share"))
    got = adhoc.pareto(df, "volume")
    assert sorted(map(tuple, got.select("DRUGS_ID", "position", "cum_share").collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and got.select("before").where("before IS NULL").count() == 0
    assert adhoc.pareto(df.where("DRUGS_ID < 0"), "volume").collect() == []
