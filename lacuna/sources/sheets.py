"""Spreadsheets and delimited text: a data source that reads sheets in tasks, and small final tables written through the store of their path.

Large tables stay Parquet."""

from __future__ import annotations

import csv
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from lacuna.sources.files import input_file, write_bytes, write_text

#: Rows up to which a table counts as small.
MOST_ROWS = 1_000_000
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def small_rows(df: DataFrame) -> list:
    rows = df.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows: write Parquet instead")
    return rows


def write_csv(df: DataFrame, path: str) -> None:
    """One semicolon-separated file with a byte-order mark."""
    text = io.StringIO(newline="")
    out = csv.writer(text, delimiter=";", lineterminator="\n")
    out.writerow(df.columns)
    out.writerows(["" if v is None else v for v in r] for r in small_rows(df))
    write_bytes(df.sparkSession, path, text.getvalue().encode("utf-8-sig"))


#: Characters that a workbook's text can't hold, and text that looks like their code, are written as codes.
_CODED = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def coded(text: str) -> str:
    return escape(_CODED.sub(lambda m: f"_x{ord(m[0]):04X}_", text)).replace("\r", "_x000D_")


def decoded(text: str) -> str:
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text)


def letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def write_xlsx(df: DataFrame, path: str, sheet: str = "data") -> None:
    """Numbers stay numbers (doubles with six decimals), dates and the rest are text."""

    def cell(i: int, n: int, v) -> str:
        at = f"{letters(i)}{n}"
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{at}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{at}"{" s=" + chr(34) + "1" + chr(34) if isinstance(v, float) else ""}><v>{v!r}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{coded(str(v))}</t></is></c>'

    rows = [tuple(df.columns), *small_rows(df)]
    data = "".join(f'<row r="{n}">' + "".join(cell(i, n, v) for i, v in enumerate(r)) + "</row>" for n, r in enumerate(rows, 1))
    main = _NS["m"]
    whole = io.BytesIO()
    with zipfile.ZipFile(whole, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{_REL}"><sheets><sheet name="{escape(sheet, {chr(34): '&quot;'})}" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{_REL}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<?xml version="1.0"?><styleSheet xmlns="{main}"><numFmts count="1"><numFmt numFmtId="164" formatCode="0.000000"/></numFmts><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellXfs count="2"><xf/><xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<?xml version="1.0"?><worksheet xmlns="{main}"><sheetData>{data}</sheetData></worksheet>')
    write_bytes(df.sparkSession, path, whole.getvalue())


def _tag(name: str) -> str:
    return f"{{{_NS['m']}}}{name}"


def sheet_parts(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part of the file) of each sheet, in their order."""
    target = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    sheets = ET.fromstring(z.read("xl/workbook.xml")).iter(_tag("sheet"))
    return [(s.get("name"), t.lstrip("/") if (t := target[s.get(f"{{{_REL}}}id")]).startswith("/") else f"xl/{t}") for s in sheets]


def _text(node: ET.Element) -> str:
    return decoded("".join(t.text or "" for t in node.iter(_tag("t"))))


def cells(z: zipfile.ZipFile, part: str) -> Iterator[dict[int, object]]:
    """The rows of a sheet as place -> value, one at a time; numbers stay text."""
    shared = [_text(s) for s in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
    with z.open(part) as f:
        for _, node in ET.iterparse(f):
            if node.tag != _tag("row"):
                continue
            row: dict[int, object] = {}
            for i, c in enumerate(node):
                at = i + 1
                if place := c.get("r"):
                    at = 0
                    for letter in re.match("[A-Z]+", place)[0]:
                        at = at * 26 + ord(letter) - 64
                value, kind = c.findtext("m:v", None, _NS), c.get("t")
                row[at - 1] = _text(c) if kind == "inlineStr" else shared[int(value)] if kind == "s" else value == "1" if kind == "b" else decoded(value) if kind == "str" and value else value if value is None else Number(value)
            yield row
            node.clear()


class Number(str):
    """The text of a cell that is a number."""


def kind_of(values: list[object]) -> str:
    """The type that holds all values of a column."""
    found = [v for v in values if v is not None]
    if found and all(isinstance(v, bool) for v in found):
        return "boolean"
    if found and all(isinstance(v, Number) for v in found):
        return "long" if all(re.fullmatch(r"-?[0-9]+", v) for v in found) else "double"
    return "string"


def _converted(value: object, kind: str) -> object:
    if value is None or (value == "" and kind != "string"):
        return None
    if kind in ("bigint", "int"):
        return int(float(value)) if re.search("[.eE]", value) else int(value)
    return {"double": float, "boolean": bool, "string": str}[kind](value)


class SheetPart(InputPartition):
    """A sheet of a file."""

    def __init__(self, path: str, part: str):
        self.path, self.part = path, part


class SheetReader(DataSourceReader):
    """A task for each sheet; rows leave it in batches."""

    def __init__(self, schema: StructType, parts: list[SheetPart]):
        self.schema, self.parts = schema, parts

    def partitions(self) -> list[SheetPart]:
        return self.parts

    def read(self, partition: SheetPart) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fields, arrow = [(f.name, f.dataType.simpleString()) for f in self.schema], to_arrow_schema(self.schema)
        with input_file(partition.path) as f, zipfile.ZipFile(f) as z:
            rows = cells(z, partition.part)
            names = {str(v): i for i, v in next(rows, {}).items()}
            if missing := [n for n, _ in fields if n not in names]:
                raise ValueError(f"{partition.path} has no column {', '.join(missing)}")
            held: list[list] = []
            for row in rows:
                held.append([_converted(row.get(names[n]), k) for n, k in fields])
                if len(held) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)


class Sheets(DataSource):
    """spark.read.format("xlsx").load(path): rows below the header. Option ``sheet``: a name, or ``*`` for all sheets; the first one without it.

    Columns are chosen by the schema's names; without a schema all are read, typed by the cells of all the sheets."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _parts(self) -> list[SheetPart]:
        path, wanted = self.options["path"], self.options.get("sheet")
        with input_file(path) as f, zipfile.ZipFile(f) as z:
            found = sheet_parts(z)
        kept = found if wanted == "*" else [x for x in found if x[0] == wanted] if wanted else found[:1]
        if not kept:
            raise ValueError(f"{path} has no sheet {wanted!r}")
        return [SheetPart(path, part) for _, part in kept]

    def schema(self) -> str:
        kinds: dict[str, set[str]] = {}
        for p in self._parts():
            with input_file(p.path) as f, zipfile.ZipFile(f) as z:
                rows = cells(z, p.part)
                names = {i: str(v) for i, v in next(rows, {}).items()}
                for n in names.values():
                    kinds.setdefault(n, set())
                for row in rows:
                    for i, n in names.items():
                        if row.get(i) is not None:
                            kinds[n].add(kind_of([row[i]]))
        both = lambda k: next(iter(k)) if len(k) == 1 else "double" if k == {"long", "double"} else "string"
        return ", ".join(f"`{n}` {both(k)}" for n, k in kinds.items()) or "nothing string"

    def reader(self, schema: StructType) -> SheetReader:
        return SheetReader(schema, self._parts())


def sheet_name(path: str) -> str:
    """The name of a workbook's first sheet."""
    with input_file(path) as f, zipfile.ZipFile(f) as z:
        return sheet_parts(z)[0][0]


def read_xlsx(spark: SparkSession, path: str, schema: str | None = None, sheet: str | None = None) -> DataFrame:
    spark.dataSource.register(Sheets)
    reader = spark.read.format("xlsx").options(**({"sheet": sheet} if sheet else {}))
    return (reader.schema(schema) if schema else reader).load(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated text with a header. A column is of numbers or booleans only if they would be written as they stand, so 007 stays text."""
    text = spark.read.csv(path, sep=";", header=True, escape='"')
    shapes = {"long": "-?(0|[1-9][0-9]{0,17})", "double": r"-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?", "boolean": "(?i)true|false"}
    fits = [F.coalesce(F.every(F.col(f"`{c}`").rlike(f"^({shape})$")), F.lit(False)).alias(f"{i}{kind}") for i, c in enumerate(text.columns) for kind, shape in shapes.items()]
    row = text.agg(*fits).first()
    kinds = [next((k for k in shapes if row[f"{i}{k}"]), "string") for i in range(len(text.columns))]
    return text.select(*[F.col(f"`{c}`").cast(k).alias(c) for c, k in zip(text.columns, kinds, strict=True)])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A published table by its extension: a spreadsheet, or semicolon-separated text with a header."""
    return read_xlsx(spark, path) if path.lower().endswith(".xlsx") else read_csv(spark, path)


def report(checks: DataFrame, path: str) -> bool:
    """A text report of the checks; whether all passed."""
    rows = checks.orderBy("check").collect()  # a row for each check
    good = all(r.passed for r in rows)
    lines = [f"{sum(r.passed for r in rows)} of {len(rows)} checks passed", *(f"{'pass' if r.passed else 'FAIL'}  {r.check}  {r.detail}" for r in rows)]
    write_text(checks.sparkSession, path, "\n".join(lines) + "\n")
    return good
