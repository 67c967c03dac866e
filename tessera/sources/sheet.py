"""Sheets: a small OOXML reader and writer on the standard library, and the tables around them.

A workbook is a driver-side file of bounded size (a ticket export, a reviewer's view); its rows
become a DataFrame at once. Larger inputs come as Parquet, JSON or CSV with the same columns.

Cases: missing cells are null; numbers read as text without a trailing ``.0``; a missing question
or answer column is an error, a missing extra one is skipped; an empty sheet gives an empty table.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.params import DEFAULTS, Params
from tessera.sources import files

CORE = {"category": "Category", "question": "Question", "answer": "Answer", "source_file": "Source file", "source_rows": "Source rows", "updated_at": "Updated", "doubtful": "Doubtful"}
REJECTED = ["source_row", "reason", "topic", "question", "answer", "model_question", "model_answer"]
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _name(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def read_workbook(data: bytes) -> dict[str, list[list[str | None]]]:
    """The cells of each sheet as text, in the workbook's order."""
    tag = lambda name: f"{{{_NS['m']}}}{name}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(tag("t"))) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        targets = {r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        listed = ET.fromstring(z.read("xl/workbook.xml")).iter(tag("sheet"))
        sheets = {s.get("name"): ET.fromstring(z.read("xl/" + targets[s.get(_ID)])) for s in listed}
    return {name: [_row_cells(cells, shared) for cells in _numbered_rows(sheet, tag("row"))] for name, sheet in sheets.items()}


def _numbered_rows(sheet: ET.Element, row_tag: str) -> Iterable[ET.Element | None]:
    """The rows of a sheet at their numbers, None for those that it leaves out."""
    n = 0
    for row in sheet.iter(row_tag):
        number = int(row.get("r", n + 1))
        yield from [None] * (number - 1 - n)
        yield row
        n = number


def _row_cells(row: ET.Element | None, shared: list[str]) -> list[str | None]:
    cells: list[str | None] = []
    for c in () if row is None else row.findall("m:c", _NS):
        at = _column(c.get("r")) if c.get("r") else len(cells)
        cells += [None] * (at + 1 - len(cells))
        kind, v = c.get("t", "n"), c.find("m:v", _NS)
        if kind == "inlineStr":
            cells[at] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
        elif v is not None and v.text is not None:
            cells[at] = shared[int(v.text)] if kind == "s" else re.sub(r"\.0$", "", v.text)
    return cells


def _data(path: str) -> bytes:
    return files.read(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate(), path)


def read_cells(path: str) -> list[list[str | None]]:
    """The first sheet's cells as text."""
    return next(iter(read_workbook(_data(path)).values()), [])


def write_cells(path: str, header: list[str], rows: Iterable[list], marked: Iterable[bool] = (), widths: list[int] | None = None, name: str = "Sheet1") -> None:
    """One formatted sheet: bold filled header, wrapped cells, marked rows filled, panes frozen, filter on."""
    cell = lambda r, c, v, s: f'<c r="{_name(c)}{r}" s="{s}" t="inlineStr"><is><t xml:space="preserve">{escape(_clean(v))}</t></is></c>'
    body, n = [f'<row r="1">{"".join(cell(1, c, h, 1) for c, h in enumerate(header))}</row>'], 1
    marks = iter(marked)
    for row in rows:
        n += 1
        style = 3 if next(marks, False) else 2
        body.append(f'<row r="{n}">{"".join(cell(n, c, v, style) for c, v in enumerate(row))}</row>')
    cols = "".join(f'<col min="{k + 1}" max="{k + 1}" width="{w}" customWidth="1"/>' for k, w in enumerate(widths or [30] * len(header)))
    main = f'xmlns="{_NS["m"]}"'
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    pane = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
    sheet = f'{head}<worksheet {main}>{pane}<cols>{cols}</cols><sheetData>{"".join(body)}</sheetData><autoFilter ref="A1:{_name(max(0, len(header) - 1))}{n}"/></worksheet>'
    fills = "".join(f"<fill>{p}</fill>" for p in ('<patternFill patternType="none"/>', '<patternFill patternType="gray125"/>', *(f'<patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill>' for c in ("FFD9E1F2", "FFFFF2CC"))))
    xfs = "".join(f'<xf numFmtId="0" fontId="{f}" fillId="{x}" borderId="0" xfId="0" applyAlignment="1"><alignment wrapText="1" vertical="top"/></xf>' for f, x in ((0, 0), (1, 2), (0, 0), (0, 3)))
    styles = f'{head}<styleSheet {main}><fonts count="2"><font/><font><b/></font></fonts><fills count="4">{fills}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="4">{xfs}</cellXfs></styleSheet>'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'{head}<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook {main} xmlns:r="{rel}"><sheets><sheet name="{escape(name)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": sheet,
        "xl/styles.xml": styles,
    }
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w", zipfile.ZIP_DEFLATED) as z:
        for k, v in parts.items():
            z.writestr(k, v)
    files.write(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate(), path, book.getvalue())


def _clean(value) -> str:
    """Text that XML can hold."""
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", "" if value is None else str(value))


def _table(spark: SparkSession, cells: list[list[str | None]]) -> DataFrame:
    header = [h or f"column_{k + 1}" for k, h in enumerate(cells[0])] if cells else []
    rows = [(n, *((c + [None] * len(header))[: len(header)])) for n, c in enumerate(cells[1:], 2)]
    return spark.createDataFrame(rows, "row_number int" + "".join(f", `{h}` string" for h in header))


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet: all columns as text, with ``row_number`` as the sheet numbers its rows."""
    return _table(spark, read_cells(path))


def read_sheets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All sheets by name."""
    return {name: _table(spark, cells) for name, cells in read_workbook(_data(path)).items()}


def read_entries_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON list in a file, or in several; an absent file is an empty table."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def pairs(df: DataFrame, question: list[str], answer: list[str], extra: list[str] = (), params: Params = DEFAULTS) -> DataFrame:
    """(row_number, question, answer, source_columns): rows with a question or an answer."""
    missing = [c for c in (*question, *answer) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    join = lambda names: X.join_parts(*(F.col(f"`{n}`") for n in names), separator=params.line_separator)
    there = [c for c in extra if c in df.columns]
    values = F.create_map(*(x for c in there for x in (F.lit(c), F.coalesce(X.strip(F.col(f"`{c}`")), F.lit(""))))) if there else F.create_map().cast("map<string,string>")
    rows = df.select("row_number", join(question).alias("question"), join(answer).alias("answer"), F.map_filter(values, lambda k, v: v != "").alias("source_columns"))
    return rows.where("question <> '' or answer <> ''")


def read_base(df: DataFrame) -> DataFrame:
    """Entries from a reviewer's view: blank questions or answers dropped, unknown columns as extras."""
    required = [CORE[c] for c in ("category", "question", "answer")]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    field = lambda k: X.strip(F.coalesce(F.col(f"`{CORE[k]}`"), F.lit(""))) if CORE[k] in df.columns else F.lit("")
    extras = [c for c in df.columns if c not in CORE.values() and c != "row_number"]
    values = F.create_map(*(x for c in extras for x in (F.lit(c), F.coalesce(X.strip(F.col(f"`{c}`")), F.lit(""))))) if extras else F.create_map().cast("map<string,string>")
    numbers = F.filter(F.transform(F.split(field("source_rows"), r"\|"), X.strip), lambda p: p.rlike("^[0-9]+$"))
    out = df.select(
        (F.col("row_number") - 2).cast("long").alias("ord"), field("category").alias("category"), field("question").alias("question"), field("answer").alias("answer"),
        field("source_file").alias("source_file"), F.transform(numbers, lambda p: p.cast("int")).alias("source_rows"),
        F.map_filter(values, lambda k, v: v != "").alias("source_columns"), field("updated_at").alias("updated_at"), F.nullif(field("doubtful"), F.lit("")).alias("doubtful"),
    )
    return out.where("question <> '' and answer <> ''")


def base_view(entries: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Rows of the reviewer's view, ordered by category and question; extras in first-seen order."""
    keys = [r.k for r in entries.select("category", "question", F.posexplode(F.map_keys("source_columns")).alias("p", "k")).groupBy("k").agg(F.min(F.struct("category", "question", "p")).alias("at")).orderBy("at").select("k").collect()]
    core = {"source_rows": F.array_join(F.transform("source_rows", lambda r: r.cast("string")), params.value_separator)}
    columns = [F.coalesce(core.get(k, F.col(k)), F.lit("")).alias(v) for k, v in CORE.items()]
    return entries.orderBy("category", "question").select(*columns, *(F.coalesce(F.try_element_at("source_columns", F.lit(k)), F.lit("")).alias(k) for k in keys))


def rejected_view(rejected: DataFrame) -> DataFrame:
    return rejected.orderBy("source_row").select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in REJECTED if c in rejected.columns))


def write_view(view: DataFrame, path: str, mark: str | None = "Doubtful") -> None:
    """The view as a workbook: one file, so its rows are on the driver; a view is what a reviewer reads."""
    names = view.columns
    at = names.index(mark) if mark in names else None
    rows = [list(r) for r in view.toLocalIterator()]
    write_cells(path, names, rows, [at is not None and bool(r[at]) for r in rows])
