"""Workbooks (xlsx) in and out, by the public file format: zipped XML, no library needed.

A workbook is one small file, read whole by the task it falls to; many workbooks are read in parallel.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgrid.operators.tables import dense_ids

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: The most rows one sheet can have by the format.
SHEET_ROWS = 1_048_576


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def read_workbook(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row from 0, cells as text) of every row that has cells; empty cells are None."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(_LINK)]
            path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            count = 0
            for row in ElementTree.fromstring(z.read(path)).iter(f"{_MAIN}row"):
                at = int(row.get("r", count + 1)) - 1
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    place = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (place + 1 - len(cells))
                    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        cells[place] = _text(cell)
                    elif value is not None and value.text is not None:
                        cells[place] = shared[int(value.text)] if kind == "s" else value.text
                count = at + 1
                if cells:
                    yield sheet.get("name"), at, cells


def write_workbook(sheets: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """The bytes of a workbook of ``name -> (header, rows)``; texts are inline, numbers are numbers, None is no cell."""

    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(v)))}</t></is></c>'
        return f"<c><v>{v}</v></c>"

    names = list(sheets)
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        links = "".join(f'<Relationship Id="rId{k}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        listed = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        for k, (header, rows) in enumerate(sheets.values(), 1):
            if len(rows) >= SHEET_ROWS:
                raise ValueError(f"a sheet holds {SHEET_ROWS} rows with its header; write CSV or Parquet, or more sheets")
            body = "".join(f'<row>{"".join(map(cell, r))}</row>' for r in [tuple(header), *rows])
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'{head}<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def sheet_rows(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(file, sheet, row, cells) of all rows of all workbooks at ``path``; ``sheet`` keeps one sheet."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [r for r in read_workbook(data) if sheet is None or r[0] == sheet]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.string()))], names=["file", "sheet", "row", "cells"])

    return files.mapInArrow(run, "file string, sheet string, row long, cells array<string>")


def read_companies(spark: SparkSession, path: str, sheet: str | None = None, hints: tuple[str, ...] = ("client_name", "company", "name")) -> DataFrame:
    """(idx, company): the distinct trimmed names of all sheets, sorted.

    A sheet's names are in the first column whose header holds one of ``hints``; sheets without one are left out.
    """
    rows = sheet_rows(spark, path, sheet)
    headers = rows.groupBy("file", "sheet").agg(F.min_by("cells", "row").alias("header"), F.min("row").alias("first"))
    fits = F.array_position(F.transform("header", lambda h: F.exists(F.array(*map(F.lit, hints)), lambda x: F.contains(F.lower(h), x))), True)
    at = headers.select("file", "sheet", "first", fits.cast("int").alias("at")).filter("at > 0")
    names = rows.join(at, ["file", "sheet"]).filter("row > first").select(F.trim(F.get("cells", F.col("at") - 1)).alias("company"))
    return dense_ids(names.filter("company <> ''"), "company", "idx")


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """One sheet of one workbook (by default the first) as a table of texts under its header."""
    rows = sheet_rows(spark, path)
    first = rows.filter(F.col("sheet") == sheet) if sheet is not None else rows
    head = first.limit(1).collect()
    if not head:
        raise ValueError(f"no sheet {sheet or ''} in {path}")
    kept = rows.filter((F.col("sheet") == head[0].sheet) & (F.col("row") > head[0].row))
    return kept.select(*[F.get("cells", F.lit(k)).alias(h or f"column_{k + 1}") for k, h in enumerate(head[0].cells)])


def write_sheets(tables: dict[str, DataFrame], path: str) -> None:
    """A workbook of report tables, one a sheet. A sheet holds at most ``SHEET_ROWS`` rows, so the driver's part is bounded."""
    sheets = {}
    for name, df in tables.items():
        rows = df.limit(SHEET_ROWS).collect()
        sheets[name] = (df.columns, [tuple(str(v) if isinstance(v, (list, dict)) else v for v in r) for r in rows])
    data = write_workbook(sheets)
    spark = next(iter(tables.values())).sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(data))
    stream.close()
