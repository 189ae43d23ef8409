"""XLSX sheets as DataFrames (SRC-2, SRC-3), no spreadsheet library needed.

``spark.read.format("binaryFile")`` gives one row per workbook; a
``mapInPandas`` task unzips it and parses the sheet's XML with the
standard library, yielding one row per sheet row. A workbook cannot be
split, so one task handles one file; many files run in parallel. The XML is
pulled through the parser row by row and given on in frames of FRAME_ROWS, so what a
task holds is the packed workbook, its shared strings and one frame, whatever the number of rows.
Cells come out as text plus a type letter (``n`` number, ``s`` text,
``b`` boolean, ``d`` ISO date); typing happens afterwards in Spark.
"""

from __future__ import annotations

import io
import itertools
import sys
import zipfile
from array import array
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.sources.files import blank_to_null

# The task-side functions of this module use only the standard library,
# pandas and pyspark; shipping them by value means Python workers need no
# copy of this package (on a cluster it would otherwise go out with --py-files).
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
#: Rows of a frame that a task gives on.
FRAME_ROWS = 20_000
_RID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


_V, _IS, _T, _R = (f"{{{_NS['m']}}}{tag}" for tag in ("v", "is", "t", "r"))


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + (ord(ch.upper()) - 64)
    return n - 1


def _text(el) -> str:
    """Text of a string item: its own ``t`` and those of its rich-text runs; phonetic runs are not part of it."""
    inline = el.find(_IS)
    item = el if inline is None else inline
    return "".join(t.text or "" for t in [*item.findall(_T), *(t for run in item.findall(_R) for t in run.findall(_T))])


def _each(zf: zipfile.ZipFile, path: str, parent: str, tag: str):
    """The ``tag`` children of ``parent``, one at a time as the packed XML is read; each is gone once the next is asked for."""
    parent, tag, holder = (f"{{{_NS['m']}}}{parent}", f"{{{_NS['m']}}}{tag}", None)
    with zf.open(path) as stream:
        for event, el in ET.iterparse(stream, events=("start", "end")):
            if event == "start":
                if el.tag == parent:
                    holder = el
            elif el.tag == tag and holder is not None:
                yield el
                holder.clear()


class SharedStrings:
    """The workbook's strings by number: one buffer of UTF-8 and the place where each ends."""

    def __init__(self, zf: zipfile.ZipFile):
        self.buffer, self.ends = bytearray(), array("Q")
        if "xl/sharedStrings.xml" in zf.namelist():
            for si in _each(zf, "xl/sharedStrings.xml", "sst", "si"):
                self.buffer += _text(si).encode()
                self.ends.append(len(self.buffer))

    def __getitem__(self, i: int) -> str:
        if not 0 <= i < len(self.ends):
            raise ValueError(f"the workbook has no shared string {i}")
        return self.buffer[self.ends[i - 1] if i else 0:self.ends[i]].decode()


def _cells(row, ncols: int, shared: SharedStrings, number: str):
    vals, kinds = [None] * ncols, [None] * ncols
    for i, c in enumerate(row.iter(f"{{{_NS['m']}}}c")):
        j = _col_index(c.get("r")) if c.get("r") else i
        if j >= ncols:
            continue
        t = c.get("t", "n")
        v = c.find(_V)
        if t == "inlineStr":
            vals[j], kinds[j] = _text(c), "s"
        elif v is None or v.text is None:
            continue
        elif t == "s":
            vals[j], kinds[j] = shared[int(v.text)], "s"
        elif t in ("str", "e"):
            vals[j], kinds[j] = v.text, "s"
        elif t == "b":
            vals[j], kinds[j] = "TRUE" if v.text == "1" else "FALSE", "b"
        elif t == "d":
            vals[j], kinds[j] = v.text, "d"
        else:
            vals[j], kinds[j] = v.text, number
    return vals, kinds


def sheet_rows(data: bytes, sheet: str, ncols: int):
    """Yield (row_number, [text]*ncols, [type]*ncols) for every non-empty row of ``sheet``, as it is read."""
    zf = zipfile.ZipFile(io.BytesIO(data))
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    properties = wb.find("m:workbookPr", _NS)
    # day numbers of a workbook with the 1904 date system get a letter of their own
    number = "m" if properties is not None and properties.get("date1904") in ("1", "true") else "n"
    rid = None
    for s in wb.iter(f"{{{_NS['m']}}}sheet"):
        if s.get("name") == sheet:
            rid = s.get(_RID)
    if rid is None:
        raise ValueError(f"workbook has no sheet named {sheet!r}")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.iter(f"{{{_NS['rel']}}}Relationship")
                  if r.get("Id") == rid)
    target = target.lstrip("/")
    path = target if target.startswith("xl/") else "xl/" + target
    shared = SharedStrings(zf)
    for row in _each(zf, path, "sheetData", "row"):
        vals, kinds = _cells(row, ncols, shared, number)
        if any(x is not None for x in vals):
            yield int(row.get("r", 0)), vals, kinds


def _raw_schema(ncols: int) -> T.StructType:
    fields = [T.StructField("source_file", T.StringType()), T.StructField("row_number", T.IntegerType())]
    fields += [T.StructField(f"c{i}", T.StringType()) for i in range(ncols)]
    fields += [T.StructField(f"t{i}", T.StringType()) for i in range(ncols)]
    return T.StructType(fields)


def read_sheet(spark: SparkSession, paths, sheet: str, ncols: int, header: bool = True) -> DataFrame:
    """Raw cells of ``sheet`` of every workbook in ``paths`` (header row dropped)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    names = _raw_schema(ncols).fieldNames()

    def parse(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = sheet_rows(bytes(content), sheet, ncols)
                if header:
                    next(rows, None)
                while frame := [[path, rn, *vals, *kinds] for rn, vals, kinds in itertools.islice(rows, FRAME_ROWS)]:
                    yield pd.DataFrame(frame, columns=names)
    return files.mapInPandas(parse, _raw_schema(ncols))


def excel_time(value: str, kind: str):
    """A cell as a zone-free timestamp: Excel serial day numbers (days since
    1899-12-30, or since 1904-01-01 in a workbook that says so) or text such as ``2021-03-01`` / ``2021-03-01 10:11:12``."""
    serial = F.col(value).cast("double")
    from_serial = F.expr(
        f"timestampadd(MICROSECOND, cast(round(cast(`{value}` as double) * 86400000000) as bigint), "
        "TIMESTAMP_NTZ'1899-12-30 00:00:00')")
    days_1904 = F.expr("interval 1462 days")
    return (F.when(F.col(kind) == "n", F.when(serial.isNotNull(), from_serial))
            .when(F.col(kind) == "m", F.when(serial.isNotNull(), from_serial + days_1904))
            .otherwise(F.expr(f"try_cast(`{value}` as timestamp_ntz)")))


def read_terminals(spark: SparkSession, paths) -> DataFrame:
    """SRC-2: sheet ``terminals``: id, type, city, address (by position)."""
    raw = read_sheet(spark, paths, "terminals", 4)
    names = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]
    return raw.select(*[blank_to_null(f"c{i}").alias(n) for i, n in enumerate(names)])


def read_blacklist(spark: SparkSession, paths) -> DataFrame:
    """SRC-3: sheet ``blacklist``: entry date, passport number (by position)."""
    raw = read_sheet(spark, paths, "blacklist", 2)
    return raw.select(excel_time("c0", "t0").alias("entry_dt"),
                      blank_to_null("c1").alias("passport_num"))


# ---- writing (fixtures, tests, replays) ------------------------------------

def _esc(s: str) -> str:
    return (s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            .replace('"', "&quot;"))


def _col_name(j: int) -> str:
    s = ""
    j += 1
    while j:
        j, r = divmod(j - 1, 26)
        s = chr(65 + r) + s
    return s


def workbook_bytes(sheet: str, header: list[str], rows) -> bytes:
    """A minimal workbook with one sheet of inline strings and numbers."""
    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{ref}"><v>{v!r}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{_esc(str(v))}</t></is></c>'
    lines = []
    for i, r in enumerate([header, *rows], start=1):
        cells = "".join(cell(f"{_col_name(j)}{i}", v) for j, v in enumerate(r))
        lines.append(f'<row r="{i}">{cells}</row>')
    sheet_xml = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    wb = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
          f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
          f'<sheet name="{_esc(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
    wb_rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
               f'<Relationships xmlns="{_NS["rel"]}"><Relationship Id="rId1" '
               'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
               'Target="worksheets/sheet1.xml"/></Relationships>')
    rels = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<Relationships xmlns="{_NS["rel"]}"><Relationship Id="rId1" '
            'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
            'Target="xl/workbook.xml"/></Relationships>')
    types = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
             '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
             '<Default Extension="xml" ContentType="application/xml"/>'
             '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
             '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
             '</Types>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", types)
        z.writestr("_rels/.rels", rels)
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", wb_rels)
        z.writestr("xl/worksheets/sheet1.xml", sheet_xml)
    return buf.getvalue()


def write_sheets(df: DataFrame, folder: str, sheet: str, rows_per_book: int = 50_000) -> None:
    """Fixture writer: workbooks of at most ``rows_per_book`` rows each, added to ``folder``.

    A workbook is one value of Spark's text writer (bytes pass through it
    unchanged, readers of zip files ignore the line end after them), so any
    storage that Spark can write will do and a retried task leaves nothing behind.
    """
    header = df.columns

    def books(batches):
        rows = []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                rows.append([None if pd.isna(v) else v for v in r])
                if len(rows) == rows_per_book:
                    yield pd.DataFrame({"content": [workbook_bytes(sheet, header, rows)]})
                    rows = []
        if rows:
            yield pd.DataFrame({"content": [workbook_bytes(sheet, header, rows)]})

    (df.mapInPandas(books, "content binary").select(F.col("content").cast("string").alias("value"))
     .write.mode("append").option("maxRecordsPerFile", 1).text(folder))
