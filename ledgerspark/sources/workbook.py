"""SRC4 ``workbook``: a Spark Python data source for ``.xlsx`` files.

``spark.read.format("workbook").option("skipRows", 8).load(path)`` reads the
first sheet of every workbook under ``path``: one input partition per file,
all cells as text, the header being the first row with a cell after ``skipRows``
sheet rows (blank rows count). Blank rows between data rows are rows of nulls.
Workbooks may differ in their headers: each file's columns are found by its own
header, and the columns are those asked for, or the union over all files.
Paths may be local or any scheme ``pyarrow.fs`` opens (``hdfs://``, ``s3a://`` …).
Each output row also carries ``_file`` and ``_row`` (sheet row number), the
exact "file order" key. Predicates given to ``read_workbooks`` are decided while a sheet is parsed, and files that ``_file`` rules out
are not opened. They are given by name, since Spark 4.1 keeps the filters it pushes into a Python source for later
queries of the same DataFrame, which then lack rows. Cells are decoded the way a spreadsheet reader shows
them: shared/inline strings as text, booleans as ``True``/``False``, integral
numbers without a decimal point, numbers in a date format as
``yyyy-MM-dd HH:mm:ss``. Only the standard library is used (``zipfile`` and
an incremental XML parse), so no extra package is needed on the executors.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import islice
from xml.etree.ElementTree import iterparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

# SpreadsheetML namespaces, built-in date formats, epoch.
NS_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
NS_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
NS_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
BUILTIN_DATE_FORMATS = set(range(14, 23)) | set(range(45, 48))
EXCEL_EPOCH = dt.datetime(1899, 12, 30)
SOURCE_NAME = "workbook"


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", code)
    return re.search(r"[dmyhs]", code, re.IGNORECASE) is not None


def _serial_to_text(value: float) -> str:
    if value < 60:  # the spreadsheet epoch counts a 29 Feb 1900 that never existed
        value += 1
    t = EXCEL_EPOCH + dt.timedelta(days=value)
    t = t.replace(microsecond=0) + dt.timedelta(seconds=round(t.microsecond / 1e6))
    return t.strftime("%Y-%m-%d %H:%M:%S")


def _number_text(v: str) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    if f.is_integer() and abs(f) < 1e16:
        return str(int(f))
    return repr(f)


class _Book:
    """Lazy access to the parts of one workbook needed for its first sheet."""

    def __init__(self, zf: zipfile.ZipFile):
        self.zf = zf
        names = set(zf.namelist())
        self.strings = self._shared_strings() if "xl/sharedStrings.xml" in names else []
        self.date_styles = self._date_styles() if "xl/styles.xml" in names else set()
        self.sheet = self._first_sheet()

    def _shared_strings(self) -> list[str]:
        out = []
        with self.zf.open("xl/sharedStrings.xml") as f:
            for _, el in iterparse(f):
                if el.tag == NS_MAIN + "si":
                    out.append("".join(t.text or "" for t in el.iter(NS_MAIN + "t")
                                       if not _inside_phonetic(el, t)))
                    el.clear()
        return out

    def _date_styles(self) -> set[int]:
        custom, xfs = {}, []
        with self.zf.open("xl/styles.xml") as f:
            in_cell_xfs = False
            for ev, el in iterparse(f, events=("start", "end")):
                if el.tag == NS_MAIN + "numFmt" and ev == "end":
                    custom[int(el.get("numFmtId"))] = el.get("formatCode", "")
                elif el.tag == NS_MAIN + "cellXfs":
                    in_cell_xfs = ev == "start"
                elif el.tag == NS_MAIN + "xf" and ev == "end" and in_cell_xfs:
                    xfs.append(int(el.get("numFmtId", "0")))
        return {i for i, fmt_id in enumerate(xfs)
                if fmt_id in BUILTIN_DATE_FORMATS or (fmt_id in custom and _is_date_format(custom[fmt_id]))}

    def _first_sheet(self) -> str:
        with self.zf.open("xl/workbook.xml") as f:
            first = next((el for _, el in iterparse(f) if el.tag == NS_MAIN + "sheet"), None)
        if first is None:
            return "xl/worksheets/sheet1.xml"
        rid = first.get(NS_REL + "id")
        with self.zf.open("xl/_rels/workbook.xml.rels") as f:
            for _, el in iterparse(f):
                if el.tag == NS_PKG_REL + "Relationship" and el.get("Id") == rid:
                    target = el.get("Target")
                    return target.lstrip("/") if target.startswith("/") else posixpath.normpath(
                        posixpath.join("xl", target))
        return "xl/worksheets/sheet1.xml"

    def rows(self) -> Iterator[tuple[int, list[str | None]]]:
        """(sheet row number, cell texts) for every row that has a cell."""
        with self.zf.open(self.sheet) as f:
            next_row = 1
            for _, el in iterparse(f):
                if el.tag != NS_MAIN + "row":
                    continue
                r = int(el.get("r", next_row))
                next_row = r + 1
                cells: dict[int, str | None] = {}
                pos = 0
                for c in el.iter(NS_MAIN + "c"):
                    ref = c.get("r")
                    pos = _col_index(ref) if ref else pos
                    cells[pos] = self._cell(c)
                    pos += 1
                el.clear()
                if cells:
                    yield r, [cells.get(i) for i in range(max(cells) + 1)]

    def _cell(self, c) -> str | None:
        t = c.get("t", "n")
        v = c.find(NS_MAIN + "v")
        if t == "inlineStr":
            return "".join(x.text or "" for x in c.iter(NS_MAIN + "t"))
        if v is None or v.text is None:
            return None
        if t == "s":
            return self.strings[int(v.text)]
        if t == "b":
            return "True" if v.text.strip() == "1" else "False"
        if t in ("str", "e", "d"):
            return v.text
        if int(c.get("s", "0")) in self.date_styles:
            try:
                return _serial_to_text(float(v.text))
            except ValueError:
                return v.text
        return _number_text(v.text)


def _inside_phonetic(si, t) -> bool:
    for ph in si.iter(NS_MAIN + "rPh"):
        if any(x is t for x in ph.iter()):
            return True
    return False


def _workbook_paths(path: str) -> list[str]:
    from ledgerspark.sources.files import list_paths

    return list_paths(path, ".xlsx")


def _open_zip(path: str) -> zipfile.ZipFile:
    from ledgerspark.sources.files import open_input

    return zipfile.ZipFile(open_input(path))


def read_header(path: str, skip_rows: int = 0) -> list[str]:
    """The cells of the first row with a cell after ``skip_rows`` sheet rows."""
    with _open_zip(path) as zf:
        return next((["" if c is None else c for c in cells] for r, cells in _Book(zf).rows() if r > skip_rows), [])


def _positions(header: list[str | None], aliases: dict[str, str] | None) -> dict[str, int]:
    """Column name -> position in this file: resolved by ``aliases``, else the header's own names."""
    from ledgerspark.sources import headers as H

    if aliases is None:
        return {n: i for i, n in enumerate(H.dedup_headers(header))}
    names, keep = H.resolve_header(header, aliases)
    return dict(zip(names, keep, strict=True))


class _FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


BATCH_ROWS = 4096

# A predicate is (column, operator, value). A null cell passes "is null" only. Texts compare by code point, as Spark's do.
OPERATORS: dict[str, tuple[Callable, Callable]] = {  # on a cell that is not null, and on a column
    "=": (lambda cell, v: cell == v, lambda c, v: c == v),
    "<>": (lambda cell, v: cell != v, lambda c, v: c != v),
    "<": (lambda cell, v: cell < v, lambda c, v: c < v),
    "<=": (lambda cell, v: cell <= v, lambda c, v: c <= v),
    ">": (lambda cell, v: cell > v, lambda c, v: c > v),
    ">=": (lambda cell, v: cell >= v, lambda c, v: c >= v),
    "in": (lambda cell, v: cell in v, lambda c, v: c.isin(*v)),
    "not in": (lambda cell, v: cell not in v, lambda c, v: ~c.isin(*v) if v else c.isNotNull()),
    "starts with": (lambda cell, v: cell.startswith(v), lambda c, v: c.startswith(v)),
    "ends with": (lambda cell, v: cell.endswith(v), lambda c, v: c.endswith(v)),
    "contains": (lambda cell, v: v in cell, lambda c, v: c.contains(v)),
    "is null": (lambda cell, v: False, lambda c, v: c.isNull()),
    "is not null": (lambda cell, v: True, lambda c, v: c.isNotNull()),
}
Predicate = tuple[str, str, object]


def condition(where: Iterable[Predicate]) -> Column:
    """The predicates as one condition, for rows of other sources."""
    return reduce(lambda a, b: a & b, [OPERATORS[op][1](F.col(f"`{c}`"), v) for c, op, v in where], F.lit(True))


def _checked(where: Iterable[Predicate], names: Iterable[str]) -> list[Predicate]:
    names, where = set(names), [tuple(p) for p in where]
    for column, op, value in where:
        kind = int if column == "_row" else str
        values = value if op in ("in", "not in") else [] if op in ("is null", "is not null") else [value]
        if op not in OPERATORS or column not in names or not all(type(v) is kind for v in values):
            raise ValueError(f"not a predicate on these workbooks: {column} {op} {value!r}")
    return where


class WorkbookReader(DataSourceReader):
    def __init__(self, paths: list[str], skip_rows: int, names: list[str], aliases: dict[str, str] | None,
                 null_tokens: list[str], where: list[Predicate]):
        self.paths, self.skip_rows, self.names, self.aliases = paths, skip_rows, names, aliases
        self.null_tokens = frozenset(null_tokens)
        self.where = _checked(where, [*names, "_file", "_row"])

    def partitions(self):
        files = [p for p in self.where if p[0] == "_file"]
        return [_FilePartition(p) for p in self.paths if self._fits((p,), files, {"_file": 0})]

    @staticmethod
    def _fits(row: tuple, where: list[Predicate], place: dict[str, int]) -> bool:
        for column, op, value in where:
            cell = row[place[column]]
            if not (op == "is null" if cell is None else OPERATORS[op][0](cell, value)):
                return False
        return True

    def _kept(self, path: str) -> Iterator[tuple]:
        place = {n: k for k, n in enumerate([*self.names, "_file", "_row"])}
        return (row for row in self._rows(path) if self._fits(row, self.where, place))

    def _rows(self, path: str) -> Iterator[tuple]:
        with _open_zip(path) as zf:
            positions, last = None, 0
            for r, cells in _Book(zf).rows():
                if r <= self.skip_rows:
                    continue
                if positions is None:
                    index = _positions(cells, self.aliases)
                    positions = [index.get(n) for n in self.names]
                else:
                    for blank in range(last + 1, r):
                        yield (*[None] * len(positions), path, blank)
                    found = [cells[j] if j is not None and j < len(cells) else None for j in positions]
                    yield (*[None if c in self.null_tokens else c for c in found], path, r)
                last = r

    def read(self, partition):
        import pyarrow as pa

        kinds = pa.schema([*[(n, pa.string()) for n in self.names], ("_file", pa.string()), ("_row", pa.int64())])
        rows = iter(()) if partition is None else self._kept(partition.path)  # Spark makes one of none
        while batch := list(islice(rows, BATCH_ROWS)):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*batch, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)


class WorkbookDataSource(DataSource):
    """Options: ``skipRows`` (sheet rows before the header, default 0), ``aliases``, ``columns``, ``nullTokens`` and ``where`` (JSON)."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def _paths(self) -> list[str]:
        return _workbook_paths(self.options.get("path", ""))

    def _skip(self) -> int:
        return int(self.options.get("skipRows", self.options.get("skiprows", "0")))

    def _aliases(self) -> dict[str, str] | None:
        return json.loads(self.options["aliases"]) if "aliases" in self.options else None

    def schema(self):
        if "columns" in self.options:
            names = json.loads(self.options["columns"])
        else:
            found = [_positions(read_header(p, self._skip()), self._aliases()) for p in self._paths()]
            names = list(dict.fromkeys(n for f in found for n in f))
        return StructType([StructField(n, StringType()) for n in names]
                          + [StructField("_file", StringType()), StructField("_row", LongType())])

    def reader(self, schema: StructType):
        names = [f.name for f in schema.fields if f.name not in ("_file", "_row")]
        return WorkbookReader(self._paths(), self._skip(), names, self._aliases(),
                              json.loads(self.options.get("nullTokens", "[]")), json.loads(self.options.get("where", "[]")))


def register(spark: SparkSession) -> None:
    from ledgerspark.session import ship_package

    ship_package(spark)
    spark.dataSource.register(WorkbookDataSource)


def read_workbooks(spark: SparkSession, path: str, skip_rows: int = 0, columns: list[str] | None = None,
                   aliases: dict[str, str] | None = None, null_tokens: Iterable[str] = (),
                   where: Iterable[Predicate] = ()) -> DataFrame:
    """All workbooks under ``path`` (first sheet, header after ``skip_rows`` sheet rows).

    With ``aliases`` each file's header is resolved to canonical names on the executor that reads it;
    with ``columns`` no header is read on the driver. Cells that are one of ``null_tokens`` are null.
    Only rows that fit all predicates in ``where`` (``OPERATORS``) leave the source.
    """
    register(spark)
    reader = spark.read.format(SOURCE_NAME).option("skipRows", skip_rows).option("nullTokens", json.dumps(list(null_tokens)))
    reader = reader.option("where", json.dumps([list(p) for p in where]))
    if columns is not None:
        reader = reader.option("columns", json.dumps(columns))
    if aliases is not None:
        reader = reader.option("aliases", json.dumps(aliases))
    return reader.load(path)


# ---------------------------------------------------------------- writer (one workbook per partition)

_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/styles.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>')
_ROOT_RELS = (
    '<?xml version="1.0" encoding="UTF-8"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
    'officeDocument" Target="xl/workbook.xml"/></Relationships>')
_WORKBOOK = (
    '<?xml version="1.0" encoding="UTF-8"?>'
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>')
_WORKBOOK_RELS = (
    '<?xml version="1.0" encoding="UTF-8"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
    'worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8"?>'
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    '<numFmts count="1"><numFmt numFmtId="164" formatCode="dd/mm/yyyy hh:mm:ss"/></numFmts>'
    '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>')
WRITE_SCHEMA = "path string, rows bigint"
MAX_SHEET_ROWS = 1 << 20  # fixed value: what a sheet can hold


def _xml_text(v: str) -> str:
    v = "".join(ch for ch in v if ch in "\t\n\r" or ord(ch) >= 0x20)
    return v.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _cell_xml(col: int, row: int, v) -> str:
    ref = f"{_col_letters(col)}{row}"
    if v is None or (isinstance(v, float) and v != v):
        return ""
    if isinstance(v, (dt.datetime,)) or hasattr(v, "to_pydatetime"):
        t = v.to_pydatetime() if hasattr(v, "to_pydatetime") else v
        serial = (t.replace(microsecond=0) - EXCEL_EPOCH).total_seconds() / 86400.0
        return f'<c r="{ref}" s="1"><v>{serial!r}</v></c>'
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)) or type(v).__module__ == "numpy":
        return f'<c r="{ref}"><v>{v}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_xml_text(str(v))}</t></is></c>'


def _col_letters(i: int) -> str:
    s, i = "", i + 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_workbooks(df: DataFrame, folder: str, preamble: list[list[str]] | None = None,
                    sheet_name: str = "Plan1") -> DataFrame:
    """Write each partition of ``df`` as one workbook ``part-NNNNN.xlsx`` under ``folder``.

    Runs on the executors (``mapInPandas``), streaming the sheet XML into the
    archive, so no partition is ever collected on the driver. The header row is
    the column names, preceded by ``preamble`` rows. Timestamps are stored as
    spreadsheet date serials with second precision. Returns ``(path, rows)``
    per workbook; ``folder`` may be local or any ``pyarrow.fs`` scheme and must hold no
    workbook yet, so that two results never mix. A partition that a sheet cannot hold fails.
    """
    from ledgerspark.session import ship_package
    from ledgerspark.sources.landing import list_landing

    if not list_landing(df.sparkSession, folder, glob="*.xlsx").isEmpty():
        raise FileExistsError(f"{folder} already holds workbooks")
    ship_package(df.sparkSession)
    names = list(df.columns)
    pre = [list(r) for r in (preamble or [])]
    target = folder.rstrip("/")

    def write(batches):
        from pyspark import TaskContext

        import pandas as pd

        from ledgerspark.sources.files import move, open_output

        ctx = TaskContext.get()
        path = f"{target}/part-{ctx.partitionId():05d}.xlsx"
        # Each attempt writes its own file and moves it into place when complete, so a
        # retried or speculative attempt never leaves a half-written workbook behind.
        attempt_path = f"{path}.attempt-{ctx.taskAttemptId()}"
        n = 0
        with open_output(attempt_path) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("[Content_Types].xml", _CONTENT_TYPES)
            zf.writestr("_rels/.rels", _ROOT_RELS)
            zf.writestr("xl/workbook.xml", _WORKBOOK.format(name=_xml_text(sheet_name)))
            zf.writestr("xl/_rels/workbook.xml.rels", _WORKBOOK_RELS)
            zf.writestr("xl/styles.xml", _STYLES)
            with zf.open("xl/worksheets/sheet1.xml", "w") as out:
                out.write(b'<?xml version="1.0" encoding="UTF-8"?><worksheet '
                          b'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                r = 0
                for row in [*pre, names]:
                    r += 1
                    cells = "".join(_cell_xml(j, r, v) for j, v in enumerate(row))
                    out.write(f'<row r="{r}">{cells}</row>'.encode())
                for pdf in batches:
                    for values in pdf.itertuples(index=False, name=None):
                        r += 1
                        n += 1
                        if r > MAX_SHEET_ROWS:
                            raise ValueError(f"more than {MAX_SHEET_ROWS} rows in a partition: use more partitions")
                        cells = "".join(_cell_xml(j, r, v) for j, v in enumerate(values))
                        out.write(f'<row r="{r}">{cells}</row>'.encode())
                out.write(b"</sheetData></worksheet>")
        move(attempt_path, path)
        yield pd.DataFrame({"path": [path], "rows": [n]})

    return df.mapInPandas(write, WRITE_SCHEMA)
