"""Ledger scans from landed files (SRC1-SRC3, SRC5-SRC8).

Files are scanned as text only (every column STRING, so ``01234567890`` keeps
its zero). A CSV file's header is its first record; headers are resolved once
per distinct raw header (a *signature*, see ``headers.resolve_header``), and all
files of one signature are read by a single CSV scan, renamed positionally and
unioned by name with the other signatures. Headers are grouped by signature on the
executors; the driver gets one row per signature, with the paths its scan needs.

Files are split like any text. A file with records that span lines (a quoted line break) is
split too: ``records`` finds the record limits of all splits in parallel. Which files
those are takes one scan of the text more; ``multi_line=False`` leaves it out and fails on a quote left open at a
line end, ``multi_line=True`` reads every file whole, by one task. A record wider than its
header fails the scan; shorter records end in nulls.

Order key for "first row" semantics (S6): ``(source_rank, file path, file block
start, row position)``; the position comes from ``monotonically_increasing_id``
and is only ever compared inside one file block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions.dates import parse_movement_timestamp
from ledgerspark.functions.keys import as_text
from ledgerspark.sources import headers as H
from ledgerspark.sources import records
from ledgerspark.sources.landing import landing_filter, list_files, list_landing

# The five status exports, in the order they are concatenated.
STATUS_FILES = [
    (1, "Ativas", "Ativas.csv"),
    (2, "Baixadas", "Baixadas.csv"),
    (3, "Pendentes", "Pendentes.csv"),
    (4, "Determinacao", "Determinacao.csv"),
    (5, "Erros", "Erros.csv"),
]
MOVEMENTS_FILE = "Relatorio_CNM.xlsx"
REGISTRY_FILE = "Relatorio_SGP.xlsx"
REGISTRY_PREAMBLE_ROWS = 8
# Header spellings of the movement register and the registry.
MOVEMENT_ALIASES = {"Id": "id", "Documento": "documento", "Tipo": "tipo", "Data / Hora": "data_hora"}
REGISTRY_ALIASES = {"CPF/CNPJ": "cpf_cnpj", "Nome/Razão Social": "nome"}
# Text that pandas' CSV reader treats as missing by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
EXPORT_SCHEMA = "documento string, devedor string, data string, fonte string, unique_id string"
BAD_RECORD = "_bad"


class MissingSourceError(FileNotFoundError):
    """SRC7: a required ledger file is absent."""


def _string_schema(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n)])


def _csv(spark: SparkSession, n: int, multi_line: bool):
    schema = _string_schema(n).add(BAD_RECORD, T.StringType())
    return (spark.read.format("csv").schema(schema).option("header", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD).option("encoding", "UTF-8")
            .option("columnPruning", False))  # a pruned parse would not count the cells of a record


def _well_formed(n: int, path: Column, whole: bool = False) -> Column:
    """True, or an error for a record with more than ``n`` cells or, unless records are known to be ``whole``, an open quote.

    Records of another width than the header arrive with their raw text; those are looked at only.
    """
    raw = F.col(BAD_RECORD)
    quotes = F.length(raw) - F.length(F.replace(raw, F.lit('"'), F.lit("")))
    unquoted = F.regexp_replace(raw, '"(?:[^"]|"")*"', "")
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    # the first cell is named too: Spark refuses queries that read nothing but the raw text of odd records
    where = F.concat(F.lit(" in "), path, F.lit(": "), raw,
                     F.coalesce(F.substring(F.col("_c0"), 1, 0), F.lit("")))
    open_quote = F.raise_error(F.concat(F.lit("quote left open at the line end (read with multi_line=True)"), where))
    wide = F.raise_error(F.concat(F.lit(f"more than the header's {n} cells"), where))
    wide_only = F.when(commas >= n, wide).otherwise(F.lit(True))
    return wide_only if whole else F.when(quotes % 2 == 1, open_quote).otherwise(wide_only)


def _records_csv(spark: SparkSession, files: list[str], n: int) -> DataFrame:
    """The cells of files whose records may span lines, with ``_file, _block, _pos``."""
    listing = spark.read.format("binaryFile").load(files).select("path", "length")
    schema = _string_schema(n).add(BAD_RECORD, T.StringType())
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD, "multiLine": "true"}
    cells = records.records(listing).select("path", "block", "pos", F.from_csv("value", schema.toDDL(), options).alias("_r"))
    return cells.select("_r.*", F.col("path").alias("_file"), F.col("block").alias("_block"), F.col("pos").alias("_pos"))


def null_tokens(c: Column, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """S17: missing-value tokens become null (Spark's ``nullValue`` takes one token only)."""
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def _open_binary(path: str):
    """Open a listed path for reading (see ``files.open_input``)."""
    from ledgerspark.sources.files import open_input

    return open_input(path)


def first_csv_record(path: str) -> list[str]:
    """The first CSV record of a file that is not blank; no more of the file is read than that takes."""
    import csv
    import io

    with _open_binary(path) as f:
        lines = io.TextIOWrapper(f, encoding="utf-8-sig", errors="replace", newline="")
        return next((row for row in csv.reader(lines) if any(cell.strip() for cell in row)), [])


def _header_batches(batches):
    import pandas as pd

    for pdf in batches:
        yield pd.DataFrame({"path": pdf["path"], "header": [first_csv_record(p) for p in pdf["path"]]})


def header_signatures(listing: DataFrame) -> DataFrame:
    """``header, paths``: the distinct first records of the listed CSV files and the files of each.

    Read in parallel from the head of each file; grouped before anything reaches the driver.
    """
    from ledgerspark.session import ship_package

    ship_package(listing.sparkSession)
    heads = listing.select("path").mapInPandas(_header_batches, "path string, header array<string>")
    return heads.groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files per raw header, from the given paths."""
    if not paths:
        return {}
    n = max(1, min(len(paths), spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(n)
    return {tuple(r.header): list(r.paths) for r in header_signatures(listed).collect()}


def scan_csv(spark: SparkSession, paths: list[str], aliases: dict[str, str] = H.ALL_ALIASES,
             tags: dict[str, tuple] | None = None, multi_line: bool | None = None) -> DataFrame | None:
    """SRC3 + SCH1-SCH5 over many CSV files whose headers may differ.

    Files are grouped by ``(tag, raw header)``; each group is one CSV scan whose
    columns are renamed positionally, and the groups are unioned by name.
    ``tags`` optionally maps a path to extra constant columns ``((name, value), ...)``.
    Output: the resolved columns, the tag columns, and ``_file``, ``_block``,
    ``_pos`` (order-key parts).
    """
    if not paths:
        return None
    open_lines = records.files_with_open_lines(spark, paths) if multi_line is None else set()
    groups: dict[tuple, list[str]] = {}
    for raw, files in csv_headers(spark, paths).items():
        for path in files:
            spans = records.same_file(path, open_lines)
            groups.setdefault(((tags or {}).get(path, ()), raw, spans), []).append(path)
    parts = []
    for (tag, raw, spans), files in sorted(groups.items(), key=lambda kv: min(kv[1])):
        names, keep = H.resolve_header(list(raw), aliases)
        n = max(len(raw), 1)
        if spans:
            df = _records_csv(spark, sorted(files), n).where(_well_formed(n, F.col("_file"), whole=True))
        else:
            df = _csv(spark, n, bool(multi_line)).load(sorted(files)).where(_well_formed(n, F.col("_metadata.file_path")))
            df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                           F.monotonically_increasing_id().alias("_pos"))
        cols = [null_tokens(F.col(f"_c{i}")).alias(name) for name, i in zip(names, keep)]
        consts = [F.lit(v).alias(k) for k, v in tag]
        parts.append(df.select(*cols, *consts, "_file", "_block", "_pos"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def status_source_map(spark: SparkSession, files=STATUS_FILES) -> DataFrame:
    """SRC5: the ordered map status -> file as a small literal relation."""
    return spark.createDataFrame(list(files), "source_rank int, fonte string, file string")


def missing_sources(spark: SparkSession, folder: str, files=STATUS_FILES) -> DataFrame:
    """SRC6 as a relation: entries of the status map with no landed CSV under ``folder``.

    The listing's top-level names (a file or a folder of parts) are anti-joined
    with the 5-row map, so the warning list comes from the same listing the scan uses.
    """
    import re

    base = folder.split(":", 1)[-1].rstrip("/")
    while base.startswith("//"):
        base = base[1:]
    listing = landing_filter(list_landing(spark, folder), suffixes=(".csv",))
    top = F.regexp_extract(F.col("path"), re.escape(base) + r"/([^/]+)", 1)
    landed = listing.select(top.alias("file")).distinct()
    return status_source_map(spark, files).join(landed, "file", "left_anti").orderBy("source_rank")


def empty_exports(spark: SparkSession) -> DataFrame:
    """SRC8: no status file at all -> an empty table with the export columns."""
    return spark.createDataFrame([], EXPORT_SCHEMA)


def _status_of(path: str, folder: str, files) -> tuple | None:
    rel = path.split(folder.rstrip("/").split(":")[-1].rstrip("/") + "/", 1)[-1]
    top = rel.split("/", 1)[0]
    for rank, fonte, name in files:
        if top == name:
            return (("fonte", fonte), ("source_rank", rank))
    return None


def scan_status_exports(spark: SparkSession, folder: str, files=STATUS_FILES,
                        aliases: dict[str, str] = H.ALL_ALIASES,
                        multi_line: bool | None = None) -> tuple[DataFrame, list[str]]:
    """SRC3/SRC5/SRC6/UN1: all present status files as one canonical export ledger.

    A status "file" may be a single CSV or a folder of CSV parts (as Spark
    writes them). One listing and one header job cover all of them. Missing
    statuses are skipped and returned as the second element (SRC6). Output:
    ``documento, devedor, unique_id, data, fonte, source_rank, ord`` with
    ``ord = (file, block, position)``.
    """
    tags = {}
    for path in list_files(spark, folder, suffix=".csv"):
        t = _status_of(path, folder, files)
        if t is not None:
            tags[path] = t
    present = {dict(t)["fonte"] for t in tags.values()}
    missing = [name for _, fonte, name in files if fonte not in present]
    union = scan_csv(spark, sorted(tags), aliases, tags=tags, multi_line=multi_line)
    if union is None:
        out = empty_exports(spark).withColumn("source_rank", F.lit(None).cast("int"))
        out = out.withColumn("ord", F.struct(F.lit(None).cast("string").alias("file"),
                                             F.lit(None).cast("bigint").alias("block"),
                                             F.lit(None).cast("bigint").alias("pos")))
        return out.select("documento", "devedor", "unique_id", "data", "fonte", "source_rank", "ord"), missing
    for c in ("documento", "devedor", "unique_id", "data"):
        if c not in union.columns:
            union = union.withColumn(c, F.lit(None).cast("string"))
    ord_ = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_pos").alias("pos"))
    return union.select("documento", "devedor", "unique_id", "data", "fonte", "source_rank",
                        ord_.alias("ord")), missing


def _table_scan(spark: SparkSession, path: str, fmt: str, skip_rows: int, aliases: dict[str, str],
                multi_line: bool | None = None, where: Sequence = ()) -> DataFrame:
    if skip_rows and fmt != "workbook":
        raise ValueError(f"preamble rows are a workbook feature; {fmt} has no skip_rows")
    if fmt == "workbook":
        from ledgerspark.sources.workbook import read_workbooks

        wanted = list(dict.fromkeys(aliases.values()))
        df = read_workbooks(spark, path, skip_rows=skip_rows, columns=wanted, aliases=aliases, null_tokens=NA_TOKENS, where=where)
        return df.select(*wanted, F.struct(F.col("_file").alias("file"), F.col("_row").alias("row")).alias("ord"))
    if fmt == "csv":
        df = scan_csv(spark, list_files(spark, path, suffix=".csv"), aliases, multi_line=multi_line)
        if df is None:
            raise MissingSourceError(path)
        ord_ = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_pos").alias("pos"))
        return df.withColumn("ord", ord_).drop("_file", "_block", "_pos")
    if fmt == "parquet":
        df = spark.read.parquet(path)
        names, keep = H.resolve_header(df.columns, aliases)
        fields = [df.schema.fields[i] for i in keep]
        # typed columns are rendered before anything looks at them as text: a float key keeps its digits
        return df.select(*[as_text(F.col(f"`{f.name}`"), f.dataType).alias(n) for n, f in zip(names, fields)],
                         F.struct(F.col("_metadata.file_path").alias("file"),
                                  F.col("_metadata.row_index").alias("row")).alias("ord"))
    raise ValueError(f"unsupported format {fmt!r}")


def require(spark: SparkSession, path: str) -> str:
    """SRC7: abort before planning when a required ledger is absent."""
    if landing_filter(list_landing(spark, path), suffixes=None).isEmpty():
        raise MissingSourceError(f"required ledger not found: {path}")
    return path


def _with_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("string") for c in names if c not in df.columns})


def _fitting(df: DataFrame, fmt: str, where: Sequence) -> DataFrame:
    from ledgerspark.sources.workbook import condition

    return df if fmt == "workbook" or not where else df.where(condition(where))


def scan_movements(spark: SparkSession, path: str, fmt: str = "workbook", multi_line: bool | None = None,
                   where: Sequence = ()) -> DataFrame:
    """SRC1: movement register -> ``id, documento, tipo, data_hora, ord`` (data_hora parsed).

    ``where`` holds predicates on the texts of the cells (``workbook.OPERATORS``), which workbooks are parsed under.
    """
    df = _with_columns(_table_scan(spark, require(spark, path), fmt, 0, MOVEMENT_ALIASES, multi_line, where),
                       ("id", "documento", "tipo", "data_hora"))
    df = _fitting(df, fmt, where)
    return df.select("id", "documento", "tipo", parse_movement_timestamp(F.col("data_hora")).alias("data_hora"),
                     "ord")


def scan_registry(spark: SparkSession, path: str, fmt: str = "workbook", skip_rows: int | None = None,
                  multi_line: bool | None = None, where: Sequence = ()) -> DataFrame:
    """SRC2: customer registry -> ``cpf_cnpj, nome, ord``.

    A workbook's header follows ``skip_rows`` preamble rows (sheet rows, blank ones count;
    ``REGISTRY_PREAMBLE_ROWS`` unless given); other formats have no preamble. ``where`` as for the movements.
    """
    skip = (REGISTRY_PREAMBLE_ROWS if fmt == "workbook" else 0) if skip_rows is None else skip_rows
    df = _with_columns(_table_scan(spark, require(spark, path), fmt, skip, REGISTRY_ALIASES, multi_line, where),
                       ("cpf_cnpj", "nome"))
    df = _fitting(df, fmt, where)
    return df.select("cpf_cnpj", "nome", "ord")
