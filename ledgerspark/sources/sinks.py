"""Sinks: SNK1 result files, SNK2 HTML table rows.

Reports keep ASCII column names internally; ``display_names`` gives the
headers users saw in the original spreadsheets. Writes are ordinary
distributed DataFrame writes (one file per task), never a driver-side file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output headers per report variant.
DISPLAY_NAMES = {
    "current": {"id": "ID", "documento": "Documento", "nome": "Nome", "data": "Data", "tipo": "Tipo",
                "local": "Local", "status": "Status"},
    "cnm_registry": {"id": "Id", "documento": "Documento", "nome": "Nome", "data": "Data", "tipo": "Tipo",
                     "local": "Local", "status": "Status"},
    "soa_registry": {"id": "ID", "documento": "Documento", "nome": "Nome", "data_inclusao": "Data Inclusão",
                     "local": "Local", "tipo": "Tipo", "status": "Status"},
}
NULL_CELL = "NaN"


def display_names(df: DataFrame, variant: str = "current") -> DataFrame:
    names = DISPLAY_NAMES[variant]
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def write_result(df: DataFrame, path: str, fmt: str = "parquet", variant: str | None = "current",
                 mode: str = "overwrite") -> None:
    """SNK1: one row per document to Parquet or CSV (with header)."""
    out = display_names(df, variant) if variant else df
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
            .option("ignoreTrailingWhiteSpace", False).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def html_rows(df: DataFrame, columns: list[str] | None = None, key: str | None = "documento") -> DataFrame:
    """SNK2: each row as ``<tr><td>…</td>…</tr>``, values unescaped, null as ``NaN``."""
    columns = columns or df.columns
    cells = [F.concat(F.lit("<td>"), F.coalesce(F.col(c).cast("string"), F.lit(NULL_CELL)), F.lit("</td>"))
             for c in columns]
    row = F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("html")
    return df.select(*([F.col(key)] if key else []), row)


def write_html_rows(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """SNK2 to text files, one ``<tr>`` per line."""
    html_rows(df, columns, key=None).write.mode("overwrite").text(path)
