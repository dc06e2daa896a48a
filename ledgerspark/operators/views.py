"""Dashboard interactions as table operators (UI1-UI6).

The original dashboard ran these in the viewer's browser over the whole
result; here they are distributed DataFrame operators over a report:

* ``search_rows``: every whitespace-separated term must occur (case-insensitive)
  in the row's visible text (HTML tags removed);
* ``sort_rows`` / ``with_positions``: a range-partitioned sort, then a global
  position per row computed from per-partition counts (no single-task window);
* ``page_rows``: one page of 25 rows as a top-k (``orderBy + offset + limit``);
* ``facet_values`` / ``facet_filter``: distinct choices and exact, anchored,
  case-insensitive matches on chosen columns;
* ``view_subtitle``: caption of the first visible row of the current view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.status import BAIXADO, ERRO, NEGATIVADO

# Page size and the dashboard captions per status.
PAGE_SIZE = 25
TOP_PAGES = 40
TAG_PATTERN = r"<[^>]*>"
SUBTITLES = {
    "current": {
        NEGATIVADO: "Clientes negativados no CNM ou SOA e presentes no SGP.",
        BAIXADO: "Clientes excluídos no CNM ou no SOA e ausentes no SGP.",
        ERRO: "Clientes com inconsistência entre CNM, SOA e SGP.",
    },
    "presence": {
        NEGATIVADO: "Clientes negativados no CNM ou SOA e presentes no SGP.",
        BAIXADO: "Clientes excluídos no CNM ou no SOA e ausentes no SGP.",
        ERRO: "Clientes com inconsistência de presença entre os sistemas CNM, SOA e SGP.",
    },
    "two_way": {
        NEGATIVADO: "Relação de clientes que estão negativados nas duas planilhas.",
        BAIXADO: "Relação de clientes que estão baixados nas duas planilhas..",
        ERRO: "Relação de clientes que não estão presentes em uma das planilhas.",
    },
}
FACETS = {"current": ("data", "tipo", "status"), "presence": ("status",), "two_way": ("status",)}


def visible_text(c: Column) -> Column:
    """What a cell shows: its text without HTML tags; null prints as empty."""
    return F.coalesce(F.regexp_replace(c.cast("string"), TAG_PATTERN, ""), F.lit(""))


def search_terms(text: str) -> list[str]:
    """Smart-search terms: words, or phrases in double quotes."""
    import re

    return [t.strip('"') for t in re.findall(r'"[^"]+"|[^ ]+', text) if t.strip('"')]


def row_text(columns: list[str]) -> Column:
    """What a search looks at: the visible text of all cells in lower case."""
    return F.lower(F.concat_ws(" ", *[visible_text(F.col(c)) for c in columns]))


def search_rows(df: DataFrame, text: str, columns: list[str] | None = None) -> DataFrame:
    """UI1: rows containing every term of ``text`` in some visible cell text."""
    columns = columns or df.columns
    terms = search_terms(text)
    if not terms:
        return df
    shown = row_text(columns)
    cond = F.lit(True)
    for t in terms:
        cond = cond & F.contains(shown, F.lit(t.lower()))
    return df.where(cond)


def _ordering(by: list[tuple[str, bool]], tie_breaker: str | None) -> list[Column]:
    cols = [F.col(c).desc() if desc else F.col(c).asc() for c, desc in by]
    if tie_breaker and tie_breaker not in [c for c, _ in by]:
        cols.append(F.col(tie_breaker).asc())
    return cols


def sort_rows(df: DataFrame, by: list[tuple[str, bool]], tie_breaker: str | None = "documento") -> DataFrame:
    """UI2: order by columns (``(name, descending)``), ties broken by the document."""
    return df.orderBy(*_ordering(by, tie_breaker))


def with_positions(df: DataFrame, by: list[tuple[str, bool]], tie_breaker: str | None = "documento",
                   position: str = "pos") -> DataFrame:
    """UI2 with a 0-based global position per row, computed without a single-task window.

    The range-partitioned sort is checkpointed (reliable, in the shared
    ``spark.checkpoint.dir``) so both passes below read identical partitions;
    per-partition row counts (one row per partition) give each partition's
    offset, and ``monotonically_increasing_id`` the index inside it.
    """
    from ledgerspark.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*_ordering(by, tie_breaker)).withColumn("_pid", F.spark_partition_id())
    ordered = ordered.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = counts.select(
        "_pid", "_first",
        (F.sum("_n").over(_running_window()) - F.col("_n")).alias("_offset"),
    )
    # One row per partition: bounded by the partition count, safe to broadcast.
    out = ordered.join(F.broadcast(offsets), "_pid")
    return out.withColumn(position, F.col("_offset") + F.col("_mid") - F.col("_first")).drop(
        "_pid", "_mid", "_first", "_offset")


def _running_window():
    from pyspark.sql import Window

    return Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def page_rows(df: DataFrame, page: int, by: list[tuple[str, bool]], tie_breaker: str | None = "documento",
              size: int = PAGE_SIZE) -> DataFrame:
    """UI3: page ``page`` (1-based) of ``size`` rows of the ordered view.

    The first ``TOP_PAGES`` pages are a top-k plan, in which every task keeps the rows up to the page's
    end. Later pages are the range of global positions (``with_positions``), which no task has to gather.
    """
    if page < 1:
        raise ValueError("pages start at 1")
    start = size * (page - 1)
    if page <= TOP_PAGES:
        return df.orderBy(*_ordering(by, tie_breaker)).offset(start).limit(size)
    placed = with_positions(df, by, tie_breaker, position="_pos")
    return placed.where((F.col("_pos") >= start) & (F.col("_pos") < start + size)).orderBy("_pos").drop("_pos")


def facet_values(df: DataFrame, columns: tuple[str, ...], keep_empty: bool = False) -> DataFrame:
    """UI4: sorted distinct values per facet column as ``(facet, value)``; empties dropped.

    One pass over the report: each row is unpivoted into ``(facet, value)`` pairs
    and a single (partially aggregated) ``distinct`` serves all facets.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))
                              for c in columns]))
    out = df.select(pairs)
    if not keep_empty:
        out = out.where(F.col("value").isNotNull() & (F.col("value") != ""))
    return out.distinct().orderBy("facet", "value")


def facet_filter(df: DataFrame, choices: dict[str, str | None]) -> DataFrame:
    """UI5: exact, case-insensitive match per chosen facet; empty choice = no filter."""
    for c, v in choices.items():
        if v:
            df = df.where(F.lower(visible_text(F.col(c))) == F.lit(v.lower()))
    return df


def view_subtitle(spark: SparkSession, view: DataFrame, by: list[tuple[str, bool]], variant: str = "current",
                  tie_breaker: str | None = "documento", status_col: str = "status") -> DataFrame:
    """UI6: caption for the status of the first row of the (filtered, ordered) view.

    Returns one row ``(status, subtitulo)``; an empty view gives ``(null, '')``.
    """
    first = view.orderBy(*_ordering(by, tie_breaker)).limit(1)
    # A global aggregate over at most one row: exactly one row out, null status when the view is empty.
    picked = first.agg(F.max(F.col(status_col)).alias("status"))
    captions = spark.createDataFrame(list(SUBTITLES[variant].items()), "status string, subtitulo string")
    return (picked.join(F.broadcast(captions), "status", "left")
            .select("status", F.coalesce("subtitulo", F.lit("")).alias("subtitulo")))
