"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the provided tables (whole
tables, no sampling) through the fixture ledgers or directly, and returns a
lazy DataFrame with ASCII column names that match its oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions import (
    canonical_type,
    format_movement_date,
    html_unescape,
    join_badges,
    normalize_document,
    normalize_document_loose,
    strip_non_word,
)
from ledgerspark.operators import reconcile as rc
from ledgerspark.operators import views
from ledgerspark.plans import oracle as sql
from ledgerspark.plans import reports
from ledgerspark.sources import files, sinks
from ledgerspark.sources import fixtures as fx

Builder = Callable[[SparkSession, str], DataFrame]
ACTIVE = ("Ativas",)


def _q1(spark: SparkSession, d: str) -> DataFrame:
    return reports.unified_report(fx.movements(spark, d), fx.registry(spark, d), fx.status_exports(spark, d))


def _q1_join(spark: SparkSession, d: str) -> DataFrame:
    return reports.unified_report_join_form(fx.movements(spark, d), fx.registry(spark, d),
                                            fx.status_exports(spark, d))


def _q2(spark: SparkSession, d: str) -> DataFrame:
    return reports.unified_presence_report(fx.movements(spark, d), fx.registry(spark, d),
                                           fx.status_exports(spark, d, fontes=ACTIVE))


def _q3(spark: SparkSession, d: str) -> DataFrame:
    return reports.cnm_registry_report(fx.movements(spark, d), fx.registry(spark, d))


def _q4(spark: SparkSession, d: str) -> DataFrame:
    return reports.soa_registry_report(fx.status_exports(spark, d, fontes=ACTIVE), fx.registry(spark, d))


def _q5(spark: SparkSession, d: str) -> DataFrame:
    return reports.movement_status_counts(fx.movements(spark, d), fx.registry(spark, d))


def _movement_status(spark: SparkSession, d: str) -> DataFrame:
    rows = reports.movement_status_rows(fx.movements(spark, d), fx.registry(spark, d))
    return rows.select("id", "documento", "tipo", "in_registry", "status")


# Fixed parameters of the registered view queries (what a dashboard user would pick).
SEARCH_TEXT = "erro ativas"
FILTER_TYPES, FILTER_FROM = ("EXCLUSAO", "INCLUSAO"), "000.000.001"
SEARCH_NAMES = "negativado customer#00000012"
SORT_BY = [("data", True)]
PAGE = 2
FACET_CHOICE = {"status": "baixado"}
FACET_CHOICES = {"status": "erro", "tipo": "inclusao"}
FACET_ORDER = [("data", False), ("tipo", False), ("status", False)]
SUBTITLE_CHOICE = {"status": "negativado"}
SUBTITLE_ORDER = [("id", False)]
DEEP_PAGE, DEEP_PAGE_SIZE = 101, 5
SINCE = "2024-01-15"
TAG = "BUILDING"
CURRENT_COLUMNS = ["id", "documento", "nome", "data", "tipo", "local", "status"]
# Status files of the concat test: which columns each export lacks.
EXPORT_FILES = [("Ativas", ()), ("Baixadas", ("devedor",)), ("Pendentes", ()), ("Determinacao", ()),
                ("Erros", ("unique_id",))]


def _ledgers(spark: SparkSession, d: str):
    return fx.movements(spark, d), fx.registry(spark, d), fx.status_exports(spark, d)


def _keys_union(fn):
    def build(spark: SparkSession, d: str) -> DataFrame:
        mv, rg, se = _ledgers(spark, d)

        def part(df, ledger, column):
            return df.select(F.lit(ledger).alias("ledger"), "ord", F.col(column).alias("raw"),
                             fn(F.col(column), df.schema[column].dataType).alias("documento"))

        return part(mv, "CNM", "documento").unionByName(part(rg, "SGP", "cpf_cnpj")).unionByName(
            part(se, "SOA", "documento"))
    return build


def _html_unescape(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/pages.parquet")
    return pages.select("page_id", html_unescape("html").alias("html"))


def _strip_non_word(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", strip_non_word("text").alias("text"))


def _canonical_type(spark: SparkSession, d: str) -> DataFrame:
    mv = fx.movements(spark, d)
    return mv.select("id", "tipo", canonical_type("tipo").alias("tipo_canonical"))


def _format_movement_date(spark: SparkSession, d: str) -> DataFrame:
    mv, _, se = _ledgers(spark, d)
    a = mv.select(F.lit("CNM").alias("ledger"), "ord",
                  format_movement_date(F.col("data_hora"), mv.schema["data_hora"].dataType).alias("data"))
    b = se.select(F.lit("SOA").alias("ledger"), "ord", format_movement_date(F.col("data")).alias("data"))
    return a.unionByName(b)


def _flags(spark: SparkSession, d: str) -> DataFrame:
    mv, rg, se = _ledgers(spark, d)
    return rc.presence_flags(("CNM", mv, normalize_document("documento")),
                             ("SOA", se, normalize_document("documento")),
                             ("SGP", rg, normalize_document("cpf_cnpj")))


def _presence_badges(spark: SparkSession, d: str) -> DataFrame:
    f = _flags(spark, d)
    return f.select("documento", join_badges(("CNM", F.col("in_cnm")), ("SOA", F.col("in_soa")),
                                             ("SGP", F.col("in_sgp"))).alias("local"))


def _concat_sources(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for fonte, missing in EXPORT_FILES:
        one = fx.status_exports(spark, d, fontes=(fonte,))
        keep = [c for c in ("documento", "devedor", "unique_id", "data", "ord") if c not in missing]
        parts.append(rc.tag_source(one.select(*keep), fonte))
    return rc.concat_sources(*parts).select("documento", "devedor", "unique_id", "data", "fonte", "ord")


def _document_universe(spark: SparkSession, d: str) -> DataFrame:
    mv, rg, se = _ledgers(spark, d)
    return rc.document_universe((mv, normalize_document("documento")), (se, normalize_document("documento")),
                                (rg, normalize_document("cpf_cnpj")))


def _in_registry(spark: SparkSession, d: str) -> DataFrame:
    _, rg, se = _ledgers(spark, d)
    keys = rc.registry_key_rows(rg, normalize_document("cpf_cnpj"))
    rows = se.select("ord", normalize_document("documento").alias("documento"))
    return rc.with_registry_flag(rows, F.col("documento"), keys)


def _only_in_cnm(spark: SparkSession, d: str) -> DataFrame:
    mv, rg, _ = _ledgers(spark, d)
    return rc.only_in(rc.document_keys(mv, normalize_document("documento")),
                      rc.document_keys(rg, normalize_document("cpf_cnpj")))


def _in_both(spark: SparkSession, d: str) -> DataFrame:
    mv, rg, _ = _ledgers(spark, d)
    return rc.in_both(rc.document_keys(mv, normalize_document("documento")),
                      rc.document_keys(rg, normalize_document("cpf_cnpj")))


def _first_row_per_document(spark: SparkSession, d: str) -> DataFrame:
    se = fx.status_exports(spark, d)
    return rc.first_rows(se, normalize_document("documento"), ["devedor", "unique_id", "data", "fonte"],
                         ["source_rank", "ord"])


def _sources_per_document(spark: SparkSession, d: str) -> DataFrame:
    mv, _, se = _ledgers(spark, d)
    r = rc.reconcile(rc.Ledger("CNM", mv, normalize_document("documento"), payload=["tipo"], order=["ord"]),
                     rc.Ledger("SOA", se, normalize_document("documento"), sources=("source_rank", "fonte")))
    fontes = reports.sources_with_movement_tag(F.col("soa_sources"), F.col("in_cnm"), F.col("cnm_first.tipo"))
    return r.select("documento", F.array_join(fontes, ",").alias("fontes"))


def _all_null_per_document(spark: SparkSession, d: str) -> DataFrame:
    se = fx.status_exports(spark, d)
    r = rc.reconcile(rc.Ledger("SOA", se, normalize_document("documento"), payload=["unique_id"],
                               order=["source_rank", "ord"], count_non_null=["unique_id"]))
    return r.select("documento", (F.col("soa_unique_id_n") == 0).alias("all_null"))


def _search_rows(spark: SparkSession, d: str) -> DataFrame:
    return views.search_rows(_q1(spark, d), SEARCH_TEXT)


def _search_indexed(spark: SparkSession, d: str) -> DataFrame:
    """UI1 from a trigram index of Q1."""
    from ledgerspark.operators import search_index

    path = _scratch(spark, "search")
    search_index.add(spark, path, _q1(spark, d), 0, whole=True)
    return search_index.search(spark, path, SEARCH_NAMES)


def _search_changes(spark: SparkSession, d: str) -> DataFrame:
    """UI1 after an upkeep by changes: Q1 without its status exports is indexed, then the rows that those change are added."""
    from ledgerspark.operators import search_index

    movements, registry, status_exports = _ledgers(spark, d)
    path = _scratch(spark, "search")
    before = reports.unified_report(movements, registry, status_exports.where(F.lit(False)))
    search_index.add(spark, path, before, 0, whole=True)
    changes = _q1(spark, d).exceptAll(before)
    search_index.add(spark, path, changes, 1)
    return search_index.search(spark, path, SEARCH_TEXT)


def _sort_rows(spark: SparkSession, d: str) -> DataFrame:
    return views.with_positions(_q1(spark, d), SORT_BY)


def _page_rows(spark: SparkSession, d: str) -> DataFrame:
    return views.page_rows(_q1(spark, d), PAGE, SORT_BY)


def _facet_values(spark: SparkSession, d: str) -> DataFrame:
    return views.facet_values(_q1(spark, d), views.FACETS["current"])


def _facet_filter(spark: SparkSession, d: str) -> DataFrame:
    return views.facet_filter(_q1(spark, d), FACET_CHOICE)


def _view_subtitle(spark: SparkSession, d: str) -> DataFrame:
    view = views.facet_filter(_q1(spark, d), SUBTITLE_CHOICE)
    return views.view_subtitle(spark, view, SUBTITLE_ORDER, "current")


def _html_rows(spark: SparkSession, d: str) -> DataFrame:
    return sinks.html_rows(_q1(spark, d), CURRENT_COLUMNS)


def _q1_reference_keys(spark: SparkSession, d: str) -> DataFrame:
    """Q1 with a key mode per ledger: loose for the two registers, strict for the exports."""
    return reports.unified_report(*_ledgers(spark, d), key_mode=reports.REGISTER_LOOSE)


def _intake_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.intake_report(*_ledgers(spark, d))


def _deep_page(spark: SparkSession, d: str) -> DataFrame:
    return views.page_rows(_q1(spark, d), DEEP_PAGE, SORT_BY, size=DEEP_PAGE_SIZE)


def _stored_page(spark: SparkSession, d: str) -> DataFrame:
    """UI3: the deep page from an order of Q1 that is stored once."""
    from ledgerspark.operators import stored_order

    path = stored_order.stored(spark, lambda: _q1(spark, d), _scratch(spark, "orders"), "1", SORT_BY)
    return stored_order.page(spark, path, DEEP_PAGE, DEEP_PAGE_SIZE)


def _facet_index(spark: SparkSession, d: str):
    """An order of Q1 by its facets and the bitmaps over it, each stored once."""
    from ledgerspark.operators import facet_bitmaps, stored_order

    root = _scratch(spark, "facets")
    order = stored_order.stored(spark, lambda: _q1(spark, d), root, "1", FACET_ORDER)
    facet_bitmaps.store_index(spark, order, f"{order}/facets", views.FACETS["current"])
    return order, facet_bitmaps.read_index(spark, f"{order}/facets")


def _facet_counts(spark: SparkSession, d: str) -> DataFrame:
    """UI4 under active choices, from bitmaps alone."""
    from ledgerspark.operators import facet_bitmaps

    return facet_bitmaps.facet_counts(_facet_index(spark, d)[1], views.FACETS["current"], FACET_CHOICES)


def _facet_rows(spark: SparkSession, d: str) -> DataFrame:
    """UI5: the rows of two choices, found by bitmaps."""
    from ledgerspark.operators import facet_bitmaps

    return facet_bitmaps.filtered_rows(spark, *_facet_index(spark, d), FACET_CHOICES)


def _extract_predicates(spark: SparkSession, d: str) -> DataFrame:
    return files.extract_movements(fx.movements(spark, d), SINCE).select("id", "documento", "tipo")


def _extract_registry(spark: SparkSession, d: str) -> DataFrame:
    return files.extract_registry(fx.customers(spark, d), TAG).select("cpf_cnpj", "nome")


def _landed(spark: SparkSession, d: str) -> str:
    """A fresh landing folder (under the shared checkpoint folder) holding the fixture files."""
    import uuid

    from ledgerspark.session import checkpoint_dir

    return fx.land_fixture(spark, d, f"{checkpoint_dir(spark).rstrip('/')}/landing-{uuid.uuid4().hex}")


def _landed_ledgers(spark: SparkSession, d: str):
    from ledgerspark.sources import exports

    folder = _landed(spark, d)
    mv = exports.scan_movements(spark, f"{folder}/Relatorio_CNM.csv", fmt="csv")
    rg = exports.scan_registry(spark, f"{folder}/Relatorio_SGP.csv", fmt="csv")
    se, _ = exports.scan_status_exports(spark, folder)
    return folder, mv, rg, se


def _q1_from_landing(spark: SparkSession, d: str) -> DataFrame:
    _, mv, rg, se = _landed_ledgers(spark, d)
    return reports.unified_report(mv, rg, se)


def _scan_status_exports(spark: SparkSession, d: str) -> DataFrame:
    _, _, _, se = _landed_ledgers(spark, d)
    return se.drop("ord")


LEDGER_BUCKETS = 8  # of the registered queries; a production table sets it for the rows it will hold


def _bucketed(report):
    """A report from a fresh bucketed table of the fixture ledgers."""
    def build(spark: SparkSession, d: str) -> DataFrame:
        from ledgerspark.plans import buckets

        table = _scratch(spark, "ledgers").rsplit("/", 1)[-1].replace("-", "_")
        buckets.write_ledgers(*_ledgers(spark, d), table, LEDGER_BUCKETS)
        return report(buckets, spark, table)
    return build


def _scan_multiline_exports(spark: SparkSession, d: str) -> DataFrame:
    """SRC3 over exports whose debtor names hold a line break: every file is split, none is read whole by one task."""
    from ledgerspark.sources import exports

    folder = fx.land_fixture(spark, d, _scratch(spark, "landing-lines"), line_breaks=True)
    se, _ = exports.scan_status_exports(spark, folder)
    return se.drop("ord")


def _scan_movements(spark: SparkSession, d: str) -> DataFrame:
    _, mv, _, _ = _landed_ledgers(spark, d)
    return mv.select("id", "documento", "tipo", format_movement_date(F.col("data_hora"),
                                                                     mv.schema["data_hora"].dataType).alias("data"))


def _header_rows(batches):
    """(ledger file, raw header) rows with the header each scan resolves it to."""
    from ledgerspark.sources import exports, headers

    own = {"Relatorio_CNM.csv": exports.MOVEMENT_ALIASES, "Relatorio_SGP.csv": exports.REGISTRY_ALIASES}
    for pdf in batches:
        pdf["columns"] = ["|".join(headers.resolve_header(list(h), own.get(f, headers.ALL_ALIASES))[0])
                          for f, h in zip(pdf["ledger_file"], pdf["header"])]
        pdf["raw_header"] = pdf["header"].map("|".join)
        yield pdf[["ledger_file", "raw_header", "columns"]]


def _header_ops(spark: SparkSession, d: str) -> DataFrame:
    """SCH1-SCH5 on the landed files: one row per distinct (ledger file, raw header)."""
    from ledgerspark.sources import exports, landing

    folder = _landed(spark, d)
    listing = landing.landing_filter(landing.list_landing(spark, folder), suffixes=(".csv",))
    signatures = exports.header_signatures(listing)
    files_ = signatures.select(F.explode("paths").alias("path"), "header").select(
        F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("ledger_file"), "header").distinct()
    return files_.mapInPandas(_header_rows, "ledger_file string, raw_header string, columns string")


def _spoil(kind: str):
    """Copies of workbooks under another name: cut short, or with a byte of a member flipped."""
    def write(batches):
        import pandas as pd

        from ledgerspark.sources.files import open_output

        for pdf in batches:
            for path, content in zip(pdf["target"], pdf["content"]):
                data = bytearray(content)
                if kind == "tiny":
                    data = data[:100]
                else:
                    data[len(data) // 2] ^= 0xFF
                with open_output(path) as f:
                    f.write(bytes(data))
            yield pd.DataFrame({"path": pdf["target"]})
    return write


def _intake_check(spark: SparkSession, d: str) -> DataFrame:
    """SRC9 over the movements landed as workbooks, as they are, cut short, and damaged."""
    from ledgerspark.sources.landing import intake_check
    from ledgerspark.sources.workbook import write_workbooks

    folder = _scratch(spark, "intake")
    rows = fx.movements(spark, d)
    write_workbooks(rows.repartitionByRange("ord").select("id", "documento", "tipo", F.sha2("documento", 512).alias("filler")),
                    f"{folder}/good").collect()
    good = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(f"{folder}/good")
    for kind in ("tiny", "damaged"):
        target = F.concat(F.lit(f"{folder}/{kind}/"), F.element_at(F.split("path", "/"), -1))
        good.select(target.alias("target"), "content").mapInPandas(_spoil(kind), "path string").collect()
    checked = intake_check(spark, folder)
    return checked.select(F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("file"), "ok",
                          F.regexp_replace("reason", ":.*$", "").alias("reason")).distinct()


def _q1_from_parquet(spark: SparkSession, d: str) -> DataFrame:
    """SRC1/SRC2 over typed Parquet ledgers: the registry's documents are doubles there."""
    from ledgerspark.sources import exports

    folder = _landed(spark, d)
    digits = F.regexp_replace("cpf_cnpj", "[^0-9]", "").cast("double")
    (fx.registry(spark, d).repartitionByRange("ord").sortWithinPartitions("ord")
     .select(digits.alias("CPF/CNPJ"), F.col("nome").alias("Nome/Razão Social")).write.parquet(f"{folder}/Relatorio_SGP.parquet"))
    mv = exports.scan_movements(spark, f"{folder}/Relatorio_CNM.csv", fmt="csv")
    rg = exports.scan_registry(spark, f"{folder}/Relatorio_SGP.parquet", fmt="parquet")
    se, _ = exports.scan_status_exports(spark, folder)
    unpadded = rg.withColumn("cpf_cnpj", F.lpad(F.regexp_replace("cpf_cnpj", r"\.0$", ""), fx.DOC_WIDTH, "0"))
    return reports.unified_report(mv, unpadded, se)


def _scan_registry(spark: SparkSession, d: str) -> DataFrame:
    """SRC2/SRC4: the registry from workbooks whose preamble holds blank rows."""
    from ledgerspark.sources import exports

    folder = fx.land_fixture_workbooks(spark, d, _scratch(spark, "landing-xlsx"))
    return exports.scan_registry(spark, f"{folder}/Relatorio_SGP.xlsx").select("cpf_cnpj", "nome")


def _workbook_filters(spark: SparkSession, d: str) -> DataFrame:
    """SRC4/SRC12: movements of some types and keys from workbooks, decided while the sheets are parsed."""
    from ledgerspark.sources import exports

    folder = fx.land_fixture_workbooks(spark, d, _scratch(spark, "landing-xlsx"))
    where = [("tipo", "in", FILTER_TYPES), ("documento", ">=", FILTER_FROM)]
    return exports.scan_movements(spark, f"{folder}/Relatorio_CNM.xlsx", where=where).select("id", "documento", "tipo")


def _partly_landed(spark: SparkSession, d: str, fontes: tuple[str, ...], folder: str) -> str:
    """Some of the status exports as single CSV files, each named as its portal names it."""
    from ledgerspark.sources.exports import STATUS_FILES

    for _, fonte, name in STATUS_FILES:
        if fonte in fontes:
            fx.status_exports(spark, d, fontes=(fonte,)).select(F.col("documento").alias("Documento")).write.option(
                "header", True).csv(f"{folder}/{name}")
    return folder


def _missing_sources(spark: SparkSession, d: str) -> DataFrame:
    from ledgerspark.sources import exports

    return exports.missing_sources(spark, _partly_landed(spark, d, ("Ativas", "Pendentes"), _scratch(spark, "missing")))


def _empty_exports(spark: SparkSession, d: str) -> DataFrame:
    """SRC8: a landing with both registers and no status export at all."""
    from ledgerspark.sources import exports

    folder = _scratch(spark, "no-exports")
    fx.movements(spark, d).select(F.col("documento").alias("Documento")).write.option("header", True).csv(f"{folder}/Relatorio_CNM.csv")
    se, _ = exports.scan_status_exports(spark, folder)
    return se.select("documento", "devedor", "unique_id", "data", "fonte")


def _top_names(listing: DataFrame) -> DataFrame:
    return listing.select(F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("file")).distinct()


def _new_files_since(spark: SparkSession, d: str) -> DataFrame:
    from ledgerspark.sources import landing

    folder = _partly_landed(spark, d, ("Ativas", "Pendentes"), _scratch(spark, "arrivals"))
    before = landing.landing_filter(landing.list_landing(spark, folder))
    before.write.parquet(f"{folder}-before")
    _partly_landed(spark, d, ("Erros", "Baixadas"), folder)
    after = landing.landing_filter(landing.list_landing(spark, folder))
    return _top_names(landing.new_files_since(spark.read.parquet(f"{folder}-before"), after))


def _landing_filter(spark: SparkSession, d: str) -> DataFrame:
    """SRC10: CSV parts pass; Parquet parts, success markers and checksum files do not."""
    from ledgerspark.sources import landing

    folder = _partly_landed(spark, d, ("Ativas", "Erros"), _scratch(spark, "filter"))
    fx.registry(spark, d).write.parquet(f"{folder}/Relatorio_SGP.parquet")
    return _top_names(landing.landing_filter(landing.list_landing(spark, folder)))


def _newest_versions(spark: SparkSession, d: str) -> DataFrame:
    """STR2: three loads of the registry, the newest of which has the name that sorts first as text."""
    from ledgerspark.sources import landing
    from ledgerspark.streaming import refresh

    root = _scratch(spark, "versions")
    for load, tag in (("20240101", "HOUSEHOLD"), ("20240131T120000", "MACHINERY"), ("1700000000", "BUILDING")):
        files.extract_registry(fx.customers(spark, d), tag).write.parquet(f"{root}/ledger=SGP/load_ts={load}")
    listing = landing.list_landing(spark, root, glob="*.parquet")
    paths = [r.path for r in refresh.newest_versions(listing).select("path").collect()]
    return spark.read.parquet(*paths).select("cpf_cnpj", "nome", "tag")


OVERWRITTEN_EXPORTS = ("Ativas", "Erros")


def _summary_files(folder: str):
    """Writes one small file per row, in place: ``<fonte>.csv`` with the row's text."""
    def write(batches):
        import pandas as pd

        from ledgerspark.sources.files import open_output

        for pdf in batches:
            for fonte, text in zip(pdf["fonte"], pdf["text"]):
                with open_output(f"{folder}/{fonte}.csv") as f:
                    f.write(text.encode())
            yield pd.DataFrame({"fonte": pdf["fonte"]})
    return write


def _overwritten_files(spark: SparkSession, d: str) -> DataFrame:
    """STR2: the events of a flat landing over three runs of the stream: all files land, two are overwritten, nothing happens.

    Each file holds the number of its export's rows, then that of its rows with a unique id.
    """
    from ledgerspark.session import ship_package
    from ledgerspark.streaming import refresh
    from ledgerspark.streaming.landing_events import landing_events

    root = _scratch(spark, "overwritten")
    ship_package(spark)
    se = fx.status_exports(spark, d).groupBy("fonte").agg(
        F.concat(F.lit("rows\n"), F.count(F.lit(1))).alias("all"), F.concat(F.lit("unique ids\n"), F.count("unique_id")).alias("some"))
    for k, text in enumerate((se.select("fonte", F.col("all").alias("text")),
                              se.where(F.col("fonte").isin(*OVERWRITTEN_EXPORTS)).select("fonte", F.col("some").alias("text")), None)):
        if text is not None:
            text.mapInPandas(_summary_files(f"{root}/in"), "fonte string").collect()
        events = landing_events(spark, f"{root}/in", f"{root}/listings", glob="*.csv").withColumn("run", F.lit(k))
        refresh.await_all(events.writeStream.format("parquet").option("path", f"{root}/out")
                          .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return spark.read.parquet(f"{root}/out").select("run", "name", "event", "length")


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    from ledgerspark.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# State partitions of the registered streams at least; a production stream sets this for the state it will hold.
STATE_PARTITIONS = 8


@contextmanager
def _state_partitions(spark: SparkSession, n: int):
    """``spark.sql.shuffle.partitions`` for the start of a stream, which fixes its state's partitioning: ``n``, or two for each core."""
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(max(n, 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def _stream_changes(spark: SparkSession, d: str) -> DataFrame:
    """STR4: the rows emitted by a second step that repeats the last movement rows of every document.

    The repeated movements sort after the first ones and change nothing; the registry entries
    of the segment that lands with them do.
    """
    from ledgerspark.streaming import incremental, refresh

    root = _scratch(spark, "stream-changes")
    mv, rg, se = _ledgers(spark, d)
    late = rg.where(F.col("tag") == TAG)
    steps = [(mv, rg.where(F.col("tag") != TAG), se), (mv.withColumn("ord", F.col("ord") + (1 << 40)), late, None)]
    names = ("movements", "registry", "status_exports")
    for i, step in enumerate(steps):
        for name, df in zip(names, step):
            if df is not None:
                df.write.parquet(f"{root}/in/{name}/load={i}")
        streams = [spark.readStream.schema(df.schema).parquet(f"{root}/in/{n}") for n, df in zip(names, (mv, rg, se))]
        with _state_partitions(spark, STATE_PARTITIONS):
            refresh.await_all(incremental.write_changes(incremental.unified_changes(*streams), f"{root}/out", f"{root}/checkpoint"))
    out = spark.read.parquet(f"{root}/out")
    return out.where(F.col(refresh.BATCH_COLUMN) == 1).drop(refresh.BATCH_COLUMN)


def _stream_incremental_report(spark: SparkSession, d: str) -> DataFrame:
    """STR4: the fixture lands in steps; the latest row of every document after the last step."""
    from ledgerspark.streaming import incremental, refresh

    root = _scratch(spark, "stream-incremental")
    steps = fx.fixture_loads(spark, d)
    schemas = {name: df.schema for name, df in steps[0].items()}
    for i, step in enumerate(steps):
        for name, df in step.items():
            df.write.mode("overwrite").parquet(f"{root}/in/{name}/load={i}")
        streams = {n: spark.readStream.schema(schemas[n]).parquet(f"{root}/in/{n}") for n in schemas}
        changes = incremental.unified_changes(streams["movements"], streams["registry"], streams["status_exports"])
        with _state_partitions(spark, STATE_PARTITIONS):
            refresh.await_all(incremental.write_changes(changes, f"{root}/out", f"{root}/checkpoint"))
    return refresh.current_status(spark.read.parquet(f"{root}/out"))


def _stream_refresh_report(spark: SparkSession, d: str) -> DataFrame:
    """STR1 + STR3: watching the landing folder triggers a full Q1 refresh."""
    from ledgerspark.sources import exports
    from ledgerspark.streaming import refresh

    root = _scratch(spark, "stream-refresh")
    folder = fx.land_fixture(spark, d, f"{root}/landing")

    def build(s: SparkSession) -> DataFrame:
        mv = exports.scan_movements(s, f"{folder}/Relatorio_CNM.csv", fmt="csv")
        rg = exports.scan_registry(s, f"{folder}/Relatorio_SGP.csv", fmt="csv")
        se, _ = exports.scan_status_exports(s, folder)
        return reports.unified_report(mv, rg, se)

    files = refresh.watch_landing(spark, folder, glob="*.csv", recursive=True)
    q = refresh.refresh_report(files, build, f"{root}/out", f"{root}/log", f"{root}/checkpoint")
    refresh.await_all(q)
    return refresh.published(spark, f"{root}/out", f"{root}/log")


def _q1_from_workbooks(spark: SparkSession, d: str) -> DataFrame:
    """SRC1/SRC2/SRC4: movement register and registry read back from landed workbooks."""
    from ledgerspark.sources import exports

    folder = fx.land_fixture_workbooks(spark, d, _scratch(spark, "landing-xlsx"))
    mv = exports.scan_movements(spark, f"{folder}/Relatorio_CNM.xlsx", fmt="workbook")
    rg = exports.scan_registry(spark, f"{folder}/Relatorio_SGP.xlsx", fmt="workbook")
    se, _ = exports.scan_status_exports(spark, folder)
    return reports.unified_report(mv, rg, se)


def _write_result(spark: SparkSession, d: str) -> DataFrame:
    """SNK1: Q1 written as CSV with the spreadsheet headers, read back as text."""
    path = _scratch(spark, "result-csv")
    sinks.write_result(_q1(spark, d), path, fmt="csv", variant="current")
    # a quoted empty cell is the empty document, an unquoted one a null: tell them apart when reading
    back = spark.read.option("header", True).option("escape", '"').option("nullValue", "\u0000").schema(
        ", ".join(f"`{h}` string" for h in sinks.DISPLAY_NAMES["current"].values())).csv(path)
    names = {v: k for k, v in sinks.DISPLAY_NAMES["current"].items()}
    return back.select(*[F.col(f"`{c}`").alias(names[c]) for c in back.columns])


# Literal results of the queries over landed file names, headers and damaged workbooks.
MISSING_EXPECTED = [{"file": "Baixadas.csv", "source_rank": 2, "fonte": "Baixadas"},
                    {"file": "Determinacao.csv", "source_rank": 4, "fonte": "Determinacao"},
                    {"file": "Erros.csv", "source_rank": 5, "fonte": "Erros"}]
INTAKE_EXPECTED = [{"file": "good", "ok": True, "reason": "ok"}, {"file": "tiny", "ok": False, "reason": "too_small"},
                   {"file": "damaged", "ok": False, "reason": "bad_crc"}]
HEADERS_EXPECTED = [
    {"ledger_file": "Relatorio_CNM.csv", "raw_header": "Id|Documento|Tipo|Data / Hora", "columns": "id|documento|tipo|data_hora"},
    {"ledger_file": "Relatorio_SGP.csv", "raw_header": "CPF/CNPJ|Nome/Razão Social", "columns": "cpf_cnpj|nome"},
    {"ledger_file": "Ativas.csv", "raw_header": "+//3//f/9-Unique ID|+ACI-Documento+ACI-|Devedor|Data Inclus+//3//Q-o",
     "columns": "unique_id|documento|devedor|data"},
    {"ledger_file": "Baixadas.csv", "raw_header": "Documento|Devedor|Unique ID|Data Exclusão", "columns": "documento|devedor|unique_id|data"},
    {"ledger_file": "Pendentes.csv", "raw_header": "Documento|Devedor|Unique ID|Data Inclusão|Data Exclusão",
     "columns": "documento|devedor|unique_id|data"},
    {"ledger_file": "Determinacao.csv", "raw_header": "Documento|Devedor|Unique ID|Data Inclusão|+ACI-Documento+ACI-|Data Exclusão",
     "columns": "documento|devedor|unique_id|data|Documento.1"},
    {"ledger_file": "Erros.csv", "raw_header": "Documento|Devedor|Unique ID|Data Inclusão", "columns": "documento|devedor|unique_id|data"},
]


def catalog() -> dict[str, tuple[Builder, str | None]]:
    return {
        "q1_unified_report": (_q1, sql.q1_sql()),
        "q1_bucketed": (_bucketed(lambda b, s, t: b.unified_report(s, t)), sql.q1_sql()),
        "q2_bucketed": (_bucketed(lambda b, s, t: b.unified_presence_report(s, t, ACTIVE)), sql.q2_sql()),
        "q3_bucketed": (_bucketed(lambda b, s, t: b.cnm_registry_report(s, t)), sql.q3_sql()),
        "q4_bucketed": (_bucketed(lambda b, s, t: b.soa_registry_report(s, t, ACTIVE)), sql.q4_sql()),
        "q1_join_form": (_q1_join, sql.q1_sql()),
        "q2_unified_presence_report": (_q2, sql.q2_sql()),
        "q3_cnm_registry_report": (_q3, sql.q3_sql()),
        "q4_soa_registry_report": (_q4, sql.q4_sql()),
        "q5_movement_status_counts": (_q5, sql.q5_sql()),
        "movement_status": (_movement_status, sql.movement_status_sql()),
        "normalize_document": (_keys_union(normalize_document), sql.normalize_document_sql()),
        "normalize_document_loose": (_keys_union(normalize_document_loose), sql.normalize_document_loose_sql()),
        "html_unescape": (_html_unescape, sql.html_unescape_pages_sql()),
        "strip_non_word": (_strip_non_word, sql.strip_non_word_sql()),
        "canonical_type": (_canonical_type, sql.canonical_type_sql()),
        "format_movement_date": (_format_movement_date, sql.format_movement_date_sql()),
        "presence_badges": (_presence_badges, sql.presence_badges_sql()),
        "concat_sources": (_concat_sources, sql.concat_sources_sql(EXPORT_FILES)),
        "document_universe": (_document_universe, sql.document_universe_sql()),
        "in_registry": (_in_registry, sql.in_registry_sql()),
        "only_in_cnm": (_only_in_cnm, sql.only_in_cnm_sql()),
        "in_both": (_in_both, sql.in_both_sql()),
        "first_row_per_document": (_first_row_per_document, sql.first_row_per_document_sql()),
        "sources_per_document": (_sources_per_document, sql.sources_per_document_sql()),
        "all_null_per_document": (_all_null_per_document, sql.all_null_per_document_sql()),
        "presence_flags": (_flags, sql.presence_flags_sql()),
        "search_rows": (_search_rows, sql.search_rows_sql(SEARCH_TEXT)),
        "search_indexed": (_search_indexed, sql.search_rows_sql(SEARCH_NAMES)),
        "search_changes": (_search_changes, sql.search_rows_sql(SEARCH_TEXT)),
        "sort_rows": (_sort_rows, sql.sort_rows_sql(SORT_BY)),
        "page_rows": (_page_rows, sql.page_rows_sql(PAGE, SORT_BY, views.PAGE_SIZE)),
        "facet_values": (_facet_values, sql.facet_values_sql(views.FACETS["current"])),
        "facet_filter": (_facet_filter, sql.facet_filter_sql(FACET_CHOICE)),
        "facet_counts": (_facet_counts, sql.facet_counts_sql(views.FACETS["current"], FACET_CHOICES)),
        "facet_rows": (_facet_rows, sql.facet_filter_sql(FACET_CHOICES)),
        "view_subtitle": (_view_subtitle, sql.view_subtitle_sql(SUBTITLE_CHOICE, SUBTITLE_ORDER,
                                                                  views.SUBTITLES["current"])),
        "html_rows": (_html_rows, sql.html_rows_sql(CURRENT_COLUMNS)),
        "extract_predicates": (_extract_predicates, sql.extract_predicates_sql(SINCE)),
        "extract_registry": (_extract_registry, sql.extract_registry_sql(TAG)),
        "q1_reference_keys": (_q1_reference_keys, sql.q1_reference_keys_sql()),
        "intake_report": (_intake_report, sql.intake_report_sql()),
        "deep_page": (_deep_page, sql.page_rows_sql(DEEP_PAGE, SORT_BY, DEEP_PAGE_SIZE)),
        "stored_page": (_stored_page, sql.page_rows_sql(DEEP_PAGE, SORT_BY, DEEP_PAGE_SIZE)),
        "q1_from_parquet": (_q1_from_parquet, sql.q1_sql()),
        "workbook_filters": (_workbook_filters, sql.workbook_filters_sql(FILTER_TYPES, FILTER_FROM)),
        "scan_registry": (_scan_registry, sql.scan_registry_sql()),
        "missing_sources": (_missing_sources, sql.values_sql(MISSING_EXPECTED)),
        "empty_exports": (_empty_exports, sql.empty_exports_sql()),
        "new_files_since": (_new_files_since, sql.values_sql([{"file": "Baixadas.csv"}, {"file": "Erros.csv"}])),
        "landing_filter": (_landing_filter, sql.values_sql([{"file": "Ativas.csv"}, {"file": "Erros.csv"}])),
        "newest_versions": (_newest_versions, sql.newest_versions_sql("MACHINERY")),
        "overwritten_files": (_overwritten_files, sql.overwritten_files_sql(OVERWRITTEN_EXPORTS)),
        "stream_changes": (_stream_changes, sql.stream_changes_sql(TAG)),
        "q1_from_landing": (_q1_from_landing, sql.q1_sql()),
        "scan_status_exports": (_scan_status_exports, sql.scan_status_exports_sql()),
        "scan_multiline_exports": (_scan_multiline_exports, sql.scan_multiline_exports_sql()),
        "scan_movements": (_scan_movements, sql.scan_movements_sql()),
        "intake_check": (_intake_check, sql.values_sql(INTAKE_EXPECTED)),
        "header_ops": (_header_ops, sql.values_sql(HEADERS_EXPECTED)),
        "q1_from_workbooks": (_q1_from_workbooks, sql.q1_sql()),
        "write_result": (_write_result, sql.q1_sql()),
        "stream_incremental_report": (_stream_incremental_report, sql.q1_sql()),
        "stream_refresh_report": (_stream_refresh_report, sql.q1_sql()),
    }
