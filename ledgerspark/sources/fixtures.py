"""Ledgers derived from the provided TPC-H-style tables (the parity fixture).

The three ledgers of the reconciliation are projections of existing tables, so
their size grows with the scale factor:

* movements (CNM) <- ``events``: one movement per event, the user id as the
  document (punctuated like a CPF; a float-style ``.0`` tail for some), the event type
  mapped to a movement type (including a padded lower-case spelling and a type outside
  the enum). Many documents are missing or blank, some types and dates missing.
* registry (SGP) <- ``customer``: the customers tagged with a registry segment
  (the analogue of the registry's tag filter), punctuated document.
* status exports (SOA) <- all ``orders``, with the debtor name from ``customer``; the
  order priority picks one of the five status files; the document carries a float-style
  ``.0`` tail; cheap orders have no unique id, the cheapest no document; some dates are
  month-first or no date at all.

What a row looks like is decided by attributes (segment, price, event value), never by
sampling ids, and every query reads the whole tables.
The same derivation in DuckDB SQL is ``fixture_sql()`` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.dates import render_timestamp

# Fixed values of the fixture derivation.
EVENT_TYPE_TO_TIPO = {
    "purchase": "INCLUSAO",
    "signup": " inclusao ",
    "click": "EXCLUSAO",
    "error": "EXCLUSAO",
}
OTHER_TIPO = "CONSULTA"
REGISTRY_SEGMENTS = ("HOUSEHOLD", "MACHINERY", "BUILDING")
# Events of the type outside the enum have no document below the first value, a blank one below the second.
NO_DOCUMENT_BELOW, BLANK_DOCUMENT_BELOW = 25.0, 50.0
BLANK_DOCUMENT = "   "
FLOAT_TAIL_EVENT, FLOAT_TAIL_FROM = "signup", 100.0
NO_TIPO_EVENT, NO_TIPO_BELOW = "click", 1.0
NO_DATE_EVENT, NO_DATE_BELOW = "error", 2.0
# Orders below these prices: no document; no date; a month-first date.
ORDER_NO_DOCUMENT_BELOW, ORDER_NO_DATE_BELOW, ORDER_MONTH_FIRST_BELOW = 3000.0, 10000.0, 30000.0
NO_DATE_TEXT = "sem data"
UID_MIN_PRICE = 50000.0
UID_PREFIX = "UID-"
DOC_WIDTH = 11
# Status file per order-priority digit: (rank, fonte).
PRIORITY_TO_STATUS = {
    "1": (1, "Ativas"),
    "2": (2, "Baixadas"),
    "3": (3, "Pendentes"),
    "4": (4, "Determinacao"),
    "5": (5, "Erros"),
}


_TABLES: dict[tuple[str, str], DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table, resolved once per application (file listing and footer schema).

    The provided tables are immutable inputs, so like a catalog table they keep
    their resolved relation; every query still scans the whole table.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _padded(c: Column) -> Column:
    return F.lpad(c.cast("string"), DOC_WIDTH, "0")


def punctuated(c: Column) -> Column:
    """``00000001234`` -> ``000.000.012-34`` (CPF layout)."""
    k = _padded(c)
    return F.concat(
        F.substring(k, 1, 3), F.lit("."), F.substring(k, 4, 3), F.lit("."),
        F.substring(k, 7, 3), F.lit("-"), F.substring(k, 10, 2),
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CNM: ``id bigint, documento, tipo, data_hora timestamp_ntz, ord bigint``."""
    ev = _table(spark, sf_dir, "events")
    kind, value = F.col("event_type"), F.col("value")
    tipo = F.lit(OTHER_TIPO)
    for event_type, t in reversed(list(EVENT_TYPE_TO_TIPO.items())):
        tipo = F.when(kind == event_type, F.lit(t)).otherwise(tipo)
    other = ~kind.isin(*EVENT_TYPE_TO_TIPO)
    documento = (F.when(other & (value < NO_DOCUMENT_BELOW), F.lit(None).cast("string"))
                 .when(other & (value < BLANK_DOCUMENT_BELOW), F.lit(BLANK_DOCUMENT))
                 .when((kind == FLOAT_TAIL_EVENT) & (value >= FLOAT_TAIL_FROM), F.concat(_padded(F.col("user_id")), F.lit(".0")))
                 .otherwise(punctuated(F.col("user_id"))))
    return ev.select(
        F.col("event_id").alias("id"),
        documento.alias("documento"),
        F.when((kind == NO_TIPO_EVENT) & (value < NO_TIPO_BELOW), F.lit(None).cast("string")).otherwise(tipo).alias("tipo"),
        F.when((kind == NO_DATE_EVENT) & (value < NO_DATE_BELOW), F.lit(None)).otherwise(F.col("ts")).alias("data_hora"),
        F.col("event_id").alias("ord"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole registry before its tag filter: ``cpf_cnpj, nome, tag, ord bigint``."""
    return _table(spark, sf_dir, "customer").select(
        punctuated(F.col("c_custkey")).alias("cpf_cnpj"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("tag"),
        F.col("c_custkey").alias("ord"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SGP: ``cpf_cnpj, nome, tag, ord bigint`` (already limited to the registry tags)."""
    return customers(spark, sf_dir).where(F.col("tag").isin(*REGISTRY_SEGMENTS))


def status_exports(spark: SparkSession, sf_dir: str, fontes: tuple[str, ...] | None = None) -> DataFrame:
    """SOA: ``documento, devedor, unique_id, data, fonte, source_rank int, ord bigint``.

    ``fontes`` restricts to some status files (``('Ativas',)`` for the two-way
    reports); it becomes a prefix predicate that reaches the Parquet scan.
    """
    orders = _table(spark, sf_dir, "orders")
    if fontes is not None:
        digits = [d for d, (_, f) in PRIORITY_TO_STATUS.items() if f in fontes]
        cond = F.lit(False)
        for d in digits:
            cond = cond | F.col("o_orderpriority").startswith(d)
        orders = orders.where(cond)
    cust = _table(spark, sf_dir, "customer")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    price, date = F.col("o_totalprice"), F.col("o_orderdate")
    data = (F.when(price < ORDER_NO_DATE_BELOW, F.lit(NO_DATE_TEXT))
            .when(price < ORDER_MONTH_FIRST_BELOW, F.date_format(date, "MM/dd/yyyy"))
            .otherwise(render_timestamp(date)))
    digit = F.substring(F.col("o_orderpriority"), 1, 1)
    rank = F.lit(None).cast("int")
    fonte = F.lit(None).cast("string")
    for d, (r, f) in reversed(list(PRIORITY_TO_STATUS.items())):
        rank = F.when(digit == d, F.lit(r)).otherwise(rank)
        fonte = F.when(digit == d, F.lit(f)).otherwise(fonte)
    return joined.select(
        F.when(price < ORDER_NO_DOCUMENT_BELOW, F.lit(None).cast("string"))
        .otherwise(F.concat(_padded(F.col("o_custkey")), F.lit(".0"))).alias("documento"),
        F.col("c_name").alias("devedor"),
        F.when(F.col("o_totalprice") < UID_MIN_PRICE, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(UID_PREFIX), F.col("o_orderkey").cast("string")))
        .alias("unique_id"),
        data.alias("data"),
        fonte.alias("fonte"),
        rank.alias("source_rank"),
        F.col("o_orderkey").alias("ord"),
    )


def _case_sql(column: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"case {column} {whens} else '{default}' end"


def _punctuated_sql(k: str) -> str:
    return (
        f"concat(substr({k},1,3),'.',substr({k},4,3),'.',substr({k},7,3),'-',substr({k},10,2))"
    )


def fixture_sql() -> str:
    """The three fixture ledgers as DuckDB CTEs (without the leading WITH)."""
    segs = ", ".join(f"'{s}'" for s in REGISTRY_SEGMENTS)
    known = ", ".join(f"'{t}'" for t in EVENT_TYPE_TO_TIPO)
    fonte_case = _case_sql("substr(o_orderpriority,1,1)", {d: f for d, (_, f) in PRIORITY_TO_STATUS.items()}, "")
    return f"""
fx_movements as (
  select event_id as id,
         case when event_type not in ({known}) and value < {NO_DOCUMENT_BELOW} then null
              when event_type not in ({known}) and value < {BLANK_DOCUMENT_BELOW} then '{BLANK_DOCUMENT}'
              when event_type = '{FLOAT_TAIL_EVENT}' and value >= {FLOAT_TAIL_FROM} then concat(k, '.0')
              else {_punctuated_sql('k')} end as documento,
         case when event_type = '{NO_TIPO_EVENT}' and value < {NO_TIPO_BELOW} then null
              else {_case_sql('event_type', EVENT_TYPE_TO_TIPO, OTHER_TIPO)} end as tipo,
         case when event_type = '{NO_DATE_EVENT}' and value < {NO_DATE_BELOW} then null else ts end as data_hora,
         event_id as ord
  from (select *, lpad(cast(user_id as varchar), {DOC_WIDTH}, '0') as k from events) e),
fx_customers as (
  select {_punctuated_sql('k')} as cpf_cnpj, c_name as nome, c_mktsegment as tag, c_custkey as ord
  from (select *, lpad(cast(c_custkey as varchar), {DOC_WIDTH}, '0') as k from customer) c),
fx_registry as (select * from fx_customers where tag in ({segs})),
fx_status_exports as (
  select case when o_totalprice < {ORDER_NO_DOCUMENT_BELOW} then null
              else concat(lpad(cast(o_custkey as varchar), {DOC_WIDTH}, '0'), '.0') end as documento,
         c_name as devedor,
         case when o_totalprice < {UID_MIN_PRICE} then null
              else concat('{UID_PREFIX}', cast(o_orderkey as varchar)) end as unique_id,
         case when o_totalprice < {ORDER_NO_DATE_BELOW} then '{NO_DATE_TEXT}'
              when o_totalprice < {ORDER_MONTH_FIRST_BELOW} then strftime(o_orderdate, '%m/%d/%Y')
              else strftime(o_orderdate, '%d/%m/%Y %H:%M') end as data,
         {fonte_case} as fonte,
         cast(substr(o_orderpriority,1,1) as integer) as source_rank,
         o_orderkey as ord
  from orders left join customer on o_custkey = c_custkey)"""


# Header spellings of the landed fixture files, as the portals export them.
MOVEMENT_HEADERS = {"id": "Id", "documento": "Documento", "tipo": "Tipo", "data_hora": "Data / Hora"}
REGISTRY_HEADERS = {"cpf_cnpj": "CPF/CNPJ", "nome": "Nome/Razão Social"}
EXPORT_HEADERS = {
    "Ativas": {"unique_id": "+//3//f/9-Unique ID", "documento": "+ACI-Documento+ACI-", "devedor": "Devedor",
               "data": "Data Inclus+//3//Q-o"},
    "Baixadas": {"documento": "Documento", "devedor": "Devedor", "unique_id": "Unique ID",
                 "data": "Data Exclusão"},
}
# Columns the portals repeat: a second spelling that decodes to the same name, and a second date column.
EXPORT_REPEATS = {
    "Pendentes": {"data": "Data Exclusão"},
    "Determinacao": {"documento": "+ACI-Documento+ACI-", "data": "Data Exclusão"},
}
DEFAULT_EXPORT_HEADERS = {"documento": "Documento", "devedor": "Devedor", "unique_id": "Unique ID",
                          "data": "Data Inclusão"}


# Fixed value: the character of the debtors' names that becomes a line break where names are landed over two lines.
NAME_MARK = "#"


def _write_csv_in_order(df: DataFrame, order: str, path: str) -> None:
    """CSV parts whose file-name order and row order follow ``order`` (range partitioned)."""
    (df.repartitionByRange(order).sortWithinPartitions(order).drop(order)
     .write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def land_fixture(spark: SparkSession, sf_dir: str, folder: str, line_breaks: bool = False) -> str:
    """Write the fixture ledgers as landed files (CSV folders with the portal headers).

    With ``line_breaks`` the debtor names of the status exports are written over two lines.

    Movement timestamps are written as day-first text, so the scan parses them
    back; each status export gets the header spelling of its portal tab.
    """
    from ledgerspark.sources.exports import STATUS_FILES

    folder = folder.rstrip("/")
    mv = movements(spark, sf_dir)
    day_first = F.date_format(F.col("data_hora"), "dd/MM/yyyy HH:mm:ss")
    _write_csv_in_order(
        mv.select(F.col("ord").alias("_o"), *[(day_first if c == "data_hora" else F.col(c)).alias(h)
                                             for c, h in MOVEMENT_HEADERS.items()]),
        "_o", f"{folder}/Relatorio_CNM.csv")
    rg = registry(spark, sf_dir)
    _write_csv_in_order(rg.select(F.col("ord").alias("_o"), *[F.col(c).alias(h) for c, h in REGISTRY_HEADERS.items()]),
                        "_o", f"{folder}/Relatorio_SGP.csv")
    for _, fonte, name in STATUS_FILES:
        se = status_exports(spark, sf_dir, fontes=(fonte,))
        if line_breaks:
            se = se.withColumn("devedor", F.replace("devedor", F.lit(NAME_MARK), F.lit("\n")))
        cols = EXPORT_HEADERS.get(fonte, DEFAULT_EXPORT_HEADERS)
        repeats = [F.lit("repeated").alias(h) for h in EXPORT_REPEATS.get(fonte, {}).values()]
        _write_csv_in_order(se.select(F.col("ord").alias("_o"), *[F.col(c).alias(h) for c, h in cols.items()], *repeats),
                            "_o", f"{folder}/{name}")
    return folder


# How the fixture arrives as a stream — movement loads split at these
# event times, status files landing in reverse rank order, one step per tuple.
MOVEMENT_LOAD_SPLITS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
EXPORT_LOAD_STEPS = (("Erros", "Determinacao"), ("Pendentes", "Baixadas"), ("Ativas",))


def fixture_loads(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    """The fixture ledgers cut into arrival steps: ``[{ledger: rows landing in this step}]``.

    Movements arrive by event-time range, the registry in the first step, the
    status files one or two at a time; together the steps hold every row once.
    """
    mv = movements(spark, sf_dir)
    ts = F.col("data_hora")
    bounds = [None, *MOVEMENT_LOAD_SPLITS, None]
    steps = []
    for i, fontes in enumerate(EXPORT_LOAD_STEPS):
        lo, hi = bounds[i], bounds[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (ts >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            cond = cond & (ts < F.lit(hi).cast("timestamp_ntz"))
        if i == 0:
            cond = cond | ts.isNull()  # movements without a time arrive first
        step = {"movements": mv.where(cond), "status_exports": status_exports(spark, sf_dir, fontes=fontes)}
        if i == 0:
            step["registry"] = registry(spark, sf_dir)
        steps.append(step)
    return steps


# The second header spelling of the movement workbooks, and the registry's preamble.
MOVEMENT_HEADERS_2 = {"tipo": "+ACI-Tipo+ACI-", "id": "Id", "data_hora": "Data / Hora", "documento": " Documento"}
REGISTRY_PREAMBLE = [["Relatório de clientes"], [], ["Filtro", "NEGATIVADO"], [], [], ["Página 1"], [], ["Linhas"]]


def land_fixture_workbooks(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Like ``land_fixture``, but the movement register and the registry land as workbooks.

    Each is a folder of part workbooks in ``ord`` order (one per range partition), the later half of the
    movements under another header; every registry part starts with the 8-row report preamble, some
    rows of it blank. Status exports land as CSV, as the portal exports them.
    """
    from ledgerspark.sources.workbook import write_workbooks

    folder = land_fixture(spark, sf_dir, folder)
    mv = movements(spark, sf_dir)
    middle = (mv.agg(F.max("ord")).first()[0] or 0) // 2
    for part, rows, names in (("1", mv.where(F.col("ord") <= middle), MOVEMENT_HEADERS),
                              ("2", mv.where(F.col("ord") > middle), MOVEMENT_HEADERS_2)):
        cols = [F.col(c).alias(h) for c, h in names.items()]
        write_workbooks(rows.repartitionByRange("ord").sortWithinPartitions("ord").select(*cols),
                        f"{folder}/Relatorio_CNM.xlsx/{part}").collect()
    rg = registry(spark, sf_dir)
    rg_cols = [F.col(c).alias(h) for c, h in REGISTRY_HEADERS.items()]
    write_workbooks(rg.repartitionByRange("ord").sortWithinPartitions("ord").select(*rg_cols),
                    f"{folder}/Relatorio_SGP.xlsx", preamble=REGISTRY_PREAMBLE).collect()
    return folder
