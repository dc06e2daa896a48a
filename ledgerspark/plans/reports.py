"""End-to-end reports Q1-Q5 over canonical ledgers.

Canonical ledgers (any source: fixture tables, CSV/workbook scans, streams):

* movements: ``id, documento, tipo, data_hora (timestamp or text), ord``
* registry: ``cpf_cnpj, nome, ord``
* status exports: ``documento, devedor, unique_id, data, fonte, source_rank, ord``

Every report is one ``groupBy('documento')`` over the tagged union of its
ledgers (see ``operators.reconcile``) followed by a projection, so each plan has
a single exchange on the document key plus partial aggregation before it.
Output columns use ASCII snake_case names; the sinks rename them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions.badges import join_badges, or_placeholder, priority_pick, source_tag
from ledgerspark.functions.dates import format_movement_date, parse_movement_timestamp
from ledgerspark.functions.entities import html_unescape
from ledgerspark.functions.keys import canonical_type, int_id, key_function, strip_non_word, text_or_nan
from ledgerspark.operators import status as st
from ledgerspark.operators.reconcile import (
    DOC,
    Ledger,
    document_keys,
    first_rows,
    flag_documents,
    full_outer,
    reconcile,
    registry_key_rows,
    with_registry_flag,
)

REPORT_COLUMNS = ["id", DOC, "nome", "data", "tipo", "local", "status"]
SOA_REGISTRY_COLUMNS = ["id", DOC, "nome", "data_inclusao", "local", "tipo", "status"]


# A key mode for all ledgers, or one per ledger (``CNM``, ``SGP``, ``SOA``).
KeyModes = str | Mapping[str, str]
# The current report's own mix: loose keys for the two registers, strict ones for the exports.
REGISTER_LOOSE = {"CNM": "loose", "SGP": "loose", "SOA": "strict"}


def _key(df: DataFrame, column: str, modes: KeyModes, ledger: str) -> Column:
    mode = modes if isinstance(modes, str) else modes[ledger]
    return key_function(mode)(F.col(column), df.schema[column].dataType)


def _movement_date(movements: DataFrame, c: Column) -> Column:
    return format_movement_date(c, movements.schema["data_hora"].dataType)


def _cnm(movements: DataFrame, mode: KeyModes) -> Ledger:
    return Ledger("CNM", movements, _key(movements, "documento", mode, "CNM"),
                  payload=["tipo", "data_hora", "id"], order=["ord"])


def _sgp(registry: DataFrame, mode: KeyModes, with_name: bool = False) -> Ledger:
    return Ledger("SGP", registry, _key(registry, "cpf_cnpj", mode, "SGP"),
                  payload=["nome"] if with_name else [], order=["ord"] if with_name else [])


def _soa(exports: DataFrame, mode: KeyModes, with_sources: bool = False) -> Ledger:
    return Ledger("SOA", exports, _key(exports, "documento", mode, "SOA"),
                  payload=["devedor", "unique_id", "data", "fonte"], order=["source_rank", "ord"],
                  count_non_null=["unique_id"],
                  sources=("source_rank", "fonte") if with_sources else None)


def unified_report(movements: DataFrame, registry: DataFrame, status_exports: DataFrame,
                   key_mode: KeyModes = "strict", with_sources: bool = False) -> DataFrame:
    """Q1: one row per document of CNM ∪ SOA ∪ SGP, classified by ST1.

    tipo/data come from the first movement, else from the first status-export
    row (its file name and raw date), else ``-``; nome from the first export row;
    id is that row's unique id unless all of the document's export ids are null.
    """
    r = reconcile(*unified_ledgers(movements, registry, status_exports, key_mode, with_sources))
    return r.select(*unified_columns(F.col, movements.schema["data_hora"].dataType, with_sources))


def unified_ledgers(movements: DataFrame, registry: DataFrame, status_exports: DataFrame, key_mode: KeyModes = "strict",
                    with_sources: bool = False) -> list[Ledger]:
    """What each ledger contributes to the unified report."""
    return [_cnm(movements, key_mode), _soa(status_exports, key_mode, with_sources), _sgp(registry, key_mode)]


def all_ledgers(movements: DataFrame, registry: DataFrame, status_exports: DataFrame,
                key_mode: KeyModes = "strict") -> list[Ledger]:
    """What any of the reports needs of each ledger."""
    return [_cnm(movements, key_mode), _soa(status_exports, key_mode, with_sources=True), _sgp(registry, key_mode, with_name=True)]


def unified_columns(r: Callable[[str], Column], date: T.DataType, with_sources: bool = False) -> list[Column]:
    """The columns of the unified report over a reconciliation's columns, which ``r`` names."""
    cnm, soa, sgp = r("in_cnm"), r("in_soa"), r("in_sgp")
    c, s = r("cnm_first"), r("soa_first")
    tipo = priority_pick((cnm, c["tipo"]), (soa, s["fonte"]))
    return [
        F.when(r("soa_unique_id_n") > 0, s["unique_id"]).otherwise(F.lit("-")).alias("id"),
        F.col(DOC),
        or_placeholder(soa, s["devedor"]).alias("nome"),
        priority_pick((cnm, format_movement_date(c["data_hora"], date)), (soa, s["data"])).alias("data"),
        tipo.alias("tipo"),
        join_badges(("CNM", cnm), ("SOA", soa), ("SGP", sgp)).alias("local"),
        st.status_by_type(sgp, tipo).alias("status"),
        *([sources_with_movement_tag(r("soa_sources"), cnm, c["tipo"]).alias("fontes")] if with_sources else []),
    ]


def sources_with_movement_tag(soa_sources: Column, in_cnm: Column, raw_tipo: Column) -> Column:
    """AG2 + FN13: export files of the document in order, then the movement tag."""
    base = F.coalesce(soa_sources, F.array().cast("array<string>"))
    return F.when(in_cnm, F.array_append(base, source_tag(raw_tipo))).otherwise(base)


def unified_report_join_form(movements: DataFrame, registry: DataFrame, status_exports: DataFrame,
                             key_mode: KeyModes = "strict") -> DataFrame:
    """Q1 as per-ledger first rows + two full outer joins (independent formulation)."""
    cnm = first_rows(movements, _key(movements, "documento", key_mode, "CNM"), ["tipo", "data_hora"], ["ord"])
    soa = first_rows(status_exports, _key(status_exports, "documento", key_mode, "SOA"),
                     ["devedor", "unique_id", "data", "fonte"], ["source_rank", "ord"], count_non_null=("unique_id",))
    sgp = document_keys(registry, _key(registry, "cpf_cnpj", key_mode, "SGP"))
    j = full_outer(cnm, soa, "in_cnm", "in_soa")
    j = full_outer(j, sgp, "_left", "in_sgp").drop("_left")
    cnm_, soa_, sgp_ = F.col("in_cnm"), F.col("in_soa"), F.col("in_sgp")
    tipo = priority_pick((cnm_, F.col("tipo")), (soa_, F.col("fonte")))
    return j.select(
        F.when(F.coalesce(F.col("unique_id_n"), F.lit(0)) > 0, F.col("unique_id")).otherwise(F.lit("-")).alias("id"),
        F.col(DOC),
        or_placeholder(soa_, F.col("devedor")).alias("nome"),
        priority_pick((cnm_, _movement_date(movements, F.col("data_hora"))), (soa_, F.col("data"))).alias("data"),
        tipo.alias("tipo"),
        join_badges(("CNM", cnm_), ("SOA", soa_), ("SGP", sgp_)).alias("local"),
        st.status_by_type(sgp_, tipo).alias("status"),
    )


def clean_export_text(c: Column) -> Column:
    """Legacy export cleaning: stringify (null -> ``nan``), then decode entities."""
    return html_unescape(text_or_nan(c))


def clean_export_texts(*cols: Column) -> list[Column]:
    """``clean_export_text`` of several columns through one shared expression."""
    cleaned = F.transform(F.array(*[text_or_nan(c) for c in cols]), lambda x: html_unescape(x))
    return [cleaned[i] for i in range(len(cols))]


def unified_presence_report(movements: DataFrame, registry: DataFrame, active_exports: DataFrame,
                            key_mode: KeyModes = "strict") -> DataFrame:
    """Q2: presence-only three-way report (ST3) with the active-status export only.

    id: export unique id (entities decoded, non-word characters removed), else the
    movement id as an integer, else ``-``; nome: export debtor else ``-``;
    data: export date, else the formatted movement date, else ``-``.
    """
    r = reconcile(_cnm(movements, key_mode), _soa(active_exports, key_mode), _sgp(registry, key_mode))
    return presence_rows(r, movements.schema["data_hora"].dataType)


def presence_rows(r: DataFrame, date: T.DataType) -> DataFrame:
    """Q2's rows of a reconciliation of the three ledgers."""
    cnm, soa, sgp = F.col("in_cnm"), F.col("in_soa"), F.col("in_sgp")
    c, s = F.col("cnm_first"), F.col("soa_first")
    tipo, status = st.status_by_presence(cnm, soa, sgp)
    uid, devedor, data = clean_export_texts(s["unique_id"], s["devedor"], s["data"])
    return r.select(
        priority_pick((soa, strip_non_word(uid)), (cnm, int_id(c["id"]))).alias("id"),
        F.col(DOC),
        or_placeholder(soa, devedor).alias("nome"),
        priority_pick((soa, data), (cnm, format_movement_date(c["data_hora"], date))).alias("data"),
        tipo.alias("tipo"),
        join_badges(("CNM", cnm), ("SOA", soa), ("SGP", sgp)).alias("local"),
        status.alias("status"),
    )


def cnm_registry_report(movements: DataFrame, registry: DataFrame, key_mode: KeyModes = "strict") -> DataFrame:
    """Q3: movements × registry (ST4, raw case-sensitive type); absent values are ``''``."""
    r = reconcile(_cnm(movements, key_mode), _sgp(registry, key_mode, with_name=True))
    return cnm_registry_rows(r, movements.schema["data_hora"].dataType)


def cnm_registry_rows(r: DataFrame, date: T.DataType) -> DataFrame:
    """Q3's rows of a reconciliation of movements and registry."""
    cnm, sgp = F.col("in_cnm"), F.col("in_sgp")
    c, g = F.col("cnm_first"), F.col("sgp_first")
    tipo = or_placeholder(cnm, c["tipo"], "")
    return r.select(
        or_placeholder(cnm, int_id(c["id"]), "").alias("id"),
        F.col(DOC),
        or_placeholder(sgp, g["nome"], "").alias("nome"),
        or_placeholder(cnm, format_movement_date(c["data_hora"], date), "").alias("data"),
        tipo.alias("tipo"),
        join_badges(("CNM", cnm), ("SGP", sgp)).alias("local"),
        st.status_cnm_registry(cnm, c["tipo"], sgp).alias("status"),
    )


def soa_registry_report(active_exports: DataFrame, registry: DataFrame, key_mode: KeyModes = "strict") -> DataFrame:
    """Q4: active-status export × registry (ST5); nome from the export, else the registry."""
    return soa_registry_rows(reconcile(_soa(active_exports, key_mode), _sgp(registry, key_mode, with_name=True)))


def soa_registry_rows(r: DataFrame) -> DataFrame:
    """Q4's rows of a reconciliation of active exports and registry."""
    soa, sgp = F.col("in_soa"), F.col("in_sgp")
    s, g = F.col("soa_first"), F.col("sgp_first")
    tipo, status = st.status_exports_registry(soa, sgp)
    uid, devedor, data = clean_export_texts(s["unique_id"], s["devedor"], s["data"])
    return r.select(
        or_placeholder(soa, strip_non_word(uid)).alias("id"),
        F.col(DOC),
        priority_pick((soa, devedor), (sgp, g["nome"])).alias("nome"),
        or_placeholder(soa, data).alias("data_inclusao"),
        join_badges(("SOA", soa), ("SGP", sgp)).alias("local"),
        tipo.alias("tipo"),
        status.alias("status"),
    )


def movement_status_rows(movements: DataFrame, registry: DataFrame, key_mode: KeyModes = "strict") -> DataFrame:
    """ST2 per movement row: every movement with its registry flag and status."""
    keys = registry_key_rows(registry, _key(registry, "cpf_cnpj", key_mode, "SGP"))
    flagged = with_registry_flag(movements, _key(movements, "documento", key_mode, "CNM"), keys)
    return flagged.withColumn("status", st.movement_status(F.col("tipo"), F.col("in_registry")))


def movement_status_counts(movements: DataFrame, registry: DataFrame, key_mode: KeyModes = "strict") -> DataFrame:
    """Q5 (ST2 + AG4): number of movements per row-level status, most frequent first.

    Movements are first reduced to one row per document with a count per type
    class (inclusion, exclusion, other) — a partial aggregation, so a document
    holding a third of all rows costs one row per map task — and that relation,
    already partitioned by document, meets the registry keys without another
    exchange. Each class then goes through the ST2 rule and the counts add up.
    """
    key = _key(movements, "documento", key_mode, "CNM")
    t = F.col("_t")
    per_doc = (movements.select(key.alias(DOC), canonical_type(F.col("tipo")).alias("_t")).groupBy(DOC)
               .agg(F.count(F.when(t == st.INCLUSAO, 1)).alias("_inc"),
                    F.count(F.when(t == st.EXCLUSAO, 1)).alias("_exc"),
                    F.count(F.lit(1)).alias("_all")))
    keys = registry_key_rows(registry, _key(registry, "cpf_cnpj", key_mode, "SGP"))
    flagged = flag_documents(per_doc, keys)
    classes = F.inline(F.array(
        F.struct(F.lit(st.INCLUSAO).alias("_t"), F.col("_inc").alias("_n")),
        F.struct(F.lit(st.EXCLUSAO).alias("_t"), F.col("_exc").alias("_n")),
        F.struct(F.lit(None).cast("string").alias("_t"),
                 (F.col("_all") - F.col("_inc") - F.col("_exc")).alias("_n")),
    ))
    per_class = flagged.select("in_registry", classes).where(F.col("_n") > 0)
    return status_counts(per_class.withColumn("status", st.movement_status(F.col("_t"), F.col("in_registry"))),
                         weight="_n")


def status_counts(df: DataFrame, column: str = "status", weight: str | None = None) -> DataFrame:
    """AG4: frequency per value, nulls dropped, most frequent first (ties by value)."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(n.cast("bigint").alias("count"))
            .orderBy(F.desc("count"), F.asc(column)))


def intake_report(movements: DataFrame, registry: DataFrame, status_exports: DataFrame,
                  key_mode: KeyModes = "strict") -> DataFrame:
    """Rows, blank documents and unreadable dates per ledger (``ledger, rows, blank_documents, unreadable_dates``).

    A document is blank when nothing is left of its key; a date is unreadable when it is missing or cannot be parsed.
    """
    def counted(df: DataFrame, ledger: str, column: str, date: Column | None) -> DataFrame:
        lost = F.lit(0) if date is None else F.count(F.when(date.isNull(), 1))
        return df.agg(F.count(F.lit(1)).alias("rows"),
                      F.count(F.when(_key(df, column, key_mode, ledger) == "", 1)).alias("blank_documents"),
                      lost.cast("bigint").alias("unreadable_dates")).select(F.lit(ledger).alias("ledger"), "*")

    dates = F.col("data_hora")
    if not isinstance(movements.schema["data_hora"].dataType, (T.TimestampType, T.TimestampNTZType)):
        dates = parse_movement_timestamp(dates)
    return (counted(movements, "CNM", "documento", dates).unionByName(counted(registry, "SGP", "cpf_cnpj", None))
            .unionByName(counted(status_exports, "SOA", "documento", parse_movement_timestamp(F.col("data")))))
