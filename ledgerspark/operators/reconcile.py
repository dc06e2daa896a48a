"""Relational operators of the reconciliation: UN1, JN1-JN7, AG1-AG6, PRJ1.

Shape of every report: project each ledger to ``(documento, ledger tag, order
key, payload)``, union them, and run **one** ``groupBy(documento)`` that yields
presence flags, the first row of each ledger and per-document counts. That is
one exchange per report, and the aggregation is partial before the shuffle,
so a hot key (for example the ``''`` document that all blank ids collapse into)
reaches the reducer as one partial row per map task instead of all its rows.

The join forms (JN4-JN6) are kept as independent formulations: they first
reduce each ledger to one row per document (again a partial aggregation) and
then full-outer-join co-partitioned inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOC = "documento"
_SYS = "_ledger"


@dataclass
class Ledger:
    """One ledger's contribution to a reconciliation.

    ``key`` is the normalised document expression; ``payload`` the columns kept
    from the ledger's first row; ``order`` the columns that define "first";
    ``count_non_null`` the payload columns whose non-null rows are counted (AG3);
    ``sources`` an optional ``(rank, name)`` pair collected per document (AG2).
    """

    name: str
    df: DataFrame
    key: Column
    payload: list[str] = field(default_factory=list)
    order: list[str] = field(default_factory=list)
    count_non_null: list[str] = field(default_factory=list)
    sources: tuple[str, str] | None = None

    @property
    def tag(self) -> str:
        return self.name.lower()


def tag_source(df: DataFrame, name: str, column: str = "fonte") -> DataFrame:
    """PRJ1: constant column naming the file/ledger a row came from."""
    return df.withColumn(column, F.lit(name))


def concat_sources(*dfs: DataFrame) -> DataFrame:
    """UN1: vertical concat by column name; missing columns become null, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def document_keys(df: DataFrame, key: Column) -> DataFrame:
    """AG5: distinct normalised keys of one ledger."""
    return df.select(key.alias(DOC)).distinct()


def document_universe(*keyed: tuple[DataFrame, Column]) -> DataFrame:
    """JN1/JN2: distinct union of the keys of several ledgers (one exchange)."""
    return concat_sources(*[df.select(k.alias(DOC)) for df, k in keyed]).distinct()


def registry_key_rows(df: DataFrame, key: Column) -> DataFrame:
    """The normalised keys of a ledger, one per row (duplicates kept), as ``documento``."""
    return df.select(key.alias(DOC))


def with_registry_flag(df: DataFrame, key: Column, registry_keys: DataFrame, flag: str = "in_registry") -> DataFrame:
    """JN3: add a membership flag of ``key`` in a key set, keeping every row of ``df`` exactly once.

    One lazy left join with the distinct keys; the optimizer broadcasts them when they
    are small. The distinct also groups by the key's length, which the key decides, so that
    its partitioning is not taken for the join's: both join inputs are then plain shuffle
    reads, and AQE splits a skewed document of ``df``.
    """
    k = F.col(DOC)
    keys = registry_keys.select(k.alias("_k"), F.length(k).alias("_n")).distinct()
    out = df.withColumn("_k", key).join(keys.select("_k", F.lit(True).alias(flag)), "_k", "left")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop("_k")


def flag_documents(per_document: DataFrame, registry_keys: DataFrame, flag: str = "in_registry") -> DataFrame:
    """JN3 for a relation that already has one row per document (no skew possible).

    A left join with the distinct keys; both sides end up partitioned by the
    document, so Catalyst adds no exchange for ``per_document`` (or broadcasts
    the keys when they are small).
    """
    keys = registry_keys.select(F.col(DOC)).distinct().withColumn(flag, F.lit(True))
    out = per_document.join(keys, DOC, "left")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def only_in(df: DataFrame, other: DataFrame, on: str = DOC) -> DataFrame:
    """JN7: rows of ``df`` whose key is absent from ``other`` (left anti)."""
    return df.join(other.select(on), on, "left_anti")


def in_both(df: DataFrame, other: DataFrame, on: str = DOC) -> DataFrame:
    """JN7: rows of ``df`` whose key is present in ``other`` (left semi)."""
    return df.join(other.select(on), on, "left_semi")


def tagged_rows(lg: Ledger) -> DataFrame:
    """One ledger's rows as ``documento, _ledger`` and its row, order key and source, each under the ledger's name."""
    cols = [lg.key.alias(DOC), F.lit(lg.name).alias(_SYS)]
    if lg.payload:
        cols.append(F.struct(*[F.col(c) for c in lg.payload]).alias(f"_{lg.tag}_row"))
        cols.append(F.struct(*[F.col(c) for c in lg.order]).alias(f"_{lg.tag}_ord"))
    if lg.sources:
        rank, name = lg.sources
        cols.append(F.struct(F.col(rank).alias("rank"), F.col(name).alias("name")).alias(f"_{lg.tag}_src"))
    return lg.df.select(*cols)


def reconcile(*ledgers: Ledger) -> DataFrame:
    """JN1 + JN4 + AG1 + AG2 + AG3 + AG6 in a single aggregation.

    Output, per document: ``in_<ledger>`` (AG6), ``<ledger>_first`` struct of the
    payload of the ledger's first row by its order key (AG1; null payload values
    are kept), ``<ledger>_<col>_n`` non-null counts (AG3) and ``<ledger>_sources``
    (AG2, sorted by rank).
    """
    union = concat_sources(*[tagged_rows(lg) for lg in ledgers])
    aggs = []
    for lg in ledgers:
        aggs.append(F.bool_or(F.col(_SYS) == F.lit(lg.name)).alias(f"in_{lg.tag}"))
        if lg.payload:
            aggs.append(F.min_by(F.col(f"_{lg.tag}_row"), F.col(f"_{lg.tag}_ord")).alias(f"{lg.tag}_first"))
            for c in lg.count_non_null:
                aggs.append(F.count(F.col(f"_{lg.tag}_row.{c}")).alias(f"{lg.tag}_{c}_n"))
        if lg.sources:
            aggs.append(F.array_sort(F.collect_set(F.col(f"_{lg.tag}_src"))).alias(f"_{lg.tag}_src"))
    out = union.groupBy(DOC).agg(*aggs)
    for lg in ledgers:
        if lg.sources:
            out = out.withColumn(f"{lg.tag}_sources", F.transform(F.col(f"_{lg.tag}_src"), lambda s: s["name"]))
            out = out.drop(f"_{lg.tag}_src")
    return out


def first_rows(df: DataFrame, key: Column, payload: list[str], order: list[str],
               count_non_null: tuple[str, ...] = ()) -> DataFrame:
    """AG1: first row per document by ``order``; one row per document.

    For the columns in ``count_non_null`` the same aggregation counts the non-null rows (``<col>_n``).

    ``min_by`` over a struct is merged map-side, so a document with a third of
    all rows costs one partial row per task before the shuffle.
    """
    row = F.min_by(F.struct(*[F.col(f"_in_{c}").alias(c) for c in payload]), F.struct(*[F.col(f"_in_{c}") for c in order]))
    return (
        df.select(key.alias(DOC), *[F.col(c).alias(f"_in_{c}") for c in sorted({*payload, *order, *count_non_null})])
        .groupBy(DOC)
        .agg(row.alias("_first"), *[F.count(f"_in_{c}").alias(f"{c}_n") for c in count_non_null])
        .select(DOC, *[F.col(f"_first.{c}").alias(c) for c in payload], *[f"{c}_n" for c in count_non_null])
    )


def full_outer(left: DataFrame, right: DataFrame, left_flag: str, right_flag: str) -> DataFrame:
    """JN4-JN6: full outer join of two one-row-per-document relations with presence flags.

    Both sides come hash-partitioned by the key from their aggregation. A full join's output is
    not (either side's key may be null), so a further join on its key adds an exchange.
    """
    lf = left.withColumn(left_flag, F.lit(True))
    rf = right.withColumn(right_flag, F.lit(True))
    out = lf.join(rf, DOC, "full")
    return out.fillna(False, subset=[left_flag, right_flag])


def presence_flags(*keyed: tuple[str, DataFrame, Column]) -> DataFrame:
    """AG6: one row per document with a boolean per ledger (``in_<name>``)."""
    return reconcile(*[Ledger(name, df, key) for name, df, key in keyed])
