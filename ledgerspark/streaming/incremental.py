"""STR4: the unified report kept up to date by a stateful operator per document.

Rows of the streaming ledgers become one-row accumulators of the reconciliation (presence, first row with its
order key, counts, sources). A map-side combiner merges those of a document within a task, column by column, so that a hot
document leaves a task as a row per some hundred thousand rows. After the shuffle ``transformWithState`` keeps one
accumulator per document and merges what arrived; if it changed, the accumulators before and after go out. The report's
columns are computed from both by the same expressions as in the batch report, and only rows whose report changed are kept. So a
micro-batch costs by the documents it touches: no earlier output is read and nothing is compared outside the state.

A group of the operator, a call to the state store and an output batch cost far more than a document's merge. Documents are
therefore grouped by the hash of their key (``BUCKETS``), and those of a slot (``SLOTS`` in each) share a value of the
state, whose fields are named after the ledgers' columns: columns may be added between restarts, and state of the older
form has them as null, which the merge takes for "nothing seen yet". A checkpoint of the form before (a group per document)
cannot be continued.

Results do not depend on the order of arrival: "first" is decided by the order keys. Equal order keys keep the row
that was merged first. A replayed micro-batch starts from the state before it, so it gives the same rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerspark.operators.reconcile import DOC, Ledger, concat_sources, tagged_rows

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Groups of documents by the hash of their key, and values of the state in each. Touching a document rewrites its slot: a few
# documents at a million, some hundred at a hundred millions. The state of a checkpoint lies by these numbers.
BUCKETS, SLOTS = 1 << 14, 1 << 3
# Rows or bytes that a task of the combiner gathers before it merges them.
COMBINED_ROWS, COMBINED_BYTES = 1 << 18, 256 << 20


@contextmanager
def stateful_conf(spark: SparkSession) -> Iterator[None]:
    """Settings a stream of ``unified_changes`` needs when it starts: RocksDB state, encoded so that it can evolve."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.stateStore.encodingFormat": "avro"}
    previous = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def accumulators(*ledgers: Ledger) -> DataFrame:
    """``documento, acc``: every ledger row as the accumulator of itself."""
    rows = concat_sources(*[tagged_rows(lg) for lg in ledgers])
    fields: list[Column] = []
    sets: list[Column] = []  # last, as they are asked for by option
    for lg in ledgers:
        own = F.col("_ledger") == F.lit(lg.name)
        fields.append(own.alias(f"in_{lg.tag}"))
        if lg.payload:
            fields += [F.col(f"_{lg.tag}_row").alias(f"{lg.tag}_first"), F.col(f"_{lg.tag}_ord").alias(f"{lg.tag}_ord")]
            fields += [F.when(F.col(f"_{lg.tag}_row.{c}").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long").alias(f"{lg.tag}_{c}_n")
                       for c in lg.count_non_null]
        if lg.sources:
            sets.append(F.when(own, F.array(F.col(f"_{lg.tag}_src"))).alias(f"{lg.tag}_set"))
    return rows.select(DOC, F.struct(*fields, *sets).alias("acc"))


def _nullable(t: T.DataType) -> T.DataType:
    """The type with every part nullable, as state and Python rows have it."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    return t


class Merge:
    """Merging of two accumulators given as lists in field order; the fields' names say how."""

    def __init__(self, schema: T.StructType):
        self.names = schema.fieldNames()
        self.firsts = [(self.names.index(n), self.names.index(n[:-6] + "_ord")) for n in self.names if n.endswith("_first")]
        self.flags = [i for i, n in enumerate(self.names) if n.startswith("in_")]
        self.counts = [i for i, n in enumerate(self.names) if n.endswith("_n")]
        self.sets = [i for i, n in enumerate(self.names) if n.endswith("_set")]

    def __call__(self, a: list, b: list) -> list:
        out = list(a)
        for i in self.flags:
            out[i] = bool(a[i]) or bool(b[i])
        for i in self.counts:
            out[i] = (a[i] or 0) + (b[i] or 0)
        for i in self.sets:
            both = {_rank(v): v for v in [*(a[i] or []), *(b[i] or [])]}
            out[i] = [both[k] for k in sorted(both)] or None
        for first, order in self.firsts:
            if b[order] is not None and (a[order] is None or _rank(b[order]) < _rank(a[order])):
                out[first], out[order] = b[first], b[order]
        return out


def _rank(value) -> tuple:
    """Sort key of a value as Spark orders it: nulls first, structs field by field (rows and Arrow's dicts alike)."""
    if isinstance(value, dict):
        value = tuple(value.values())
    if isinstance(value, (tuple, list)):
        return tuple(_rank(v) for v in value)
    return (False, 0) if value is None else (True, value)


def _plain(value):
    """Rows and dicts of fields as plain tuples, which the state takes at any depth."""
    if isinstance(value, dict):
        value = tuple(value.values())
    if isinstance(value, tuple):
        return tuple(_plain(v) for v in value)
    return [_plain(v) for v in value] if isinstance(value, list) else value


def _named(value, kind: T.DataType):
    """Plain tuples as dicts of fields again, as output rows take them."""
    if isinstance(kind, T.StructType) and value is not None:
        return {f.name: _named(v, f.dataType) for f, v in zip(kind.fields, value)}
    if isinstance(kind, T.ArrayType) and value is not None:
        return [_named(v, kind.elementType) for v in value]
    return value


def _sort_keys(column: pa.Array) -> list[pa.Array]:
    """Columns that sort, nulls first, as Spark orders ``column``: structs field by field, NaN last."""
    kind = column.type
    if pa.types.is_struct(kind):
        return [column.is_valid(), *(key for part in column.flatten() for key in _sort_keys(part))]
    if pa.types.is_floating(kind):
        return [pc.is_nan(column), column]
    if pa.types.is_nested(kind):
        ranks = [_rank(v) for v in column.to_pylist()]
        place = {r: i for i, r in enumerate(sorted(set(ranks)))}
        return [pa.array([place[r] for r in ranks], pa.int64())]
    return [column]


def _sorted_rows(groups: np.ndarray, column: pa.Array) -> np.ndarray:
    """Row numbers by group, then by ``column``; equal rows stay as they came."""
    keys = [pa.array(groups), *_sort_keys(column), pa.array(np.arange(len(groups)))]
    table = pa.table(keys, names=[str(i) for i in range(len(keys))])
    order = [(name, "ascending") for name in table.column_names]
    return pc.sort_indices(table, sort_keys=order, null_placement="at_start").to_numpy()


def _starts(groups: np.ndarray) -> np.ndarray:
    """Where a sorted column begins a new value."""
    return np.append(True, groups[1:] != groups[:-1])[: len(groups)]


def _merged(batches: list[pa.RecordBatch], merge: Merge) -> pa.RecordBatch:
    """What ``merge`` makes of the rows of every document, column by column."""
    table = pa.Table.from_batches(batches).combine_chunks()
    docs, accs = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns)
    found = docs.dictionary_encode(null_encoding="encode")
    group, n = found.indices.to_numpy(), len(found.dictionary)
    fields = accs.flatten()
    out: list[pa.Array] = [pa.nulls(n, f.type) for f in fields]
    for i in merge.flags:
        seen = np.zeros(n, bool)
        seen[group[pc.fill_null(fields[i], False).to_numpy(zero_copy_only=False)]] = True
        out[i] = pa.array(seen)
    for i in merge.counts:
        total = np.zeros(n, np.int64)
        np.add.at(total, group, pc.fill_null(fields[i], 0).to_numpy())
        out[i] = pa.array(total)
    for i in merge.sets:
        values, of = pc.list_flatten(fields[i]), group[pc.list_parent_indices(fields[i]).to_numpy()]
        rows = _sorted_rows(of, values)
        values, of = values.take(pa.array(rows)), of[rows]
        new = _starts(of)
        for key in _sort_keys(values):
            coded = key.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new |= _starts(coded)
        values, of = values.filter(pa.array(new)), of[new]
        sizes = np.bincount(of, minlength=n)
        ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
        out[i] = pa.ListArray.from_arrays(pa.array(ends), values, type=fields[i].type, mask=pa.array(sizes == 0))
    for first, order in merge.firsts:
        known = np.flatnonzero(fields[order].is_valid().to_numpy(zero_copy_only=False))
        known = known[_sorted_rows(group[known], fields[order].take(pa.array(known)))]
        known = known[_starts(group[known])]
        at = np.full(n, -1)
        at[group[known]] = known
        rows = pa.array(at, mask=at < 0)
        out[first], out[order] = fields[first].take(rows), fields[order].take(rows)
    kind = accs.type
    merged = pa.StructArray.from_arrays([a.cast(f.type) for a, f in zip(out, kind)], fields=list(kind))
    return pa.RecordBatch.from_arrays([found.dictionary, merged], schema=table.schema)


def _combine(batches: Iterator[pa.RecordBatch], schema: T.StructType, full_rows: int = COMBINED_ROWS,
             full_bytes: int = COMBINED_BYTES) -> Iterator[pa.RecordBatch]:
    """One row per document out of all rows of a task, or of as many as fit."""
    merge = Merge(schema)
    held: list[pa.RecordBatch] = []

    def filled(part: int = 1) -> bool:
        return sum(b.num_rows for b in held) * part >= full_rows or sum(b.nbytes for b in held) * part >= full_bytes

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if filled():
            held = [_merged(held, merge)]
            if filled(part=2):
                yield held.pop()
    if held:
        yield _merged(held, merge)


class DocumentState(StatefulProcessor):
    """The accumulators of a bucket's documents, by slots; a changed one goes out beside the one before."""

    def __init__(self, schema: T.StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        slot, kept = T.StructType().add("slot", T.LongType()), T.StructType().add("accumulators", T.BinaryType())
        self.state = handle.getMapState("documents", slot, kept)
        self.merge = Merge(self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived: dict[int, dict] = {}
        for row in rows:
            found = arrived.setdefault(row["_slot"], {})
            doc, acc = row[DOC], list(_plain(row["acc"]))
            found[doc] = self.merge(found[doc], acc) if doc in found else acc
        for slot, found in arrived.items():
            value = self.state.getValue((slot,))
            kept = {} if value is None else _loaded(value[0], self.merge.names)
            changed = []
            for doc, acc in found.items():
                before = kept.get(doc)
                now = tuple(acc if before is None else self.merge(list(before), acc))
                if now != before:
                    kept[doc] = now
                    changed.append((doc, before, now))
            if changed:
                self.state.updateValue((slot,), (pickle.dumps((self.merge.names, kept)),))
            for doc, before, now in changed:
                yield Row(**{DOC: doc, "before": _named(before, self.schema), "after": _named(now, self.schema)})

    def close(self) -> None:
        pass


def _loaded(value: bytes, names: list[str]) -> dict:
    """The accumulators of a slot in the order of ``names``; a field that was not kept yet is null."""
    kept_names, kept = pickle.loads(value)
    if kept_names == names:
        return kept
    at = [kept_names.index(n) if n in kept_names else None for n in names]
    return {doc: tuple(None if i is None else acc[i] for i in at) for doc, acc in kept.items()}


def reconciled_changes(*ledgers: Ledger) -> DataFrame:
    """``documento, before, after``: the reconciliation of every document that a micro-batch changed, as it was and as it is.

    The fields are those of ``reconcile`` (sources as pairs of rank and name in ``<ledger>_set``) and the order keys.
    """
    from ledgerspark.session import ship_package

    rows = accumulators(*ledgers)
    ship_package(rows.sparkSession)
    key, schema = rows.schema[DOC].dataType, _nullable(rows.schema["acc"].dataType)
    combined = rows.mapInArrow(lambda it: _combine(it, schema), T.StructType().add(DOC, key).add("acc", schema))
    out = T.StructType().add(DOC, key).add("before", schema).add("after", schema)
    place = F.pmod(F.xxhash64(DOC), F.lit(BUCKETS * SLOTS))
    placed = combined.withColumns({"_bucket": F.pmod(place, F.lit(BUCKETS)), "_slot": F.floor(place / F.lit(BUCKETS))})
    return placed.groupBy("_bucket").transformWithState(
        statefulProcessor=DocumentState(schema), outputStructType=out, outputMode="Update", timeMode="None")


def unified_changes(movements: DataFrame, registry: DataFrame, status_exports: DataFrame, key_mode="strict",
                    with_sources: bool = False) -> DataFrame:
    """Rows of the unified report (Q1) that are new or changed, from streaming ledgers."""
    from ledgerspark.plans.reports import unified_columns, unified_ledgers

    changes = reconciled_changes(*unified_ledgers(movements, registry, status_exports, key_mode, with_sources))
    date = movements.schema["data_hora"].dataType

    def report(at: str) -> Column:
        def column(name: str) -> Column:
            if name == "soa_sources":
                return F.transform(F.col(f"{at}.soa_set"), lambda s: s["name"])
            return F.col(f"{at}.{name}")

        return F.struct(*unified_columns(column, date, with_sources))

    both = changes.select(report("after").alias("now"), F.when(F.col("before").isNotNull(), report("before")).alias("was"))
    return both.where(F.col("was").isNull() | ~F.col("now").eqNullSafe(F.col("was"))).select("now.*")


def write_changes(changes: DataFrame, output: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run ``changes``: the rows of each micro-batch land in ``output/batch_id=<n>/``, overwritten if it is replayed.

    ``refresh.current_status`` folds them to the latest row per document. The number of state partitions is
    ``spark.sql.shuffle.partitions`` at the first start of a checkpoint: set it for the size the state will have.
    """
    from ledgerspark.streaming.refresh import BATCH_COLUMN

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/{BATCH_COLUMN}={batch_id}")

    writer = changes.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    with stateful_conf(changes.sparkSession):
        return writer.trigger(**(trigger or {"availableNow": True})).start()
