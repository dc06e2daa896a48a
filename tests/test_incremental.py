"""STR4 on a stateful operator: changes only, hot documents, replay by restart, state of an older form."""

import datetime as dt
import random

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerspark.plans import reports
from ledgerspark.streaming import incremental, refresh
from tests.test_reports import MV, RG, SE

T0 = dt.datetime(2024, 1, 1, 8, 0)


class Landing:
    """Ledger rows that land step by step, and the stream over them."""

    def __init__(self, spark, root):
        self.spark, self.root, self.step = spark, str(root), 0
        self.rows = {"mv": [], "rg": [], "se": []}

    def land(self, **new):
        for name, schema in (("mv", MV), ("rg", RG), ("se", SE)):
            part = new.get(name, [])
            self.rows[name] += part
            self.spark.createDataFrame(part, schema).write.parquet(f"{self.root}/in/{name}/load={self.step}")
        self.step += 1

    def run(self, **options):
        streams = [self.spark.readStream.schema(s).parquet(f"{self.root}/in/{n}") for n, s in (("mv", MV), ("rg", RG), ("se", SE))]
        changes = incremental.unified_changes(*streams, **options)
        refresh.await_all(incremental.write_changes(changes, f"{self.root}/out", f"{self.root}/ck"))
        out = self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/out")
        return out, sorted(r.documento for r in out.where(F.col(refresh.BATCH_COLUMN) == self.step - 1).collect())

    def batch(self):
        return reports.unified_report(*(self.spark.createDataFrame(self.rows[n], s) for n, s in (("mv", MV), ("rg", RG), ("se", SE))))


def same(a, b):
    cols = sorted(b.columns)
    return sorted(map(str, map(tuple, a.select(cols).collect()))) == sorted(map(str, map(tuple, b.select(cols).collect())))


def test_only_changed_rows_are_emitted_and_the_fold_is_the_batch_report(spark, tmp_path):
    l = Landing(spark, tmp_path)
    l.land(mv=[(1, "1", "INCLUSAO", T0, 5), (7, None, None, None, 6)], rg=[("2", "B", 1)],
           se=[("3", "d3", None, "x", "Erros", 5, 1), ("3", "d4", "U4", "y", "Ativas", 1, 9)])
    out, changed = l.run()
    assert changed == ["", "1", "2", "3"]
    # an earlier movement of 1 arrives later and sorts first; its registry entry too; 3 gets a row that sorts last
    l.land(mv=[(2, "1", "EXCLUSAO", T0, 1)], rg=[("1", "A", 2)], se=[("3", "d5", "U5", "z", "Erros", 5, 7)])
    out, changed = l.run()
    assert changed == ["1"]
    l.land(mv=[(3, "1", "INCLUSAO", T0, 9)], rg=[("2", "again", 8)])  # touched, not changed
    out, changed = l.run()
    assert changed == []
    l.land(rg=[("3", "C", 3)])
    out, changed = l.run()
    assert changed == ["3"]
    assert same(refresh.current_status(out), l.batch())


def test_a_hot_blank_document(spark, tmp_path):
    l = Landing(spark, tmp_path)
    l.land(mv=[(i, " " if i % 3 else str(i), "INCLUSAO", T0, 10_000 - i) for i in range(6000)],
           se=[(None, "d", f"U{i}", "x", "Ativas", 1, i) for i in range(3000)])
    l.run()
    l.land(mv=[(9, None, "EXCLUSAO", T0, -1)], rg=[("", "blank", 1)])
    out, changed = l.run()
    assert changed == [""]
    assert same(refresh.current_status(out), l.batch())


def test_the_combiner_leaves_one_row_per_document_and_batch(spark):
    mv = spark.createDataFrame([(i, str(i % 2), "INCLUSAO", T0, i) for i in range(100)], MV)
    rows = incremental.accumulators(*reports.unified_ledgers(mv, spark.createDataFrame([], RG), spark.createDataFrame([], SE)))
    schema = incremental._nullable(rows.schema["acc"].dataType)
    table = rows.coalesce(1).toArrow().combine_chunks()
    combined = list(incremental._combine(iter(table.to_batches()), schema))
    assert sum(b.num_rows for b in combined) == 2
    accs = {d: a for b in combined for d, a in zip(*(c.to_pylist() for c in b.columns))}
    assert accs["1"]["cnm_ord"] == {"ord": 1} and accs["0"]["cnm_first"]["id"] == 0
    assert list(incremental._combine(iter([pa.RecordBatch.from_pylist([], table.schema)]), schema)) == []


def test_order_keys_compare_as_spark_orders_them():
    merge = incremental.Merge(incremental.T._parse_datatype_string(
        "in_a boolean, a_first struct<v:int>, a_ord struct<o:struct<file:string,pos:bigint>>, a_v_n bigint"))
    def acc(v, file, pos):
        return [True, (v,), ((file, pos),), 1]
    assert merge(acc(1, "b", 1), acc(2, "b", None))[1] == (2,)      # null first
    assert merge(acc(1, "b", 1), acc(2, "a", 9))[1] == (2,)
    assert merge(acc(1, "b", 1), acc(2, "b", 1)) == [True, (1,), (("b", 1),), 2]  # ties keep the row that was there
    assert merge([False, None, None, 0], acc(2, "b", 1))[1] == (2,)


def test_state_of_an_older_form_is_read_after_columns_were_added(spark, tmp_path):
    l = Landing(spark, tmp_path)
    l.land(mv=[(1, "1", "INCLUSAO", T0, 5)], se=[("1", "d", "U", "x", "Ativas", 1, 1)])
    l.run()
    l.land(se=[("1", "d", "U2", "x", "Erros", 5, 2)], mv=[(2, "4", "EXCLUSAO", T0, 7)])
    out, _ = l.run(with_sources=True)  # the accumulators have one more field now
    got = {r.documento: r for r in out.where("batch_id = 1").collect()}
    assert got["4"].fontes == ["CNM_EXCLUSAO"]
    assert got["1"].tipo == "INCLUSAO" and got["1"].fontes == ["Erros", "CNM"]  # sources are known since they are kept


def test_the_combiner_merges_the_batches_of_a_task(spark):
    mv = spark.createDataFrame([(i, str(i % 3), "INCLUSAO", T0, -i) for i in range(90)], MV)
    rows = incremental.accumulators(*reports.unified_ledgers(mv, spark.createDataFrame([], RG), spark.createDataFrame([], SE)))
    schema = incremental._nullable(rows.schema["acc"].dataType)
    batches = rows.coalesce(1).toArrow().combine_chunks().to_batches(max_chunksize=10)
    assert len(batches) == 9
    (one,) = incremental._combine(iter(batches), schema)
    accs = dict(zip(*(c.to_pylist() for c in one.columns)))
    assert {d: a["cnm_first"]["id"] for d, a in accs.items()} == {"0": 87, "1": 88, "2": 89}
    # what a task holds is bounded: documents that do not shrink go on
    assert sum(b.num_rows for b in incremental._combine(iter(batches), schema, full_rows=6)) == 27
    assert [b.num_rows for b in incremental._combine(iter(batches), schema, full_bytes=1)] == [3] * 9


ACC = ("in_a boolean, a_first struct<v:string,w:bigint>, a_ord struct<o:struct<file:string,pos:bigint>,x:double,l:array<int>>, a_v_n bigint, "
       "in_b boolean, b_first struct<v:timestamp_ntz>, b_ord struct<ord:bigint>, b_set array<struct<rank:int,name:string>>")


def test_columns_are_merged_as_rows_are(spark):
    rnd = random.Random(7)

    def acc():
        a, b = rnd.random() < 0.6, rnd.random() < 0.6
        order = {"o": {"file": rnd.choice([None, "a", "\u00e9", "\U0001f600"]), "pos": rnd.choice([None, 1, 2, 2**60, 2**60 + 1])},
                 "x": rnd.choice([None, -1.5, 2.0]), "l": rnd.choice([[], [1], [1, 2], [None]])}
        return {"in_a": a, "a_first": {"v": rnd.choice([None, "p", "q"]), "w": rnd.randrange(2**62)} if a else None, "a_ord": order if a else None,
                "a_v_n": rnd.randrange(3), "in_b": b, "b_first": {"v": rnd.choice([None, T0])} if b else None,
                "b_ord": {"ord": rnd.choice([None, 1, 2])} if b else None,
                "b_set": [{"rank": rnd.choice([None, 1, 2]), "name": rnd.choice([None, "x", "y"])} for _ in range(rnd.randrange(3))] if b else None}

    schema = incremental.T._parse_datatype_string(ACC)
    rows = [(rnd.choice([None, "", "1", "2", "3"]), acc()) for _ in range(400)]
    table = spark.createDataFrame(rows, incremental.T.StructType().add("documento", "string").add("acc", schema)).coalesce(1).toArrow()
    merge, want = incremental.Merge(schema), {}
    for doc, row in rows:
        new = [incremental._plain(v) for v in row.values()]
        want[doc] = merge(want[doc], new) if doc in want else new
    (one,) = incremental._combine(iter(table.to_batches(max_chunksize=64)), schema)
    got = {d: [incremental._plain(v) for v in a.values()] for d, a in zip(*(c.to_pylist() for c in one.columns))}
    assert got == want


def test_documents_of_a_slot_share_the_calls_to_the_state(spark):
    class State:
        values, calls = {}, 0

        def getValue(self, key):
            State.calls += 1
            return State.values.get(key)

        def updateValue(self, key, value):
            State.calls += 1
            State.values[key] = value

    class Handle:
        def getMapState(self, *_):
            return State()

    schema = incremental.T._parse_datatype_string("in_a boolean, a_v_n bigint")
    work = incremental.DocumentState(schema)
    work.init(Handle())

    def arrive(docs):
        rows = (Row(documento=d, acc={"in_a": True, "a_v_n": n}, _bucket=1, _slot=int(d) % 2) for d, n in docs)
        State.calls = 0
        return sorted((r.documento, r.before and r.before["a_v_n"], r.after["a_v_n"]) for r in work.handleInputRows((1,), rows, None))

    assert arrive([(str(i), 1) for i in range(100, 200)] + [("100", 4)])[:2] == [("100", None, 5), ("101", None, 1)]
    assert State.calls == 4  # two slots, each read and written once
    assert arrive([("101", 0), ("103", 2), ("300", 1)]) == [("103", 1, 3), ("300", None, 1)]
    assert State.calls == 4
    assert arrive([("101", 0)]) == [] and State.calls == 1


def test_documents_are_grouped_by_bucket(spark, tmp_path):
    spark.createDataFrame([], MV).write.parquet(f"{tmp_path}/mv")
    mv = spark.readStream.schema(MV).parquet(f"{tmp_path}/mv")
    plan = incremental.reconciled_changes(*reports.unified_ledgers(mv, *(spark.createDataFrame([], s) for s in (RG, SE))))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert str(incremental.BUCKETS) in text and "xxhash64(documento" in text
