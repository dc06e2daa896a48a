"""Streaming operators: versioned landing (STR2) and the incremental report's change log (STR4)."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from ledgerspark.plans import reports
from ledgerspark.sources import landing
from ledgerspark.streaming import refresh
from tests.test_reports import MV, RG, SE


def test_newest_versions(spark):
    root = tempfile.mkdtemp(prefix="ls-versions-")
    for ledger, ts in [("CNM", "20240101"), ("CNM", "20240301"), ("SGP", "20240201")]:
        d = os.path.join(root, f"ledger={ledger}", f"load_ts={ts}")
        os.makedirs(d)
        with open(os.path.join(d, "data.csv"), "w") as f:
            f.write("x\n1\n")
    newest = refresh.newest_versions(landing.list_landing(spark, root))
    got = sorted((r.ledger, r.load_ts) for r in newest.collect())
    assert got == [("CNM", "20240301"), ("SGP", "20240201")]


def test_incremental_report_emits_changes_only(spark):
    root = tempfile.mkdtemp(prefix="ls-stream-")
    t = dt.datetime(2024, 1, 1, 8, 0)

    def land(name, rows, schema, step):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/in/{name}/load={step}")

    land("mv", [(1, "1", "INCLUSAO", t, 5)], MV, 0)
    land("rg", [("2", "B", 1)], RG, 0)
    land("se", [("3", "d3", "U3", "x", "Erros", 5, 1)], SE, 0)
    streams = [spark.readStream.schema(s).parquet(f"{root}/in/{n}") for n, s in (("mv", MV), ("rg", RG), ("se", SE))]
    report = reports.unified_report(*streams)
    out, ck = f"{root}/out", f"{root}/ck"
    refresh.await_all(refresh.incremental_report(report, out, ck))
    # second arrival: an earlier movement of document 1 (arrives later, sorts first) and registry entry for it
    land("mv", [(2, "1", "EXCLUSAO", t, 1)], MV, 1)
    land("rg", [("1", "A", 2)], RG, 1)
    refresh.await_all(refresh.incremental_report(report, out, ck))
    changes = spark.read.parquet(out)
    second = {r.documento for r in changes.where(F.col(refresh.BATCH_COLUMN) == 1).collect()}
    assert second == {"1"}                       # only the touched document is re-emitted
    final = {r.documento: r.status for r in refresh.current_status(changes).collect()}
    assert final == {"1": "ERRO", "2": "ERRO", "3": "ERRO"}
    # a later movement of document 1 changes nothing: no row, although the document was touched
    land("mv", [(3, "1", "INCLUSAO", t, 9)], MV, 2)
    refresh.await_all(refresh.incremental_report(report, out, ck, compact_every=3))
    assert spark.read.parquet(out).where(F.col(refresh.BATCH_COLUMN) == 2).count() == 0
    land("mv", [(4, "3", "EXCLUSAO", t, 1)], MV, 3)
    refresh.await_all(refresh.incremental_report(report, out, ck))
    assert {r.documento for r in spark.read.parquet(out).where(F.col(refresh.BATCH_COLUMN) == 3).collect()} == {"3"}
    assert spark.read.parquet(f"{out}-snapshot").where("upto = 2").count() == 3
    assert refresh.emitted_status(spark, out, "documento", 4).count() == 3
    first_doc1 = changes.where((F.col("documento") == "1") & (F.col(refresh.BATCH_COLUMN) == 0)).first()
    assert first_doc1.status == "ERRO" and first_doc1.tipo == "INCLUSAO"
    latest = refresh.current_status(changes).where(F.col("documento") == "1").first()
    assert latest.tipo == "EXCLUSAO"             # order key, not arrival, decides the first movement


def test_versioned_landing_uses_newest_load(spark):
    import shutil

    from ledgerspark import cli
    from tests.test_sources import _landing
    from tests.xlsx_fixture import write_xlsx

    flat = _landing()
    root = tempfile.mkdtemp(prefix="ls-versioned-")
    for ledger, ts in (("CNM", "20240101"), ("CNM", "20240201"), ("SGP", "20240101"), ("SOA", "20240105")):
        os.makedirs(os.path.join(root, f"ledger={ledger}", f"load_ts={ts}"))
    new_cnm = os.path.join(root, "ledger=CNM", "load_ts=20240201")
    old_cnm = os.path.join(root, "ledger=CNM", "load_ts=20240101")
    shutil.copy(os.path.join(flat, "Relatorio_CNM.xlsx"), new_cnm)
    write_xlsx(os.path.join(old_cnm, "Relatorio_CNM.xlsx"),
               [["Id", "Documento", "Tipo", "Data / Hora"], [9, "111.111.111-11", "INCLUSAO", "01/01/2024"]])
    shutil.copy(os.path.join(flat, "Relatorio_SGP.xlsx"), os.path.join(root, "ledger=SGP", "load_ts=20240101"))
    for f in ("Ativas.csv", "Pendentes.csv"):
        shutil.copy(os.path.join(flat, f), os.path.join(root, "ledger=SOA", "load_ts=20240105"))
    assert refresh.newest_version_folders(spark, root)["CNM"].endswith("load_ts=20240201")
    mv, rg, se, missing = cli.ledgers(spark, root, "workbook", versioned=True)
    docs = {r.documento for r in mv.select(F.regexp_replace("documento", r"\D", "").alias("documento")).collect()}
    assert "11111111111" not in docs and "12345678901" in docs
    assert se.count() == 5 and "Ativas.csv" not in missing


def test_load_times_are_compared_as_times(spark):
    names = ["9", "10", "20240101", "20240101T0700", "2024-01-02T03:04:05", "2024-01-01T00%3A00%3A01", "20231231235959", "later"]
    rows = spark.createDataFrame([(f"/x/ledger=A{k}/load_ts={a}/f", ) for k, pair in enumerate(zip(names, names[1:])) for a in pair], "path string")
    got = {r.ledger: r.load_ts for r in refresh.newest_versions(rows).collect()}
    assert got["A0"] == "10" and got["A1"] == "20240101" and got["A4"] == "2024-01-02T03:04:05"
    assert got["A5"] == "2024-01-01T00%3A00%3A01" and got["A6"] == "20231231235959"


def test_overwritten_files_are_seen_and_failures_keep_the_last_report(spark, tmp_path):
    folder, state, out, log = (str(tmp_path / n) for n in ("in", "state", "out", "log"))
    os.makedirs(folder)
    path = os.path.join(folder, "Relatorio_CNM.xlsx")

    def put(text):
        with open(path, "w") as f:
            f.write(text)

    put("a")
    changed, listing = refresh.landing_changes(spark, folder, state)
    assert changed.count() == 1
    assert refresh.published(spark, out, log) is None
    assert refresh.refresh_once(spark, lambda s: s.range(3), out, log, 1, 1)
    refresh.remember_landing(listing, state)
    assert refresh.landing_changes(spark, folder, state)[0].count() == 0
    put("longer")
    changed, listing = refresh.landing_changes(spark, folder, state)
    assert changed.count() == 1

    def broken(s):
        return s.range(9).select(F.raise_error(F.lit("x" * 2000)).alias("id"))

    assert not refresh.refresh_once(spark, broken, out, log, 2, 1)
    assert refresh.published(spark, out, log).count() == 3
    assert len(spark.read.parquet(log).where("not ok").first().message) > 1500
    refresh.remember_landing(listing, state)
    assert refresh.landing_changes(spark, folder, state)[0].count() == 0


def test_waiting_has_no_limit():
    class Query:
        waited = None

        def awaitTermination(self, timeout="none"):
            Query.waited = timeout

    refresh.await_all(Query())
    assert Query.waited == "none"
