"""File sources: workbook data source, CSV header operators, intake and landing operators."""

import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from ledgerspark.plans import reports
from ledgerspark.sources import exports, headers, landing
from ledgerspark.sources.workbook import read_workbooks
from tests.xlsx_fixture import Date, write_xlsx


def test_header_operators():
    assert headers.dedup_headers(["A", "A", "B"]) == ["A", "A.1", "B"]
    assert headers.decode_header('+ACI-Documento+ACI-') == "Documento"
    assert headers.decode_header("Data &amp; Hora +AC0- x") == "Data & Hora - x"
    assert headers.alias_headers(["+//3//f/9-Unique ID"]) == ["unique_id"]
    names, keep = headers.resolve_header(["Documento", "Data Inclusão", "Data Exclusão", "Devedor"])
    assert names == ["documento", "data", "devedor"] and keep == [0, 1, 3]
    names, keep = headers.resolve_header(["Documento", "Documento"])
    assert names == ["documento", "Documento.1"]


# Fixed values below: file names, header spellings and residues as the portals export them.
def _landing():
    d = tempfile.mkdtemp(prefix="ls-landing-")
    write_xlsx(os.path.join(d, "Relatorio_CNM.xlsx"), [
        ["Id", "Documento", "Tipo", "Data / Hora"],
        [1, "123.456.789-01", "INCLUSAO", Date(45356.6041666667)],   # 05/03/2024 14:30
        [2, "123.456.789-01", "EXCLUSAO", "06/03/2024 10:00"],
        [3, "987.654.321-00", " exclusao ", Date(45306.25)],            # 15/01/2024 06:00
        [4, None, "INCLUSAO", "01/02/2024"],
    ], pad_to=12000)
    preamble = [["Relatório de clientes"]] + [[f"linha {i}"] for i in range(7)]
    write_xlsx(os.path.join(d, "Relatorio_SGP.xlsx"), preamble + [
        ["CPF/CNPJ", "Nome/Razão Social"],
        ["123.456.789-01", "Ana"],
        ["555.555.555-55", "Bia"],
    ], pad_to=12000)
    with open(os.path.join(d, "Ativas.csv"), "w", encoding="utf-8") as f:
        f.write('+//3//f/9-Unique ID,"+ACI-Documento+ACI-",Devedor,Data Inclus+//3//Q-o\n')
        f.write(',12345678901.0,Ana &amp; Cia,01/01/2024\n')
        f.write('U-2,12345678901,Ana 2,02/01/2024\n')
        f.write('U-3,55555555555,"Bia, ""B""",03/01/2024\n')
    with open(os.path.join(d, "Pendentes.csv"), "w", encoding="utf-8") as f:
        f.write('Documento,Devedor,Unique ID,Data Inclusão,Data Exclusão,Documento\n')
        f.write('999.999.999-99,Caio,NA,04/01/2024,05/01/2024,x\n')
        f.write('12345678901,Ana 3,U-9,06/01/2024,07/01/2024,y\n')
    with open(os.path.join(d, "Erros.csv.crdownload"), "w") as f:
        f.write("partial")
    with open(os.path.join(d, "tiny.xlsx"), "wb") as f:
        f.write(b"PK\x03\x04 too small")
    return d


def test_workbook_source(spark):
    d = _landing()
    df = read_workbooks(spark, os.path.join(d, "Relatorio_CNM.xlsx"))
    assert df.columns == ["Id", "Documento", "Tipo", "Data / Hora", "_file", "_row"]
    rows = df.orderBy("_row").collect()
    assert [r["Data / Hora"] for r in rows] == ["2024-03-05 14:30:00", "06/03/2024 10:00", "2024-01-15 06:00:00",
                                                "01/02/2024"]
    assert [r.Id for r in rows] == ["1", "2", "3", "4"] and rows[3].Documento is None
    reg = read_workbooks(spark, os.path.join(d, "Relatorio_SGP.xlsx"), skip_rows=8)
    assert [tuple(r)[:2] for r in reg.orderBy("_row").collect()] == [("123.456.789-01", "Ana"), ("555.555.555-55", "Bia")]


def test_scans_and_unified_report(spark):
    d = _landing()
    mv = exports.scan_movements(spark, os.path.join(d, "Relatorio_CNM.xlsx"))
    rg = exports.scan_registry(spark, os.path.join(d, "Relatorio_SGP.xlsx"))
    se, missing = exports.scan_status_exports(spark, d)
    assert missing == ["Baixadas.csv", "Determinacao.csv", "Erros.csv"]
    assert [r.file for r in exports.missing_sources(spark, d).collect()] == missing
    got = {r.documento: r.asDict() for r in se.collect()}
    assert set(got) == {"12345678901.0", "12345678901", "55555555555", "999.999.999-99"}
    assert got["55555555555"]["devedor"] == 'Bia, "B"'
    assert got["999.999.999-99"]["unique_id"] is None and got["999.999.999-99"]["data"] == "04/01/2024"
    q1 = {r.documento: r.asDict() for r in reports.unified_report(mv, rg, se).collect()}
    assert set(q1) == {"12345678901", "98765432100", "", "55555555555", "99999999999"}
    a = q1["12345678901"]
    # first movement is the INCLUSAO of 05/03; first export row (Ativas, file order) has a null id
    assert (a["tipo"], a["data"], a["status"], a["id"], a["nome"]) == (
        "INCLUSAO", "05/03/2024 14:30", "NEGATIVADO", None, "Ana &amp; Cia")
    assert (q1["98765432100"]["status"], q1["98765432100"]["data"]) == ("BAIXADO", "15/01/2024 06:00")
    assert (q1[""]["status"], q1[""]["data"]) == ("ERRO", "01/02/2024 00:00")
    b = q1["55555555555"]
    assert (b["tipo"], b["status"], b["id"], b["data"]) == ("Ativas", "ERRO", "U-3", "03/01/2024")
    c = q1["99999999999"]
    assert (c["id"], c["tipo"], c["nome"]) == ("-", "Pendentes", "Caio")
    q2 = {r.documento: r.asDict() for r in reports.unified_presence_report(
        mv, rg, se.where(F.col("fonte") == "Ativas")).collect()}
    assert (q2["12345678901"]["id"], q2["12345678901"]["nome"]) == ("nan", "Ana & Cia")


def test_intake_and_landing(spark):
    d = _landing()
    res = {os.path.basename(r.path): (r.ok, r.reason) for r in landing.intake_check(spark, d).collect()}
    assert res["Relatorio_CNM.xlsx"] == (True, "ok")
    assert res["tiny.xlsx"] == (False, "too_small")
    bad = os.path.join(d, "bad.xlsx")
    with open(os.path.join(d, "Relatorio_SGP.xlsx"), "rb") as f:
        data = bytearray(f.read())
    with zipfile.ZipFile(os.path.join(d, "Relatorio_SGP.xlsx")) as zf:
        info = zf.getinfo("docProps/padding.bin")
    start = info.header_offset + 30 + len(info.filename) + len(info.extra) + 10
    data[start] ^= 0xFF
    with open(bad, "wb") as f:
        f.write(bytes(data))
    with open(os.path.join(d, "notzip.xlsx"), "wb") as f:
        f.write(b"x" * 20000)
    res = {os.path.basename(r.path): (r.ok, r.reason) for r in landing.intake_check(spark, d).collect()}
    assert res["bad.xlsx"] == (False, "bad_crc:docProps/padding.bin")
    assert res["notzip.xlsx"] == (False, "not_zip")
    listing = landing.list_landing(spark, d)
    names = {r.name for r in landing.landing_filter(listing).collect()}
    assert "Erros.csv.crdownload" not in names and "Ativas.csv" in names
    before = listing.where(F.col("name") != "Ativas.csv")
    assert [r.name for r in landing.new_files_since(before, listing).collect()] == ["Ativas.csv"]


def test_optional_required_and_empty_sources(spark):
    import pytest

    d = tempfile.mkdtemp(prefix="ls-empty-")
    se, missing = exports.scan_status_exports(spark, d)
    assert missing == [name for _, _, name in exports.STATUS_FILES]
    assert se.columns == ["documento", "devedor", "unique_id", "data", "fonte", "source_rank", "ord"]
    assert se.count() == 0
    with pytest.raises(exports.MissingSourceError):
        exports.scan_movements(spark, os.path.join(d, "Relatorio_CNM.xlsx"))
    src = exports.status_source_map(spark).orderBy("source_rank").collect()
    assert [r.fonte for r in src] == ["Ativas", "Baixadas", "Pendentes", "Determinacao", "Erros"]


def test_loose_keys_keep_the_float_tail(spark):
    import datetime as dt

    from tests.test_reports import MV, RG, SE

    mv = spark.createDataFrame([(1, "12345678901", "INCLUSAO", dt.datetime(2024, 1, 1), 1)], MV)
    rg = spark.createDataFrame([("12345678901", "A", 1)], RG)
    se = spark.createDataFrame([("12345678901.0", "d", "U", "x", "Ativas", 1, 1)], SE)
    strict = {r.documento for r in reports.unified_report(mv, rg, se).collect()}
    loose = {r.documento for r in reports.unified_report(mv, rg, se, key_mode="loose").collect()}
    assert strict == {"12345678901"} and loose == {"12345678901", "123456789010"}


def test_parquet_ledgers_round_trip(spark):
    """Ledgers landed as Parquet with the spreadsheet headers give the same Q1 as the fixture itself."""
    from ledgerspark.sources import fixtures as fx

    d = "/root/testdata/sf0.001"
    root = tempfile.mkdtemp(prefix="ls-parquet-")
    mv, rg = fx.movements(spark, d), fx.registry(spark, d)
    (mv.orderBy("ord").select(*[F.col(c).alias(h) for c, h in fx.MOVEMENT_HEADERS.items()])
     .coalesce(1).write.parquet(f"{root}/cnm"))
    (rg.orderBy("ord").select(*[F.col(c).alias(h) for c, h in fx.REGISTRY_HEADERS.items()])
     .coalesce(1).write.parquet(f"{root}/sgp"))
    mv2 = exports.scan_movements(spark, f"{root}/cnm", fmt="parquet")
    rg2 = exports.scan_registry(spark, f"{root}/sgp", fmt="parquet")
    se = fx.status_exports(spark, d)
    got = sorted(map(tuple, reports.unified_report(mv2, rg2, se).collect()), key=str)
    want = sorted(map(tuple, reports.unified_report(mv, rg, se).collect()), key=str)
    assert got == want


def test_cli_report(spark, capsys):
    from ledgerspark import cli

    d = _landing()
    out = tempfile.mkdtemp(prefix="ls-out-")
    args = cli.argparse.Namespace(landing=d, out=out, variant="current", ledger_format="workbook",
                                  key_mode="strict", format="csv", html=True, versioned=False)
    cli.run_report(spark, args)
    printed = capsys.readouterr()
    assert "NEGATIVADO\t2" in printed.out and "Baixadas.csv" in printed.err
    back = spark.read.option("header", True).csv(f"{out}/resultado_current")
    assert back.columns == ["ID", "Documento", "Nome", "Data", "Tipo", "Local", "Status"] and back.count() == 5
    assert spark.read.text(f"{out}/linhas_current").count() == 5
    args.variant, args.format = "soa_registry", "xlsx"
    cli.run_report(spark, args)
    wb = read_workbooks(spark, f"{out}/resultado_soa_registry")
    assert "Data Inclusão" in wb.columns and wb.count() == 2   # Ativas and registry hold the same 2 documents
    cli.run_report(spark, args)
    runs = sorted(os.listdir(f"{out}/resultado_soa_registry"))
    assert len(runs) == 2 and read_workbooks(spark, f"{out}/resultado_soa_registry/{runs[1]}").count() == 2


def test_legacy_reports_start_behind_the_intake_check(spark):
    import pytest

    from ledgerspark import cli

    d = _landing()
    with open(os.path.join(d, "Relatorio_SGP.xlsx"), "r+b") as f:
        f.truncate(500)
    args = cli.argparse.Namespace(landing=d, out=tempfile.mkdtemp(), variant="presence", ledger_format="workbook",
                                  key_mode="strict", format="csv", html=False, versioned=False)
    with pytest.raises(SystemExit, match="too_small"):
        cli.run_report(spark, args)
