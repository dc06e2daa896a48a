"""Sources are lossless or loud: preambles, differing headers, odd CSV records, typed keys, session settings."""

import os

import pytest

from ledgerspark import session
from ledgerspark.sources import exports, headers
from ledgerspark.sources.workbook import read_workbooks
from tests.xlsx_fixture import write_xlsx


def _csv(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_preamble_counts_sheet_rows_and_blank_rows_stay(spark, tmp_path):
    preamble = [["title"], [], ["a"], [], [], ["b"], [], ["c"]]
    write_xlsx(str(tmp_path / "Relatorio_SGP.xlsx"), preamble + [["CPF/CNPJ", "Nome/Razão Social"], ["1", "Ana"], [], ["2", "Bia"]])
    got = exports.scan_registry(spark, str(tmp_path / "Relatorio_SGP.xlsx")).orderBy("ord").collect()
    assert [(r.cpf_cnpj, r.nome) for r in got] == [("1", "Ana"), (None, None), ("2", "Bia")]


def test_workbooks_with_different_headers(spark, tmp_path):
    d = str(tmp_path / "Relatorio_CNM.xlsx")
    os.makedirs(d)
    write_xlsx(os.path.join(d, "a.xlsx"), [["Id", "Documento"], [1, "11"]])
    write_xlsx(os.path.join(d, "b.xlsx"), [["Tipo", "Id", "Data / Hora"], ["INCLUSAO", 2, "01/02/2024"]])
    write_xlsx(os.path.join(d, "c.xlsx"), [["Documento ", "+ACI-Tipo+ACI-", "Documento"], ["33", "EXCLUSAO", "44"]])
    got = {r.id: r for r in exports.scan_movements(spark, d).collect()}
    assert got["1"].documento == "11" and got["2"].tipo == "INCLUSAO" and got["2"].data_hora.month == 2
    assert (got[None].documento, got[None].tipo) == ("33", "EXCLUSAO")
    assert read_workbooks(spark, d).columns == ["Id", "Documento", "Tipo", "Data / Hora", "Documento ", "+ACI-Tipo+ACI-", "_file", "_row"]


def test_blank_lines_before_a_csv_header(spark, tmp_path):
    path = _csv(str(tmp_path), "x.csv", "\n  \nDocumento,Devedor\n1,Ana\n2\n")
    got = sorted((r.documento, r.devedor) for r in exports.scan_csv(spark, [path]).collect())
    assert got == [("1", "Ana"), ("2", None)]


@pytest.mark.parametrize("line", ["1,Ana,extra", '1,"A, B",x', "1,Ana,,y"])
def test_wide_records_fail(spark, tmp_path, line):
    path = _csv(str(tmp_path), "x.csv", f"Documento,Devedor\n{line}\n")
    with pytest.raises(Exception, match="more than the header's 2 cells"):
        exports.scan_csv(spark, [path]).select("documento").collect()


def test_records_over_several_lines(spark, tmp_path):
    path = _csv(str(tmp_path), "x.csv", 'Documento,Devedor,Unique ID\n1,"Ana\nMaria",U\n')
    with pytest.raises(Exception, match="quote left open"):
        exports.scan_csv(spark, [path], multi_line=False).collect()
    for multi_line in (None, True):
        got = exports.scan_csv(spark, [path], multi_line=multi_line).collect()
        assert [(r.documento, r.devedor, r.unique_id) for r in got] == [("1", "Ana\nMaria", "U")]


def test_long_header_and_repeats(spark, tmp_path):
    names = [f"c{i:05d}" + "x" * 40 for i in range(300)] + ["Documento", "Documento", "Data Inclusão", "Data Exclusão"]
    path = _csv(str(tmp_path), "x.csv", ",".join(names) + "\n" + ",".join(str(i) for i in range(len(names))) + "\n")
    row = exports.scan_csv(spark, [path]).collect()[0]
    assert row.documento == "300" and row["Documento.1"] == "301" and row.data == "302"
    assert headers.dedup_headers(["A", None, "A", None, "A"]) == ["A", "", "A.1", ".1", "A.2"]


def test_float_keys_of_a_parquet_ledger(spark, tmp_path):
    path = str(tmp_path / "Relatorio_SGP.parquet")
    spark.createDataFrame([(12345678901.0, "Ana")], "`CPF/CNPJ` double, `Nome/Razão Social` string").write.parquet(path)
    got = exports.scan_registry(spark, path, fmt="parquet").collect()
    assert got[0].cpf_cnpj == "12345678901.0"


def test_preamble_option_and_missing_ledger_are_loud(spark, tmp_path):
    _csv(str(tmp_path), "x.csv", "CPF/CNPJ\n1\n")
    with pytest.raises(ValueError, match="workbook feature"):
        exports.scan_registry(spark, str(tmp_path / "x.csv"), fmt="csv", skip_rows=3)
    with pytest.raises(exports.MissingSourceError):
        exports.scan_registry(spark, str(tmp_path / "absent.xlsx"))


def test_session_names_a_master_only_when_told(monkeypatch):
    monkeypatch.delenv("SPARK_MASTER", raising=False)
    assert "spark.master" not in session.session_conf(cluster=True)
    assert session.session_conf("local[2]")["spark.master"] == "local[2]"
    assert session.session_conf(cluster=True)["spark.sql.shuffle.partitions"] == "8000"

    class Preset:
        def contains(self, key):
            return key == "spark.sql.shuffle.partitions"

    assert "spark.sql.shuffle.partitions" not in session.session_conf(cluster=True, preset=Preset())


def test_checkpoint_folder_is_required_off_a_local_master():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.checkpoint_dir(Session())
