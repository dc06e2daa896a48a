"""SRC4: filters decided while a sheet is parsed, as Spark would decide them."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerspark.sources import exports
from ledgerspark.sources.workbook import condition, read_workbooks
from tests.xlsx_fixture import write_xlsx

CELLS = ["b", "a", None, "", "ab", "B", "é", "\U0001F600", "￮", "zz", "nan", "10", "9"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("books"))
    for k in range(3):
        rows = [[f"r{k}-{i}", c, CELLS[(i * 3 + k) % len(CELLS)]] for i, c in enumerate(CELLS)]
        write_xlsx(os.path.join(d, f"{k}.xlsx"), [["id", "x", "y"], *rows[:6], [], *rows[6:]])
    return d


PREDICATES = [[("x", "=", "a")], [("x", "<>", "a")], [("x", ">", "a")], [("x", ">=", "zz")], [("x", "<", "b")], [("x", "<=", "￮")],
              [("x", ">", "￮")], [("x", "is null", None)], [("x", "is not null", None)], [("x", "in", ("a", "zz"))], [("x", "in", ())],
              [("x", "not in", ("a", "zz"))], [("x", "not in", ())], [("x", "starts with", "a")], [("x", "ends with", "b")],
              [("x", "contains", "b")], [("_row", ">", 4)], [("_row", "in", (3, 5))], [("x", ">=", "a"), ("y", "<", "b"), ("_row", ">", 3)],
              [("x", "=", "none such")]]


@pytest.mark.parametrize("where", PREDICATES)
def test_predicates_decide_as_spark_does(spark, folder, where):
    rows = read_workbooks(spark, folder)
    given = read_workbooks(spark, folder, where=where)
    assert sorted(map(str, given.collect())) == sorted(map(str, rows.where(condition(where)).collect()))
    assert rows.count() == 42  # what one query filters is no matter to another


def test_files_ruled_out_are_not_opened(spark, folder):
    one = read_workbooks(spark, folder, where=[("_file", "ends with", "/1.xlsx")])
    assert one.rdd.getNumPartitions() == 1 and one.count() == 14
    assert read_workbooks(spark, folder, where=[("_file", "=", "none")]).count() == 0


@pytest.mark.parametrize("wrong", [("x", "like", "a"), ("none", "=", "a"), ("x", "=", 1), ("_row", "=", "1"), ("x", "in", ("a", 1))])
def test_wrong_predicates_fail(spark, folder, wrong):
    with pytest.raises(Exception, match="not a predicate"):
        read_workbooks(spark, folder, where=[wrong]).collect()


def test_scans_take_predicates_on_their_columns(spark, tmp_path):
    path = str(tmp_path / "Relatorio_CNM.xlsx")
    write_xlsx(path, [["Id", "Documento", "Tipo", "Data / Hora"], [1, "11", "INCLUSAO", "01/02/2024"], [2, "nan", "EXCLUSAO", ""],
                      [3, "33", "nan", "01/02/2024"]])
    exports.scan_movements(spark, path).select("id", "documento", "tipo", F.lit("05/03/2024").alias("data_hora")).write.parquet(
        str(tmp_path / "same"))
    for fmt, at in (("workbook", path), ("parquet", str(tmp_path / "same"))):
        got = exports.scan_movements(spark, at, fmt, where=[("tipo", "=", "EXCLUSAO"), ("documento", "is null", None)])
        assert [r.id for r in got.collect()] == ["2"]
        assert exports.scan_movements(spark, at, fmt, where=[("tipo", "=", "nan")]).count() == 0
