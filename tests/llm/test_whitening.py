"""op13: whitening by block matrices against numpy on the whole table."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, key string, index long, x int"


def run(spark, vectors, **kw):
    df = spark.createDataFrame([(i, v, "k", 0, 1) for i, v in vectors], SCHEMA).repartition(3)
    return whitening.whiten(df, **kw).collect()


def expected(vectors):
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in vectors], dtype=object)
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    centred = (x - s / n).astype(float)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    return n, deviation, centred @ (u / np.sqrt(np.maximum(e, 1e-300))), e / e.sum()


@pytest.mark.parametrize("rows,dims", [(700, 12), (90, 5), (300, 40)])
def test_against_numpy(spark, monkeypatch, rows, dims):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    monkeypatch.setattr(whitening, "SPLIT_ROWS", 128)
    if dims == 40:
        monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 16)
    r = np.random.default_rng(rows)
    base = r.normal(size=(rows, dims)) * np.linspace(0.3, 2, dims) + 5
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    n, deviation, white, share = expected(vectors)
    got = run(spark, vectors)
    k = min(8, dims)
    assert len(got) == rows * k
    signs = {}
    for g in got:
        want = white[g.vec_id, g.component - 1]
        sign = signs.setdefault(g.component, np.sign(want * g.whitened) or 1.0)
        assert (g.n, g.deviation) == (n, deviation[g.vec_id])
        assert g.whitened == pytest.approx(sign * want, abs=1e-6)
        assert g.explained == pytest.approx(share[g.component - 1], rel=1e-6)
        assert g.identity_error < 1e-6
    assert len({g.identity_error for g in got}) == 1


def test_rows_that_take_no_part_and_ties(spark):
    good = [(i, [float(i % 7), float(i % 3), float(i * i % 11)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 2.0]), (103, [float("inf"), 1.0, 2.0]), (104, []),
           (105, [1.0, 2.0])]
    got = run(spark, good + bad + good[:5] + [(None, [1.0, 2.0, 3.0])])
    assert len(got) == (40 + 5 + 1) * 3
    assert {g.n for g in got} == {46} and not {g.vec_id for g in got} & set(range(100, 106))
    assert sum(g.vec_id is None for g in got) == 3


def test_constant_dimension_and_equal_vectors(spark):
    got = run(spark, [(i, [float(i), 1.0]) for i in range(10)])
    assert all((g.whitened is None) == (g.component == 2) for g in got)
    assert all(g.identity_error < 1e-9 for g in got)
    same = run(spark, [(i, [0.5, 0.25]) for i in range(4)])
    assert len(same) == 8 and all(g.whitened is None and g.deviation == 0 for g in same)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_deviation_is_exact_or_an_error(spark):
    vectors = [(0, [1e6, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 1.0])]
    n, deviation, *_ = expected(vectors)
    assert {g.vec_id: g.deviation for g in run(spark, vectors)} == dict(enumerate(deviation))
    with pytest.raises(Exception, match="too large|out of bounds|OverflowError"):
        run(spark, [(0, [1e9, 0.0]), (1, [0.0, 1.0])])
