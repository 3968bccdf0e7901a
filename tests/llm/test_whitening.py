"""Whitening against dense eigenvectors and exact sums."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from dayfold.llm import whitening
from dayfold.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, components=8):
    """{(row, component): ...} by a dense eigen decomposition; rows are equally long lists."""
    x = np.floor(1024 * np.array(rows, float)).astype(int) + 100_000
    n, dims = x.shape
    centred = x - x.sum(0) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    sums = [sum(int(v) for v in column) for column in x.T]
    deviations = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return values, centred @ vectors / np.sqrt(values), deviations, (centred**2).sum() / n


def compare(found, rows, ids, components=8):
    values, whitened, deviations, trace = plain(rows, components)
    number = len(values)
    assert len(found) == len(rows) * number
    place = {v: i for i, v in enumerate(ids)}
    got = np.zeros((len(rows), number))
    for row in found:
        i, j = place[row["vec_id"]], row["component"] - 1
        got[i, j] = row["whitened"]
        assert row["n"] == len(rows)
        assert row["deviation"] == deviations[i]
        assert math.isclose(row["explained"], values[j] / trace, rel_tol=1e-10)
        assert 0 <= row["identity_error"] < 1e-9
    for j in range(number):
        same = np.abs(got[:, j] - whitened[:, j]).max()
        turned = np.abs(got[:, j] + whitened[:, j]).max()
        assert min(same, turned) < 1e-8
    assert np.abs(np.cov(got.T, bias=True) - np.eye(number)).max() < 1e-9


def test_query_equals_dense(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet")
    rows, ids = table.column("embedding").to_pylist(), table.column("vec_id").to_pylist()
    frame = QUERIES["op12_whitening"](spark, SF_DIR)
    kinds = dict(frame.dtypes)
    assert kinds["deviation"] == kinds["n"] == "bigint" and kinds["component"] == "int"
    compare(frame.collect(), rows, ids)


def test_rows_that_are_left_out(spark):
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(40, 5)).tolist()
    data = [(i, row) for i, row in enumerate(rows)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [nan] * 5, [inf] + [0.0] * 4, [1e300] * 5,
           [1.0] * 4, [0.0] * 6]
    data += [(100 + i, row) for i, row in enumerate(bad)]
    frame = spark.createDataFrame(data, SCHEMA)
    compare(whitening.whiten(frame).collect(), rows, list(range(40)))


def test_repeated_rows_and_other_columns(spark):
    draw = np.random.default_rng(2)
    rows = draw.normal(size=(10, 3)).tolist() * 3
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], SCHEMA).selectExpr(
        "'x' AS component", "vec_id", "embedding", "1 AS VEC_ID", "2 AS n"
    )
    compare(whitening.whiten(frame).collect(), rows, list(range(30)))
    null = spark.createDataFrame([(None, r) for r in rows], SCHEMA)
    found = whitening.whiten(null).collect()
    assert len(found) == 90 and {row["vec_id"] for row in found} == {None}


def test_without_variance(spark):
    for data in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(data, SCHEMA)).collect() == []
    # One direction of two has variance.
    line = [(i, [float(i), 2.0 * i]) for i in range(5)]
    found = whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert sorted((row["vec_id"], row["component"]) for row in found) == [(i, 1) for i in range(5)]


def test_large_numbers_are_exact(spark):
    rows = [[1e12 * i, 3.0 * i * i] for i in range(4)]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], SCHEMA)
    _, _, deviations, _ = plain(rows)
    found = {row["vec_id"]: row["deviation"] for row in whitening.whiten(frame).collect()}
    assert {i: int(v) for i, v in found.items()} == dict(enumerate(deviations))


@pytest.mark.parametrize(
    "spectrum",
    [
        np.ones(120),
        0.9 ** np.arange(300),
        np.r_[np.full(10, 5.0), np.ones(90)],
        np.r_[3.0, 2.0, 1.0, np.zeros(60)],
        np.linspace(1, 2, 150),
        np.array([2.0]),
    ],
)
def test_solver(spectrum):
    size = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(3).normal(size=(size, size)))[0]
    matrix = (turn * spectrum) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading_pairs(lambda v: matrix @ v, size, 8)
    top = np.sort(spectrum)[::-1][:8]
    assert np.abs(values - top).max() < 1e-12 * top[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12 * top[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(top))).max() < 1e-12


def test_minres_solves_indefinite_systems():
    draw = np.random.default_rng(4)
    matrix = draw.normal(size=(30, 30))
    matrix = matrix + matrix.T
    right = np.column_stack([draw.normal(size=(30, 3)), np.zeros(30)])
    shifts = np.array([0.0, 1.5, -2.0, 0.0])
    found = whitening.minres(lambda v, which: matrix @ v - v * shifts[which], right, 60, 1e-12)
    for i, shift in enumerate(shifts):
        left = matrix @ found[:, i] - shift * found[:, i] - right[:, i]
        assert np.abs(left).max() < 1e-8
