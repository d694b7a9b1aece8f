"""Whitening against numpy's own eigenvectors and whole numbers in plain Python."""

import math

import numpy as np
import pytest

from siteatlas.llm import queries, whitening
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, component string, n int"


def expected(rows, k=4):
    """{position: (deviation, whitened)} , explained, by the contract's words."""
    xs = {}
    for at, (_, v) in enumerate(rows):
        if v and all(c is not None and math.isfinite(c) for c in v):
            xs[at] = tuple(math.floor(256 * float(np.float32(c))) for c in v)
    fit = sorted(set(xs.values()))
    n = len(fit)
    sums = [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors.T[::-1][:k]
    out = {}
    for at, x in xs.items():
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        out[at] = deviation, (np.array(x) - np.array(sums) / n) @ vectors.T / np.sqrt(values)
    return n, out, values / np.trace(centred.T @ centred / n)


def run(spark, rows):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return whitening.whiten(table).collect()


def check(found, rows):
    n, want, explained = expected(rows)
    by_id = {rows[at][0]: at for at in want}
    assert len(found) == 4 * len(want)
    sign = {}
    for r in found:
        deviation, white = want[by_id[r.vec_id]]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
        value = white[r.component - 1]
        if abs(value) > 1e-3:
            sign.setdefault(r.component, np.sign(value) * np.sign(r.whitened))
            assert r.whitened == pytest.approx(value * sign[r.component], rel=1e-7, abs=1e-9)


def test_against_numpy(spark):
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(12, 12))
    rows = [(i, (rng.normal(size=12) @ spread).tolist()) for i in range(300)]
    check(run(spark, rows), rows)


def test_repeats_nulls_and_lengths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    hot = rows[3][1]
    rows += [(100 + i, hot) for i in range(30)]  # one vector in many rows counts once
    plain = list(rows)
    rows += [(200, None), (201, []), (202, [1.0] * 5 + [None]), (203, [math.nan] * 6), (204, [math.inf] + [0.0] * 5), (205, [0.0] * 6), (206, [1.0, 2.0])]
    plain.append((205, [0.0] * 6))
    check(run(spark, rows), plain)


def test_edge_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [])]) == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance
    found = run(spark, [(1, [1.0, 5.0]), (2, [3.0, 5.0]), (None, [1.0, 5.0]), (1, [1.0, 5.0])])  # one direction
    assert sorted((str(r.vec_id), r.component, round(abs(r.whitened), 9), r.explained) for r in found) == [("1", 1, 1.0, 1.0), ("1", 1, 1.0, 1.0), ("2", 1, 1.0, 1.0), ("None", 1, 1.0, 1.0)]
    big = run(spark, [(1, [1e30, 0.0]), (2, [0.0, 1e15]), (3, [1.0, -1e15]), (4, [0.5, 3.0])])
    assert {r.vec_id for r in big} == {2, 3, 4} and all(r.deviation is None for r in big if r.vec_id != 4)


@pytest.mark.parametrize("matrix", ["random", "equal", "split", "tiny"])
def test_leading_components(matrix):
    rng = np.random.default_rng(7)
    basis, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    values = {
        "random": np.sort(rng.random(30))[::-1],
        "equal": np.array([3.0, 3.0, 3.0, 3.0] + [1.0] * 26),
        "split": np.concatenate([[5, 5, 2, 2], np.zeros(26)]),
        "tiny": np.geomspace(1e-20, 1e-40, 30),
    }[matrix]
    basis = np.eye(30)[rng.permutation(30)] if matrix == "split" else basis
    whole = (basis * values) @ basis.T
    found, vectors = whitening.leading_components((whole + whole.T) / 2, 4)
    assert found == pytest.approx(values[:4], rel=1e-12)
    assert vectors @ vectors.T == pytest.approx(np.eye(4), abs=1e-10)
    assert np.abs(whole @ vectors.T - vectors.T * found).max() <= 1e-12 * values[0]


def test_query_on_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, r.embedding) for r in table]
    check(queries.QUERIES["op13_whitening"](spark, SF).collect(), rows)
