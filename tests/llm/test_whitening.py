"""Whitening against a dense eigenvalue decomposition, and the method itself on matrices with awkward spectra."""

from __future__ import annotations

from math import floor, isfinite
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from samedays.llm import whitening
from samedays.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def spectrum(kind: str, size: int) -> np.ndarray:
    rng = np.random.default_rng(size)
    return {
        "spread": rng.random(size),
        "decaying": 1 / np.arange(1, size + 1),
        "close": 1 + 1e-3 * rng.random(size),
        "ties": np.repeat(rng.random(-(-size // 4)), 4)[:size],
        "low rank": np.r_[rng.random(size // 4), np.zeros(size - size // 4)],
        "negative": rng.random(size) - 0.5,
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "decaying", "close", "ties", "low rank", "negative"])
@pytest.mark.parametrize("size", [1, 6, 40, 150])
def test_jacobi_davidson(kind, size):
    values = spectrum(kind, size)
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((size, size)))[0]
    matrix = (turn * values) @ turn.T * 1e4
    matrix = (matrix + matrix.T) / 2
    wanted = min(size, 12)
    found, vectors = whitening.jacobi_davidson(lambda block: matrix @ block, size, wanted)
    largest = np.abs(matrix).sum(axis=0).max() or 1
    assert np.allclose(found, np.sort(np.linalg.eigvalsh(matrix))[::-1][:wanted], atol=1e-11 * largest)
    assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-11 * largest
    assert np.allclose(vectors.T @ vectors, np.eye(wanted), atol=1e-12)


def brute(rows: list[tuple], components: int = 32) -> dict:
    kept = [(i, v) for i, v in rows if v is not None and len(v) and all(e is not None and isfinite(e) for e in v)]
    x = np.array([[floor(64 * float(np.float32(e))) + 1_000_000 for e in v] for _, v in kept], dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    many = min(components, x.shape[1])
    values, vectors = values[::-1][:many], vectors[:, ::-1][:, :many]
    deviation = [sum(int(d) ** 2 for d in n * row - sums) for row in x]
    with np.errstate(all="ignore"):
        whitened = centred @ vectors / np.sqrt(values)
    return {"ids": [i for i, _ in kept], "n": n, "deviation": deviation, "whitened": whitened, "values": values, "explained": values / (centred**2).sum() * n}


def check(made: list, expected: dict, many: int) -> None:
    assert len(made) == len(expected["ids"]) * many
    by_component = {}
    for row in made:
        assert row.n == expected["n"] and row.identity_error <= 1e-4
        by_component.setdefault(row.component, {}).setdefault((row.vec_id is None, row.vec_id, row.deviation), []).append(row)
    assert sorted(by_component) == list(range(1, many + 1))
    for component, rows in by_component.items():
        at = component - 1
        wanted = {}
        for vec_id, deviation, value in zip(expected["ids"], expected["deviation"], expected["whitened"][:, at], strict=True):
            wanted.setdefault((vec_id is None, vec_id, deviation), []).append(value)
        assert set(rows) == set(wanted)
        found = np.concatenate([sorted(r.whitened for r in rows[key]) for key in wanted])
        same = np.concatenate([sorted(wanted[key]) for key in wanted])
        turned = np.concatenate([sorted(-v for v in wanted[key]) for key in wanted])
        assert min(np.abs(found - same).max(), np.abs(found - turned).max()) < 1e-6
        assert abs(next(iter(rows.values()))[0].explained / expected["explained"][at] - 1) < 1e-9


def test_awkward_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(v) for v in rng.standard_normal(5) * [3, 1, 2, 0.5, 5]]) for i in range(200)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, [0.0] * 5)] + [(500, rows[1][1])] * 100
    odd = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [float("nan")] * 5), (904, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (905, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + odd, SCHEMA).select("*", F.lit(1).alias("x"), F.lit(2).alias("component"), F.lit(3).alias("n"))
    check(whitening.whiten(frame.repartition(5)).collect(), brute(rows), 5)


def test_more_dimensions_than_components(spark):
    rng = np.random.default_rng(8)
    mixed = rng.standard_normal((300, 70)) @ np.diag(1 + np.arange(70) / 5) * 4
    rows = [(i, [float(v) for v in vector]) for i, vector in enumerate(mixed)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows), 32)


def test_without_variance(spark):
    def whitened(rows):
        return whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()

    assert whitened([]) == [] and whitened([(1, None)]) == []
    assert whitened([(1, [1.0, 2.0])]) == [] and whitened([(1, [1.0, 2.0])] * 3) == []
    rows = [(i, [float(i % 5), 2.0 * (i % 5), float(i % 3)]) for i in range(30)]
    made = whitened(rows)
    assert {r.component for r in made} == {1, 2} and len(made) == 60


def test_deviations_beyond_64_bits_stop_the_job(spark):
    rows = [(i, [float(i * 2**32), 1.0]) for i in range(50)]
    with pytest.raises(Exception, match="int|large|overflow|Overflow"):
        whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the given tables")
def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check(QUERIES["op13_whitening"](spark, SF_DIR).collect(), brute(rows), 32)
