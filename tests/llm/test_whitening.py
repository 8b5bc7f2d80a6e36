"""Whitening against numpy's eigenvectors of the covariance, and exact sums against whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StructField, StructType

from recordlake.llm import queries, whitening
from recordlake.llm.whitening import bidiagonalised, center_of, fitted, row_blocks, whitened

SF_DIR = "/root/testdata/sf0.001"
VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))])


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame(rows, VECTORS).repartition(3)


def plain(rows):
    """x of the rows that count, and eigenvalues and eigenvectors of their covariance."""
    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    a = np.array(x, np.float64)
    a = a - a.mean(0)
    values, columns = np.linalg.eigh(a.T @ a / len(a))
    return kept, x, a, values[::-1], columns[:, ::-1]


def check(found, rows, components=32):
    kept, x, a, values, columns = plain(rows)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    r = int((values[:components] > 1e-10 * values[0]).sum())
    assert len(found) == n * r
    by_key = {}
    for row in found:
        by_key.setdefault(row["vec_id"], {}).setdefault(row["component"], row)
    wanted = a @ columns[:, :r] / np.sqrt(values[:r])
    signs = np.zeros(r)
    for (key, _), entries, scaled in zip(kept, x, wanted):
        assert sorted(by_key[key]) == list(range(1, r + 1))
        deviation = sum((n * c - s) ** 2 for c, s in zip(entries, sums))
        for i in range(r):
            row = by_key[key][i + 1]
            assert (row["n"], row["deviation"]) == (n, deviation)
            assert row["explained"] == pytest.approx(values[i] / values.sum(), rel=1e-9)
            assert row["identity_error"] < 1e-9
            if abs(scaled[i]) > 1e-3:
                sign = np.sign(row["whitened"] * scaled[i])
                assert signs[i] in (0, sign)
                signs[i] = sign
            assert row["whitened"] * (signs[i] or 1) == pytest.approx(scaled[i], abs=1e-6)


def random_rows(n, d, seed, spread=None):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) @ np.diag(spread if spread is not None else np.geomspace(9, 0.5, d))
    return [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(x @ np.linalg.qr(rng.standard_normal((d, d)))[0])]


def test_components_are_those_of_the_covariance(vectors):
    rows = random_rows(300, 12, 1)
    check(whitened(vectors(rows)).collect(), rows)
    check(whitened(vectors(rows), components=4).collect(), rows, 4)


def test_few_dimensions_carry_all_variance(vectors):
    rows = [(k, [float(k % 7), float(k % 3), 2.0, float(k % 7) + 1]) for k in range(60)]
    check(whitened(vectors(rows)).collect(), rows)


def test_rows_that_do_not_count(vectors):
    rows = random_rows(40, 3, 2) + [
        (90, None), (91, [1.0, None, 2.0]), (92, [float("nan"), 0.0, 0.0]), (93, [float("-inf"), 0.0, 0.0]), (94, []),
    ]
    found = whitened(vectors(rows).withColumns({"a.b": F.lit(1), "keys": F.lit(2), "n": F.lit(3)})).collect()
    check(found, rows)


def test_repeated_rows_and_null_keys_count(vectors):
    rows = random_rows(20, 3, 3)
    doubled = whitened(vectors(rows + rows + [(None, [1.0, 2.0, 3.0])]))
    assert doubled.count() == 41 * 3 and doubled.where("vec_id is null").count() == 3
    assert doubled.where("vec_id = 4").select("whitened", "component").distinct().count() == 3


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)], [(1, None)]])
def test_no_variance_gives_no_rows(vectors, rows):
    found = whitened(vectors(rows))
    assert found.count() == 0 and "identity_error" in found.columns


def test_lengths_must_agree(vectors):
    with pytest.raises(ValueError, match="lengths"):
        whitened(vectors([(1, [1.0]), (2, [1.0, 2.0])]))


def test_equal_eigenvalues_are_all_found(vectors):
    corners = [(k, [8.0 * ((k >> i) & 1) for i in range(6)]) for k in range(64)]
    found = fitted(row_blocks(vectors(corners), "embedding", "vec_id", 64, 0))
    assert np.allclose(found.eigenvalues, np.full(6, 256.0**2)) and found.components.shape == (6, 6)
    assert np.allclose(found.components.T @ found.components, np.eye(6), atol=1e-13)


def test_steps_end_early_where_nothing_can_be_missed(vectors, monkeypatch):
    rows = random_rows(200, 30, 5, np.r_[np.full(3, 50.0) * [1, 2, 3], np.full(27, 0.05)])
    blocks, passes = row_blocks(vectors(rows), "embedding", "vec_id", 64, 0), []
    real = whitening.summed
    monkeypatch.setattr(whitening, "summed", lambda b, f: passes.append(1) or real(b, f))
    form, squares = bidiagonalised(blocks, center_of(blocks), 3)
    assert len(passes) < 15
    assert np.allclose(form.right.T @ form.right, np.eye(len(form.diagonal)), atol=1e-13)
    _, _, _, values, _ = plain(rows)
    sizes = np.linalg.svd(form.matrix())[1]
    assert np.allclose(sizes[:3] ** 2 / 200, values[:3], rtol=1e-10)


def test_large_numbers_stay_exact(vectors):
    # Deviations of up to 6e18: two of them would not fit a long, so they are not bounded safely.
    rows = [(k, [float(k) * 1963, float(k % 7)]) for k in range(200)]
    found = whitened(vectors(rows)).collect()
    check(found, rows)
    assert max(r["deviation"] for r in found) > 6e18


def test_deviations_beyond_a_long_fail(vectors):
    rows = [(k, [float(k) * 2.0**22, float(k * k)]) for k in range(200)]
    with pytest.raises(Exception, match="[Oo]verflow|too large|too big"):
        whitened(vectors(rows)).collect()


def test_the_query_against_numpy(spark):
    found = queries.QUERIES["op11_whitening"](spark, SF_DIR).collect()
    rows = [tuple(r) for r in queries.table(spark, SF_DIR, "embeddings").select("vec_id", "embedding").collect()]
    check(found, rows)
