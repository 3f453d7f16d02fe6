import math
import random
from fractions import Fraction

import numpy as np
import pytest

from indicatrix.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, whitened string"


def rows_of(n, dims, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(dims, dims)) * spread
    return [(i, np.float32(v).tolist(), 0, "x", "y") for i, v in enumerate(rng.normal(size=(n, dims)).dot(mixing))]


def usable(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def brute(rows, count=8):
    """By numpy's symmetric eigenvalues; deviations by Python's whole numbers."""
    rows = usable(rows)
    width = max((len(r[1]) for r in rows), default=0)
    x = [[math.floor(1024 * c) + 100000 for c in r[1]] + [100000] * (width - len(r[1])) for r in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(line, sums)) for line in x]
    centred = np.array(x, float) - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T.dot(centred) / n)
    keep = [k for k in np.argsort(-values)[:count] if values[k] > 1e-7 * values.max()]
    return rows, n, deviation, centred.dot(axes[:, keep]) / np.sqrt(values[keep]), values[keep] / values.sum()


def check(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    got = got.collect()
    kept, n, deviation, white, explained = brute(rows)
    assert len(got) == n * len(explained) and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    tell = lambda r: (r["vec_id"] is None, r["vec_id"], r["deviation"])
    want = sorted((r[0] is None, r[0], d if d < 2**63 else None) for r, d in zip(kept, deviation))
    for k, share in enumerate(explained):
        mine = sorted((r for r in got if r["component"] == k + 1), key=tell)
        assert [tell(r) for r in mine] == want
        assert all(abs(r["explained"] / share - 1) < 1e-9 for r in mine)
        a = np.array([r["whitened"] for r in mine])
        b = white[[i for i, _ in sorted(enumerate(kept), key=lambda p: (p[1][0] is None, p[1][0], deviation[p[0]]))], k]
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6


def test_against_numpy(spark):
    check(spark, rows_of(200, 12))


def test_odd_rows(spark):
    rows = rows_of(80, 5, 2) + [(None, [0.5] * 5, 0, "", ""), (7, [0.25] * 5, 0, "", ""), (7, [0.25] * 5, 0, "", "")]
    rows += [(100, None, 0, "", ""), (101, [1.0, None, 0.0, 0.0, 0.0], 0, "", ""), (102, [float("nan")] * 5, 0, "", ""), (103, [float("-inf")], 0, "", ""), (104, [], 0, "", ""), (105, [2.0], 0, "", "")]
    check(spark, rows)


def test_few_positive_eigenvalues(spark):
    rng = random.Random(4)
    rows = [(i, [a, 2 * a, 0.0, b], 0, "", "") for i in range(40) for a, b in [(rng.randint(-9, 9) / 1024, rng.randint(-9, 9) / 8)]]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert {r["component"] for r in got.collect()} == {1, 2} and got.count() == 80
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 1.0], 0, "", "")], [(1, [0.5], 0, "", ""), (2, [0.5], 0, "", "")], [(1, [], 0, "", "")], [(1, None, 0, "", "")]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_huge_entries(spark):
    rows = [(i, [float(x), float(y)], 0, "", "") for i, (x, y) in enumerate([(3e30, 1), (-3e30, 2), (1e10, 3), (5.0, -4e12)])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 8 and all(r["deviation"] is None for r in got) and got[0]["identity_error"] < 1e-9


def test_equal_eigenvalues(spark):
    """Axes of one eigenvalue are not determined, but have to be orthogonal."""
    rows = [(i, [s / 4 if k == axis else 0.0 for k in range(4)], 0, "", "") for i, (axis, s) in enumerate((a, s) for a in range(4) for s in (-1, 1))]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 32 and got[0]["identity_error"] < 1e-12 and {round(r["explained"], 12) for r in got} == {0.25}


def exact_polynomial(matrix):
    """By traces of powers, over fractions."""
    d, out, power = len(matrix), [Fraction(1)], [[Fraction(int(i == j)) for j in range(len(matrix))] for i in range(len(matrix))]
    for k in range(1, d + 1):
        power = [[sum(a * power[m][j] for m, a in enumerate(line)) for j in range(d)] for line in matrix]
        c = -sum(power[i][i] for i in range(d)) / k
        out.append(c)
        for i in range(d):
            power[i][i] += c
    return [int(c) for c in reversed(out)]


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 7):
        half = rng.integers(-(10**6), 10**6, (d, d)).astype(object)
        matrix = half.dot(half.T).tolist()
        found = whitening.characteristic(spark, matrix)
        assert found == exact_polynomial(matrix)
        values = sorted(np.linalg.eigvalsh(np.array(matrix, float)), reverse=True)
        for rank in range(d):
            low, scale = whitening.isolated_root(found, rank + 1, sum(matrix[i][i] for i in range(d)))
            assert abs((low / 2**scale) / values[rank] - 1) < 1e-6
            assert whitening.roots_above(found, low, scale) > rank >= whitening.roots_above(found, low + 1, scale)


def test_close_eigenvalues():
    """Eigenvalues 10^40 and 10^40 + 1 of a turned matrix: their vectors are told apart."""
    big = 10**40
    # Columns (3, 4) / 5 and (-4, 3) / 5, all times 25.
    matrix = [[9 * (big + 1) + 16 * big, 12 * (big + 1) - 12 * big], [12 * (big + 1) - 12 * big, 16 * (big + 1) + 9 * big]]
    polynomial = exact_polynomial(matrix)
    vectors = [whitening.null_vectors(matrix, whitening.isolated_root(polynomial, rank, 50 * big + 25), 1)[0] for rank in (1, 2)]
    assert np.allclose(vectors, [[0.6, 0.8], [0.8, -0.6]], atol=1e-15)


def test_product_sums_of_any_size():
    rng = np.random.default_rng(6)
    for most in (10, 2**25, 2**40, 2**62):
        table = rng.integers(-most, most, (30, 3))
        want = np.concatenate([np.ones((30, 1), object), table.astype(object)], axis=1)
        assert whitening.product_sums(table) == want.T.dot(want).tolist()
