"""Whitening against a direct eigendecomposition."""

from collections import defaultdict

import numpy as np
import pytest

from tideline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string"


def scatter(x):
    apart = x - x.mean(0)
    return apart.T @ apart


def close(a, b, size):
    assert np.abs(a - b).max(initial=0) <= 1e-10 * max(np.abs(b).max(initial=0), 1) * size


@pytest.mark.parametrize("size", [1, 2, 5, 24])
@pytest.mark.parametrize("kind", ["plain", "equal values", "low rank", "constant"])
def test_spectra_follow_every_vector(size, kind):
    rng = np.random.default_rng(size)
    c = rng.normal(size=(120, size)) * np.linspace(1, 20, size)
    if kind == "equal values":
        c = np.round(c / 8)
    if kind == "low rank":
        c = rng.normal(size=(120, 1 + size // 3)) @ rng.normal(size=(1 + size // 3, size))
    if kind == "constant":
        c[:, : size // 2] = 3
    x = np.floor(64 * c).astype(np.int64) + 1_000_000
    parts = []
    for rows in (x[:70], x[70:], x[:0]):
        own = whitening.Spectrum.empty(size)
        for k, row in enumerate(rows, 1):
            own.add(row)
            if k in (1, 2, 30):
                close(own.q * own.d @ own.q.T, scatter(rows[:k].astype(float)), size)
        parts.append(own)
    total = whitening.Spectrum.empty(size)
    for p in parts:
        total.join(p)
    assert total.n == 120 and total.sums.tolist() == x.sum(0).tolist()
    close(total.q * total.d @ total.q.T, scatter(x.astype(float)), size)
    assert np.abs(total.q.T @ total.q - np.eye(size)).max() < 1e-12
    close(total.d, np.linalg.eigvalsh(scatter(x.astype(float))), size)


def test_secular_roots_interlace_and_solve():
    rng = np.random.default_rng(2)
    for k in (1, 2, 3, 40):
        d, z = np.sort(rng.normal(size=k)) * 10, rng.normal(size=k)
        z /= np.sqrt(z @ z)
        roots, delta = whitening.secular_roots(d, z, 0.7)
        assert (roots > d).all() and (roots[:-1] <= d[1:]).all() and roots[-1] <= d[-1] + 0.7 + 1e-9
        assert roots == pytest.approx(np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z)), abs=1e-9)
        assert delta == pytest.approx(d[:, None] - roots, abs=1e-12)


def test_numerators_are_exact():
    x, sums, n = np.array([[1_000_003, 999_000]]), np.array([7 * 10**18, 3]), 7 * 10**12
    assert whitening.numerators(x, n, sums).tolist() == [[n * 1_000_003 - 7 * 10**18, n * 999_000 - 3]]
    assert whitening._squares(np.array([[2**40, 3], [1, 2]])) == [None, 5]


def answers(frame, **how):
    found = defaultdict(list)
    for r in whitening.whiten(frame, **how).collect():
        found[r["vec_id"]].append(r)
    return {k: sorted(v, key=lambda r: r["component"]) for k, v in found.items()}


def test_whitened_vectors(spark):
    rng = np.random.default_rng(9)
    c = (rng.normal(size=(260, 20)) * np.linspace(1, 4, 20)).astype(np.float32)
    vectors = [v.tolist() for v in c]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[7]) for i in range(300)]
    bad = [None, [None] + [0.0] * 19, [float("nan")] * 20, [float("inf")] + [0.0] * 19, [1.0] * 19, []]
    frame = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows + list(zip(range(5000, 5006), bad, strict=True))], SCHEMA).repartition(5)
    got = answers(frame)
    x = np.floor(64 * c.astype(float)).astype(np.int64) + 1_000_000
    mean, n = x.sum(0) / len(x), len(x)
    values, basis = np.linalg.eigh(scatter(x.astype(float)) / n)
    values, basis = values[::-1], basis[:, ::-1]
    assert set(got) == {i for i, _ in rows}
    white = np.array([[r["whitened"] for r in got[i]] for i in range(n)])
    want = (x - mean) @ basis[:, :16] / np.sqrt(values[:16])
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-8
    signs = np.sign(white / want)
    assert (signs == signs[0]).all()
    assert np.abs(white.T @ white / n - np.eye(16)).max() < 1e-9
    for i in range(n):
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], x.sum(0), strict=True))
        assert {(r["n"], r["deviation"]) for r in got[i]} == {(n, exact)}
        assert [r["component"] for r in got[i]] == list(range(1, 17))
    assert [r["explained"] for r in got[0]] == pytest.approx(values[:16] / values.sum(), rel=1e-9)
    assert got[0][0]["identity_error"] < 1e-9
    assert [r["whitened"] for r in got[1000]] == [r["whitened"] for r in got[7]]


def test_many_parts_meet_in_a_tree(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (90, 3))
    fit = spark.createDataFrame([(v.tolist(),) for v in x], "x array<long>").repartition(40)
    found = whitening.spectrum(fit, 3, 2)
    assert found.n == 90 and found.sums.tolist() == x.sum(0).tolist()
    close(found.q * found.d @ found.q.T, scatter(x.astype(float)), 3)
    close(whitening.gram(fit, 90, found.sums, np.eye(3), 2) * 90, scatter(x.astype(float)), 3)


def test_odd_tables(spark):
    def table(*vectors):
        return spark.createDataFrame([(k, v, "", "", "") for k, v in enumerate(vectors)], SCHEMA)

    assert answers(table()) == {}
    assert answers(table(None, [None], [])) == {}
    assert answers(table([1.0, 2.0], [1.0, 2.0])) == {}  # a single different vector has no spread
    two = answers(table([1.0, 2.0], [1.0, 4.0], [1.0, 4.0], None))
    assert {k: [abs(r["whitened"]) for r in v] for k, v in two.items()} == {k: [pytest.approx(1.0)] for k in range(3)}
    assert two[0][0]["explained"] == pytest.approx(1.0) and two[0][0]["n"] == 2 and two[0][0]["deviation"] == 128**2
    nothing = spark.createDataFrame([(None, [float(k % 3)]) for k in range(4)], "vec_id long, embedding array<double>")
    assert len(answers(nothing)[None]) == 4
