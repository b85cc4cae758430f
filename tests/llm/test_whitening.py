"""Whitening against numpy's eigendecomposition of the whole covariance, and its parts by themselves."""

import math
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import whitening as W
from panelcast.llm.queries import op11_embedding_whitening
from panelcast.llm.whitening import Spectrum, combined, deviations, rank_one, secular_roots, square_sums, whiten
from panelcast.session import stored

SCHEMA = "vec_id long, embedding array<float>, x int, n string, component double"


def frame(spark, rows):
    """(vec_id, vector) with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(k, v, 1, "n", 0.5) for k, v in rows], SCHEMA)


def plain(rows, components=16, scale=64, shift=1_000_000):
    """Rows by key: component -> (n, deviation, whitened), with explained and identity error, by one dense decomposition."""
    fine = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    sizes = Counter(len(v) for _, v in fine)
    size = max(sizes, key=lambda s: (sizes[s], s))
    grid = [(k, tuple(math.floor(scale * float(np.float32(c))) + shift for c in v)) for k, v in fine if len(v) == size]
    fit = np.array(sorted({x for _, x in grid}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centre = (fit * n - sums) / n
    values, vectors = np.linalg.eigh(centre.T @ centre / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [k for k in range(min(components, size)) if values[k] > 1e-12 * values[0]]
    out = []
    for key, x in grid:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        y = ((np.array(x) * n - sums) / n) @ vectors[:, kept] / np.sqrt(values[kept])
        out += [(key, c + 1, n, deviation, y[c], values[c] / values.sum()) for c in range(len(kept))]
    return out


def check(got, expected):
    assert len(got) == len(expected)
    key = lambda r: (r[0] is None, r[0] or 0, r[3], r[1])
    got = sorted([tuple(r) for r in got], key=lambda r: (*key(r), abs(r[4])))
    expected = sorted(expected, key=lambda r: (*key(r), abs(r[4])))
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)
    for c in {r[1] for r in got}:
        a, b = (np.array([r[4] for r in rows if r[1] == c]) for rows in (got, expected))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert len({r[6] for r in got}) <= 1 and all(r[6] < 1e-8 for r in got)


def cloud(n, size, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) / 4).astype(np.float32)


def test_secular_roots_and_vectors():
    rng = np.random.default_rng(1)
    for trial in range(200):
        k = int(rng.integers(1, 30))
        d = np.sort(rng.normal(size=k) ** 2 * 10.0 ** rng.integers(-3, 4, k))
        if trial % 3 == 0:
            d[: k // 2] = d[k // 2] if k > 1 else d[0]  # equal eigenvalues
            d.sort()
        if trial % 4 == 0:
            d = d + np.arange(k) * 1e-13  # nearly equal ones
        basis = np.linalg.qr(rng.normal(size=(k, k)))[0]
        v = rng.normal(size=k) * 10.0 ** rng.integers(-4, 3)
        if trial % 5 == 0:
            v = basis[:, 0] * 2.0  # all but one direction untouched
        dense = basis @ np.diag(d) @ basis.T + np.outer(v, v)
        values, vectors = rank_one(d, basis, v)
        size = max(1e-300, np.abs(dense).max())
        assert np.abs(np.sort(np.linalg.eigvalsh(dense)) - values).max() <= 1e-12 * size
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
        assert np.abs(vectors @ np.diag(values) @ vectors.T - dense).max() <= 1e-11 * size


def test_roots_lie_between_the_poles():
    d, z = np.array([1.0, 2.0, 2.0 + 1e-9, 50.0]), np.array([0.5, 1e-6, 0.3, 2.0])
    roots, apart = secular_roots(d, z)
    between = np.tri(4, dtype=bool).T  # the poles behind each root are larger
    assert (apart[~between | np.eye(4, dtype=bool)] < 0).all() and (apart[between & ~np.eye(4, dtype=bool)] > 0).all()
    assert roots[-1] <= d[-1] + z @ z * (1 + 1e-15)
    terms = z * z / apart
    assert (np.abs(1 + terms.sum(axis=1)) <= 1e-14 * (1 + np.abs(terms).sum(axis=1))).all()


def test_updates_and_joins_give_the_scatter():
    x = np.floor(64 * cloud(300, 12)).astype(np.int64) + 1_000_000
    parts = []
    for part in (x[:1], x[1:100], x[100:100], x[100:]):
        s = Spectrum.none(12)
        for row in part:
            s.add(row)
        parts.append(Spectrum.load(s.dump(), 12))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.join(p)
    centre = x - x.mean(axis=0)
    assert whole.n == 300 and (whole.sums == x.sum(axis=0)).all()
    scatter = centre.T @ centre
    assert np.abs(whole.basis @ np.diag(whole.values) @ whole.basis.T - scatter).max() < 1e-9 * np.abs(scatter).max()


@pytest.mark.parametrize("task_rows", [2048, 20])
def test_whitened_vectors(spark, monkeypatch, task_rows):
    monkeypatch.setattr(W, "TASK_ROWS", task_rows)  # 20: several rounds of combining
    x = cloud(700, 20)
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(k, x[0].tolist()) for k in range(5)] + [(None, x[3].tolist())]
    rows += [(900, None), (901, [None] * 20), (902, [float("nan")] * 20), (903, [float("inf")] + [0.0] * 19), (904, []), (905, [1.0] * 7)]
    check(whiten(frame(spark, rows)).collect(), plain(rows))


def test_few_directions_and_few_vectors(spark):
    flat = cloud(60, 2) @ np.array([[1, 0, 2, 0], [0, 0, 1, 0]], np.float32)
    rows = [(k, np.round(v * 64).tolist()) for k, v in enumerate(flat)]  # two directions of four
    got = whiten(frame(spark, rows), scale=1).collect()
    assert {r["component"] for r in got} == {1, 2}
    check(got, plain(rows, scale=1))
    two = [(1, [0.0, 1.0]), (2, [3.0, 1.0])]
    check(whiten(frame(spark, two)).collect(), plain(two))


def test_no_variance_and_no_vectors(spark):
    assert whiten(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect() == []
    assert whiten(frame(spark, [(1, []), (2, None)])).collect() == []
    assert whiten(frame(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whiten(frame(spark, [])).collect() == []


def test_exact_whole_numbers():
    x, n = np.array([[1 << 40, -5]], np.int64), 1 << 30
    sums = np.array([(1 << 69) % (1 << 62), 7], np.int64)
    assert deviations(x, n, sums).tolist() == [[(1 << 70) - int(sums[0]), -5 * n - 7]]
    assert square_sums(np.array([[3, 4], [1 << 31, 0]])).tolist() == [25, 1 << 62]
    with pytest.raises(OverflowError):
        square_sums(np.array([[1 << 32, 1 << 32]], object))


def test_combining_in_rounds(spark):
    parts = spark.createDataFrame([(k, bytes([k % 256])) for k in range(300)], "task long, data binary")
    assert combined(stored(parts, "parts"), lambda a, b: a + b) == bytes(k % 256 for k in range(300))
    assert combined(stored(parts.limit(0), "parts"), lambda a, b: a + b) is None


def test_given_embeddings(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op11_embedding_whitening(spark, sf).collect(), plain(rows))
