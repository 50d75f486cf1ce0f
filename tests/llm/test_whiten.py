import numpy as np
import pytest

from quirebind.llm import whiten


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, dims int")


def brute(vectors):
    """n, S, eigenvalues, eigenvectors, trace of the distinct whole vectors."""
    x = np.array(sorted({tuple(np.floor(256 * np.float64(np.float32(v))).astype(int)) for v in vectors}))
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    values, axes = np.linalg.eigh(v)
    return x, values[::-1], axes[:, ::-1].T, np.trace(v)


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for x in (
        rng.integers(-200, 200, (301, 7)), rng.integers(-2**40, 2**40, (65, 3)),
        np.array([[-2**63, 2**63 - 1], [2**63 - 1, 5]]), np.full((9, 2), -4),
    ):
        x = x.astype(np.int64)
        sums, both = whiten.products(x)
        big = x.astype(object)
        assert sums == list(big.sum(axis=0))
        for i in range(x.shape[1]):
            assert both[i] == [int((big[:, i] * big[:, j]).sum()) for j in range(i, x.shape[1])]
            for v in both[i]:
                assert sum(p << 32 * k for k, p in enumerate(whiten._limbs(v))) == v


def test_like_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 6)) * [3, 2, 1.5, 1, 0.2, 0.1]
    vectors = [list(map(float, v)) for v in base] + [list(map(float, base[0]))] * 200
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (902, [float("nan")] * 6, 1),
             (903, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], 1), (None, vectors[5], 1), (7, vectors[9], 1)]
    x, values, axes, trace = brute(vectors)
    n, s = len(x), x.sum(axis=0)
    monkeypatch.setattr(whiten, "BLOCK_ROWS", 70)
    monkeypatch.setattr(whiten, "BLOCK_ENTRIES", 64 * 6)
    got = whiten.whitened(frame(spark, rows).repartition(5)).collect()
    assert len(got) == 4 * (len(vectors) + 2)
    signs = {}
    for r in got:
        v = vectors[5] if r.vec_id is None else None
        if v is None and r.vec_id != 7:
            v = vectors[r.vec_id]
        if v is None:
            continue
        own = np.floor(256 * np.float64(np.float32(v)))
        k = r.component - 1
        want = (own - s / n) @ axes[k] / values[k] ** 0.5
        sign = signs.setdefault(k, np.sign(want * r.whitened))
        assert r.whitened == pytest.approx(sign * want, abs=1e-9)
        assert r.n == n and r.deviation == int(((n * own - s) ** 2).sum())
        assert r.explained == pytest.approx(values[k] / trace, rel=1e-9)
        assert 0 <= r.identity_error < 1e-9


def test_odd_tables(spark):
    one = whiten.whitened(frame(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error)
            for r in sorted(one, key=lambda r: (r.vec_id, r.component))] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)] * 2
    two = whiten.whitened(frame(spark, [
        (1, [1.0], 1), (2, [2.0], 1), (3, [0.0, 1.0], 1), (4, [1.0, 1.0], 1), (5, [], 1), (6, [3e38], 1),
    ])).collect()
    assert sorted((r.vec_id, r.component, r.n) for r in two) == [
        (1, 1, 3), (2, 1, 3), (3, 1, 2), (3, 2, 2), (4, 1, 2), (4, 2, 2), (6, 1, 3)]
    assert {r.vec_id: r.deviation for r in two}[6] is None
    assert {(r.vec_id, r.component): r.whitened for r in two}[3, 2] is None
    assert abs({(r.vec_id, r.component): r.whitened for r in two}[3, 1]) == pytest.approx(1)
    assert whiten.whitened(frame(spark, [])).collect() == []


def test_given_data(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    got = whiten.whitened(df).collect()
    vectors = [r.embedding for r in df.collect()]
    x, values, _, trace = brute(vectors)
    assert len(got) == 4 * len(vectors) and {r.n for r in got} == {len(x)}
    assert all(r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9) for r in got)
    assert max(r.identity_error for r in got) < 1e-9
