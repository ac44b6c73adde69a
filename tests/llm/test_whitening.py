import numpy as np
import pytest

from deadhead.llm import queries, whitening


def near(got, want):
    return np.allclose(got, want, rtol=0, atol=1e-9 * max(1.0, np.abs(want).max()))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64])
@pytest.mark.parametrize("kind", ["random", "diagonal", "repeated", "low rank", "near", "blocks", "zero"])
def test_eigenvectors(n, kind):
    r = np.random.default_rng(n)
    a = r.normal(size=(n, 3 * n))
    m = a @ a.T
    q = np.linalg.qr(r.normal(size=(n, n)))[0]
    if kind == "diagonal":
        m = np.diag(r.permutation(n).astype(float))
    if kind == "repeated":
        m = q @ np.diag([9.0] * min(n, 3) + [1.0] * (n - min(n, 3))) @ q.T
    if kind == "low rank":
        m = a[:, :2] @ a[:, :2].T
    if kind == "near":
        m = q @ np.diag(5 + 1e-9 * np.arange(n)) @ q.T
    if kind == "blocks":
        m[: n // 2, n // 2 :] = m[n // 2 :, : n // 2] = 0
    if kind == "zero":
        m = np.zeros((n, n))
    m = (m + m.T) / 2
    k = min(4, n)
    values, vectors = whitening.leading(m, k)
    assert near(values, np.linalg.eigvalsh(m)[::-1][:k])
    assert near(vectors.T @ vectors, np.eye(k))
    assert near(m @ vectors, vectors * values)


def brute(rows, k=4):
    """(vec_id, component, n, deviation, |whitened|, explained) by numpy's own solver."""
    good = [(i, [float(c) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    good = [(i, v) for i, v in good if len(v) == max(set(lengths), key=lambda n: (lengths.count(n), n))]
    x = [[int(np.floor(256 * c)) for c in v] for _, v in good]
    distinct = sorted(set(map(tuple, x)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    c = np.array(distinct, float) - np.array(sums) / n
    e, vectors = np.linalg.eigh(c.T @ c / n)
    out = []
    for (i, _), row in zip(good, x, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        for j in range(min(k, len(sums))):
            value = abs((np.array(row) - np.array(sums) / n) @ vectors[:, -1 - j]) / np.sqrt(e[-1 - j])
            out.append((i, j + 1, n, deviation, value, e[-1 - j] / e.sum()))
    return out


def compare(got, want):
    rows = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=repr)
    want = sorted(want, key=repr)
    assert [r[:4] for r in rows] == [w[:4] for w in want]
    assert np.allclose([r[4:] for r in rows], [w[4:] for w in want], rtol=0, atol=1e-8)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op11_whitening(spark, "/root/testdata/sf0.001")
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), brute(rows))


def odd_rows():
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).astype(np.float32).tolist()) for i in range(200)]
    rows += [rows[0], (500, rows[1][1]), (None, rows[2][1]), (501, None), (502, []), (503, [1.0] * 5), (504, [1.0] * 5 + [None]), (505, [float("nan")] * 6), (506, [float("-inf")] + [0.0] * 5)]
    return rows + [(600 + i, [0.5] * 6) for i in range(300)] + [(507, [-0.0] * 6)]


def test_odd_rows(spark, tmp_path):
    d = spark.createDataFrame([(i, v, 1.0, "a") for i, v in odd_rows()], "vec_id long, embedding array<float>, x double, white string")
    d.write.parquet(f"{tmp_path}/embeddings.parquet")
    compare(queries.op11_whitening(spark, str(tmp_path)).collect(), brute(odd_rows()))
    model = whitening.fit(d)
    kept = whitening.whiten(d, model)
    assert kept.columns == ["vec_id", "embedding", "x", "white"] and kept.count() == 504


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float((-1) ** i * 3 * 10**15 + i), 1e12 * i, 1.0]) for i in range(50)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(d)
    x = [[int(256 * c) for c in v] for _, v in rows]
    assert list(model.sums) == [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((50 * a - s) ** 2 for a, s in zip(v, model.sums, strict=True)) for (i, _), v in zip(rows, x, strict=True)}
    got = {r.vec_id: None if r.white.deviation is None else int(r.white.deviation) for r in whitening.whiten(d, model).collect()}
    assert got == {i: v if v < 10**38 else None for i, v in want.items()}
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(huge, whitening.fit(huge)).count() == 2


def test_degenerate_tables(spark, tmp_path):
    d = spark.createDataFrame([], "vec_id long, embedding array<float>")
    d.write.parquet(f"{tmp_path}/empty/embeddings.parquet")
    assert queries.op11_whitening(spark, f"{tmp_path}/empty").collect() == []
    d = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "vec_id long, embedding array<float>")
    d.write.parquet(f"{tmp_path}/equal/embeddings.parquet")
    rows = queries.op11_whitening(spark, f"{tmp_path}/equal").collect()
    assert len(rows) == 18 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(1, 0, None, None, None)}
    d = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(9)], "vec_id long, embedding array<float>")
    d.write.parquet(f"{tmp_path}/line/embeddings.parquet")
    rows = queries.op11_whitening(spark, f"{tmp_path}/line").collect()
    assert {(r.component, r.whitened is None) for r in rows} == {(1, False), (2, True)}
