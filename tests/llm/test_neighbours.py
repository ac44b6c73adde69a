import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from deadhead.llm import neighbours as nn


def brute(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault((i, tuple(v)))
    good = list(good)
    out = {}
    for i, v in good:
        if i % every == 0:
            near = sorted(((-(np.array(v) * np.array(w)).sum(), j) for j, w in good if j != i))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def rows(n=700, seed=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, 8)) * 3
    x = centres[r.integers(0, 12, n)] + r.normal(size=(n, 8)) * 0.4
    out = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    out += [(1000 + i, out[0][1]) for i in range(200)]  # a hot vector
    return out + [(5, out[5][1]), (None, out[1][1]), (2000, None), (2005, []), (2010, [0.0] * 8), (2015, [1.0, None] * 4), (2020, [float("nan")] * 8), (2025, [float("inf")] * 8), (2030, [1.0] * 3)]


@pytest.mark.parametrize("part", [nn.PART, 100])
def test_recall_and_exact_scores(spark, monkeypatch, part):
    monkeypatch.setattr(nn, "PART", part)
    data = rows()
    d = spark.createDataFrame([(i, v, 3, 0) for i, v in data], "vec_id long, embedding array<double>, query_id int, rank int")
    got = {}
    for r in nn.search(d, F.col("id") % 5 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    want = brute(data, 10, 5)
    assert got.keys() == want.keys()
    vectors = {i: np.array(v) for i, v in data if v and i is not None and None not in v}
    hits = 0
    for q, near in got.items():
        assert [r for *_, r in near] == list(range(1, 11)) and q not in [i for i, *_ in near]
        assert [(-s, i) for i, s, _ in near] == sorted((-s, i) for i, s, _ in near)
        assert all(math.isclose(s, (vectors[q] * vectors[i]).sum(), rel_tol=1e-12) for i, s, _ in near)
        hits += len({i for i, *_ in near} & {i for i, _ in want[q]})
    assert hits >= 0.9 * sum(map(len, want.values()))


def scattered(n, size, seed=3):
    x = np.random.default_rng(seed).normal(size=(n, size))
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize(("limit", "least"), [(30, 3), (1, 6)])
def test_recall_where_the_list_of_probes_is_short(spark, monkeypatch, limit, least):
    monkeypatch.setattr(nn, "TEMPLATE", limit)  # of 3 ** 7 offsets
    monkeypatch.setattr(nn, "LEAST_HASHES", least)
    x = scattered(2500, 16)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in nn.search(d, F.col("id") % 20 == 0, k=10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x[::20] @ x.T
    want = {20 * q: set([int(i) for i in np.argsort(-row) if i != 20 * q][:10]) for q, row in enumerate(scores)}
    share = sum(len(got[q] & w) for q, w in want.items()) / (10 * len(want))
    assert share >= 0.93 and (share == 1.0 or limit > 1)


def test_hashes_are_left_out_until_the_list_does():
    r = np.random.default_rng(1)
    x = scattered(48, 32)
    near = []
    for v in x:  # neighbours at a distance of 1.2, as in a table of very many points; 3 ** 14 offsets
        side = r.normal(size=(10, 32))
        side -= np.outer(side @ v, v)
        near.append(0.28 * v + 0.96 * side / np.linalg.norm(side, axis=1)[:, None])
    sample = nn.Sample(x, np.repeat(np.arange(48), 10), np.concatenate(near))
    probes, reached = nn._needed(sample, nn.Hashing(32, 14), 1.0, 0.96, nn.template(14, nn.TEMPLATE))
    assert probes == nn.TEMPLATE and reached < 0.96
    hashing, sets = nn._settled(sample, 32, 14, 4, 1.0, 0.96)
    assert 3 <= hashing.hashes < 14 and sets
    assert nn._needed(sample, hashing, 1.0, 0.96, sets)[1] >= 0.96


def test_few_rows_give_all_candidates(spark):
    d = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.5]), (20, [3.0, 3.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in nn.search(d, F.col("id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 3.0), (0, 2, 1, 0.0), (0, 3, 2, -1.0), (20, 1, 0, 3.0), (20, 2, 1, 3.0), (20, 3, 2, -1.5)]


def test_ties_of_a_slice_go_to_the_smaller_ids():
    vectors = np.array([[k in c for k in range(10)] for c in itertools.combinations(range(10), 4)], float)  # 210 with one product
    ids = np.random.default_rng(2).permutation(len(vectors))
    best = nn.Best(np.ones((1, 10)), 21)
    best.offer(np.arange(1), ids, vectors, None)
    best.offer(np.arange(1), ids + 1000, vectors, None)
    assert best.points[0].tolist() == list(range(21))


def test_template_is_in_order_of_expected_score():
    sets = nn.template(4, 200)
    assert len(sets) == 81 and sets[0] == () and sets[1] == (1,) and len(set(sets)) == 81
    visited = nn.probes(np.array([[0.1, 0.5, 0.8, 0.45]]), sets)
    assert len(np.unique(visited)) == 81 and visited[0, 0] == nn.codes(np.zeros((1, 4), np.int64))[0]


def test_no_usable_rows(spark):
    for data in ([], [(1, None), (2, [0.0])]):
        d = spark.createDataFrame(data, "vec_id long, embedding array<float>")
        assert nn.search(d, F.col("id") % 20 == 0).collect() == []
