import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deadhead.llm import jaccard
from deadhead.llm.components import components


def shingle_set(text, size=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(docs, size=3, percent=90):
    sets = [shingle_set(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * 100 >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [docs[i][0] for i in members if docs[i][0] is not None]
        out += [(docs[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=repr)


def cases(seed, copies=6):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "ß"]
    text = lambda n: [r.choice(words) for _ in range(n)]
    docs = []
    for _ in range(14):
        base = text(r.choice([2, 8, 11, 12, 13, 20, 40, 90, 200, 420]))
        for _ in range(copies):
            own = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 45))):
                kind, at = r.random(), r.randrange(len(own))
                if kind < 0.4:
                    own[at] = r.choice(words)
                elif kind < 0.7:
                    own.insert(at, r.choice(words))
                elif len(own) > 1:
                    del own[at]
            docs.append(" ".join(own).upper() if r.random() < 0.2 else "\n".join(own))
    docs += ["", None, " \t", "one", "ONE", "one two", "a " * 3000, "a " * 3001, " ".join(text(5000))]
    docs = list(enumerate(docs)) + [(None, docs[0]), (None, "only null ids here"), (3, docs[3])]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize(("seed", "chunk"), [(1, jaccard.CHUNK), (2, 400)])
def test_equals_brute_force(spark, monkeypatch, seed, chunk):
    docs = cases(seed)
    d = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n int, mark string")
    monkeypatch.setattr(jaccard, "HELD", 300 if seed == 2 else jaccard.HELD)
    got = jaccard.components(d, chunk=chunk)
    assert sorted(map(tuple, jaccard.digest(got).collect()), key=repr) == brute(docs)


@pytest.mark.parametrize(("seed", "chunk"), [(1, jaccard.CHUNK), (2, 400)])
def test_join_gives_every_link_once(spark, seed, chunk):
    base = [f"v{i}" for i in range(200)]
    docs = cases(seed) + [(500 + k, " ".join([*base[: 40 * k], "other", *base[40 * k + 1 :]])) for k in range(5)]
    sets = [shingle_set(t) for _, t in docs]
    linked = [[j for j, b in enumerate(sets) if i != j and a and len(a & b) * 100 >= 90 * len(a | b)] for i, a in enumerate(sets)]
    # the row's number is the id here, so that pairs of rows can be told apart
    d = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id long, text string")
    got = jaccard.join(d, chunk=chunk)
    members = {r.doc_id: (r.n_shingles, r.class_id) for r in got.members.collect()}
    assert {i: n for i, (n, _) in members.items()} == {i: len(s) for i, s in enumerate(sets)}
    of = {}
    for i, (n, c) in members.items():
        assert (c is None) == (n == 0)
        of.setdefault(c, []).append(i)
    pairs = [tuple(r) for r in got.pairs.collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    found = {(i, j) for c, m in of.items() if c is not None for i in m for j in m if i != j}
    found |= {p for a, b in pairs for i in of[a] for j in of[b] for p in ((i, j), (j, i))}
    assert found == {(i, j) for i, near in enumerate(linked) for j in near}
    near = [members[len(docs) - 5 + k][1] for k in range(5)]
    assert len({p for p in pairs if set(p) <= set(near)}) == 10  # all of five near copies, a forest has 4
    assert {r.doc_id: r.n_links for r in got.degrees().collect()} == {i: len(near) for i, near in enumerate(linked)}
    ids = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.digest(jaccard.components(ids, chunk=chunk, every=True)).collect()), key=repr) == brute(docs)


def test_representatives(spark):
    docs = cases(4, copies=3)
    d = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n int, _mark string")
    got = jaccard.representatives(d)
    assert got.columns == d.columns
    rows = got.collect()
    want = brute(docs)
    parts = {c for _, n, c in want if n}
    assert sorted((r.doc_id for r in rows if (r.text or "").strip()), key=repr) == sorted(parts, key=repr)
    assert sum(not (r.text or "").strip() for r in rows) == sum(n == 0 for _, n, _ in want)


@pytest.mark.parametrize("percent", [95, 90, 80, 70, 60])
def test_linked_sets_share_a_key(percent):
    r, share, linked = np.random.default_rng(5), percent / 100, 0
    for _ in range(2000):
        n = int(r.choice([9, 10, 11, 14, 15, 16, 19, 20, 29, 33, 50, 75, 76, 113, 171, 256, 700]))
        base = r.integers(0, 2**63, n).astype(np.uint64)
        union = int(n / share) if r.random() < 0.5 else n
        drop = int(r.integers(0, max(1, int(union * (1 - share))) + 1))
        a = np.unique(base[min(drop, n - 1) // 2 :])
        b = np.unique(np.concatenate([base[: n - (min(drop, n - 1) - min(drop, n - 1) // 2)], r.integers(0, 2**63, max(0, union - n)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if both * 100 >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
            linked += 1
            one, two = ({band: (need, set(k.tolist())) for band, need, k in jaccard.keys(x, percent)} for x in (a, b))
            # in the larger one's band, they share a key, and all but so many of each one's keys as it needs
            band = jaccard.band_of(max(len(a), len(b)), percent)
            same = len(one[band][1] & two[band][1])
            assert same >= max(1, one[band][0]) and same >= two[band][0]
    assert linked > 200


@pytest.mark.parametrize("percent", [90, 80, 70])
def test_unrelated_sets_share_no_key(percent):
    r = np.random.default_rng(6)
    for n in (50, 70, 100, 150, 200, 300, 400, 600, 1000, 2000, 5000):
        sets = [np.unique(r.integers(0, 2**63, n + int(r.integers(0, n // 10 + 1))).astype(np.uint64)) for _ in range(30)]
        found = [{int(k) for _, _, own in jaccard.keys(s, percent) for k in own} for s in sets]
        pairs = [bool(found[i] & found[j]) for i in range(30) for j in range(i)]
        assert sum(pairs) < 0.01 * len(pairs)


def test_a_common_passage_chains_no_texts(spark):
    r = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, " ".join(f"d{i}x{r.randrange(10**6)}" for _ in range(300)) + " " + passage) for i in range(40)]
    docs += [(100 + i, " ".join([*[f"c{k}" for k in range(300)], f"e{i}"]) + " " + passage) for i in range(5)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    source = d.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    edges = jaccard._stars(source, 5, 80, 8).collect()
    assert 4 <= len({x for e in edges for x in e}) <= 5
    assert sorted(map(tuple, jaccard.digest(jaccard.components(d, size=5, percent=80)).collect()), key=repr) == brute(docs, 5, 80)


def test_chunk_pairs_are_dealt_out(spark):
    members = spark.range(100).selectExpr("id % 2 AS family", "id AS cid", "id + 100 AS n", "cast('' AS binary) AS point", "2 AS chunks", "cast('' AS binary) AS set")
    for df in (jaccard._possible(members.drop("chunks"), 80), jaccard._family_links(members, 80, False)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert any(" i#" in line and " j#" in line for line in exchanges), plan


def test_tree_prunes_only_what_cannot_link():
    r = random.Random(8)
    base = [f"w{i}" for i in range(160)]
    raw = [" ".join(w for w in base if r.random() > r.choice([0.01, 0.03, 0.3])).encode() for _ in range(120)]
    sets = sorted(jaccard.shingles(raw, 3), key=len)
    tree = jaccard.Tree(jaccard.counts(sets), np.array([len(s) for s in sets]))
    pruned = 0
    for q in range(len(sets)):
        left = set(tree.partners(tree.levels[0][q], int(tree.sizes[q]), q + 1, 90).tolist())
        for p in range(q + 1, len(sets)):
            both = len(np.intersect1d(sets[q], sets[p]))
            if both * 100 >= 90 * (len(sets[q]) + len(sets[p]) - both):
                assert p in left
            pruned += p not in left
    assert pruned > 3000


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(20)] + [(60, 50), (50, 60), (70, 70)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 121)}, 50: 50, 60: 50}


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.digest(jaccard.components(d)).collect() == []
    assert jaccard.representatives(d).collect() == []
