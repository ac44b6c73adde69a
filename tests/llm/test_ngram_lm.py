import math
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deadhead.llm import ngram_lm as lm


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["</s>"]


class Brute:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            seq = tokens(t)
            self.words.update(seq)
            self.pairs.update(zip(["<s>", *seq], seq))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.ahead, self.behind = Counter(), defaultdict(list)
        for (a, b), c in self.pairs.items():
            self.ahead[b] += 1
            self.behind[a].append(c)
        self.d2 = self.discounts(self.pairs.values())
        self.d1 = self.discounts(self.ahead.values())

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
        found = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.0 for k in (1, 2, 3)]
        return [0.0] + [d if d > 0 else 0.5 for d in found]

    def probability(self, a, b):
        types = len(self.pairs)
        rest = sum(self.d1[min(c, 3)] for c in self.ahead.values()) / types if types else 1.0
        word = (self.ahead[b] - self.d1[min(self.ahead[b], 3)]) / max(types, 1) + rest / (self.v + 1)
        if not self.behind.get(a):
            return word
        total = sum(self.behind[a])
        c = self.pairs[a, b]
        return (c - self.d2[min(c, 3)]) / total + sum(self.d2[min(x, 3)] for x in self.behind[a]) / total * word

    def row(self, text):
        seq = tokens(text)
        base = sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in seq)
        score = sum(math.log10(self.probability(a, b)) for a, b in zip(["<s>", *seq], seq))
        return len(seq), sum(self.words[w] > 0 for w in seq), base, score


def cases():
    r = random.Random(6)
    words = [f"w{i}" for i in range(40)] + ["É", "the", "The", "THE"] * 8
    docs = ["".join(r.choice(words) + r.choice([" ", "\n", "\t"]) for _ in range(r.randint(0, 60))) for _ in range(80)]
    return list(enumerate(docs)) + [(200, None), (201, ""), (202, "the the " * 900), (203, "never seen before"), (None, "w1 w2"), (204, docs[1]), (204, docs[1])]


@pytest.mark.parametrize("held", [lm.HELD, 50])
def test_equals_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(lm, "HELD", held)
    docs = cases()
    d = spark.createDataFrame([(i, t, "own", 3) for i, t in docs], "doc_id long, text string, bucket string, n int").repartition(5)
    training = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(True)) & F.coalesce(F.col("doc_id") != 203, F.lit(True))
    model = lm.fit(d, training=training)
    assert model.spread  # the word that fills shards is dealt out
    want = Brute([t for i, t in docs if i is None or (i % 3 != 1 and i != 203)])
    assert (model.tokens, model.types) == (want.n, want.v)
    rows = lm.score(d, model).collect()
    assert len(rows) == len(docs)
    for r in rows:
        a, b = tuple(r.lm), want.row(r.text)
        assert a[:2] == b[:2] and np.allclose(a[2:], b[2:], rtol=1e-9)


class BruteTriples(Brute):
    """Pairs count by the different words ahead of them, those after a begin by their tokens."""

    def __init__(self, texts):
        super().__init__(texts)
        self.triples, self.next = Counter(), defaultdict(list)
        for t in texts:
            seq = ["<s>", *tokens(t)]
            self.triples.update(zip(seq, seq[1:], seq[2:]))
        raw, self.pairs = self.pairs, Counter({p: c for p, c in self.pairs.items() if p[0] == "<s>"})
        for (a, b, c), n in self.triples.items():
            self.pairs[b, c] += 1
            self.next[a, b].append(n)
        assert self.pairs.keys() == raw.keys()
        self.behind = defaultdict(list)
        for (a, _), c in self.pairs.items():
            self.behind[a].append(c)
        self.d2, self.d3 = self.discounts(self.pairs.values()), self.discounts(self.triples.values())

    def by_two(self, a, b, c):
        near = self.next.get((a, b))
        if not near:
            return self.probability(b, c)
        n = self.triples[a, b, c]
        return (n - self.d3[min(n, 3)]) / sum(near) + sum(self.d3[min(x, 3)] for x in near) / sum(near) * self.probability(b, c)

    def row(self, text):
        seq = ["<s>", *tokens(text)]
        score = math.log10(self.probability(*seq[:2])) + sum(math.log10(self.by_two(*x)) for x in zip(seq, seq[1:], seq[2:]))
        return *super().row(text)[:3], score


@pytest.mark.parametrize("held", [lm.HELD, 50])
def test_order_three_equals_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(lm, "HELD", held)
    docs = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    training = F.coalesce(F.col("doc_id") % 3 != 2, F.lit(True)) & F.coalesce(F.col("doc_id") != 203, F.lit(True))
    model = lm.fit(d, training=training, order=3)
    assert model.heavy  # the pair that fills shards is dealt out
    want = BruteTriples([t for i, t in docs if i is None or (i % 3 != 2 and i != 203)])
    rows = lm.score(d, model).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert np.allclose(tuple(r.lm), want.row(r.text), rtol=1e-9)
    none = d.filter("false")
    assert lm.score(none, lm.fit(none, order=3)).collect() == []
    assert [r.lm.n_known for r in lm.score(d.limit(1), lm.fit(none, order=3)).collect()] == [0]


def test_order_three_sums_to_one():
    want = BruteTriples(["a b a c", "b a", "c c c a b"])
    for a, b in (("<s>", "a"), ("a", "b"), ("c", "c"), ("unseen", "a"), ("a", "unseen")):
        assert math.isclose(sum(want.by_two(a, b, c) for c in [*want.words, "unseen"]), 1.0)


def test_probabilities_sum_to_one():
    want = Brute(["a b a c", "b a", "c c c a b"])
    for a in ("<s>", "a", "b", "c", "unseen"):
        assert math.isclose(sum(want.probability(a, b) for b in [*want.words, "unseen"]), 1.0)


def test_tokens_of_texts():
    r = random.Random(3)
    parts = ["a", "B", "ab", "É", "eight888", "nine99999", "x" * 40, "\x1c", "\x00", "\u00a0", "\u0085", " ", " ", "\t", "\n\v", "\f\r "]
    raw = ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(300)] + [None, "", " ", "end", "start", "x" * 39, "x" * 41]
    names = {}
    for column in (pa.array(raw), pa.array(["cut", *raw, "off"], pa.large_string())[1:-1]):
        hashes, counts = lm.token_hashes(column)
        words = [w for t in raw for w in [*(t or "").encode().lower().split(), b"\n"]]
        assert counts.tolist() == [len((t or "").encode().split()) + 1 for t in raw]
        assert len(words) == len(hashes)
        for word, found in zip(words, hashes.tolist(), strict=True):
            assert names.setdefault(word, found) == found
    assert len(set(names.values())) == len(names)
    hashes, counts = lm.token_hashes(pa.array([], pa.string()))
    assert len(hashes) == len(counts) == 0


@pytest.mark.parametrize("scores", [False, True])
def test_words_take_no_calls_of_their_own(spark, monkeypatch, scores):
    few, many = ([" ".join(f"w{i}" for i in range(n)), None] for n in (20, 20_000))
    model = lm.fit(spark.createDataFrame([(few[0],), (many[0],)], "text string"), order=3)

    def calls(raw):
        words, count = lm.Vocabulary(model, scores), 0

        def seen(frame, event, _):
            nonlocal count
            count += event in ("call", "c_call")

        sys.setprofile(seen)
        try:
            rows = words.look_up(lm.token_hashes(pa.array(raw))[0])
        finally:
            sys.setprofile(None)
        return count, rows

    lm.mapped.cache_clear()
    calls(many)  # the files are open
    assert calls(many)[0] < calls(few)[0] + 1_000
    whole = calls(many)[1]
    monkeypatch.setattr(lm.Vocabulary, "BITS", 3)  # nearly every word replaces another
    words = lm.Vocabulary(model, scores)
    hashes = lm.token_hashes(pa.array(many))[0]
    for _ in range(2):
        parts = [words.look_up(hashes[i : i + 500]) for i in range(0, len(hashes), 500)]
        for a, b in zip(whole, zip(*parts, strict=True), strict=True):
            assert (a == np.concatenate(b)).all()


def test_packed_arrays_round_trip():
    r = np.random.default_rng(0)
    keys = np.unique(r.integers(0, 2**64, 999, dtype=np.uint64))
    counts = r.integers(1, 2**31, len(keys))
    a, b = lm.unsqueeze(lm.squeeze(keys, counts))
    assert (a == keys).all() and (b == counts).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(none, lm.fit(none)).collect() == []
    some = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r.lm for r in lm.score(some, lm.fit(none)).collect()}
    assert (rows[1].n_tokens, rows[1].n_known, rows[2].n_tokens) == (2, 0, 1)
