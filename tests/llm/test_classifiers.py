import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deadhead.llm import labelled, quality, toxicity
from deadhead.llm.common import crc_mod


def _texts(n, seed, bad):
    r = random.Random(seed)
    words = [a + b for a in ("ka", "lo", "mi", "ru", "se", "to") for b in ("na", "di", "pe", "ru", "", "x")]
    rows = []
    for i in range(n):
        sentences = [" ".join(r.choice(words) for _ in range(r.randint(3, 9))) for _ in range(r.randint(1, 9))]
        label = int(r.random() < 0.4)
        rows.append((i, bad(r, sentences) if label else ". ".join(sentences), label))
    return rows


def _toxic(r, sentences):
    sentences[r.randrange(len(sentences))] += " " + r.choice(["Vileword", "vilest", "grobian"])
    return ". ".join(sentences)


def _junk(r, sentences):
    return " | ".join(w + "!!" for w in ". ".join(sentences).split()) if r.random() < 0.5 else " ".join(w + " " + w for w in sentences[0].split())


def _auc(rows):
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    return float(np.mean([(s[y == 1][:, None] > s[y == 0]) + 0.5 * (s[y == 1][:, None] == s[y == 0])]))


def _frames(spark, rows, label):
    extra = [(9001, None), (9002, ""), (None, "no id"), (9003, "long " * 20_000), (rows[0][0], rows[0][1])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in [*((i, t) for i, t, _ in rows), *extra]], "doc_id long, text string, score string, label int")
    labels = spark.createDataFrame([(i, y, "z") for i, _, y in rows] + [(None, 1, "z"), (5, None, "z")], f"doc_id long, {label} int, text string")
    return docs, labels


def test_quality_on_held_out_rows(spark):
    rows = _texts(700, 1, _junk)
    docs, labels = _frames(spark, rows, "quality")
    model = quality.fit(docs, labels, crc_mod("id", 5) != 0, settings=quality.Settings(slots=4096, size=24))
    got = quality.score(docs, model, out="p")
    assert got.columns == [*docs.columns, "p"] and got.count() == docs.count()
    assert got.filter("p < 0 or p > 1 or p is null").count() == 0
    held = got.join(labels.select("doc_id", "quality"), "doc_id").filter(crc_mod("doc_id", 5) == 0).select("p", "quality").na.drop().collect()
    assert _auc([tuple(r) for r in held]) > 0.95
    empty = {r.p for r in got.filter("doc_id in (9001, 9002)").collect()}
    assert len(empty) == 1


def test_word_vectors_equal_a_plain_sum(spark):
    s = quality.Settings(slots=64, size=8)
    texts = ["a b c a", "B! a", "", "c c c d"]
    places, signs = quality.index_vectors(s)
    table = np.zeros((64, 8))
    for t in texts:
        rows, _ = quality.token_rows([t.encode()], quality.Slots(64))
        for i, w in enumerate(rows):
            for j in range(max(0, i - 2), min(len(rows), i + 3)):
                if j != i:
                    np.add.at(table[w], places[rows[j]], signs[rows[j]])
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    docs = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(3)
    assert np.allclose(quality.word_vectors(docs, "text", s), table, atol=1e-6)


def test_toxicity_on_held_out_rows_and_sentences(spark):
    rows = _texts(900, 2, _toxic)
    docs, labels = _frames(spark, rows, "toxic")
    model = toxicity.fit(docs, labels, crc_mod("id", 4) != 2)
    got = toxicity.score(docs, model)
    assert got.columns == [*docs.columns, "toxicity"]
    held = got.join(labels.select("doc_id", "toxic"), "doc_id").filter(crc_mod("doc_id", 4) == 2).select("toxicity.score", "toxic", "toxicity.sentences").na.drop().collect()
    assert _auc([tuple(r)[:2] for r in held]) > 0.97
    found = [s.text.lower() for r in held for s in r.sentences]
    assert found and np.mean([any(w in t for w in ("vil", "grobian")) for t in found]) > 0.9
    assert {r.toxicity.score for r in got.filter("doc_id in (9001, 9002)").collect()} == {0.0}
    assert got.filter("toxicity.score < 0 or toxicity.score > 1").count() == 0


def test_noisy_or_equals_the_product():
    logits, firsts = np.array([0.3, -2.0, 1.0, 5.0]), np.array([0, 2, 2, 4])
    filled = np.array([True, True, False, True])
    p = 1 / (1 + np.exp(-logits)) * filled
    want = [1 - (1 - p[0]) * (1 - p[1]), 0, 1 - (1 - p[2]) * (1 - p[3])]
    assert np.allclose(-np.expm1(toxicity.noisy_or(logits, firsts, filled)), want)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_no_rows_and_no_labels(spark, module):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = module.fit(docs, labels, F.lit(True))
    assert module.score(docs, model).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert module.score(some, module.fit(some, labels, F.lit(True))).count() == 2


def test_sample_is_bounded_and_chosen_by_id(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    own, known = labelled.sample(docs, labels, "doc_id", "text", "toxic", crc_mod("id", 4) != 2, rows=500)
    assert own.join(known, "id").count() == own.count() == known.count() and 350 < own.count() < 650
    assert own.filter(crc_mod("id", 4) == 2).count() == 0
