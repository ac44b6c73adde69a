"""The corpus pipeline on the smallest tables, each stage against a brute-force version of its own input."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from deadhead.llm import decontaminate, quality, queries
from deadhead.llm.common import materialize, table
from tests.llm.test_bpe import library
from tests.llm.test_jaccard import shingle_set
from tests.llm.test_substrings import brute as brute_windows

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name.split()[0]))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert [s.columns for s in steps[:-1]] == [COLUMNS] * (len(steps) - 1)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "byte-level BPE",
    ]


def test_quality_rejects_by_score_and_keeps_good_documents(spark, steps):
    docs, kept = steps[0], texts(steps[1])
    scored = quality.score(docs, queries._quality_model(spark, docs, SF)).collect()
    assert {r.doc_id: r.text for r in scored if r.score >= 0.3} == kept
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_one_document_of_each_group_stays(steps):
    before, after = texts(steps[1]), texts(steps[2])
    sets = {i: shingle_set(t, 5) for i, t in before.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and both * 100 >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert after == {i: t for i, t in before.items() if not sets[i] or root(i) == i}


def test_repeated_passages_go(steps):
    before, after = texts(steps[2]), texts(steps[3])
    want = {i: (kept if gone else before[i]) for i, _, gone, kept in brute_windows(list(before.items()), 35)}
    assert after == want


def test_benchmark_passages_go(spark, steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    items = [decontaminate.words_of((r.text or "").encode()) for r in table(spark, SF, "benchmark").collect()]
    grams = {tuple(w[i : i + min(10, len(w))]) for w in items for i in range(max(1, len(w) - 9)) if w}
    for i, t in before.items():
        w = decontaminate.words_of((t or "").encode())
        hit = {k for g in {len(g) for g in grams} for a in range(len(w) - g + 1) if tuple(w[a : a + g]) in grams for k in range(a, a + g)}
        assert decontaminate.words_of((after[i] or "").encode()) == [x for k, x in enumerate(w) if k not in hit]


def test_ids_are_the_librarys(steps):
    before, rows = texts(steps[4]), {r.doc_id: r for r in steps[5].collect()}
    assert before.keys() == rows.keys()
    want = library()
    for i, t in before.items():
        ids = np.array(want.encode_ordinary(t or ""), "<u4")
        assert rows[i].n_tokens == len(ids) and rows[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1].collect()))


def odd_rows():
    long = " ".join(f"word{i % 977} filler{i % 13}" for i in range(60_000))
    sentences = " ".join(f"The quick brown fox number {i} jumps over the lazy dog." for i in range(40))
    rows = [(i, f"{sentences} Only here {i * 7919}.", "en", "web", 10) for i in range(60)]
    rows += [rows[3], rows[3], (None, "no id at all", "en", None, 1), (None, None, None, None, None), (70, None, "de", "web", 0), (71, "", None, "", None)]
    return rows + [(72, long, "en", "web", len(long)), (73, sentences, "en", "web", 5), (74, sentences, "fr", "web", 5)]


@pytest.mark.parametrize("rows", [[], odd_rows()])
def test_odd_tables_and_clashing_columns(spark, tmp_path, rows):
    extra = "score double, _mark long, cut string, scan int, _row long, payload binary, ids array<int>, tokens string"
    d = spark.createDataFrame([(*r, 0.5, 1, "c", 2, 3, b"p", [1], "t") for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = table(spark, str(tmp_path), "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = materialize(stage(spark, docs, str(tmp_path)), f"odd{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == d.columns, name
        docs, before = made, docs
    got = sorted(((r.doc_id, r.n_tokens) for r in docs.collect()), key=repr)
    want = library()
    assert got == sorted(((r.doc_id, len(want.encode_ordinary(r.text or ""))) for r in before.collect()), key=repr)
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == docs.columns


def test_defined_results_of_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(*r, "x") for r in odd_rows()], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    once = queries.one_of_each_group(spark, docs, SF).collect()
    # near copies leave their smallest id, documents without a word all stay, a repeated row stays once
    assert sorted((r.doc_id for r in once), key=repr) == sorted([0, 70, 71, 72, None, None], key=repr)
    assert {r.extra for r in once} == {"x"}
