import random

import pytest

from deadhead.llm import decontaminate


def brute(docs, items, n):
    out = []
    grams = {}
    for item, text in items:
        w = [x.decode() for x in decontaminate.words_of((text or "").encode())] if item is not None else []
        for i in range(max(1, len(w) - n + 1) if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    for doc, text in docs:
        w = [x.decode() for x in decontaminate.words_of((text or "").encode())]
        hit, found = set(), set()
        for g, owners in grams.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found |= owners
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def cases():
    r = random.Random(7)
    words = ["Ab", "é1", "z", "9x", "ß", "𝒳q"]
    make = lambda n: "".join(r.choice(words) + r.choice([" ", "-", ".\n", "'"]) for _ in range(n))
    items = [(1, make(7)), (2, make(3)), (2, make(2)), (3, ""), (4, None), (None, make(2)), (5, make(4)), (50, make(1))]
    docs = [(i, make(r.randint(0, 40))) for i in range(40)] + [(7, "x"), (None, make(20)), (41, None), (42, ""), (43, "Ab " * 5000)]
    docs += [docs[0], (44, "pre " + items[0][1] + " post"), (45, items[0][1] * 3)]
    return docs, items


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_scan_equals_brute_force(spark, limit):
    docs, items = cases()
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, scan int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.scan(d, b, n=4, broadcast_bytes=limit)
    rows = sorted(((r.doc_id, r.scan.n_words, r.scan.n_hit, list(r.scan["items"])) for r in got.collect()), key=repr)
    assert rows == brute(docs, items, 4)
    for r in got.collect():
        assert sum(s["last"] - s["first"] + 1 for s in r.scan.spans) == r.scan.n_hit
    assert {r.n_hit > 0 for r in decontaminate.digest(got).collect()} == {True, False}


def test_removal_keeps_columns_and_clean_texts(spark):
    docs = spark.createDataFrame(
        [(1, "Keep this. The secret answer here! And this.", "s"), (2, "nothing to see", "s"), (3, None, None)], "doc_id long, text string, scan string"
    )
    items = spark.createDataFrame([(9, "the SECRET answer here")], "item_id long, text string")
    spans = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items, n=4).collect()}
    assert spans == {1: "Keep this. ! And this.", 2: "nothing to see", 3: None}
    kept = decontaminate.remove_documents(docs, items, n=4)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert decontaminate.scan(docs, items).count() == 0
    for limit in (8 << 20, -1):
        assert [r.scan.n_hit for r in decontaminate.scan(some, items, broadcast_bytes=limit).collect()] == [0]
