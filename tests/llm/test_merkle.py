import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from deadhead.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def siblings(found, at):
    path = []
    for level in found[:-1]:
        begin = at // 8 * 8
        path.append((level[begin:at], level[at + 1 : begin + 8]))
        at //= 8
    return path


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text)."""
    langs = defaultdict(list)
    for r in rows:
        changed = r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if changed else r[4]
        langs[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r[0], leaf((*r[:4], text))))
    trees = {lang: levels([x[2] for x in sorted(own)]) for lang, own in langs.items()}
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    top = levels([trees[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for at, (_, _, own, doc, tampered) in enumerate(sorted(langs[lang])):
            path = siblings(trees[lang], at) + siblings(top, k)
            digest = tampered
            for left, right in path:
                digest = h(*left, digest, *right)
            out.append((doc, own, trees[lang][-1][0], top[-1][0], h(*[x for step in path for side in step for x in side]), digest, digest == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows, extra=""):
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, digest int")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op12_merkle(spark, str(tmp_path))


def cases():
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(70)] + [(i, None, "de", None, None) for i in range(70, 79)] + [(i, "", "fr", 5, "é𝒳 A") for i in range(100, 108)]
    rows += [(200, "x", None, 1, ""), (None, "x", None, 1, "B"), (300, "s", "zz", 2, "ONE"), (-7, "s", "", 2, "lower"), (5, "s5", "en", 5, "other"), rows[3], rows[3]]
    return rows + [(i, "s", f"l{i}", 1, "T" * 100_000) for i in range(400, 412)]


def test_equals_brute_force(spark, tmp_path):
    got = run(spark, tmp_path, cases())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(cases())


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 1, "A")], [(1, "s", None, 1, None), (2, "s", None, 1, "x")], [(None,) * 5] * 3])
def test_small_tables(spark, tmp_path, rows):
    assert sorted(map(tuple, run(spark, tmp_path, rows).collect()), key=repr) == brute(rows)


def test_statement_on_odd_rows(spark, tmp_path):
    import duckdb

    from deadhead.llm import oracle

    run(spark, tmp_path, cases())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.sql(oracle.SQL["op12_merkle"]).fetchall(), key=repr) == brute(cases())


def test_any_changed_field_is_found(spark):
    d = spark.createDataFrame([(i, "g", i * 10) for i in range(20)], "key long, part string, value long")
    forged = merkle.leaf_hash([F.col("key"), F.when(F.col("key") == 7, F.col("value") + 1).otherwise(F.col("value"))])
    made = merkle.manifest(d, ["key", "value"], "key", "part", {"forged": forged})
    rows = made.proofs().withColumn("good", merkle.folded(F.col("forged"), F.col("path")) == F.col("root")).collect()
    assert {r.key: r.good for r in rows} == {i: i != 7 for i in range(20)}
    assert made.root == rows[0].root and [x.count() for x in made.levels] == [3, 1]


def test_leaves_are_not_shuffled_on_the_way_down(spark):
    d = spark.createDataFrame([(i, "g", i) for i in range(100)], "key long, part string, value long")
    plan = merkle.manifest(d, ["key", "value"], "key", "part").proofs()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
