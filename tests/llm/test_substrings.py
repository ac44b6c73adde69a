import random
import tracemalloc
from collections import Counter, deque

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from deadhead.llm import substrings


def brute(docs, width):
    words = [(text or "").encode().split() for _, text in docs]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(docs, words, strict=True):
        gone = {k for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for k in range(i, i + width)}
        out.append((doc, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def cases():
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["é", "ß x", "𝒳"]
    text = lambda n: "".join(r.choice(words) + r.choice([" ", "\n", "\t ", "\r\n"]) for _ in range(n))
    passage, line = text(14), text(9)
    docs = [(i, text(r.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, text(r.randint(0, 9)) + passage + text(r.randint(0, 9))) for i in range(30)]
    docs += [(200 + i, line) for i in range(40)] + [(300, "a " * 500), (301, "a " * 7), (302, "b b b"), (303, ""), (304, None), (None, passage)]
    docs += [docs[3], docs[3], (305, text(6000)), (306, text(7)), (307, " ".join(f"u{i}" for i in range(8)) * 2)]
    return docs


@pytest.mark.parametrize("options", [{}, {"block_bytes": 400, "bucket_bytes": 12000, "hot_times": 1.0}, {"block_bytes": 2000, "hot_times": 0.0}])
def test_equals_brute_force(spark, options):
    docs = cases()
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, block string, bytes int")
    got = substrings.deduplicate(d, width=8, seed=3, **options)
    rows = got.collect()
    assert got.columns == ["doc_id", "text", "block", "bytes", "cut"]
    assert sorted([(r.doc_id, r.cut.n_words, r.cut.n_removed, r.cut.kept) for r in rows], key=repr) == brute(docs, 8)
    for r in rows:
        assert sum(s["last"] - s["first"] + 1 for s in r.cut.spans) == r.cut.n_removed


def test_remove_keeps_untouched_texts(spark):
    d = spark.createDataFrame([(1, "a  b\tc d", 5), (2, "x a  b c d y", 6), (3, None, 7), (4, "q\n r", 8)], "doc_id long, text string, cut int")
    got = substrings.remove(d, width=4, seed=2)
    assert got.columns == d.columns
    assert sorted(map(tuple, got.collect())) == [(1, "", 5), (2, "x y", 6), (3, None, 7), (4, "q\n r", 8)]


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.digest(substrings.deduplicate(d)).collect() == []


def traced(run):
    """Bytes that ``run`` takes at most beside what was there."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def long_texts(number, words):
    r = random.Random(5)
    return [" ".join(f"w{r.randrange(10**5)}" for _ in range(words)).encode() for _ in range(number)]


def test_memory_of_a_block():
    raw = long_texts(300, 1000)
    size = sum(map(len, raw))
    assert traced(lambda: substrings.Block(raw, 35, 6)) < 7 * size


def test_memory_of_a_bucket():
    strings = long_texts(6000, 50)
    size = sum(map(len, strings))
    rows = [{"bucket": 1, "block": k, "strings": zstandard.compress(b"\n".join(strings[k::4])), "counts": np.ones(len(strings[k::4]), "<u4").tobytes()} for k in range(4)]
    batch = pa.RecordBatch.from_pylist(rows)
    assert traced(lambda: deque(substrings._count(35)(iter([batch])), maxlen=0)) < 7 * size


def test_a_block_is_dropped_before_the_next():
    texts = [t.decode() for t in long_texts(100, 1000)]
    block = substrings._block([pa.RecordBatch.from_pydict({"text": texts})], 0)

    def run(number):
        batch = pa.RecordBatch.from_pydict({"payload": block.column("payload").take([0] * number), "found": pa.array([None] * number, pa.list_(pa.int8()))})
        return traced(lambda: deque(substrings._cut("text", 35, 6, 4, np.zeros(4, bool), "cut")(iter([batch])), maxlen=0))

    assert run(4) < 1.15 * run(1)


def test_slices_of_a_block(monkeypatch):
    raw = [(t or "").encode() for _, t in cases()]
    whole = substrings.Block(raw, 8, 3)
    for windows in (1, 7, 1000):
        monkeypatch.setattr(substrings, "WINDOWS", windows)
        sliced = substrings.Block(raw, 8, 3)
        for name in ("starts", "sizes", "minimisers"):
            assert np.array_equal(getattr(whole, name), getattr(sliced, name))


@pytest.mark.parametrize("hashes", [2**64 - 1, 3, 0])
def test_repeated_windows_in_slices(monkeypatch, hashes):
    """Also with texts that share a hash."""
    r = random.Random(3)
    strings = [[r.choice([b"a", b"b", b"cc"]) for _ in range(r.randint(4, 9))] for _ in range(60)]
    counts = np.array([r.choice([1, 1, 1, 2]) for _ in strings])
    seen = Counter()
    for words, n in zip(strings, counts.tolist(), strict=True):
        for i in range(len(words) - 3):
            seen[tuple(words[i : i + 4])] += n
    expected = [seen[tuple(words[i : i + 4])] > 1 for words in strings for i in range(len(words) - 3)]
    real = substrings.window_hashes
    monkeypatch.setattr(substrings, "window_hashes", lambda values, width: real(values, width) & np.uint64(hashes))
    for size, compared in ((1 << 19, 20_000), (30, 7), (1, 1)):
        monkeypatch.setattr(substrings, "LINES_BYTES", size)
        monkeypatch.setattr(substrings, "COMPARED", compared)
        windows, repeat = substrings.repeated_windows(b"\n".join(b" ".join(x) for x in strings), counts, 4)
        assert windows.tolist() == [len(x) - 3 for x in strings]
        assert repeat.tolist() == expected
