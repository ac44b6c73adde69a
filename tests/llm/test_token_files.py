import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from deadhead.llm import token_files as tf

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 15, 16, 17, 20, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1003, dtype=np.uint64)
    data = tf.pack(ids, bits)
    assert len(data) == -(-1003 // 8) * bits
    assert (tf.unpack(data, bits)[:1003] == ids).all()


def expected(docs):
    library = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_equal_the_library(spark):
    r = random.Random(1)
    parts = ["The", "word,", "Word!!", "é,", "it's.", "a'", "'s", "x%%%", "9.", "́.", "é;", "…,", "<|endoftext|>.", "\x01", "a\x01b", "don't", "É́", "x y", "\x1c", "a b", "<|endoftext|>", "ΟΔΟΣ", "İ", "12", "!?", "\x01", "a\x01b", "😀", "́", "ﬁ", "\u0085"]
    docs = [(i * 3, "".join(r.choice(parts) + r.choice(["", " ", "\n", "\t", "  "]) for _ in range(r.randint(0, 80)))) for i in range(50)]
    docs += [(1, None), (2, ""), (4, "long " * 30_000), (None, "no id"), (-5, "before")]
    r.shuffle(docs)
    d = spark.createDataFrame([(i, t, 1, "p") for i, t in docs], "doc_id long, text string, start int, path string")
    manifest = tf.write(d, tf.Vocabulary(PATH, 1))
    rows = tf.digest(tf.read(spark, manifest)).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected(docs)
    files = [tf.TokenFile(m.path) for m in manifest.orderBy("shard").collect()]
    whole = [f.document(i) for f in files for i in range(f.n_docs)]
    assert [zlib.crc32(x.astype("<u4").tobytes()) for x in whole] == [e[3] for e in expected(docs)]


def test_repeated_rows_and_empty_table(spark):
    d = spark.createDataFrame([(1, "same text")] * 20 + [(2, "b")], "doc_id long, text string")
    rows = tf.digest(tf.read(spark, tf.write(d, tf.Vocabulary(PATH, 1)))).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected([(1, "same text")] * 20 + [(2, "b")])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tf.read(spark, tf.write(none, tf.Vocabulary(PATH, 1))).collect() == []


EQUAL_HASHES = [lambda buffer, starts, sizes: np.zeros(len(starts), np.uint64), lambda buffer, starts, sizes: sizes.astype(np.uint64)]


@pytest.mark.parametrize("hashes", [tf.span_hashes, *EQUAL_HASHES])
@pytest.mark.parametrize("apart", [True, False])
def test_ids_of_runs_equal_the_library(monkeypatch, hashes, apart):
    monkeypatch.setattr(tf, "span_hashes", hashes)
    r = random.Random(7)
    parts = ["a", "B", "Heaon", "H\u0331", "J\u030c", "I\u0307", "\u0331", "\u0307", "Σ", "ΑΣ", "é", ".", ",", "..", ",.", "'S", "'s", "'", "don't", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "endoftext", "1", "$", "\x01", "\x00", "\x1c", "\u0085", "\u00a0", "ﬁ", "K", "x" * 15]
    raw = ["".join(r.choice(parts) + r.choice(["", "", " ", "\n", "\t\r"]) for _ in range(r.randint(0, 30))) for _ in range(400)]
    raw += [None, "", " ", "abc", "DEF", "ghi.", ".", "Jkl,", None, "x" * 16, "X" * 17, "x" * 24]  # runs that touch those of the next text
    library, own = Tokenizer.from_file(PATH), tf.WordIds(PATH)
    assert own.divides
    own.divides = apart
    for _ in range(2):  # learned, remembered
        ids, counts = own.batch(pa.array(raw))
        texts = np.split(ids, np.cumsum(counts)[:-1])
        assert [x.tolist() for x in texts] == [library.encode(t or "", add_special_tokens=False).ids for t in raw]
    ids, counts = own.batch(pa.array([], pa.string()))
    assert len(ids) == len(counts) == 0


def test_full_stops_commas_and_capitals_make_no_new_runs():
    own = tf.WordIds(PATH)
    own.batch(pa.array(["heaon . ,"]))
    own._learn = lambda new: pytest.fail(f"{new} learned") if new else None
    own.batch(pa.array(["Heaon, heaon.", "HEAON"]))


def test_memory_that_is_full(monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 30)
    library, own = Tokenizer.from_file(PATH), tf.WordIds(PATH)
    for k in range(9):
        raw = [f"w{'abcdefghi'[j % 9]}{'klmnopqrs'[(j + k) % 9]} word{j}" for j in range(k, k + 12)]
        ids, _ = own.batch(pa.array(raw))
        assert ids.tolist() == [i for t in raw for i in library.encode(t, add_special_tokens=False).ids]
    assert own.before


def test_only_known_files_are_divided(tmp_path):
    with open(PATH) as file:
        made = json.load(file)
    for name, change in (("cased", {"normalizer": None}), ("token", {"added_tokens": [{**made["added_tokens"][0], "content": "end."}]})):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps({**made, **change}))
        assert not tf.divides(str(path))
    assert tf.divides(PATH)
