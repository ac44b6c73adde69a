import base64
import random

import numpy as np
import public_tokenizers as P
import tiktoken

from deadhead.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cases():
    r = random.Random(3)
    parts = ["the ", "don't", " we'll ", "ñandú", "\n\n", "   ", "😀", "12345", "...", "é́", "<|endoftext|>", "\t", "'", "𝒳", " "]
    docs = ["".join(r.choice(parts) for _ in range(r.randint(0, 400))) for _ in range(60)]
    docs += ["", None, "x" * 5000, " " * 3000, "ab " * 2000, "a'" * 999 + "re", "  x" * 700, docs[0], docs[0]]
    return list(enumerate(docs)) + [(None, "no id")]


def test_chunks_equal_the_library(spark):
    docs = cases()
    want = library()
    d = spark.createDataFrame([(i, t, "own", 5) for i, t in docs], "doc_id long, text string, _row string, piece int")
    tokens = bpe.tokenize(d, PATH, P.PATTERN, chunk=97, overlap=24)
    assert tokens.columns == ["doc_id", "text", "_row", "piece", "ids"]
    rows = bpe.detokenize(tokens, PATH, P.PATTERN).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == want.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "") and r._row == "own"


def test_stitching_pieces_cover_the_text():
    own = bpe.encoder(PATH, P.PATTERN)
    r = random.Random(5)
    text = "".join(r.choice(["ab", " ", "  ", "'ll", "9", "!?"]) for _ in range(900))
    chunk, overlap = 60, 20
    n = -(-len(text) // chunk)
    edges = []
    for k in range(n):
        head, tail = bpe.chunk_edges(own.pattern, text[k * chunk : (k + 1) * chunk + overlap], overlap, k == 0, k == n - 1)
        edges.append({"chunk": k, "head": head.tolist(), "tail": tail.tolist()})
    pieces = bpe.stitch(edges, chunk, len(text))
    assert len(pieces) > 5 and sum(n for _, n in pieces) == len(text)
    assert b"".join(own.encode(text[a : a + n]) for a, n in pieces) == own.encode(text)


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    tokens = bpe.detokenize(bpe.tokenize(d, PATH, P.PATTERN), PATH, P.PATTERN)
    assert bpe.digest(tokens).collect() == []
