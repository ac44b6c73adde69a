"""Byte-level BPE by overlapping chunks, and decoding.

A text is cut into chunks of ``chunk`` characters that reach ``overlap`` characters into the next one. Chunks are
pre-tokenised in parallel. Matching is deterministic from a match start on, so where the starts that the left chunk found
in the overlap meet a start of the right chunk, both agree from there: that is the stitch. Pieces between two stitches are
encoded in parallel. A document whose chunks do not meet (one run of letters or spaces longer than the overlap) is encoded
as a single piece. Decoding concatenates the bytes of the ids.

Texts of one chunk need no stitch and never leave their task. Longer ones are numbered in a written table, so that a
retried task sees the same numbers.

Defined results: a NULL or empty text has no ids and decodes to nothing; repeated rows get equal rows each; an empty table
gives no rows; strings that look like special tokens are ordinary text; further columns are carried along unchanged.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm.common import KEPT, free_name, materialize, partitions, tidied

#: A match that ends this close to the end of a cut text may have been decided by what is missing (fixed by the pattern).
LOOK_AHEAD = 4
_SPACE = regex.compile(r"\s")
#: Pre-tokens whose ids a worker remembers.
REMEMBERED = 200_000


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder(dict):
    """Pre-token -> its ids as little-endian 32-bit integers, remembered for a bounded number of pre-tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        self.pattern = regex.compile(pattern)
        self.encoding = _encoding(path, pattern)
        self.bytes_of = np.array([self.encoding.decode_single_token_bytes(i) if self._known(i) else b"" for i in range(self.encoding.n_vocab)], object)

    def _known(self, token: int) -> bool:
        try:
            self.encoding.decode_single_token_bytes(token)
        except KeyError:
            return False
        return True

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoding._encode_single_piece(piece), "<u4").tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text that begins and ends with a whole pre-token."""
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.bytes_of[np.frombuffer(ids, "<u4")])


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _forget() -> None:
    encoder.cache_clear()
    _encoding.cache_clear()


KEPT["bpe"] = _forget


def starts(pattern: regex.Pattern, text: str) -> np.ndarray:
    return np.fromiter((m.start() for m in pattern.finditer(text)), np.int64)


def chunk_edges(pattern: regex.Pattern, text: str, overlap: int, first: bool, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Match starts of a chunk in its first ``overlap`` characters, and those in its last ones that the cut cannot move.

    Starts behind white space are left out: a run of white space is divided by what follows it, so a text must not end there.
    """
    found = starts(pattern, text)
    after_word = np.fromiter((s > 0 and not _SPACE.match(text[s - 1]) for s in found.tolist()), bool, len(found))
    head = found[:0] if first else found[after_word & (found < overlap)]
    if last:
        return head, found[:0]
    ends = np.append(found[1:], len(text))
    sure = np.minimum.accumulate((ends <= len(text) - LOOK_AHEAD)[: len(found)]) if len(found) else found.astype(bool)
    begin = len(text) - overlap
    # a start is sure when every match before it ended in time
    settled = np.concatenate(([True], sure[:-1])) if len(found) else sure
    return head, found[settled & after_word & (found >= begin)]


def stitch(edges: list[dict], chunk: int, size: int) -> list[tuple[int, int]]:
    """Pieces (start, length) of a text from its chunks' edges; one piece where two neighbours do not meet."""
    cuts = [0]
    edges = sorted(edges, key=lambda e: e["chunk"])
    for left, right in zip(edges, edges[1:], strict=False):
        base = right["chunk"] * chunk
        own = {base + s for s in right["head"]}
        # the left chunk's starts count from its own cut on, where it runs with the whole text
        meet = [s for s in (left["chunk"] * chunk + t for t in left["tail"]) if s in own and s >= cuts[-1]]
        if not meet:
            return [(0, size)]
        cuts.append(meet[0])
    return [(a, b - a) for a, b in zip(cuts, [*cuts[1:], size], strict=True)]


def tokenize(
    docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", chunk: int = 32_768, overlap: int = 1_024
) -> DataFrame:
    """``docs`` with ``out``: the ids of each text as little-endian unsigned 32-bit integers."""
    kept = [c for c in docs.columns if c != out]
    given = docs.select(*kept)
    schema = T.StructType([*given.schema.fields, T.StructField(out, T.BinaryType())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            ids = [own.encode(t or "") for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=[*kept, out])

    long = F.length(text) > chunk
    short = given.filter(~F.coalesce(long, F.lit(False))).mapInArrow(tidied(whole, "bpe"), schema)
    row = free_name(docs, "_row")
    numbered = materialize(given.filter(long).withColumn(row, F.monotonically_increasing_id()), "bpe")
    stitched = _encode_long(numbered.select(F.col(row).alias("_row"), F.col(text).alias("_text")), path, pattern, chunk, overlap)
    stitched = stitched.select(F.col("_row").alias(row), F.col("_ids").alias(out))
    return short.unionByName(numbered.join(stitched, row).select(*kept, out))


def _encode_long(rows: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    n = partitions(rows.sparkSession)
    count = F.ceil(F.length("_text") / F.lit(chunk)).cast("int")
    chunks = (
        rows.select("_row", "_text", F.length("_text").alias("_size"), count.alias("_count"))
        .select("_row", "_text", "_size", "_count", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("chunk"))
        .select("_row", "_size", "chunk", (F.col("chunk") == F.col("_count") - 1).alias("last"), F.substring("_text", F.col("chunk") * chunk + 1, F.lit(chunk + overlap)).alias("part"))
        .repartition(n, "_row", "chunk")
    )
    edge = "struct<chunk:int,head:array<int>,tail:array<int>>"

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = regex.compile(pattern)
        for batch in batches:
            made = []
            for r in batch.select(["chunk", "last", "part"]).to_pylist():
                head, tail = chunk_edges(own, r["part"], overlap, r["chunk"] == 0, r["last"])
                made.append({"chunk": r["chunk"], "head": head.tolist(), "tail": tail.tolist()})
            kind = pa.struct([("chunk", pa.int32()), ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_size"), pa.array(made, kind)], names=["_row", "_size", "edge"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [[{"start": a, "size": b} for a, b in stitch(e, chunk, size)] for e, size in zip(batch.column("edges").to_pylist(), batch.column("_size").to_pylist(), strict=True)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(made, kind)], names=["_row", "pieces"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            ids = [own.encode(p) for p in batch.column("part").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("piece"), pa.array(ids, pa.binary())], names=["_row", "piece", "ids"])

    found = chunks.mapInArrow(tidied(edges, "bpe"), f"_row long, _size int, edge {edge}")
    # a text's chunks meet again: as many as it is long
    pieces = found.groupBy("_row", "_size").agg(F.collect_list("edge").alias("edges")).mapInArrow(tidied(cut, "bpe"), "_row long, pieces array<struct<start:int,size:int>>")
    parts = (
        rows.join(pieces, "_row")
        .select("_row", "_text", F.posexplode("pieces").alias("piece", "p"))
        .select("_row", "piece", F.expr("substring(_text, p.start + 1, p.size)").alias("part"))
        .repartition(n, "_row", "piece")
        .mapInArrow(tidied(encode, "bpe"), "_row long, piece int, ids binary")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(p["ids"] for p in r) for r in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(ids, pa.binary())], names=["_row", "_ids"])

    return parts.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("parts")).mapInArrow(tidied(join, "bpe"), "_row long, _ids binary")


def detokenize(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the bytes that the ids stand for, joined; they need not be valid UTF-8 for cut id lists."""
    kept = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            made = [own.decode(i or b"") for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.binary())], names=[*kept, out])

    return docs.select(*kept).mapInArrow(tidied(run, "bpe"), T.StructType([*docs.select(*kept).schema.fields, T.StructField(out, T.BinaryType())]))


def digest(tokens: DataFrame) -> DataFrame:
    """One row per document: number of ids, and hashes of the ids and of the decoded bytes."""
    return tokens.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

