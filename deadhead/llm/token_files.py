"""Token ids in bit-packed binary files: written in document order, read back by blocks or at random.

A file holds, in this order, the packed blocks, the byte offset of each block, the document ids, a flag for each NULL id,
the first position of each document, and a fixed-size footer. Every id takes the fewest bits that the vocabulary needs.
Blocks hold a multiple of eight ids, so they begin at whole bytes and are unpacked with a few numpy operations each.

``write`` deals documents out by ranges of their ids; each task encodes its range and writes one file to the shared
folder. The manifest (one row per file) is committed by Spark: files of lost or repeated attempts are never listed, hence
never read. ``read`` gives each file to a task of its own.

Defined results: NULL and empty texts hold the end id only; NULL document ids come first; repeated rows and ids are all
kept, next to each other, equal ids in the order of their texts' hashes; an empty table gives no file and no row; further
columns are not written.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deadhead.llm.common import KEPT, SPACED, joined_texts, lengths_to_starts, materialize, new_folder, partitions, same_spans, span_hashes, tidied, word_spans

MAGIC = b"PACKIDS1"
#: n_docs, n_ids, bits, ids per block, byte offset of the index, magic
FOOTER = struct.Struct("<QQIIQ8s")
BLOCK = 32_768
#: Ids unpacked at once by ``read``.
READ_IDS = 1 << 20
REMEMBERED = 500_000

MANIFEST = "shard int, path string, n_docs long, n_ids long"


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of ``bits`` bits each, lowest bits first; padded with zeros to a multiple of eight ids."""
    padded = np.zeros(-(-len(ids) // 8) * 8, np.uint64)
    padded[: len(ids)] = ids
    groups = padded.reshape(-1, 8)
    out = np.zeros((len(groups), bits), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = groups[:, j] << np.uint64(shift)
        while byte * 8 < (j + 1) * bits:
            out[:, byte] |= (value & np.uint64(255)).astype(np.uint8)
            value = value >> np.uint64(8)
            byte += 1
    return out.tobytes()


def unpack(data: bytes, bits: int) -> np.ndarray:
    """The inverse of ``pack``, with its padding."""
    groups = np.frombuffer(data, np.uint8).reshape(-1, bits)
    out = np.empty((len(groups), 8), np.uint32)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = np.zeros(len(groups), np.uint64)
        for k, b in enumerate(range(byte, -(-((j + 1) * bits) // 8))):
            value |= groups[:, b].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.ravel()


class Writer:
    """Streams documents into one file; keeps only a batch, less than a block of ids and the index in memory."""

    def __init__(self, sink: pa.NativeFile, bits: int, block: int = BLOCK) -> None:
        self.sink, self.bits, self.block = sink, bits, block
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.offsets = [0]
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents of these sizes, their ids one behind the other."""
        self.ids += doc_ids
        self.sizes += sizes.tolist()
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block:
            self._flush(self.held // self.block * self.block)

    def _flush(self, count: int) -> None:
        every = np.concatenate(self.waiting)
        for at in range(0, count, self.block):
            data = pack(every[at : min(at + self.block, count)], self.bits)
            self.sink.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.waiting, self.held = [every[count:]], len(every) - count

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        nulls = np.array([i is None for i in self.ids], np.uint8)
        index = (
            np.array(self.offsets, "<u8"),
            np.array([i or 0 for i in self.ids], "<i8"),
            nulls,
            lengths_to_starts(np.array(self.sizes, np.int64)).astype("<u8"),
        )
        for part in index:
            self.sink.write(part.tobytes())
        self.sink.write(FOOTER.pack(len(self.ids), self.total, self.bits, self.block, self.offsets[-1], MAGIC))


class TokenFile:
    """Random access to a written file."""

    def __init__(self, path: str) -> None:
        store, name = fs.FileSystem.from_uri(path)
        self.source = store.open_input_file(name)
        self.source.seek(self.source.size() - FOOTER.size)
        self.n_docs, self.n_ids, self.bits, self.block, index, magic = FOOTER.unpack(self.source.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} holds no packed ids")
        self.source.seek(index)
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(self.source.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.doc_ids = np.frombuffer(self.source.read(8 * self.n_docs), "<i8")
        self.nulls = np.frombuffer(self.source.read(self.n_docs), np.uint8).astype(bool)
        self.starts = np.frombuffer(self.source.read(8 * (self.n_docs + 1)), "<u8").astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids at positions ``first`` to ``last``, the latter not included."""
        if last <= first:
            return np.empty(0, np.uint32)
        a, b = first // self.block, -(-last // self.block)
        self.source.seek(int(self.offsets[a]))
        data = self.source.read(int(self.offsets[b] - self.offsets[a]))
        return unpack(data, self.bits)[first - a * self.block : last - a * self.block]

    def document(self, index: int) -> np.ndarray:
        return self.ids(int(self.starts[index]), int(self.starts[index + 1]))

    def close(self) -> None:
        self.source.close()


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Stands between runs that are encoded in one call; runs that hold it are encoded alone.
BETWEEN = "\x01"
CALL = 500


#: Of a file that keeps a full stop or comma apart from the ASCII letter ahead of it and lower-cases all words.
DIVIDED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
LETTER, UPPER, MARK = 1, 2, 4
KINDS = np.array([LETTER * (c in string.ascii_letters) | UPPER * (c in string.ascii_uppercase) | MARK * (c in ".,") for c in map(chr, range(256))], np.uint8)


def divides(path: str) -> bool:
    """Whether a tokenizer file is ``DIVIDED``, and none of its added tokens can be hit by that."""
    with open(path) as file:
        made = json.load(file)
    odd = [t for t in made["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not re.fullmatch(r"<\|[a-z]+\|>", t["content"])]
    return not odd and all(made[k] == v for k, v in DIVIDED.items())


def divided(buffer: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Runs with a last full stop or comma behind an ASCII letter as a run of its own, those of ASCII letters alone lower-cased."""
    raw = np.frombuffer(buffer, np.uint8)
    kinds = KINDS[raw]
    last = starts + sizes - 1
    cut = np.flatnonzero((sizes > 1) & (kinds[last] == MARK) & (kinds[last - 1] & LETTER > 0))
    sizes = sizes.copy()
    sizes[cut] -= 1
    starts, sizes = np.insert(starts, cut + 1, last[cut]), np.insert(sizes, cut + 1, 1)
    others = lengths_to_starts(kinds & LETTER == 0)
    plain = others[starts + sizes] == others[starts]
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts[plain]] = 1
    inside[(starts + sizes)[plain]] -= 1
    lower = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & (kinds & UPPER > 0)
    return (raw + np.uint8(32) * lower).tobytes(), starts, sizes


def distinct_runs(buffer: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different run, and which of these each run is. Runs of equal hashes are compared; those that differ stand alone."""
    hashes = span_hashes(buffer, starts, sizes)
    order = np.argsort(hashes)
    fresh = np.diff(hashes[order], prepend=hashes[order[:1]] + np.uint64(1)) != 0
    first, of = order[fresh], np.empty(len(order), np.int64)
    of[order] = np.cumsum(fresh) - 1
    like = first[of]
    odd = np.flatnonzero((sizes != sizes[like]) | ~same_spans(buffer, starts, starts[like], sizes))
    of[odd] = len(first) + np.arange(len(odd))
    return np.append(first, odd), of


class WordIds(dict):
    """Ids of each run without ASCII white space, remembered for a bounded number of runs.

    The vocabularies meant here drop white space and never join across it, so a text's ids are those of its runs. Runs are
    met as spans of a batch's bytes, each different one is looked up once; where the file allows it (``divides``) they are divided
    further, so fewer are new. When the
    memory is full, the runs met since it was last full are kept in a second one, so frequent runs stay known.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.before: dict[bytes, bytes] = {}
        between = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self.divides = divides(path)

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and the number of each text's ids."""
        buffer, edges = joined_texts(column, SPACED)
        starts, sizes = word_spans(buffer, edges)
        if self.divides:
            buffer, starts, sizes = divided(buffer, starts, sizes)
        first, of = distinct_runs(buffer, starts, sizes)
        found = self._ids([buffer[a : a + n] for a, n in zip(starts[first].tolist(), sizes[first].tolist(), strict=True)])
        begins = lengths_to_starts(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        counts = np.diff(begins)[of]
        at = lengths_to_starts(counts)
        places = np.repeat(begins[of] - at[:-1], counts) + np.arange(at[-1])
        return np.frombuffer(b"".join(found), "<u4")[places], np.diff(at[np.searchsorted(starts, edges)])

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of different runs."""
        found = list(map(self.get, words))
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        if len(self) + len(new) > REMEMBERED:
            self.before = dict(self)
            self.clear()
            self.update((w, ids) for w, ids in zip(words, found, strict=True) if ids is not None)
        known = {w: self.before[w] for w in new if w in self.before}
        self.update(known)
        self._learn([w for w in new if w not in known])
        return [self[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def _learn(self, new: list[bytes]) -> None:
        mark = BETWEEN.encode()
        alone = [w for w in new if mark in w] if self.between is not None else new
        for word, found in zip(alone, self.tokenizer.encode_batch([w.decode() for w in alone], add_special_tokens=False), strict=True):
            self[word] = np.array(found.ids, "<u4").tobytes()
        rest = [w for w in new if mark not in w] if self.between is not None else []
        calls = [rest[i : i + CALL] for i in range(0, len(rest), CALL)]
        gap = b" " + mark + b" "
        found = self.tokenizer.encode_batch_fast([gap.join(c).decode() for c in calls], add_special_tokens=False)
        for call, encoded in zip(calls, found, strict=True):
            ids = np.array(encoded.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.between), len(ids)) * 4
            data, at = ids.tobytes(), 0
            for word, end in zip(call, ends.tolist(), strict=True):
                self[word] = data[at:end]
                at = end + 4


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def _forget() -> None:
    word_ids.cache_clear()
    _tokenizer.cache_clear()


KEPT["token_files"] = _forget


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file of the tokenizers library that drops white space, and the id that ends each document."""

    path: str
    end: int

    def bits(self) -> int:
        return max(1, (_tokenizer(self.path).get_vocab_size() - 1).bit_length())


def write(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Write the ids of all texts in ascending ``doc_id`` order; the manifest lists the files in that order."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    bits, end, path = vocabulary.bits(), vocabulary.end, vocabulary.path
    order = [F.col("doc_id").asc_nulls_first(), "_hash", "_row"]
    dealt = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        # rows with the same id may go to several files
        .select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
        .repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, shard, own = None, TaskContext.get().partitionId(), word_ids(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                store, root = fs.FileSystem.from_uri(folder)
                store.create_dir(root, recursive=True)
                name = f"shard-{shard:06d}-{uuid.uuid4().hex}.ids"
                writer = Writer(store.open_output_stream(f"{root}/{name}"), bits)
            ids, counts = own.batch(batch.column(1))
            writer.add(batch.column(0).to_pylist(), counts + 1, np.insert(ids, np.cumsum(counts), end))
        if writer is not None:
            writer.close()
            writer.sink.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name}"], "n_docs": [len(writer.ids)], "n_ids": [writer.total]}
            )

    return materialize(dealt.mapInArrow(tidied(run, "token_files"), MANIFEST), "token-manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids (32-bit)."""
    files = manifest.orderBy("shard").collect()  # a row per file
    begins = lengths_to_starts(np.array([f.n_ids for f in files], np.int64)).tolist()
    paths = [f.path for f in files]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                own = TokenFile(paths[k])
                yield from _documents(own, begins[k])
                own.close()

    return spark.range(0, len(paths), 1, max(1, len(paths))).mapInArrow(tidied(run, "token_files"), "doc_id long, start long, n_tokens long, ids binary")


def _documents(own: TokenFile, begin: int) -> Iterator[pa.RecordBatch]:
    a = 0
    while a < own.n_docs:
        b = max(a + 1, int(np.searchsorted(own.starts, own.starts[a] + READ_IDS, "right")) - 1)
        b = min(b, own.n_docs)
        starts = own.starts[a : b + 1]
        data = own.ids(int(starts[0]), int(starts[-1])).astype("<u4").tobytes()
        offsets = ((starts - starts[0]) * 4).astype(np.int64)
        ids = [data[i:j] for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(own.doc_ids[a:b], pa.int64(), mask=own.nulls[a:b]),
                "start": pa.array(starts[:-1] + begin),
                "n_tokens": pa.array(np.diff(starts)),
                "ids": pa.array(ids, pa.binary()),
            }
        )
        a = b


def digest(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
