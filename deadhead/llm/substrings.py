"""Substring deduplication by super-k-mers.

A window is ``width`` consecutive words (runs without ASCII white space) of one document. A word goes if a window over it
occurs anywhere else too, in the same document or another; windows are judged on the input, not on what is left.

* Documents are packed into blocks of a few MB, written once. A block is the unit that meets the shuffle.
* In a block, every window has a minimiser, the smallest hash among its ``seed``-word runs. Consecutive windows with the
  same minimiser form one super-k-mer, which travels as one string of words to the bucket of its minimiser. Equal
  super-k-mers of a block travel once, with their count: a passage in every document costs a bucket one string per block.
* A bucket sorts its windows by hash and compares the texts of neighbours, so counts are exact.
* Buckets that hold many times the mean (a frequent minimiser with ever other neighbours) are dealt out again by single
  windows: their windows travel one by one to the bucket of the window itself. Loads are counted first, per bucket, over
  all data; equal windows always take the same way.
* The bucket returns, per block, which windows repeat. The block derives its super-k-mers anew and cuts its texts.

Defined results: NULL or empty texts have no words and stay as they are; texts shorter than a window stay; equal rows are
occurrences of their own, so all copies of a long text lose their words; very long texts form a block of their own; an
empty table gives no rows; further columns come back unchanged.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm.common import BATCH_ROWS, SPACED, buffer_hashes, free_name, lengths_to_starts, materialize, mixed, partitions, texts, tidied, window_hashes, word_starts

#: Text of one block.
BLOCK_BYTES = 6 << 20
#: Packed words that a bucket should hold, and how many times that makes it be dealt out by windows.
BUCKET_BYTES, HOT = 12 << 20, 4
#: Windows of a block and bytes of a bucket's super-k-mers that are hashed at a time, windows that are compared at a time.
WINDOWS, LINES_BYTES, COMPARED = 1 << 16, 1 << 19, 20_000
#: Bytes of super-k-mers that a byte of text becomes, about 2 + 2 * seed / width and a word.
EXPANSION = 3.2

_BLOCKS = "block long, texts long, bytes long, payload binary"


def words_of(text: bytes) -> list[bytes]:
    return text.split()


# blocks


def pack_blocks(docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` as written rows of compressed Arrow tables, numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            sizes = np.array([len(t) for t in texts(batch.column(text))], np.int64)
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(sizes[at:]), block_bytes - size, "right"))
                take = min(batch.num_rows - at, max(fits, 0 if held else 1))
                if take:
                    held.append(batch.slice(at, take))
                    size += int(sizes[at : at + take].sum())
                    at += take
                if at < batch.num_rows:
                    yield _block(held, size)
                    held, size = [], 0
        if held:
            yield _block(held, size)

    packed = docs.mapInArrow(tidied(run), "texts long, bytes long, payload binary")
    return materialize(packed.select(F.monotonically_increasing_id().alias("block"), "*"), "blocks")


def _block(held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held[0].schema) as out:
        for batch in held:
            out.write_batch(batch)
    payload = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
    return pa.RecordBatch.from_pydict({"texts": [sum(b.num_rows for b in held)], "bytes": [size], "payload": pa.array([payload], pa.binary())})


def unpack_block(payload: bytes) -> pa.Table:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    with pa.ipc.open_stream(raw) as batches:
        return batches.read_all()


class Block:
    """The words of a block, its windows and their super-k-mers."""

    def __init__(self, raw: list[bytes], width: int, seed: int) -> None:
        self.width = width
        spaced = [b" ".join(words_of(t)) for t in raw]
        self.counts = np.array([t.count(b" ") + 1 if t else 0 for t in spaced], np.int64)
        self.begins = lengths_to_starts(self.counts)
        # the text of words i to j is buffer[at[i] : at[j] - 1], whatever stood between them
        self.buffer = b" ".join([t for t in spaced if t])
        self.at = word_starts(self.buffer)
        total = len(self.at) - 1
        n = total - width + 1
        if n <= 0:
            self.starts = self.sizes = np.empty(0, np.int64)
            self.minimisers = np.empty(0, np.uint64)
            return
        del spaced
        lowest = np.empty(n, np.uint64)
        for a in range(0, n, WINDOWS):
            b = min(n, a + WINDOWS)
            lowest[a:b] = self._lowest(a, b, seed)
        inside = np.zeros(total + 1, bool)
        for a, size in zip(self.begins[:-1][self.counts >= width], self.counts[self.counts >= width], strict=True):
            inside[a : a + size - width + 1] = True
        inside = inside[:n]
        fresh = np.concatenate(([True], (lowest[1:] != lowest[:-1]) | ~inside[:-1]))
        # two documents that follow each other without a gap of windows
        fresh[self.begins[:-1][self.begins[:-1] < n]] = True
        self.starts = np.flatnonzero(inside & fresh)
        ends = np.flatnonzero(inside & np.append(fresh[1:] | ~inside[1:], True))
        self.sizes = ends - self.starts + 1
        self.minimisers = lowest[self.starts]

    def _lowest(self, a: int, b: int, seed: int) -> np.ndarray:
        """The smallest hash of ``seed`` words in each window from ``a`` to ``b``."""
        at = self.at[a : b + self.width]
        lowest = mixed(window_hashes(buffer_hashes(self.buffer[at[0] : at[-1] - 1], at - at[0]), seed))
        span, reach = self.width - seed + 1, 1
        while reach < span:  # the minimum over span seeds, by doubling
            step = min(reach, span - reach)
            lowest = np.minimum(lowest[: len(lowest) - step], lowest[step:])
            reach += step
        return lowest

    def single(self, which: np.ndarray) -> np.ndarray:
        """Starts of all windows of these super-k-mers."""
        sizes = self.sizes[which]
        return np.repeat(self.starts[which] - lengths_to_starts(sizes)[:-1], sizes) + np.arange(sizes.sum())

    def string(self, start: int, size: int) -> bytes:
        return self.buffer[self.at[start] : self.at[start + size + self.width - 1] - 1]

    def parts(self, buckets: int, hot: np.ndarray) -> Iterator[tuple[int, list[bytes], list[int], list[list[int]]]]:
        """Per bucket its distinct super-k-mers in a fixed order, their windows and where they stand."""
        bucket = (self.minimisers % np.uint64(buckets)).astype(np.int64)
        cold = ~hot[bucket]
        starts, sizes, target = self.starts[cold], self.sizes[cold], bucket[cold]
        if not cold.all():
            alone = self.single(np.flatnonzero(~cold))
            keys = np.array([int.from_bytes(hashlib.blake2b(self.string(s, 1), digest_size=8).digest(), "little") for s in alone.tolist()], np.uint64)
            starts, sizes = np.concatenate((starts, alone)), np.concatenate((sizes, np.ones(len(alone), np.int64)))
            target = np.concatenate((target, (keys % np.uint64(buckets)).astype(np.int64)))
        order = np.argsort(target, kind="stable")
        target = target[order]
        edges = np.flatnonzero(np.diff(target, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            places: dict[bytes, list[int]] = {}
            windows: list[int] = []
            for s, size in zip(starts[order[a:b]].tolist(), sizes[order[a:b]].tolist(), strict=True):
                string = self.string(s, size)
                own = places.get(string)
                if own is None:
                    places[string] = [s]
                    windows.append(size)
                else:
                    own.append(s)
            yield int(target[a]), list(places), windows, list(places.values())


def _keyed(strings: bytes, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Super-k-mers, a line each, some at a time: windows of each one, and of each window hash, first byte and end."""
    begin = 0
    while begin < len(strings):
        end = strings.find(b"\n", begin + LINES_BYTES)
        end = len(strings) if end < 0 else end
        lines = strings[begin:end]
        spaced = lines.translate(SPACED)
        at = word_starts(spaced)
        last = np.append(np.frombuffer(lines, np.uint8)[at[1:-1] - 1] == 10, True)  # words at the end of a line
        ends = np.flatnonzero(last) + 1
        sizes = np.diff(ends, prepend=0)
        windows = sizes - width + 1
        begins = lengths_to_starts(windows)
        starts = np.repeat(ends - sizes - begins[:-1], windows) + np.arange(begins[-1])
        yield windows, window_hashes(buffer_hashes(spaced, at), width)[starts], at[starts] + begin, at[starts + width] - 1 + begin
        begin = end + 1


def repeated_windows(strings: bytes, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the super-k-mers of a bucket, a line each: their windows, and a flag for each window: whether it occurs more than once."""
    windows, key, first, end = (np.concatenate(x) for x in zip(*_keyed(strings, width), strict=True))
    # a window occurs again in a super-k-mer that does, or has a neighbour of its hash
    repeat = np.repeat(counts > 1, windows)
    weight = repeat.astype(np.uint8) + 1
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    del key
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    del ordered
    same = np.flatnonzero(~fresh)
    # windows of one hash must be one text: each is compared with the one before it
    odd: list[int] = []
    for k in range(0, len(same), COMPARED):
        some = same[k : k + COMPARED]
        x, y = order[some], order[some - 1]
        places = zip(some.tolist(), first[x].tolist(), end[x].tolist(), first[y].tolist(), end[y].tolist(), strict=True)
        odd += [g for g, a, b, c, d in places if strings[a:b] != strings[c:d]]
        repeat[x] = repeat[y] = True
    if odd:  # different texts under one hash are counted apart
        edges = np.append(np.flatnonzero(fresh), len(fresh))
        for g in np.unique(np.searchsorted(edges, odd, "right") - 1).tolist():
            members = order[edges[g] : edges[g + 1]].tolist()
            real = [strings[first[m] : end[m]] for m in members]
            seen: Counter = Counter()
            for m, words in zip(members, real, strict=True):
                seen[words] += int(weight[m])
            for m, words in zip(members, real, strict=True):
                repeat[m] = seen[words] > 1
    return windows, repeat


# the job


def deduplicate(
    docs: DataFrame, text: str = "text", width: int = 35, seed: int = 6, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_times: float = HOT, out: str = "cut"
) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_removed, spans of removed words, and the kept words joined by a space."""
    spark = docs.sparkSession
    given = docs.drop(out)
    schema = T.StructType([*given.schema.fields, T.StructField(out, T.StructType.fromDDL(CUT))])
    blocks = pack_blocks(given, text, block_bytes)
    size = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(size * EXPANSION / bucket_bytes), partitions(spark))
    # bytes per bucket over all data: one number for each bucket
    loads = blocks.mapInArrow(tidied(_loads(text, width, seed, buckets)), "bucket int, bytes long").groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    limit = max(bucket_bytes * hot_times, hot_times * size * EXPANSION / buckets)
    hot = np.zeros(buckets, bool)
    hot[[r.bucket for r in loads.filter(F.col("bytes") > limit).toLocalIterator()]] = True
    sent = blocks.mapInArrow(tidied(_send(text, width, seed, buckets, hot)), "bucket int, block long, strings binary, counts binary")
    flags = (
        sent.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(tidied(_count(width)), "block long, bucket int, flags binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("bucket", "flags")).alias("found"))  # at most one per bucket and a bit per window
    )
    return blocks.join(flags, "block", "left").select("payload", "found").mapInArrow(tidied(_cut(text, width, seed, buckets, hot, out)), schema)


CUT = "n_words long, n_removed long, spans array<struct<first:int,last:int>>, kept string"


def _read(batches: Iterator[pa.RecordBatch], text: str, width: int, seed: int) -> Iterator[tuple[pa.RecordBatch, int, pa.Table, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            given = unpack_block(batch.column("payload")[i].as_py())
            yield batch, i, given, Block(texts(given.column(text).combine_chunks()), width, seed)
            del given  # users of a block drop it too, so that the next one does not stand beside it


def _loads(text: str, width: int, seed: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, _, _, own in _read(batches, text, width, seed):
            bytes_ = own.at[own.starts + own.sizes + width - 1] - own.at[own.starts]
            total += np.bincount((own.minimisers % np.uint64(buckets)).astype(np.int64), weights=bytes_, minlength=buckets).astype(np.int64)
            del _, own, bytes_
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "bytes": pa.array(total[some])})

    return run


def _send(text: str, width: int, seed: int, buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch, i, given, own in _read(batches, text, width, seed):
            del given
            block = batch.column("block")[i].as_py()
            for bucket, strings, _, places in own.parts(buckets, hot):
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([bucket], pa.int32()),
                        "block": [block],
                        "strings": pa.array([press.compress(b"\n".join(strings))], pa.binary()),
                        "counts": pa.array([np.array([len(p) for p in places], "<u4").tobytes()], pa.binary()),
                    }
                )
                del strings, places
            del own

    return run


def _count(width: int):
    def flush(bucket: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        counts = [np.frombuffer(r["counts"], "<u4") for r in rows]
        windows, flags = repeated_windows(b"\n".join([zstandard.decompress(r.pop("strings")) for r in rows]), np.concatenate(counts), width)
        begins = lengths_to_starts(windows)[lengths_to_starts(np.array([len(c) for c in counts], np.int64))].tolist()
        for r, a, b in zip(rows, begins[:-1], begins[1:], strict=True):
            own = flags[a:b]
            if own.any():
                yield pa.RecordBatch.from_pydict({"block": [r["block"]], "bucket": pa.array([bucket], pa.int32()), "flags": pa.array([zstandard.compress(np.packbits(own).tobytes())], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] != bucket and rows:
                    yield from flush(bucket, rows)
                    rows = []
                bucket = r["bucket"]
                rows.append(r)
        if rows:
            yield from flush(bucket, rows)

    return run


def _cut(text: str, width: int, seed: int, buckets: int, hot: np.ndarray, out: str):
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def removed(own: Block, found: list[dict]) -> np.ndarray:
        flags = {f["bucket"]: np.unpackbits(np.frombuffer(zstandard.decompress(f["flags"]), np.uint8)) for f in found}
        change = np.zeros(len(own.at) + 1, np.int64)
        if flags:
            for bucket, _, windows, places in own.parts(buckets, hot):
                if bucket not in flags:
                    continue
                bits, at = flags[bucket], 0
                for size, starts in zip(windows, places, strict=True):
                    inner = np.flatnonzero(bits[at : at + size])
                    at += size
                    for s in starts if len(inner) else ():
                        np.add.at(change, inner + s, 1)
                        np.add.at(change, inner + s + own.width, -1)
        return np.cumsum(change)[: own.begins[-1]] > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, given, own in _read(batches, text, width, seed):
            gone = removed(own, batch.column("found")[i].as_py() or [])
            n_removed, spans, kept = [], [], []
            for raw, a, b in zip(texts(given.column(text).combine_chunks()), own.begins[:-1].tolist(), own.begins[1:].tolist(), strict=True):
                away = gone[a:b]
                n_removed.append(int(away.sum()))
                if not n_removed[-1]:
                    spans.append([])
                    kept.append(own.buffer[own.at[a] : own.at[b] - 1].decode() if b > a else "")
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate(([0], away, [0])).astype(np.int8))).reshape(-1, 2)
                spans.append([{"first": x, "last": y - 1} for x, y in edges.tolist()])
                words = words_of(raw)
                kept.append(b" ".join([words[k] for k in np.flatnonzero(~away).tolist()]).decode())
            cut = pa.StructArray.from_arrays(
                [pa.array(own.counts), pa.array(n_removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())], names=["n_words", "n_removed", "spans", "kept"]
            )
            del gone, own, spans, kept
            whole = pa.Table.from_arrays([*given.columns, pa.chunked_array([cut])], names=[*given.schema.names, out])
            del given, cut
            yield from whole.to_batches(BATCH_ROWS)
            del whole

    return run


def remove(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the kept words as ``text`` where words went; other texts and all other columns as they came."""
    cut = free_name(docs, "cut")
    found = deduplicate(docs, text, out=cut, **options)
    kept = F.when(F.col(cut)["n_removed"] > 0, F.col(cut)["kept"]).otherwise(F.col(text))
    return found.select(*[kept.alias(c) if c == text else F.col(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.col("cut.n_words").alias("n_words"), F.col("cut.n_removed").alias("n_removed"), F.sha2("cut.kept", 256).alias("kept_sha256"))
