"""Helpers shared by the text operators: columns, Arrow batches, words, hashes and written stage tables."""

from __future__ import annotations

import ctypes
import string
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deadhead.session import ship_package
from deadhead.storage import shared_folder

#: Rows of one Arrow batch; documents are whole rows, so a batch of long ones stays far below a worker's memory.
BATCH_ROWS = 512

#: 64-bit odd multipliers of the polynomial hashes and of the finalizer.
MULTIPLIER = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators that hand whole texts to Python, and the package on the workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the driver and all executors share."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage as a zstd Parquet table of the shared folder and read it back: cuts lineage, survives executors."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Memories that a worker keeps from task to task: the operator that fills one, and how it is dropped.
KEPT: dict[str, Callable[[], None]] = {}

Batches = Iterator[pa.RecordBatch]


def tidied(run: Callable[[Batches], Batches], keep: str = "") -> Callable[[Batches], Batches]:
    """``run`` as a task that first drops what other operators left in this worker, and gives freed memory back at its end."""

    def task(batches: Batches) -> Batches:
        for name, drop in KEPT.items():
            if name != keep:
                drop()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
            if trim is not None:
                trim(0)

    return task


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def window_hashes(values: np.ndarray, width: int, multiplier: int = MULTIPLIER) -> np.ndarray:
    """Polynomial hash of each run of ``width`` values, by doubling: log2(width) vector operations."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, block, size = multiplier & (2**64 - 1), values, 1
    done, total, scale = 0, None, 1
    while True:
        if width & size:
            part = block[done : done + n]
            total = part.copy() if total is None else total * np.uint64(power) + part
            done += size
        if size * 2 > width:
            return total
        block = block[:-size] * np.uint64(power) + block[size:]
        power = power * power & (2**64 - 1)
        size *= 2


#: The lowest 0 to 8 bytes of 64 bits.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def span_hashes(buffer: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: word i is the ``sizes[i]`` bytes from ``starts[i]`` on. Eight bytes at a time."""
    eights = np.ndarray((len(buffer) + 1,), "<u8", buffer + bytes(8), strides=(1,))
    found = mixed((sizes.astype(np.uint64) * np.uint64(MULTIPLIER)) ^ (eights[starts] & _LOWEST[np.minimum(sizes, 8)]))
    here, done = np.flatnonzero(sizes > 8), 8
    while len(here):
        rest = sizes[here] - done
        found[here] = mixed(found[here] ^ (eights[starts[here] + done] & _LOWEST[np.minimum(rest, 8)]))
        here, done = here[rest > 8], done + 8
    return found


def same_spans(buffer: bytes, starts: np.ndarray, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the ``sizes[i]`` bytes from ``starts[i]`` on are those from ``others[i]`` on. Eight bytes at a time."""
    eights = np.ndarray((len(buffer) + 1,), "<u8", buffer + bytes(8), strides=(1,))
    same = ((eights[starts] ^ eights[others]) & _LOWEST[np.minimum(sizes, 8)]) == 0
    here, done = np.flatnonzero(same & (sizes > 8)), 8
    while len(here):
        rest = sizes[here] - done
        same[here] = ((eights[starts[here] + done] ^ eights[others[here] + done]) & _LOWEST[np.minimum(rest, 8)]) == 0
        here, done = here[same[here] & (rest > 8)], done + 8
    return same


def buffer_hashes(buffer: bytes, at: np.ndarray) -> np.ndarray:
    """``span_hashes`` of words joined by one byte: word i is ``buffer[at[i] : at[i + 1] - 1]``."""
    return span_hashes(buffer, at[:-1], np.diff(at) - 1)


#: ASCII white space as spaces; in ``LOWERED`` also A-Z lower-cased.
SPACED = bytes.maketrans(b"\t\n\v\f\r", b"     ")
LOWERED = SPACED.translate(bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode()))


def joined_texts(column: pa.Array, changes: bytes) -> tuple[bytes, np.ndarray]:
    """All texts one behind the other, their bytes changed by a table, and where each begins and the last ends. NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, edges, data = column.buffers()
    edges = np.frombuffer(edges, np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = data.slice(edges[0], edges[-1] - edges[0]).to_pybytes() if edges[-1] > edges[0] else b""
    return buffer.translate(changes), edges - edges[0]


def word_spans(buffer: bytes, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs without spaces, none of which goes beyond its text."""
    word = np.frombuffer(buffer + b" ", np.uint8) != 32
    ahead = np.concatenate(([False], word[:-1]))
    ahead[edges] = False
    starts = np.flatnonzero(word & ~ahead)
    behind = np.append(word[1:], False)
    behind[edges[edges > 0] - 1] = False
    return starts, np.flatnonzero(word & ~behind) + 1 - starts


def word_starts(buffer: bytes) -> np.ndarray:
    """Starts of the words of a text joined by single spaces, and the place behind its last space."""
    if not buffer:
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32) + 1, [len(buffer) + 1]))


def lengths_to_starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def rows_of(batches: Iterator[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
    """Apply ``make`` (RecordBatch -> dict of arrays, or None) to every non-empty batch."""
    for batch in batches:
        if batch.num_rows and (out := make(batch)) is not None:
            yield pa.RecordBatch.from_pydict(out)
