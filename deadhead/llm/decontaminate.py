"""Benchmark decontamination: a broadcast set of test n-grams scanned against the word windows of training texts.

Words are runs of digits, letters a-z and non-ASCII characters after lower-casing A-Z. A window is ``n`` consecutive words
of a benchmark item; an item of fewer words, but not none, is one window. A document word inside any occurrence of a
window is hit. Every hash match is verified word by word.

The benchmark is broadcast while its texts take at most ``broadcast_bytes`` (measured first). A larger one is joined by
window hash instead: documents get a row number in a written table, their windows meet the benchmark's in a shuffle, and
the matching windows return to their documents. Both ways give the same rows.

Defined results: NULL or empty texts have no words, no hits and are kept; items with a NULL id or text have no windows; equal items all
count; repeated documents get equal rows each; empty tables give no rows or no hits; further columns pass through
``remove_spans`` and ``remove_documents`` unchanged and are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm.common import free_name, lengths_to_starts, materialize, texts, tidied, window_hashes

#: Word bytes: digits, a-z (A-Z lower-cased) and every byte of a non-ASCII character.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")

SCAN = "n_words long, n_hit long, items array<string>, spans array<struct<first:int,last:int>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Windows:
    """Benchmark windows in numpy arrays: word numbers, and per window length sorted hashes, words and items."""

    def __init__(self, items: list[tuple[str, bytes]], n: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                by_length.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.lengths: dict[int, tuple[np.ndarray, np.ndarray, list[tuple[str, ...]]]] = {}
        for size, windows in sorted(by_length.items()):
            rows = np.array(list(windows), np.int64).reshape(-1, size)
            hashes = self._hash(rows)
            order = np.argsort(hashes, kind="stable")
            owners = list(windows.values())
            self.lengths[size] = hashes[order], rows[order].astype(np.int32), [tuple(sorted(owners[i])) for i in order]

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        flat = rows.astype(np.uint64).ravel() + np.uint64(1)
        return window_hashes(flat, rows.shape[1])[:: rows.shape[1]]

    def find(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, start, window) of every occurrence; numbers under 0 are words that no item has."""
        place = np.arange(len(ids))
        unknown = np.maximum.accumulate(np.where(ids < 0, place, -1)) if len(ids) else place
        for size, (hashes, rows, _) in self.lengths.items():
            ends = np.flatnonzero(place - unknown >= size)
            starts = ends - size + 1
            if not len(starts):
                continue
            found = ids[starts[:, None] + np.arange(size)]
            key = self._hash(found)
            left, right = np.searchsorted(hashes, key, "left"), np.searchsorted(hashes, key, "right")
            for step in range(int((right - left).max(initial=0))):  # several windows only if their hashes collide
                some = np.flatnonzero(left + step < right)
                at = left[some] + step
                same = (rows[at] == found[some]).all(axis=1)
                yield size, starts[some][same], at[same]


def _scan_batch(windows: Windows, raw: list[bytes]) -> dict[str, pa.Array]:
    words = [words_of(t) for t in raw]
    # one number that no window has stands between two documents
    ids = np.fromiter(
        (i for w in words for i in (*map(windows.vocabulary.get, w, repeat(-1)), -1)), np.int64
    )
    counts = np.array([len(w) for w in words], np.int64)
    begins = lengths_to_starts(counts + 1)
    hit = np.zeros(len(ids), bool)
    items: dict[int, set[str]] = {}
    for size, starts, at in windows.find(ids):
        for k in range(size):
            hit[starts + k] = True
        owners = windows.lengths[size][2]
        for doc, w in zip(np.searchsorted(begins, starts, "right") - 1, at, strict=True):
            items.setdefault(int(doc), set()).update(owners[w])
    sums = lengths_to_starts(hit)
    n_hit = sums[begins[1:]] - sums[begins[:-1]]
    spans: list[list[dict[str, int]]] = [[] for _ in raw]
    for doc in items:
        own = np.flatnonzero(np.diff(np.concatenate(([0], hit[begins[doc] : begins[doc + 1]], [0])).astype(np.int8)))
        spans[doc] = [{"first": int(a), "last": int(b) - 1} for a, b in own.reshape(-1, 2)]
    return {
        "n_words": pa.array(counts),
        "n_hit": pa.array(n_hit.astype(np.int64)),
        "items": pa.array([sorted(items.get(i, ())) for i in range(len(raw))], pa.list_(pa.string())),
        "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
    }


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = 8 << 20,
    out: str = "scan",
) -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: n_words, n_hit, items with occurring windows, hit word spans."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")).na.drop()
    measured = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if measured > broadcast_bytes:
        return _scan_by_join(docs, items, n, text, out)
    windows = Windows([(r.item, r.text.encode()) for r in items.toLocalIterator()], n)
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = _scan_batch(shared.value, texts(batch.column(text)))
                struct = pa.StructArray.from_arrays(list(made.values()), names=list(made))
                yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, out])

    given = docs.drop(out)
    return given.mapInArrow(tidied(run), T.StructType([*given.schema.fields, T.StructField(out, T.StructType.fromDDL(SCAN))]))


def _scan_by_join(docs: DataFrame, items: DataFrame, n: int, text: str, out: str) -> DataFrame:
    """The same result with the benchmark's windows in a shuffle join, for benchmarks too large to send to each task."""
    row = free_name(docs, "_row")
    numbered = materialize(docs.drop(out).withColumn(row, F.monotonically_increasing_id()), "decontaminate")
    rows = numbered.select(F.col(row).alias("_row"), F.col(text).alias("_text"))

    def words(column: str) -> F.Column:
        lowered = F.translate(F.coalesce(F.col(column), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))

    own = items.select("item", words("text").alias("w")).filter(F.size("w") > 0)
    size = F.least(F.lit(n), F.size("w"))
    grams = own.select(
        "item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice("w", i, size))).alias("g")
    ).distinct()
    lengths = sorted(r[0] for r in grams.select(F.size("g")).distinct().collect())  # at most n numbers
    counted = rows.select("_row", words("_text").alias("w"))
    hits = None
    for k in lengths:
        runs = counted.filter(F.size("w") >= k).select(
            "_row", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.slice("w", i, k))).alias("first", "g")  # noqa: B023
        )
        part = runs.join(grams.filter(F.size("g") == k), "g").select("_row", "first", (F.col("first") + k - 1).alias("last"), "item")
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        hits = counted.select("_row", F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit("").alias("item")).filter("false")
    per_row = hits.groupBy("_row").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.collect_set(F.struct("first", "last")).alias("found"),  # at most one per word of the document and length
    )
    merged = F.aggregate(
        F.array_sort("found"),
        F.expr("cast(array() as array<struct<first:int,last:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["last"] + 1 >= x["first"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["last"], x["last"]).alias("last"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["first"].alias("first"), x["last"].alias("last"))))),
    )
    scanned = counted.select("_row", F.size("w").cast("long").alias("n_words")).join(per_row.select("_row", "items", merged.alias("spans")), "_row", "left")
    empty_items, empty_spans = F.expr("cast(array() as array<string>)"), F.expr("cast(array() as array<struct<first:int,last:int>>)")
    result = scanned.select(
        "_row",
        F.struct(
            "n_words",
            F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1), F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", empty_items).alias("items"),
            F.coalesce("spans", empty_spans).alias("spans"),
        ).alias(out),
    )
    return numbered.join(result.withColumnRenamed("_row", row), row).drop(row)


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; columns as they came."""
    out = free_name(docs, "scan")
    return scan(docs, benchmark, out=out, **options).filter(F.col(out)["n_hit"] == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with hit spans cut from ``text``: each run of hit words goes, with what stands between its words."""
    out, names = free_name(docs, "scan"), docs.columns
    scanned = scan(docs, benchmark, text=text, out=out, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                _cut(t, s["spans"]) if s["spans"] else t
                for t, s in zip(batch.column(text).to_pylist(), batch.column(out).to_pylist(), strict=True)
            ]
            columns = [pa.array(kept, pa.string()) if n == text else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return scanned.mapInArrow(tidied(run), docs.schema)


def _cut(text: str, spans: list[dict[str, int]]) -> str:
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(re.sub(rb"[\x09-\x0d]", b" ", raw.translate(_TABLE)))]
    out, at = [], 0
    for s in spans:
        out.append(raw[at : places[s["first"]][0]])
        at = places[s["last"]][1]
    return b"".join([*out, raw[at:]]).decode()


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document with the items as a sha256 of their sorted, comma-joined ids."""
    return scanned.select(
        "doc_id",
        F.col("scan.n_words").alias("n_words"),
        F.col("scan.n_hit").alias("n_hit"),
        F.size("scan.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("scan.items", ","), 256).alias("items_sha256"),
        (F.col("scan.n_hit") > 0).alias("contaminated"),
    )
