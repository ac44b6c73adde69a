"""Interpolated modified Kneser-Ney language model over word pairs or triples, counted in Spark and read by memory map.

Training text counts as: begin, its words (runs without ASCII white space, A-Z lower-cased), end. Three passes over packed
arrays build the model, a shard per bucket:

* words: sorted 64-bit hashes and counts, dealt out by ranges of the hash. A word's number is its place in that order.
* pairs: sorted (number of the first word, number of the second) and counts, dealt out by the first word's shard. A first
  word with more than a shard's share of all tokens is spread over as many shards as it fills, by its second word.
* per word, from the distinct pairs: how many tokens follow it, how many words follow it once, twice and more often, and how
  different words it follows.

Order 3 adds two passes, and the pairs then count by the different words ahead of them, those after a begin by their tokens:

* triples: sorted (place of the first two words in their shard of pairs, number of the third) and counts, in the shard of
  the pair. A pair with more than a shard's share of all tokens is spread by the third word. Per pair: how many words follow
  it once, twice and more often. A text's first word is scored by pairs.
* from the distinct triples: the different words ahead of each pair, and from these the numbers per word above.

Texts are cut into words and hashed by array operations on the bytes of a batch, without an object for each word. Tasks
combine equal words and pairs before they send them. Shards are files of the shared folder, named anew by each
attempt and listed by a table that Spark commits. Scoring tasks map them into memory and look up sorted batches of
keys; only the list of files and a few totals travel. Files of a store without local paths are fetched once per worker,
mapped, and unlinked.

Defined results: a NULL or empty text is its end token only; without training tokens the model is uniform over the unknown
word; repeated rows count and are scored each by itself; an empty table gives no rows; further columns are carried along.
"""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm.common import LOWERED, joined_texts, lengths_to_starts, materialize, mixed, new_folder, partitions, span_hashes, tidied, word_spans

#: Hash of the end; no word holds a line end.
END = span_hashes(b"\n", np.zeros(1, np.int64), np.ones(1, np.int64))[0]
#: Tokens that a task counts before it sends them.
HELD = 2_000_000
#: Most frequent words that a shard reports, to find those that must be spread.
FREQUENT = 256
UNDECIDED = 0.5
#: Places of pairs that are spread over shards begin here.
HEAVY = 1 << 31
#: Text of a shard, at most; word numbers and places of pairs are held in 32 bits.
SHARD_BYTES = 128 << 20
_SALT = np.uint64(0x9E3779B97F4A7C15)

_LONGS = pa.list_(pa.int64())
SCORE = "n_tokens long, n_known long, base_score double, score double"


# packed arrays


def squeeze(ordered: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending 64-bit numbers and their counts, compressed: steps by byte planes, then the counts."""
    steps = np.diff(ordered, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.compress(planes, 1)


def unsqueeze(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    n = len(planes) // 12
    steps = planes[: 8 * n].reshape(8, n).T.copy().view("<u8").ravel()
    counts = planes[8 * n :].reshape(4, n).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, in order, with their counts added."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _send(bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per bucket of ascending ``keys``."""
    for k, some in _groups(bucket, int(bucket.max(initial=0)) + 1):
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([k], pa.int32()), "part": pa.array([squeeze(keys[some], counts[some])], pa.binary())})


def _gather(batches: Iterator[pa.RecordBatch], done: Callable[[int, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Call ``done`` with each bucket's summed keys; rows come sorted by bucket. Parts are added up as they come."""
    bucket, keys, counts, waiting, size = None, None, None, [], 0

    def merge() -> None:
        nonlocal keys, counts, waiting, size
        keys, counts = summed(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]))
        waiting, size = [(keys, counts)], 0

    for batch in batches:
        for b, part in zip(batch.column("bucket").to_pylist(), batch.column("part").to_pylist(), strict=True):
            if b != bucket and waiting:
                merge()
                yield from done(bucket, keys, counts)
                waiting = []
            bucket = b
            waiting.append(unsqueeze(part))
            size += len(waiting[-1][0])
            if size > HELD:
                merge()
    if waiting:
        merge()
        yield from done(bucket, keys, counts)


# files


def _write(folder: str, array: np.ndarray) -> str:
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.bin"
    with store.open_output_stream(f"{root}/{name}") as out:
        out.write(np.ascontiguousarray(array).tobytes())
    return f"{folder}/{name}"


@functools.lru_cache(maxsize=4096)
def mapped(path: str, kind: str) -> np.ndarray:
    """An array of a file, mapped into memory."""
    store, name = fs.FileSystem.from_uri(path)
    if store.get_file_info(name).size == 0:
        return np.empty(0, kind)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(name, kind, "r")
    with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(name) as source:
        shutil.copyfileobj(source, copy, 1 << 20)
        copy.flush()
        os.fsync(copy.fileno())
        return np.memmap(copy.name, kind, "r")  # stays readable without its name


# model

#: Shards and the places of a batch's keys that belong to each.
Groups = list[tuple[int, np.ndarray]]


def _groups(shard: np.ndarray, shards: int) -> Groups:
    """Places by shard, those of one shard in the order they came."""
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")  # by radix for 16 bits
    edges = lengths_to_starts(np.bincount(shard, minlength=shards))
    return [(k, order[edges[k] : edges[k + 1]]) for k in np.flatnonzero(np.diff(edges)).tolist()]


@dataclass
class Model:
    """File names and totals; the arrays stay in the files."""

    shards: int
    words: dict[int, tuple[str, str]] = field(default_factory=dict)  # hashes, counts
    begins: list[int] = field(default_factory=lambda: [0])  # first word number of each shard, and the number of words
    tokens: int = 0
    texts: int = 0
    spread: dict[int, int] = field(default_factory=dict)  # word number -> shards that its pairs fill
    pairs: dict[int, tuple[str, str, str]] = field(default_factory=dict)  # keys, counts up to 255, the larger ones
    follow: dict[int, str] = field(default_factory=dict)  # tokens behind, words behind once, twice, more
    spread_follow: dict[int, list[int]] = field(default_factory=dict)
    ahead: dict[int, str] = field(default_factory=dict)  # different words ahead
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    pair_types: int = 0
    word_rest: float = 1.0
    heavy: dict[int, int] = field(default_factory=dict)  # key of a pair -> shards that its triples fill
    triples: dict[int, tuple[str, str, str]] = field(default_factory=dict)  # as pairs
    behind: dict[int, tuple[str, str]] = field(default_factory=dict)  # words behind each pair once, twice, more
    heavy_behind: dict[int, list[int]] = field(default_factory=dict)
    adjusted: dict[int, tuple[str, str]] = field(default_factory=dict)  # different words ahead of each pair
    triple_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    order: int = 2

    @property
    def types(self) -> int:
        return self.begins[-1]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (-1: unknown) and counts of ascending hashes."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        edges = np.searchsorted(_range(hashes, self.shards), np.arange(self.shards + 1))
        for shard, (keys, counts) in self.words.items():
            a, b = edges[shard], edges[shard + 1]
            if b > a:
                own = mapped(keys, "<u8")
                at = np.searchsorted(own, hashes[a:b])
                hit = np.flatnonzero(own[np.minimum(at, len(own) - 1)] == hashes[a:b])
                number[a + hit] = at[hit] + self.begins[shard]
                count[a + hit] = mapped(counts, "<i8")[at[hit]]
        return number, count

    def shard_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Shards of pairs: those of the first words, moved on by the second ones where the first is spread."""
        own = np.searchsorted(self.begins[1:], first, "right")
        own = np.minimum(own, self.shards - 1)
        if self.spread:
            names = np.array(sorted(self.spread))
            parts = np.array([self.spread[k] for k in sorted(self.spread)])
            at = np.minimum(np.searchsorted(names, first), len(names) - 1)
            some = np.flatnonzero(names[at] == first)
            step = (mixed(second[some].astype(np.uint64) * _SALT) % parts[at[some]].astype(np.uint64)).astype(np.int64)
            own[some] = (own[some] + step) % self.shards
        return own

    def _places(self, files: dict[int, tuple[str, ...]], keys: np.ndarray, groups: Groups) -> np.ndarray:
        """Places of keys in the files of their shards, -1 for those that are not there."""
        out = np.full(len(keys), -1, np.int64)
        for k, some in groups:
            if k in files:
                own, wanted = mapped(files[k][0], "<u8"), keys[some]
                at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                out[some] = np.where(own[at] == wanted, at, -1)
        return out

    def _at_places(self, files: dict[int, tuple[str, ...]], groups: Groups, place: np.ndarray, width: int = 1) -> np.ndarray:
        """Rows of counts, zeros where there is no place."""
        out = np.zeros((len(place), width), np.int64)
        for k, some in groups:
            some = some[place[some] >= 0]
            if k in files and len(some):
                small, large = files[k][-2:]
                at = (place[some][:, None] * width + np.arange(width)).ravel()
                found = mapped(small, "u1")[at].astype(np.int64)
                full = np.flatnonzero(found == 255)
                if len(full):
                    rest = mapped(large, "<i8").reshape(-1, 2)
                    found[full] = rest[np.searchsorted(rest[:, 0], at[full]), 1]
                out[some] = found.reshape(-1, width)
        return out

    def _heavy(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys of pairs are spread, and their numbers among these."""
        names = np.array(sorted(self.heavy), np.uint64)
        at = np.minimum(np.searchsorted(names, pairs), max(len(names) - 1, 0))
        some = np.flatnonzero(names[at] == pairs) if len(names) else np.empty(0, np.int64)
        return some, at[some]

    def triple_keys(self, pairs: np.ndarray, shard: np.ndarray, place: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shards and keys of triples, whose first two words are known as pairs of these keys and places."""
        shard, place = shard.copy(), place.copy()
        some, at = self._heavy(pairs)
        if len(some):
            parts = np.array([self.heavy[k] for k in sorted(self.heavy)], np.uint64)[at]
            shard[some] = (shard[some] + (mixed(third[some].astype(np.uint64) * _SALT) % parts).astype(np.int64)) % self.shards
            place[some] = HEAVY + at
        return shard, _key(place, third)

    def triple_counts(self, shard: np.ndarray, keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        groups = [(k, order[some]) for k, some in _groups(shard[order], self.shards)]
        return self._at_places(self.triples, groups, self._places(self.triples, keys, groups))[:, 0]

    def words_behind(self, pairs: np.ndarray, groups: Groups, place: np.ndarray) -> np.ndarray:
        """Different words behind pairs once, twice, more often."""
        out = self._at_places(self.behind, groups, place, 3)
        some, at = self._heavy(pairs)
        for i, k in zip(some.tolist(), at.tolist(), strict=True):
            out[i] = self.heavy_behind.get(k, [0] * 3)
        return out

    def _by_word(self, number: np.ndarray, files: dict[int, str], kind: str, width: int) -> np.ndarray:
        """Rows of per-word arrays; zeros for unknown words and the begin."""
        out = np.zeros((len(number), width), np.int64)
        real = (number >= 0) & (number < self.types)
        shard = np.where(real, np.searchsorted(self.begins[1:], number, "right"), -1)
        for k in np.unique(shard[real]).tolist():
            if k in files:
                some = np.flatnonzero(shard == k)
                out[some] = mapped(files[k], kind).reshape(-1, width)[number[some] - self.begins[k]]
        return out

    def following(self, number: np.ndarray) -> np.ndarray:
        """Tokens behind each word, and words behind it once, twice, more often."""
        out = self._by_word(number, self.follow, "<i8", 4)
        if self.spread_follow:
            names = np.array(sorted(self.spread_follow))
            at = np.minimum(np.searchsorted(names, number), len(names) - 1)
            some = np.flatnonzero(names[at] == number)
            out[some] = np.array([self.spread_follow[k] for k in names.tolist()])[at[some]]
        return out

    def word_probability(self, number: np.ndarray) -> np.ndarray:
        """Probability of words by the different words ahead of them, mixed with the uniform one."""
        ahead = self._by_word(number, self.ahead, "<i8", 1)[:, 0]
        return _kept(ahead, self.word_discounts) / max(self.pair_types, 1) + self.word_rest / (self.types + 1)


def _range(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)


def _kept(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *discounts])[np.minimum(counts, 3)]


def _left(kinds: np.ndarray, discounts: tuple[float, float, float], total: np.ndarray) -> np.ndarray:
    """The share that discounts leave, by the numbers of keys that occur once, twice and more often."""
    return (kinds[:, 0] * discounts[0] + kinds[:, 1] * discounts[1] + kinds[:, 2] * discounts[2]) / np.maximum(total, 1)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of keys that occur 1, 2, 3 and 4 times.

    Where these leave one undefined or not positive (small or odd data), it is ``UNDECIDED``, so every word keeps a chance.
    """
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0 for k in (1, 2, 3)]
    return tuple(d if d > 0 else UNDECIDED for d in found)


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, end included, and the tokens of each text; NULL is empty."""
    buffer, edges = joined_texts(column, LOWERED)
    starts, sizes = word_spans(buffer, edges)
    counts = np.diff(np.searchsorted(starts, edges)) + 1
    last = np.cumsum(counts) - 1
    inside = np.ones(int(counts.sum()), bool)
    inside[last] = False
    out = np.empty(len(inside), np.uint64)
    out[inside], out[last] = span_hashes(buffer, starts, sizes), END
    return out, counts


class Vocabulary:
    """What the model knows of words, the words met last at hand: a word's place is its hash's first bits, where it replaces another."""

    BITS = 18

    def __init__(self, model: Model, scores: bool = False) -> None:
        self.model, self.scores = model, scores
        # no hash stands at the place of its complement
        self.hashes = ~(np.arange(1 << self.BITS, dtype=np.uint64) << np.uint64(64 - self.BITS))
        self.rows = [np.empty(len(self.hashes), x.dtype) for x in self._known(np.empty(0, np.uint64))]

    def _known(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Numbers of ascending hashes; to score also base scores, chances, and tokens and rest behind (``behind``)."""
        model = self.model
        number, count = model.numbers(hashes)
        if not self.scores:
            return [number]
        base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
        return [number, base, model.word_probability(number), *self.behind(number)]

    def behind(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens behind each word, and the share of their probability left to the words' own one."""
        found = self.model.following(number)
        return found[:, 0], _left(found[:, 1:], self.model.pair_discounts, found[:, 0])

    def look_up(self, hashes: np.ndarray) -> list[np.ndarray]:
        """``_known`` of each token."""
        place = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        missed = np.flatnonzero(self.hashes[place] != hashes)
        out = [x[place] for x in self.rows]
        fresh, at = np.unique(hashes[missed], return_inverse=True)
        new = (fresh >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.hashes[new] = fresh
        for own, found, rows in zip(out, self._known(fresh), self.rows, strict=True):
            own[missed] = found[at]
            rows[new] = found
        return out


def _counting(column: str, read: Callable, bucket_of: Callable) -> Callable:
    """Batches of texts to packed counts of ``read()(texts)``, sent on by ``bucket_of(keys)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of, held, size = read(), [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(keys_of(batch.column(column)))
                size += len(held[-1])
            if size >= HELD:
                keys, counts = np.unique(np.concatenate(held), return_counts=True)
                yield from _send(bucket_of(keys), keys, counts)
                held, size = [], 0
        if held:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            yield from _send(bucket_of(keys), keys, counts)

    return run


def fit(docs: DataFrame, text: str = "text", training: Column | None = None, order: int = 2) -> Model:
    """Count ``docs``, or those that meet ``training``, into shards in the shared folder. ``order``: 2 or 3 words."""
    if order not in (2, 3):
        raise ValueError(f"order {order} is not built")
    spark = docs.sparkSession
    taught = (docs if training is None else docs.filter(training)).select(F.col(text).alias("text"))
    size = taught.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    folder, shards = new_folder(spark, "ngram-model"), max(partitions(spark), -(-size // SHARD_BYTES))
    model = Model(shards)
    _count_words(taught, model, folder)
    _count_pairs(taught, model, folder)
    if order == 3:
        _count_triples(taught, model, folder)
        _adjust_pairs(taught, model, folder)
    model.order = order
    return model


def _dealt(parts: DataFrame, shards: int) -> DataFrame:
    return parts.repartition(shards, "bucket").sortWithinPartitions("bucket")


def _write_counts(folder: str, counts: np.ndarray) -> tuple[str, str]:
    """Counts up to 255, and the places and counts of the larger ones."""
    large = np.flatnonzero(counts >= 255)
    return _write(folder, np.minimum(counts, 255).astype("u1")), _write(folder, np.stack((large, counts[large]), axis=1).astype("<i8"))


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _shares(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each name once, and its keys' total count and numbers of counts of 1, 2 and more."""
    name, at = np.unique(names, return_inverse=True)
    return name, np.stack([np.bincount(at, weights=w, minlength=len(name)).astype(np.int64) for w in (counts, counts == 1, counts == 2, counts > 2)], axis=1)


def _follow(model: Model, bucket: int, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What follows the words of a shard, and the rows of words that other shards hold a part of."""
    begin = model.begins[bucket]
    width = model.begins[bucket + 1] - begin
    name, rows = _shares(first, counts)
    follow = np.zeros((width, 4), "<i8")
    inside = (name >= begin) & (name < begin + width)
    follow[name[inside] - begin] = rows[inside]
    moved = np.array([int(n) in model.spread or n == model.types for n in name.tolist()], bool)
    return follow, name[moved], rows[moved]


def _add_rows(into: dict[int, list[int]], names: list[int], rows: list[int]) -> None:
    width = len(rows) // max(1, len(names))
    for k, name in enumerate(names):
        row = rows[width * k : width * (k + 1)]
        into[name] = [a + b for a, b in zip(into.get(name, [0] * width), row, strict=True)]


def _count_words(taught: DataFrame, model: Model, folder: str) -> None:
    shards = model.shards

    def store(bucket: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        top = np.argsort(-counts, kind="stable")[:FREQUENT]
        ends = counts[np.searchsorted(keys, END) : np.searchsorted(keys, END, "right")].sum()
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([bucket], pa.int32()), "keys": [_write(folder, keys.astype("<u8"))], "counts": [_write(folder, counts.astype("<i8"))],
                "types": [len(keys)], "tokens": [int(counts.sum())], "ends": [int(ends)], "places": pa.array([top.tolist()], _LONGS), "top": pa.array([counts[top].tolist()], _LONGS),
            }
        )

    def read() -> Callable:
        return lambda column: token_hashes(column)[0]

    sent = taught.mapInArrow(tidied(_counting("text", read, lambda keys: _range(keys, shards))), "bucket int, part binary")
    kind = "bucket int, keys string, counts string, types long, tokens long, ends long, places array<long>, top array<long>"
    rows = materialize(_dealt(sent, shards).mapInArrow(lambda batches: _gather(batches, store), kind), "ngram-words").collect()  # a row per shard
    by_shard = {r.bucket: r for r in rows}
    for k in range(shards):
        model.begins.append(model.begins[-1] + (by_shard[k].types if k in by_shard else 0))
    if model.types >= (1 << 32) - 1:
        raise OverflowError("more different words than 32 bits can number")
    for k, r in by_shard.items():
        model.words[k] = r["keys"], r["counts"]
        model.tokens += r.tokens
        model.texts += r.ends
    share = max(1, model.tokens // shards)
    heads = {model.begins[k] + place: n for k, r in by_shard.items() for place, n in zip(r.places, r.top, strict=True)} | {model.types: model.texts}
    model.spread = {name: min(shards, -(-n // share)) for name, n in heads.items() if n > share}


def _count_pairs(taught: DataFrame, model: Model, folder: str) -> None:
    shards = model.shards
    shared = taught.sparkSession.sparkContext.broadcast(model)  # file names, a few for each shard

    def read() -> Callable:
        own, words = shared.value, Vocabulary(shared.value)

        def keys_of(column: pa.Array) -> np.ndarray:
            hashes, counts = token_hashes(column)
            (number,) = words.look_up(hashes)
            return _key(_moved(number, counts, own.types), number)

        return keys_of

    def store(bucket: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = shared.value
        first, second = _split(keys)
        follow, names, rows = _follow(own, bucket, first, counts)
        small, large = _write_counts(folder, counts)
        heavy = np.flatnonzero(counts > max(1, own.tokens // shards))
        ahead, types = np.unique(second, return_counts=True)
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([bucket], pa.int32()), "keys": [_write(folder, keys.astype("<u8"))], "small": [small], "large": [large], "follow": [_write(folder, follow)],
                "names": pa.array([names.tolist()], _LONGS), "rows": pa.array([rows.ravel().tolist()], _LONGS), "n": [[int((counts == k).sum()) for k in (1, 2, 3, 4)]], "types": [len(keys)],
                "ahead": pa.array([squeeze(ahead.astype(np.uint64), types)], pa.binary()),
                "heavy": pa.array([keys[heavy].view(np.int64).tolist()], _LONGS), "filled": pa.array([counts[heavy].tolist()], _LONGS),
            }
        )

    sent = taught.mapInArrow(tidied(_counting("text", read, lambda keys: shared.value.shard_of(*_split(keys)))), "bucket int, part binary")
    kind = "bucket int, keys string, small string, large string, follow string, names array<long>, rows array<long>, n array<long>, types long, ahead binary, heavy array<long>, filled array<long>"
    made = materialize(_dealt(sent, shards).mapInArrow(lambda batches: _gather(batches, store), kind), "ngram-pairs")
    n = np.zeros(4, np.int64)
    for r in made.drop("ahead").collect():  # a row per shard, with the spread words that it holds a part of
        model.pairs[r.bucket] = r["keys"], r.small, r.large
        model.follow[r.bucket] = r.follow
        n += r.n
        model.pair_types += r.types
        if r.types >= HEAVY:
            raise OverflowError("more pairs in a shard than 31 bits can number: make SHARD_BYTES smaller")
        _add_rows(model.spread_follow, r.names, r["rows"])
        share = max(1, model.tokens // shards)
        model.heavy |= {k % (1 << 64): min(shards, -(-c // share)) for k, c in zip(r.heavy, r.filled, strict=True)}
    model.pair_discounts = discounts(n.tolist())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = np.array(shared.value.begins)
        for batch in batches:
            for part in batch.column("ahead").to_pylist():
                keys, counts = unsqueeze(part)
                yield from _send(np.searchsorted(begins[1:], keys.astype(np.int64), "right"), keys, counts)

    def keep(bucket: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        begins = shared.value.begins
        ahead = np.zeros(begins[bucket + 1] - begins[bucket], "<i8")
        ahead[keys.astype(np.int64) - begins[bucket]] = counts
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array([bucket], pa.int32()), "ahead": [_write(folder, ahead)], "n": [[int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int((counts > 2).sum())]]}
        )

    sent = made.select("ahead").mapInArrow(deal, "bucket int, part binary")
    kind = "bucket int, ahead string, n array<long>"
    n = np.zeros(5, np.int64)
    for r in materialize(_dealt(sent, shards).mapInArrow(lambda batches: _gather(batches, keep), kind), "ngram-ahead").collect():  # a row per shard
        model.ahead[r.bucket] = r.ahead
        n += r.n
    model.word_discounts = discounts(n[:4].tolist())
    if model.pair_types:
        model.word_rest = float(np.dot(model.word_discounts, [n[0], n[1], n[4]])) / model.pair_types


@dataclass
class Pairs:
    """The different pairs of known words in a batch, and which of them each token ends (-1: none)."""

    keys: np.ndarray
    shard: np.ndarray
    place: np.ndarray  # -1: not counted
    groups: Groups
    of: np.ndarray


def _pairs(model: Model, number: np.ndarray, first: np.ndarray) -> Pairs:
    both = np.flatnonzero((first >= 0) & (number >= 0))
    keys, at = np.unique(_key(first[both], number[both]), return_inverse=True)
    shard = model.shard_of(*_split(keys))
    groups, of = _groups(shard, model.shards), np.full(len(number), -1, np.int64)
    of[both] = at
    return Pairs(keys, shard, model._places(model.pairs, keys, groups), groups, of)


def _moved(values: np.ndarray, counts: np.ndarray, none: int) -> np.ndarray:
    """The value of the token ahead in the same text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[lengths_to_starts(counts)[:-1]] = none
    return out


def _count_triples(taught: DataFrame, model: Model, folder: str) -> None:
    shards = model.shards
    shared = taught.sparkSession.sparkContext.broadcast(model)

    def found(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        own, number, counts = shared.value, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        pairs = _pairs(own, number, _moved(number, counts, own.types))
        ahead = _moved(pairs.of, counts, -1)
        some = np.flatnonzero(ahead >= 0)
        ahead = ahead[some]
        if (pairs.place[ahead] < 0).any():
            raise RuntimeError("a pair of the training texts was not counted")
        return own.triple_keys(pairs.keys[ahead], pairs.shard[ahead], pairs.place[ahead], number[some])

    def combined(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        bucket, keys = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        order = np.argsort(keys)
        order = np.concatenate([order[some] for _, some in _groups(bucket[order], shards)]) if len(order) else order
        bucket, keys = bucket[order], keys[order]
        fresh = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])))) if len(keys) else np.empty(0, np.int64)
        yield from _send(bucket[fresh], keys[fresh], np.diff(fresh, append=len(keys)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, read, held, some, size = Vocabulary(shared.value), [], [], 0, 0
        for batch in batches:
            if batch.num_rows:
                hashes, counts = token_hashes(batch.column("text"))
                read.append((*words.look_up(hashes), counts))
                some += len(hashes)
            if some >= HELD // 4:  # looked up together
                held.append(found(read))
                size, some, read = size + some, 0, []
            if size >= HELD:
                yield from combined(held)
                held, size = [], 0
        if read:
            held.append(found(read))
        if held:
            yield from combined(held)

    def store(bucket: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = shared.value
        name, rows = _shares(_split(keys)[0], counts)
        inside = name < HEAVY
        behind = np.zeros((len(mapped(own.pairs[bucket][0], "<u8")) if bucket in own.pairs else 0, 3), np.int64)
        behind[name[inside]] = rows[inside, 1:]
        small, large = _write_counts(folder, counts)
        few, many = _write_counts(folder, behind.ravel())
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([bucket], pa.int32()), "keys": [_write(folder, keys.astype("<u8"))], "small": [small], "large": [large], "few": [few], "many": [many],
                "names": pa.array([(name[~inside] - HEAVY).tolist()], _LONGS), "rows": pa.array([rows[~inside, 1:].ravel().tolist()], _LONGS), "n": [[int((counts == k).sum()) for k in (1, 2, 3, 4)]],
            }
        )

    sent = taught.mapInArrow(tidied(count), "bucket int, part binary")
    kind = "bucket int, keys string, small string, large string, few string, many string, names array<long>, rows array<long>, n array<long>"
    n = np.zeros(4, np.int64)
    for r in materialize(_dealt(sent, shards).mapInArrow(lambda batches: _gather(batches, store), kind), "ngram-triples").collect():  # a row per shard
        model.triples[r.bucket] = r["keys"], r.small, r.large
        model.behind[r.bucket] = r.few, r.many
        _add_rows(model.heavy_behind, r.names, r["rows"])
        n += r.n
    model.triple_discounts = discounts(n.tolist())


def _adjust_pairs(taught: DataFrame, model: Model, folder: str) -> None:
    """Count pairs by the different words ahead of them, those after a begin by their tokens."""
    spark, shards = taught.sparkSession, model.shards
    shared = spark.sparkContext.broadcast(model)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        heavy = np.array(sorted(own.heavy), np.uint64)
        for bucket in (b for batch in batches for b in batch.column("id").to_pylist()):
            pairs = mapped(own.pairs[bucket][0], "<u8") if bucket in own.pairs else np.empty(0, np.uint64)
            begun = np.arange(*np.searchsorted(pairs, _key(np.array([own.types, own.types + 1]), np.zeros(2, np.int64))))
            if len(begun):
                counts = own._at_places(own.pairs, [(bucket, np.arange(len(begun)))], begun)[:, 0]
                yield from _send(np.full(len(begun), bucket), pairs[begun], counts)
            triples = mapped(own.triples[bucket][0], "<u8") if bucket in own.triples else np.empty(0, np.uint64)
            for a in range(0, len(triples), HELD):
                place, third = _split(np.asarray(triples[a : a + HELD]))
                spread = place >= HEAVY
                ahead = np.empty(len(place), np.uint64)
                ahead[~spread] = pairs[place[~spread]]
                ahead[spread] = heavy[place[spread] - HEAVY]
                keys, counts = np.unique(_key(_split(ahead)[1], third), return_counts=True)
                yield from _send(own.shard_of(*_split(keys)), keys, counts)

    def keep(bucket: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if not np.array_equal(keys, mapped(own.pairs[bucket][0], "<u8")):
            raise RuntimeError("pairs and triples differ")
        follow, names, rows = _follow(own, bucket, _split(keys)[0], counts)
        small, large = _write_counts(folder, counts)
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([bucket], pa.int32()), "small": [small], "large": [large], "follow": [_write(folder, follow)],
                "names": pa.array([names.tolist()], _LONGS), "rows": pa.array([rows.ravel().tolist()], _LONGS), "n": [[int((counts == k).sum()) for k in (1, 2, 3, 4)]],
            }
        )

    sent = spark.range(0, shards, 1, shards).mapInArrow(deal, "bucket int, part binary")
    kind = "bucket int, small string, large string, follow string, names array<long>, rows array<long>, n array<long>"
    rows = materialize(_dealt(sent, shards).mapInArrow(lambda batches: _gather(batches, keep), kind), "ngram-adjusted").collect()  # a row per shard
    model.follow, model.spread_follow = {r.bucket: r.follow for r in rows}, {}
    n = np.zeros(4, np.int64)
    for r in rows:
        model.adjusted[r.bucket] = r.small, r.large
        _add_rows(model.spread_follow, r.names, r["rows"])
        n += r.n
    model.pair_discounts = discounts(n.tolist())


# scores


def _by_triples(model: Model, number: np.ndarray, counts: np.ndarray, pairs: Pairs, lower: np.ndarray) -> np.ndarray:
    """Probabilities of tokens by the two words ahead, mixed with those by one."""
    total = np.maximum(model._at_places(model.pairs, pairs.groups, pairs.place)[:, 0], 1)  # a token follows each
    rest = _left(model.words_behind(pairs.keys, pairs.groups, pairs.place), model.triple_discounts, total)
    ahead = _moved(pairs.of, counts, -1)
    some = np.flatnonzero(ahead >= 0)
    some = some[pairs.place[ahead[some]] >= 0]
    ahead = ahead[some]
    known = np.flatnonzero(number[some] >= 0)
    triples, own = np.zeros(len(some), np.int64), ahead[known]
    triples[known] = model.triple_counts(*model.triple_keys(pairs.keys[own], pairs.shard[own], pairs.place[own], number[some[known]]))
    out = lower.copy()
    out[some] = _kept(triples, model.triple_discounts) / total[ahead] + rest[ahead] * lower[some]
    return out


def _scores(model: Model, hashes: np.ndarray, counts: np.ndarray, words: Vocabulary) -> dict[str, np.ndarray]:
    number, base, chance, total, rest = words.look_up(hashes)
    begin_total, begin_rest = (x[0] for x in words.behind(np.array([model.types])))
    total, rest = _moved(total, counts, begin_total), _moved(rest, counts, begin_rest)
    pairs = _pairs(model, number, _moved(number, counts, model.types))
    found = model._at_places(model.adjusted if model.order == 3 else model.pairs, pairs.groups, pairs.place)[:, 0]
    kept = np.append(_kept(found, model.pair_discounts), 0.0)[pairs.of]  # the last one where there is no pair
    chance = np.where(total > 0, kept / np.maximum(total, 1) + rest * chance, chance)
    if model.order == 3:
        chance = _by_triples(model, number, counts, pairs, chance)
    begins = lengths_to_starts(counts)[:-1]
    return {
        "n_tokens": counts,
        "n_known": np.add.reduceat((number >= 0).astype(np.int64), begins),
        "base_score": np.add.reduceat(base, begins),
        "score": np.add.reduceat(np.log10(chance), begins),
    }


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "lm") -> DataFrame:
    """``docs`` with a struct ``out``: tokens, known tokens, and log10 probabilities by the unigram base and by the model."""
    kept = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, some = Vocabulary(shared.value, scores=True), [], 0

        def scored() -> Iterator[pa.RecordBatch]:
            made = _scores(shared.value, *(np.concatenate([h[k] for h in held]) for k in (1, 2)), words)
            at = 0
            for batch, _, counts in held:
                own = [pa.array(x[at : at + len(counts)]) for x in made.values()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(own, names=list(made))], names=[*batch.schema.names, out])
                at += len(counts)

        for batch in batches:
            if batch.num_rows:
                held.append((batch, *token_hashes(batch.column(text))))
                some += len(held[-1][1])
            if some >= HELD // 4:  # looked up together
                yield from scored()
                held, some = [], 0
        if held:
            yield from scored()

    return kept.mapInArrow(tidied(run), T.StructType([*kept.schema.fields, T.StructField(out, T.StructType.fromDDL(SCORE))]))


def perplexity(score: Column) -> Column:
    """Perplexity by token of a scored text."""
    return F.pow(F.lit(10.0), -score["score"] / score["n_tokens"])
