"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with temperature.

* Every word has a sparse random index vector (a few +1 and -1, given by its hash). A word's vector is the sum of the
  index vectors of the words around it, over all documents. Words are hashed to ``slots`` rows, so the vectors have a fixed
  size (``slots`` x ``size``); all tasks add up their own table and partial tables are summed in two steps.
* A document is the mean and the spread of its words' vectors. Words in capitals, repeated words and runs of punctuation
  are words of their own.
* A two-layer network learns from a bounded sample of labelled documents (``labelled.SAMPLE``); a part held back from it
  sets the temperature of the probabilities.

Defined results: NULL and empty texts have zero vectors and get the network's score for those; documents without a label
are scored like all others; repeated rows get equal scores; without any label of both kinds every score is the share of
label 1 (0.5 without labels); an empty table gives no rows; further columns of the documents are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm import labelled
from deadhead.llm.common import lengths_to_starts, partitions, texts, tidied

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
REMEMBERED = 200_000
#: Rows of the vector table that travel together.
ROWS = 1024
SALTS = 16


@dataclass(frozen=True)
class Settings:
    slots: int = 1 << 15
    size: int = 48
    entries: int = 4  # non-zero entries of an index vector
    reach: int = 2  # words of context on each side
    hidden: int = 32
    seed: int = 7


class Slots(dict):
    """Word -> row of the vector table; row 0 stands for words in capitals, row 1 for a word said again."""

    def __init__(self, slots: int) -> None:
        self.slots = slots

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        text = word.decode("utf-8", "replace")
        capitals = len(text) > 1 and text.isupper()
        self[word] = found = 0 if capitals else 2 + xxhash.xxh3_64_intdigest(text.lower().encode()) % (self.slots - 2)
        return found


def token_rows(raw: list[bytes], slots: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all words of some texts, and the number of words of each."""
    words = [_TOKEN.findall(t) for t in raw]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    rows = np.fromiter((slots[w] for ws in words for w in ws), np.int64, int(counts.sum()))
    again = np.zeros(len(rows), bool)
    again[1:] = rows[1:] == rows[:-1]
    firsts = lengths_to_starts(counts)[:-1][counts > 0]
    again[firsts] = False
    rows[again] = 1
    return rows, counts


def index_vectors(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of every row's index vector."""
    random = np.random.default_rng(s.seed)
    return random.integers(0, s.size, (s.slots, s.entries)), random.choice([-1.0, 1.0], (s.slots, s.entries))


def _add_contexts(rows: np.ndarray, counts: np.ndarray, total: np.ndarray, s: Settings, places: np.ndarray, signs: np.ndarray) -> None:
    owner = np.repeat(np.arange(len(counts)), counts)
    for step in range(1, s.reach + 1):
        same = owner[step:] == owner[:-step]
        left, right = rows[:-step][same], rows[step:][same]
        for word, near in ((left, right), (right, left)):
            for e in range(s.entries):
                total += np.bincount(word * s.size + places[near, e], weights=signs[near, e], minlength=len(total))


def word_vectors(docs: DataFrame, text: str, s: Settings) -> np.ndarray:
    """The table of word vectors over all documents, rows of unit length."""
    places, signs = index_vectors(s)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slots = np.zeros(s.slots * s.size), Slots(s.slots)
        for batch in batches:
            if batch.num_rows:
                rows, counts = token_rows(texts(batch.column(0)), slots)
                _add_contexts(rows, counts, total, s, places, signs)
        yield from _pieces(total, TaskContext.get().partitionId() % SALTS)

    def _pieces(total: np.ndarray, salt: int) -> Iterator[pa.RecordBatch]:
        for k, part in enumerate(np.split(total.astype("<i8"), range(ROWS * s.size, len(total), ROWS * s.size))):
            if part.any():
                yield _piece(k, salt, part)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                part = np.frombuffer(zstandard.decompress(r["part"]), "<i8")
                key = r["piece"], r["salt"]
                sums[key] = sums[key] + part if key in sums else part
        for (piece, salt), part in sums.items():
            yield _piece(piece, salt, part)

    kind = "piece int, salt int, part binary"
    n = min(partitions(docs.sparkSession), -(-s.slots // ROWS))
    partial = docs.select(text).mapInArrow(tidied(count), kind).repartition(n, "piece", "salt").mapInArrow(tidied(add), kind)
    whole = partial.withColumn("salt", F.lit(0)).repartition(n, "piece").mapInArrow(tidied(add), kind)
    table = np.zeros(s.slots * s.size)
    for r in whole.collect():  # slots x size numbers, whatever the data
        part = np.frombuffer(zstandard.decompress(r.part), "<i8")
        table[r.piece * ROWS * s.size : r.piece * ROWS * s.size + len(part)] = part
    table = table.reshape(s.slots, s.size)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _piece(piece: int, salt: int, part: np.ndarray) -> pa.RecordBatch:
    data = zstandard.compress(part.tobytes(), 1)
    return pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "salt": pa.array([salt], pa.int32()), "part": pa.array([data], pa.binary())})


def pooled(raw: list[bytes], slots: Slots, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors of each text."""
    rows, counts = token_rows(raw, slots)
    size = vectors.shape[1]
    out = np.zeros((len(raw), 2 * size), np.float32)
    for i, (a, b) in enumerate(zip(lengths_to_starts(counts)[:-1], np.cumsum(counts), strict=True)):
        if b > a:
            own, times = np.unique(rows[a:b], return_counts=True)
            share = (times / (b - a)).astype(np.float32)
            found = vectors[own]
            mean = share @ found
            out[i, :size], out[i, size:] = mean, np.sqrt(np.maximum(share @ (found * found) - mean * mean, 0))
    return out


class Network:
    """Two layers in numpy: standardised inputs, a hidden layer of tanh, one output, divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int, seed: int, steps: int = 400) -> None:
        random = np.random.default_rng(seed)
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            self.constant = 0.5 if len(y) == 0 else float(y.mean())
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        order = random.permutation(len(y))
        held, own = (order[: len(y) // 5], order[len(y) // 5 :]) if len(y) >= 50 else (order, order)
        x = self._scaled(x)
        self.weights = [
            random.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, hidden**-0.5, hidden), np.zeros(1),
        ]
        self.temperature = 1.0
        self._learn(x[own], y[own].astype(float), random, steps)
        self.temperature = self._calibrated(x[held], y[held].astype(float))

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(x @ a + b) @ c + d[0]

    def _learn(self, x: np.ndarray, y: np.ndarray, random: np.random.Generator, steps: int, rate: float = 0.01, decay: float = 1e-3) -> None:
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        for step in range(1, steps + 1):
            some = random.integers(0, len(y), min(len(y), 1024))
            a, b, c, d = self.weights
            h = np.tanh(x[some] @ a + b)
            error = (_sigmoid(h @ c + d[0]) - y[some]) / len(some)
            back = np.outer(error, c) * (1 - h * h)
            slopes = [x[some].T @ back + decay * a, back.sum(0), h.T @ error + decay * c, np.array([error.sum()])]
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.weights[k] = self.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def _calibrated(self, x: np.ndarray, y: np.ndarray) -> float:
        z = self._logit(x)
        loss = lambda t: np.mean(np.logaddexp(0, z / t) - y * z / t)
        return float(min(np.geomspace(0.25, 8, 61), key=loss))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self._logit(self._scaled(x)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    settings: Settings
    vectors: np.ndarray
    network: Network


def fit(
    docs: DataFrame, labels: DataFrame, training: Column, text: str = "text", doc_id: str = "doc_id", label: str = "quality", settings: Settings | None = None, rows: int = labelled.SAMPLE
) -> Model:
    """Word vectors from all of ``docs``; the network from about ``rows`` labelled ones. ``training``: a condition on ``id``."""
    s = settings or Settings()
    vectors = word_vectors(docs, text, s)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    own, known = labelled.sample(docs, labels, doc_id, text, label, training, rows)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots(s.slots)
        for batch in batches:
            if batch.num_rows:
                x = pooled(texts(batch.column("text")), slots, shared.value)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([v.tobytes() for v in x], pa.binary())], names=["id", "vector"])

    pools = own.mapInArrow(tidied(pool), T.StructType([own.schema["id"], T.StructField("vector", T.BinaryType())]))
    found = pools.join(known, "id").select("vector", "label").orderBy(F.xxhash64("vector"), "label").collect()  # a bounded sample
    x = np.array([np.frombuffer(r.vector, np.float32) for r in found], float).reshape(len(found), 2 * s.size)
    return Model(s, vectors, Network(x, np.array([r.label for r in found]), s.hidden, s.seed))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability of label 1."""
    kept = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        slots = Slots(own.settings.slots)
        for batch in batches:
            if batch.num_rows:
                found = own.network.score(pooled(texts(batch.column(text)), slots, own.vectors).astype(float))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, out])

    return kept.mapInArrow(tidied(run), T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))
