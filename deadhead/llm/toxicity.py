"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is logistic in its distinct words and their beginnings (hashed to ``slots`` weights; beginnings
carry over to other forms of a word). A document's is the noisy-or of
its sentences: 1 - prod(1 - p). Weights are learned from document labels through that combination, on a bounded sample of
labelled documents (``labelled.SAMPLE``). The sentence scores then locate the offending sentences. Sentences end at ``.``, ``!``, ``?`` and line ends; words are digits, letters
a-z (A-Z lower-cased) and non-ASCII characters.

Defined results: NULL and empty texts have no sentence and score 0; repeated rows get equal scores; without labels of both
kinds all weights are 0 and every sentence has the base probability; an empty table gives no rows; further columns of the
documents are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deadhead.llm import labelled
from deadhead.llm.common import lengths_to_starts, materialize, texts

#: Sentence ends become full stops, other separators spaces.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 46 if b in b".!?\n\r" else 32 for b in range(256)
)
_END = re.compile(r"[.!?\n\r]")
REMEMBERED = 200_000
SENTENCES = "array<struct<sentence:int,text:string,score:double>>"


#: Characters of the beginnings that are features beside the whole word.
BEGINNINGS = (4, 5)
#: Bits of one weight's number.
BITS = 20


class Slots(dict):
    """Word -> the numbers of its weights, ``BITS`` each; the sentence end is -1."""

    def __init__(self, slots: int) -> None:
        self.slots = slots
        self[b"."] = -1

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
            self[b"."] = -1
        text, found = word.decode("utf-8", "replace"), xxhash.xxh3_64_intdigest(word) % self.slots
        for k, size in enumerate(BEGINNINGS, 1):
            own = b"^" + text[:size].encode() if len(text) > size else word
            found |= xxhash.xxh3_64_intdigest(own) % self.slots << BITS * k
        self[word] = found
        return found


def sentence_words(raw: list[bytes], slots: Slots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sentence, weight) pairs of some texts, sentences numbered through, and the first sentence of each text."""
    words = [t.translate(_TABLE).replace(b".", b" . ").split() for t in raw]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    ids = np.fromiter((slots[w] for ws in words for w in ws), np.int64, int(counts.sum()))
    owner = np.repeat(np.arange(len(raw)), counts)
    ends = ids < 0
    # every text begins a sentence of its own
    sentence = np.cumsum(ends) - ends + owner
    firsts = np.concatenate(([0], np.cumsum(np.bincount(owner[ends], minlength=len(raw)) + 1)))
    place, packed = sentence[~ends] * slots.slots, ids[~ends]
    one = (1 << BITS) - 1
    pairs = np.unique(np.concatenate([place + (packed >> BITS * k & one) for k in range(len(BEGINNINGS) + 1)]))
    return pairs // slots.slots, pairs % slots.slots, firsts


def noisy_or(logits: np.ndarray, firsts: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """log(1 - P) per document from sentence logits; empty sentences say nothing."""
    safe = np.where(filled, -np.logaddexp(0, logits), 0.0)
    sums = lengths_to_starts(safe)
    return sums[firsts[1:]] - sums[firsts[:-1]]


@dataclass
class Model:
    weights: np.ndarray
    base: float

    def sentences(self, raw: list[bytes], slots: Slots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each sentence, the first sentence of each text, and the texts' scores."""
        sentence, word, firsts = sentence_words(raw, slots)
        n = int(firsts[-1])
        logits = np.bincount(sentence, weights=self.weights[word], minlength=n) + self.base
        filled = np.bincount(sentence, minlength=n) > 0
        scores = np.where(filled, 1 / (1 + np.exp(-np.clip(logits, -40, 40))), 0.0)
        return scores, firsts, -np.expm1(noisy_or(logits, firsts, filled))


def informative(ones: np.ndarray, every: np.ndarray, share: float, least: float = 20.0) -> np.ndarray:
    """Weights that documents of label 1 have more often than the others, by a log-likelihood ratio of ``least``.

    ``ones`` and ``every`` count the documents of label 1 and all documents with the weight's words. Chance alone passes
    the ratio in about one of 1e5 cases.
    """
    return (_ratio(ones, every, share) >= least) & (ones > every * share)


def learn(
    sentence: np.ndarray, word: np.ndarray, firsts: np.ndarray, y: np.ndarray, model: Model, odds: np.ndarray, steps: int = 80, rate: float = 0.05
) -> Model:
    """Gradient steps on the documents' log-likelihood under the noisy-or, from the words' log odds.

    Weights stay positive, so that no word excuses another.
    """
    n, b = int(firsts[-1]), model.base
    document = np.repeat(np.arange(len(y)), np.diff(firsts))
    names, own = np.unique(word, return_inverse=True)
    w = odds[names]
    filled = np.ones(n, bool)
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        logits = np.bincount(sentence, weights=w[own], minlength=n) + b
        p = 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
        none = np.exp(noisy_or(logits, firsts, filled))
        # d log-likelihood / d logit: -p for label 0, p * (1 - P) / P for label 1
        slope = p * np.where(y == 1, none / np.maximum(1 - none, 1e-9), -1.0)[document]
        g = np.append(np.bincount(own, weights=slope[sentence], minlength=len(names)), slope.sum()) / len(y)
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        w, b = np.maximum(w + move[:-1], 0), b + move[-1]
    model.weights[names], model.base = w, float(b)
    return model


def _ratio(ones: np.ndarray, every: np.ndarray, share: float) -> np.ndarray:
    """Log-likelihood ratio of each word's share of label 1 against the share of all."""
    rest, total = every - ones, np.maximum(every, 1)
    return 2 * (ones * np.log(np.maximum(ones, 1e-9) / (total * share)) + rest * np.log(np.maximum(rest, 1e-9) / (total * (1 - share))))


def fit(
    docs: DataFrame, labels: DataFrame, training: Column, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", slots: int = 1 << 18, rows: int = labelled.SAMPLE
) -> Model:
    """Weights from about ``rows`` labelled documents. ``training``: a condition on ``id``."""
    own, known = labelled.sample(docs, labels, doc_id, text, label, training, rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Slots(slots)
        for batch in batches:
            made, counts = [], []
            for t in texts(batch.column("text")):
                sentence, word, firsts = sentence_words([t], table)
                made.append(np.concatenate((sentence, word)).astype("<i4").tobytes())
                counts.append(int(firsts[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(made, pa.binary())], names=["id", "sentences", "pairs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, every = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        for batch in batches:
            for pairs, y in zip(batch.column("pairs").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words = np.unique(_halves(pairs)[1])
                every[words] += 1
                ones[words] += y == 1
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(some), "ones": pa.array(ones[some]), "n": pa.array(every[some])})

    pairs = own.mapInArrow(read, T.StructType([own.schema["id"], *T.StructType.fromDDL("sentences long, pairs binary")]))
    taught = materialize(pairs.join(known, "id").select("sentences", "pairs", "label"), "toxicity-sample")
    n, positive, sentences = taught.agg(F.count("*"), F.sum((F.col("label") == 1).cast("int")), F.sum("sentences")).first()
    model = Model(np.zeros(slots), -4.0 - float(np.log(max(1.0, (sentences or 0) / max(n, 1)))))
    if not positive or positive == n:
        return model
    share = positive / n
    found = taught.mapInArrow(count, "slot long, ones long, n long").groupBy("slot").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    stats = found.filter((F.col("ones") > 1) & (F.col("ones") > F.col("n") * share)).toArrow()  # at most slots rows
    slot, ones, every = (stats.column(c).to_numpy().astype(np.int64) for c in ("slot", "ones", "n"))
    odds = np.zeros(slots)
    odds[slot] = np.log((ones + 0.5) / np.maximum(every - ones, 0.5)) + np.log((1 - share) / share)
    used = np.zeros(slots, bool)
    used[slot] = informative(ones, every, share)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for pairs in batch.column("pairs").to_pylist():
                sentence, word = _halves(pairs)
                here = used[word]
                made.append(np.concatenate((sentence[here], word[here])).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("sentences"), pa.array(made, pa.binary()), batch.column("label")], names=["sentences", "pairs", "label"])

    sentence, word, counts, y = [], [], [], []
    for r in taught.mapInArrow(keep, taught.schema).orderBy(F.xxhash64("pairs"), "label").toLocalIterator():  # a bounded sample
        at, words = _halves(r.pairs)
        sentence.append(at)
        word.append(words)
        counts.append(r.sentences)
        y.append(r.label)
    firsts = lengths_to_starts(np.array(counts, np.int64)).astype(np.int64)
    shifted = np.concatenate([at + begin for at, begin in zip(sentence, firsts[:-1].tolist(), strict=True)])
    return learn(shifted, np.concatenate(word), firsts, np.array(y), model, odds)


def _halves(pairs: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sentence and the weight of each pair."""
    found = np.frombuffer(pairs, "<i4").astype(np.int64)
    return found[: len(found) // 2], found[len(found) // 2 :]


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity", threshold: float = 0.3) -> DataFrame:
    """``docs`` with a struct ``out``: the document's score and its sentences of at least ``threshold``."""
    kept = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("sentence", pa.int32()), ("text", pa.string()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        slots = Slots(len(own.weights))
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = texts(batch.column(text))
            scores, firsts, whole = own.sentences(raw, slots)
            found: list[list[dict]] = [[] for _ in raw]
            for k in np.flatnonzero(scores >= threshold).tolist():
                doc = int(np.searchsorted(firsts, k, "right")) - 1
                found[doc].append({"sentence": k - int(firsts[doc]), "score": float(scores[k])})
            for doc, several in enumerate(found):
                parts = _END.split(raw[doc].decode()) if several else ()
                for s in several:
                    s["text"] = parts[s["sentence"]].strip()
            struct = pa.StructArray.from_arrays([pa.array(np.clip(whole, 0, 1)), pa.array(found, kind)], names=["score", "sentences"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.StructType.fromDDL(f"score double, sentences {SENTENCES}"))]))
