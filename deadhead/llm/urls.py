"""URL filter: rules, and for the rest naive Bayes over segmented host names and path tokens.

* A rule fits its host and all subdomains if the url's path starts with the rule's; the longest fitting rule decides.
* Host names are cut into words by unigram Viterbi. Word counts come from the visible text of all pages. Every run of
  letters of a host is joined, by its substrings, with exactly the counts that it can use, so no dictionary is broadcast
  or cut short; words of more than ``LONGEST`` letters are joined by their beginning and then looked for in the run.
* Pages that a rule decides teach a multinomial naive Bayes model (label: the rule's verdict) on host words and path
  tokens, hashed to ``slots`` counts; a token's digits only tell their number. Counts cover all such pages. The weights,
  ``slots`` numbers, are all that is broadcast.

Defined results: a NULL url, or one without ``://``, has an empty host and path, no rule and no token, and gets the verdict
of the class shares; ties are allowed; repeated rows get equal rows each; very long hosts and paths are used whole; an
empty table gives no rows; NULL html adds no words; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deadhead.llm.common import lengths_to_starts, materialize

#: Longest substring that is joined as it is.
LONGEST = 24
SLOTS = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``where`` is a host and the beginning of a path, like ``example.net/en/``."""

    where: str
    verdict: str

    @property
    def host(self) -> str:
        return self.where.partition("/")[0]

    @property
    def path(self) -> str:
        slash = self.where.find("/")
        return self.where[slash:] if slash >= 0 else ""


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def first_rule(rules: Sequence[Rule], host: Column, path: Column, give: str) -> Column:
    """``give`` ("where" or "verdict") of the longest rule that fits, or NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.where), r.where)):  # the longest is asked first
        own = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
        found = F.when(own & F.startswith(path, F.lit(rule.path)), F.lit(getattr(rule, give))).otherwise(found)
    return found


def unigrams(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n) of the visible text of all pages: runs of a-z, lower-cased."""
    shown = F.regexp_replace(F.lower(html), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    words = pages.select(F.explode(F.split(shown, r"[^\p{L}]+")).alias("word"))
    return words.filter(F.col("word").rlike("^[a-z]+$")).groupBy("word").agg(F.count("*").alias("n"))


def viterbi(run: str, logs: dict[str, float], unknown: float) -> list[str]:
    """The most likely words of a run; an unknown piece costs ``unknown`` and a digit of probability per letter."""
    letter, sizes = math.log(10), sorted({len(w) for w in logs}, reverse=True)
    best, back = [0.0], [0]
    lead, first = 0.0, 0  # where the unknown piece that ends here begins
    for end in range(1, len(run) + 1):
        if best[end - 1] + letter * (end - 1) > lead:
            lead, first = best[end - 1] + letter * (end - 1), end - 1
        score, start = lead + unknown - letter * end, first
        for size in sizes:
            if size <= end and (word := run[end - size : end]) in logs and best[end - size] + logs[word] > score:
                score, start = best[end - size] + logs[word], end - size
        best.append(score)
        back.append(start)
    words, end = [], len(run)
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


def segment(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words): each distinct ``host`` as words; digits and other characters stay as they are."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    unknown = -math.log(max(total, 1))
    parts = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("([a-z]+|[0-9]+|[^a-z0-9._-]+)"), F.lit(1))).alias("place", "part"))
    runs = parts.filter(F.col("part").rlike("^[a-z]{2,}$")).select("part").distinct()
    starts = F.sequence(F.lit(1), F.length("part"))
    pieces = runs.select("part", F.explode(starts).alias("s")).select(
        "part", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("part") - F.col("s") + 1)), lambda k: F.substring("part", F.col("s"), k))).alias("word")
    )
    pieces, long = pieces.distinct(), F.length("word") > LONGEST
    begun = pieces.filter(F.length("word") == LONGEST).withColumnRenamed("word", "begin")
    longer = begun.join(counts.filter(long).withColumn("begin", F.substring("word", 1, LONGEST)), "begin").filter(F.contains("part", "word"))
    found = pieces.join(counts.filter(~long), "word").select("part", "word", "n").unionByName(longer.select("part", "word", "n"))
    known = found.groupBy("part").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                viterbi(part, {k["word"]: math.log(k["n"]) + unknown for k in found or ()}, unknown)
                for part, found in zip(batch.column("part").to_pylist(), batch.column("known").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(made, pa.list_(pa.string()))], names=["part", "words"])

    cuts = runs.join(known, "part", "left").mapInArrow(cut, "part string, words array<string>")
    own = parts.join(cuts, "part", "left").select("host", "place", F.coalesce("words", F.array("part")).alias("words"))
    return own.groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "words"))), lambda x: x["words"])).alias("words"))


def tokens(words: Column, path: Column) -> Column:
    """Host words and path tokens; numbers count by their length."""
    found = F.regexp_extract_all(F.lower(path), F.lit(r"(\p{L}+|\p{N}+)"), F.lit(1))
    shaped = F.transform(found, lambda t: F.concat(F.lit("/"), F.when(t.rlike(r"^\p{N}+$"), F.concat(F.lit("#"), F.length(t).cast("string"))).otherwise(t)))
    return F.concat(F.coalesce(words, F.expr("cast(array() as array<string>)")), shaped)


def judge(pages: DataFrame, counts: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url", slots: int = SLOTS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): score is the log odds of block, also where a rule decides."""
    spark = pages.sparkSession
    parsed = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    words = segment(parsed.select("host").distinct(), counts)
    slot = F.transform(tokens(F.col("words"), F.col("path")), lambda t: F.pmod(F.xxhash64(t), F.lit(slots)).cast("int"))
    held = materialize(
        parsed.join(words, "host", "left").select(
            "page_id", "host", "path", first_rule(rules, F.col("host"), F.col("path"), "where").alias("rule"),
            first_rule(rules, F.col("host"), F.col("path"), "verdict").alias("ruled"), slot.alias("slots"),
        ),
        "urls",
    )
    weights, prior = _train(held, slots)
    shared = spark.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("slots")
            own = np.concatenate(([0.0], np.cumsum(shared.value[lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)])))
            at = lengths_to_starts(np.array(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64))
            odds = own[at[1:]] - own[at[:-1]] + prior
            kept = [batch.column(c) for c in ("page_id", "host", "path", "rule", "ruled")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(odds)], names=["page_id", "host", "path", "rule", "ruled", "score"])

    schema = held.drop("slots").schema.add("score", "double")
    verdict = F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return held.mapInArrow(score, schema).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def _train(held: DataFrame, slots: int) -> tuple[np.ndarray, float]:
    """Log odds of block per slot, and of the classes, with one added to each count."""
    taught = held.filter("ruled is not null").select((F.col("ruled") == "block").cast("int").alias("block"), "slots")
    blocked, every = taught.agg(F.coalesce(F.sum("block"), F.lit(0)), F.count("*")).first()
    rows = taught.select("block", F.explode("slots").alias("slot")).groupBy("slot").agg(F.sum("block").alias("block"), F.count("*").alias("n")).collect()  # at most slots rows
    block, allow = np.ones(slots), np.ones(slots)
    for r in rows:
        block[r.slot] += r.block
        allow[r.slot] += r.n - r.block
    weights = np.log(block / block.sum()) - np.log(allow / allow.sum())
    return weights, math.log((blocked + 1) / (every - blocked + 1))
