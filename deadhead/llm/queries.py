"""The registered queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deadhead.llm import bpe, decontaminate, jaccard, merkle, neighbours, ngram_lm, quality, substrings, suffixes, token_files, toxicity, urls, whitening
from deadhead.llm.common import crc_mod, free_name, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.scan(docs, table(spark, sf_dir, "benchmark")))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.digest(substrings.deduplicate(docs, width=35))


def _graded(scored: DataFrame, held_out: Column, score: Column) -> DataFrame:
    """A classifier's row per document: label 1 is predicted from a score of 0.3."""
    rows = scored.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod("id", 4) != 2)
    return _graded(toxicity.score(docs, model), crc_mod("doc_id", 4) == 2, F.col("toxicity.score"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def _quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    return quality.fit(docs, table(spark, sf_dir, "labels"), crc_mod("id", 5) != 0)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, _quality_model(spark, docs, sf_dir))
    return _graded(scored, crc_mod("doc_id", 5) == 0, F.col("score"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram_lm.fit(docs, training=crc_mod("doc_id", 5) != 1, order=3)
    scored = ngram_lm.score(docs, model)
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 1).alias("held_out"),
        F.col("lm.n_tokens").alias("n_tokens"),
        F.col("lm.n_known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("lm.base_score").alias("base_score"),
        F.col("lm.score").alias("score"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, table(spark, sf_dir, "documents"), sf_dir)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_files.Vocabulary(public_tokenizers.path("word_bpe_49k.json"), end=1)
    manifest = token_files.write(table(spark, sf_dir, "documents"), vocabulary)
    return token_files.digest(token_files.read(spark, manifest))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.digest(jaccard.components(docs, size=3, percent=90))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors, components=4)
    rows = whitening.whiten(vectors, model).select("vec_id", "white", F.posexplode("white.whitened").alias("place", "whitened"))
    explained = F.array(*[F.lit(x).cast("double") for x in model.explained]) if model else F.array(F.lit(None).cast("double"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        # more digits than 64 bits hold only come with tables of over ten million distinct vectors
        F.expr("try_cast(white.deviation AS bigint)").alias("deviation"),
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
        F.col("white.deviation").alias("deviation_digits"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(changed, merkle.leaf_hash([lowered if c == "text" else F.col(c) for c in columns]))
    proofs = merkle.manifest(docs, columns, key="doc_id", group="lang", carry={"tampered": tampered}).proofs()
    fold = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    found = proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), fold.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.digest(suffixes.deduplicate(docs, width=200))


URL_RULES = (
    urls.Rule("net/", "block"),
    urls.Rule("example.net/en/", "allow"),
    urls.Rule("example.com/de/", "block"),
    urls.Rule("org/fr/", "allow"),
)


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.unigrams(pages), URL_RULES)


# stages of the corpus pipeline

#: Near-duplicate stages take shingles of five words and a similarity of 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = free_name(docs, "score")
    scored = quality.score(docs, _quality_model(spark, docs, sf_dir), out=score)
    return scored.filter(F.col(score) >= 0.3).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.remove(docs, width=35)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = bpe.tokenize(docs.select("doc_id", "text"), path, pattern).drop("text")
    return bpe.digest(bpe.detokenize(tokens, path, pattern))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontaminate, op2_substrings, op3_toxicity, op4_neighbours, op5_quality, op6_language_model, op7_byte_bpe, op8_token_files, op9_jaccard, op10_urls, op11_whitening, op12_merkle, op13_suffixes)
}
