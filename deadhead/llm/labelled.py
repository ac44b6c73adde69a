"""The bounded sample of labelled rows that a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents that a classifier learns from, about: a share of the labelled ones, chosen by the hash of the id.
SAMPLE = 16_000


def _share(column: str) -> Column:
    """A number from 0 to 1 made of the id."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 20)) / float(1 << 20)


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, training: Column, rows: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """Texts (id, text) and labels (id, label) of about ``rows`` training rows. ``training`` is a condition on the id.

    Rows are chosen by their id alone, so texts are thinned out before anything is computed from them, and meet their
    labels after that. NULL ids and labels teach nothing; of several labels of one id each counts.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).na.drop().filter(training)
    share = min(1.0, rows / max(1, known.count()))
    chosen = _share("id") < share
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.col("id").isNotNull() & training & chosen)
    return own, known.filter(chosen)
