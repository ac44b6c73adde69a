"""A training corpus from raw documents: stages that each write their result for the next one.

Defined results. Quality: a NULL or empty text is scored like any other; repeated rows are scored each. Near copies: rows of
one group leave the one with the smallest id (NULL ids last), repeated rows leave one, documents without a word all stay.
Repeated passages and benchmark passages go from the texts that hold them; texts of which nothing is left stay as empty
texts, NULL stays NULL. Encoding: NULL and empty texts have no ids. Further columns come through all stages but the last
unchanged, whatever their names; an empty table gives no rows; very long texts pass like others, none is cut short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deadhead.llm import queries
from deadhead.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", queries.accepted),
    ("n-gram Jaccard join", queries.one_of_each_group),
    ("substring dedup", queries.without_repeats),
    ("benchmark decontamination", queries.decontaminated),
    ("byte-level BPE", queries.encoded),
]

#: A trained classifier decides in the first stage, which SQL cannot express; tests compare the rest with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole ``documents`` table, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
