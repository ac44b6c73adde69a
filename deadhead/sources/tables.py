"""Reading the source tables and writing result tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from deadhead.schemas import SOURCES, conform


@dataclass(frozen=True)
class Sources:
    """The twelve input tables."""

    invoice_lines: DataFrame
    invoices: DataFrame
    calendar: DataFrame
    dc_transitions: DataFrame
    campus_map: DataFrame
    locations: DataFrame
    partner_lanes: DataFrame
    distance_table: DataFrame
    postal_codes: DataFrame
    manual_distances: DataFrame
    partner_rates: DataFrame
    dedicated_costs: DataFrame

    def conformed(self) -> Sources:
        return Sources(**{f.name: conform(getattr(self, f.name), SOURCES[f.name]) for f in fields(self)})


def read_sources(spark: SparkSession, root: str) -> Sources:
    """Parquet folders ``root/<table>``; extra columns are pruned at the scan."""
    return Sources(**{name: spark.read.parquet(f"{root}/{name}") for name in SOURCES}).conformed()


def read_catalog(spark: SparkSession, names: Mapping[str, str]) -> Sources:
    """Catalog tables; ``names`` maps each source to its qualified table name."""
    return Sources(**{name: spark.table(names[name]) for name in SOURCES}).conformed()


def write_sources(src: Sources, root: str) -> None:
    for name in SOURCES:
        write_table(getattr(src, name), root, name)


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Replace ``root/name`` whole and return the table as read back."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folders under the root of published tables: a folder per run, and the list of published runs.
RUNS, PUBLISHED = "_runs", "_published"


class Snapshot:
    """The tables of one run, written to a folder of their own and published together.

    Publishing appends one row to the list of published runs, which Spark commits as a whole, after all tables are
    written. A run that fails before that leaves what readers see untouched. Tables are written once, never copied.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex
        self.tables: dict[str, DataFrame] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table of this run and return it as read back."""
        path = f"{self.root}/{RUNS}/{self.run}/{name}"
        df.write.parquet(path)
        self.tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.tables[name]

    def publish(self, keep: int = 2) -> None:
        """Show this run to readers, and remove published runs but the last ``keep``."""
        before = published(self.spark, self.root)
        number = before[0].number + 1 if before else 1
        row = [(number, self.run, sorted(self.tables))]
        self.spark.createDataFrame(row, "number long, run string, tables array<string>").coalesce(1).write.mode("append").parquet(f"{self.root}/{PUBLISHED}")
        files = self.spark._jvm.org.apache.hadoop.fs
        for old in before[max(0, keep - 1) :]:
            path = files.Path(f"{self.root}/{RUNS}/{old.run}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def published(spark: SparkSession, root: str) -> list[Row]:
    """Published runs (number, run, tables), the last one first."""
    path = f"{root.rstrip('/')}/{PUBLISHED}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return []
    return spark.read.schema("number long, run string, tables array<string>").parquet(path).orderBy(F.desc("number"), "run").collect()  # a row per run


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the run that was published last."""
    runs = published(spark, root)
    if not runs or name not in runs[0].tables:
        raise LookupError(f"no published table {name} under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{RUNS}/{runs[0].run}/{name}")
