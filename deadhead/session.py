"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

SETTINGS = {
    # splits hot invoice ids and zips when they are joined, merges small shuffle partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # dates of timestamps are taken in UTC
    "spark.sql.session.timeZone": "UTC",
    # division by zero and bad casts are errors
    "spark.sql.ansi.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once for each application.

    The driver's copy is an archive that Spark serves; nothing has to be installed or on a path of the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="deadhead-package-")) / "deadhead.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and measurements."""
    parallelism = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("deadhead")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(parallelism))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
