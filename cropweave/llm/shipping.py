"""The package as a file that a session hands to its executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import cropweave

NAME = "cropweave-code.zip"
#: Texts are long: a batch of Spark's default number of rows would hold tens of megabytes.
BATCH, DEFAULT, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ship(spark: SparkSession) -> None:
    """Let workers import the package where it isn't installed, and hold Arrow batches small.

    Once a session; Spark copies the file to the executors. A batch size that the session
    has set itself is left alone.
    """
    if spark.conf.get(BATCH, DEFAULT) == DEFAULT:
        spark.conf.set(BATCH, ROWS)
    context = spark.sparkContext
    if any(Path(x).name == NAME for x in context.listFiles):
        return
    top = Path(cropweave.__file__).parent
    made = Path(tempfile.mkdtemp(prefix="cropweave-code-")) / NAME
    with zipfile.ZipFile(made, "w") as archive:
        for source in sorted(top.rglob("*.py")):
            archive.write(source, source.relative_to(top.parent))
    context.addPyFile(str(made))
