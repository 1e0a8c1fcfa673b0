"""Session helpers: where shared scratch data goes and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the
    session is local, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="cropweave-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; never reuses an existing one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "rows") -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and read it from there.

    The plan behind it is cut, lost executors cost nothing that was already computed,
    and later readers still prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
