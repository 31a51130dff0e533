"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir, shuffles_freed


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back: its plan is run once however
    often it is used, values that depend on the run (partition numbers) stay as they
    were, and a lost executor costs no recomputation. The shuffle files it took do not
    stay on disk through the later steps."""
    path = staged_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
