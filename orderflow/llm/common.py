"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, shuffles_freed  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors (once an application), so that
    it need not be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    file = os.path.join(tempfile.mkdtemp(prefix="orderflow-code-"), "orderflow_code.zip")
    with zipfile.ZipFile(file, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(file)
    _SHIPPED.add(sc.applicationId)


#: Bytes of an Arrow batch; of one whose text both the JVM and a worker hold beside much else.
BATCH_BYTES, SMALL_BATCH = 32 << 20, 8 << 20


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Ship the code, and bound Arrow batches by bytes too, so that long texts
    do not pile up in a task."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def written(df: DataFrame, what: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: write to the shared folder of ``spark.checkpoint.dir``
    and read back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{what}-{uuid.uuid4().hex}"
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_small(df: DataFrame, what: str) -> DataFrame:
    """``written`` for a table far smaller than what it was made from: in an eighth
    of the shuffle's partitions, so that many partitions do not leave many small files."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.coalesce(max(8, n // 8)), what)


def crc_mod(column: str, n: int):
    return F.crc32(F.col(column).cast("string")) % n

