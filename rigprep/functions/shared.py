"""Tables that cut lineage, written to the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch: shuffle files go when the query that wrote them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir`` (or of setCheckpointDir).

    Where neither is set, a temporary folder serves a session whose executors are threads of the driver
    (as in tests) and is then set; on a cluster it is an error, as executors would not share it.
    """
    path = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir() or ""
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="rigprep-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def dealt(spark: SparkSession) -> int:
    """Tasks to which small rows are dealt before each becomes many: four for each core."""
    return 4 * spark.sparkContext.defaultParallelism


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files; their results are written tables."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/rigprep/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    What is built on the result starts from files that outlive any executor, and its
    size is known to the planner. An empty table keeps its schema.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def superseded(*tables: DataFrame) -> None:
    """Empty written tables that nothing reads any more, by writing no rows over them."""
    for df in tables:
        folder = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        if len(folder) == 1 and "/rigprep/" in (path := folder.pop()):
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
