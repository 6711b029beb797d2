"""Written tables in the folder that all executors share, to cut lineage in iterative plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, the session's checkpoint folder or, on one machine as in tests, a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='textmill-')}")
    return context._jsc.sc().getCheckpointDir().get()


class Tables:
    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.at}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.at}/{name}")

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
