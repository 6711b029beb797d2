"""Tables that an operator keeps between its jobs, in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset: the checkpoint folder of the session, or on one machine (tests) a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='textmill-')}")
    return context._jsc.sc().getCheckpointDir().get()


class Stage:
    """A folder of written tables. drop() deletes a table that no later job reads, and lets Spark
    release the shuffle files of the jobs that made it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        df.write.option("compression", codec).parquet(f"{self.at}/{name}")
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.at}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.release()

    def release(self) -> None:
        """Shuffle files go once the driver has collected the plans that named them: Python's references first, then the JVM's."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plain(docs: DataFrame, kept: tuple[str, ...] = ("doc_id", "text")) -> tuple[DataFrame, list[str]]:
    """The frame with all columns but the `kept` ones under names that clash with none, and those names in order."""
    names = [c if c in kept else f"c{i}_" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names
