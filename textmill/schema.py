"""The document schema and the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A normalised document. `ord` is added where order matters: first row wins, caps, packing.
DOC = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("domain", T.StringType()), T.StructField("doc_id", T.StringType()),
    T.StructField("license_tag", T.StringType()), T.StructField("created_at", T.StringType()), T.StructField(
        "meta", T.MapType(T.StringType(), T.StringType())
    ),
])


def session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow."""
    b = SparkSession.builder.appName("textmill").config(
        "spark.sql.adaptive.enabled", "true"
    ).config("spark.sql.session.timeZone", "UTC").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def with_id(docs: DataFrame) -> DataFrame:
    """`id` stands in for `doc_id` where there is no such column."""
    if "doc_id" not in docs.columns and "id" in docs.columns:
        return docs.withColumn("doc_id", F.col("id").cast("string")).drop("id")
    return docs
