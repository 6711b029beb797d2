"""Exact dedup by a heavy-hitter split.

A Misra-Gries summary of 4 * COUNTERS counters per partition, merged, holds every digest that makes up
more than 1 / COUNTERS of the rows. Those candidates are counted exactly; the verified ones, fewer than COUNTERS,
are broadcast and settle their rows where they lie. All other digests, each with a
bounded share of the rows, go through an ordinary shuffle of (digest, doc_id).

Texts are equal when they are identical; null counts as empty. Of equal texts the row with the largest
doc_id stays (a null doc_id loses against any other). Of rows that share that doc_id too, the one
that `row_key` numbers highest stays, so exactly one row of a group is kept. Extra columns are
ignored by `groups` and kept by `dedup`. An empty table gives an empty result.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm._stage import Stage, plain

COUNTERS = 256


def _lower(counts: pd.Series, k: int) -> pd.Series:
    """Misra-Gries: with more than k counters, all go down by the (k + 1)-th largest count."""
    if len(counts) <= k:
        return counts
    counts = counts.sort_values(ascending=False)
    counts = counts - counts.iloc[k]
    return counts[counts > 0]


def misra_gries(batches, k: int = COUNTERS):
    """A summary of one partition's digests."""
    held = pd.Series(dtype="int64")
    for batch in batches:
        counts = batch.column("digest").to_pandas().value_counts()
        held = _lower(held.add(counts, fill_value=0).astype("int64") if len(held) else counts, k)
    yield pa.RecordBatch.from_arrays(
        [pa.array(held.index.astype(object), pa.string()), pa.array(held.to_numpy(), pa.int64())], ["digest", "least"]
    )


def heavy(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """Digests of more than 1 / k of the rows, so fewer than k, with the rows of each and the winner's key.

    Summaries have 4 * k counters. Added up, they undercount a digest by rows / (4 * k) at most, so one of more than rows / k has at
    least three quarters of that left; no more than 4 * k / 3 digests do, and these candidates are counted exactly.
    """
    n = digests.count()
    summed = digests.select("digest").mapInArrow(
        lambda b: misra_gries(b, 4 * k), "digest string, least long"
    ).groupBy("digest").agg(F.sum("least").alias("least"))
    candidates = summed.where(F.col("least") * (4 * k) >= 3 * n)
    exact = digests.join(F.broadcast(candidates.select("digest")), "digest").groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_key")).alias("best")
    )
    return exact.where(F.col("group_size") * k > n)


def _settled(docs: DataFrame, stage: Stage, k: int) -> DataFrame:
    """(doc_id, row_key, digest, group_size, best) per row of (doc_id, row_key, text)."""
    digests = stage.save(docs.select("doc_id", "row_key", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")), "digests")
    winners = stage.save(heavy(digests, k).coalesce(1), "winners")
    hot = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # counts and winners are aggregates, made in part before the shuffle; only digests of several rows are met by a join
    several = rest.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_key")).alias("best")
    ).where("group_size > 1")
    rest = rest.join(several, "digest", "left").withColumns(
        {"group_size": F.coalesce("group_size", F.lit(1)), "best": F.coalesce("best", F.struct("doc_id", "row_key"))}
    )
    columns = ["doc_id", "row_key", "digest", "group_size", "best"]
    return hot.select(columns).unionByName(rest.select(columns))


def groups(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """Per row of (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    stage = Stage(docs.sparkSession, "exact")
    s = _settled(docs.select("doc_id", "text").withColumn("row_key", F.monotonically_increasing_id()), stage, k)
    return s.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row_key") == F.col("best.row_key")).alias("kept"),
        F.col("digest").alias("text_sha256")
    )


def dedup(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns."""
    stage = Stage(docs.sparkSession, "exact")
    renamed, names = plain(docs)
    table = stage.save(renamed.withColumn("row_key", F.monotonically_increasing_id()), "docs")
    s = _settled(table.select("doc_id", "row_key", "text"), stage, k)
    gone = s.where(F.col("row_key") != F.col("best.row_key")).select("row_key")
    return table.join(gone, "row_key", "left_anti").select(*names).toDF(*docs.columns)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS sha FROM documents) WINDOW w AS (PARTITION BY sha)
"""
