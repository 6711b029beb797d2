"""Documents in chunks, and an exchange of hashes between chunks.

A chunk is a range of doc_id of about CHUNK bytes of text. What the corpus knows about a hash (its
count, the first chunk that has it) is found by an exchange: every chunk sends its distinct hashes,
sorted and packed, to buckets of the hash range; a bucket answers each chunk with packed rows. A hash
that every document holds is sent once by a chunk, so no bucket grows with how often it occurs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm._stage import Stage, width

CHUNK = 12 << 20
#: Up to so many bytes of text, a chunk has CHUNK; beyond, chunks grow with the square root, so that the rows between
#: chunks and buckets, number times number, grow as the text does: 120 MB a chunk, 20 million hashes a bucket at 100 TB.
LEVEL = 1 << 40
#: Buckets at most; the number of a bucket times 2 ** _HIGH has to fit in 64 bits.
_HIGH = 42
MOST_BUCKETS = 1 << (64 - _HIGH)


def measure(docs: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of text."""
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return n, size


def chunked(stage: Stage, docs: DataFrame, size: int, chunk_bytes: int = CHUNK) -> tuple[DataFrame, int]:
    """A written table of the columns of docs and `chunk`; how many chunks there are. doc_id decides the chunk; chunks are even in rows."""
    n = max(1, -(-size // chunk_size(size, chunk_bytes)))
    df = docs.repartitionByRange(n, F.col("doc_id").asc_nulls_first()) if n > 1 else docs.coalesce(1)
    table = stage.save(df.withColumn("chunk", F.spark_partition_id()), "chunks")
    del df
    stage.release()
    return table, n


def chunk_size(size: int, chunk_bytes: int = CHUNK) -> int:
    return chunk_bytes if size <= LEVEL else int(chunk_bytes * (size / LEVEL) ** 0.5)


def buckets(n_chunks: int, spark: SparkSession) -> int:
    n = max(n_chunks, width(spark))
    if n > MOST_BUCKETS:  # some petabytes
        raise ValueError(f"{n} buckets; larger chunks are needed for so much text")
    return n


def cuts(keys: np.ndarray, n_buckets: int, bits: int = 64) -> np.ndarray:
    """Where each bucket's keys begin among sorted ones of so many bits. The bucket follows from the upper _HIGH bits."""
    at = ((keys >> np.uint64(bits - _HIGH)) * np.uint64(n_buckets)) >> np.uint64(_HIGH)
    return np.searchsorted(at, np.arange(n_buckets + 1).astype(np.uint64))


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one chunk."""
    for batch in batches:
        chunk = batch.column("chunk").to_numpy()
        cuts = np.flatnonzero(np.diff(chunk)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(chunk)]):
            if b > a:
                yield int(chunk[a]), batch.slice(a, b - a)


SENT = "bucket int, chunk int, a binary, b binary"


def send(chunk: int, keys: np.ndarray, n_buckets: int, extra: np.ndarray | None = None, bits: int = 64) -> pa.RecordBatch:
    """One row per bucket of sorted keys."""
    at = cuts(keys, n_buckets, bits)
    rows = np.flatnonzero(np.diff(at)).tolist()
    from textmill.llm._text import pack, pack_sorted

    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows, pa.int32()),
            pa.array([chunk] * len(rows), pa.int32()),
            pa.array([pack_sorted(keys[at[i] : at[i + 1]]) for i in rows], pa.binary()),
            pa.array([None if extra is None else pack(extra[at[i] : at[i + 1]]) for i in rows], pa.binary()),
        ],
        ["bucket", "chunk", "a", "b"],
    )


def reply(answers: list[tuple[int, bytes, bytes | None]]) -> pa.Table:
    chunk, a, b = zip(*answers) if answers else ((), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int32()), "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


ANSWER = "chunk int, a binary, b binary"


def exchange(sent: DataFrame, answer: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return sent.groupBy("bucket").applyInArrow(answer, ANSWER)


def with_answers(chunks: DataFrame, answers: DataFrame, f: Callable, schema: str) -> DataFrame:
    """f(rows of a chunk, its answers) for each chunk."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return f(left, right)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
