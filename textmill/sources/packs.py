"""Packed matrices: raw int32 rows, with meta and index, and back."""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.pack import index
from textmill.sources import files


def export(rows: DataFrame, out_dir: str, seq_len: int, extra: dict | None = None) -> dict:
    """packed.mmap (row-major int32), index as Parquet, meta.json, in a mounted folder that all executors share, as a matrix to be mapped into memory is a local file. Every task writes its rows where they belong."""
    out_dir = files.local(out_dir)
    os.makedirs(out_dir, exist_ok=True)
    n = rows.count()
    path = f"{out_dir}/packed.mmap"
    with open(path, "wb") as f:
        f.truncate(n * seq_len * 4)

    def write(batches):
        with open(path, "r+b") as f:
            for pdf in batches:
                for row, ids in zip(pdf["row"], pdf["input_ids"]):
                    f.seek(int(row) * seq_len * 4)
                    f.write(np.asarray(ids, "<i4").tobytes())
                yield pd.DataFrame({"n": [len(pdf)]})

    written = rows.select("row", "input_ids").mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0
    index(rows).write.mode("overwrite").parquet(f"file://{out_dir}/index")
    meta = {"seq_len": seq_len, "num_seqs": n, "dtype": "int32", "written": written} | (extra or {})
    with open(f"{out_dir}/meta.json", "w") as f:
        json.dump(meta, f, indent=2)
    return meta


def read(spark: SparkSession, out_dir: str) -> DataFrame:
    """(row, input_ids, domain) of an exported pack; domains are left out if their number is not that of the rows."""
    out_dir = files.local(out_dir)
    with open(f"{out_dir}/meta.json") as f:
        meta = json.load(f)
    n, width = meta.get("num_seqs", meta.get("n_seqs")), meta["seq_len"]
    path = f"{out_dir}/packed.mmap"

    def load(batches):
        m = np.memmap(path, np.uint32, "r", shape=(n, width)) if n else np.zeros((0, width), np.uint32)
        for pdf in batches:
            yield pd.DataFrame({"row": pdf["id"], "input_ids": [m[i].astype(np.int64).tolist() for i in pdf["id"]]})

    rows = spark.range(n).mapInPandas(load, "row long, input_ids array<long>")
    labels = spark.read.parquet(f"file://{out_dir}/index").select("row", "domain") if os.path.exists(f"{out_dir}/index") else None
    if labels is None or labels.count() != n:
        return rows.withColumn("domain", F.lit(None).cast("string"))
    return rows.join(labels, "row", "left")
