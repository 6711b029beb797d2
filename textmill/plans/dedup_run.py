"""A dedup run into a folder of any store: decisions, kept rows and stats. Each is renamed into place when it is whole, so
a run that was cut off goes on with what is missing, if its parameters are the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from textmill.functions.text import params_hash
from textmill.operators import dedup


def run(docs: DataFrame, out: str, inputs: list[str], resume: bool = False, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(decisions, kept, stats) of documents with unique `ord`, as written below `out`. `inputs` names what docs were read from: with
    the options of dedup.decisions it decides whether a run is the same."""
    spark = docs.sparkSession
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/{name}")
    fs = path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mark = "params-" + params_hash({"inputs": sorted(inputs), **options})
    there = [s.getPath().getName() for s in fs.listStatus(path(""))] if fs.exists(path("")) else []
    if there and not resume:
        raise FileExistsError(f"{out} is not empty; resume it or choose another folder")
    if any(n.startswith("params-") and n != mark for n in there) or there and mark not in there:
        raise ValueError(f"{out} holds a run of other parameters")
    for n in there:
        if n.startswith("open-"):  # what a run left unfinished
            fs.delete(path(n), True)
    fs.mkdirs(path(mark))

    def step(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not fs.exists(path(name)):
            part = f"open-{name}-{uuid.uuid4().hex[:12]}"
            make().write.option("compression", "zstd").parquet(path(part).toString())
            if not fs.rename(path(part), path(name)):
                raise OSError(f"{part} cannot be renamed to {name}")
        return spark.read.parquet(path(name).toString())

    decided = step("decisions", lambda: dedup.decisions(docs, **options))
    return decided, step("kept", lambda: dedup.kept(docs, decided)), step("stats", lambda: dedup.stats(decided))
