"""JSON lines, also compressed by zstd: paths, scans, sinks, repair. Reads go through Spark; what it cannot write, Python writes."""

from __future__ import annotations

import glob
import io
import json
import os
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.text import safe_name
from textmill.sources import files

FIRST_LINE_MOST = 8 << 20


def expand(inputs: list[str]) -> list[str]:
    """Paths: ~ and globs, ** included, expanded and sorted; others as they are."""
    out: list[str] = []
    for item in map(os.path.expanduser, inputs):
        out += sorted(glob.glob(item, recursive=True)) if any(c in item for c in "*?[") else [item]
    return out


def walk(path: str) -> list[str]:
    """A file itself; of a folder all *.jsonl* below, sorted."""
    return sorted(
        p for p in glob.glob(f"{glob.escape(path)}/**/*.jsonl*", recursive=True) if os.path.isfile(p)
    ) if os.path.isdir(path) else [path]


def under_root(paths: list[str], root: str | None = None) -> list[str]:
    """Relative paths below a root (else that of TEXTMILL_DATA_ROOT or DATA_ROOT, if set), globs expanded, each once, sorted."""
    root = root or os.environ.get("TEXTMILL_DATA_ROOT") or os.environ.get("DATA_ROOT")
    full = [p if not root or os.path.isabs(p) else os.path.join(root, p) for p in paths]
    return sorted({x for p in full for x in glob.glob(p)})


def dedup_inputs(paths: list[str], out_dir: str) -> list[str]:
    """Files to dedup: .jsonl and .jsonl.zst, without manifests and without what lies in out_dir."""
    out = os.path.realpath(out_dir) + os.sep
    files = [f for p in expand(paths) for f in walk(p)]
    return [
        f
        for f in files if f.endswith((".jsonl", ".jsonl.zst")) and ".manifest." not in os.path.basename(f) and not os.path.realpath(f).startswith(out)
    ]


def read(spark: SparkSession, paths: list[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Rows with `ord`: by file, then by place in it. strict: a line that is no JSON is an error, else it is left out."""
    if not paths:
        return spark.createDataFrame([], schema).withColumn("ord", F.lit(0).cast("long"))
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    full = kind if strict else T.StructType([*kind, T.StructField("_bad", T.StringType())])
    r = spark.read.schema(full).option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    rows = r.json(paths).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id")
    )
    if not all(f.endswith(".zst") for f in paths):
        # a plain file can be several splits: ids count from a split's first row on, and a row is a byte long at least
        first = rows.groupBy("_file", "_start").agg(F.min("_id").alias("_first"))
        rows = rows.join(first, ["_file", "_start"]).withColumn("_id", F.col("_start") + F.col("_id") - F.col("_first")).drop("_first")
    if not strict:
        rows = rows.where("_bad IS NULL").drop("_bad")
    # a compressed file is one split, within which ids rise
    place = F.pmod("_id", F.lit(1 << 43)) if not all(f.endswith(".zst") for f in paths) else F.pmod("_id", F.lit(1 << 33))
    name = lambda f: f if "://" in f else os.path.abspath(f)
    numbered = [(name(re.sub("^file:/*", "/", f)), i) for i, f in enumerate(sorted(set(paths)))]
    names = spark.createDataFrame(numbered, "_path string, _n long")
    rows = rows.withColumn("_path", F.regexp_replace("_file", "^file:/*", "/")).join(names, "_path")
    columns = [f.name for f in kind]
    return rows.select(*columns, (F.col("_n") * F.lit(1 << 43) + place).alias("ord"))


def first_line(path: str, most: int = FIRST_LINE_MOST) -> tuple[str, str]:
    """(ok | empty | too_long, the first line)."""
    with files.read(path) as f:
        raw = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) if path.endswith(".zst") else f
        line = io.TextIOWrapper(io.BufferedReader(raw), "utf-8", "replace").readline(most + 1)
    return ("empty" if not line else "too_long" if len(line) > most else "ok"), line


def write_zst(rows: Iterable[bytes], path: str, level: int | None = None) -> int:
    """One compressed file, in place only when it is whole."""
    level = level if level is not None else int(os.environ.get("TEXTMILL_ZSTD_LEVEL", 3))
    n = 0
    with files.Written(path) as f, zstandard.ZstdCompressor(level=level).stream_writer(f, closefd=False) as w:
        for row in rows:
            w.write(row + b"\n")
            n += 1
    return n


def write_shards(docs: DataFrame, out_dir: str, prefix: str = "shard", level: int | None = None) -> DataFrame:
    """One prefix_00000.jsonl.zst per shard_id, in a folder that all executors share, and its manifest beside it. Returns (shard_id, path, docs)."""
    body = docs.select("shard_id", "ord", to_json_column(docs).alias("value"))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["shard_id"].iloc[0])
        path = f"{out_dir}/{prefix}_{k:05d}.jsonl.zst"
        n = write_zst((v.encode() for v in pdf.sort_values("ord")["value"]), path, level)
        return pd.DataFrame({"shard_id": [k], "path": [path], "docs": [n]})

    return body.groupBy("shard_id").applyInPandas(write, "shard_id long, path string, docs long")


def to_json_column(docs: DataFrame):
    from textmill.schema import DOC

    return F.to_json(
        F.struct(
            *[
                F.col(f.name).cast(f.dataType).alias(f.name) if f.name in docs.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in DOC
            ]
        ),
        {"ignoreNullFields": "false"}
    )


def write_manifests(
    manifest: DataFrame, drops: DataFrame, out_dir: str, domain: str, source: str, seed: int = 0, prefix: str = "shard"
) -> None:
    """prefix_00000.jsonl.manifest.json per shard: counts, and drops by reason. A row per shard comes to the driver."""
    by_shard: dict[int, dict[str, int]] = {}
    for r in drops.toLocalIterator():
        by_shard.setdefault(r["shard_id"], {})[r["drop_reason"]] = r["n"]
    for r in manifest.toLocalIterator():
        name = f"{prefix}_{r['shard_id']:05d}.jsonl"
        body = {
            "shard_path": f"{out_dir}/{name}.zst", "domain": domain, "source": source, "seed": seed,
            "counts": {k: r[k] for k in ("docs", "bytes", "est_tokens")}, "drops": by_shard.get(r["shard_id"], {})
        }
        with files.Written(f"{out_dir}/{name}.manifest.json") as f:
            f.write(json.dumps(body, indent=2).encode())


def _domain_of(fast: bool):
    """(whether a line is good, its domain): a line is bad if it is no JSON or, with `fast`, has no domain that a pattern finds."""
    if fast:
        found = F.regexp_extract("value", '"domain"\\s*:\\s*"([^"]*)"', 0)
        return found != "", F.regexp_extract("value", '"domain"\\s*:\\s*"([^"]*)"', 1)
    return F.expr("try_parse_json(value) IS NOT NULL"), F.get_json_object("value", "$.domain")


def split_by_domain(lines: DataFrame, out_dir: str | None = None, allow: list[str] | None = None, fast: bool = False) -> DataFrame:
    """JSON lines (value) with the safe name of their domain; bad lines left out, those without a domain under `unknown`.

    Written, if asked, as text, lines unchanged, a folder per domain: a domain may hold most of all lines, so it is no one
    task's file. Spark puts the folders in place when all tasks are done."""
    good, domain = _domain_of(fast)
    out = lines.where(F.trim("value") != "").where(good).select("value", safe_name(domain).alias("domain_safe"))
    if allow is not None:
        out = out.where(F.col("domain_safe").isin(allow))
    if out_dir:
        out.write.partitionBy("domain_safe").text(out_dir)
    return out


def bad_lines(lines: DataFrame, fast: bool = False) -> DataFrame:
    """(lines, bad): how many lines that are not blank a split meets, and how many of them it leaves out."""
    good, _ = _domain_of(fast)
    return lines.where(F.trim("value") != "").agg(F.count(F.lit(1)).alias("lines"), F.count_if(~good).alias("bad"))


def split_counts(split: DataFrame, k: int = 50) -> DataFrame:
    return split.groupBy("domain_safe").agg(F.count(F.lit(1)).alias("docs")).orderBy(F.desc("docs"), "domain_safe").limit(k)


class RepairError(Exception):
    """More bad records than allowed."""


#: What matters outside a string, and inside one, where an escape keeps the byte after it unless that is a line end.
_OUTSIDE, _INSIDE = re.compile(rb'"|\r\n?|\n'), re.compile(rb'"|\r|\n|\\[^\r\n]', re.DOTALL)


def records(raw: bytes) -> Iterator[bytes]:
    """Records of broken JSON lines: line ends inside strings are escaped, outside they end a record; CR LF is one end."""
    parts, quoted, at = [], False, 0
    while m := (_INSIDE if quoted else _OUTSIDE).search(raw, at):
        mark = m[0]
        if mark == b'"':
            parts.append(raw[at : m.end()])
            quoted = not quoted
        elif quoted:
            parts.append(raw[at : m.start()] + {b"\n": b"\\n", b"\r": b"\\r"}.get(mark, mark))
        else:
            parts.append(raw[at : m.start()])
            if record := b"".join(parts):
                yield record
            parts = []
        at = m.end()
    if record := b"".join([*parts, raw[at:]]):
        yield record


def repaired(raw: bytes, validate: bool = True, most_bad: int = 1000) -> tuple[list[bytes], int]:
    """Good records, and how many were bad."""
    good, bad = [], 0
    for r in records(raw):
        if not validate:
            good.append(r)
            continue
        try:
            good.append(json.dumps(json.loads(r.decode()), ensure_ascii=False).encode())
        except ValueError:
            bad += 1
            if bad > most_bad:
                raise RepairError(f"more than {most_bad} bad records") from None
    return good, bad


def repair(
    spark: SparkSession, paths: list[str], out_dir: str | None = None, backup: bool = True, validate: bool = True, most_bad: int = 1000
) -> DataFrame:
    """Repairs files in parallel, one a task: into out_dir, or in place with a .bak copy; what was not compressed gets .zst to its name.
    Returns (path, records_ok, records_bad)."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))

    def run(batches):
        for pdf in batches:
            for path in pdf["path"]:
                with files.read(path) as f:
                    raw = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() if path.endswith(".zst") else f.read()
                good, bad = repaired(raw, validate, most_bad)
                to = f"{out_dir}/{os.path.basename(path)}" if out_dir else path
                if not out_dir and backup:
                    files.move(path, f"{path}.bak")
                write_zst(good, to if to.endswith(".zst") else f"{to}.zst")
                yield pd.DataFrame({"path": [path], "records_ok": [len(good)], "records_bad": [bad]})

    return listed.mapInPandas(run, "path string, records_ok long, records_bad long")


def file_stats(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """(source, domain, file, n_docs, total_chars, total_bytes, n_bad) of listed files (source, domain, file): every line is a document, and
    one that is no JSON counts in n_bad as well."""
    paths = [r["file"] for r in listed.select("file").distinct().collect()]
    lines = spark.read.text(paths).select(
        "value", F.regexp_replace("_metadata.file_path", "^file:/*", "/").alias("file")
    ) if paths else spark.createDataFrame([], "value string, file string")
    text = F.get_json_object("value", "$.text")
    by = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length(F.coalesce(text, F.lit("")))).alias("total_chars"),
        F.sum(F.when(F.expr("try_parse_json(value) IS NULL"), 1).otherwise(0)).alias("n_bad")
    )
    size = spark.createDataFrame([(p, os.path.getsize(p)) for p in paths], "file string, total_bytes long")
    none = F.lit(0).cast("long")
    return listed.join(size, "file", "left").join(by, "file", "left").select(
        "source", "domain", "file", F.coalesce("n_docs", none).alias("n_docs"), F.coalesce("total_chars", none).alias("total_chars"),
        F.coalesce("total_bytes", none).alias("total_bytes"), F.coalesce("n_bad", none).alias("n_bad")
    )
