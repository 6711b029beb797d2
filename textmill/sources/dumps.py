"""Dumps: StackExchange posts, wiki dumps, extracted articles."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POST = "Id string, PostTypeId string, ParentId string, AcceptedAnswerId string, Title string, Body string, Tags string, CreationDate string, Score string"
_FIELDS = [x.split()[0] for x in POST.split(", ")]


def posts_path(path: str) -> str:
    """Posts.xml of a folder or of a .7z archive, or an .xml file itself."""
    if os.path.isdir(path):
        found = os.path.join(path, "Posts.xml")
        if not os.path.exists(found):
            raise FileNotFoundError(f"no Posts.xml in {path}")
        return found
    if path.endswith(".7z"):
        try:
            import py7zr
        except ImportError as e:
            raise ImportError("reading .7z takes py7zr") from e
        to = tempfile.mkdtemp(dir=os.path.dirname(os.path.abspath(path)))  # beside the archive, where executors find it too
        with py7zr.SevenZipFile(path) as archive:
            archive.extractall(to)
        return posts_path(to)
    if path.endswith(".xml"):
        return path
    raise ValueError(f"no StackExchange input: {path}")


def posts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of POST and `ord`, read by Spark's own reader, in splits. If any row is none to it, all are read by posts_broken;
    to know that takes a scan before the one that reads."""
    schema = ", ".join(f"_{f} string" for f in _FIELDS)
    rows = spark.read.format("xml").option("rowTag", "row").option(
        "columnNameOfCorruptRecord", "_bad"
    ).schema(f"{schema}, _bad string").load(path)
    if not rows.where("_bad IS NOT NULL AND _Id IS NULL").isEmpty():
        return posts_broken(spark, path)
    return rows.select(*[F.col(f"_{f}").alias(f) for f in _FIELDS], F.monotonically_increasing_id().alias("ord"))


def posts_broken(spark: SparkSession, path: str) -> DataFrame:
    """The same of XML that no parser takes, in splits as well: what stands between two `<row` is a line of text. A row ends at the first >
    outside quotes, an attribute is a name and a value in double quotes, entities stay as they are; a row without any is none."""
    lines = spark.read.option("lineSep", "<row").text(path)
    head = F.regexp_extract("value", r"""^((?:[^"'>]|"[^"]*"|'[^']*')*+)>""", 1)
    parts = lines.select(head.alias("head")).select(
        *[F.regexp_extract_all("head", F.lit(r'(\w+)="([^"]*)"'), F.lit(k)).alias(c) for k, c in ((1, "names"), (2, "values"))]
    )
    rows = parts.where(F.size("names") > 0)
    return rows.select(
        *[F.try_element_at("values", F.nullif(F.array_position("names", f).cast("int"), F.lit(0))).alias(f) for f in _FIELDS],
        F.monotonically_increasing_id().alias("ord")
    )


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a dump, also .bz2 or .gz: title, ns, id and revision."""
    schema = "title string, ns string, id string, revision struct<timestamp:string,text:string>"
    return spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)


def wiki_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles from lines of JSON, files of a folder included; blank and bad lines are left out."""
    schema = "id string, doc_id string, title string, text string, created_at string, timestamp string, url string"
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(
        F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("a"), F.expr("try_parse_json(value)").isNotNull().alias("good")
    ).where("good").select("a.*")
