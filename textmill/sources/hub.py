"""Datasets of a hub: which, how their fields map to documents, configurations. Rows come from any DataFrame, as there is no network."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import stable_hash
from textmill.operators.transforms import _field, _some

# Known sources, as (dataset, configuration, text field, fields for meta, domain).
SOURCES = {
    "fineweb_edu_default": ("HuggingFaceFW/fineweb-edu", "default", "text", ["url", "score", "language_score"], "filtered_web"),
    "fineweb2": (
        "HuggingFaceFW/fineweb-2", "eng_Latn", "text", ["url", "date", "timestamp", "language", "language_score", "minhash_cluster_size"],
        "filtered_web"
    ),
    "the-stack-v2": ("bigcode/the-stack-v2", None, "content", ["path", "language", "repo_name"], "code_docs"),
    "starcoder2data-extras": ("bigcode/starcoder2data-extras", None, "content", ["path", "language", "repo_name"], "code_docs"),
    "open-web-math": ("open-web-math/open-web-math", None, "text", ["source"], "math"),
    "arxiv-abstracts-2021": (
        "gfissore/arxiv-abstracts-2021", None, "abstract", ["title", "categories", "authors", "update_date"], "paper_teasers"
    ),
    "openstax-text": ("crumb/openstax-text", None, "text", ["title", "book", "chapter"], "books_longform"),
    "open-text-books": ("izumi-lab/open-text-books", None, "text", ["title", "url"], "books_longform"),
    "gutenberg_clean_en": ("nikolina-p/gutenberg_clean_en", None, "text", ["title", "author"], "books_longform"),
}


def resolved(source: str, params: dict) -> dict:
    """Parameters of a source, with what is known of it where they say nothing."""
    dataset, config, text, meta, domain = SOURCES.get(source, (None, None, "text", [], None))
    base = {
        "dataset": dataset, "config_name": config, "split": "train", "text_field": text, "id_field": "id", "meta_fields": meta,
        "domain": domain
    }
    out = base | {k: v for k, v in params.items() if v}
    if not out["dataset"]:
        raise ValueError(f"{source}: no dataset")
    return out


def documents(
    rows: DataFrame, source: str, domain: str, text_field: str = "text", id_field: str = "id", meta_fields: list[str] = (),
    limit: int | None = None
) -> DataFrame:
    """Documents of rows with `ord`: at most `limit`; meta has the fields that are there; ids missing are hashes."""
    d = rows.orderBy("ord").limit(limit) if limit is not None else rows
    text = F.coalesce(_field(d, text_field), F.lit(""))
    there = [f for f in meta_fields if f in d.columns]
    meta = F.map_filter(
        F.create_map(*[x for f in there for x in (F.lit(f), F.col(f).cast("string"))]), lambda k, v: v.isNotNull()
    ) if there else F.lit(None).cast("map<string,string>")
    made = d.select(
        text.alias("text"), _some(_field(d, id_field)).alias("doc_id"),
        _some(_field(d, "timestamp"), _field(d, "date")).alias("created_at"), meta.alias("meta"), "ord"
    )
    own = stable_hash(F.concat_ws(":", F.lit(source), F.col("ord").cast("string"), "text"))
    return made.select(
        "text", F.lit(source).alias("source"), F.lit(domain).alias("domain"), F.coalesce("doc_id", own).alias("doc_id"),
        F.lit(None).cast("string").alias("license_tag"), "created_at", F.when(F.size("meta") > 0, F.col("meta")).alias("meta"), "ord"
    )


def split_of(load: Callable[[str], DataFrame], splits: list[str], wanted: str = "train") -> DataFrame:
    """The wanted split, else train, else test, else the first there is."""
    for name in (wanted, "train", "test", *splits):
        if name in splits:
            return load(name)
    raise ValueError("no splits")


def matching_configs(configs: DataFrame, lang: str | None = None, script: str | None = None, contains: str | None = None) -> DataFrame:
    """Rows (config): by language, the part before the first _, and script, all after it; else by a substring in any case."""
    head, rest = F.substring_index("config", "_", 1), F.expr(
        "CASE WHEN instr(config, '_') > 0 THEN substring(config, instr(config, '_') + 1) END"
    )
    if lang:
        out = configs.where(head == lang)
        return out.where(rest == script) if script is not None else out
    return configs.where(F.lower("config").contains(contains.lower())) if contains else configs
