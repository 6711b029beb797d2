"""Reports: manifests, histograms, yields, audits, tokenizer acceptance."""

from __future__ import annotations

import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import est_tokens, identifiers, n_bytes, placeholder, sci_numbers
from textmill.operators.transforms import canonical_domain
from textmill.sources import files


def sharded(docs: DataFrame, shard_size: int = 5000, block: int = 4096) -> DataFrame:
    """The rows with shard_id, shard_size rows by ord in each. Places are running counts over blocks of ord, not one sorted task, and
    texts do not go through them: a frame with texts, best a written one as it is read twice, meets its places by a join."""
    from textmill.operators.mix import running

    if "text" not in docs.columns:
        d = running(docs.withColumns({"_k": F.lit(0), "_one": F.lit(1)}), "_k", "ord", "_one", block)
        return d.withColumn("shard_id", F.floor(F.col("before") / shard_size)).drop("_k", "_one", "before")
    d = running(docs.select("ord", F.lit(0).alias("_k"), F.lit(1).alias("_one")), "_k", "ord", "_one", block)
    return docs.join(d.select("ord", F.floor(F.col("before") / shard_size).alias("shard_id")), "ord")


def sized(docs: DataFrame, chars_per_token: float = 4.0) -> DataFrame:
    """(ord, bytes, est_tokens): what a manifest needs of the texts."""
    return docs.select("ord", n_bytes("text").alias("bytes"), est_tokens("text", chars_per_token).alias("est_tokens"))


def shard_manifest(kept: DataFrame, chars_per_token: float = 4.0) -> DataFrame:
    """(shard_id, docs, bytes, est_tokens) of documents with shard_id, or of sized() ones."""
    d = kept if "est_tokens" in kept.columns else kept.withColumns(
        {"bytes": n_bytes("text"), "est_tokens": est_tokens("text", chars_per_token)}
    )
    return d.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("bytes").alias("bytes"), F.sum("est_tokens").alias("est_tokens")
    )


def drops(judged: DataFrame, *keys: str) -> DataFrame:
    return judged.where("drop_reason IS NOT NULL").groupBy(*keys, "drop_reason").agg(F.count(F.lit(1)).alias("n"))


def tokens_by(docs: DataFrame, *keys: str, chars_per_token: float = 4.0) -> DataFrame:
    return docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("docs"), F.sum(est_tokens("text", chars_per_token)).alias("est_tokens"))


def pack_manifest(docs: DataFrame) -> DataFrame:
    """(kind, name, docs, est_tokens) by domain and by source; sources of one name in several domains are one."""
    g = docs.withColumn("t", est_tokens("text")).groupingSets([["domain"], ["source"]], "domain", "source").agg(
        F.grouping("domain").alias("g"), F.count(F.lit(1)).alias("docs"), F.sum("t").alias("est_tokens")
    )
    return g.select(
        F.when(F.col("g") == 0, "domain").otherwise("source").alias("kind"),
        F.when(F.col("g") == 0, F.col("domain")).otherwise(F.col("source")).alias("name"), "docs", "est_tokens"
    )


def top_sources(docs: DataFrame, k: int = 10) -> DataFrame:
    return tokens_by(docs, "source").orderBy(F.desc("est_tokens"), "source").limit(k)


def worst(decided: DataFrame, k: int = 5) -> DataFrame:
    """The dropped rows of the lowest scores; those without a score last."""
    return decided.where(~F.col("keep")).orderBy(F.col("score").asc_nulls_last(), "doc_id").limit(k)


def report(shards: DataFrame, shard_drops: DataFrame, decided: DataFrame) -> dict:
    """Totals, by domain and source, drops by reason, dedup drops by reason, top sources and worst examples, as one dict.
    shards: (domain, source, docs, bytes, est_tokens); what comes to the driver is a row per domain, source or reason."""
    by = lambda k, v: {r[k]: r[v] for r in shards.groupBy(k).agg(F.sum(v).alias(v)).collect()}
    total = shards.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", "bytes", "est_tokens")]).first().asDict()
    tokens = by("source", "est_tokens")
    return total | {
        "by_domain": by("domain", "docs"), "by_domain_tokens": by("domain", "est_tokens"), "by_source": by("source", "docs"), "by_source_tokens": tokens,
        "drops": {r[0]: r[1] for r in shard_drops.groupBy("drop_reason").agg(F.sum("n")).collect()},
        "dedup_drops": {r[0]: r[1] for r in decided.where(~F.col("keep")).groupBy("reason").count().collect()},
        "top_sources_by_tokens": [{"source": s, "est_tokens": t} for s, t in sorted(tokens.items(), key=lambda x: -x[1])[:10]],
        "worst_examples": [r.asDict() for r in worst(decided).collect()],
    }


def write_json(report: dict, path: str) -> None:
    """A report as a file of any store, in place only when it is whole."""
    with files.Written(path) as f:
        f.write(json.dumps(report, indent=2, sort_keys=True, default=str, ensure_ascii=False).encode())


def histogram(docs: DataFrame, k: int = 50) -> DataFrame:
    """(kind, domain, docs, bytes): raw and canonical names, the k largest by bytes of each."""
    raw = docs.groupBy(F.coalesce("domain", F.lit("")).alias("domain")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(n_bytes("text")).alias("bytes")
    )
    canon = raw.groupBy(canonical_domain("domain").alias("domain")).agg(F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes"))
    top = lambda d, kind: d.orderBy(F.desc("bytes"), "domain").limit(k).select(
        F.lit(kind).alias("kind"), "domain", "docs", "bytes"
    )
    return top(raw, "raw").unionByName(top(canon, "canonical"))


def domain_yield(docs: DataFrame, most_lines: int | None = None, most_docs: int | None = None) -> DataFrame:
    """(domain, docs, avg_yield): characters per document, summed over its rows, then averaged. Caps, if given, count rows and distinct
    documents by ord."""
    from textmill.operators.mix import placed

    d = docs.select(
        "domain", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("line_"), F.col("ord").cast("string"))).alias("doc"), "ord",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars")
    )
    if most_lines is not None:
        d = placed(d, "ord", "domain").where(F.col("nth") <= most_lines).drop("nth")
    if most_docs is not None:
        # the place of a document is that of its first row; all up to the row that brings the last document in count
        first = placed(d.groupBy("domain", "doc").agg(F.min("ord").alias("first")), "first", "domain")
        last = first.where(F.col("nth") == most_docs).select("domain", F.col("first").alias("last"))
        d = d.join(F.broadcast(last), "domain", "left").where(F.col("last").isNull() | (F.col("ord") <= F.col("last")))
    return d.groupBy("domain", "doc").agg(F.sum("chars").alias("chars")).groupBy("domain").agg(
        F.count(F.lit(1)).alias("docs"), F.avg("chars").alias("avg_yield")
    )


def placeholders(docs: DataFrame) -> DataFrame:
    note = F.try_element_at("meta", F.lit("note")) if "meta" in docs.columns else F.lit(None).cast("string")
    licence = F.col("license_tag") if "license_tag" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", placeholder(licence, note, "text").alias("where")).where("`where` IS NOT NULL")


@lru_cache(4)
def _sentencepiece(model: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=model)


def _short(sp, found) -> list[int]:
    """How many of each row's strings take two tokens at most; each distinct string is encoded once."""
    distinct = list({x for xs in found for x in xs})
    short = {x: len(ids) <= 2 for x, ids in zip(distinct, sp.encode(distinct))} if distinct else {}
    return [sum(short[x] for x in xs) for xs in found]


def acceptance(
    samples: DataFrame, model: str, most_token_per_char: float = 0.6, most_byte_fallback: float = 0.08, least_ident: float = 0.7,
    least_sci: float = 0.6
) -> DataFrame:
    """(domain, token_per_char, byte_fallback_rate, ident_le2_rate, sci_le2_rate, samples, ok) of a sentencepiece model."""
    @F.pandas_udf("tokens long, fallback long, ident long, ident2 long, sci long, sci2 long")
    def evaluate(text: pd.Series, ident: pd.Series, sci: pd.Series) -> pd.DataFrame:
        sp = _sentencepiece(model)
        pieces = sp.encode(text.tolist(), out_type=str)
        return pd.DataFrame({
            "tokens": [len(p) for p in pieces], "fallback": [sum(x.startswith("<0x") and x.endswith(">") for x in p) for p in pieces],
            "ident": ident.map(len), "ident2": _short(sp, ident), "sci": sci.map(len), "sci2": _short(sp, sci),
        })

    d = samples.where("text IS NOT NULL AND text <> ''").withColumn("e", evaluate("text", identifiers("text"), sci_numbers("text")))
    g = d.groupBy(F.trim(F.coalesce("domain", F.lit("unknown"))).alias("domain")).agg(
        F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("samples"),
        *[F.sum(f"e.{c}").alias(c) for c in ("tokens", "fallback", "ident", "ident2", "sci", "sci2")]
    )
    rate = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    g = g.select(
        "domain", rate("tokens", "chars").alias("token_per_char"), rate("fallback", "tokens").alias("byte_fallback_rate"),
        rate("ident2", "ident").alias("ident_le2_rate"), rate("sci2", "sci").alias("sci_le2_rate"), "samples", "ident", "sci"
    )
    ok = (F.col("token_per_char") <= most_token_per_char) & (F.col("byte_fallback_rate") <= most_byte_fallback) & (
        (F.col("ident") == 0) | (F.col("ident_le2_rate") >= least_ident)
    ) & ((F.col("sci") == 0) | (F.col("sci_le2_rate") >= least_sci))
    return g.withColumn("ok", ok).drop("ident", "sci")
