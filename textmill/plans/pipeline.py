"""Whole runs: manifest-driven ingest, normalise, dedup, mix report, tokenizer corpus, packing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import n_bytes, nfc_line
from textmill.operators import dedup, filters, mix, pack, reports, transforms
from textmill.plans.manifest import Manifest
from textmill.plans.tables import Tables
from textmill.sources import hub, jsonl


def ingest(m: Manifest, load: Callable[[dict], DataFrame], limit: int | None = None) -> Iterator[tuple[str, str, DataFrame]]:
    """(domain, source, documents) of the hub sources of a manifest, domains and sources in order; load turns a source's parameters into
    rows with `ord`. Sources of weight 0 are left out."""
    for domain in sorted(m.sources):
        for name, s in sorted(m.sources[domain].items()):
            if s.type != "hf_stream" or s.weight <= 0 or m.weights[domain] <= 0:
                continue
            p = hub.resolved(name, s.params)
            yield domain, name, hub.documents(
                load(p), name, domain, p["text_field"], p["id_field"], p["meta_fields"], p.get("limit", limit)
            )


def normalise(
    records: DataFrame, domain: str, source: str, license_tag: str | None = None, shard_size: int = 5000, language: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept documents with shard_id, shard manifest, drops by reason) of records with `ord`."""
    d = transforms.normalise(records, domain, source, license_tag)
    judged = filters.judged(d, filters.DEFAULT if language else filters.WITHOUT_LANGUAGE)
    judged = Tables(records.sparkSession, "normalise").save(judged, "judged")
    kept = reports.sharded(judged.where("drop_reason IS NULL").drop("drop_reason"), shard_size)
    return kept, reports.shard_manifest(kept), reports.drops(judged)


def mix_report(
    spark: SparkSession, m: Manifest, root: str | None = None, most_docs: int = 20000, samples: Callable[[dict], DataFrame] | None = None
) -> dict:
    """Measured sources, files read until most_docs are reached; samples of hub sources, if they can be had; shares of domains by both.
    Rows per file and per source come to the driver."""
    files = [
        (n, d, f) for d, ms in m.sources.items() for n, s in ms.items() if s.type in ("local_dir", "local_jsonl")
        for f in jsonl.under_root(s.paths, root)
    ]
    table = jsonl.file_stats(spark, spark.createDataFrame(files, "source string, domain string, file string"))
    used = [r.asDict() for r in mix.capped_files(table.withColumn("source", F.concat_ws("/", "domain", "source")), most_docs).collect()]
    report = {"sources": {}, "empty_files": sorted(f["file"] for f in used if not f["n_docs"]), "sampled": {}, "errors": {}}
    for d, ms in m.sources.items():
        for n, s in ms.items():
            own = [f for f in used if f["source"] == f"{d}/{n}"]
            if s.type in ("local_dir", "local_jsonl"):
                report["sources"][f"{d}/{n}"] = {
                    "n_docs": sum(f["n_docs"] for f in own), "chars": sum(f["total_chars"] for f in own),
                    "bytes": sum(f["total_bytes"] for f in own)
                }
            elif samples is not None:
                try:
                    r = samples(hub.resolved(n, s.params)).agg(
                        F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0)), F.coalesce(F.sum(n_bytes("text")), F.lit(0))
                    ).first()
                    report["sampled"][f"{d}/{n}"] = {"n_docs": r[0], "chars": r[1], "bytes": r[2]}
                except (ValueError, OSError) as e:
                    report["errors"][f"{d}/{n}"] = str(e)
    for name, parts in (("domain_shares", [report["sources"]]), ("domain_shares_with_samples", [report["sources"], report["sampled"]])):
        total = {
            d: {k: sum(v[k] for p in parts for s, v in p.items() if s.startswith(f"{d}/")) for k in ("chars", "bytes")}
            for d in sorted(m.sources)
        }
        whole = {k: sum(t[k] for t in total.values()) for k in ("chars", "bytes")}
        report[name] = {d: t | {f"share_{k}": t[k] / whole[k] if whole[k] else 0.0 for k in whole} for d, t in total.items()}
    return report


def tokenizer_corpus(
    docs: DataFrame, target_bytes: int, boost_code: float = 1.0, boost_math: float = 1.0, passes: int = 1, allow_missing: bool = False,
    n_numbers: int = 0, seed: int = 0
) -> DataFrame:
    """(domain, ord, text, bytes_used): lines in NFC by domain until budgets are filled; a second pass takes rows again where the first
    leaves a budget open. A domain without a byte is an error unless allowed. n_numbers lines of numbers are added as the domain `numbers`,
    beyond the budgets."""
    budgets = mix.boosted_budgets(target_bytes, boost_code, boost_math)
    d = docs.select(
        "ord", transforms.canonical_domain("domain", unknown=True).alias("domain"), nfc_line(F.coalesce("text", F.lit(""))).alias("text")
    )
    if passes > 1:
        span = (d.agg(F.coalesce(F.max("ord"), F.lit(0))).first()[0]) + 1
        d = d.withColumn(
            "epoch", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))
        ).withColumn("ord", F.col("ord") + F.col("epoch") * span).drop("epoch")
    out = mix.byte_budget(d, budgets).withColumn(
        "text", F.decode(F.substring(F.encode("text", "UTF-8"), F.lit(1), F.col("bytes_used").cast("int")), "UTF-8")
    ).select("domain", "ord", "text", "bytes_used")
    if not allow_missing:
        have = {r[0] for r in out.select("domain").distinct().collect()}
        if missing := sorted(set(budgets) - have):
            raise ValueError(f"no text for {missing}")
    if n_numbers:
        lines = [("numbers", i, x, len(x.encode())) for i, x in enumerate(mix.number_lines(n_numbers, seed))]
        out = out.unionByName(docs.sparkSession.createDataFrame(lines, "domain string, ord long, text string, bytes_used long"))
    return out


def packed(
    docs: DataFrame, tokenizer: pack.Tokenizer, weights: dict[str, float], source_weights: dict[str, dict[str, float]], tokens: int,
    seq_len: int = 4096, num_seqs: int | None = None, repeat: bool = False, mode: str = "both"
) -> DataFrame:
    """Dedup, mix about so many tokens, tokenise and pack documents with `ord`: rows as of pack.pack."""
    kept = dedup.kept(docs, dedup.decisions(docs, mode))
    shares = {(d, s): weights[d] * w for d, m in source_weights.items() for s, w in m.items() if d in weights}
    plan = mix.numbered(mix.interleaved(kept, shares, tokens, repeat), "at", "domain", "source", "ord")
    mixed = plan.select("mix_ord", "ord").join(kept, "ord")
    return pack.pack(pack.tokenised(mixed, tokenizer), seq_len, tokenizer.eos_id, num_seqs)
