"""Mixing domains and sources: weights, the token-aware sampler, budgets, shuffles, shares."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.text import est_tokens, n_bytes

# The target mix of the eight domains.
BASE_WEIGHTS = {
    "filtered_web": 0.30, "books_longform": 0.18, "reference": 0.08, "forums_qa": 0.10, "code_docs": 0.18, "math": 0.12,
    "tutorials_notebooks": 0.02, "paper_teasers": 0.02
}


def _all(c: str) -> Column:
    """The sum over all rows of a table that has a row per domain."""
    return F.sum(c).over(Window.partitionBy())


def validated(weights: dict[str, float], label: str) -> dict[str, float]:
    """Weights that sum to 1 within a millionth, divided by their sum."""
    total = sum(weights.values())
    if not weights:
        raise ValueError(f"no weights for {label}")
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"weights for {label} sum to {total:.6f} instead of 1")
    return {k: v / total for k, v in weights.items()} if total > 0 else weights


def yield_corrected(weights: DataFrame, yields: DataFrame) -> DataFrame:
    """(domain, weight) divided by the domain's avg_yield where there is a positive one, then normalised."""
    y = yields.select("domain", F.col("avg_yield").try_cast("double").alias("y"))
    w = weights.join(y, "domain", "left").withColumn(
        "weight", F.when(F.col("y") > 0, F.col("weight") / F.col("y")).otherwise(F.col("weight"))
    )
    return w.select("domain", (F.col("weight") / _all("weight")).alias("weight"))


def shares(docs: DataFrame) -> DataFrame:
    """(domain, docs, chars, bytes, share_chars, share_bytes)."""
    by = docs.groupBy("domain").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"),
        F.sum(n_bytes("text")).alias("bytes")
    )
    part = lambda a: F.when(_all(a) > 0, F.col(a) / _all(a)).otherwise(0.0)
    return by.select("domain", "docs", "chars", "bytes", part("chars").alias("share_chars"), part("bytes").alias("share_bytes"))


def against_target(docs: DataFrame, targets: dict[str, float] = BASE_WEIGHTS) -> DataFrame:
    """(domain, observed, target, delta) for every target domain, by rows; rows of other domains count in the total."""
    spark = docs.sparkSession
    t = spark.createDataFrame(list(targets.items()), "domain string, target double")
    counts = docs.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("domain", (F.col("n") / _all("n")).alias("share"))
    seen = t.join(counts, "domain", "left").withColumn("observed", F.coalesce("share", F.lit(0.0)))
    return seen.select("domain", "observed", "target", (F.col("observed") - F.col("target")).alias("delta"))


def capped_files(files: DataFrame, cap: int) -> DataFrame:
    """Rows (source, file, n_docs) of files to read: those before which the source has less than `cap` documents."""
    w = Window.partitionBy("source").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("n_docs").over(w), F.lit(0))).where(F.col("before") < cap)


def byte_budget(docs: DataFrame, budgets: dict[str, int], size="text") -> DataFrame:
    """Rows (domain, ord, ...) until each domain's budget of bytes is filled, with `bytes_used`; the row that overflows is cut to what is left.

    Running sums go over the sizes alone, first within blocks of rows of like ord, then over the blocks' totals, so a domain
    with most of the rows is no one task's work."""
    b = docs.sparkSession.createDataFrame(list(budgets.items()), "domain string, budget long")
    sized = docs.join(F.broadcast(b), "domain").withColumn("bytes", n_bytes(size) if isinstance(size, str) else size)
    before = running(sized, "domain", "ord", "bytes")
    return before.where((F.col("before") < F.col("budget"))).withColumn(
        "bytes_used", F.least("bytes", F.col("budget") - F.col("before"))
    ).where("bytes_used > 0").drop("budget")


def running(df: DataFrame, key: str, order: str, value: str, block: int = 4096) -> DataFrame:
    """The rows with `before`, the sum of `value` over the key's earlier rows. Blocks are ranges of an integral order column."""
    d = df.withColumn("_block", F.floor(F.col(order) / block))
    within = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy(key, "_block").agg(F.sum(value).alias("_sum"))
    above = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(key, "_block", F.coalesce(F.sum("_sum").over(above), F.lit(0)).alias("_above"))
    return d.withColumn(
        "_in", F.coalesce(F.sum(value).over(within), F.lit(0))
    ).join(totals, [key, "_block"]).withColumn("before", F.col("_above") + F.col("_in")).drop("_block", "_in", "_above")


def placed(df: DataFrame, order: str, *keys: str) -> DataFrame:
    """The rows with `nth`, their place from 1 among those of equal keys (null is a key) by an integral column. Counts run within blocks of
    rows, then over the blocks, so a key with a third of all rows is no one task's work."""
    key = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
    d = running(df.withColumns({"_key": key, "_one": F.lit(1)}), "_key", order, "_one")
    return d.withColumn("nth", F.col("before") + 1).drop("_key", "_one", "before")


def boosted_budgets(target_bytes: int, boost_code: float = 1.0, boost_math: float = 1.0) -> dict[str, int]:
    w = BASE_WEIGHTS | {"code_docs": BASE_WEIGHTS["code_docs"] * boost_code, "math": BASE_WEIGHTS["math"] * boost_math}
    return {k: int(target_bytes * v / sum(w.values())) for k, v in w.items()}


def number_lines(n: int, seed: int):
    """Lines of one number each, as it is written in a dozen ways, so that a tokenizer's corpus has digits in all their surroundings."""
    chance = random.Random(f"numbers:{seed}")
    for i in range(n):
        magnitude = int(10 ** chance.uniform(0, 12))
        small, minute = chance.randrange(1 << 16), chance.randrange(24 * 60)
        ways = (
            f"{magnitude:,}", f"{magnitude:o}", f"{magnitude / 7:.4g}", f"{small / 655.36:.2f} %", f"#{small:04x}",
            f"{minute // 60:02d}:{minute % 60:02d}", f"10^{len(str(magnitude))}", f"({small}, -{magnitude})", f"x_{i} = {magnitude % 1000}",
            f"{small} kg", f"§ {small % 400}", f"+{magnitude:012d}"
        )
        yield ways[i % len(ways)] + "\n"


def shuffled(docs: DataFrame, seed: int, key: str = "", epoch: int = 0) -> DataFrame:
    """The rows in an order that seed, key and epoch fix: a full shuffle, by a hash of doc_id."""
    return docs.orderBy(F.sha2(F.concat_ws(":", F.lit(f"{seed}:{key}:{epoch}"), F.col("doc_id").cast("string")), 256), "doc_id")


def sample_per_domain(docs: DataFrame, k: int, seed: int) -> DataFrame:
    """A uniform sample of k rows of each domain, the same for the same seed: the k least hashes."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    w = Window.partitionBy("domain").orderBy(h, "doc_id")
    return docs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


class _Shares:
    """Names with weights, and the tokens that each has had so far."""

    def __init__(self, weights: dict[str, float]):
        self.names = sorted(weights)
        self.weight = np.array([weights[n] for n in self.names])
        self.have = np.zeros(len(self.names))

    def behind(self, chance: random.Random) -> int:
        """Who is furthest below its share; of several, as at the begin, one by weighted chance."""
        lack = self.weight * self.have.sum() - self.have
        among = np.flatnonzero(lack == lack.max()) if self.have.any() else np.arange(len(self.names))
        if len(among) == 1:
            return int(among[0])
        reached = list(accumulate(self.weight[among].tolist()))
        return int(among[min(bisect_left(reached, chance.random() * reached[-1]), len(among) - 1)])


class Sampler:
    """Chooses a domain, then one of its sources, so that tokens follow the weights."""

    def __init__(self, domains: dict[str, float], sources: dict[str, dict[str, float]], seed: int = 0):
        self.chance = random.Random(seed)
        self.top, self.below = _Shares(domains), {d: _Shares(w) for d, w in sources.items()}

    def next(self) -> tuple[str, str]:
        d = self.top.names[self.top.behind(self.chance)]
        own = self.below[d]
        return d, own.names[own.behind(self.chance)]

    def took(self, domain: str, source: str, tokens: int) -> None:
        for shares, name in ((self.top, domain), (self.below[domain], source)):
            shares.have[shares.names.index(name)] += tokens


def sampler_plan(
    docs: DataFrame, domains: dict[str, float], sources: dict[str, dict[str, float]], n: int, seed: int = 0, repeat: bool = False,
    chars_per_token: float = 4.0
) -> DataFrame:
    """(mix_ord, ord, epoch, domain, source, est_tokens) of n documents in the order in which the sampler takes them.

    A choice depends on all before it, so it is made on the driver, from one integer per document that can be taken:
    the first n of a source at most, so n bounds what comes to the driver; interleaved() is for mixes of any size. A source
    that runs out begins anew with `repeat`, else it is an error."""
    pairs = [(d, s) for d, m in sources.items() for s in m]
    first = docs.where(
        F.concat_ws("\x01", "domain", "source").isin(["\x01".join(p) for p in pairs])
    ).select("domain", "source", "ord", est_tokens("text", chars_per_token).alias("t"))
    first = placed(first, "ord", "domain", "source").where(F.col("nth") <= n)
    queue = {
        (r["domain"], r["source"]): r["rows"]
        for r in first.groupBy("domain", "source").agg(F.array_sort(F.collect_list(F.struct("ord", "t"))).alias("rows")).toLocalIterator()
    }
    sampler, at, out = Sampler(domains, sources, seed), dict.fromkeys(pairs, 0), []
    while len(out) < n:
        d, s = sampler.next()
        rows, k = queue.get((d, s), []), at[d, s]
        if not rows or k >= len(rows) and not repeat:
            raise ValueError(f"source {d}/{s} has no more than {len(rows)} documents")
        epoch, i = divmod(k, len(rows))
        out.append((len(out), rows[i]["ord"], epoch, d, s, rows[i]["t"]))
        at[d, s] = k + 1
        sampler.took(d, s, rows[i]["t"])
    return docs.sparkSession.createDataFrame(out, "mix_ord long, ord long, epoch int, domain string, source string, est_tokens long")


def interleaved(
    docs: DataFrame, weights: dict[tuple[str, str], float], tokens: int, repeat: bool = False, chars_per_token: float = 4.0
) -> DataFrame:
    """(domain, source, ord, epoch, est_tokens, at): the mix of about `tokens` tokens, in the order of `at`, then domain, source and ord.

    A document stands where its source's tokens before it, divided by the source's weight, put it: the source that is furthest
    behind its share comes next, without any state. Only totals per source come to the driver, the sums are by blocks of
    rows, so the mix can be of any size. A source with too few tokens begins anew with `repeat`, else it is an error."""
    spark, total = docs.sparkSession, sum(weights.values())
    if total <= 0 or min(weights.values()) < 0:
        raise ValueError("no weight, or a negative one")
    shares = spark.createDataFrame(
        [(d, s, w / total) for (d, s), w in weights.items() if w > 0], "domain string, source string, weight double"
    )
    sized = docs.select(
        "domain", "source", "ord", est_tokens("text", chars_per_token).alias("est_tokens")
    ).join(F.broadcast(shares), ["domain", "source"])
    sized = sized.withColumn("_key", F.to_json(F.array("domain", "source")))
    have = {(r["domain"], r["source"]): r["t"] for r in sized.groupBy("domain", "source").agg(F.sum("est_tokens").alias("t")).collect()}
    for (d, s), w in weights.items():
        if w > 0 and (not have.get((d, s)) or have[d, s] < w / total * tokens and not repeat):
            raise ValueError(f"source {d}/{s} has {have.get((d, s), 0)} tokens of {w / total * tokens:.0f}")
    totals = spark.createDataFrame([(d, s, t) for (d, s), t in have.items()], "domain string, source string, whole long")
    before = running(sized, "_key", "ord", "est_tokens").join(F.broadcast(totals), ["domain", "source"])
    last = F.floor((F.col("weight") * tokens - F.col("before")) / F.col("whole"))
    rows = before.where(F.col("before") < F.col("weight") * tokens).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    at = (F.col("epoch") * F.col("whole") + F.col("before")) / F.col("weight")
    return rows.select(
        "domain", "source", "ord", F.col("epoch").cast("int").alias("epoch"), "est_tokens", at.alias("at")
    ).where(F.col("at") < tokens)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with mix_ord, their place from 0 by some columns: a sort by range, counts per task, and the place within it."""
    d = rows.orderBy(*order).withColumn("_task", F.spark_partition_id()).withColumn(
        "_nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    from textmill.plans.tables import Tables

    d = Tables(rows.sparkSession, "numbered").save(d, "sorted")
    counts = d.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    above = counts.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_above"))
    return d.join(F.broadcast(above), "_task").withColumn("mix_ord", F.col("_above") + F.col("_nth")).drop("_task", "_nth", "_above")


def chance_seed(seed: int, key: str, epoch: int) -> int:
    """A seed for one pass over one source."""
    return int(hashlib.blake2b(f"{seed}:{key}:{epoch}".encode(), digest_size=8).hexdigest(), 16) % (2**31 - 1)
