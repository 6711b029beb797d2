"""Queries over the driver's tables, and the same in DuckDB SQL.

Documents stand for normalised ones: lang is the domain, doc_id the order; ids are strings where they are compared as such.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.functions import text as X
from textmill.functions.simhash import fingerprints
from textmill.operators import dedup, filters, mix, pack, reports, transforms
from textmill.plans import dedup_run, manifest
from textmill.plans.tables import Tables
from textmill.sources import dumps, hub, jsonl, packs
from textmill.streaming import exact

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a query by its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "source",
        F.col("lang").alias("domain")
    )


# --- SQL parts
T = "coalesce(text, '')"
TOKENS = f"greatest(1, round_even(length({T}) / 4.0, 0))::BIGINT"
COLLAPSED = rf"trim(regexp_replace({T}, '\s+', ' ', 'g'))"
_SOURCE = "SELECT doc_id AS ord, doc_id::VARCHAR AS doc_id, coalesce(text, '') AS text, source, lang AS domain FROM documents"


def _reason(ascii_rule: bool) -> str:
    rule = r"WHEN length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / greatest(length(text), 1) < 0.8 THEN 'low_ascii_ratio'" if ascii_rule else ""
    return rf"""
WITH d AS ({_SOURCE}),
line AS (SELECT ord, trim(unnest(string_split_regex(text, '\r\n|[\n\r\x0b\x0c]')), ' ' || chr(9) || chr(28) || chr(29)) AS l FROM d),
freq AS (SELECT ord, l, count(*) AS n FROM line WHERE l <> '' GROUP BY ord, l),
rep AS (SELECT ord, sum(n) >= 6 AND max(n) / sum(n) > 0.3 AS r FROM freq GROUP BY ord),
judged AS (SELECT d.*, CASE WHEN length(text) < 200 THEN 'too_short' WHEN length(text) > 1000000 THEN 'too_long' {rule}
  WHEN length(regexp_replace(text, '[\p{{L}}\p{{N}}\s]', '', 'g')) / greatest(length(text), 1) > 0.45 THEN 'symbol_ratio'
  WHEN coalesce(r, false) THEN 'boilerplate_repeat' WHEN regexp_matches(lower(text), '{"|".join(filters.PHRASES)}') THEN 'boilerplate_phrase'
  WHEN regexp_matches(text, '(?i)\b(?:{"|".join(filters.TOXIC_WORDS)})\b') THEN 'toxicity' END AS drop_reason FROM d LEFT JOIN rep ON d.ord = rep.ord)"""


_SUMMARY = "SELECT coalesce(drop_reason, 'keep') AS outcome, count(*) AS docs, sum(strlen(text))::BIGINT AS bytes, sum(" + TOKENS + ")::BIGINT AS est_tokens FROM judged GROUP BY 1"


def _summary(d: DataFrame) -> DataFrame:
    return d.groupBy(F.coalesce("drop_reason", F.lit("keep")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(X.n_bytes("text")).alias("bytes"), F.sum(X.est_tokens("text")).alias("est_tokens")
    )


# --- filters
@query(_reason(True) + "SELECT ord AS doc_id, drop_reason FROM judged")
def filter_reasons(spark, sf):
    return filters.judged(docs(spark, sf)).select(F.col("ord").alias("doc_id"), "drop_reason")


@query(_reason(True) + _SUMMARY)
def filter_summary(spark, sf):
    return _summary(filters.judged(docs(spark, sf)))


@query(_reason(False) + _SUMMARY)
def filter_no_lang(spark, sf):
    return _summary(filters.judged(docs(spark, sf), filters.WITHOUT_LANGUAGE))


@query(
    _reason(True) + ", l AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) SELECT coalesce(drop_reason, 'keep') AS outcome, quality, toxic, count(*) AS docs FROM judged JOIN l ON judged.ord = l.doc_id GROUP BY ALL"
)
def filter_vs_labels(spark, sf):
    labels = table(spark, sf, "labels").groupBy(F.col("doc_id").alias("ord")).agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    judged = filters.judged(docs(spark, sf)).select("ord", F.coalesce("drop_reason", F.lit("keep")).alias("outcome"))
    return judged.join(labels, "ord").groupBy("outcome", "quality", "toxic").agg(F.count(F.lit(1)).alias("docs"))


# --- scalars
@query(f"SELECT lang AS domain, count(*) AS docs, sum({TOKENS})::BIGINT AS est_tokens FROM documents GROUP BY 1")
def est_tokens_by_domain(spark, sf):
    return reports.tokens_by(docs(spark, sf), "domain")


@query(f"SELECT source, count(*) AS docs, sum({TOKENS})::BIGINT AS est_tokens FROM documents GROUP BY 1")
def est_tokens_by_source(spark, sf):
    return reports.tokens_by(docs(spark, sf), "source")


_REP = f"""WITH d AS ({_SOURCE}), t AS (SELECT ord, text, [x FOR x IN string_split({COLLAPSED}, ' ') IF x <> ''][1:4000] AS w FROM d),
r AS (SELECT ord, text, CASE WHEN len(w) < 3 THEN 0.0 ELSE 1.0 - len(list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) / (len(w) - 2) END AS rep FROM t)"""


@query(_REP + "SELECT ord AS doc_id, round(rep, 6) AS ratio FROM r")
def repetition_3gram(spark, sf):
    return docs(spark, sf).select(F.col("ord").alias("doc_id"), F.round(X.repetition_3gram("text"), 6).alias("ratio"))


_PRINTABLE = r"(length(text) - length(regexp_replace(regexp_replace(text, '[^\p{C}\p{Z}]', '', 'g'), ' ', '', 'g'))) / length(text)"


@query(
    f"SELECT doc_id, CASE WHEN length(text) > 0 THEN round({_PRINTABLE}, 6) ELSE 0.0 END AS ratio FROM (SELECT doc_id, {T} AS text FROM documents)"
)
def printable_ratio(spark, sf):
    return docs(spark, sf).select(F.col("ord").alias("doc_id"), F.round(X.printable_ratio("text"), 6).alias("ratio"))


_QUALITY = rf"""{_REP}, q AS (SELECT ord, text, CASE WHEN length(text) = 0 THEN -10.0 ELSE least(length(text) / 1000.0, 5.0) - CASE WHEN length(text) < 200 THEN 2.0 ELSE 0.0 END
  - CASE WHEN length(text) > 20000 THEN least((length(text) - 20000) / 20000.0, 2.0) ELSE 0.0 END + ({_PRINTABLE} - 0.85) * 2.0 - rep * 2.0 END AS score FROM r)"""


@query(_QUALITY + "SELECT ord AS doc_id, round(score, 6) AS score FROM q")
def quality_score(spark, sf):
    return docs(spark, sf).select(F.col("ord").alias("doc_id"), F.round(X.quality_score("text"), 6).alias("score"))


@query(
    f"SELECT page_id, CASE WHEN regexp_matches(lower(url), '{'|'.join(h.replace('.', '[.]') for h in X.LOW_SIGNAL_HOSTS)}') THEN -0.5 ELSE 0.0 END AS penalty FROM pages"
)
def url_penalty(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.url_penalty("url").alias("penalty"))


@query(
    "SELECT page_id, CASE WHEN s = '' THEN 'unknown' ELSE s END AS name FROM (SELECT page_id, regexp_replace(coalesce(url, ''), '[^A-Za-z0-9._-]+', '_', 'g') AS s FROM pages)"
)
def safe_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.safe_name("url").alias("name"))


@query(
    r"SELECT doc_id, least(50, len([x FOR x IN regexp_extract_all(text, '[\p{L}\p{N}_]+') IF regexp_full_match(x, '[A-Za-z_][A-Za-z0-9_]*')]))::INT AS n_ident, len(regexp_extract_all(text, '(?i)\b(\d+(?:\.\d+)?e[+-]?\d+)\b', 1)[1:20])::INT AS n_sci FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)"
)
def ident_sci_counts(spark, sf):
    return docs(spark, sf).select(
        F.col("ord").alias("doc_id"), F.size(X.identifiers("text")).alias("n_ident"), F.size(X.sci_numbers("text")).alias("n_sci")
    )


_HTML = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({0}, ''), '(?s)<pre><code>(.*?)</code></pre>', '\1', 'g'), '(?s)<code>(.*?)</code>', '\1', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT page_id, {_HTML.format('html')} AS text FROM pages")
def strip_html_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.strip_html("html").alias("text"))


@query(
    r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?s)\{\{.*?\}\}', ' ', 'g'), '\[\[(?:[^\]|]+\|)?([^\]]+)\]\]', '\1', 'g'), '''''+', '', 'g'), '(?s)<ref[^>]*>.*?</ref>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages"
)
def strip_wikitext_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.strip_wikitext("html").alias("text"))


# --- records to documents
@query(
    f"SELECT page_id::VARCHAR AS doc_id, {_HTML.format('html')} AS text, 'pages' AS source, 'filtered_web' AS domain, url FROM pages WHERE html <> ''"
)
def normalise_pages(spark, sf):
    records = table(spark, sf, "pages").select(F.col("page_id").alias("id"), X.strip_html("html").alias("content"), "url")
    made = transforms.normalise(records, "filtered_web", "pages").where("text <> ''")
    return made.select("doc_id", "text", "source", "domain", F.try_element_at("meta", F.lit("url")).alias("url"))


_QA = rf"""WITH c AS (SELECT conv_id, turn, role, text FROM conversations),
q AS (SELECT conv_id, arg_min(text, turn) AS body FROM c WHERE role = 'user' GROUP BY 1),
a AS (SELECT conv_id, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY length({T}) DESC, turn) AS r FROM c WHERE role = 'assistant') WHERE r = 1)
SELECT q.conv_id::VARCHAR AS doc_id, trim('Q: ' || chr(10) || {_HTML.format('q.body')} || chr(10) || 'A: ' || {_HTML.format('a.text')}, ' ' || chr(10)) AS text FROM q LEFT JOIN a ON q.conv_id = a.conv_id"""


@query(_QA)
def qa_pairs(spark, sf):
    """The first question of each conversation with its longest answer, as posts are assembled."""
    c = table(spark, sf, "conversations")
    first = c.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("Body"), F.min("turn").alias("turn"))
    order = F.col("conv_id") * 100000 + F.col("turn")
    q = first.select(
        F.col("conv_id").cast("string").alias("Id"), F.lit("1").alias("PostTypeId"), F.lit(None).cast("string").alias("ParentId"), "Body",
        F.lit(0).alias("Score"), order.alias("ord")
    )
    a = c.where("role = 'assistant'").select(
        F.concat(F.lit("a"), order.cast("string")).alias("Id"), F.lit("2").alias("PostTypeId"),
        F.col("conv_id").cast("string").alias("ParentId"), F.col("text").alias("Body"),
        F.length(F.coalesce("text", F.lit(""))).alias("Score"), order.alias("ord")
    )
    return transforms.stackexchange(q.unionByName(a)).select("doc_id", "text")


@query(
    f"SELECT doc_id::VARCHAR || '::chunk' || i AS doc_id, i::INT AS chunk_index, (i * 800)::INT AS chunk_start, substr(text, i * 800 + 1, 1000) AS text FROM (SELECT doc_id, {T} AS text, unnest(range(0, ((length({T}) + 799) // 800))) AS i FROM documents)"
)
def chunk_documents(spark, sf):
    return transforms.chunk(docs(spark, sf), 1000, 200).select("doc_id", "chunk_index", "chunk_start", "text")


@query(f"SELECT doc_id, substr({T}, 1, 300) AS text FROM documents")
def truncate_documents(spark, sf):
    return transforms.truncate(docs(spark, sf), 300).select(F.col("ord").alias("doc_id"), "text")


# --- dedup
_KEPT = f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {{}}md5({COLLAPSED}) ORDER BY doc_id) AS r FROM documents) WHERE r = 1"


@query(_KEPT.format(""))
def exact_dedup_global(spark, sf):
    return dedup.exact_kept(docs(spark, sf), "global").select(F.col("ord").alias("doc_id"))


@query(_KEPT.format("lang, source, "))
def exact_dedup_per_source(spark, sf):
    return dedup.exact_kept(docs(spark, sf), "per-source").select(F.col("ord").alias("doc_id"))


@query(f"""SELECT doc_id, r = 1 AS keep, CASE WHEN r = 1 THEN 'keep' ELSE 'exact_dup' END AS reason, CASE WHEN r > 1 THEN f END AS dup_of FROM
(SELECT doc_id, row_number() OVER w AS r, first_value(doc_id) OVER w AS f FROM documents WINDOW w AS (PARTITION BY md5({COLLAPSED}) ORDER BY doc_id))""")
def exact_dedup_decisions(spark, sf):
    return dedup.exact_decisions(docs(spark, sf), "global", with_hash=False).select(
        F.col("ord").alias("doc_id"), "keep", "reason", F.col("dup_of").cast("long").alias("dup_of")
    )


@query(_QUALITY + f"""SELECT ord AS doc_id, n AS group_size FROM (SELECT ord, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY round(score, 6) DESC, ord DESC) AS r
FROM (SELECT ord, score, md5({COLLAPSED}) AS k FROM q)) WHERE r = 1""")
def best_of_exact_group(spark, sf):
    key = F.sha2(X.collapse("text"), 256)
    d = docs(spark, sf).select("ord", key.alias("k"), F.round(X.quality_score("text"), 6).alias("score"))
    return d.groupBy("k").agg(F.max_by("ord", F.struct("score", "ord")).alias("doc_id"), F.count(F.lit(1)).alias("group_size")).drop("k")


@query()
def near_dedup_best(spark, sf):
    return dedup.near_decisions(docs(spark, sf), "both", "global", "best")


@query()
def near_dedup_first(spark, sf):
    return dedup.near_decisions(docs(spark, sf), "near", "global", "first")


@query()
def near_dedup_greedy(spark, sf):
    return dedup.greedy(docs(spark, sf))


@query()
def near_pairs(spark, sf):
    """Fingerprints of documents within 3 bits of each other, by their first documents, with how many documents have each."""
    prints = docs(spark, sf).select("ord", fingerprints()("text")["fp"].alias("fp")).groupBy("fp").agg(
        F.min("ord").alias("first"), F.count(F.lit(1)).alias("n")
    ).select(F.lit("").alias("scope"), "first", "fp", "n")
    prints = Tables(spark, "prints").save(prints, "prints")
    pairs = dedup.band_pairs(prints.drop("n"), 3).groupBy("a", "b").agg(F.min("band").alias("band"), F.min("distance").alias("distance"))
    size = lambda k: prints.select(F.col("first").alias(k), F.col("n").alias(f"n_{k}"))
    return pairs.join(size("a").hint("merge"), "a").join(size("b").hint("merge"), "b")


@query()
def near_dedup_stats(spark, sf):
    return dedup.stats(dedup.near_decisions(docs(spark, sf), "both", "per-source", "best"))


_BANDS = """WITH p AS (SELECT o_custkey AS c, o_orderkey % 8 AS low, min(o_orderkey) AS first FROM orders GROUP BY 1, 2)
SELECT a.first AS a, b.first AS b, k AS band, bit_count(xor(a.low, b.low))::INT AS distance FROM p a JOIN p b ON a.c = b.c AND a.first > b.first, (SELECT unnest([1, 2, 3])::INT AS k)"""


@query(_BANDS)
def hamming_band_join(spark, sf):
    """Fingerprints made of a hash of the customer, with the lowest three bits from the order's number."""
    o = table(spark, sf, "orders")
    high = F.conv(F.substring(F.md5(F.col("o_custkey").cast("string")), 1, 15), 16, 10).cast("long")
    fp = high.bitwiseAND(F.lit(~7)).bitwiseOR(F.col("o_orderkey") % 8)
    prints = o.groupBy(F.array(fp).alias("fp")).agg(F.min("o_orderkey").alias("first")).select(F.lit("").alias("scope"), "first", "fp")
    return dedup.band_pairs(prints, 3).select("a", "b", "band", "distance")


#: Twelve documents in a row share a base; two of them each have the same fingerprint, the next two differ by two bits more.
_FLIPS = [sum(1 << 6 * j for j in range(2 * k)) for k in range(6)]
_LIVE = "(SELECT * FROM g WHERE ord = copy_of)"
_CHAINS = _QUALITY.replace("WITH", "WITH RECURSIVE", 1) + f""", fp AS (SELECT ord, text, score, md5({COLLAPSED}) AS k, len([x FOR x IN string_split({COLLAPSED}, ' ') IF x <> '']) AS words,
  xor(('0x' || substr(md5((ord // 12)::VARCHAR), 1, 15))::BIGINT, {_FLIPS}[(ord // 2) % 6 + 1]::BIGINT) AS fp FROM q),
g AS (SELECT *, min(ord) OVER (PARTITION BY k) AS copy_of FROM fp),
key AS (SELECT ord, fp, i AS band, (fp >> (16 * i)::INT) & 65535 AS key FROM @live, (SELECT unnest(range(4)) AS i)),
pair AS (SELECT a.ord AS a, b.ord AS b, band, bit_count(xor(a.fp, b.fp))::INT AS distance FROM key a JOIN key b USING (band, key) WHERE a.ord > b.ord AND bit_count(xor(a.fp, b.fp)) <= 3)"""
_MATCHED = """, match AS (SELECT a AS ord, b AS match_ord, distance FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY band, b) AS r FROM pair) WHERE r = 1),
root AS (SELECT ord, ord AS root FROM @live WHERE ord NOT IN (SELECT ord FROM match) UNION ALL SELECT match.ord, root.root FROM match JOIN root ON match_ord = root.ord)"""
_BEST = _CHAINS.replace("@live", _LIVE) + _MATCHED.replace("@live", _LIVE) + """,
ranked AS (SELECT ord, root, row_number() OVER (PARTITION BY root ORDER BY score DESC, words DESC, ord::VARCHAR DESC) AS r, count(*) OVER (PARTITION BY root) AS n FROM root JOIN g USING (ord)),
decided AS (SELECT ord AS doc_id, coalesce(r.r = 1, false) AS keep, CASE WHEN r.r IS NULL THEN 'exact_dup' WHEN r.r > 1 THEN 'near_dup' WHEN n > 1 THEN 'keep_best' ELSE 'keep' END AS reason,
  CASE WHEN r.r IS NULL THEN copy_of WHEN r.r > 1 THEN best.ord END AS dup_of, r.root AS cluster_id, n::INT AS cluster_size, match_ord AS match_id, distance
  FROM g LEFT JOIN ranked r USING (ord) LEFT JOIN (SELECT ord, root FROM ranked WHERE r = 1) best ON best.root = r.root LEFT JOIN match USING (ord))"""
_DECIDED = ["doc_id", "keep", "reason", "dup_of", "cluster_id", "cluster_size", "match_id", "distance"]


def _chained(spark, sf) -> tuple[DataFrame, F.Column]:
    base = F.conv(F.substring(F.md5(F.floor(F.col("ord") / 12).cast("string")), 1, 15), 16, 10).cast("long")
    flips = F.element_at(F.array(*map(F.lit, _FLIPS)), (F.floor(F.col("ord") / 2) % 6 + 1).cast("int")).cast("long")
    fp = F.array(base.bitwiseXOR(flips))
    return docs(spark, sf), F.struct(fp.alias("fp"), F.length("text").alias("norm_len"), F.size(X.tokens("text")).alias("n_tokens"))


def _ids(d: DataFrame) -> DataFrame:
    return d.withColumns({c: F.col(c).cast("long") for c in ("doc_id", "dup_of", "cluster_id", "match_id") if c in d.columns})


@query(_BEST + "SELECT * FROM decided")
def simhash_best(spark, sf):
    """Exact copies go, then of each cluster all but the best, over made-up fingerprints: chains of matches longer than the threshold."""
    d, fp = _chained(spark, sf)
    return _ids(dedup.near_decisions(d, "both", "global", "best", prints=fp).select(*_DECIDED))


@query(_CHAINS.replace("@live", "g") + _MATCHED.replace("@live", "g") + """
SELECT ord AS doc_id, match_ord IS NULL AS keep, CASE WHEN match_ord IS NULL THEN 'keep' ELSE 'near_dup' END AS reason, CASE WHEN match_ord IS NOT NULL THEN root END AS dup_of, root AS cluster_id,
  (count(*) OVER (PARTITION BY root ORDER BY ord ROWS UNBOUNDED PRECEDING))::INT AS cluster_size, match_ord AS match_id, distance FROM root LEFT JOIN match USING (ord)""")
def simhash_first(spark, sf):
    """The same without exact copies; of each cluster the first stays, sizes are running ones."""
    d, fp = _chained(spark, sf)
    return _ids(dedup.near_decisions(d, "near", "global", "first", prints=fp).select(*_DECIDED))


@query(_BEST + "SELECT keep, reason, count(*) AS n FROM decided GROUP BY 1, 2")
def simhash_stats(spark, sf):
    d, fp = _chained(spark, sf)
    return dedup.stats(dedup.near_decisions(d, "both", "global", "best", prints=fp))


@query(_CHAINS.replace("@live", _LIVE) + """, o AS (SELECT ord, fp, row_number() OVER (ORDER BY ord) AS r FROM g WHERE ord = copy_of),
w AS (SELECT 0::BIGINT AS r, []::BIGINT[] AS kept UNION ALL SELECT o.r, CASE WHEN len([x FOR x IN w.kept IF bit_count(xor(x, o.fp)) <= 3]) > 0 THEN w.kept ELSE w.kept || [o.fp] END FROM w JOIN o ON o.r = w.r + 1),
last AS (SELECT kept FROM w ORDER BY r DESC LIMIT 1),
s AS (SELECT min(ord) AS ord FROM o WHERE list_contains((SELECT kept FROM last), fp) GROUP BY fp),
hit AS (SELECT a AS ord, b, distance FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY band, b) AS r FROM pair JOIN s ON b = s.ord) WHERE r = 1)
SELECT g.ord AS doc_id, s.ord IS NOT NULL AS keep, CASE WHEN g.ord <> copy_of THEN 'exact_dup' WHEN s.ord IS NULL THEN 'near_dup' ELSE 'keep' END AS reason,
  CASE WHEN g.ord <> copy_of THEN copy_of WHEN s.ord IS NULL THEN b END AS dup_of, CASE WHEN g.ord <> copy_of THEN 0 WHEN s.ord IS NULL THEN distance END AS score FROM g LEFT JOIN s ON s.ord = g.ord LEFT JOIN hit ON hit.ord = g.ord""")
def simhash_greedy(spark, sf):
    """Only kept documents are indexed."""
    d, fp = _chained(spark, sf)
    return _ids(dedup.greedy(d, prints=fp).drop("ord"))


@query(
    f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5({COLLAPSED}) ORDER BY doc_id) AS r FROM documents) WHERE r = 1"
)
def dedup_run_kept(spark, sf):
    """What a run into a folder keeps, read from there."""
    _, kept, _ = dedup_run.run(docs(spark, sf), Tables(spark, "run").at, [sf], mode="exact", scope="global")
    return kept.select(F.col("ord").alias("doc_id"))


@query(_reason(True) + f", k AS (SELECT md5({COLLAPSED}) AS k FROM judged WHERE drop_reason IS NULL) SELECT DISTINCT k AS digest FROM k")
def stream_distinct(spark, sf):
    """Texts of a stream that passes the filters, each once."""
    out = Tables(spark, "stream").at
    docs(spark, sf).write.parquet(f"{out}/in")
    schema = spark.read.parquet(f"{out}/in").schema
    exact.filtered_stream(spark.readStream.schema(schema).parquet(f"{out}/in"), f"{out}/out", f"{out}/state").awaitTermination()
    return spark.read.schema(schema).parquet(f"{out}/out").select(F.md5(X.collapse("text")).alias("digest"))


# --- written and read again
def _shards(spark, sf) -> tuple[DataFrame, DataFrame, str]:
    """Documents that pass the filters, the files of shards of 100 they were written to, and their folder. Documents are judged once
    and written, as shards and manifests read them several times."""
    out, tables = Tables(spark, "shards").at, Tables(spark, "shards")
    kept = tables.save(filters.kept(docs(spark, sf)), "kept")
    return kept, tables.save(jsonl.write_shards(reports.sharded(kept, 100), out), "files"), out


@query(
    _reason(True) + ", k AS (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS r FROM judged WHERE drop_reason IS NULL) SELECT doc_id, text, source, domain, r // 100 AS shard, r % 100 AS place FROM k"
)
def jsonl_shards(spark, sf):
    """Compressed shards, read in order."""
    _, files, _ = _shards(spark, sf)
    back = jsonl.read(spark, [r.path for r in files.collect()], "doc_id string, text string, source string, domain string")
    shard = F.shiftright("ord", 43)
    return back.select(
        "doc_id", "text", "source", "domain", shard.alias("shard"),
        (F.row_number().over(Window.partitionBy(shard).orderBy("ord")) - 1).cast("long").alias("place")
    )


@query(_reason(True) + f""", k AS (SELECT *, (row_number() OVER (ORDER BY ord) - 1) // 100 AS s FROM judged WHERE drop_reason IS NULL)
SELECT printf('shard_%05d.jsonl.zst', s) AS file, count(*) AS docs, sum(strlen(text))::BIGINT AS bytes, sum({TOKENS})::BIGINT AS est_tokens FROM k GROUP BY s""")
def jsonl_manifests(spark, sf):
    """Manifests beside the shards, read again."""
    kept, _, out = _shards(spark, sf)
    jsonl.write_manifests(
        reports.shard_manifest(reports.sharded(reports.sized(kept), 100)),
        spark.createDataFrame([], "shard_id long, drop_reason string, n long"), out, "d", "s"
    )
    schema = "shard_path string, counts struct<docs: long, bytes: long, est_tokens: long>"
    return spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", "*.manifest.json").json(out).select(
        F.substring_index("shard_path", "/", -1).alias("file"), "counts.*"
    )


@query(_reason(True) + """, k AS (SELECT *, (row_number() OVER (ORDER BY ord) - 1) // 100 AS s FROM judged WHERE drop_reason IS NULL)
SELECT printf('shard_%05d.jsonl.zst', s) AS file, count(*) AS n_docs, sum(length(text))::BIGINT AS total_chars, 0::BIGINT AS n_bad FROM k GROUP BY s""")
def jsonl_file_stats(spark, sf):
    _, files, _ = _shards(spark, sf)
    listed = files.select(F.lit("s").alias("source"), F.lit("d").alias("domain"), F.regexp_replace("path", "^file:/*", "/").alias("file"))
    return jsonl.file_stats(spark, listed).select(F.element_at(F.split("file", "/"), -1).alias("file"), "n_docs", "total_chars", "n_bad")


@query(
    "SELECT regexp_replace(lang || '/' || source, '[^A-Za-z0-9._-]+', '_', 'g') AS domain_safe, doc_id::VARCHAR AS doc_id FROM documents"
)
def split_files(spark, sf):
    """Lines in folders by domain, read again; every other line is no JSON and left out."""
    lines = docs(spark, sf).select(F.to_json(F.struct("doc_id", F.concat_ws("/", "domain", "source").alias("domain"))).alias("value"))
    out = f"{Tables(spark, 'split').at}/split"
    jsonl.split_by_domain(lines.select(F.explode(F.array("value", F.substring("value", 1, 9))).alias("value")), out)
    return spark.read.schema("value string, domain_safe string").text(out).select(
        "domain_safe", F.get_json_object("value", "$.doc_id").alias("doc_id")
    )


@query("SELECT 2 * count(*) AS lines, count(*) AS bad FROM documents")
def split_bad_lines(spark, sf):
    lines = docs(spark, sf).select(F.to_json(F.struct("doc_id", "domain")).alias("value"))
    return jsonl.bad_lines(lines.select(F.explode(F.array("value", F.substring("value", 1, 9))).alias("value")), fast=True)


@query(f"SELECT doc_id::VARCHAR AS doc_id, {T} AS text FROM documents")
def repaired_lines(spark, sf):
    """Lines whose strings hold raw line ends, repaired and read."""
    out = Tables(spark, "repair").at
    broken = F.regexp_replace(F.to_json(F.struct("doc_id", "text")), r"(?<!\\)\\n", "\n")
    docs(spark, sf).select(broken.alias("value")).write.text(f"{out}/broken")
    files = [
        r.f
        for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{out}/broken").select(F.col("path").alias("f")).collect()
    ]
    jsonl.repair(spark, files, f"{out}/good").write.format("noop").mode("overwrite").save()
    good = [f"{out}/good/{f.rsplit('/', 1)[1]}.zst" for f in files]
    return jsonl.read(spark, good, "doc_id string, text string").drop("ord")


@query(_QA)
def posts_xml(spark, sf):
    """Conversations as posts in XML, read and assembled. Scores leave no ties, as rows have no order across files."""
    c = table(spark, sf, "conversations")
    q = c.where("role = 'user'").groupBy(F.col("conv_id").cast("string").alias("_Id")).agg(
        F.min_by(F.coalesce("text", F.lit("")), "turn").alias("_Body")
    ).select("_Id", F.lit("1").alias("_PostTypeId"), F.lit(None).cast("string").alias("_ParentId"), "_Body", F.lit("0").alias("_Score"))
    score = F.length(F.coalesce("text", F.lit(""))) * 1000 + 999 - F.col("turn")
    a = c.where("role = 'assistant'").select(
        F.concat_ws("-", F.lit("a"), "conv_id", "turn").alias("_Id"), F.lit("2").alias("_PostTypeId"),
        F.col("conv_id").cast("string").alias("_ParentId"), F.coalesce("text", F.lit("")).alias("_Body"),
        score.cast("string").alias("_Score")
    )
    out = f"{Tables(spark, 'posts').at}/xml"
    q.unionByName(a).write.format("xml").option("rootTag", "posts").option("rowTag", "row").save(out)
    return transforms.stackexchange(dumps.posts(spark, out)).select("doc_id", "text")


@query(
    _QA.replace(
        "SELECT q.conv_id::VARCHAR AS doc_id, trim('Q: ' || chr(10) || ", "SELECT q.conv_id::VARCHAR AS id, "
    ).replace(" || chr(10) || 'A: ' || ", " AS question, coalesce(").replace(", ' ' || chr(10)) AS text", ", '') AS answer")
)
def qa_raw(spark, sf):
    """Questions and answers as records, not as text."""
    c = table(spark, sf, "conversations")
    first = c.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("Body"), F.min("turn").alias("turn"))
    order = F.col("conv_id") * 100000 + F.col("turn")
    none = F.lit(None).cast("string")
    q = first.select(
        F.col("conv_id").cast("string").alias("Id"), F.lit("1").alias("PostTypeId"), none.alias("ParentId"), "Body",
        F.lit(0).alias("Score"), order.alias("ord")
    )
    a = c.where("role = 'assistant'").select(
        F.concat(F.lit("a"), order.cast("string")).alias("Id"), F.lit("2").alias("PostTypeId"),
        F.col("conv_id").cast("string").alias("ParentId"), F.col("text").alias("Body"),
        F.length(F.coalesce("text", F.lit(""))).alias("Score"), order.alias("ord")
    )
    return transforms.stackexchange_raw(q.unionByName(a)).select(
        "id", F.col("question.body").alias("question"), F.col("answer.body").alias("answer")
    )


_WIKI = ORACLES["strip_wikitext_pages"].replace(
    "SELECT page_id,", "SELECT page_id::VARCHAR AS id, url AS title,"
) + " WHERE page_id % 3 > 0"


@query(_WIKI)
def wiki_dump(spark, sf):
    """Pages as a dump in XML, every third in another name space, read as articles."""
    p = table(spark, sf, "pages")
    text = F.col("html").alias("text")
    pages = p.select(
        F.col("url").alias("title"), F.when(F.col("page_id") % 3 > 0, "0").otherwise("1").alias("ns"),
        F.col("page_id").cast("string").alias("id"), F.struct(F.lit("2020").alias("timestamp"), text).alias("revision")
    )
    out = f"{Tables(spark, 'wiki').at}/xml"
    pages.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").option("compression", "gzip").save(out)
    return transforms.wiki_dump(dumps.wiki_pages(spark, out)).select("id", "title", "text")


@query(f"SELECT doc_id::VARCHAR AS doc_id, CASE WHEN {T} = '' THEN '' ELSE lang || chr(10) || chr(10) || text END AS text FROM documents")
def wiki_articles(spark, sf):
    """Extracted articles as lines of JSON between blank and bad ones, read as documents."""
    lines = table(spark, sf, "documents").select(
        F.explode(
            F.array(
                F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("title"), "text")), F.lit(""),
                F.lit("{no")
            )
        ).alias("value")
    )
    out = f"{Tables(spark, 'articles').at}/lines"
    lines.write.text(out)
    return transforms.wikipedia(dumps.wiki_articles(spark, out)).select("doc_id", "text")


@query(f"SELECT doc_id, nfc_normalize({T}) || CASE WHEN suffix({T}, chr(10)) THEN '' ELSE chr(10) END AS line FROM documents")
def nfc_lines(spark, sf):
    return docs(spark, sf).select(F.col("ord").alias("doc_id"), X.nfc_line("text").alias("line"))


@query("SELECT doc_id, printf('shard_%05d.jsonl.zst', doc_id::INT) AS name FROM documents")
def shard_names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.shard_name("shard", "doc_id").alias("name"))


@query(
    f"SELECT k AS domain, round(w, 6) AS weight, 'split' AS source, 'in/' || k || '.jsonl.zst' AS path FROM (SELECT k, w / sum(w) OVER () AS w FROM (VALUES {', '.join(f'({k!r}, {v}::DOUBLE)' for k, v in mix.BASE_WEIGHTS.items())}) t(k, w))"
)
def split_manifest(spark, sf):
    """A manifest for files by domain, written, read and laid out as a table."""
    m = manifest.parse(json.loads(manifest.split_manifest("in")))
    return m.table(spark).select(
        "domain",
        F.round(
            F.lit(1.0) * F.element_at(F.create_map(*[F.lit(x) for kv in m.weights.items() for x in kv]), F.col("domain")) * F.col("weight"),
            6
        ).alias("weight"),
        "source", "path"
    )


# --- reports
@query(
    _reason(True) + f", k AS (SELECT *, (row_number() OVER (ORDER BY ord) - 1) // 100 AS shard_id FROM judged WHERE drop_reason IS NULL) SELECT shard_id::BIGINT AS shard_id, count(*) AS docs, sum(strlen(text))::BIGINT AS bytes, sum({TOKENS})::BIGINT AS est_tokens FROM k GROUP BY 1"
)
def shard_manifest(spark, sf):
    return reports.shard_manifest(reports.sharded(reports.sized(filters.kept(docs(spark, sf))), 100))


@query(_reason(True) + "SELECT domain, drop_reason, count(*) AS n FROM judged WHERE drop_reason IS NOT NULL GROUP BY 1, 2")
def drops_by_domain(spark, sf):
    return reports.drops(filters.judged(docs(spark, sf)), "domain")


@query(
    f"SELECT 'domain' AS kind, lang AS name, count(*) AS docs, sum({TOKENS})::BIGINT AS est_tokens FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*), sum({TOKENS})::BIGINT FROM documents GROUP BY source"
)
def pack_manifest(spark, sf):
    return reports.pack_manifest(docs(spark, sf))


@query(
    f"SELECT source, count(*) AS docs, sum({TOKENS})::BIGINT AS est_tokens FROM documents GROUP BY 1 ORDER BY est_tokens DESC, source LIMIT 10"
)
def top_sources(spark, sf):
    return reports.top_sources(docs(spark, sf))


@query(_QUALITY + f""", e AS (SELECT ord, round(score, 6) AS score, row_number() OVER (PARTITION BY md5({COLLAPSED}) ORDER BY ord) AS r FROM q)
SELECT ord::VARCHAR AS doc_id, score FROM e WHERE r > 1 ORDER BY score, doc_id LIMIT 5""")
def worst_examples(spark, sf):
    d = dedup.exact_first(docs(spark, sf), "global").select(
        "doc_id", (~F.col("is_copy")).alias("keep"), F.round(X.quality_score("text"), 6).alias("score")
    )
    return reports.worst(d).select("doc_id", "score")


_ALIAS = "CASE " + " ".join(f"WHEN {{0}} = '{k}' THEN '{v}'" for k, v in transforms.DOMAIN_ALIASES.items()) + " ELSE {0} END"
_NAMED = "CASE source WHEN 'src0' THEN 'web' WHEN 'src1' THEN 'wiki' WHEN 'src2' THEN 'code' WHEN 'src3' THEN 'filtered_web' ELSE source END"


def _renamed(d: DataFrame) -> DataFrame:
    """Sources as domains, some under an alias."""
    s = F.col("source")
    return d.withColumn(
        "domain",
        F.when(s == "src0", "web").when(s == "src1", "wiki").when(s == "src2", "code").when(s == "src3", "filtered_web").otherwise(s)
    )


@query(f"""WITH r AS (SELECT {_NAMED} AS domain, count(*) AS docs, sum(strlen({T}))::BIGINT AS bytes FROM documents GROUP BY 1)
SELECT 'raw' AS kind, domain, docs, bytes FROM r UNION ALL SELECT 'canonical', {_ALIAS.format('domain')}, sum(docs)::BIGINT, sum(bytes)::BIGINT FROM r GROUP BY 2""")
def domain_histogram_raw_canonical(spark, sf):
    return reports.histogram(_renamed(docs(spark, sf)))


@query(
    "SELECT domain_safe, count(*) AS docs FROM (SELECT regexp_replace(lang || '/' || source, '[^A-Za-z0-9._-]+', '_', 'g') AS domain_safe FROM documents) GROUP BY 1 ORDER BY docs DESC, domain_safe LIMIT 50"
)
def split_counts(spark, sf):
    lines = docs(spark, sf).select(F.to_json(F.struct("doc_id", F.concat_ws("/", "domain", "source").alias("domain"))).alias("value"))
    return jsonl.split_counts(jsonl.split_by_domain(lines))


_YIELD = f"SELECT lang AS domain, count(*) AS docs, round(avg(length({T})), 6) AS avg_yield FROM documents GROUP BY 1"


@query(_YIELD)
def domain_yield(spark, sf):
    return reports.domain_yield(docs(spark, sf)).withColumn("avg_yield", F.round("avg_yield", 6))


@query(
    f"WITH y AS ({_YIELD}), w AS (SELECT domain, 0.25 / avg_yield AS w FROM y) SELECT domain, round(w / sum(w) OVER (), 6) AS weight FROM w"
)
def yield_corrected_weights(spark, sf):
    yields = reports.domain_yield(docs(spark, sf))
    return mix.yield_corrected(yields.select("domain", F.lit(0.25).alias("weight")), yields).withColumn("weight", F.round("weight", 6))


@query(_QUALITY + "SELECT doc_id, text FROM (SELECT ord AS doc_id, text, round(score, 6) AS s FROM q) ORDER BY s, doc_id LIMIT 20")
def lowest_quality(spark, sf):
    d = docs(spark, sf).select(F.col("ord").alias("doc_id"), "text", F.round(X.quality_score("text"), 6).alias("s"))
    return d.orderBy("s", "doc_id").limit(20).drop("s")


@query("SELECT doc_id, 'text' AS at FROM documents WHERE contains(text, 'placeholder')")
def placeholder_audit(spark, sf):
    return reports.placeholders(table(spark, sf, "documents")).select("doc_id", F.col("where").alias("at"))


# --- mixing
@query(f"""WITH g AS (SELECT lang AS domain, count(*) AS docs, sum(length({T}))::BIGINT AS chars, sum(strlen({T}))::BIGINT AS bytes FROM documents GROUP BY 1)
SELECT *, round(chars / sum(chars) OVER (), 6) AS share_chars, round(bytes / sum(bytes) OVER (), 6) AS share_bytes FROM g""")
def mix_shares(spark, sf):
    return mix.shares(docs(spark, sf)).withColumns({k: F.round(k, 6) for k in ("share_chars", "share_bytes")})


_TARGETS = ", ".join(f"('{k}', {v})" for k, v in mix.BASE_WEIGHTS.items())


@query(f"""WITH d AS (SELECT {_ALIAS.format('s')} AS domain FROM (SELECT {_NAMED} AS s FROM documents)), n AS (SELECT domain, count(*) AS n FROM d GROUP BY 1)
SELECT t.domain, round(coalesce(n, 0) / (SELECT count(*) FROM d), 6) AS observed, target::DOUBLE AS target, round(coalesce(n, 0) / (SELECT count(*) FROM d) - target::DOUBLE, 6) AS delta FROM (VALUES {_TARGETS}) t(domain, target) LEFT JOIN n ON n.domain = t.domain""")
def mix_vs_target(spark, sf):
    named = _renamed(docs(spark, sf)).withColumn("domain", transforms.canonical_domain("domain"))
    return mix.against_target(named).withColumns({k: F.round(k, 6) for k in ("observed", "delta")})


@query("""WITH f AS (SELECT source, lang AS file, count(*) AS n_docs FROM documents GROUP BY 1, 2)
SELECT * FROM (SELECT *, coalesce(sum(n_docs) OVER (PARTITION BY source ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM f) WHERE before < 10""")
def file_cap_running(spark, sf):
    """Files of a source, here one per language, until 10 documents are reached."""
    files = table(spark, sf, "documents").groupBy("source", F.col("lang").alias("file")).agg(F.count(F.lit(1)).alias("n_docs"))
    return mix.capped_files(files, 10)


@query(f"""WITH b AS (SELECT lang, doc_id, strlen({T}) AS n, coalesce(sum(strlen({T})) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents WHERE lang IN ('en', 'de'))
SELECT doc_id, least(n, 100000 - before)::BIGINT AS bytes_used FROM b WHERE before < 100000 AND least(n, 100000 - before) > 0""")
def byte_budget(spark, sf):
    return mix.byte_budget(docs(spark, sf), {"en": 100000, "de": 100000}).select(F.col("ord").alias("doc_id"), "bytes_used")


@query(
    "SELECT doc_id, lang AS domain FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 25"
)
def per_domain_sample(spark, sf):
    return mix.sample_per_domain(table(spark, sf, "documents").select("doc_id", F.col("lang").alias("domain")), 25, 7)


@query("SELECT doc_id, row_number() OVER (ORDER BY sha256('7:all:0:' || doc_id), doc_id) AS place FROM documents")
def shuffled_order(spark, sf):
    """Places in the shuffled order: running counts over ranges of the hash, so no one task sorts all rows."""
    h = F.sha2(F.concat_ws(":", F.lit("7:all:0"), F.col("doc_id").cast("string")), 256)
    d = table(spark, sf, "documents").select("doc_id", h.alias("h"), F.conv(F.substring(h, 1, 3), 16, 10).cast("int").alias("range"))
    before = d.groupBy("range").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("range")) - F.col("n")
    ).drop("n")
    return d.join(F.broadcast(before), "range").select(
        "doc_id", (F.row_number().over(Window.partitionBy("range").orderBy("h", "doc_id")) + F.col("before")).alias("place")
    )


@query()
def sampler_plan(spark, sf):
    d = docs(spark, sf)
    have = {(r.domain, r.source) for r in d.select("domain", "source").distinct().collect()}  # a row per source
    sources = {x: {f"src{i}": 0.25 for i in range(4) if (x, f"src{i}") in have} for x in ("en", "de", "fr", "es")}
    return mix.sampler_plan(d, {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, sources, 200, seed=1, repeat=True)


_SHARES = {(d, f"src{i}"): w * 0.25 for d, w in (("en", 0.4), ("de", 0.2), ("fr", 0.2), ("es", 0.2)) for i in range(4)}
_MIX = f"""WITH w AS (SELECT * FROM (VALUES {', '.join(f"('{d}', '{s}', {w}::DOUBLE)" for (d, s), w in _SHARES.items())}) t(domain, source, weight)),
v AS (SELECT w.* FROM w SEMI JOIN documents d ON d.lang = w.domain AND d.source = w.source),
e AS (SELECT domain, source, weight / (SELECT sum(weight) FROM v) AS weight FROM v),
t AS (SELECT d.doc_id, d.lang AS domain, d.source, e.weight, {TOKENS} AS n FROM documents d JOIN e ON d.lang = e.domain AND d.source = e.source),
b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY domain, source) AS whole FROM t),
x AS (SELECT *, unnest(range(0, 1 + greatest(0, floor((weight * 200000 - before) / whole))::BIGINT)) AS epoch FROM b WHERE before < weight * 200000)
SELECT doc_id, domain, source, epoch::INT AS epoch, n AS est_tokens, round((epoch * whole + before) / weight, 3) AS at FROM x WHERE (epoch * whole + before) / weight < 200000"""


@query(_MIX)
def interleaved_mix(spark, sf):
    """200000 tokens, sources by their weights, again from their begin where they run out."""
    d = docs(spark, sf)
    have = {(r.domain, r.source) for r in d.select("domain", "source").distinct().collect()}  # a row per source
    mixed = mix.interleaved(d, {k: w for k, w in _SHARES.items() if k in have}, 200000, repeat=True)
    return mixed.select(F.col("ord").alias("doc_id"), "domain", "source", "epoch", "est_tokens", F.round("at", 3).alias("at"))


# --- packing and loading
def _lengths(spark, sf) -> DataFrame:
    """Documents with their words' lengths for tokens."""
    return docs(spark, sf).withColumns({"tokens": F.transform(X.tokens("text"), F.length), "mix_ord": F.col("ord")})


_STREAM = f"""WITH RECURSIVE d AS ({_SOURCE}),
l AS (SELECT ord, doc_id, domain, source, [length(x) FOR x IN string_split({COLLAPSED}, ' ') IF x <> ''] AS ids, row_number() OVER (ORDER BY ord) AS r FROM d),
z AS (SELECT r, len(ids)::BIGINT AS n FROM l),
s AS (SELECT 0::BIGINT AS r, 0::BIGINT AS was, 0::BIGINT AS beg, 0::BIGINT AS stop UNION ALL
  SELECT z.r, s.stop, b, b + n FROM s JOIN z ON z.r = s.r + 1, LATERAL (SELECT CASE WHEN n >= 256 THEN s.stop + (256 - s.stop % 256) % 256 WHEN s.stop % 256 > 0 THEN s.stop + 1 ELSE s.stop END AS b)),
p AS (SELECT l.*, s.was, s.beg FROM s JOIN l ON l.r = s.r),
tok AS (SELECT beg + i - 1 AS pos, ids[i] AS id, ord, doc_id, domain, source, i FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS i FROM p) UNION ALL
  SELECT i, 0, ord, NULL, domain, source, NULL FROM (SELECT *, unnest(range(was, beg)) AS i FROM p)),
w AS (SELECT pos // 256 AS row, string_agg(id, ',' ORDER BY pos) AS ids, count(*) AS n, arg_max(domain, ord) AS domain, arg_max(source, ord) AS source, count(DISTINCT doc_id) AS n_segments FROM tok GROUP BY 1)
"""


@query(
    _STREAM + "SELECT row::BIGINT AS row, ids || repeat(',0', (256 - n)::INT) AS input_ids, domain, source, n_segments::INT AS n_segments FROM w"
)
def pack_rows(spark, sf):
    return pack.pack(_lengths(spark, sf), 256, 0).select(
        "row", F.array_join("input_ids", ",").alias("input_ids"), "domain", "source", F.size("segments").alias("n_segments")
    )


@query(_STREAM + """, g AS (SELECT (pos // 256)::BIGINT AS row, doc_id, (min(i) - 1)::INT AS start, max(i)::INT AS end FROM tok WHERE i IS NOT NULL GROUP BY ALL)
SELECT *, CASE WHEN count(*) OVER (PARTITION BY row) = 1 THEN start END AS start_token FROM g""")
def pack_segments(spark, sf):
    return pack.index(pack.pack(_lengths(spark, sf), 256, 0)).select(
        "row", F.explode("segments").alias("s"), "start_token"
    ).select("row", "s.doc_id", "s.start", "s.end", "start_token")


_IDS = f"WITH d AS ({_SOURCE}), l AS (SELECT ord AS doc_id, [length(x) FOR x IN string_split({COLLAPSED}, ' ') IF x <> ''] AS ids FROM d), i AS (SELECT * FROM l WHERE len(ids) > 0)"


def _rows(spark, sf) -> DataFrame:
    return docs(spark, sf).select(
        F.col("ord").alias("doc_id"), F.transform(X.tokens("text"), F.length).alias("ids")
    ).where(F.size("ids") > 0)


@query(_IDS + "SELECT doc_id, array_to_string(ids[2:] || [-100], ',') AS labels FROM i")
def loader_shift(spark, sf):
    return _rows(spark, sf).select("doc_id", F.array_join(pack.labels("ids"), ",").alias("labels"))


@query(_IDS + "SELECT doc_id, array_to_string([999] || ids[1:len(ids) - 1], ',') AS ids FROM i")
def loader_prefix(spark, sf):
    return _rows(spark, sf).select("doc_id", F.array_join(pack.domain_prefix("ids", 999), ",").alias("ids"))


@query(
    _IDS + "SELECT doc_id, array_to_string(CASE WHEN len(ids) < 8 THEN ids ELSE ([901] || ids[1:4] || [902] || ids[7:] || [903] || ids[5:6])[1:len(ids)] END, ',') AS ids FROM i"
)
def loader_fim(spark, sf):
    return _rows(spark, sf).select("doc_id", F.array_join(pack.fill_in_middle("ids", F.lit(4), F.lit(6), 901, 902, 903), ",").alias("ids"))


_DRAW = "('0x' || substr(md5({}), 1, 15))::BIGINT"
_LEN = "greatest(len(ids) - 1, 2)"


@query(_IDS + f""", f AS (SELECT *, {_DRAW.format("'first:5:' || doc_id")} % {_LEN} AS x, {_DRAW.format("'other:5:' || doc_id")} % ({_LEN} - 1) AS y FROM i),
c AS (SELECT *, CASE WHEN y < x THEN y ELSE y + 1 END AS z FROM f), e AS (SELECT *, least(x, z) + 1 AS a, greatest(x, z) + 1 AS b FROM c)
SELECT doc_id, array_to_string(CASE WHEN len(ids) < 8 THEN ids ELSE ([901] || ids[1:a] || [902] || ids[b + 1:] || [903] || ids[a + 1:b])[1:len(ids)] END, ',') AS ids FROM e""")
def loader_fim_drawn(spark, sf):
    """The same with cut points drawn by document."""
    rows = _rows(spark, sf)
    return rows.select(
        "doc_id", F.array_join(pack.fill_in_middle("ids", *pack.middle_cuts("ids", 5, "doc_id"), 901, 902, 903), ",").alias("ids")
    )


@query(
    _STREAM + f", n AS (SELECT max(row) + 1 AS n FROM w) SELECT i AS draw, row, domain FROM (SELECT unnest(range(500)) AS i) JOIN n ON true JOIN w ON row = {_DRAW.format(chr(39) + 'row:3:' + chr(39) + ' || i')} % n.n"
)
def loader_draws(spark, sf):
    """500 rows of a pack with replacement."""
    rows = Tables(spark, "pack").save(pack.pack(_lengths(spark, sf), 256, 0), "rows")
    return pack.sampled_rows(rows, 500, rows.count(), 3).select("draw", "row", "domain")


@query(
    f"SELECT i AS draw, CASE WHEN u < 0.5 THEN 'a' WHEN u < 0.75 THEN 'b' ELSE 'c' END AS pack FROM (SELECT i, {_DRAW.format(chr(39) + 'pack:3:' + chr(39) + ' || i')} / {1 << 60}::DOUBLE AS u FROM (SELECT unnest(range(4000)) AS i))"
)
def loader_mixture(spark, sf):
    return pack.mixture(spark, {"a": 2.0, "b": 1.0, "c": 1.0}, 4000, 3)


@query(_STREAM + "SELECT row::BIGINT AS row, ids || repeat(',0', (256 - n)::INT) AS input_ids, domain FROM w")
def pack_matrix(spark, sf):
    """A pack as a matrix of integers in a file, read from there."""
    out = Tables(spark, "matrix").at
    packs.export(Tables(spark, "pack").save(pack.pack(_lengths(spark, sf), 256, 0), "rows"), out, 256)
    return packs.read(spark, out).select("row", F.array_join("input_ids", ",").alias("input_ids"), "domain")


@query("SELECT config FROM (VALUES ('eng_Latn'), ('eng_Cyrl')) t(config)")
def hf_config_filter(spark, sf):
    configs = spark.createDataFrame([(c,) for c in ("asm_Beng", "fra_Latn", "eng_Latn", "eng_Cyrl")], "config string")
    return hub.matching_configs(configs, lang="eng")


@query(f"SELECT doc_id::VARCHAR AS doc_id, {T} AS text, 'web' AS source, 'filtered_web' AS domain FROM documents")
def hub_documents(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", F.col("doc_id").alias("ord"))
    return hub.documents(rows, "web", "filtered_web").select("doc_id", "text", "source", "domain")


@query(f"SELECT doc_id::VARCHAR AS doc_id, CASE WHEN {T} = '' THEN '' ELSE lang || chr(10) || chr(10) || text END AS text FROM documents")
def wikipedia_documents(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), "text")
    return transforms.wikipedia(pages).select("doc_id", "text")
