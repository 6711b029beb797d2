"""Scalar functions over text, as Column expressions; hashes that Spark lacks, as Arrow UDFs."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: hosts whose pages count as of low signal.
LOW_SIGNAL_HOSTS = ["pinterest.com", "facebook.com", "instagram.com", "tiktok.com", "twitter.com", "x.com"]
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """body(value), the value computed once: inside lambdas of array functions an expression would be computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c) -> Column:
    """Without white space, Unicode's included, at either end."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def collapse(c) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def est_tokens(c, chars_per_token: float = 4.0) -> Column:
    """Characters over characters a token, rounded half to even, 1 at least."""
    n = F.length(F.coalesce(_c(c), F.lit("")))
    return F.greatest(F.lit(1), F.bround(n / F.lit(max(chars_per_token, 1e-6)))).cast("long")


def n_bytes(c) -> Column:
    return F.octet_length(F.coalesce(_c(c), F.lit(""))).cast("long")


def printable_ratio(c) -> Column:
    """Share of printable characters; 0 for no text. Of white space, the ASCII space alone is printable."""
    c = F.coalesce(_c(c), F.lit(""))
    n = F.length(c)
    return F.when(n == 0, F.lit(0.0)).otherwise((n - F.length(F.regexp_replace(c, r"[^\p{C}\p{Z}]| ", ""))) / n)


def tokens(c) -> Column:
    """Words between white space; none for blank text."""
    return F.filter(F.split(collapse(F.coalesce(_c(c), F.lit(""))), " "), lambda x: x != "")


def repetition_3gram(c, most: int = 4000) -> Column:
    """1 less the share of distinct ones among the word 3-grams of the first `most` words."""

    def ratio(t: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(1), F.size(t) - 2),
            lambda i: F.concat_ws(" ", F.element_at(t, i), F.element_at(t, i + 1), F.element_at(t, i + 2))
        )
        return F.when(F.size(t) < 3, F.lit(0.0)).otherwise(let(grams, lambda g: F.lit(1.0) - F.size(F.array_distinct(g)) / F.size(g)))

    return let(F.slice(tokens(c), 1, most), ratio)


def url_penalty(c) -> Column:
    hosts = "|".join(h.replace(".", r"\.") for h in LOW_SIGNAL_HOSTS)
    return F.when(F.lower(_c(c)).rlike(hosts), F.lit(-0.5)).otherwise(F.lit(0.0))


def quality_score(c, url=None) -> Column:
    """Length, printable share, repetition and host in one number; -10 for no text."""
    c = F.coalesce(_c(c), F.lit(""))
    n = F.length(c)
    long = F.when(n > 20000, F.least((n - 20000) / 20000.0, F.lit(2.0))).otherwise(0.0)
    size = F.least(n / 1000.0, F.lit(5.0)) - F.when(n < 200, 2.0).otherwise(0.0) - long
    score = size + (printable_ratio(c) - 0.85) * 2.0 - repetition_3gram(c) * 2.0 + (url_penalty(url) if url is not None else F.lit(0.0))
    return F.when(n == 0, F.lit(-10.0)).otherwise(score)


def shard_name(prefix: str, index) -> Column:
    return F.format_string(f"{prefix}_%05d.jsonl.zst", _c(index))


def safe_name(c) -> Column:
    """A name for files: other characters than letters, digits, dot, underscore and dash as underscores; `unknown` for none."""
    s = F.regexp_replace(F.coalesce(_c(c), F.lit("")), "[^A-Za-z0-9._-]+", "_")
    return F.when(s == "", "unknown").otherwise(s)


def strip_html(c) -> Column:
    """Code kept, other tags as spaces, white space collapsed. Entities stay."""
    c = F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"(?s)<pre><code>(.*?)</code></pre>", "$1")
    c = F.regexp_replace(c, r"(?s)<code>(.*?)</code>", "$1")
    return collapse(F.regexp_replace(c, "<[^>]+>", " "))


def strip_wikitext(c) -> Column:
    """Templates and references as spaces, links as their labels, quote marks gone, tags as spaces."""
    c = F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"(?s)\{\{.*?\}\}", " ")
    c = F.regexp_replace(c, r"\[\[(?:[^\]|]+\|)?([^\]]+)\]\]", "$1")
    c = F.regexp_replace(c, "''+", "")
    c = F.regexp_replace(c, r"(?s)<ref[^>]*>.*?</ref>", " ")
    return collapse(F.regexp_replace(c, "<[^>]+>", " "))


def identifiers(c, most: int = 50) -> Column:
    return F.slice(F.regexp_extract_all(_c(c), F.lit(r"(?<![\p{L}\p{N}_])([A-Za-z_][A-Za-z0-9_]*)(?![\p{L}\p{N}_])"), 1), 1, most)


def sci_numbers(c, most: int = 20) -> Column:
    return F.slice(
        F.regexp_extract_all(_c(c), F.lit(r"(?i)(?<![\p{L}\p{N}_])(\p{Nd}+(?:\.\p{Nd}+)?e[+-]?\p{Nd}+)(?![\p{L}\p{N}_])"), 1), 1, most
    )


def placeholder(license_tag, note, text) -> Column:
    """Which part of a document is a placeholder, if any."""
    word = "placeholder"
    return F.when(_c(license_tag) == word, "license_tag").when(_c(note) == word, "meta.note").when(
        F.coalesce(_c(text), F.lit("")).contains(word), "text"
    )


def blake2b8(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "ignore"), digest_size=8).hexdigest()


def _udf(f):
    """An Arrow UDF from a function of strings, made when it is used: a worker imports this module without a session."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    return F.pandas_udf(run, T.StringType())


def stable_hash(c) -> Column:
    """16 hexadecimal digits of BLAKE2b; null for null."""
    return _udf(blake2b8)(_c(c))


def exact_hash(c) -> Column:
    """stable_hash of the text with white space collapsed."""
    return stable_hash(collapse(F.coalesce(_c(c), F.lit(""))))


def nfc_line(c) -> Column:
    """NFC, with a line end."""

    def line(x: str) -> str:
        x = unicodedata.normalize("NFC", x)
        return x if x.endswith("\n") else x + "\n"

    return _udf(line)(_c(c))


def params_hash(params: dict) -> str:
    """SHA-256 of parameters, whatever their order."""
    import json

    return hashlib.sha256(json.dumps(params, sort_keys=True).encode()).hexdigest()


def file_sha256(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
