"""Quality filters: an ordered chain in which the first that fails gives the reason.

A filter is a name and a function from a text column to a column with the reason, or null. The chain is one
coalesce, so one scan gives the kept rows and the counts of drops. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import LINE_BREAK, let, strip

Filter = Callable[[Column], Column]
# Phrases of page furniture, and words that mark toxic text.
PHRASES = [
    "all rights reserved", "terms of service", "cookie policy", "subscribe to our newsletter", "privacy policy", "navigation", "footer"
]
TOXIC_WORDS = ["fuck", "shit", "bitch", "cunt", "nigger", "faggot"]


def _share(c: Column, unlike: str) -> Column:
    """Share of the characters that do not match a class."""
    return F.length(F.regexp_replace(c, unlike, "")) / F.greatest(F.length(c), F.lit(1))


def length(least: int = 200, most: int = 1_000_000) -> Filter:
    return lambda c: F.when(F.length(c) < least, "too_short").when(F.length(c) > most, "too_long")


def ascii_ratio(least: float = 0.8) -> Filter:
    return lambda c: F.when(c == "", "empty").when(_share(c, r"[^\x00-\x7F]") < least, "low_ascii_ratio")


def symbol_ratio(most: float = 0.45) -> Filter:
    return lambda c: F.when(c == "", "empty").when(_share(c, r"(?U)[\p{L}\p{N}\s]") > most, "symbol_ratio")


def most_frequent(lines: Column) -> Column:
    """How often the most frequent of some strings occurs: the longest run once they are sorted."""
    run = lambda a, x: F.struct(
        x.alias("last"), F.when(x == a["last"], a["n"] + 1).otherwise(F.lit(1)).alias("n"),
        F.greatest(a["best"], F.when(x == a["last"], a["n"] + 1).otherwise(F.lit(1))).alias("best")
    )
    return F.aggregate(
        F.array_sort(lines), F.struct(F.lit("").alias("last"), F.lit(0).alias("n"), F.lit(0).alias("best")), run, lambda a: a["best"]
    )


def repeated_lines(most: float = 0.3, least_lines: int = 6) -> Filter:
    def check(c: Column) -> Column:
        lines = F.filter(F.transform(F.split(c, LINE_BREAK), strip), lambda x: x != "")
        too_many = lambda x: (F.size(x) >= least_lines) & (most_frequent(x) / F.greatest(F.size(x), F.lit(1)) > most)
        return F.when(let(lines, too_many), "boilerplate_repeat")

    return check


def phrases(found: list[str] = PHRASES) -> Filter:
    return lambda c: F.when(F.lower(c).rlike("|".join(found)), "boilerplate_phrase")


def toxicity(words: list[str] = TOXIC_WORDS) -> Filter:
    return lambda c: F.when(c.rlike(r"(?iU)\b(?:" + "|".join(words) + r")\b"), "toxicity")


#: More filters can be put in; `chain` names those to apply, in order.
REGISTRY: dict[str, Filter] = {
    "length": length(), "ascii_ratio": ascii_ratio(), "symbol_ratio": symbol_ratio(), "repeated_lines": repeated_lines(),
    "phrases": phrases(), "toxicity": toxicity()
}
DEFAULT = ["length", "ascii_ratio", "symbol_ratio", "repeated_lines", "phrases", "toxicity"]
WITHOUT_LANGUAGE = [x for x in DEFAULT if x != "ascii_ratio"]


def drop_reason(text="text", chain: list[str] | None = None) -> Column:
    """The reason of the first filter that fails, null if none does."""
    c = F.coalesce(F.col(text), F.lit(""))
    return F.coalesce(*[REGISTRY[x](c) for x in (DEFAULT if chain is None else chain)], F.lit(None).cast("string"))


def judged(docs: DataFrame, chain: list[str] | None = None) -> DataFrame:
    return docs.withColumn("drop_reason", drop_reason(chain=chain))


def kept(docs: DataFrame, chain: list[str] | None = None) -> DataFrame:
    return docs.where(drop_reason(chain=chain).isNull())
