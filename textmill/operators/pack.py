"""Tokenisation and sequential packing into rows of fixed length; loader transforms.

All rows of a pack are one stream of positions. What is buffered when a document comes is the stream's place within a row, so
where documents lie follows from their lengths alone. A block of documents is summarised as a map from that place, 0 to
seq_len - 1, to how far the block moves the stream; the maps are followed one after the other, a small row per block,
and then every block places its documents by itself. Tokens meet only row by row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = "struct<doc_id:string,start:int,end:int>"


class Tokenizer:
    """A tokenizer file, .json (tokenizers) or .model (sentencepiece); loaded where it is first used."""

    def __init__(self, path: str, eos_id: int | None = None):
        self.path, self._eos = path, eos_id
        self._loaded = None

    def __getstate__(self):
        return {"path": self.path, "_eos": self._eos, "_loaded": None}

    @property
    def loaded(self):
        if self._loaded is None:
            if self.path.endswith(".json"):
                from tokenizers import Tokenizer as Json

                self._loaded = Json.from_file(self.path)
            elif self.path.endswith(".model"):
                from sentencepiece import SentencePieceProcessor

                self._loaded = SentencePieceProcessor(model_file=self.path)
            else:
                raise ValueError(f"no tokenizer for {self.path}")
        return self._loaded

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        t = self.loaded
        return [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)] if self.path.endswith(".json") else t.encode(texts)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    @property
    def eos_id(self) -> int:
        if self._eos is not None:
            return self._eos
        if self.path.endswith(".json"):
            found = next((i for i in map(self.loaded.token_to_id, ("<eos>", "<|endoftext|>", "</s>")) if i is not None), None)
        else:
            found = self.loaded.eos_id() if self.loaded.eos_id() >= 0 else None
        if found is None:
            raise ValueError(f"{self.path} has no end token; give eos_id")
        self._eos = found
        return found


def tokenised(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """The rows with `tokens`."""

    @F.pandas_udf("array<int>")
    def encode(s: pd.Series) -> pd.Series:
        return pd.Series(tokenizer.encode_all(s.tolist()))

    return docs.withColumn("tokens", encode(F.coalesce("text", F.lit(""))))


#: Documents of a block: the stream is followed block by block.
BLOCK = 1 << 16


def _moves(seq_len: int):
    """(block, moved) of a block's lengths: for each place within a row how far the block moves the stream."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("mix_ord")
        at = np.arange(seq_len, dtype=np.int64)
        for n in group.column("n").to_numpy():
            at = _placed(at, int(n), seq_len) + n
        moved = (at - np.arange(seq_len)).astype("<i8")
        return pa.table({"block": group.column("block").slice(0, 1), "moved": pa.array([moved.tobytes()], pa.binary())})

    return run


def _placed(at, n: int, seq_len: int):
    """Where a document of n tokens begins if the stream is at a position, or at each of some."""
    inside = at % seq_len
    if n >= seq_len:  # what is buffered is filled up
        return at + (-inside) % seq_len
    return at + (inside > 0)  # an end token, if anything is buffered


def _begins(seq_len: int):
    """(block, begin) of all blocks, in order."""

    def run(batches):
        at = 0
        for batch in batches:
            begins = []
            for moved in batch.column("moved"):
                begins.append(at)
                at += int(np.frombuffer(moved.as_py(), "<i8")[at % seq_len])
            yield pa.RecordBatch.from_pydict({"block": batch.column("block"), "begin": pa.array(begins, pa.int64())})

    return run


def _places(seq_len: int):
    """(mix_ord, at, was) of a block's documents: where their tokens begin, and where the stream was before."""

    def run(docs: pa.Table, begin: pa.Table) -> pa.Table:
        docs = docs.sort_by("mix_ord")
        at, was, begins = begin.column("begin")[0].as_py(), [], []
        for n in docs.column("n").to_pylist():
            was.append(at)
            begins.append(_placed(at, n, seq_len))
            at = begins[-1] + n
        return pa.table({"mix_ord": docs.column("mix_ord"), "at": pa.array(begins, pa.int64()), "was": pa.array(was, pa.int64())})

    return run


def places(lengths: DataFrame, seq_len: int, block: int = BLOCK) -> DataFrame:
    """(mix_ord, at, was) of documents (mix_ord, n)."""
    from textmill.plans.tables import Tables

    slim = Tables(lengths.sparkSession, "places").save(
        lengths.select(
            F.col("mix_ord").cast("long").alias("mix_ord"), F.col("n").cast("long").alias("n"),
            F.floor(F.col("mix_ord") / block).cast("long").alias("block")
        ),
        "lengths"
    )
    moves = slim.groupBy("block").applyInArrow(_moves(seq_len), "block long, moved binary")
    begins = moves.coalesce(1).sortWithinPartitions("block").mapInArrow(_begins(seq_len), "block long, begin long")
    return slim.groupBy("block").cogroup(begins.groupBy("block")).applyInArrow(_places(seq_len), "mix_ord long, at long, was long")


def pack(docs: DataFrame, seq_len: int, eos_id: int, num_seqs: int | None = None, block: int = BLOCK) -> DataFrame:
    """Rows (row, input_ids, segments, domain, source) of documents (mix_ord, doc_id, domain, source, tokens); mix_ord is 0, 1, 2 ...

    A document of seq_len tokens or more begins a row, others follow an end token if anything is in the row. Rows are filled
    up with end tokens. A segment without doc_id is an end token or filling; `segments` leaves those out. A row's domain
    and source are those of the document that completes it, or, for filling, that forces it out."""
    d = docs.select(
        F.col("mix_ord").cast("long").alias("mix_ord"), F.col("doc_id").cast("string").alias("doc_id"), "domain", "source", "tokens"
    )
    p = d.join(places(d.select("mix_ord", F.size("tokens").alias("n")), seq_len, block), "mix_ord")
    row_of = lambda c: F.floor(c / seq_len)
    # parts: a document's tokens cut at row ends
    stop_at = F.col("at") + F.size("tokens")
    part = p.where(F.size("tokens") > 0).withColumn("row", F.explode(F.sequence(row_of(F.col("at")), row_of(stop_at - 1))))
    begin, stop = F.greatest(F.col("row") * seq_len, F.col("at")), F.least((F.col("row") + 1) * seq_len, stop_at)
    segment = F.struct("doc_id", (begin - F.col("at")).cast("int").alias("start"), (stop - F.col("at")).cast("int").alias("end"))
    part = part.select(
        "row", (begin - F.col("row") * seq_len).cast("int").alias("pos"),
        F.slice("tokens", (begin - F.col("at") + 1).cast("int"), (stop - begin).cast("int")).alias("ids"), segment.alias("segment"),
        "mix_ord", "domain", "source"
    )
    # between documents: an end token, or filling to the end of the row
    none = F.lit(None).cast(SEGMENT)
    gap = p.where("at > was").select(
        row_of(F.col("was")).alias("row"), (F.col("was") % seq_len).cast("int").alias("pos"),
        F.array_repeat(F.lit(eos_id), (F.col("at") - F.col("was")).cast("int")).alias("ids"), none.alias("segment"), "mix_ord", "domain",
        "source"
    )
    pieces = part.unionByName(gap)
    rows = pieces.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("pos", "ids", "segment"))).alias("p"),
        F.max_by(F.struct("domain", "source"), "mix_ord").alias("label")
    )
    ids = F.flatten(F.col("p.ids"))
    filled = F.concat(ids, F.array_repeat(F.lit(eos_id), seq_len - F.size(ids)))  # the last row
    out = rows.select(
        "row", filled.alias("input_ids"), F.filter("p.segment", lambda s: s.isNotNull()).alias("segments"), "label.domain", "label.source"
    )
    return out if num_seqs is None else out.where(F.col("row") < num_seqs)


def index(rows: DataFrame) -> DataFrame:
    """(row, segments, domain, source, doc_id, start_token, end_token): the last three only for rows of a single segment."""
    one = lambda k: F.when(F.size("segments") == 1, F.col("segments")[0][k])
    return rows.select(
        "row", "segments", "domain", "source", one("doc_id").alias("doc_id"), one("start").alias("start_token"),
        one("end").alias("end_token")
    )


def domain_prefix(ids, domain_id) -> Column:
    """The row moved right by one, the domain's id in front."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.concat(F.array(domain_id if isinstance(domain_id, Column) else F.lit(domain_id)), F.slice(ids, F.lit(1), F.size(ids) - 1))


def fill_in_middle(ids, a, b, prefix_id: int | None, suffix_id: int | None, middle_id: int | None) -> Column:
    """prefix_id, ids before a, suffix_id, ids from b, middle_id, ids between; cut to the row's length. Rows under 8, or a missing id: as they are."""
    ids, a, b = (F.col(x) if isinstance(x, str) else x for x in (ids, a, b))
    if None in (prefix_id, suffix_id, middle_id):
        return ids
    n = F.size(ids)
    parts = F.concat(
        F.array(F.lit(prefix_id)), F.slice(ids, F.lit(1), a), F.array(F.lit(suffix_id)), F.slice(ids, b + 1, n - b),
        F.array(F.lit(middle_id)), F.slice(ids, a + 1, b - a)
    )
    return F.when(n < 8, ids).otherwise(F.slice(parts, F.lit(1), n))


def drawn(*keys) -> Column:
    """A number below 2 ** 60 that keys fix: the begin of an MD5 digest, so that other engines draw the same."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[k.cast("string") for k in keys])), 1, 15), 16, 10).cast("long")


def middle_cuts(ids, seed: int, *keys: str) -> tuple[Column, Column]:
    """Cut points a < b for fill_in_middle, neither at an end, drawn by a hash of seed and key columns: any two places are as likely."""
    n = F.greatest(F.size(ids) - 1, F.lit(2))  # places inside the row
    first = F.pmod(drawn(F.lit("first"), F.lit(seed), *map(F.col, keys)), n)
    other = F.pmod(drawn(F.lit("other"), F.lit(seed), *map(F.col, keys)), n - 1)
    other = F.when(other < first, other).otherwise(other + 1)
    return (F.least(first, other) + 1).cast("int"), (F.greatest(first, other) + 1).cast("int")


def labels(ids) -> Column:
    """What follows each token; -100 after the last."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.concat(F.slice(ids, F.lit(2), F.size(ids) - 1), F.array(F.lit(-100)))


def sampled_rows(rows: DataFrame, n: int, n_rows: int, seed: int = 0) -> DataFrame:
    """n rows with replacement, as (draw, row, ...): a hash of the draw picks the row."""
    draws = rows.sparkSession.range(n).select(
        F.col("id").alias("draw"), F.pmod(drawn(F.lit("row"), F.lit(seed), F.col("id")), F.lit(n_rows)).alias("row")
    )
    return draws.join(rows, "row")


def mixture(spark, weights: dict[str, float], n: int, seed: int = 0) -> DataFrame:
    """n draws (draw, pack) of packs by weight: a hash of the draw against the running sums of the weights."""
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("no weight")
    u = drawn(F.lit("pack"), F.lit(seed), F.col("id")) / F.lit(1 << 60)
    names, reached, choice = list(weights), 0.0, None
    for name in names[:-1]:
        reached += weights[name] / total
        choice = F.when(u < reached, name) if choice is None else choice.when(u < reached, name)
    return spark.range(n).select(
        F.col("id").alias("draw"), (F.lit(names[0]) if choice is None else choice.otherwise(names[-1])).alias("pack")
    )
