"""Best-fit-decreasing packing into sequences of bounded length.

A piece is at most `seq_len` tokens, so the pieces of any corpus are counted in at most seq_len
numbers, one per length. Best-fit decreasing runs on those: lengths from long to short, and for each the
tightest open bin, found by a segment tree over remaining capacities. All bins of one
capacity are alike, so a step places as many pieces as go into that class of bins; it puts every
piece where placing them one by one would. The resulting plan has a few rows per length whatever
the size of the corpus. Pieces are ranked within their length by prefix sums over parts, the scan tasks that made
them; each part meets its sums, one number per length, by a shuffle and looks up its pieces' places in the plan.

Nulls and so on: a null text is empty and makes one piece, the end token alone; rows that share a doc_id,
and rows with a null one, are packed each for itself; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm._lexicon import Lexicon
from textmill.llm._stage import Stage
from textmill.llm._text import Words, slices, texts

SEQ_LEN = 2048
_LEXICONS: dict[str, Lexicon] = {}


class Tightest:
    """A segment tree over capacities 0 to n: which is the least one, from a given one up, that has bins."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.some = bytearray(2 * self.size)

    def put(self, capacity: int, some: bool) -> None:
        i = capacity + self.size
        self.some[i] = some
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def find(self, least: int) -> int | None:
        i = least + self.size
        if self.some[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan(counts: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, from rank, first sequence, offset, pieces per bin): pieces of a length from that rank
    on fill the sequences from that one on, so many in each, the first at that offset."""
    tree, bins, opened, rows = Tightest(seq_len), {}, 0, []

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            bins.setdefault(capacity, []).append((first, n))
            tree.put(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            c = tree.find(length)
            if c is None:
                c, first, n = seq_len, opened, -(-left // (seq_len // length))
                opened += n
            else:
                first, n = bins[c].pop()
                if not bins[c]:
                    del bins[c]
                    tree.put(c, False)
            each = c // length
            used = min(n, -(-left // each))
            rows.append((length, rank, first, seq_len - c, each))
            put(c, first + used, n - used)
            placed = min(left, used * each)
            full, rest = divmod(placed, each)
            put(c - each * length, first, full)
            if rest:
                put(c - rest * length, first + full, 1)
            rank, left = rank + placed, left - placed
    return rows


def _lexicon(path: str) -> Lexicon:
    if path not in _LEXICONS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _LEXICONS[path] = Lexicon(
            lambda words: [e.ids for e in t.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)], [0]
        )
    return _LEXICONS[path]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


def pieces(path: str, seq_len: int):
    """Tokenises whole texts; white space parts words, which this tokenizer never joins across it."""

    def run(batches):
        lexicon, part, seen = _lexicon(path), TaskContext.get().partitionId(), np.zeros(seq_len + 1, np.int64)
        for batch in batches:
            data, off = texts(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in slices(off):
                w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                entry = np.insert(lexicon.entries(w.data, w.start, w.end) if w.n else np.zeros(0, np.int64), w.first[1:], 0)
                tokens, size = lexicon.tokens(entry)
                end = np.cumsum(size)[w.first[1:] + np.arange(w.n_docs)]
                begin = np.r_[0, end[:-1]]
                n = -(-(end - begin) // seq_len)
                doc = np.repeat(np.arange(b - a), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * seq_len
                length = np.minimum((end - begin)[doc] - start, seq_len)
                raw, at = tokens.astype("<u4"), begin[doc] + start
                crc = [zlib.crc32(raw[x : x + y]) for x, y in zip(at.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                s = length[order]
                lead = np.r_[True, s[1:] != s[:-1]] if len(s) else np.zeros(0, bool)
                nth = np.empty(len(s), np.int64)
                nth[order] = np.arange(len(s)) - np.flatnonzero(lead)[np.cumsum(lead) - 1]
                rank = seen[length] + nth
                seen += np.bincount(length, minlength=seq_len + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(doc + a)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(doc), pa.int32()),
                        pa.array(rank, pa.int64())
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"],
                )

    return run


def placed(rows: list[tuple[int, int, int, int, int]], seq_len: int):
    """Places a part's pieces: of its row of numbers, how many pieces of each length come before in earlier parts, and the plan."""
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 48) + table[:, 1]

    def run(pieces: pa.Table, before: pa.Table) -> pa.Table:
        above = np.zeros(seq_len + 1, np.int64)
        above[before.column("length").to_numpy()] = before.column("before").to_numpy()
        length = pieces.column("length").to_numpy()
        rank = pieces.column("rank").to_numpy() + above[length]
        r = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
        nth = rank - r[:, 1]
        columns = {k: pieces.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        return pa.table(columns | {"sequence_id": pa.array(r[:, 2] + nth // r[:, 4]), "offset": pa.array(r[:, 3] + nth % r[:, 4] * length)})

    return run


def pack(docs: DataFrame, seq_len: int = SEQ_LEN, tokenizer: str | None = None) -> DataFrame:
    """Per piece of the documents (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    stage = Stage(docs.sparkSession, "packing")
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    made = stage.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces(path, seq_len), PIECE), "pieces")
    # rank is the rank within a task's pieces of that length; those of earlier tasks come before
    per_part = stage.save(
        made.groupBy("length", "part").agg(F.max("rank").alias("last")).withColumn("n", F.col("last") + 1).drop("last"), "counts"
    )
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # seq_len rows at most
    before = per_part.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    # a part, the pieces of one scan task and seq_len numbers at most, meets its numbers by a shuffle of pieces, not of texts
    return made.groupBy("part").cogroup(before.groupBy("part")).applyInArrow(placed(plan(counts, seq_len), seq_len), schema)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
