"""Substring dedup by fixed-block anchors.

Index: the non-overlapping blocks of BLOCK words of every document (words 0-9, 10-19, ...). Probe:
every rolling window of BLOCK words. A span of `window` words (at least 2 * BLOCK - 1) that occurs
twice holds a whole block of either occurrence, so both are hit. A hit is extended to the windows
of `window` words around it, and those that occur earlier, read in order of (doc_id, start), make
up the maximal exact repeats: runs of such windows, with all the words they cover.

Hashes go between chunks of documents, never documents or pairs: see _chunks. Index and probes carry
48 bits, so a false hit can only make more candidates; windows are compared by 128 bits, two hashes of
windows over two independent hashes of words (polynomials of other bases over the bytes).

Nulls, ties and so on: a null or empty text has no words, is returned with n_words 0, and removes
nothing; null doc_ids sort before all others; rows that share a doc_id keep the order that Spark
gives them, and the later one loses; extra columns are ignored by `repeats` and kept by `dedup`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm import _chunks as C
from textmill.llm._stage import Stage, plain
from textmill.llm._text import Words, inside, member, mix, ranges, slices, spans, texts, unpack, unpack_sorted, windows

BLOCK = 10
WINDOW = 20
_KEY = np.uint64(16)  # bits of a block's hash that are not sent


def _blocks(words: Words, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the rolling windows of BLOCK words, and the 48-bit hash of each."""
    at = inside(words.first, BLOCK)
    return at, windows(wh, BLOCK)[at] >> _KEY if len(at) else np.zeros(0, np.uint64)


def _send_blocks(n_buckets: int):
    def run(batches):
        for chunk, batch in C.by_chunk(batches):
            data, off = texts(batch.column("text"))
            found = []
            for a, b in slices(off):
                w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                at, h = _blocks(w, w.hashes())
                aligned = (at - np.repeat(w.first[:-1], np.maximum(np.diff(w.first) - BLOCK + 1, 0))) % BLOCK == 0
                found.append((h << np.uint64(1)) | aligned)
            s = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
            if not len(s):
                continue
            h = s >> np.uint64(1)
            begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            n = np.diff(np.r_[begin, len(h)])
            state = (np.bitwise_or.reduceat(s & np.uint64(1), begin) | ((n > 1).astype(np.uint64) << np.uint64(1))).astype(np.uint8)
            yield C.send(chunk, h[begin], n_buckets, state, 48)

    return run


def _answer_blocks(group: pa.Table) -> pa.Table:
    """For each chunk its blocks that are indexed somewhere and occur more than once."""
    chunk = group.column("chunk").to_pylist()
    keys = [unpack_sorted(x) for x in group.column("a").to_pylist()]
    state = np.concatenate([unpack(x, np.uint8) for x in group.column("b").to_pylist()])
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    s, state = flat[order], state[order]
    begin = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    n = np.diff(np.r_[begin, len(s)])
    state = np.bitwise_or.reduceat(state, begin)
    hit = s[begin][((state & 1) > 0) & ((n > 1) | (state > 1))]
    return _reply_sorted(chunk, keys, lambda k: member(hit, k))


def _reply_sorted(chunk, keys, keep, extra=None) -> pa.Table:
    from textmill.llm._text import pack, pack_sorted

    out = []
    for i, (c, k) in enumerate(zip(chunk, keys)):
        m = keep(k) if extra is None else keep(i)
        if m.any():
            out.append((c, pack_sorted(k[m]), None if extra is None else pack(extra[i][m])))
    return C.reply(out)


_OTHER = np.uint64(0xA0761D6478BD642F)


def _tail(words: Words, at: np.ndarray, size: int) -> np.ndarray:
    """A second hash of windows, from word hashes of its own."""
    return windows(mix(spans(words.data, words.start, words.end, _OTHER), 7), size, 3)[at]


def _send_windows(n_buckets: int, size: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        hits = [unpack_sorted(x) for x in answers.column("a").to_pylist()]
        hits = np.sort(np.concatenate(hits)) if hits else np.zeros(0, np.uint64)
        if not len(hits) or not docs.num_rows:
            return pa.table(
                {
                    "bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int32()), "a": pa.array([], pa.binary()),
                    "b": pa.array([], pa.binary())
                }
            )
        data, off = texts(docs.column("text"))
        keys, tails = [], []
        for a, b in slices(off):
            w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
            wh = w.hashes()
            at, h = _blocks(w, wh)
            hit = np.zeros(w.n + 1, np.int32)
            hit[at + 1] = member(hits, h)
            hit = np.cumsum(hit)
            at = inside(w.first, size)
            at = at[hit[at + size - BLOCK + 1] > hit[at]]  # a window with a hit inside
            if len(at):
                keys.append(windows(wh, size, 1)[at])
                tails.append(_tail(w, at, size))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        tails = np.concatenate(tails) if tails else np.zeros(0, np.uint64)
        order = np.lexsort((tails, keys))
        keys, tails = keys[order], tails[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (tails[1:] != tails[:-1])] if len(keys) else np.zeros(0, bool)
        return pa.Table.from_batches([C.send(int(docs.column("chunk")[0].as_py()), keys[new], n_buckets, tails[new])])

    return run


def _answer_windows(group: pa.Table) -> pa.Table:
    """For each chunk its windows that an earlier chunk has too."""
    chunk = group.column("chunk").to_pylist()
    keys = [unpack_sorted(x) for x in group.column("a").to_pylist()]
    tails = [unpack(x, np.uint64) for x in group.column("b").to_pylist()]
    k, t = np.concatenate(keys), np.concatenate(tails)
    of = np.repeat(np.array(chunk), [len(x) for x in keys])
    order = np.lexsort((of, t, k))
    ks, ts, cs = k[order], t[order], of[order]
    new = np.r_[True, (ks[1:] != ks[:-1]) | (ts[1:] != ts[:-1])]
    least = cs[np.flatnonzero(new)][np.cumsum(new) - 1]
    late = np.empty(len(k), bool)
    late[order] = cs > least
    at = np.cumsum([0, *map(len, keys)])
    return _reply_sorted(chunk, keys, lambda i: late[at[i] : at[i + 1]], tails)


def covered(words_first: np.ndarray, at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether each of n words lies in a window that starts at one of `at`."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, at, 1)
    np.subtract.at(d, at + size, 1)
    return np.cumsum(d[:-1]) > 0


def joined(words: Words, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words, a space after each, and the end of each text's part."""
    start, size = words.start[keep], (words.end - words.start)[keep] + 1
    out = np.r_[words.data, np.uint8(32)][ranges(start, size)] if len(start) else np.zeros(0, np.uint8)
    end = np.cumsum(size)
    out[end - 1] = 32
    kept = np.r_[0, np.cumsum(keep)][words.first]
    return out.tobytes(), np.r_[0, end][kept]


def _remove(size: int, with_text: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return None
        docs = docs.sort_by([("doc_id", "ascending")]) if docs.column("doc_id").null_count == 0 else docs.take(
            pa.compute.sort_indices(docs, [("doc_id", "ascending")], null_placement="at_start")
        )
        early = [unpack_sorted(x) for x in answers.column("a").to_pylist()]
        tails = [unpack(x, np.uint64) for x in answers.column("b").to_pylist()]
        early = np.concatenate(early) if early else np.zeros(0, np.uint64)
        tails = np.concatenate(tails) if tails else np.zeros(0, np.uint64)
        data, off = texts(docs.column("text"))
        parts, at_all, key_all, tail_all, base = [], [], [], [], 0
        for a, b in slices(off):
            w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
            wh = w.hashes()
            at = inside(w.first, size)
            if len(at):
                key_all.append(windows(wh, size, 1)[at])
                tail_all.append(_tail(w, at, size))
                at_all.append(at + base)
            parts.append((w, base))
            base += w.n
        keys = np.concatenate(key_all) if key_all else np.zeros(0, np.uint64)
        at = np.concatenate(at_all) if at_all else np.zeros(0, np.int64)
        gone = covered(None, at[repeated(keys, np.concatenate(tail_all) if tail_all else keys, early, tails)], size, base)
        n_words, n_removed, digest, text = [], [], [], []
        for w, base in parts:
            g = gone[base : base + w.n]
            raw, end = joined(w, ~g)
            cum = np.r_[0, np.cumsum(g)]
            n_words += np.diff(w.first).tolist()
            n_removed += np.diff(cum[w.first]).tolist()
            for i in range(w.n_docs):
                kept = raw[end[i] : max(end[i], end[i + 1] - 1)]
                digest.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    text.append(kept if n_removed[len(digest) - 1] else None)
        out = {
            "doc_id": docs.column("doc_id").cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())
        }
        if with_text:
            rest = {k: docs.column(k) for k in docs.column_names if k not in ("chunk", "doc_id")}
            was = pa.array(text, pa.binary()).cast(pa.string())
            rest["text"] = pa.compute.coalesce(was, rest["text"].cast(pa.string()))
            return pa.table({"doc_id": docs.column("doc_id"), **rest, "_words": out["n_words"], "_removed": out["n_removed"]})
        return pa.table(out)

    return run


def repeated(keys: np.ndarray, tails: np.ndarray, early: np.ndarray, early_tails: np.ndarray) -> np.ndarray:
    """Whether each window, of two hashes, is among the early ones or is equal to one before it."""
    n = len(keys)
    k, t = np.r_[early, keys], np.r_[early_tails, tails]
    # only windows whose first hash occurs more than once need the second one
    order = np.argsort(k, kind="stable")
    same = k[order][1:] == k[order][:-1]
    order = order[np.r_[same, False] | np.r_[False, same]] if len(k) else order
    order = order[np.lexsort((order, t[order], k[order]))]
    again = np.zeros(len(k), bool)
    again[order[1:]] = (k[order][1:] == k[order][:-1]) & (t[order][1:] == t[order][:-1])
    return again[len(k) - n :]


def _run(docs: DataFrame, window: int, with_text: bool, schema: str | T.StructType, chunk_bytes: int) -> DataFrame:
    if window < 2 * BLOCK - 1:
        raise ValueError(f"a window takes at least {2 * BLOCK - 1} words")
    spark = docs.sparkSession
    stage = Stage(spark, "substring")
    _, size = C.measure(docs)
    table, n = C.chunked(stage, docs, size, chunk_bytes)
    n_buckets = C.buckets(n, spark)
    sent = table.select("chunk", "text").mapInArrow(_send_blocks(n_buckets), C.SENT)
    hits = stage.save(C.exchange(sent, _answer_blocks), "hits")
    stage.release()
    sent = C.with_answers(table.select("chunk", "text"), hits, _send_windows(n_buckets, window), C.SENT)
    late = stage.save(C.exchange(sent, _answer_windows), "late")
    stage.drop("hits")
    return C.with_answers(table if with_text else table.select("chunk", "doc_id", "text"), late, _remove(window, with_text), schema)


def repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = C.CHUNK) -> DataFrame:
    """Per document of (doc_id, text): doc_id, n_words, n_removed, kept_sha256."""
    return _run(docs.select("doc_id", "text"), window, False, "doc_id long, n_words long, n_removed long, kept_sha256 string", chunk_bytes)


def dedup(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = C.CHUNK) -> DataFrame:
    """The documents, repeated passages cut out of `text`: a document that loses words becomes its kept
    words joined by spaces, and goes if none is left; any other stays as it is. Columns stay, with n_chars, if there, counted anew."""
    renamed, names = plain(docs)
    rest = [f for f in renamed.schema if f.name != "doc_id"]
    schema = T.StructType([renamed.schema["doc_id"], *rest, T.StructField("_words", T.LongType()), T.StructField("_removed", T.LongType())])
    out = _run(renamed, window, True, schema, chunk_bytes)
    out = out.where((F.col("_removed") == 0) | (F.col("_removed") < F.col("_words")))
    if "n_chars" in docs.columns:
        c = names[docs.columns.index("n_chars")]
        out = out.withColumn(c, F.when(F.col("_removed") > 0, F.length("text")).otherwise(F.col(c)).cast(docs.schema["n_chars"].dataType))
    return out.select(*names).toDF(*docs.columns)


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, string_split_regex(trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w FROM documents),
e AS (SELECT doc_id, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM e)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM late, (SELECT unnest(range(0, 20)) AS j)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM e),
per AS (SELECT word.doc_id, count(gone.i) AS n, string_agg(x, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS kept
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
SELECT e.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM e LEFT JOIN per ON e.doc_id = per.doc_id
"""
