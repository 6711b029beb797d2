"""Byte-level BPE over numpy matrices.

Texts are parted into spans between which the split pattern never matches across (runs of ASCII
white space, and words with the one space before them); each distinct span is split by the
pattern and its pieces are encoded once. Pieces of like length make a padded matrix. In
each round every row merges its leftmost pair of minimum rank: ranks of pairs come from a hashed
table, rows close up after a merge, and rows without a pair left leave the matrix. Texts that hold
white space beyond ASCII are split by the pattern as a whole.

Nulls and so on: a null text is empty, with no ids; rows stand each for themselves, also with equal or null
doc_ids; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from textmill.llm._lexicon import Lexicon
from textmill.llm._text import Words, mix, ranges, slices, texts

NONE = np.int32(2**31 - 1)
#: Widest matrix. A round costs a row's width, so a piece costs its square; longer pieces are rows of their own, see merge_long.
WIDEST = 4096
_WIDTHS = np.array([2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 64, 128, 256, 512, 1024, 2048, WIDEST])


class Pairs:
    """A hash table from a pair of ids to the id, and rank, that they merge to."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        self.bits = max(4, (4 * len(found)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        keys, values = np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int32, len(found))
        at = self._slot(keys)
        while len(keys):  # all that find their slot free take it, one each; the others go on to the next
            free = self.keys[at] < 0
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            lost = self.keys[at] != keys
            keys, values, at = keys[lost], values[lost], (at[lost] + 1) & ((1 << self.bits) - 1)
        # a slot's value belongs to the last key written there, as its key does

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE where there is no merge, or where either id is -1."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        flat = keys.ravel()
        at = self._slot(flat)
        there = self.keys[at]
        out = np.where(there == flat, self.values[at], NONE)
        go = np.flatnonzero((there != flat) & (there >= 0) & (flat >= 0))
        at = at[go]
        while len(go):
            at = (at + 1) & ((1 << self.bits) - 1)
            there = self.keys[at]
            hit = there == flat[go]
            out[go[hit]] = self.values[at[hit]]
            on = ~hit & (there >= 0)
            go, at = go[on], at[on]
        return out.reshape(keys.shape)


class ByteBPE:
    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.pairs = Pairs(self.ranks)
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        n = max(self.ranks.values()) + 1
        tokens = [b""] * n
        for t, i in self.ranks.items():
            tokens[i] = t
        self.size = np.array([len(t) for t in tokens])
        self.start, self.bytes = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(tokens), np.uint8)
        self.lexicon = Lexicon(self.encode_spans, [])

    def encode_spans(self, found: list[bytes]) -> list:
        """Ids of each span: those of its matches of the pattern, one after the other."""
        parts = [self.pattern.findall(x.decode("utf-8", "replace")) for x in found]
        pieces = {p: None for ps in parts for p in ps}
        ids = dict(zip(pieces, self.encode_pieces([p.encode() for p in pieces])))
        return [ids[ps[0]] if len(ps) == 1 else [i for p in ps for i in ids[p]] for ps in parts]

    def encode_pieces(self, pieces: list[bytes]) -> list:
        out: list = [None] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            if (r := self.ranks.get(p)) is not None:  # a piece that is a token is that token
                out[i] = (r,)
            else:
                todo.append(i)
        size = np.array([len(pieces[i]) for i in todo], np.int64)
        bucket = np.searchsorted(_WIDTHS, size)
        for k in np.unique(bucket):
            rows = [todo[i] for i in np.flatnonzero(bucket == k)]
            if k == len(_WIDTHS):
                for i in rows:
                    out[i] = self.merge_long(pieces[i]).tolist()
                continue
            w = int(_WIDTHS[k])
            for j in range(0, len(rows), max(1, (1 << 20) // w)):
                part = rows[j : j + max(1, (1 << 20) // w)]
                for i, x in zip(part, self.merge([pieces[i] for i in part], w)):
                    out[i] = x
        return out

    def merge(self, pieces: list[bytes], w: int) -> list:
        n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, n)
        m = np.full((n, w), -1, np.int32)
        m[np.arange(w) < size[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        left, who, out = np.arange(w), np.arange(n), [None] * n
        rank = self.pairs.ranks(m[:, :-1], m[:, 1:])
        while len(m):
            j = rank.argmin(axis=1)  # the leftmost of the least
            r = rank[np.arange(len(m)), j]
            done = r == NONE
            if done.any():
                rows = m[done]
                for i, x, k in zip(who[done].tolist(), rows.tolist(), (rows >= 0).sum(axis=1).tolist()):
                    out[i] = x[:k]
                go = ~done
                m, rank, who, j, r = m[go], rank[go], who[go], j[go], r[go]
                if not len(m):
                    break
            width = max(2, int((m >= 0).sum(axis=1).max()))
            m, rank, left = m[:, :width], rank[:, : width - 1], left[:width]
            row = np.arange(len(m))
            m[row, j] = r
            take = left[:-1] + (left[:-1] > j[:, None])
            m = np.concatenate([np.take_along_axis(m, take, 1), np.full((len(m), 1), -1, np.int32)], 1)
            take = left[: width - 1] + (left[: width - 1] >= j[:, None])
            rank = np.take_along_axis(np.concatenate([rank, np.full((len(m), 1), NONE, np.int32)], 1), take, 1)
            rank[row, j] = self.pairs.ranks(m[row, j], m[row, np.minimum(j + 1, width - 1)])
            rank[j == width - 1, -1] = NONE
            some = j > 0
            rank[row[some], j[some] - 1] = self.pairs.ranks(m[row[some], j[some] - 1], m[row[some], j[some]])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """One row. Equal pairs of the least rank are merged in one go, from the left, where no pair
        that this makes ranks as low or lower: then they would come next one by one as well."""
        m = self.byte[np.frombuffer(piece, np.uint8)]
        while len(m) > 1:
            rank = self.pairs.ranks(m[:-1], m[1:])
            r = rank.min()
            if r == NONE:
                break
            at = np.flatnonzero(rank == r)
            if len(at) > 1:  # of a run of overlapping pairs, every other
                lead = np.r_[True, np.diff(at) > 1]
                at = at[(at - at[lead][np.cumsum(lead) - 1]) % 2 == 0]
            new = self._merged(m, at, r)
            if len(at) > 1:
                where = at - np.arange(len(at))
                near = np.unique(np.clip(np.r_[where - 1, where], 0, max(0, len(new) - 2)))
                if len(new) > 1 and self.pairs.ranks(new[near], new[near + 1]).min() <= r:
                    new = self._merged(m, at[:1], r)
            m = new
        return m

    @staticmethod
    def _merged(m: np.ndarray, at: np.ndarray, r: int) -> np.ndarray:
        m = m.copy()
        m[at] = r
        return np.delete(m, at + 1)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end bytes of the spans of some texts, and the number of spans of each text."""
        w = Words(data, offsets)
        n = len(data)
        wide = np.zeros(w.n_docs, bool)
        if n and (data >= 0xC2).any():
            d1 = np.r_[data[1:], np.uint8(0)]
            lead = (
                (data == 0xC2) & ((d1 == 0x85) | (d1 == 0xA0))
            ) | (data == 0xE1) & (d1 == 0x9A) | (data == 0xE2) & ((d1 == 0x80) | (d1 == 0x81)) | (data == 0xE3) & (d1 == 0x80)
            wide[np.searchsorted(offsets, np.flatnonzero(lead), "right") - 1] = True
        opens = np.repeat(w.first[:-1], np.diff(w.first)) == np.arange(w.n)  # first word of its text
        before = np.where(opens, offsets[w.doc], np.r_[0, w.end[:-1]])
        own = (w.start > before) & (data[w.start - 1] == 32) if w.n else np.zeros(0, bool)
        cut = np.where(own, w.start - 1, np.maximum(w.start - 1, before))  # where white space's last single piece begins
        tail = np.diff(w.first)
        last = np.where(tail > 0, np.r_[w.end, 0][np.maximum(w.first[1:] - 1, 0)], offsets[:-1])
        a = np.concatenate([before, cut, np.where(own, w.start - 1, w.start), last])
        b = np.concatenate([cut, np.where(own, cut, w.start), w.end, offsets[1:]])
        doc = np.concatenate([w.doc, w.doc, w.doc, np.arange(w.n_docs)])
        keep = (b > a) & ~wide[doc]
        a, b, doc = a[keep], b[keep], doc[keep]
        for i in np.flatnonzero(wide):
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
            size = np.array([len(p.encode()) for p in self.pattern.findall(text)], np.int64)
            end = offsets[i] + np.cumsum(size)
            a, b, doc = np.r_[a, end - size], np.r_[b, end], np.r_[doc, np.full(len(size), i)]
        order = np.argsort(a, kind="stable")
        return a[order], b[order], np.bincount(doc, minlength=w.n_docs)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts, and offsets of each text's ids."""
        a, b, n = self.spans(data, offsets)
        if not len(a):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ids, size = self.lexicon.tokens(self.lexicon.entries(data, a, b))
        return ids, np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(n)]]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ranges(self.start[ids], self.size[ids])]


@lru_cache(4)
def bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


def _run(path: str, with_ids: bool):
    def run(batches):
        t = bpe(path)
        for batch in batches:
            data, off = texts(batch.column("text"))
            for a, b in slices(off):
                ids, at = t.encode(data[off[a] : off[b]], off[a : b + 1] - off[a])
                raw = t.decode(ids)
                ends = np.r_[0, np.cumsum(t.size[ids])][at].tolist()
                le, at = ids.astype("<u4"), at.tolist()
                rows = range(b - a)
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(le[at[i] : at[i + 1]]).hexdigest() for i in rows], pa.string()),
                    pa.array([hashlib.sha256(raw[ends[i] : ends[i + 1]]).hexdigest() for i in rows], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encoded(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _run(path, with_ids), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    )


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
