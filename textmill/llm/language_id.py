"""Language identification of mixed-language text by Viterbi over words.

Script ranges narrow each word's candidates to the languages that use one of its scripts; a word without letters
speaks for none. A candidate's score for a word is the naive Bayes log likelihood of the word's byte
trigrams, as a log posterior over the candidates. Viterbi with a switching penalty then labels the words; runs
of one label are the spans, and the document's language is the label of most of its words with letters.

Fitting: of every language up to about PER_LANG documents, picked by a hash of doc_id, so the model, a row of
2 ** BITS numbers per language, is bounded whatever the corpus. Only text and lang are used to fit and
only text to predict.

Nulls and so on: a null, empty or letterless text is `und` with score 0, as is every text if no language was learned.
A row without doc_id is never held out. Equal counts go to the language that sorts first. Rows stand each
for themselves; extra columns are ignored by `identify` and kept by `keep`. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm._text import SLICE, Words, mix, pack, ranges, slices, spans, texts, unpack

PER_LANG, BITS, PENALTY, FLOOR = 2000, 16, 6.0, -12.0
#: Slices of text decoded at once, times languages: a step of Viterbi is the dearer the fewer texts it moves.
TOGETHER = 8
#: A language uses a script that makes up this share of its letters.
USES = 0.01
# First code points of the ranges of scripts, by the Unicode blocks.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x6FF), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF)
]


@lru_cache(1)
def _script_bits() -> np.ndarray:
    """Per code point: 0 if no letter, else the bit of its script (the lowest for all others)."""
    out = np.zeros(0x110000, np.uint32)
    names = sorted({s for s, _, _ in SCRIPTS})
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            out[c] = 1
    for name, a, b in SCRIPTS:
        part = out[a : b + 1]
        part[part > 0] = 2 << names.index(name)
    return out


def letter_bits(data: np.ndarray) -> np.ndarray:
    """Per byte: the script bit of the letter that begins there, or 0."""
    n = len(data)
    d = np.r_[data, np.zeros(3, np.uint8)].astype(np.int32)
    cp = np.where(d[:n] < 0x80, d[:n], 0)
    two, three, four = (d[:n] >= 0xC0) & (d[:n] < 0xE0), (d[:n] >= 0xE0) & (d[:n] < 0xF0), d[:n] >= 0xF0
    for where, size, top in ((two, 2, 0x1F), (three, 3, 0x0F), (four, 4, 0x07)):
        i = np.flatnonzero(where)
        if len(i):
            x = d[i] & top
            for k in range(1, size):
                x = (x << 6) | (d[i + k] & 0x3F)
            cp[i] = np.minimum(x, 0x10FFFF)
    return _script_bits()[cp]


def grams(data: np.ndarray, start: np.ndarray, end: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of words, one around each byte, lower case for ASCII; a word's first and end gram."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    size = end - start
    at = ranges(start, size)
    first = np.cumsum(size) - size
    mid = low[at]
    left, right = np.r_[np.uint64(32), mid[:-1]], np.r_[mid[1:], np.uint64(32)]
    left[first] = 32
    right[first + size - 1] = 32
    return (mix(left << np.uint64(16) | mid << np.uint64(8) | right) >> np.uint64(64 - bits)).astype(np.int64), first


class Model:
    """log_p: per language and gram; uses: the script bits of each language."""

    def __init__(self, langs: list[str], counts: list[np.ndarray], scripts: list[np.ndarray]):
        order = sorted(range(len(langs)), key=lambda i: langs[i])
        self.langs = [langs[i] for i in order]
        c = np.array([counts[i] for i in order], np.float64).reshape(len(langs), 1 << BITS) + 0.1
        self.log_p = (np.log(c) - np.log(c.sum(axis=1, keepdims=True))).astype(np.float32)
        s = np.array([scripts[i] for i in order], np.float64).reshape(len(langs), 32)
        self.uses = (
            (s >= USES * s.sum(axis=1, keepdims=True)) & (s > 0)
        ) @ (1 << np.arange(s.shape[1])) if langs else np.zeros(0, np.int64)

    def scores(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Log posteriors of the languages per word (0 for all where there is no letter), and whether it has a letter."""
        _, one, inverse = np.unique(mix(spans(w.data, w.start, w.end)), return_index=True, return_inverse=True)
        start, end = w.start[one], w.end[one]
        g, first = grams(w.data, start, end)
        bits = np.bitwise_or.reduceat(letter_bits(w.data)[ranges(start, end - start)], first).astype(np.int64)
        s = np.stack([np.add.reduceat(p[g], first) for p in self.log_p], 1)
        can = (bits[:, None] & self.uses[None, :]) > 0
        can |= ~can.any(axis=1, keepdims=True)
        s = np.where(can, s, -np.inf)
        s -= s.max(axis=1, keepdims=True)
        s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
        s = np.maximum(s, np.float32(FLOOR))
        s[bits == 0] = 0
        return s[inverse], (bits > 0)[inverse]


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best labels of the words of all texts at once, one word of each text a step."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    begin, n = first[:-1][order], n[order]
    labels = np.zeros(len(scores), np.int16)
    if not len(n) or not n[0] or not scores.shape[1]:
        return labels
    active = np.searchsorted(-n, -np.arange(1, n[0] + 1), "right")  # texts that have a word t
    came = np.zeros(scores.shape, bool)  # whether the best way to this label is a switch
    top = np.zeros(len(scores), np.int16)  # the best label so far
    v = None
    for t in range(n[0]):
        k = active[t]
        at = begin[:k] + t
        if t == 0:
            v = scores[at]
        else:
            v = v[:k]
            best = v[np.arange(k), top[at - 1]] - penalty
            sw = best[:, None] > v
            came[at] = sw
            v = np.where(sw, best[:, None], v) + scores[at]
        top[at] = v.argmax(axis=1)
    now = np.zeros(len(n), np.int16)
    for t in range(n[0] - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        ends = n[:k] == t + 1
        now[:k][ends] = top[at[ends]]
        labels[at] = now[:k]
        if t:
            sw = came[at, now[:k]]
            now[:k][sw] = top[at[sw] - 1]
    return labels


def _count(batches):
    for batch in batches:
        lang = batch.column("lang").to_pylist()
        data, off = texts(batch.column("text"))
        found: dict[str, list[np.ndarray]] = {}
        for a, b in slices(off):
            w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
            if not w.n:
                continue
            has = np.bitwise_or.reduceat(np.r_[letter_bits(w.data), np.uint32(0)], np.c_[w.start, w.end].ravel())[::2]
            names = sorted({x for x in lang[a:b] if x is not None})
            of = np.array([names.index(x) if x is not None else -1 for x in lang[a:b]])[w.doc]
            for i, name in enumerate(names):
                m = (of == i) & (has > 0)
                if not m.any():
                    continue
                counts, scripts = found.setdefault(name, [np.zeros(1 << BITS), np.zeros(32)])
                counts += np.bincount(grams(w.data, w.start[m], w.end[m])[0], minlength=1 << BITS)
                bits = has[m].astype(np.int64)
                scripts += ((bits[:, None] >> np.arange(32)) & 1).sum(axis=0)
        if found:
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array(list(found)), "counts": pa.array([pack(x.astype(np.int64)) for x, _ in found.values()], pa.binary()),
                    "scripts": pa.array([pack(x.astype(np.int64)) for _, x in found.values()], pa.binary())
                }
            )


def _sum(group: pa.Table) -> pa.Table:
    total = lambda k: pack(np.sum([unpack(x, np.int64) for x in group.column(k).to_pylist()], axis=0))
    return pa.table(
        {
            "lang": group.column("lang").slice(0, 1), "counts": pa.array([total("counts")], pa.binary()),
            "scripts": pa.array([total("scripts")], pa.binary())
        }
    )


def remainder(n: int):
    """crc32 of doc_id as text, modulo n; 0 without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(0))


def fit(train: DataFrame, per_lang: int = PER_LANG) -> Model:
    """A model from rows of (doc_id, text, lang)."""
    train = train.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    rare = [x for x, n in counts.items() if n <= per_lang]
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(per_lang / n)) for x, n in counts.items() if n > per_lang], F.lit(1.0))
    picked = train.where(F.col("lang").isin(rare) | (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))) if counts else train
    schema = "lang string, counts binary, scripts binary"
    rows = picked.select("lang", "text").mapInArrow(_count, schema).groupBy("lang").applyInArrow(_sum, schema).collect()
    return Model([r["lang"] for r in rows], [unpack(r["counts"], np.int64) for r in rows], [unpack(r["scripts"], np.int64) for r in rows])


def predict(model: Model, w: Words, penalty: float = PENALTY) -> tuple[list, list, np.ndarray]:
    """Per text: language and score; the label of each word."""
    n_langs = len(model.langs)
    if not w.n or not n_langs:
        return ["und"] * w.n_docs, [0.0] * w.n_docs, np.zeros(w.n, np.int16)
    scores, letter = model.scores(w)
    labels = viterbi(scores, w.first, penalty)
    votes = np.bincount((w.doc * n_langs + labels)[letter], minlength=w.n_docs * n_langs).reshape(-1, n_langs)
    total, best = votes.sum(axis=1), votes.argmax(axis=1)
    return [
        model.langs[i] if t else "und" for i, t in zip(best.tolist(), total.tolist())
    ], (votes.max(axis=1) / np.maximum(total, 1)).tolist(), labels


def _predict(model: Model, columns: list[str], with_spans: bool):
    def run(batches):
        for batch in batches:
            data, off = texts(batch.column("text"))
            lang, score, found = [], [], []
            for a, b in slices(off, SLICE * max(1, TOGETHER // max(1, len(model.langs)))):
                w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                x, y, labels = predict(model, w)
                lang += x
                score += y
                if with_spans:
                    for i in range(w.n_docs):
                        p = labels[w.first[i] : w.first[i + 1]]
                        cut = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]).tolist() if len(p) and x[i] != "und" else []
                        found.append([{"first_word": s, "end_word": e, "lang": model.langs[p[s]]} for s, e in zip(cut, [*cut[1:], len(p)])])
            out = {c: batch.column(c) for c in columns} | {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())}
            if with_spans:
                out["spans"] = pa.array(
                    found, pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("lang", pa.string())]))
                )
            yield pa.RecordBatch.from_pydict(out)

    return run


SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType()), T.StructField("lang", T.StringType())]
    )
)


def identify(docs: DataFrame, model: Model, with_spans: bool = False) -> DataFrame:
    """The rows with lang_pred, score and, if asked for, spans (of words, numbered from 0, `end_word` excluded)."""
    fields = [f for f in docs.schema if f.name not in ("lang_pred", "score", "spans")]
    extra = [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())
    ] + [T.StructField("spans", SPANS)] * with_spans
    columns = [f.name for f in fields]
    return docs.select(*columns).mapInArrow(_predict(model, columns, with_spans), T.StructType(fields + extra))


def keep(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The rows, with their columns, that are not `und`. A text of several languages stays, however they share it, unless `least` asks
    that one language has so much of the words with letters."""
    plain = docs.select("*", F.lit(True).alias("_row"))
    fields = list(plain.schema)
    names = [f"c{i}" for i in range(len(fields))]
    renamed = plain.toDF(*[f.name if f.name == "text" else n for f, n in zip(fields, names)])
    found = identify(renamed, model).where((F.col("lang_pred") != "und") & (F.col("score") >= least)).drop("lang_pred", "score", names[-1])
    return found.toDF(*docs.columns)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(remainder(4) != 2))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")
