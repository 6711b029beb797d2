"""Quality rules, and line labels by a linear-chain conditional random field.

Lines with a word are labelled content or boilerplate: a line's features give the score of content, two by two
numbers that of neighbours, and Viterbi decoding the labels. A document stays if its base rules hold
and content lines have CONTENT of its words.

Fitting: up to about PER_CLASS labelled documents of each quality, picked by a hash of doc_id, of
MOST_LINES lines at most each (this bounds the sample only; every document is decoded whole).
Lines of good documents are content. Those of bad ones begin as boilerplate; then, ROUNDS times, the
fitted field decides which of them are content after all, the worst line excepted. Without labels of both qualities
every line counts as content.

Nulls and so on: a null, empty or blank text has no words and fails; rows stand each for themselves, also with
equal or null doc_ids; labels without doc_id or quality are ignored, and of several for a document the lowest
counts; extra columns are ignored by `judged` and kept by `keep`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm._text import Words, inside, mix, pack, slices, spans, texts, unpack, windows

PER_CLASS, MOST_LINES, ROUNDS, CONTENT = 2000, 400, 2, 0.5
NEED_WORDS, REPEAT_SHARE, WINDOW = 10, 20, 5
_TABLES = {
    k: np.isin(np.arange(256), [ord(c) for c in v])
    for k, v in {
        "symbol": "#*$%&|<>", "pipe": "|", "shout": "!", "digit": "0123456789", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "stop": ".!?\"')",
        "mark": "#*$%&|<>{}[]=_~^\\/@+", "comma": ",;:"
    }.items()
}
N_FEATURES = 14


class Lines:
    """Base figures of some texts and features of their lines with a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = self.words = Words(data, offsets)
        n_docs, doc = w.n_docs, w.doc
        cum = {k: np.r_[0, np.cumsum(t[data])] for k, t in _TABLES.items()}
        self.n_words = np.diff(w.first)
        self.n_symbols = np.diff(cum["symbol"][offsets])
        lead = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        size = lead[w.end] - lead[w.start]
        self.word_chars = np.bincount(doc, size, n_docs).astype(np.int64)
        h = w.hashes()
        own = mix(doc.astype(np.uint64), 3)  # the same words in another text differ
        at = inside(w.first, WINDOW)
        again = np.zeros(w.n + 1, np.int64)
        if len(at):
            key = windows(h, WINDOW)[at] + own[at]
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            hit = np.zeros(len(at), bool)
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            np.add.at(again, at[hit], 1)
            np.subtract.at(again, at[hit] + WINDOW, 1)
        repeated = np.cumsum(again[:-1]) > 0
        self.n_repeat_words = np.bincount(doc[repeated], minlength=n_docs)
        # lines with a word, as runs of words
        newline = np.flatnonzero(data == 10)
        nth = np.searchsorted(newline, w.start)
        begin = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (nth[1:] != nth[:-1])]) if w.n else np.zeros(0, np.int64)
        self.begin = begin
        self.doc = doc[begin]
        self.first = np.searchsorted(self.doc, np.arange(n_docs + 1))
        bounds = np.r_[-1, newline, len(data)]
        a = np.maximum(bounds[nth[begin]] + 1, offsets[self.doc])
        b = np.minimum(bounds[nth[begin] + 1], offsets[self.doc + 1])
        line = mix(spans(data, a, b), 1) + mix(self.doc.astype(np.uint64), 4)
        dup = np.ones(len(line), bool)
        dup[np.unique(line, return_index=True)[1]] = False
        self.n_dup_lines = np.bincount(self.doc[dup], minlength=n_docs)
        if not len(begin):
            self.n_line_words, self.x = np.zeros(0, np.int64), np.zeros((0, N_FEATURES), np.float32)
            return
        n = self.n_line_words = np.diff(np.r_[begin, w.n])
        last = begin + n - 1
        share = lambda k, by: (cum[k][b] - cum[k][a]) / np.maximum(by, 1)
        chars = np.add.reduceat(size, begin)
        _, distinct = np.unique(h + mix(np.repeat(np.arange(len(begin)), n).astype(np.uint64), 6), return_index=True)
        n_distinct = np.bincount(np.repeat(np.arange(len(begin)), n)[distinct], minlength=len(begin))
        self.x = np.stack([
            np.ones(len(begin)), np.minimum(share("symbol", n), 1), np.minimum(share("pipe", n), 1), np.minimum(share("shout", n), 1), share("upper", chars), share("digit", chars), np.minimum(share("mark", n), 1), np.minimum(share("comma", n), 1),
            _TABLES["stop"][data[w.end[last] - 1]], _TABLES["upper"][data[w.start[begin]]], dup, np.add.reduceat(
                repeated.astype(np.int64), begin
            ) / n, np.minimum(np.log1p(n) / 5, 1), 1 - n_distinct / n,
        ], 1).astype(np.float32)


class Field:
    """Weights of features for content, and scores of neighbouring labels (0 boilerplate, 1 content)."""

    def __init__(self, w: np.ndarray | None = None, t: np.ndarray | None = None):
        self.w, self.t = (np.eye(1, N_FEATURES)[0], np.zeros((2, 2))) if w is None else (w, t)

    def _steps(self, first: np.ndarray):
        n = np.diff(first)
        order = np.argsort(-n, kind="stable")
        begin, n = first[:-1][order], n[order]
        active = np.searchsorted(-n, -np.arange(1, (n[0] if len(n) else 0) + 1), "right")
        return begin, n, active

    def decode(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Viterbi labels of the lines of all texts at once."""
        s = np.stack([np.zeros(len(x)), x @ self.w], 1)
        begin, n, active = self._steps(first)
        came, labels, top = np.zeros((len(x), 2), np.int8), np.zeros(len(x), np.int8), np.zeros(len(x), np.int8)
        v = None
        for i, k in enumerate(active):
            at = begin[:k] + i
            if i == 0:
                v = s[at]
            else:
                way = v[:k, :, None] + self.t
                came[at] = way.argmax(axis=1)
                v = way.max(axis=1) + s[at]
            top[at] = v.argmax(axis=1)
        now = np.zeros(len(n), np.int8)
        for i in range(len(active) - 1, -1, -1):
            k = active[i]
            at = begin[:k] + i
            ends = n[:k] == i + 1
            now[:k][ends] = top[at[ends]]
            labels[at] = now[:k]
            now[:k] = came[at, now[:k]]
        return labels

    def gradient(self, x: np.ndarray, y: np.ndarray, first: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log likelihood of labels and its gradient, by forward and backward sums."""
        s = np.stack([np.zeros(len(x)), x @ self.w], 1)
        begin, n, active = self._steps(first)
        alpha, beta = np.zeros((len(x), 2)), np.zeros((len(x), 2))
        for i, k in enumerate(active):
            at = begin[:k] + i
            alpha[at] = s[at] + (np.logaddexp.reduce(alpha[at - 1][:, :, None] + self.t, axis=1) if i else 0)
        z = np.zeros(len(begin))
        for i in range(len(active) - 1, -1, -1):
            k = active[i]
            at = begin[:k] + i
            m = active[i + 1] if i + 1 < len(active) else 0
            if m:
                nxt = at[:m] + 1
                beta[at[:m]] = np.logaddexp.reduce(self.t + (s[nxt] + beta[nxt])[:, None, :], axis=2)
            z[:k] = np.logaddexp.reduce(alpha[at] + beta[at], axis=1)
        p = np.exp(alpha + beta - np.logaddexp.reduce(alpha + beta, axis=1)[:, None])
        gw = x.T @ (y - p[:, 1])
        pair = np.ones(len(x), bool)
        pair[first[:-1][np.diff(first) > 0]] = False
        j = np.flatnonzero(pair)
        gt = np.zeros((2, 2))
        ll = s[np.arange(len(x)), y.astype(int)].sum() - z[n > 0].sum()
        if len(j):
            lp = alpha[j - 1][:, :, None] + self.t + (s[j] + beta[j])[:, None, :]
            lp -= np.logaddexp.reduce(lp.reshape(len(j), 4), axis=1)[:, None, None]
            a, b = y[j - 1].astype(int), y[j].astype(int)
            gt = np.bincount(2 * a + b, minlength=4).reshape(2, 2) - np.exp(lp).sum(axis=0)
            ll += self.t[a, b].sum()
        return ll, gw, gt

    def train(self, x, y, first, steps: int = 80, rate: float = 0.3, l2: float = 1.0) -> None:
        """Gradient ascent with moment estimates."""
        theta, m, v = np.r_[self.w, self.t.ravel()], 0.0, 0.0
        for i in range(1, steps + 1):
            self.w, self.t = theta[:-4], theta[-4:].reshape(2, 2)
            _, gw, gt = self.gradient(x, y, first)
            g = (np.r_[gw, gt.ravel()] - l2 * theta) / max(1, len(x))
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        self.w, self.t = theta[:-4], theta[-4:].reshape(2, 2)


def fit_field(x: np.ndarray, first: np.ndarray, good: np.ndarray, rounds: int = ROUNDS) -> Field:
    """A field from lines of documents that are good or bad as a whole."""
    field = Field(np.zeros(N_FEATURES), np.zeros((2, 2)))
    doc = np.repeat(np.arange(len(good)), np.diff(first))
    y = good[doc].astype(float)
    field.train(x, y, first)
    for _ in range(rounds):
        label = field.decode(x, first).astype(float)
        score = x @ field.w
        worst = np.full(len(good), np.inf)
        np.minimum.at(worst, doc, score)
        y = np.where(good[doc], 1.0, np.where(score <= worst[doc], 0.0, label))
        field.train(x, y, first)
    return field


def _features(batches):
    for batch in batches:
        data, off = texts(batch.column("text"))
        for a, b in slices(off):
            f = Lines(data[off[a] : off[b]], off[a : b + 1] - off[a])
            n = np.diff(f.first)
            go = np.flatnonzero((n > 0) & (n <= MOST_LINES))
            yield pa.RecordBatch.from_pydict(
                {
                    "quality": batch.column("quality").slice(a, b - a).take(pa.array(go)),
                    "x": pa.array([pack(f.x[f.first[i] : f.first[i + 1]].ravel()) for i in go], pa.binary())
                }
            )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Field:
    """A field from documents (doc_id, text) and labels (doc_id, quality)."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    n = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(n) != {0, 1}:
        return Field()
    share = F.when(F.col("quality") == 0, per_class / n[0]).otherwise(per_class / n[1])
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("quality", "text")
    rows = sorted((r["quality"], bytes(r["x"])) for r in found.mapInArrow(_features, "quality int, x binary").collect())
    if {q for q, _ in rows} != {0, 1}:
        return Field()
    x = [unpack(b, np.float32).reshape(-1, N_FEATURES) for _, b in rows]
    return fit_field(np.concatenate(x).astype(np.float64), np.cumsum([0, *map(len, x)]), np.array([q == 1 for q, _ in rows]))


FIGURES = [
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
    ("base_failed", "boolean"), ("kept", "boolean"), ("content_share", "double")
]


def _judge(field: Field, columns: list[str]):
    def run(batches):
        for batch in batches:
            data, off = texts(batch.column("text"))
            for a, b in slices(off):
                f = Lines(data[off[a] : off[b]], off[a : b + 1] - off[a])
                label = field.decode(f.x, f.first)
                content = np.bincount(f.doc, label * f.n_line_words, b - a) / np.maximum(f.n_words, 1)
                failed = (f.n_words < NEED_WORDS) | (100 * f.n_repeat_words > REPEAT_SHARE * f.n_words)
                values = {
                    "n_words": f.n_words, "word_chars": f.word_chars, "n_symbols": f.n_symbols, "n_dup_lines": f.n_dup_lines,
                    "n_repeat_words": f.n_repeat_words, "base_failed": failed, "kept": ~failed & (content >= CONTENT),
                    "content_share": content
                }
                yield pa.RecordBatch.from_pydict(
                    {c: batch.column(c).slice(a, b - a) for c in columns} | {k: pa.array(v) for k, v in values.items()}
                )

    return run


def judged(docs: DataFrame, field: Field) -> DataFrame:
    """Per row of (doc_id, text): doc_id and FIGURES."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _judge(field, ["doc_id"]), f"doc_id {kind}, " + ", ".join(f"{k} {v}" for k, v in FIGURES)
    )


def keep(docs: DataFrame, field: Field) -> DataFrame:
    """The rows that stay, with their columns."""
    names = [f"c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    plain = docs.toDF(*names)
    schema = T.StructType([*plain.schema, T.StructField("_kept", T.BooleanType())])

    def run(batches):
        for batch in _judge(field, names)(batches):
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in names} | {"_kept": batch.column("kept")})

    return plain.mapInArrow(run, schema).where("_kept").drop("_kept").toDF(*docs.columns)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judged(docs, fit(docs, labels))
