"""Language-model scores by Brown class-based n-grams.

P(word | previous) = P(class | previous class) * P(word | class). Classes come from exchange clustering: the
most frequent words begin in classes of their own and all others in one; then, PASSES times, each word is
exchanged into the class that most raises the likelihood of the class bigrams, that is, the sum over its neighbours'
classes of the log ratio of a class pair's count to what its classes' counts alone lead to expect. All words move on the same
frozen class bigram counts, so a pass is one exchange between units of text and buckets of words; no
vocabulary, and no table of word bigrams, is held in one place. Such moves can lower the likelihood; a pass counts only if it
raises that of the class bigrams, else the classes before it stay and clustering ends. Every word of the training texts
takes part, whatever its count.

Smoothing: transitions lean on class counts; emissions are discounted by a constant from the counts of counts, and
the discount of a class is its share of the unknown word; all is interpolated with the add-half unigrams of the base score.
After an unknown word, class counts take the place of transitions. The events are the words of the training texts and one
unknown word, the same as those of the base.

A unit is about UNIT bytes of text from one scan task, written once as numbers of its own vocabulary. Tasks take units
apart one at a time, whatever a batch holds, and a unit's texts by slices, with only the columns that they use.

Nulls and so on: a null or empty text is its end token alone; rows stand each for themselves, also with equal or null
doc_ids (without one a row is never held out); extra columns are ignored; an empty table gives an empty
result, and without training texts every score is 0 or that of the unknown word.
"""

from __future__ import annotations

import logging
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import _chunks as C
from textmill.llm._stage import Stage
from textmill.llm._text import Words, mix, pack, pack_sorted, slices, spans, texts, unpack, unpack_sorted

log = logging.getLogger(__name__)
UNIT, CLASSES, PASSES, LAMBDA, PRIOR = 12 << 20, 64, 2, 0.95, 20.0
STEP = 1 << 17  # tokens scored at a time, in whole texts
END = np.uint64(1)  # in place of the end token's hash
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def frames(*parts: bytes) -> bytes:
    return struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts)


def unframes(raw: bytes, n: int) -> list[bytes]:
    at, out = 8 * n, []
    for size in struct.unpack(f"<{n}q", raw[: 8 * n]):
        out.append(raw[at : at + size])
        at += size
    return out


UNITS = "unit long, vocab binary, train binary, tokens binary, doc_id array<long>, held array<boolean>, n_tokens array<int>"


def _units(unit_bytes: int):
    def run(batches):
        k = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, off = texts(batch.column("text"))
            ids, held = batch.column("doc_id"), batch.column("held")
            for a, b in slices(off, unit_bytes):
                vocabs, parts, n_tokens = [], [], []
                for x, y in slices(off[a : b + 1]):
                    part = off[a + x : a + y + 1] - off[a + x]
                    low = _LOWER[data[off[a + x] : off[a + y]]]
                    w = Words(low, part)
                    keys, inverse = np.unique(np.insert(mix(spans(low, w.start, w.end), 1), w.first[1:], END), return_inverse=True)
                    vocabs.append(keys)
                    parts.append(inverse.astype(np.int32))
                    n_tokens.append(np.diff(w.first) + 1)
                vocab, n_tokens = np.unique(np.concatenate(vocabs)), np.concatenate(n_tokens)
                index = np.concatenate([np.searchsorted(vocab, v).astype(np.int32)[i] for v, i in zip(vocabs, parts)])
                h = np.array(held.slice(a, b - a).to_pylist(), bool)
                train = np.bincount(index[~np.repeat(h, n_tokens)], minlength=len(vocab))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k]), pa.array([pack_sorted(vocab)], pa.binary()), pa.array([pack(train.astype(np.uint32))], pa.binary()),
                        pa.array([pack(index)], pa.binary()),
                        pa.array([ids.slice(a, b - a).to_pylist()], pa.list_(pa.int64())), pa.array([h.tolist()], pa.list_(pa.bool_())),
                        pa.array([n_tokens.tolist()], pa.list_(pa.int32()))
                    ],
                    ["unit", "vocab", "train", "tokens", "doc_id", "held", "n_tokens"],
                )
                k += 1

    return run


SENT = "bucket int, unit long, a binary, b binary"


def _each(batches):
    """Rows one by one: a batch may hold all units of a scan task, and only one of them is copied."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _send_counts(n_buckets: int):
    def run(batches):
        for row in _each(batches):
            vocab, train = unpack_sorted(row["vocab"]), unpack(row["train"], np.uint32)
            at = C.cuts(vocab, n_buckets)
            rows = np.flatnonzero(np.diff(at)).tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(rows, pa.int32()), "unit": pa.array([row["unit"]] * len(rows), pa.int64()),
                    "a": pa.array([pack_sorted(vocab[at[i] : at[i + 1]]) for i in rows], pa.binary()),
                    "b": pa.array([pack(train[at[i] : at[i + 1]]) for i in rows], pa.binary())
                }
            )

    return run


COUNTED = "unit long, bucket int, counts binary, top array<struct<hash:long,n:long>>, n_types long, n1 long, n2 long, n_tokens long"
_TOP = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64())]))


def _count(n_top: int):
    def run(group: pa.Table) -> pa.Table:
        """For each unit the training counts of its words; with the first unit, figures of the bucket."""
        keys = [unpack_sorted(x) for x in group.column("a").to_pylist()]
        words, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(
            inverse, np.concatenate([unpack(x, np.uint32) for x in group.column("b").to_pylist()]), len(words)
        ).astype(np.uint32)
        at = np.cumsum([0, *map(len, keys)])
        order = np.lexsort((words, -n.astype(np.int64)))[:n_top]
        top = [{"hash": int(words[i].astype(np.int64)), "n": int(n[i])} for i in order if n[i] and words[i] != END]
        rows = group.num_rows
        first = lambda x, none: [x] + [none] * (rows - 1)
        return pa.table({
            "unit": group.column("unit"), "bucket": group.column("bucket"), "counts": pa.array(
                [pack(n[inverse[x:y]]) for x, y in zip(at[:-1], at[1:])], pa.binary()
            ),
            "top": pa.array(first(top, []), _TOP), "n_types": pa.array(first(int((n > 0).sum()), 0), pa.int64()), "n1": pa.array(
                first(int((n == 1).sum()), 0), pa.int64()
            ), "n2": pa.array(first(int((n == 2).sum()), 0), pa.int64()), "n_tokens": pa.array(first(int(n.sum()), 0), pa.int64()),
        })

    return run


class Unit:
    """A unit's row. Classes are given per word of its vocabulary; the end token's is 0."""

    def __init__(self, row: dict):
        self.id, self.vocab = row["unit"], unpack_sorted(row["vocab"])
        self.tokens, self.n = unpack(row["tokens"], np.int32), np.array(row["n_tokens"], np.int64)
        self.held = np.array(row["held"], bool)
        self.end = np.cumsum(self.n)
        self.begin = self.end - self.n

    def previous(self, values: np.ndarray, start, a: int = 0, b: int | None = None) -> np.ndarray:
        """Values of the tokens of texts a to b (all) moved on by one, `start` at the begin of each text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.begin[a:b] - self.begin[a]] = start
        return out


def gathered(answers: pa.Table, column: str, dtype) -> np.ndarray:
    """What the buckets answer a unit, in the order of its vocabulary."""
    bucket, parts = answers.column("bucket").to_pylist(), answers.column(column).to_pylist()
    return np.concatenate([unpack(parts[i], dtype) for i in np.argsort(bucket)])


def seeded(vocab: np.ndarray, top: np.ndarray, n_classes: int) -> np.ndarray:
    """Class 0 for the end, 1 to n - 2 for the most frequent words, the last for all others."""
    order = np.argsort(top)
    i = np.searchsorted(top[order], vocab)
    i[i == len(top)] = 0
    out = np.full(len(vocab), n_classes - 1, np.uint8)
    if len(top):
        hit = top[order][i] == vocab
        out[hit] = (order[i[hit]] + 1).astype(np.uint8)
    out[vocab == END] = 0
    return out


def _matrix(u: Unit, classes: np.ndarray, n_classes: int) -> np.ndarray:
    c = classes[u.tokens].astype(np.int32)
    go = ~np.repeat(u.held, u.n)
    return np.bincount((u.previous(c, 0) * n_classes + c)[go], minlength=n_classes**2)


def _profiles(u: Unit, classes: np.ndarray, n_buckets: int, n_classes: int) -> pa.Table:
    """Per bucket the unit's words with the counts of classes before and after each; bucket -1: the class bigrams."""
    kind = np.uint32 if len(u.vocab) * 2 * n_classes < 1 << 32 else np.int64
    go = ~np.repeat(u.held, u.n)
    c, own = classes[u.tokens], (u.vocab != END)[u.tokens] & go
    t = u.tokens.astype(kind) * kind(2 * n_classes)
    keys = np.concatenate([t[go] + u.previous(c, 0)[go], t[own] + np.append(c[1:], np.uint8(0))[own] + kind(n_classes)])
    del t, c, go, own
    keys.sort()
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(begin, append=len(keys)).astype(np.uint32)
    keys = keys[begin]
    del begin
    word, code = keys // (2 * n_classes), (keys % (2 * n_classes)).astype(np.uint8)
    at = C.cuts(u.vocab, n_buckets)
    to = np.searchsorted(word, at)
    per_word = np.bincount(word, minlength=len(u.vocab))
    rows = np.flatnonzero(np.diff(at)).tolist()
    a = [pack_sorted(u.vocab[at[i] : at[i + 1]]) for i in rows]
    b = [
        frames(
            pack(per_word[at[i] : at[i + 1]].astype(np.uint16)), pack(code[to[i] : to[i + 1]]),
            pack(n[to[i] : to[i + 1]]), pack(classes[at[i] : at[i + 1]])
        )
        for i in rows
    ]
    return pa.table(
        {
            "bucket": pa.array([*rows, -1], pa.int32()), "unit": pa.array([u.id] * (len(rows) + 1), pa.int64()),
            "a": pa.array([*a, None], pa.binary()), "b": pa.array([*b, pack(_matrix(u, classes, n_classes))], pa.binary())
        }
    )


def likelihood(m: np.ndarray) -> float:
    """Of class bigrams, but for what no classes change: the sum of n ln n over pairs, less that over first and over second classes."""
    part = lambda n: float((n[n > 0] * np.log(n[n > 0])).sum())
    m = m.astype(np.float64)
    return part(m) - part(m.sum(axis=0)) - part(m.sum(axis=1))


def log_ratios(m: np.ndarray) -> np.ndarray:
    """log of a class pair's count to the expected one, both a little raised."""
    m = m.astype(np.float64) + 0.1
    return np.log(m * m.sum() / (m.sum(axis=1, keepdims=True) * m.sum(axis=0, keepdims=True)))


def _exchange(matrix: np.ndarray, n_classes: int, move: bool = True):
    r = log_ratios(matrix)

    def run(group: pa.Table) -> pa.Table:
        """For each unit the new classes of its words; with the first unit, the bucket's training words by class."""
        keys = [unpack_sorted(x) for x in group.column("a").to_pylist()]
        parts = [unframes(x, 4) for x in group.column("b").to_pylist()]
        words, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        at = np.cumsum([0, *map(len, keys)])
        profile = np.zeros(len(words) * 2 * n_classes, np.float32)
        old = np.zeros(len(words), np.uint8)
        for x, p in zip(at[:-1], parts):
            size, code, n, was = unpack(p[0], np.uint16), unpack(p[1], np.uint8), unpack(p[2], np.uint32), unpack(p[3], np.uint8)
            mine = inverse[x : x + len(size)]
            old[mine] = was
            # a unit has a word and code once, so there is no clash within it
            profile[np.repeat(mine, size) * 2 * n_classes + code] += n.astype(np.float32)
        profile = profile.reshape(len(words), 2 * n_classes)
        gain = profile[:, :n_classes] @ r.astype(np.float32) + profile[:, n_classes:] @ r.T.astype(np.float32)
        gain[:, 0] = -np.inf  # the end's own class
        best = gain.argmax(axis=1).astype(np.uint8)
        stay = (gain[np.arange(len(words)), old] >= gain.max(axis=1)) & (old > 0)
        best[stay] = old[stay]
        if not move:
            best = old
        best[words == END] = 0
        types = np.bincount(best[profile.any(axis=1)], minlength=n_classes)  # a word of the training texts has a class before it
        return pa.table(
            {
                "unit": group.column("unit"), "bucket": group.column("bucket"),
                "classes": pa.array([pack(best[inverse[x:y]]) for x, y in zip(at[:-1], at[1:])], pa.binary()),
                "types": pa.array([pack(types)] + [None] * (group.num_rows - 1), pa.binary())
            }
        )

    return run


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of packed rows of numbers: in 64 groups on executors, the rest here."""

    def add(group: pa.Table) -> pa.Table:
        return pa.table({"b": pa.array([pack(np.sum([unpack(x, np.int64) for x in group.column("b").to_pylist()], axis=0))], pa.binary())})

    rows = parts.select(F.pmod(F.xxhash64("unit"), F.lit(64)).alias("k"), "b").groupBy("k").applyInArrow(add, "b binary").collect()
    return np.sum([unpack(r["b"], np.int64) for r in rows], axis=0) if rows else np.zeros(size, np.int64)


class ClassModel:
    """Scores from the class bigrams, each class's types, and the figures of the training tokens."""

    def __init__(self, matrix: np.ndarray, types: np.ndarray, n_tokens: int, n_types: int, discount: float):
        self.n, self.v, self.d = n_tokens, n_types, discount
        size = matrix.sum(axis=0).astype(np.float64)  # tokens of a class
        prior = size / max(1.0, size.sum())
        after = (matrix + PRIOR * prior) / (matrix.sum(axis=1, keepdims=True) + PRIOR)
        self.after = np.vstack([after, prior])  # the last row: after an unknown word
        self.size = np.maximum(size, 1.0)
        unknown = discount * types / self.size
        self.unknown = self.after @ unknown

    def logs(self, count: np.ndarray, before: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the base and of the model for each token; count 0: unknown."""
        base = (count + 0.5) / (self.n + 0.5 * (self.v + 1))
        own = np.where(count > 0, self.after[before, classes] * (count - self.d) / self.size[classes], self.unknown[before])
        return np.log10(base), np.log10(LAMBDA * own + (1 - LAMBDA) * base)


def scored(docs: DataFrame, held, n_classes: int = CLASSES, passes: int = PASSES, unit_bytes: int = UNIT) -> DataFrame:
    """Per row of (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. `held`: which rows not to learn from."""
    spark = docs.sparkSession
    stage = Stage(spark, "classlm")
    unit_bytes = C.chunk_size(C.measure(docs)[1], unit_bytes)
    units = stage.save(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held")).mapInArrow(_units(unit_bytes), UNITS),
        "units", "none"
    )
    n_buckets = C.buckets(2 * units.select("unit").count(), spark)
    counted = stage.save(
        units.select("unit", "vocab", "train").mapInArrow(
            _send_counts(n_buckets), SENT
        ).groupBy("bucket").applyInArrow(_count(n_classes), COUNTED),
        "counted", "none"
    )
    n_types, n1, n2, n_tokens = (int(x or 0) for x in counted.agg(*[F.sum(c) for c in ("n_types", "n1", "n2", "n_tokens")]).first())
    top = counted.select(F.explode("top").alias("t")).select("t.*").orderBy(F.desc("n"), "hash").limit(n_classes - 2).collect()
    top = np.array([r["hash"] for r in top], np.int64).astype(np.uint64)
    seeds = lambda u: seeded(u.vocab, top, n_classes)
    bare = units.drop("train", "doc_id")

    def first_pass(batches):
        for row in _each(batches):
            u = Unit(row)
            yield from _profiles(u, seeds(u), n_buckets, n_classes).to_batches()

    def later_pass(rows: pa.Table, answers: pa.Table) -> pa.Table:
        u = Unit(rows.to_pylist()[0])
        return _profiles(u, gathered(answers, "classes", np.uint8), n_buckets, n_classes)

    answered = "unit long, bucket int, classes binary, types binary"
    rose: list[float] = []  # likelihoods of the classes before each pass
    classes = before = None
    for i in range(passes):
        made = bare.mapInArrow(first_pass, SENT) if i == 0 else bare.groupBy("unit").cogroup(classes.groupBy("unit")).applyInArrow(later_pass, SENT)
        made = stage.save(made, f"profiles{i}", "none")
        matrix = _summed(made.where("bucket = -1"), n_classes**2).reshape(n_classes, n_classes)
        rose.append(likelihood(matrix))
        if i and rose[i] <= rose[i - 1]:
            stage.drop(f"profiles{i}")
            classes, before = before, classes
            break
        before, classes = classes, stage.save(
            made.where("bucket >= 0").groupBy("bucket").applyInArrow(_exchange(matrix, n_classes), answered), f"classes{i}", "none"
        )
        stage.drop(f"profiles{i}", *[f"classes{i - 2}"] * (i > 1))

    def as_seeded() -> DataFrame:
        made = bare.mapInArrow(first_pass, SENT).where("bucket >= 0")
        return stage.save(
            made.groupBy("bucket").applyInArrow(_exchange(np.zeros((n_classes, n_classes), np.int64), n_classes, False), answered),
            "seeded", "none"
        )

    def figures(rows: pa.Table, answers: pa.Table) -> pa.Table:
        u = Unit(rows.to_pylist()[0])
        c = gathered(answers, "classes", np.uint8)
        return pa.table({"unit": pa.array([u.id]), "b": pa.array([pack(_matrix(u, c, n_classes))], pa.binary())})

    def settled(classes: DataFrame, name: str) -> tuple[DataFrame, np.ndarray]:
        both = stage.save(counted.select("unit", "bucket", "counts").join(classes.drop("types"), ["unit", "bucket"]), name, "none")
        return both, _summed(
            bare.groupBy("unit").cogroup(both.groupBy("unit")).applyInArrow(figures, "unit long, b binary"), n_classes**2
        ).reshape(n_classes, n_classes)

    if classes is None:
        classes = as_seeded()
    both, matrix = settled(classes, "model")
    if rose and likelihood(matrix) < rose[-1]:  # the last pass lowered it
        classes = before if before is not None else as_seeded()
        both, matrix = settled(classes, "model_before")
    log.info("class bigram likelihood by pass: %s, kept: %s", rose, likelihood(matrix))
    types = _summed(classes.where("types IS NOT NULL").select("unit", F.col("types").alias("b")), n_classes)
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    model = ClassModel(matrix, types, n_tokens, n_types, d)

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        u = Unit(row)
        count, c = gathered(answers, "counts", np.uint32).astype(np.int64), gathered(answers, "classes", np.uint8).astype(np.int64)
        c = np.where(count > 0, c, n_classes)
        sums = []
        for a, b in slices(np.r_[0, u.end], STEP):
            tokens, begin = u.tokens[u.begin[a] : u.end[b - 1]], u.begin[a:b] - u.begin[a]
            n, k = count[tokens], c[tokens]
            base, own = model.logs(n, u.previous(k, 0, a, b), np.minimum(k, n_classes - 1))
            sums.append([np.add.reduceat(x, begin) for x in ((n > 0).astype(np.int64), base, own)])
        known, base, own = map(np.concatenate, zip(*sums))
        return pa.table(
            {
                "doc_id": pa.array(row["doc_id"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(u.n, pa.int64()), "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array([n_tokens] * len(u.n), pa.int64()), "base_score": pa.array(base, pa.float64()),
                "score": pa.array(own, pa.float64())
            }
        )

    return units.drop("train").groupBy("unit").cogroup(both.groupBy("unit")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op6_class_lm(spark, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0)) == 1
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), held)
