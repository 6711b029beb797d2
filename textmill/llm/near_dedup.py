"""Near-dedup of documents by improved consistent weighted sampling over TF-IDF shingles.

A shingle is SHINGLE consecutive words; a text with fewer words, but one at least, is one shingle.
Its weight in a document is its count there times its inverse document frequency over all
documents, 1 + ln((1 + n) / (1 + df)). With a `spread` that logarithm is scaled to lie between 0 and the
spread. In a large group of near copies the common shingles are frequent for that very reason, and under the plain
logarithm the few that differ can outweigh them and break up the group; the production parameter is therefore
NARROW, and the README has figures for both. Two texts are linked if the weighted Jaccard similarity of their
shingles, sum of minima over sum of maxima, is `threshold` or more.

1. Chunks of documents exchange their distinct shingles' document frequencies (see _chunks).
2. A shingle that no other document has is in no intersection. A document whose other shingles carry
   less than `threshold` of its weight therefore has no link, and goes no further. This is exact.
3. Of the rest, each gets BANDS * ROWS consistent weighted samples (Ioffe 2010): a pair of similarity s
   agrees in a sample with probability s, and in one band at least with 1 - (1 - s ** ROWS) ** BANDS, 0.99999 at 0.8.
4. Equal texts are one text from here on. Texts that share a band are candidates, all pairs of them: in a band of SMALL
   texts or fewer by a join. The texts of larger (crowded) bands lie in blocks of about BLOCK texts, each in one block of the largest
   crowded band it is in; two blocks that meet in a crowded band are compared text against text, for all pairs that share such
   a band and no small one, so a pair is seen once. The work on a crowded band grows with the square of its distinct texts; rows do not:
   of the links of two blocks only a spanning forest is returned, and how many links each text has. n_links counts them all.
5. Every candidate is verified with the exact weights.
6. Connected components of the links are the classes.

Words are unchanged; a text without words (null, empty, blank) is a class of its own. A row without doc_id
is a document for frequencies but has no class, and stays. Rows that share
a doc_id count as one document each for frequencies and are one node in classes. Extra columns are
ignored by `classes` and kept by `dedup`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import _chunks as C
from textmill.llm._stage import Stage
from textmill.llm._text import Words, inside, member, mix, pack, ranges, slices, texts, unpack, unpack_sorted, whole, windows
from textmill.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS, SMALL, VERIFY = 16, 3, 8, 256
#: Range of the inverse document frequencies above 1; None: that of the plain logarithm. NARROW is what op2 and the pipeline take.
SPREAD: float | None = None
NARROW = 0.5
#: Texts of a block, about.
BLOCK = 1024


def shingles(w: Words, wh: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the text of each."""
    at = inside(w.first, size)
    h, doc = (
        windows(wh, size, 2)[at] if len(at) else np.zeros(0, np.uint64)
    ), np.repeat(np.arange(w.n_docs), np.maximum(np.diff(w.first) - size + 1, 0))
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        h, doc = np.r_[h, whole(wh, w.first, 9)[short]], np.r_[doc, short]
    return h, doc


def counted(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, text) with counts, texts in order."""
    _, first, n = np.unique(h + doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95), return_index=True, return_counts=True)
    order = np.argsort(doc[first], kind="stable")
    first = first[order]
    return h[first], doc[first], n[order]


def _send(n_buckets: int, size: int):
    def run(batches):
        for chunk, batch in C.by_chunk(batches):
            data, off = texts(batch.column("text"))
            found = []
            for a, b in slices(off):
                w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                found.append(counted(*shingles(w, w.hashes(), size))[0])
            h = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
            if len(h):
                begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                yield C.send(chunk, h[begin], n_buckets, np.diff(np.r_[begin, len(h)]).astype(np.uint32))

    return run


def _frequencies(group: pa.Table) -> pa.Table:
    """For each chunk those of its shingles that occur in more than one document, with their document frequencies."""
    chunk = group.column("chunk").to_pylist()
    keys = [unpack_sorted(x) for x in group.column("a").to_pylist()]
    n = np.concatenate([unpack(x, np.uint32) for x in group.column("b").to_pylist()]).astype(np.int64)
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    s = flat[order]
    new = np.r_[True, s[1:] != s[:-1]]
    df = np.empty(len(s), np.int64)
    df[order] = np.add.reduceat(n[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    out, at = [], np.cumsum([0, *map(len, keys)])
    from textmill.llm._text import pack_sorted

    for i, c in enumerate(chunk):
        d = df[at[i] : at[i + 1]]
        if (d > 1).any():
            out.append((c, pack_sorted(keys[i][d > 1]), pack(d[d > 1])))
    return C.reply(out)


def samples(h: np.ndarray, weight: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Sample k of each text: a hash of the shingle and the step that consistent weighted sampling picks."""
    unit = lambda x: (x + np.float32(0.5)) * np.float32(2**-32)
    low = np.uint64(0xFFFFFFFF)

    def uniform(i):
        x = mix(h, 3 * k + i + 100)
        return unit((x >> np.uint64(32)).astype(np.float32)), unit((x & low).astype(np.float32))

    u1, u2 = uniform(0)
    u3, u4 = uniform(1)
    beta, _ = uniform(2)
    r = np.maximum(-np.log(np.minimum(u1, np.float32(0.9999999)) * u2), np.float32(1e-6))
    c = np.maximum(-np.log(np.minimum(u3, np.float32(0.9999999)) * u4), np.float32(1e-9))
    t = np.floor(np.log(weight) / r + beta)
    a = np.log(c) - r * (t - beta) - r
    least = np.minimum.reduceat(a, first[:-1])
    hit = np.flatnonzero(a == np.repeat(least, np.diff(first)))
    doc = np.searchsorted(first, hit, "right") - 1
    # of equal values that of the least shingle hash, so that it does not depend on the order
    order = np.lexsort((h[hit], doc))
    hit, doc = hit[order], doc[order]
    hit = hit[np.r_[True, doc[1:] != doc[:-1]]]
    return mix(h[hit] + t[hit].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), k)


SIGNED = "doc_id long, same binary, total double, bands array<long>, shingles binary, weights binary"


def idf(df: np.ndarray, n_docs: int, spread: float | None) -> np.ndarray:
    """Inverse document frequencies: 1 + ln((1 + n) / (1 + df)), or with a spread that logarithm scaled to lie between 0 and the spread."""
    log = np.log((1 + n_docs) / (1 + df))
    return 1 + (log if spread is None else spread * log / np.log(1 + n_docs))


def _sign(n_docs: int, size: int, threshold: float, bands: int, rows: int, spread: float | None):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys = [unpack_sorted(x) for x in answers.column("a").to_pylist()]
        dfs = [unpack(x, np.int64) for x in answers.column("b").to_pylist()]
        keys, dfs = (np.concatenate(keys), np.concatenate(dfs)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.argsort(keys)
        keys, dfs = np.r_[keys[order], np.uint64(0)], np.r_[dfs[order], 1]
        data, off = texts(docs.column("text"))
        ids = docs.column("doc_id")
        out = [[] for _ in range(6)]
        for a, b in slices(off):
            w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
            wh = w.hashes()
            h, doc, tf = counted(*shingles(w, wh, size))
            if not len(h):
                continue
            i = np.searchsorted(keys[:-1], h)
            df = np.where(keys[i] == h, dfs[i], 1)
            df[i == len(keys) - 1] = 1
            weight = tf * idf(df, n_docs, spread)
            total, shared = np.bincount(doc, weight, w.n_docs), np.bincount(doc, weight * (df > 1), w.n_docs)
            go = np.flatnonzero((total > 0) & (shared >= threshold * total * (1 - 1e-9)))
            keep = np.zeros(w.n_docs, bool)
            keep[go] = True
            keep = keep[doc]
            if not len(go):
                continue
            h, doc, weight, df = h[keep], doc[keep], weight[keep], df[keep]
            order = np.lexsort((h, doc))
            h, doc, weight, df = h[order], doc[order], weight[order], df[order]
            first = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)]
            w32 = weight.astype(np.float32)
            s = [samples(h, w32, first, k) for k in range(bands * rows)]
            key = np.stack([windows_key(s[i * rows : i * rows + rows], i) for i in range(bands)], 1)
            same = np.stack([whole(wh, w.first, 21)[go], whole(mix(wh, 5), w.first, 22)[go]], 1)
            out[0] += ids.slice(a, b - a).take(pa.array(go)).to_pylist()
            out[1] += [x.tobytes() for x in same]
            out[2] += total[go].tolist()
            out[3] += key.astype(np.int64).tolist()
            for x, y in zip(first[:-1], first[1:]):
                m = df[x:y] > 1
                out[4].append(pack(h[x:y][m]))
                out[5].append(pack(w32[x:y][m]))
        return pa.table(
            {
                "doc_id": pa.array(out[0], pa.int64()), "same": pa.array(out[1], pa.binary()), "total": pa.array(out[2], pa.float64()),
                "bands": pa.array(out[3], pa.list_(pa.int64())), "shingles": pa.array(out[4], pa.binary()),
                "weights": pa.array(out[5], pa.binary())
            }
        )

    return run


def windows_key(s: list[np.ndarray], band: int) -> np.ndarray:
    key = np.full(len(s[0]), band, np.uint64)
    for x in s:
        key = mix(key ^ x, band)
    return key


def grouped(signed: DataFrame) -> DataFrame:
    """(band, key, text_id, n) of the bands that n > 1 texts share."""
    bands = signed.select("text_id", F.posexplode("bands").alias("band", "key"))
    return bands.join(bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), ["band", "key"])


def candidates(groups: DataFrame, small: int = SMALL) -> DataFrame:
    """Distinct pairs (a, b) of text_ids that share a band of `small` texts or fewer."""
    few = groups.where(F.col("n") <= small)
    left = few.select("band", "key", F.col("text_id").alias("a"))
    right = few.select("band", "key", F.col("text_id").alias("b"))
    return left.join(right, ["band", "key"]).where("a < b").select("a", "b").distinct()


def blocks(groups: DataFrame, stage: Stage, small: int = SMALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Texts of crowded bands (text_id, block, crowded: a bit per band), and pairs (p, q) of blocks, p <= q, that share a crowded band."""
    many = groups.where(F.col("n") > small)
    home = F.max(F.struct("n", F.xxhash64("band", "key").alias("home")))["home"].alias("home")
    homes = stage.save(many.groupBy("text_id").agg(home, F.sum(F.expr("shiftleft(1L, band)")).alias("crowded")), "homes")
    parts = homes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    placed = homes.join(parts, "home").select(
        "text_id", F.xxhash64("home", F.pmod(F.xxhash64("text_id"), F.col("parts"))).alias("block"), "crowded"
    )
    placed = stage.save(placed, "placed")
    there = stage.save(many.join(placed, "text_id").select("band", "key", "block").distinct(), "there")
    p, q = there.withColumnRenamed("block", "p"), there.withColumnRenamed("block", "q")
    return placed, p.join(q, ["band", "key"]).where("p <= q").select("p", "q").distinct()


def common(left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sums of minima of all pairs of two lists of (shingles, weights)."""

    def flat(side):
        return np.repeat(
            np.arange(len(side)), [len(h) for h, _ in side]
        ), np.concatenate([h for h, _ in side]), np.concatenate([w for _, w in side])

    (i, h, w), (j, g, v) = flat(left), flat(right)
    both = np.intersect1d(h, g)
    m, n = member(both, h), member(both, g)
    i, h, w, j, g, v = i[m], np.searchsorted(both, h[m]), w[m], j[n], np.searchsorted(both, g[n]), v[n]
    # a shingle's weights as steps: what two texts have in common is the sum of the steps that both reach
    steps = np.unique(np.stack([np.r_[h, g].astype(np.float64), np.r_[w, v]], 1), axis=0)
    of, height = steps[:, 0].astype(np.int64), steps[:, 1]
    rise = height - np.where(np.r_[True, of[1:] != of[:-1]], 0, np.r_[0, height[:-1]])
    begin = np.searchsorted(of, np.arange(len(both)))
    key = of + 0.5 * height / (height.max() if len(height) else 1)

    def reached(x, h, w):
        up = np.searchsorted(key, h + 0.5 * w / (height.max() if len(height) else 1)) - begin[h] + 1
        return np.repeat(x, up), ranges(begin[h], up)

    (i, h), (j, g) = reached(i, h, w), reached(j, g, v)
    out = np.zeros((len(left), len(right)))
    n_h, n_g = np.bincount(h, minlength=len(of)), np.bincount(g, minlength=len(of))
    # steps that few pairs reach: pair by pair; the others: as a product of matrices
    rare = n_h * n_g * 64 <= out.size
    order = np.argsort(g, kind="stable")
    start = np.cumsum(n_g) - n_g
    m = np.flatnonzero(rare[h])
    for m in np.array_split(m, 1 + int(n_g[h[m]].sum()) // 4_000_000):
        k = n_g[h[m]]
        at = np.repeat(i[m], k) * len(right) + j[order[ranges(start[h[m]], k)]]
        out += np.bincount(at, np.repeat(rise[h[m]], k), out.size).reshape(out.shape)
    often = np.flatnonzero(~rare)
    place = np.full(len(of), -1)
    for a in range(0, len(often), 2048):
        now = often[a : a + 2048]
        place[:] = -1
        place[now] = np.arange(len(now))
        x, y = np.zeros((len(left), len(now))), np.zeros((len(right), len(now)))
        m, n = place[h] >= 0, place[g] >= 0
        x[i[m], place[h[m]]] = rise[h[m]]
        y[j[n], place[g[n]]] = 1
        out += x @ y.T
    return out


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Numbers of links (a, b) between nodes under n that connect what all of them connect, without cycles."""
    root, taken = np.arange(n), []
    live = np.arange(len(a))
    while len(live):
        x, y = root[a[live]], root[b[live]]
        live, x, y = live[x != y], x[x != y], y[x != y]
        # each part takes one link to a part with a lesser number, if it has one
        hi, lo = np.maximum(x, y), np.minimum(x, y)
        part, first = np.unique(hi, return_index=True)
        taken.append(live[first])
        root[part] = lo[first]
        while (root[root] != root).any():
            root = root[root]
    return np.concatenate(taken) if taken else live


def _compare(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        right = group.column("right").to_numpy()
        own = not right.any()
        sides = []
        for t in (group.filter(pa.array(~right)), group.filter(pa.array(right if not own else ~right))):
            v = [
                (unpack(h, np.uint64), unpack(w, np.float32).astype(np.float64))
                for h, w in zip(t.column("shingles").to_pylist(), t.column("weights").to_pylist())
            ]
            sides.append(
                (
                    t.column("text_id").to_numpy(), t.column("total").to_numpy(), np.array(t.column("bands").to_pylist()),
                    t.column("crowded").to_numpy(), v
                )
            )
        (a, total_a, bands_a, crowded, va), (b, total_b, bands_b, _, vb) = sides
        found, ids, n = ([], [], []), [], []
        if len(a) and len(b):
            hot, few = np.zeros((len(a), len(b)), bool), np.zeros((len(a), len(b)), bool)
            for k in range(bands_a.shape[1]):
                same, many = bands_a[:, k, None] == bands_b[None, :, k], (crowded >> k & 1).astype(bool)[:, None]
                hot |= same & many
                few |= same & ~many
            hot &= ~few
            if own:
                hot &= a[:, None] < b[None, :]
            if hot.any():
                low = common(va, vb)
                s = low / (total_a[:, None] + total_b[None, :] - low)
                x, y = np.nonzero(hot & (s >= threshold - 1e-6))
                go = forest(x, y if own else y + len(a), len(a) if own else len(a) + len(b))
                found = a[x[go]], b[y[go]], s[x[go], y[go]]
                ids, n = np.r_[a, b], np.r_[np.bincount(x, minlength=len(a)), np.bincount(y, minlength=len(b))]
                ids, n = ids[n > 0], n[n > 0]
        column = lambda links, counts, kind: pa.concat_arrays([pa.array(links, kind), pa.array(counts, kind)])
        none = [None] * len(ids)
        return pa.table(
            {
                "a": column(found[0], ids, pa.int64()), "b": column(found[1], none, pa.int64()),
                "similarity": column(found[2], none, pa.float64()), "n": column([None] * len(found[0]), n, pa.int64())
            }
        )

    return run


def compared(placed: DataFrame, meet: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """Rows (a, b, similarity, n): links that connect all linked texts of the blocks that meet; and, without b, the numbers n of links of texts a."""
    texts_ = placed.join(signed, "text_id").select("block", "text_id", "total", "bands", "crowded", "shingles", "weights")
    left = meet.join(texts_, F.col("p") == F.col("block")).withColumn("right", F.lit(False))
    right = meet.where("p < q").join(texts_, F.col("q") == F.col("block")).withColumn("right", F.lit(True))
    return left.unionByName(right).drop("block").groupBy("p", "q").applyInArrow(
        _compare(threshold), "a long, b long, similarity double, n long"
    )


def _verify(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        t = group.to_pydict()
        i = t["a"].index(None)
        h, w = unpack(t["shingles"][i], np.uint64), unpack(t["weights"][i], np.float32).astype(np.float64)
        total, b = t["total"][i], t["b"][i]
        found = []
        for k, a in enumerate(t["a"]):
            if a is None:
                continue
            h2, w2 = unpack(t["shingles"][k], np.uint64), unpack(t["weights"][k], np.float32).astype(np.float64)
            at = np.searchsorted(h, h2)
            at[at == len(h)] = 0
            m = h[at] == h2 if len(h) else np.zeros(len(h2), bool)
            low = np.minimum(w[at[m]], w2[m]).sum()
            s = low / (total + t["total"][k] - low)
            if s >= threshold - 1e-6:
                found.append((a, b, s))
        a, b, s = zip(*found) if found else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(s, pa.float64())})

    return run


def verified(pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, similarity) that reach the threshold. A text b meets its partners in groups of about VERIFY."""
    vectors = signed.select("text_id", "total", "shingles", "weights")
    groups = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / VERIFY).cast("int"))
    left = pairs.join(groups, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
    members = left.join(vectors, left["a"] == vectors["text_id"]).select("b", "part", "a", "total", "shingles", "weights")
    centres = left.select("b", "part").distinct().join(vectors, F.col("b") == F.col("text_id")).select(
        "b", "part", F.lit(None).cast("long").alias("a"), "total", "shingles", "weights"
    )
    return members.unionByName(centres).groupBy("b", "part").applyInArrow(_verify(threshold), "a long, b long, similarity double")


def links_of(texts_: DataFrame, stage: Stage, threshold: float, small: int = SMALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Of texts (text_id, total, bands, shingles, weights): links (a, b, similarity), those of crowded bands only as far as they
    connect what is not connected by others of the same two blocks; and for each text with links the number n of all (text_id, n)."""
    groups = stage.save(grouped(texts_), "groups")
    pairs = stage.save(candidates(groups, small), "pairs")
    few = stage.save(verified(pairs, texts_, threshold), "few")
    placed, meet = blocks(groups, stage, small, block)
    many = stage.save(compared(placed, stage.save(meet, "meet"), texts_, threshold), "many")
    ends = [few.select(F.col(c).alias("text_id"), F.lit(1).cast("long").alias("n")) for c in ("a", "b")]
    counted = many.where("b IS NULL").select(F.col("a").alias("text_id"), "n")
    n_links = ends[0].unionByName(ends[1]).unionByName(counted).groupBy("text_id").agg(F.sum("n").alias("n_links"))
    return few.unionByName(many.where("b IS NOT NULL").drop("n")), n_links


def linked(
    docs: DataFrame, stage: Stage, threshold: float = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
    chunk_bytes: int = C.CHUNK, spread: float | None = SPREAD
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (doc_id, text_id) of texts that have a partner or a copy or might; links between texts, and their numbers, as links_of() gives them."""
    n_docs, n_bytes = C.measure(docs)
    table, n = C.chunked(stage, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), n_bytes, chunk_bytes)
    sent = table.select("chunk", "text").mapInArrow(_send(C.buckets(n, docs.sparkSession), size), C.SENT)
    answers = stage.save(C.exchange(sent, _frequencies), "frequencies")
    stage.release()
    signed = stage.save(
        C.with_answers(table, answers, _sign(n_docs, size, threshold, bands, rows, spread), SIGNED).where("doc_id IS NOT NULL"), "signed"
    )
    stage.drop("chunks", "frequencies")
    reps = signed.groupBy("same").agg(F.min("doc_id").alias("text_id"))
    members = stage.save(signed.select("doc_id", "same").distinct().join(reps, "same").select("doc_id", "text_id"), "members")
    texts_ = stage.save(
        signed.join(
            reps.select(F.col("text_id").alias("doc_id"), F.col("same").alias("its")), "doc_id"
        ).where(F.col("same") == F.col("its")).withColumnRenamed("doc_id", "text_id").drop("its", "same").dropDuplicates(["text_id"]),
        "texts"
    )
    links, n_links = links_of(texts_, stage, threshold)
    stage.drop("signed", "texts", "groups", "pairs", "homes", "placed", "there", "meet")
    return members, links, n_links


def classes(docs: DataFrame, threshold: float = THRESHOLD, chunk_bytes: int = C.CHUNK, spread: float | None = SPREAD) -> DataFrame:
    """Per row of (doc_id, text): doc_id, text_id (least doc_id of the same text), class_id (least text_id that
    is linked to it, in any number of steps), n_links (how many other texts its text is linked to, those of crowded bands counted in full)."""
    stage = Stage(docs.sparkSession, "near")
    members, links, n_links = linked(docs, stage, threshold, chunk_bytes=chunk_bytes, spread=spread)
    parts = components(links, stage)
    known = members.join(parts, F.col("text_id") == F.col("node"), "left").drop("node").join(n_links, "text_id", "left")
    known = known.groupBy("doc_id").agg(
        F.min("text_id").alias("text_id"), F.min(F.coalesce("class_id", "text_id")).alias("class_id"),
        F.max(F.coalesce("n_links", F.lit(0))).alias("n_links")
    )
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(known, "doc_id", "left")
    return out.select(
        "doc_id", F.coalesce("text_id", "doc_id").alias("text_id"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def dedup(docs: DataFrame, threshold: float = THRESHOLD, chunk_bytes: int = C.CHUNK, spread: float | None = SPREAD) -> DataFrame:
    """The documents, of each class only that with the least doc_id, with all their columns."""
    stage = Stage(docs.sparkSession, "near")
    members, links, _ = linked(docs, stage, threshold, chunk_bytes=chunk_bytes, spread=spread)
    parts = components(links, stage)
    gone = members.join(parts, F.col("text_id") == F.col("node"), "left").where(
        F.col("doc_id") > F.coalesce("class_id", "text_id")
    ).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def op2_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), spread=NARROW)
