import collections
import hashlib
import math
import random
import re

import corpus_pipeline
from textmill.llm import exact_dedup, near_dedup, substring_dedup
from textmill.llm._stage import Stage
from textmill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    passage = [word() for _ in range(30)]
    rows, base = [], []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5 or not base:
            w = [word() for _ in range(rng.choice([0, 1, 3, 4, 5, 19, 20, 21, 60, 200]))]
            base.append(w)
        elif kind < 0.65:
            w = list(rng.choice(base))
        elif kind < 0.85:
            w = list(rng.choice(base))
            if w:
                w[rng.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(10)] + passage + [word() for _ in range(5)]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w), "en", "s", i))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s", 0), (n + 2, " \n", "en", "s", 2), (n + 3, "a b " * 300, "en", "s", 1200)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_exact(spark):
    rows = corpus()
    got = exact_dedup.groups(frame(spark, rows), k=3).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r[1] or ""].append(r[0])
    text = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    for r in got:
        ids = by[text[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), r.doc_id == max(ids))
        assert r.text_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_exact_repeated_rows_and_clashing_columns(spark):
    d = spark.createDataFrame(
        [(1, "x", 1, "a"), (1, "x", 2, "b"), (None, "x", 3, "c"), (None, None, 4, "d")],
        "doc_id long, text string, row_key int, digest string"
    )
    assert sum(r.kept for r in exact_dedup.groups(d).collect()) == 2
    kept = exact_dedup.dedup(d)
    assert kept.columns == d.columns and kept.count() == 2 and kept.where("text = 'x'").first().doc_id == 1
    assert exact_dedup.dedup(d.limit(0)).count() == 0


def test_misra_gries_finds_the_frequent():
    import pyarrow as pa

    rng = random.Random(1)
    stream = ["hot"] * 400 + [str(rng.randrange(10000)) for _ in range(700)]
    rng.shuffle(stream)
    batches = [pa.RecordBatch.from_pydict({"digest": stream[i : i + 50]}) for i in range(0, len(stream), 50)]
    out = next(exact_dedup.misra_gries(iter(batches), 4)).to_pydict()
    least = dict(zip(out["digest"], out["least"]))
    assert len(least) <= 4 and 400 - len(stream) / 5 <= least["hot"] <= 400


def brute_removed(rows, size=20):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows):
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if key in seen:
                gone.update(range(k, k + size))
            seen.add(key)
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_substring(spark):
    rows = corpus(1)
    want = brute_removed(rows)
    for chunk in (2000, 1 << 20):
        for r in substring_dedup.repeats(frame(spark, rows), chunk_bytes=chunk).collect():
            n, gone, text = want[r.doc_id]
            assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(text.encode()).hexdigest())


def test_substring_documents(spark):
    rows = corpus(2)
    want = brute_removed(rows)
    d = frame(spark, rows).withColumnRenamed("source", "chunk").withColumnRenamed("lang", "_words")
    got = substring_dedup.dedup(d, chunk_bytes=3000)
    assert got.columns == d.columns
    found = {r.doc_id: r.text for r in got.collect()}
    assert set(found) == {i for i, (n, gone, _) in want.items() if gone < n or not gone}
    text = {r[0]: r[1] for r in rows}
    assert all(t == (want[i][2] if want[i][1] else text[i]) for i, t in found.items())
    assert substring_dedup.dedup(d.limit(0)).count() == 0


def brute_classes(rows, threshold=0.8):
    sh = {}
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        sh[i] = collections.Counter([tuple(w[k : k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else []))
    df = collections.Counter(x for s in sh.values() for x in s)
    wt = {
        i: {x: c * (1 + math.log((1 + len(rows)) / (1 + df[x])) / math.log(1 + len(rows)) / 2) for x, c in s.items()} for i, s in sh.items()
    }
    root = {i: i for i in sh}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sh)
    for i in ids:
        for j in ids:
            if i < j and wt[i] and wt[j]:
                low = sum(min(v, wt[j].get(x, 0)) for x, v in wt[i].items())
                if low / (sum(wt[i].values()) + sum(wt[j].values()) - low) >= threshold:
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: find(i) for i in ids}


def test_near(spark):
    rows = corpus(3)
    want = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(frame(spark, rows), chunk_bytes=4000).collect()}
    assert got == want
    d = frame(spark, rows).withColumnRenamed("source", "_gone")
    kept = near_dedup.dedup(d)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == set(want.values())


def test_near_without_ids_or_rows(spark):
    d = spark.createDataFrame(
        [(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string"
    )
    got = near_dedup.classes(d).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in got) == [(0, 0), (1, 1), (2, 1), (2, 1)]
    assert near_dedup.classes(d.limit(0)).count() == 0


def test_large_bands_keep_their_links(spark):
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    root = {x: x for ab in links for x in ab}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.class_id for r in components(spark.createDataFrame(links, "a long, b long"), Stage(spark, "t")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_pipeline_stages(spark):
    """Each stage by itself against brute force, on its own input."""
    rows = [(i, t, la, s, n) for i, t, la, s, n in corpus(4, 60)]
    docs = frame(spark, rows)
    columns = docs.columns
    _, lang = corpus_pipeline.STAGES[0]
    kept = lang(spark, docs, "")
    a = kept.collect()
    assert kept.columns == columns and {r.doc_id for r in a} == {r[0] for r in rows if (r[1] or "").strip()}
    d = frame(spark, a)
    b = corpus_pipeline.STAGES[1][1](spark, d, "").collect()
    best = {}
    for r in a:
        best[r.text] = max(r.doc_id, best.get(r.text, -1))
    assert {r.doc_id for r in b} == set(best.values())
    c = corpus_pipeline.STAGES[2][1](spark, frame(spark, b), "").collect()
    assert {r.doc_id for r in c} == set(brute_classes([tuple(r) for r in b]).values())
    e = corpus_pipeline.STAGES[3][1](spark, frame(spark, c), "").collect()
    want = brute_removed([tuple(r) for r in c])
    assert {r.doc_id for r in e} == {i for i, (n, gone, _) in want.items() if gone < n}
    f = corpus_pipeline.STAGES[4][1](spark, frame(spark, e), "").collect()
    assert {r.doc_id for r in f} == {r.doc_id for r in e}
