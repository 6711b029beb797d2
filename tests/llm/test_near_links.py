import collections
import random

import numpy as np

from textmill.llm import near_dedup
from textmill.llm._stage import Stage
from textmill.llm._text import pack


def crowd(n_pairs=20, seed=0):
    """Texts of one band, most of each a template of all; only the two of a pair are 0.8 alike. Shingles and weights of each."""
    rng = random.Random(seed)
    new = lambda k: [rng.randrange(1 << 63) for _ in range(k)]
    template, out = new(140), []
    for _ in range(n_pairs):
        own = new(40)
        out += [{h: float(np.float32(1 + h % 100 / 200)) for h in template + own + new(20)} for _ in range(2)]
    return out


def crowd_frame(spark, vectors):
    rows = []
    for i, v in enumerate(vectors):
        h = np.array(sorted(v), np.uint64)
        rows.append(
            (
                i, sum(v.values()), [7] + [1000 * k + max(i, 1) for k in range(15)], bytearray(pack(h)),
                bytearray(pack(np.array([v[int(x)] for x in h], np.float32)))
            )
        )
    return spark.createDataFrame(rows, "text_id long, total double, bands array<long>, shingles binary, weights binary")


def brute_links(vectors, threshold):
    out = set()
    for i, v in enumerate(vectors):
        for j in range(i):
            low = sum(min(x, vectors[j].get(h, 0)) for h, x in v.items())
            if low >= threshold * (sum(v.values()) + sum(vectors[j].values()) - low):
                out.add((j, i))
    return out


def test_pairs_of_crowded_bands(spark):
    vectors = crowd()
    want = brute_links(vectors, 0.8)
    assert want == {(i, i + 1) for i in range(0, 40, 2)}
    texts = crowd_frame(spark, vectors)
    for block in (7, 1024):
        got = near_dedup.links_of(texts, Stage(spark, "t"), 0.8, block=block)[0].collect()
        assert sorted(tuple(sorted((r.a, r.b))) for r in got) == sorted(want)


def test_every_link_of_a_group_is_counted(spark):
    """A group of near copies in a crowded band, and a pair that meets in it and in a small one."""
    rng = random.Random(1)
    base, vectors = [rng.randrange(1 << 63) for _ in range(200)], crowd(3)
    for i in range(60):
        vectors.append({h: 1.5 for h in base[: 170 + i % 31] + [rng.randrange(1 << 63) for _ in range(i % 9)]})
    want = collections.Counter(i for link in brute_links(vectors, 0.8) for i in link)
    assert max(want.values()) > 50
    for block in (7, 1024):
        links, n_links = near_dedup.links_of(crowd_frame(spark, vectors), Stage(spark, "t"), 0.8, block=block)
        assert {r.text_id: r.n_links for r in n_links.collect()} == want
        assert len({r.a for r in links.collect()} | {r.b for r in links.collect()}) == len(want)


def test_common_weights_and_forest():
    rng = np.random.default_rng(0)
    for n, m, most in ((3, 4, 10), (40, 30, 60), (1, 1, 1)):
        side = lambda k: [
            (np.sort(rng.choice(80, rng.integers(0, most + 1), False)).astype(np.uint64), None) for _ in range(k)
        ]  # noqa: B023, E731
        left, right = ([(h, rng.integers(1, 4, len(h)) * (1.0 + h.astype(float) / 80)) for h, _ in side(k)] for k in (n, m))
        got = near_dedup.common(left, right)
        for i, (h, w) in enumerate(left):
            for j, (g, v) in enumerate(right):
                there = dict(zip(g.tolist(), v.tolist()))
                assert abs(got[i, j] - sum(min(y, there.get(x, 0)) for x, y in zip(h.tolist(), w.tolist()))) < 1e-9
    a, b = rng.integers(0, 50, 60), rng.integers(0, 50, 60)
    parts = lambda a, b: collections.Counter(_roots(a, b))
    go = near_dedup.forest(a, b, 50)
    assert parts(a, b) == parts(a[go], b[go]) and len(go) == 50 - len(parts(a, b))


def _roots(a, b):
    root = list(range(50))
    for _ in range(50):
        for x, y in zip(a.tolist(), b.tolist()):
            root[x] = root[y] = min(root[x], root[y])
    return root
