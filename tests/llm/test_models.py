import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.llm import class_lm, language_id, license_scan, quality_rules
from textmill.llm._text import texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_viterbi_is_best():
    rng = np.random.default_rng(0)
    for _ in range(60):
        first = np.r_[0, np.cumsum(rng.integers(0, 6, 4))]
        s, p = np.log(rng.dirichlet(np.ones(3), first[-1])), rng.uniform(0, 2)
        got = language_id.viterbi(s, first, p)
        for i in range(4):
            x = s[first[i] : first[i + 1]]
            value = lambda q: sum(x[t, z] for t, z in enumerate(q)) - p * sum(u != v for u, v in zip(q, q[1:]))  # noqa: B023, E731
            assert math.isclose(
                max(map(value, itertools.product(range(3), repeat=len(x)))), value(got[first[i] : first[i + 1]].tolist()), abs_tol=1e-9
            )


def _languages(spark, n=80):
    rng = random.Random(0)
    words = {
        "en": "the house with three open windows stands near".split(), "de": "das haus mit drei offenen fenstern steht über".split(),
        "ru": "дом с тремя открытыми окнами стоит у реки".split()
    }
    rows = [(i, " ".join(rng.choices(words[la], k=12)), la) for i, la in zip(range(n), itertools.cycle(words))]
    return rows + [(n, None, "en"), (n + 1, "", None), (n + 2, "12 34 !!", "de"), (None, "the open windows", None)]


def test_language(spark):
    rows = _languages(spark)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(d)
    assert model.langs == ["de", "en", "ru"]
    got = {r.doc_id: r for r in language_id.identify(d.select("doc_id", "text"), model, with_spans=True).collect()}
    assert all(got[i].lang_pred == la and 0 <= got[i].score <= 1 for i, _, la in rows[:80])
    assert [got[i].lang_pred for i in (80, 81, 82)] == ["und"] * 3 and got[None].lang_pred == "en"
    mixed = spark.createDataFrame([(1, "the house with open windows дом с тремя окнами стоит у реки")], "doc_id long, text string")
    spans = language_id.identify(mixed, model, with_spans=True).first().spans
    assert [(s.first_word, s.end_word, s.lang) for s in spans] == [(0, 5, "en"), (5, 12, "ru")]
    assert language_id.identify(d.select("doc_id", "text").limit(0), model).count() == 0


def test_language_without_labels(spark):
    d = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language_id.identify(d.select("doc_id", "text"), language_id.fit(d)).first().lang_pred == "und"


def test_licences():
    notice = license_scan.MIT_GRANT.replace(
        "and associated", "\n * and associated"
    ) + "\n\n * " + license_scan.MIT_NOTICE.replace("in all", "in\n * all")
    t = [
        "Foo bar.\nLicensed under CC BY-NC 4.0.\nmore", "xx&&& yy\nReleased under the MIT License.", None, "", "/*\n * " + notice + "\n */",
        "All rights reserved. Licensed under the Apache License, Version 2.0.", "licensed under nothing.",
        "word " * 5000 + "\nMIT License\n"
    ]
    data, off = texts(pa.array(t))
    _, found = license_scan.recognise(data, off)
    got = [[x for _, _, x in license_scan.match(f)] for f in found]
    assert got == [["CC-BY-NC-4.0"], ["MIT"], [], [], ["MIT"], ["Apache-2.0"], [], ["MIT"]]


def test_licences_against_plain_search(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    names = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
        "All rights reserved.": "Proprietary"
    }
    want = {r.doc_id: sorted({v for k, v in names.items() if any(x.strip() == k for x in (r.text or "").split("\n"))}) for r in d.collect()}
    assert {r.doc_id: list(r.licences) for r in license_scan.scan(d).collect()} == want


def test_quality_figures(spark):
    rng = random.Random(3)
    lines = ["a b c d e f g", "# x | y", "", "  ", "a b c d e f g", "Good line, indeed.", "é ß ñ"]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9))) or None) for i in range(60)] + [(None, "a b")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for r in quality_rules.judged(d, quality_rules.Field()).join(d, "doc_id").collect():
        t = r.text or ""
        w = WORD.findall(t)
        win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        again = {k for i, x in enumerate(win) if win.count(x) > 1 for k in range(i, i + 5)}
        full = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(again))
        assert want == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and r.kept == (not r.base_failed)


def test_field_gradient_and_decoding():
    rng = np.random.default_rng(1)
    first = np.array([0, 3, 3, 5, 9])
    x = rng.normal(size=(9, quality_rules.N_FEATURES))
    f = quality_rules.Field(rng.normal(size=quality_rules.N_FEATURES), rng.normal(size=(2, 2)))
    y = rng.integers(0, 2, 9).astype(float)

    def score(q, a, b):
        s = x[a:b] @ f.w
        return sum(s[i] * v for i, v in enumerate(q)) + sum(f.t[u, v] for u, v in zip(q, q[1:]))

    ll, labels = 0.0, f.decode(x, first)
    for a, b in zip(first, first[1:]):
        every = [score(q, a, b) for q in itertools.product((0, 1), repeat=b - a)]
        if b > a:
            ll += score(y[a:b].astype(int).tolist(), a, b) - np.logaddexp.reduce(every)
            assert math.isclose(max(every), score(labels[a:b].tolist(), a, b), abs_tol=1e-9)
    got, gw, gt = f.gradient(x, y, first)
    assert math.isclose(got, ll, abs_tol=1e-9)
    for g, name, at in ((gw, "w", (3,)), (gt, "t", (0, 1)), (gt, "t", (1, 1))):
        v = getattr(f, name)
        v[at] += 1e-6
        up = f.gradient(x, y, first)[0]
        v[at] -= 1e-6
        assert math.isclose((up - got) / 1e-6, g[at], rel_tol=1e-3, abs_tol=1e-4)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.col("doc_id"), F.lit(2))
    field = quality_rules.fit(docs, labels.where(half == 0))
    got = quality_rules.judged(docs, field).join(labels.where(half == 1), "doc_id").where("NOT base_failed")
    n, right = got.count(), got.where(F.col("kept") == (F.col("quality") == 1)).count()
    assert n > 100 and right >= 0.95 * n


def test_class_model_sums_to_one():
    rng = np.random.default_rng(2)
    words, classes = np.arange(12), np.r_[0, rng.integers(1, 4, 11)]
    seq = np.r_[rng.integers(1, 12, 300), 0]
    c = classes[seq]
    m = np.zeros((4, 4))
    np.add.at(m, (np.r_[0, c[:-1]], c), 1)
    count = np.bincount(seq, minlength=12)
    model = class_lm.ClassModel(m, np.bincount(classes[count > 0], minlength=4), len(seq), int((count > 0).sum()), 0.5)
    for before in range(5):
        known = sum(10 ** model.logs(count[[i]], np.array([before]), classes[[i]])[1][0] for i in words if count[i])
        unknown = 10 ** model.logs(np.array([0]), np.array([before]), np.array([3]))[1][0]
        assert math.isclose(known + unknown, 1, rel_tol=1e-9)


@pytest.mark.parametrize("unit", [1000, 1 << 20])
def test_class_lm(spark, unit):
    import collections
    import zlib

    rng = random.Random(0)
    grammar = [["the", "A"], ["cat", "dog", "bird"], ["sees", "hears"], ["the", "a"], ["tree", "sky"]]
    rows = [(i, " ".join(rng.choice(g) for g in grammar * rng.randint(1, 3))) for i in range(150)] + [(150, None), (None, "the zebra")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0)) == 1
    got = class_lm.scored(d, held, n_classes=8, unit_bytes=unit).collect()
    low = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + ["\n"]
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    c = collections.Counter(w for i, t in rows if not out[i] for w in low(t))
    n, v = sum(c.values()), len(c)
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        w = low(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
    h = [r for r in got if r.held_out]
    assert sum(r.score for r in h) > sum(r.base_score for r in h)


def _score_by_hand(rows, out, n_classes, passes):
    """Scores of rows (doc_id, text), one word after the other; the likelihoods before each pass."""
    from textmill.llm._text import mix, spans

    low = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + ["\n"]
    hashed = lambda w: int(
        mix(spans(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())])), 1)[0].astype(np.int64)
    )
    train = [low(t) for i, t in rows if not out[i]]
    count = {}
    for w in itertools.chain(*train):
        count[w] = count.get(w, 0) + 1
    first = sorted((w for w in count if w != "\n"), key=lambda w: (-count[w], hashed(w)))[: n_classes - 2]
    of = {w: n_classes - 1 for w in count} | {w: i + 1 for i, w in enumerate(first)} | {"\n": 0}

    def bigrams(of):
        m = np.zeros((n_classes, n_classes), np.int64)
        for t in train:
            for a, b in zip(["\n", *t], t):
                m[of[a], of[b]] += 1
        return m

    rose = []
    for _ in range(passes):
        m = bigrams(of)
        rose.append(class_lm.likelihood(m))
        r, new = class_lm.log_ratios(m).astype(np.float32), {"\n": 0}
        for w in count.keys() - {"\n"}:
            gain = np.zeros(n_classes, np.float32)
            for t in train:
                for a, x, b in zip(["\n", *t], t, t[1:]):
                    if x == w:
                        gain += r[of[a]] + r[:, of[b]]
            gain[0] = -np.inf
            new[w] = of[w] if of[w] and gain[of[w]] >= gain.max() - 1e-4 else int(gain.argmax())
        if class_lm.likelihood(bigrams(new)) < rose[-1]:
            break
        of = new
    n1, n2 = (sum(n == k for n in count.values()) for k in (1, 2))
    types = np.bincount([of[w] for w in count], minlength=n_classes)
    model = class_lm.ClassModel(bigrams(of), types, sum(count.values()), len(count), n1 / (n1 + 2 * n2) if n1 and n2 else 0.5)
    scores = []
    for _, t in rows:
        before, total = 0, 0.0
        for w in low(t):
            c = of.get(w, n_classes)
            total += model.logs(np.array([count.get(w, 0)]), np.array([before]), np.array([min(c, n_classes - 1)]))[1][0]
            before = c
        scores.append(total)
    return scores, rose


def test_class_lm_by_hand(spark, caplog):
    """Whole scores against the same algorithm word by word; repeated rows, a very long text, extra columns, an empty table."""
    rng = random.Random(5)
    grammar = [["the", "A", "one"], ["cat", "dog", "bird", "fish"], ["sees", "hears"], ["the", "a"], ["tree", "sky", "sea"]]
    rows = [
        (i, " ".join(rng.choice(g) for g in grammar * rng.randint(1, 4))) for i in range(60)
    ] + [(60, None), (7, "the zebra"), (7, "the zebra"), (61, "the cat " * 3000)]
    out = {i: i % 5 == 1 for i, _ in rows}
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    with caplog.at_level("INFO", class_lm.__name__):
        got = class_lm.scored(d, F.col("doc_id") % 5 == 1, n_classes=7, unit_bytes=700).collect()
    want, rose = _score_by_hand(rows, out, 7, class_lm.PASSES)
    key = lambda x: (x[0], x[1])
    for (i, x), (j, y) in zip(
        sorted(((r.doc_id, r.score) for r in got), key=key), sorted(zip((i for i, _ in rows), want), key=key), strict=True
    ):
        assert i == j and math.isclose(x, y, rel_tol=1e-6)
    logged, kept = caplog.records[-1].args
    assert np.allclose(logged, rose) and kept >= logged[0]
    assert class_lm.scored(d.limit(0), F.lit(False)).count() == 0


def test_quality_and_language_of_nothing_and_of_repeated_rows(spark):
    rows = _languages(spark) + [(5, "the house", "en"), (5, "the house", "en"), (90, "the open windows " * 60_000, None)]
    d = spark.createDataFrame([(i, t, la, "x") for i, t, la in rows], "doc_id long, text string, lang string, score string")
    model = language_id.fit(d)
    assert language_id.identify(d.limit(0), model).count() == 0
    got = [r for r in language_id.identify(d.select("doc_id", "text"), model).collect() if r.doc_id in (5, 90)]
    assert sorted((r.doc_id, r.lang_pred) for r in got)[-1] == (90, "en") and len(got) == 4
    kept = language_id.keep(d, model)
    assert kept.columns == d.columns and {r.score for r in kept.collect()} == {"x"}


def test_text_of_three_languages_stays(spark):
    words = {
        "en": "the house and the garden with that old tree", "de": "das haus und der garten mit dem alten baum",
        "ru": "дом и сад со старым деревом на улице"
    }
    rows = [(i, " ".join(words[k].split()[i % 3 :]), k) for i, k in enumerate(list(words) * 20)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = spark.createDataFrame([(1, " ".join(words.values())), (2, "123 ..."), (3, None)], "doc_id long, text string")
    assert [r.doc_id for r in language_id.keep(mixed, model).collect()] == [1]
    assert language_id.keep(mixed, model, least=0.5).count() == 0


def _peak(f) -> int:
    import tracemalloc

    f()
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_class_lm_takes_units_one_at_a_time_and_in_small_arrays():
    """What a task holds does not grow with the units of its batch, and is a few numbers a token within one."""
    import pyarrow as pa

    from textmill.llm._text import pack, pack_sorted

    rng = np.random.default_rng(3)
    vocab = np.unique(np.r_[class_lm.END, rng.integers(2, 1 << 63, 20_000).astype(np.uint64)])
    tokens = rng.integers(1, len(vocab), 400_000).astype(np.int32)
    tokens[499::500] = 0
    train = np.bincount(tokens, minlength=len(vocab)).astype(np.uint32)
    row = {
        "unit": 1, "vocab": pack_sorted(vocab), "train": pack(train), "tokens": pack(tokens), "doc_id": list(range(800)),
        "held": [False] * 800, "n_tokens": [500] * 800
    }
    few, many = (pa.RecordBatch.from_pylist([{k: row[k] for k in ("unit", "vocab", "train")}] * n) for n in (2, 40))
    send = lambda batch: sum(x.num_rows for x in class_lm._send_counts(16)(iter([batch])))
    assert send(many) == 20 * send(few)
    assert _peak(lambda: send(many)) < 1.5 * _peak(lambda: send(few))
    u, classes = class_lm.Unit(row), (np.arange(len(vocab)) % 63 + 1).astype(np.uint8)
    classes[0] = 0
    assert _peak(lambda: class_lm._profiles(u, classes, 16, 64)) < 60 * len(tokens)
