"""Whole results of op7 and op8 against plain Python, one line and one word at a time."""

import math
import re
import unicodedata
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest

from textmill.llm import language_id, quality_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def best_path(scores, step):
    """The labels of the best path; of equal ways the one from the lowest label. step(a, b): the score of b after a."""
    n = len(scores[0])
    value, back = list(scores[0]), []
    for s in scores[1:]:
        came = [max(range(n), key=lambda a: value[a] + step(a, b)) for b in range(n)]  # noqa: B023
        value, back = [value[a] + step(a, b) + s[b] for b, a in enumerate(came)], [*back, came]
    at = max(range(n), key=value.__getitem__)
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return path[::-1]


def line_features(text):
    """(features, number of words) of each line with a word."""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = [
        any(grams[tuple(words[j : j + 5])] > 1 for j in range(max(0, i - 4), min(i, len(words) - 5) + 1)) for i in range(len(words))
    ]
    seen, out, at = set(), [], 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        n = len(own)
        if not n:
            continue
        share = lambda chars, by: sum(c in chars for c in line) / by  # noqa: B023, E731
        capital = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        letters = sum(map(len, own))
        out.append(([
            1, min(share("#*$%&|<>", n), 1), min(share("|", n), 1), min(share("!", n), 1), share(capital, letters), share("0123456789", letters),
            min(
                share("#*$%&|<>{}[]=_~^\\/@+", n), 1
            ), min(share(",;:", n), 1), own[-1][-1] in ".!?\"')", own[0][0] in capital, line in seen,
            sum(repeated[at : at + n]) / n, min(math.log1p(n) / 5, 1), 1 - len(set(own)) / n,
        ], n))
        seen.add(line)
        at += n
    return out, words, sum(repeated)


def check_quality(rows, field):
    for r in rows:
        lines, words, again = line_features(r.text or "")
        content = 0.0
        if lines:
            x = np.array([f for f, _ in lines], np.float32)
            path = best_path([(0.0, float(v)) for v in x @ field.w], lambda a, b: float(field.t[a, b]))
            content = sum(n for (_, n), label in zip(lines, path) if label) / len(words)
        failed = len(words) < 10 or 100 * again > 20 * len(words)
        assert (r.n_words, r.n_repeat_words, r.base_failed) == (len(words), again, failed)
        assert math.isclose(r.content_share, content, abs_tol=1e-9), r.doc_id
        assert r.kept == (not failed and content >= 0.5)


def test_quality_of_all_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    field = quality_rules.fit(docs, labels)
    rows = quality_rules.op7_quality_rules(spark, SF).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == docs.count() and len({r.kept for r in rows}) == 2
    check_quality(rows, field)


@pytest.mark.parametrize("seed", range(3))
def test_quality_by_any_field(spark, seed):
    """Fields that tell neighbours apart, over short lines, equal lines, blanks and marks."""
    rng = np.random.default_rng(seed)
    field = quality_rules.Field(rng.normal(size=quality_rules.N_FEATURES), rng.normal(size=(2, 2)))
    pieces = ["a b c", "Ab, cd;", "", " \t", "| x | y |", "é ü!", "1 2 3 4 5 6 7 8 9 10", "END.", "a b c d e f", "\r", "#"]
    texts = ["\n".join(rng.choice(pieces, rng.integers(0, 12))) for _ in range(60)] + [None, "", "one", "a b\n" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_quality(quality_rules.judged(docs, field).join(docs, "doc_id").collect(), field)


def hashed(a, b, c):
    x = (a << 16 | b << 8 | c) + 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    x = (x ^ x >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
    return (x ^ x >> 31) >> 48


def word_grams(word):
    b = [32, *(x + 32 if 65 <= x <= 90 else x for x in word.encode()), 32]
    return [hashed(*b[i : i + 3]) for i in range(len(b) - 2)]


def word_scripts(word):
    def script(c):
        found = [s for s, a, b in language_id.SCRIPTS if a <= ord(c) <= b]
        return found[-1] if found else "other"

    return {script(c) for c in word if unicodedata.category(c)[0] == "L"}


def languages_by_hand(learn, rows):
    """{doc_id: (language, score)} of rows (doc_id, text) by what rows (text, lang) teach."""
    grams, scripts = {}, {}
    for text, lang in learn:
        for word in WORD.findall(text):
            if kinds := word_scripts(word):
                grams.setdefault(lang, Counter()).update(word_grams(word))
                scripts.setdefault(lang, Counter()).update(kinds)
    langs = sorted(grams)
    whole = {x: sum(grams[x].values()) + 0.1 * 65536 for x in langs}
    uses = {x: {k for k, n in scripts[x].items() if n >= 0.01 * sum(scripts[x].values())} for x in langs}
    out = {}

    @cache
    def score(word):
        kinds = word_scripts(word)
        if not kinds:
            return [0.0] * len(langs), False
        can = [bool(kinds & uses[x]) for x in langs]
        s = [
            sum(math.log((grams[x][g] + 0.1) / whole[x]) for g in word_grams(word)) if ok or not any(can) else -math.inf
            for x, ok in zip(langs, can)
        ]
        total = max(s) + math.log(sum(math.exp(v - max(s)) for v in s))
        return [max(v - total, -12.0) for v in s], True

    for doc_id, text in rows:
        words = WORD.findall(text or "")
        scored = [score(w) for w in words]
        out[doc_id] = ("und", 0.0)
        if any(letter for _, letter in scored) and langs:
            path = best_path([s for s, _ in scored], lambda a, b: -6.0 * (a != b))
            votes = Counter(langs[x] for x, (_, letter) in zip(path, scored) if letter)
            lang = min(votes, key=lambda x: (-votes[x], x))
            out[doc_id] = (lang, votes[lang] / sum(votes.values()))
    return out


def test_languages_of_all_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    rest = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 for r in rows}
    learn = [(r.text, r.lang) for r in rows if r.text is not None and r.lang is not None and rest[r.doc_id] != 2]
    want = languages_by_hand(learn, [(r.doc_id, r.text) for r in rows])
    got = language_id.op8_language_id(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (rest[r.doc_id] == 2)
        assert r.lang_pred == want[r.doc_id][0] and math.isclose(r.score, want[r.doc_id][1], abs_tol=1e-9), (r, want[r.doc_id])


def test_languages_of_several_scripts(spark):
    learn = [
        ("the quick brown fox and the lazy dog " * 5, "en"), ("быстрая лиса и ленивая собака " * 5, "ru"),
        ("η γρήγορη αλεπού και ο τεμπέλης σκύλος " * 5, "el"), ("der schnelle fuchs und der faule hund " * 5, "de")
    ]
    texts = [
        "the dog и собака и лиса", "42 — 7", "", None, "σκύλος fox собака", "漢字 the", "Ünïcödé hund und fuchs",
        "dog " * 40 + "собака " * 41 + "1 2 3", "ffi² и"
    ]
    rows = list(enumerate(texts))
    model = language_id.fit(spark.createDataFrame([(i, *x) for i, x in enumerate(learn)], "doc_id long, text string, lang string"))
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    want = languages_by_hand(learn, rows)
    assert {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in got} == {k: (x, round(v, 9)) for k, (x, v) in want.items()}
