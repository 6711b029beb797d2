import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textmill.functions import simhash
from textmill.functions import text as X
from textmill.operators import filters, transforms


def values(spark, texts, *columns):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [tuple(r) for r in d.orderBy("i").select(*columns).collect()]


def test_scalars(spark):
    texts = [None, "", "a", "a   b\n", "x" * 10, "y" * 6, "tab\there\x85", "a b c a b c"]
    got = values(
        spark, texts, X.collapse(F.coalesce("text", F.lit(""))), X.est_tokens("text"), X.printable_ratio("text"),
        X.repetition_3gram("text"), X.n_bytes("text")
    )
    for t, (c, n, p, r, b) in zip(texts, got):
        t = t or ""
        w = t.split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        assert c == " ".join(w) and n == max(1, round(len(t) / 4)) and b == len(t.encode())
        assert p == pytest.approx(sum(map(str.isprintable, t)) / max(1, len(t)))
        assert r == pytest.approx(1 - len(set(grams)) / len(grams) if grams else 0)


def test_quality_score(spark):
    d = spark.createDataFrame([("", None), ("a" * 300, "https://x.com/a"), ("word " * 6000, None)], "text string, url string")
    empty, short, long = (r[0] for r in d.select(X.quality_score("text", "url")).collect())
    assert empty == -10 and short == pytest.approx(0.3 + 0.3 - 0.5)
    assert long == pytest.approx(5 - 0.5 + 0.3 - 2 * (1 - 1 / 3998))


def test_urls_names_markup(spark):
    urls = ["https://x.com/a", "https://fox.com/a", "https://a.org"]
    assert [r[0] for r in values(spark, urls, X.url_penalty("text"))] == [-0.5, -0.5, 0.0]
    assert [r[0] for r in values(spark, ["a b/c", "", None], X.safe_name("text"))] == ["a_b_c", "unknown", "unknown"]
    html = "<p>Hi</p><pre><code>x\n<b></code></pre> <code>y</code>&amp;"
    assert values(spark, [html], X.strip_html("text")) == [("Hi x y&amp;",)]
    wiki = "{{box\n|a}}'''Bold''' [[Page|label]] [[Other]]<ref name=a>x</ref> end"
    assert values(spark, [wiki], X.strip_wikitext("text")) == [("Bold label Other end",)]


def test_hashes(spark):
    assert values(spark, ["a  b", None], X.exact_hash("text"))[0][0] == X.blake2b8("a b")
    assert values(spark, ["é"], X.nfc_line("text")) == [("é\n",)]
    assert X.params_hash({"a": 1, "b": 2}) == X.params_hash({"b": 2, "a": 1})


def test_simhash(spark):
    assert simhash.normalise("Hello, world! This is   a test. Don’t panic.") == "hello world this is a test dont panic"
    assert simhash.fingerprint("", 64) == [0]
    texts = ["short one", "word " * 200, "ﬁne Straße"]
    for bits in (10, 64, 128):
        got = [r[0] for r in values(spark, texts, simhash.fingerprints(bits)("text"))]
        for t, r in zip(texts, got):
            s = simhash.normalise(t)
            votes = [0] * bits
            for x in simhash.shingles(s):
                import hashlib

                h = int.from_bytes(hashlib.blake2b(x.encode(), digest_size=max(1, -(-bits // 8))).digest(), "little")
                votes = [v + (1 if h >> i & 1 else -1) for i, v in enumerate(votes)]
            want = sum(1 << i for i, v in enumerate(votes) if v > 0)
            assert sum((w & (2**64 - 1)) << 64 * i for i, w in enumerate(r.fp)) == want and r.norm_len == len(s)


def test_filters(spark):
    bad = filters.TOXIC_WORDS[1]
    texts = {
        None: "too_short", "x" * 199: "too_short", "é" * 300: "low_ascii_ratio", "#! " * 100: "symbol_ratio", "ok line here\n" * 20: "boilerplate_repeat",
        "plain words " * 20 + "Terms of Service": "boilerplate_phrase", "plain words " * 20 + bad.upper(): "toxicity", "plain words " * 20 + bad + "ake": None, "x" * 1_000_001: "too_long", "plain words " * 20: None,
    }
    assert [r[0] for r in values(spark, list(texts), filters.drop_reason())] == list(texts.values())
    assert values(spark, ["é" * 300], filters.drop_reason(chain=filters.WITHOUT_LANGUAGE)) == [(None,)]


def test_normalise(spark):
    rows = spark.read.json(
        spark.sparkContext.parallelize(
            [
                '{"content": "c", "id": "7", "url": "u", "license": "MIT", "timestamp": "t"}',
                '{"text": "", "question": {"title": "T", "body": "B", "tags": "x", "creation_date": "d"}, "answer": {"body": "A"}}',
                '{"text": "only"}'
            ]
        )
    )
    a, b, c = sorted(transforms.normalise(rows, "dom", "src", "L").collect(), key=lambda r: r.text)[::-1][::-1]
    by = {r.text: r for r in (a, b, c)}
    assert by["c"].doc_id == "7" and by["c"].license_tag == "MIT" and by["c"].created_at == "t" and by["c"].meta == {"url": "u"}
    q = by["Q: T\nB\nA: A"]
    assert q.created_at == "d" and q.meta == {"tags": "x"} and q.license_tag == "L" and q.doc_id == X.blake2b8("src::" + q.text)
    assert by["only"].meta is None and by["only"].domain == "dom"


def test_chunks(spark):
    d = spark.createDataFrame([("a", "x" * 25), ("b", ""), ("c", "abc")], "doc_id string, text string")
    got = {r.doc_id: (r.text, r.chunk_start) for r in transforms.chunk(d, 10, 2).collect()}
    assert got == {
        "a::chunk0": ("x" * 10, 0), "a::chunk1": ("x" * 10, 8), "a::chunk2": ("x" * 9, 16), "a::chunk3": ("x", 24), "c::chunk0": ("abc", 0)
    }
    with pytest.raises(ValueError):
        transforms.chunk(d, 5, 5)


def test_stackexchange(spark):
    posts = spark.createDataFrame(
        [
            ("1", "1", None, "3", "T", "<p>q</p>", "<t>", "d", "0", 0), ("2", "2", "1", None, None, "best", None, None, "9", 1),
            ("3", "2", "9", None, None, "taken", None, None, "0", 2), ("4", "1", None, None, "U", "q2", "", "d", "0", 3),
            ("5", "2", "4", None, None, "first", None, None, "1", 4), ("6", "2", "4", None, None, "second", None, None, "1", 5),
            ("7", "1", None, None, "V", "q3", "", "d", "0", 6)
        ],
        "Id string, PostTypeId string, ParentId string, AcceptedAnswerId string, Title string, Body string, Tags string, CreationDate string, Score string, ord long"
    )
    got = {r.doc_id: r.text for r in transforms.stackexchange(posts).collect()}
    assert got == {"1": "Q: T\nq\nA: taken", "4": "Q: U\nq2\nA: first", "7": "Q: V\nq3\nA:"}
    assert {r.id: r.answer.body for r in transforms.stackexchange_raw(posts).collect()} == {"1": "best", "4": "first", "7": ""}


def test_json_has_all_keys(spark):
    d = spark.createDataFrame([("1", "é")], "doc_id string, text string")
    assert set(re.findall(r'"(\w+)":', transforms.to_json(d).first()[0])) == {
        "text", "source", "domain", "doc_id", "license_tag", "created_at", "meta"
    }
    assert unicodedata.normalize("NFC", "é") in transforms.to_json(d).first()[0]
