import base64
import random
import zlib

import public_tokenizers as P
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from textmill.llm import byte_bpe, packing, warc
from textmill.llm._text import texts


def gz(b):
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(b) + z.flush()


def rec(i):
    body = b"<p>%d</p>" % i * 50
    return warc.record(i, f"http://x/{i}", body, len(body), warc.digest(body), None)


def test_salvage():
    raw = gz(rec(0)) + rec(1) + b"junk WARC/1.0\r\n more" + gz(rec(2))[:40] + gz(rec(3)) + rec(4)[:60] + rec(5) + b"tail"
    got = list(warc.salvage(raw))
    ids = [h["warc-record-id"] for _, _, h, _, _ in got if h]
    assert ids == [f"<urn:page:{i}>" for i in (0, 1, 3, 5)]
    assert [r[0] for r in got] == [0] + [a + n for a, n, *_ in got[:-1]] and sum(r[1] for r in got) == len(raw)
    assert len([r for r in got if r[4]]) == 3


def test_salvage_of_damage_anywhere():
    rng = random.Random(0)
    whole = [gz(rec(i)) if i % 2 else rec(i) for i in range(8)]
    for _ in range(150):
        k = rng.randrange(8)
        parts = list(map(bytearray, whole))
        for _ in range(3):
            parts[k][rng.randrange(len(parts[k]))] ^= rng.randrange(1, 256)
        got = {h["warc-record-id"] for _, _, h, _, _ in warc.salvage(b"".join(map(bytes, parts))) if h}
        assert {f"<urn:page:{i}>" for i in range(8) if i != k} <= got
    bad = rec(1).replace(b"<p>1", b"<p>2")
    assert [r[4] for r in warc.salvage(bad)] == ["payload digest differs"]
    assert list(warc.salvage(b"")) == []


def test_warc_round_trip(spark, tmp_path):
    rows = [
        (1, "http://a", "x"), (2, None, "x"), (3, "u v\n", None), (4, "", ""), (None, "http://n", "x"), (5, "http://é", "é" * 5000),
        (2, "again", "x")
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(pages, f"file://{tmp_path}/w", archive_bytes=2000)
    got = sorted(
        (
            (r.record_id, r.type, r.refers_to, r.payload_bytes, r.payload_digest)
            for r in warc.read(spark, f"file://{tmp_path}/w").where("reason IS NULL").collect()
        ),
        key=str
    )
    u = lambda i: f"<urn:page:{i}>"
    d = lambda s: warc.digest(s.encode())
    want = [
        (u(1), "response", None, 1, d("x")), (u(2), "revisit", u(1), 1, d("x")), (u(2), "revisit", u(1), 1, d("x")),
        (u(""), "revisit", u(1), 1, d("x")), (u(3), "response", None, 0, d("")), (u(4), "revisit", u(3), 0, d("")),
        (u(5), "response", None, 10000, d("é" * 5000))
    ]
    assert got == sorted(want, key=str)


def test_bpe_is_tiktoken():
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    t = ["".join(rng.choice("ab  \n\t'sré 　 ,.1٣漢 \x85\x1ć\U0001f600") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    t += ["a" * 1000, "ab" * 700, "abcabd" * 300, "".join(rng.choice("abcdefgh") for _ in range(3000)), "", "<|endoftext|>"]
    b = byte_bpe.bpe(path)
    data, off = texts(pa.array([*t, None]))
    ids, at = b.encode(data, off)
    assert all(ids[at[i] : at[i + 1]].tolist() == want.encode_ordinary(x) for i, x in enumerate(t))
    assert b.decode(ids).tobytes() == data.tobytes()


def test_bpe_rows(spark):
    d = spark.createDataFrame([(1, "hello world", 1), (1, "hello world", 2), (None, None, 3)], "doc_id long, text string, ids int")
    got = byte_bpe.encoded(d, with_ids=True).collect()
    assert sorted(len(r.ids) for r in got) == [0, 2, 2] and byte_bpe.encoded(d.limit(0)).count() == 0


def one_by_one(counts, size):
    left = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fits = [(r, i) for i, r in enumerate(left) if r >= n]
            if fits:
                left[min(fits)[1]] -= n
            else:
                left.append(size - n)
    return sorted(left)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(100):
        size = rng.choice([7, 16, 33, 64])
        counts = {n: rng.randint(1, 30) for n in rng.sample(range(1, size + 1), rng.randint(1, min(size, 12)))}
        rows, bins = packing.plan(counts, size), {}
        for n in counts:
            own = sorted(r[1:] for r in rows if r[0] == n)
            for k in range(counts[n]):
                start, first, offset, each = [r for r in own if r[0] <= k][-1]
                bins.setdefault(first + (k - start) // each, []).append((offset + (k - start) % each * n, n))
        for b in bins.values():
            at = 0
            for offset, n in sorted(b):
                assert offset == at
                at += n
        assert sorted(size - sum(n for _, n in b) for b in bins.values()) == one_by_one(counts, size)


def test_packing(spark):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = [
        (i, "word " * n) for i, n in enumerate([0, 1, 5, 2046, 2047, 2048, 5000, 300, 300])
    ] + [(9, None), (None, "Two words"), (10, "it's ÉCOLE  naïve…　x ½")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        want += [
            (i, k, s, len(ids[s : s + 2048]), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in ids[s : s + 2048])))
            for k, s in enumerate(range(0, len(ids), 2048))
        ]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    counts = {}
    for w in want:
        counts[w[3]] = counts.get(w[3], 0) + 1
    assert len(bins) == len(one_by_one(counts, 2048))
