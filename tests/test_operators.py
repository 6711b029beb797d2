import random

import pytest
from pyspark.sql import functions as F

from textmill.functions import simhash
from textmill.operators import dedup, mix, pack, reports
from textmill.streaming import exact


def frame(spark, texts, sources=None):
    return spark.createDataFrame(
        [(i, f"d{i}", t, "s" if not sources else sources[i], "x") for i, t in enumerate(texts)],
        "ord long, doc_id string, text string, source string, domain string"
    )


def by_id(d):
    return {r.doc_id: r for r in d.collect()}


def test_exact_scopes(spark):
    d = frame(spark, ["same  text", "same text", "other", None, ""], ["a", "b", "a", "a", "a"])
    assert {i for i, r in by_id(dedup.exact_decisions(d, "global")).items() if r.keep} == {"d0", "d2", "d3"}
    assert {i for i, r in by_id(dedup.exact_decisions(d, "per-source")).items() if r.keep} == {"d0", "d1", "d2", "d3"}
    assert by_id(dedup.exact_decisions(d, "global"))["d1"].dup_of == "d0"


def in_turn(texts, threshold, bits=64):
    """Matches and clusters, one document after the other, as the semantics say."""
    prints = [sum((w & (2**64 - 1)) << 64 * i for i, w in enumerate(simhash.fingerprint(simhash.normalise(t), bits))) for t in texts]
    out, cluster = [], []
    for i, f in enumerate(prints):
        match = None
        for start, size in simhash.bands(bits):
            mask = ((1 << size) - 1) << start
            match = next((j for j in range(i) if prints[j] & mask == f & mask and (prints[j] ^ f).bit_count() <= threshold), None)
            if match is not None:
                break
        if match is None and (len(simhash.normalise(texts[i])) < 400 or threshold >= bits):
            near = [((prints[j] ^ f).bit_count(), f"d{j}", j) for j in range(i) if (prints[j] ^ f).bit_count() <= threshold]
            match = min(near)[2] if near else None
        cluster.append(i if match is None else cluster[match])
        out.append((match, cluster[-1]))
    return out


def words(rng, n):
    return [rng.choice(["alpha", "beta", "gamma", "delta", "rho", "tau"]) for _ in range(n)]


@pytest.mark.parametrize("threshold", [3, 12])
def test_clusters_against_one_by_one(spark, threshold):
    rng = random.Random(threshold)
    texts = []
    for _ in range(50):
        if texts and rng.random() < 0.6:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(0, 2)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice("uvw")
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(words(rng, rng.choice([0, 3, 30, 150]))))
    want = in_turn(texts, threshold)
    got = by_id(dedup.near_decisions(frame(spark, texts), "near", "global", "first", threshold))
    for i, (match, root) in enumerate(want):
        r = got[f"d{i}"]
        assert (r.match_id, r.cluster_id, r.keep) == (None if match is None else f"d{match}", f"d{root}", match is None)


def test_best_of_cluster(spark):
    small, large = "tide tables " * 4, "the harbour keeps its tide tables in a drawer " * 40
    got = by_id(dedup.near_decisions(frame(spark, [small, large]), "near", "global", "best", threshold=64))
    assert (got["d1"].reason, got["d0"].reason, got["d0"].dup_of) == ("keep_best", "near_dup", "d1")
    got = by_id(dedup.near_decisions(frame(spark, [large, large + "today"]), "near", "global", "first", threshold=64))
    assert (got["d0"].keep, got["d1"].keep, got["d1"].match_id) == (True, False, "d0")


def test_punctuation_and_modes(spark):
    loud = "Wait - it's RAINING; we can't sail (not yet)!"
    d = frame(spark, [loud, "wait its raining   we cant sail not yet", loud])
    got = by_id(dedup.decisions(d, "both", "global"))
    assert [i for i in sorted(got) if got[i].keep] in (["d0"], ["d1"]) and got["d2"].reason == "exact_dup"
    assert {r.reason for r in dedup.decisions(d, "both", no_near=True).collect()} == {"keep", "exact_dup"}
    assert dedup.kept(d, dedup.decisions(d, "near", "global")).count() == 1
    with pytest.raises(ValueError):
        dedup.decisions(d, "none")


def test_pairs_against_all_pairs(spark):
    """Every pair of fingerprints within 3 bits, each by the bands that it shares."""
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(15)}
    prints = sorted({x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for x in prints for _ in range(8)})
    d = spark.createDataFrame(
        [("", i, [x - (1 << 64) if x >> 63 else x]) for i, x in enumerate(prints)], "scope string, first long, fp array<long>"
    )
    got = {(r.a, r.b, r.band, r.distance) for r in dedup.band_pairs(d, 3).collect()}
    want = set()
    for a, x in enumerate(prints):
        for b, y in enumerate(prints[:a]):
            n = (x ^ y).bit_count()
            want |= {(a, b, k, n) for k in range(4) if n <= 3 and (x ^ y) >> 16 * k & 0xFFFF == 0}
    assert got == want and len(want) > 50


def test_band_keys_are_not_broadcast(spark, tmp_path):
    """A file of few bytes has many more bytes of keys, so its size is no reason to broadcast them."""
    d = spark.range(2000).select(F.lit("").alias("scope"), F.col("id").alias("first"), F.array("id").alias("fp"))
    d.write.parquet(str(tmp_path / "prints"))
    pairs = dedup.band_pairs(spark.read.parquet(str(tmp_path / "prints")), 3)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_rows_of_documents_are_not_broadcast(spark, tmp_path):
    """Joins of clusterings are of a row per document on both sides."""
    frame(spark, ["hello world", "hello world", "Hello world", "another text"]).write.parquet(str(tmp_path / "docs"))
    d = spark.read.parquet(str(tmp_path / "docs"))
    for decided in (dedup.near_decisions(d, "both", "global", "best"), dedup.greedy(d)):
        assert "Broadcast" not in decided._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, (r.keep for r in decided.collect()))) == ["False", "False", "True", "True"]


def test_greedy_keeps_only_indexed(spark):
    got = by_id(dedup.greedy(frame(spark, ["hello world", "hello world", "Hello world"])))
    assert [got[f"d{i}"].reason for i in range(3)] == ["keep", "exact_dup", "near_dup"]


def stream(docs, size, eos):
    """Every position of the packed stream with what is there: (token, segment's document, its place in the document, label)."""
    out = []
    for name, tokens, label in docs:
        pad = -len(out) % size if len(tokens) >= size else int(len(out) % size > 0)
        out += [(eos, None, None, label)] * pad + [(t, name, i, label) for i, t in enumerate(tokens)]
    return out + [(eos, None, None, None)] * (-len(out) % size)


@pytest.mark.parametrize(
    "seed, lengths, block", [(0, [0, 1, 3, 5, 7, 8, 9, 16, 20], 7), (1, [1, 2, 3], 5), (2, [0, 8, 30], 1), (3, [7], 1000)]
)
def test_pack_against_one_stream(spark, seed, lengths, block):
    """Also without any document of a row's length, and with blocks of any size."""
    rng = random.Random(seed)
    size = 8
    docs = [(f"d{i}", [rng.randint(1, 99) for _ in range(rng.choice(lengths))], f"s{i}") for i in range(60)]
    d = spark.createDataFrame(
        [(i, n, "x", s, t) for i, (n, t, s) in enumerate(docs)],
        "mix_ord long, doc_id string, domain string, source string, tokens array<int>"
    )
    got = pack.pack(d, size, 0, block=block).orderBy("row").collect()
    want = stream(docs, size, 0)
    assert [r.row for r in got] == list(range(len(want) // size))
    for r, at in zip(got, range(0, len(want), size)):
        row = want[at : at + size]
        assert list(r.input_ids) == [t for t, *_ in row]
        assert r.source == [x for *_, x in row if x][-1]
        names = list(dict.fromkeys(n for _, n, _, _ in row if n))
        spans = [[i for _, m, i, _ in row if m == n] for n in names]
        assert [tuple(s) for s in r.segments] == [(n, min(i), max(i) + 1) for n, i in zip(names, spans)]


def test_pack_of_nothing(spark):
    assert pack.pack(
        spark.createDataFrame([], "mix_ord long, doc_id string, domain string, source string, tokens array<int>"), 8, 0
    ).count() == 0


def test_loader(spark):
    d = spark.createDataFrame([(list(range(10)),)], "ids array<int>")
    assert d.select(pack.domain_prefix("ids", 99)).first()[0] == [99, *range(9)]
    assert d.select(pack.labels("ids")).first()[0] == [*range(1, 10), -100]
    from pyspark.sql import functions as F

    assert d.select(pack.fill_in_middle("ids", F.lit(2), F.lit(5), 91, 92, 93)).first()[0] == [91, 0, 1, 92, 5, 6, 7, 8, 9, 93]


def test_mixture(spark):
    n = {r.pack: r["count"] for r in pack.mixture(spark, {"a": 3.0, "b": 1.0}, 4000).groupBy("pack").count().collect()}
    assert abs(n["a"] / 4000 - 0.75) < 0.05 and sum(n.values()) == 4000


def test_tokenizers(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"<eos>": 0, "hello": 1, "world": 2, "again": 3}, unk_token="<eos>"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(str(tmp_path / "t.json"))
    tok = pack.Tokenizer(str(tmp_path / "t.json"))
    assert tok.eos_id == 0
    d = frame(spark, ["hello world", None])
    assert {r.doc_id: r.tokens for r in pack.tokenised(d, tok).collect()} == {"d0": [1, 2], "d1": []}
    with pytest.raises(ValueError):
        pack.Tokenizer("x.bin").encode("a")


def test_sampler(spark):
    s = mix.Sampler({"a": 0.7, "b": 0.3}, {"a": {"x": 1.0}, "b": {"y": 1.0}}, seed=1)
    taken = {"a": 0, "b": 0}
    for _ in range(50):
        d, src = s.next()
        s.took(d, src, 10)
        taken[d] += 1
    assert abs(taken["a"] / 50 - 0.7) < 0.2
    docs = frame(spark, ["word " * 10] * 6)
    plan = mix.sampler_plan(docs, {"x": 1.0}, {"x": {"s": 1.0}}, 8, repeat=True).collect()
    assert [(r.ord, r.epoch) for r in plan] == [(i % 6, i // 6) for i in range(8)]
    with pytest.raises(ValueError):
        mix.sampler_plan(docs, {"x": 1.0}, {"x": {"s": 1.0}}, 8)


def test_interleaved(spark):
    docs = frame(spark, ["word " * 8] * 40 + ["word " * 80] * 10, ["a"] * 40 + ["b"] * 10)
    got = mix.numbered(
        mix.interleaved(docs, {("x", "a"): 3.0, ("x", "b"): 1.0}, 1600, repeat=True), "at", "domain", "source", "ord"
    ).orderBy("mix_ord").collect()
    assert [r.mix_ord for r in got] == list(range(len(got)))
    for n in (len(got) // 2, len(got)):
        own = {s: sum(r.est_tokens for r in got[:n] if r.source == s) for s in "ab"}
        assert abs(own["a"] / sum(own.values()) - 0.75) < 0.1
    assert max(r.epoch for r in got) == 2 and {
        (r.source, r.ord, r.epoch) for r in got if r.source == "b"
    } == {("b", i, 0) for i in range(40, 44)}
    with pytest.raises(ValueError):
        mix.interleaved(docs, {("x", "a"): 3.0, ("x", "b"): 1.0}, 1600)
    with pytest.raises(ValueError):
        mix.interleaved(docs, {("x", "none"): 1.0}, 10, repeat=True)


def test_acceptance(spark):
    d = spark.createDataFrame(
        [("a", "value_x = 1.5e-3 and value_x"), ("a", "plain words"), (None, "é" * 20), ("b", "")], "domain string, text string"
    )
    got = {r.domain: r for r in reports.acceptance(d, "/opt/tokenizers/piece_bpe_32k.model", 1.0, 1.0, 0.0, 0.0).collect()}
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    n = sum(len(sp.encode(t)) for t in ("value_x = 1.5e-3 and value_x", "plain words"))
    assert set(got) == {"a", "unknown"} and got["a"].samples == 2 and got["a"].ok and got["a"].token_per_char == pytest.approx(n / (28 + 11))
    assert got["a"].sci_le2_rate == float(len(sp.encode("1.5e-3")) <= 2)


def test_places(spark):
    """Places among equal keys, null and the word null apart, over several blocks of a column with gaps."""
    rng = random.Random(8)
    rows = [(k, rng.choice(["hot", "hot", None, "null"]), rng.choice([None, 1])) for k in rng.sample(range(20000), 400)]
    got = mix.placed(spark.createDataFrame(rows, "o long, a string, b int"), "o", "a", "b").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.nth == sum((a, b) == (r.a, r.b) and o <= r.o for o, a, b in rows)
    assert mix.placed(spark.createDataFrame([], "o long, a string"), "o", "a").count() == 0


def test_seeds_of_passes():
    seeds = {mix.chance_seed(s, k, e) for s in (1, 2) for k in ("a", "b") for e in (0, 1)}
    assert len(seeds) == 8 and all(0 <= x < 2**31 - 1 for x in seeds) and mix.chance_seed(1, "a", 0) in seeds


def test_weights(spark):
    with pytest.raises(ValueError):
        mix.validated({"a": 0.5}, "x")
    w = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.0)], "domain string, weight double")
    y = spark.createDataFrame([("a", "10"), ("b", "1"), ("c", "?")], "domain string, avg_yield string")
    got = {r.domain: r.weight for r in mix.yield_corrected(w, y).collect()}
    assert got["a"] < 0.5 < got["b"] and sum(got.values()) == pytest.approx(1)


def test_yields_with_caps(spark):
    d = spark.createDataFrame(
        [(0, "a", "x", "1234"), (1, "a", "x", "12"), (2, "b", "x", "1"), (3, "c", "x", "12345")],
        "ord long, doc_id string, domain string, text string"
    )
    assert tuple(reports.domain_yield(d).first()) == ("x", 3, 4.0)
    assert tuple(reports.domain_yield(d, most_docs=2).first()) == ("x", 2, 3.5)
    assert tuple(reports.domain_yield(d, most_lines=2).first()) == ("x", 1, 6.0)


def test_stream(spark, tmp_path):
    src, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    good = " ".join(f"word{i}" for i in range(60))
    schema = "doc_id string, text string, source string, domain string"
    for batch in ([("1", good, "s", "x"), ("2", "short", "s", "x")], [("3", good, "s", "x"), ("4", good + " more", "s", "x")]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        exact.filtered_stream(spark.readStream.schema(schema).parquet(src), out, at).awaitTermination()
    got = sorted(r.doc_id for r in spark.read.parquet(out).collect())
    assert got == ["1", "4"]


def test_drawn_cuts(spark):
    d = spark.range(2000).selectExpr("id", "sequence(1, 10) AS ids")
    a, b = pack.middle_cuts("ids", 3, "id")
    got = [tuple(r) for r in d.select(a, b).collect()]
    assert all(0 < x < y < 10 for x, y in got) and len(set(got)) == 36 and got == [tuple(r) for r in d.select(a, b).collect()]
    moved = d.select(pack.fill_in_middle("ids", a, b, 91, 92, 93).alias("x")).first().x
    assert len(moved) == 10 and moved[0] == 91 and 92 in moved
