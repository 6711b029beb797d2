import json

import pytest
import zstandard

from textmill.operators import reports
from textmill.plans import manifest
from textmill.sources import dumps, files, hub, jsonl, packs


def lines(path, rows, frames=1):
    body = [b"".join(json.dumps(r).encode() + b"\n" for r in rows[i::frames]) for i in range(frames)]
    path.write_bytes(b"".join(zstandard.compress(b) for b in body) if str(path).endswith(".zst") else b"".join(body))


def test_jsonl_order_and_repair(spark, tmp_path):
    lines(tmp_path / "a.jsonl.zst", [{"doc_id": "1", "text": "x"}, {"doc_id": "2", "text": "y"}])
    lines(tmp_path / "b.jsonl", [{"doc_id": "3", "text": "z"}])
    (tmp_path / "b.jsonl.manifest.json").write_text("{}")
    (tmp_path / "e.jsonl.zst").write_bytes(b"")
    found = jsonl.dedup_inputs([str(tmp_path)], str(tmp_path / "out"))
    assert [f.split("/")[-1] for f in found] == ["a.jsonl.zst", "b.jsonl", "e.jsonl.zst"]
    d = jsonl.read(spark, found, "doc_id string, text string")
    assert [r.doc_id for r in d.orderBy("ord").collect()] == ["1", "2", "3"]
    assert jsonl.first_line(found[0])[0] == "ok" and jsonl.first_line(found[2])[0] == "empty" and jsonl.first_line(found[0], 3)[0] == "too_long"
    raw = b'{"a": "one\\ntwo"}\n{"a": "raw\nbreak"}\r\n{"a": 3}\nbad\n{"b": "q\\"\r"}'
    good, bad = jsonl.repaired(raw)
    assert [json.loads(g) for g in good] == [{"a": "one\ntwo"}, {"a": "raw\nbreak"}, {"a": 3}, {"b": 'q"\r'}] and bad == 1
    with pytest.raises(jsonl.RepairError):
        jsonl.repaired(raw, most_bad=0)
    (tmp_path / "r.jsonl.zst").write_bytes(zstandard.compress(raw))
    r = jsonl.repair(spark, [str(tmp_path / "r.jsonl.zst")]).first()
    assert (r.records_ok, r.records_bad) == (4, 1) and (tmp_path / "r.jsonl.zst.bak").exists()


def test_order_over_splits(spark, tmp_path):
    for name in ("a", "b"):
        lines(tmp_path / f"{name}.jsonl", [{"doc_id": f"{name}{i:04d}", "text": "x" * (i % 50)} for i in range(2000)])
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = jsonl.read(spark, jsonl.walk(str(tmp_path)), "doc_id string, text string").orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert [r.doc_id for r in got] == [f"{n}{i:04d}" for n in "ab" for i in range(2000)]


def test_shards_and_split(spark, tmp_path):
    d = spark.createDataFrame(
        [(i, str(i), "text", "s", "dom" if i % 2 else None) for i in range(7)],
        "ord long, doc_id string, text string, source string, domain string"
    )
    shards = reports.sharded(d, 3)
    got = jsonl.write_shards(shards, str(tmp_path / "out")).orderBy("shard_id").collect()
    assert [r.docs for r in got] == [3, 3, 1]
    jsonl.write_manifests(
        reports.shard_manifest(shards), shards.selectExpr("shard_id", "'x' AS drop_reason", "1L AS n").limit(0), str(tmp_path / "out"), "d",
        "s"
    )
    assert json.loads((tmp_path / "out/shard_00000.jsonl.manifest.json").read_text())["counts"]["docs"] == 3
    back = jsonl.read(spark, [r.path for r in got], "doc_id string, domain string")
    assert [r.doc_id for r in back.orderBy("ord").collect()] == [str(i) for i in range(7)]
    text = spark.createDataFrame([('{"domain": "a/b"}',), ('{"x": 1}',), ("{bad",), ("",)], "value string")
    assert {r.domain_safe for r in jsonl.split_by_domain(text, str(tmp_path / "split")).collect()} == {"a_b", "unknown"}
    assert [tuple(r) for r in jsonl.bad_lines(text).collect()] == [(3, 1)] and [
        tuple(r) for r in jsonl.bad_lines(text, fast=True).collect()
    ] == [(3, 2)]
    stats = jsonl.file_stats(spark, spark.createDataFrame([("s", "d", got[0].path)], "source string, domain string, file string")).first()
    assert (stats.n_docs, stats.total_chars, stats.n_bad) == (3, 12, 0)


def test_dumps(spark, tmp_path):
    (tmp_path / "Posts.xml").write_text('<posts><row Id="1" PostTypeId="1" Title="T" Body="&lt;p&gt;q&lt;/p&gt;" Score="1" /></posts>')
    r = dumps.posts(spark, dumps.posts_path(str(tmp_path))).first()
    assert (r.Id, r.Body) == ("1", "<p>q</p>")
    (tmp_path / "bad.xml").write_text('<posts><row Id="1" Body="<p>q</p>" /><row Id="2" ParentId="1" Body="a > b" /><row></posts>')
    assert [
        (r.Id, r.Body, r.ord) for r in dumps.posts_broken(spark, str(tmp_path / "bad.xml")).collect()
    ] == [("1", "<p>q</p>", 0), ("2", "a > b", 1)]
    assert [r.Body for r in dumps.posts(spark, str(tmp_path / "bad.xml")).orderBy("ord").collect()] == ["<p>q</p>", "a > b"]
    with pytest.raises(ValueError):
        dumps.posts_path("x.txt")
    (tmp_path / "w.xml").write_text(
        "<mediawiki><page><title>A</title><ns>0</ns><id>5</id><revision><timestamp>t</timestamp><text>[[x|y]] {{z}}</text></revision></page><page><title>B</title><ns>1</ns><id>6</id></page></mediawiki>"
    )
    from textmill.operators.transforms import wiki_dump

    assert [tuple(r) for r in wiki_dump(dumps.wiki_pages(spark, str(tmp_path / "w.xml"))).collect()] == [("5", "A", "t", "y")]
    (tmp_path / "wiki").mkdir()
    (tmp_path / "wiki" / "f").write_text('{"id": "1", "title": "A", "text": "b"}\n\nnot json\n')
    assert [r.title for r in dumps.wiki_articles(spark, str(tmp_path / "wiki")).collect()] == ["A"]


def test_hub(spark):
    assert hub.resolved("open-web-math", {})["domain"] == "math" and hub.resolved(
        "fineweb2", {"config_name": "deu_Latn"}
    )["config_name"] == "deu_Latn"
    with pytest.raises(ValueError):
        hub.resolved("nothing", {})
    assert hub.split_of(lambda s: s, ["validation", "test"]) == "test"
    c = spark.createDataFrame([(x,) for x in ("asm_Beng", "fra_Latn", "eng_Latn", "eng_Cyrl")], "config string")
    assert [
        hub.matching_configs(c, **k).count() for k in ({"lang": "eng"}, {"lang": "eng", "script": "Latn"}, {"contains": "ENG"}, {})
    ] == [2, 1, 3, 4]
    rows = spark.createDataFrame([(0, None, "a", "u"), (1, "7", "b", None)], "ord long, id string, text string, url string")
    got = {r.text: r for r in hub.documents(rows, "s", "d", meta_fields=["url", "none"]).collect()}
    assert got["a"].meta == {"url": "u"} and len(got["a"].doc_id) == 16 and got["b"].meta is None and got["b"].doc_id == "7"


def test_manifest(tmp_path):
    lines(tmp_path / "f.jsonl", [{"text": "x", "meta": None}])
    body = json.loads(manifest.split_manifest("split"))
    m = manifest.parse(body)
    assert sum(m.weights.values()) == pytest.approx(1) and m.sources["math"]["split"].paths == ["split/math.jsonl.zst"]
    one = lambda **p: manifest.parse({"domains": {"d": {"weight": 1, "sources": {"s": {"weight": 1, "params": p}}}}})
    manifest.check(manifest.audit(one(paths="f.jsonl"), str(tmp_path)))
    with pytest.raises(ValueError, match="missing"):
        manifest.check(manifest.audit(one(paths="none.jsonl"), str(tmp_path)))
    lines(tmp_path / "p.jsonl", [{"text": "x", "license_tag": "placeholder"}])
    with pytest.raises(ValueError, match="placeholders"):
        manifest.check(manifest.audit(one(paths="p.jsonl"), str(tmp_path)))
    (tmp_path / "b.jsonl").write_text("{not-json}\n")
    with pytest.raises(ValueError, match="probe_errors"):
        manifest.check(manifest.audit(one(paths="b.jsonl"), str(tmp_path)))
    with pytest.raises(ValueError):
        manifest.parse({"domains": {}})
    assert one().sources["d"]["s"].paths == ["out/normalized/d/s/*.jsonl.zst"]


def test_pack_files(spark, tmp_path):
    rows = spark.createDataFrame(
        [(0, [1, 2], [("a", 0, 2)], "x", "s"), (1, [3, 4], [("a", 2, 3), ("b", 0, 1)], "y", "s")],
        "row long, input_ids array<int>, segments array<struct<doc_id:string,start:int,end:int>>, domain string, source string"
    )
    assert packs.export(rows, str(tmp_path / "p"), 2)["num_seqs"] == 2
    assert [
        (r.row, r.input_ids, r.domain) for r in packs.read(spark, str(tmp_path / "p")).orderBy("row").collect()
    ] == [(0, [1, 2], "x"), (1, [3, 4], "y")]


def test_files(tmp_path):
    path = f"file:{tmp_path}/deep/a.jsonl.zst"
    assert jsonl.write_zst([b"1", b"2"], path) == 2 and jsonl.first_line(path) == ("ok", "1\n")
    files.move(path, f"file://{tmp_path}/b.jsonl.zst")
    assert jsonl.first_line(str(tmp_path / "b.jsonl.zst")) == ("ok", "1\n")
    with pytest.raises(ZeroDivisionError):
        jsonl.write_zst((1 // 0 for _ in "x"), str(tmp_path / "c.zst"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["b.jsonl.zst", "deep"]
    with pytest.raises(ValueError):
        files.local("s3://bucket/x")


def test_jsonl_by_uri(spark, tmp_path):
    """Files may be named by URIs, as in a checkpoint folder that has one."""
    jsonl.write_zst([b'{"a": 1}', b'{"a": 2}'], str(tmp_path / "x.jsonl.zst"))
    for path in (f"file://{tmp_path}/x.jsonl.zst", f"file:{tmp_path}/x.jsonl.zst", f"{tmp_path}/x.jsonl.zst"):
        assert [r.a for r in jsonl.read(spark, [path], "a long").orderBy("ord").collect()] == [1, 2]


def test_shards_judge_documents_once(spark, monkeypatch):
    """Shards and manifests are made of a written table of the documents that pass."""
    from textmill import catalogue

    seen = []
    monkeypatch.setattr(catalogue.reports, "sharded", lambda d, n, f=catalogue.reports.sharded: (seen.append(d), f(d, n))[1])
    got = catalogue.jsonl_manifests(spark, "/root/testdata/sf0.001").collect()
    assert len(seen) == 2 and not any("documents.parquet" in f for d in seen for f in d.inputFiles())
    assert sum(r.docs for r in got) == catalogue.filters.kept(catalogue.docs(spark, "/root/testdata/sf0.001")).count()
