import json
import subprocess

import pytest
import zstandard

from textmill.operators import pack, reports
from textmill.plans import manifest, pipeline
from textmill.sources import files, jsonl


def test_mix_report_and_ingest(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"text": "x" * n}) + "\n" for n in (3, 5)))
    (tmp_path / "b.jsonl.zst").write_bytes(zstandard.compress(b""))
    m = manifest.parse(
        {
            "domains": {
                "one": {"weight": 0.5, "sources": {"a": {"weight": 1, "params": {"paths": "a.jsonl"}}}},
                "two": {
                    "weight": 0.5,
                    "sources": {
                        "b": {"weight": 0.5, "params": {"paths": "b.jsonl.zst"}}, "open-web-math": {"weight": 0.5, "type": "hf_stream"}
                    }
                }
            }
        }
    )
    rows = spark.createDataFrame([(0, "12345678", "s")], "ord long, text string, source string")
    r = pipeline.mix_report(spark, m, str(tmp_path), samples=lambda p: rows)
    assert r["sources"]["one/a"]["n_docs"] == 2 and r["sources"]["two/b"]["n_docs"] == 0 and len(r["empty_files"]) == 1
    assert r["domain_shares"]["one"]["share_chars"] == 1 and r["domain_shares_with_samples"]["two"]["share_chars"] == 0.5
    (domain, source, d), = pipeline.ingest(m, lambda p: rows)
    assert (domain, source, d.first().meta) == ("two", "open-web-math", {"source": "s"})


def test_tokenizer_corpus(spark):
    docs = spark.createDataFrame(
        [(i, "é" * 50, d) for i, d in enumerate(["web", "books_x", "wiki", "forums_qa", "code", "math", "tutorials", "paper"])],
        "ord long, text string, domain string"
    )
    got = {r.domain: r.bytes_used for r in pipeline.tokenizer_corpus(docs, 1000).collect()}
    assert got["filtered_web"] == 101 and got["tutorials_notebooks"] == 20
    twice = pipeline.tokenizer_corpus(docs, 1000, passes=2).groupBy("domain").sum("bytes_used").collect()
    assert {r[0]: r[1] for r in twice}["filtered_web"] == 202
    with pytest.raises(ValueError):
        pipeline.tokenizer_corpus(docs.limit(1), 1000)
    numbers = pipeline.tokenizer_corpus(docs, 1000, allow_missing=True, n_numbers=24, seed=1).where("domain = 'numbers'").collect()
    assert len({r.text for r in numbers}) == 24 and all(r.text.endswith("\n") and r.bytes_used == len(r.text.encode()) for r in numbers)


def test_normalise_to_pack(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"</s>": 0, "word": 1}, unk_token="word"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(str(tmp_path / "t.json"))
    records = spark.createDataFrame(
        [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(5)] + [(5, "short")], "ord long, text string"
    )
    kept, counts, drops = pipeline.normalise(records, "d", "s", shard_size=2)
    assert [r.docs for r in counts.orderBy("shard_id").collect()] == [2, 2, 1] and drops.first().drop_reason == "too_short"
    rows = pipeline.packed(kept, pack.Tokenizer(str(tmp_path / "t.json")), {"d": 1.0}, {"d": {"s": 1.0}}, 435, seq_len=64)
    assert rows.count() == 5 and all(len(r.input_ids) == 64 for r in rows.collect())


def test_phase_of_a_curriculum():
    m = manifest.parse(json.loads(manifest.split_manifest("splits")))
    new = {"reasoning_scaffolding": {"split": manifest.Source("split", 1.0, paths=["r.jsonl"])}}
    late = manifest.phase(m, sources=new)
    assert abs(late.weights["filtered_web"] - 0.285) < 1e-12 and abs(sum(late.weights.values()) - 1) < 1e-12
    assert late.source_weights["reasoning_scaffolding"] == {"split": 1.0} and "reasoning_scaffolding" not in m.weights
    with pytest.raises(ValueError):
        manifest.phase(m)  # a domain without sources
    with pytest.raises(ValueError):
        manifest.phase(m, {"math": 0.5})  # weights that do not sum to 1
    with pytest.raises(ValueError):
        manifest.phase(m, sources={"reasoning_scaffolding": {"split": manifest.Source("split", 0.5)}})


def test_run_info_as_a_report(tmp_path):
    m = manifest.parse(json.loads(manifest.split_manifest("splits")))
    info = manifest.run_info(m, seed=m.seed)
    reports.write_json(info, str(tmp_path / "out" / "run.json"))
    assert json.loads((tmp_path / "out" / "run.json").read_text()) == info and [
        p.name for p in (tmp_path / "out").iterdir()
    ] == ["run.json"]
    assert info["manifest_sha256"] != manifest.run_info(manifest.phase(m, {"math": 0.10, "reference": 0.10}))["manifest_sha256"]
    assert manifest.code_state(str(tmp_path)) == {"commit": None, "changed": None}
    run = lambda *c: subprocess.run(
        ["git", "-C", str(tmp_path), "-c", "user.name=a", "-c", "user.email=a@b", *c], check=True, capture_output=True
    )
    run("init")
    run("commit", "--allow-empty", "-m", "x")
    state = manifest.code_state(str(tmp_path))
    assert len(state["commit"]) == 40 and state["changed"]  # the report is not committed
    with pytest.raises(TypeError), files.Written(str(tmp_path / "broken.json")) as f:
        f.write(None)
    assert not (tmp_path / "broken.json").exists()


def test_data_root(tmp_path):
    for n in ("b.jsonl", "a.jsonl"):
        (tmp_path / n).write_text("")
    assert jsonl.under_root(["*.jsonl", str(tmp_path / "a.jsonl")], str(tmp_path)) == [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]
