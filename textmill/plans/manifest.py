"""Pipeline manifests: YAML to sources with weights, audits, and manifests for split files."""

from __future__ import annotations

import json
import os
import subprocess
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from textmill.operators.mix import BASE_WEIGHTS, validated
from textmill.sources import jsonl

# What the later phase of a curriculum changes in the target mix.
LATE_PHASE = {"filtered_web": 0.285, "reasoning_scaffolding": 0.015}
OUTPUTS = {"normalized_dir": "out/normalized", "dedup_dir": "out/dedup", "packed_dir": "out/packed"}


@dataclass
class Source:
    name: str
    weight: float
    type: str = "local_dir"
    params: dict = field(default_factory=dict)
    paths: list[str] = field(default_factory=list)


@dataclass
class Manifest:
    seed: int
    outputs: dict
    dedup: dict
    packing: dict
    chars_per_token: float
    weights: dict[str, float]
    sources: dict[str, dict[str, Source]]

    @property
    def source_weights(self) -> dict[str, dict[str, float]]:
        return {d: {n: s.weight for n, s in m.items()} for d, m in self.sources.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """(domain, source, weight, type, path)."""
        rows = [(d, n, s.weight, s.type, p) for d, m in self.sources.items() for n, s in m.items() for p in s.paths]
        return spark.createDataFrame(rows, "domain string, source string, weight double, type string, path string")


def _expanded(x):
    """Environment variables in strings, however deep."""
    if isinstance(x, dict):
        return {k: _expanded(v) for k, v in x.items()}
    if isinstance(x, list):
        return [_expanded(v) for v in x]
    return os.path.expandvars(x) if isinstance(x, str) else x


def parse(payload: dict) -> Manifest:
    payload = _expanded(payload)
    outputs, packing = OUTPUTS | payload.get("outputs", {}), payload.get("packing", {})
    if not payload.get("domains"):
        raise ValueError("no domains")
    weights, sources = {}, {}
    for domain, d in payload["domains"].items():
        weights[domain] = float(d.get("weight", 0))
        if not d.get("sources"):
            raise ValueError(f"no sources in {domain}")
        own = validated({n: float(s.get("weight", 0)) for n, s in d["sources"].items()}, f"sources of {domain}")
        sources[domain] = {}
        for name, s in d["sources"].items():
            params = s.get("params") or {}
            paths = params.get("paths") or s.get("paths") or [f"{outputs['normalized_dir']}/{domain}/{name}/*.jsonl.zst"]
            sources[domain][name] = Source(
                name, own[name], s.get("type", "local_dir"), params, [paths] if isinstance(paths, str) else list(paths)
            )
    chars = float(payload.get("chars_per_token", packing.get("chars_per_token", 4.0)))
    return Manifest(int(payload.get("seed", 0)), outputs, payload.get("dedup", {}), packing, chars, validated(weights, "domains"), sources)


def load(path: str) -> Manifest:
    try:
        import yaml
    except ImportError:
        yaml = None
    with open(path) as f:
        return parse(yaml.safe_load(f) if yaml else json.load(f))


def split_manifest(split_dir: str, weights: dict[str, float] = BASE_WEIGHTS, tokenizer: str = "${TOKENIZER_JSON}", seed: int = 1234) -> str:
    """A manifest, as JSON, which is YAML too, with one split file per domain."""
    total = sum(weights.values())
    domains = {
        d: {
            "weight": w / total,
            "sources": {"split": {"weight": 1.0, "type": "local_dir", "params": {"paths": [f"{split_dir}/{d}.jsonl.zst"]}}}
        }
        for d, w in weights.items()
    }
    outputs = {k: v.replace("out/", "data/") for k, v in OUTPUTS.items()} | {"raw_dir": "data/raw"}
    dedup = {"mode": "exact", "scope": "per-source", "simhash_threshold": 3, "hash_bits": 64}
    return json.dumps(
        {
            "seed": seed, "chars_per_token": 4.0, "outputs": outputs, "dedup": dedup,
            "packing": {"seq_len": 4096, "tokenizer_path": tokenizer}, "domains": domains
        },
        indent=2
    )


def phase(m: Manifest, weights: dict[str, float] = LATE_PHASE, sources: dict[str, dict[str, Source]] | None = None) -> Manifest:
    """A phase of a curriculum: the manifest with the weights of some domains changed. A domain that is new brings its sources."""
    every = m.sources | (sources or {})
    if missing := sorted(set(weights) - set(every)):
        raise ValueError(f"no sources in {missing}")
    for d, members in (sources or {}).items():
        validated({n: s.weight for n, s in members.items()}, f"sources of {d}")
    return replace(m, weights=validated(m.weights | weights, "domains"), sources=every)


def audit(m: Manifest, root: str | None = None) -> dict:
    """Per local source of positive weight: files, bytes, first paths, a probe of each file's first line; what is missing, a placeholder or broken."""
    report = {"sources": [], "missing": [], "placeholders": [], "probe_errors": [], "skipped_too_long": []}
    for domain, members in m.sources.items():
        for name, s in members.items():
            if m.weights[domain] <= 0 or s.weight <= 0 or s.type not in ("local_dir", "local_jsonl"):
                continue
            files = jsonl.under_root(s.paths, root)
            report["sources"].append(
                {"domain": domain, "source": name, "n_files": len(files), "bytes": sum(map(os.path.getsize, files)), "first": files[:3]}
            )
            if not files:
                report["missing"].append({"domain": domain, "source": name, "paths": s.paths})
            for f in files[:1]:
                state, line = jsonl.first_line(f)
                if state == "too_long":
                    report["skipped_too_long"].append(f)
                    continue
                try:
                    doc = json.loads(line) if state == "ok" else {}
                    at = "license_tag" if doc.get("license_tag") == "placeholder" else "meta.note" if (doc.get("meta") or {}).get("note") == "placeholder" else "text" if "placeholder" in (doc.get("text") or "") else None
                    if at:
                        report["placeholders"].append({"file": f, "where": at})
                except (ValueError, AttributeError) as e:
                    report["probe_errors"].append({"file": f, "error": str(e)})
    return report


def check(report: dict) -> None:
    """Raises for the first kind of fault there is: missing files, then placeholders, then probe errors."""
    for kind in ("missing", "placeholders", "probe_errors"):
        if report[kind]:
            raise ValueError(f"{kind}: {report[kind]}")


def code_state(folder: str | None = None) -> dict:
    """The commit of the code in a folder, by default this package's, and whether files differ from it; both null without git."""
    git = ["git", "-C", folder or os.path.dirname(os.path.abspath(__file__))]
    try:
        commit, changed = (
            subprocess.run([*git, *c], capture_output=True, text=True, check=True, timeout=30).stdout.strip()
            for c in (["rev-parse", "HEAD"], ["status", "--porcelain"])
        )
    except (OSError, subprocess.SubprocessError):
        return {"commit": None, "changed": None}
    return {"commit": commit, "changed": bool(changed)}


def run_info(m: Manifest, **more) -> dict:
    """What a run was made from: a hash of its manifest, the state of the code, and whatever else is given."""
    from textmill.functions.text import params_hash

    return {
        "manifest_sha256": params_hash({"seed": m.seed, "weights": m.weights, "sources": m.source_weights, "packing": m.packing}),
        "code": code_state(), **more
    }
