import os
import shutil

import pytest
from textmill.plans import dedup_run


def test_resume(spark, tmp_path):
    """A run that was cut off after its decisions, with a half-written table, ends as one that was not."""
    rows = [(i, f"d{i}", t, "s", "x") for i, t in enumerate(["one text", "one  text", None, "", "another", "one text"])]
    d = spark.createDataFrame(rows, "ord long, doc_id string, text string, source string, domain string")
    whole, cut = str(tmp_path / "whole"), str(tmp_path / "cut")
    want = [sorted(map(tuple, t.collect()), key=str) for t in dedup_run.run(d, whole, ["a"], mode="exact", scope="global")]
    assert [r[1] for r in want[1]] == ["d0", "d2", "d4"] and sum(r[-1] for r in want[2]) == 6
    dedup_run.run(d, cut, ["a"], mode="exact", scope="global")
    shutil.rmtree(f"{cut}/kept")
    shutil.rmtree(f"{cut}/stats")
    os.mkdir(f"{cut}/open-kept-1")
    written = os.path.getmtime(f"{cut}/decisions/_SUCCESS")
    with pytest.raises(FileExistsError):
        dedup_run.run(d, cut, ["a"], mode="exact", scope="global")
    with pytest.raises(ValueError):
        dedup_run.run(d, cut, ["a"], resume=True, mode="exact", scope="per-source")
    got = [sorted(map(tuple, t.collect()), key=str) for t in dedup_run.run(d, cut, ["a"], resume=True, mode="exact", scope="global")]
    assert got == want and os.path.getmtime(f"{cut}/decisions/_SUCCESS") == written
    assert not any(n.startswith("open-") for n in os.listdir(cut))
