import collections
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from textmill.llm import language_id, near_dedup, packing

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_run(spark):
    """All that run() returns, against its stages one by one: languages and near copies by their operators, which have
    tests of their own, the rest in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = language_id.keep(docs, language_id.fit(docs.where(language_id.remainder(4) != 2))).collect()
    last = {}
    for r in sorted(known, key=lambda r: r.doc_id):
        last[r.text] = r
    alone = near_dedup.dedup(spark.createDataFrame(list(last.values()), docs.schema), spread=near_dedup.NARROW).collect()
    seen, text = set(), {}
    for r in sorted(alone, key=lambda r: r.doc_id):
        w, gone = WORD.findall(r.text), set()
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            if key in seen:
                gone |= set(range(i, i + 20))
            seen.add(key)
        if len(gone) < len(w) or not gone:
            text[r.doc_id] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r.text
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, x in text.items():
        ids = [*t.encode(x, add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), packing.SEQ_LEN)):
            part = np.array(ids[at : at + packing.SEQ_LEN], "<u4")
            want.add((i, k, at, len(part), zlib.crc32(part.tobytes())))
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(got) == len(want) and {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want
    rows = collections.defaultdict(list)
    for r in got:
        rows[r.sequence_id].append((r.offset, r.length))
    for pieces in rows.values():
        ends = [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= packing.SEQ_LEN
