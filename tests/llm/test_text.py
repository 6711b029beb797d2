import random
import re

import numpy as np
import pyarrow as pa

from textmill.llm._text import Words, inside, pack, pack_sorted, slices, texts, unpack, unpack_sorted, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts():
    rng = random.Random(0)
    return ["".join(rng.choice("ab \n\té ß") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["", None, " ", "x"]


def test_words_and_windows():
    t = _texts()
    data, off = texts(pa.array(t))
    hashes = {}
    for a, b in slices(off, 500):
        w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
        h = w.hashes()
        at = inside(w.first, 3)
        win = dict(zip(at.tolist(), windows(h, 3)[at].tolist())) if len(at) else {}
        for i in range(b - a):
            words = WORD.findall(t[a + i] or "")
            mine = [
                w.data[x:y].tobytes().decode() for x, y in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]])
            ]
            assert mine == words
            for k in range(len(words) - 2):
                key, value = tuple(words[k : k + 3]), win[int(w.first[i]) + k]
                assert hashes.setdefault(key, value) == value
    assert len(set(hashes.values())) == len(hashes)


def test_packing_of_numbers():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(0, 2**63, 1000).astype(np.uint64))
    assert (unpack_sorted(pack_sorted(a)) == a).all() and (unpack(pack(a[:0]), np.uint64) == a[:0]).all()


def test_sliced_column():
    data, off = texts(pa.array(["aa", "b", None, "ccc"]).slice(1))
    assert data.tobytes() == b"bccc" and off.tolist() == [0, 1, 1, 4]
