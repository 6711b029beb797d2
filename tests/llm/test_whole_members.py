import gzip

from test_files import gz, rec

from textmill.llm import warc


def ids(raw):
    return [h["warc-record-id"][10:-1] for _, _, h, _, _ in warc.salvage(raw) if h]


def test_one_bad_record_of_a_member():
    bad = rec(3).replace(b"<p>3", b"<p>4")
    raw = gz(rec(0) + rec(1) + b"junk" + rec(2) + bad + rec(4))
    assert ids(raw) == ["0", "1", "2", "4"]
    assert [r[4] for r in warc.salvage(raw) if r[4]] == [
        f"no version line, at {2 * len(rec(0))} to {2 * len(rec(0)) + 4} of the member",
        f"payload digest differs, at {3 * len(rec(0)) + 4} to {4 * len(rec(0)) + 4} of the member"
    ]


def test_damaged_end_of_a_member():
    raw = gzip.compress(b"".join(map(rec, range(200))), 1)
    cut = ids(raw[: len(raw) * 3 // 4])
    assert cut == [str(i) for i in range(len(cut))] and len(cut) > 100
    crc = raw[:-8] + b"\x00" * 8
    assert ids(crc) == [str(i) for i in range(200)]
    assert ids(raw[: len(raw) // 2] + gz(rec(900)) + rec(901))[-2:] == ["900", "901"]


def test_many_damaged_members():
    raw = b"".join((gz(rec(2 * i) + rec(2 * i + 1)))[:-8] + b"\x00" * 8 for i in range(1200))
    assert ids(raw) == [str(i) for i in range(2400)]
