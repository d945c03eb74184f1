import random

import pytest

from rigprep.llm import warc

SCHEMA = "page_id long, url string, html string"
ROWS = [(3, "http://a/1", "same"), (1, "http://a/2\r\nX: y", "same"), (2, None, None), (4, "u", ""), (5, "http://b", "é" * 4000), (5, "http://b", "other"), (None, "n", "same"), (6, "http://c", "WARC/1.1\r\n\r\n\x1f")]


@pytest.mark.parametrize("extra", [False, True])
def test_round_trip(spark, extra):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    if extra:
        pages = pages.withColumns({c: pages.page_id.cast("string") for c in ("sha1", "first", "revisit", "path", "records", "payload")})
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str)
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        b, f = (h or "").encode(), first[h or ""]
        want.append((i, len(b), warc.sha1_base32(b), "response" if i == f else "revisit", None if i == f else f))
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive(n, plain=False):
    records = [warc.build_record(i, f"http://h/{i}", b"page %d " % i * 50, warc.sha1_base32(b"page %d " % i * 50)) for i in range(n)]
    return [r if plain else warc.member(r) for r in records]


@pytest.mark.parametrize("plain", [False, True])
def test_salvage_recovers_every_undamaged_record(plain):
    r = random.Random(1)
    for _ in range(40):
        parts = archive(12, plain)
        hurt = set(r.sample(range(12), 3))
        for k in hurt:
            p = bytearray(parts[k])
            how = r.choice(["flip", "cut", "junk"])
            if how == "flip":
                at = r.randrange(len(p) // 2, len(p) - 8)
                p[at] ^= 0x5A
            elif how == "cut":
                del p[r.randrange(5, len(p)) :]
            else:
                p[:0] = bytes(r.randrange(256) for _ in range(20))
            parts[k] = bytes(p)
        data = b"".join(parts)
        got = list(warc.salvage(data))
        seen = {int(h["x-page-id"]) for kind, _, _, h, _ in got if kind == "record"}
        assert set(range(12)) - hurt <= seen
        assert sum(n for _, _, n, _, _ in got) == len(data)  # gaps and records cover the file
        assert any(kind == "gap" for kind, *_ in got)


def test_intact_and_empty_archives():
    assert [k for k, *_ in warc.salvage(b"".join(archive(5)))] == ["record"] * 5
    assert list(warc.salvage(b"")) == []
    assert [k for k, *_ in warc.salvage(b"no archive at all")] == ["gap"]


def several(n=5):
    return [warc.build_record(i, f"http://h/{i}", f"<p>page {i}</p>".encode() * 40, warc.sha1_base32(f"<p>page {i}</p>".encode() * 40)) for i in range(n)]


def test_good_records_of_a_damaged_member_come_back():
    records = several()
    hurt = records[2].replace(b"page 2", b"page X", 1)
    whole = warc.member(b"".join([*records[:2], hurt, *records[3:]])) + warc.member(records[0])
    found = list(warc.salvage(whole))
    assert [h["x-page-id"] for kind, *_, h, _ in found if kind == "record"] == ["0", "1", "3", "4", "0"]
    assert sum(kind == "gap" for kind, *_ in found) == 1
    cut = warc.member(b"".join(records))[:-20]
    kinds = [kind for kind, *_ in warc.salvage(cut)]
    assert kinds.count("record") >= 4 and kinds.count("gap") == 1
    bits = bytearray(warc.member(b"".join(several(400))))
    bits[len(bits) // 2] ^= 0xFF
    assert sum(kind == "record" for kind, *_ in warc.salvage(bytes(bits))) >= 150


def test_reading_takes_time_in_proportion():
    import time

    took = []
    for n in (2000, 8000):
        data = b"".join(map(warc.member, several(n)))
        began = time.process_time()
        assert sum(kind == "record" for kind, *_ in warc.salvage(data)) == n
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]


def test_lost_bytes_are_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://a/{k}", f"<p>{k}</p>" * 50) for k in range(20)], "page_id long, url string, html string")
    made = warc.write_archives(pages).first()
    whole = made.path
    assert warc.described(warc.read_archives(spark.createDataFrame([(whole,)], "path string")), "long").count() == made.records
    data = open(whole.removeprefix("file://"), "rb").read()
    (tmp_path / "cut.warc.gz").write_bytes(data[:-20])
    for bad in ("cut.warc.gz", "missing.warc.gz"):
        with pytest.raises(Exception, match="gap in|missing.warc.gz"):
            warc.described(warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/{bad}",)], "path string"), with_payload=False), "long").collect()
