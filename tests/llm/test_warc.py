import gzip
import hashlib
import io

import pytest

from lacuna.llm import warc

BIG = "<p>" + "é" * 100


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, record_type string, payload int")


def plain(rows, least=100):
    firsts = {}
    for i, _, h in rows:
        if i is not None:
            firsts[h or ""] = min(i, firsts.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw, first = (h or "").encode(), firsts.get(h or "")
        again = len(raw) >= least and first is not None and i != first
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/ b\r\nX: y", BIG), (3, "http://b/", BIG), (9, None, BIG), (3, "http://b/", BIG), (None, "http://n/", BIG), (None, None, BIG + "null id alone"), (4, "", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"),
    (-2, "u", "z" * 100), (-1, "u", "z" * 100), (11, "u", "z" * 99), (12, "u", "z" * 99), (20, "u", "WARC/1.1\r\n\r\n" * 40), (21, "u", "long" * 300_000), (22, "u", "long" * 300_000), (2**62, "u", "\x00\r\n\r\n" * 50),
]


@pytest.mark.parametrize(("heavy", "size"), [(1000, 1 << 27), (1, 2000)])
def test_round_trip(spark, heavy, size):
    got = warc.round_trip(pages_of(spark, ROWS).repartition(3, "page_id"), heavy=heavy, file_bytes=size)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(ROWS)
    assert warc.round_trip(pages_of(spark, ROWS).where("page_id = 1000")).collect() == []


def test_archives_are_members_that_others_can_read(spark):
    files = warc.archived(pages_of(spark, ROWS), file_bytes=4000)
    assert files.count() > 1
    records = warc.read_archives(files, with_payload=True).collect()
    assert {r.path for r in records} == {r.path for r in files.collect()} and all(r.error is None for r in records)
    by_path = {}
    for r in records:
        by_path.setdefault(r.path, []).append(r)
    for path, rows in by_path.items():
        raw = open(path.removeprefix("file://").removeprefix("file:"), "rb").read()
        places = [r.place for r in rows]
        assert places[0] == 0 and rows[0].type == "warcinfo"
        for a, b in zip(places, [*places[1:], len(raw)], strict=True):  # each record is a gzip file of its own
            assert gzip.decompress(raw[a:b]).startswith(b"WARC/1.1\r\n")
    kept = {(r.record_id, bytes(r.payload)) for r in records if r.type == "response"}
    assert (warc.record_id(3).strip("<>"), BIG.encode()) in kept and (warc.record_id(21).strip("<>"), b"long" * 300_000) in kept
    assert not [r for r in records if r.type == "revisit" and r.payload]
    assert {r.target_uri for r in records if r.record_id == "urn:page:5"} == {"http://a/%20b%0D%0AX:%20y"}


def record(**change):
    parts = {"id": 1, "url": "http://a/", "payload": b"hello world", "size": 11, "digest": hashlib.sha256(b"hello world").digest(), "kind": "response", "to": None} | change
    return warc.page_record(*parts.values())


def read(raw: bytes, want: bool = True) -> list[dict]:
    return list(warc.records_of(io.BytesIO(raw), want))


def test_damage_is_named_and_the_rest_is_read():
    good = record()
    inside = gzip.decompress(good)
    cases = {
        "the payload's digest is": record(digest=b"\x00" * 32),
        "the block's digest is": gzip.compress(inside.replace(b"hello", b"jello")),
        "bytes of the block are missing": gzip.compress(inside.replace(b"sha256", b"sha512").replace(b"Content-Length: ", b"Content-Length: 9")),
        "doesn't end where": gzip.compress(inside + b"more"),
        "isn't a length": gzip.compress(inside.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: -", 1)),
        "without a colon": gzip.compress(inside.replace(b"WARC-Date: " + warc.DATE.encode(), b"WARC-Date")),
        "not a WARC record": gzip.compress(inside.replace(b"WARC/1.1", b"HTTP/1.1")),
        "no end of the header": gzip.compress(b"WARC/1.1\r\nA: b"),
        "within": gzip.compress(b"WARC/1.1\r\n" + b"A: b\r\n" * 200_000),
    }
    for reason, bad in cases.items():
        found = read(good + bad + good)
        assert [f.get("error") is None for f in found] == [True, False, True], reason
        assert reason in found[1]["error"] and found[0]["payload"] == found[2]["payload"] == b"hello world"
    cut = read(good + good[:-9])
    assert cut[0]["payload_bytes"] == 11 and "ends within" in cut[1]["error"]
    assert "inflated" in read(good + b"\x00" * 50 + good)[1]["error"]
    assert read(b"") == []


def test_other_records_and_folded_lines():
    raw = warc.member([("WARC-Type", "metadata"), ("warc-record-id", "<urn:x>"), ("Note", "one\r\n two")], b"no http here")
    assert read(raw) == [{"place": 0, "type": "metadata", "record_id": "urn:x", "target_uri": None, "refers_to": None, "payload_bytes": 12, "payload_digest": hashlib.sha256(b"no http here").hexdigest(), "payload": b"no http here"}]


def test_damage_fails_the_query(spark, tmp_path):
    (tmp_path / "bad.warc.gz").write_bytes(record() + record(digest=b"\x00" * 32))
    files = spark.createDataFrame([(f"file://{tmp_path}/bad.warc.gz",)], "path string")
    assert [r.error is None for r in warc.read_archives(files).orderBy("place").collect()] == [True, False]
