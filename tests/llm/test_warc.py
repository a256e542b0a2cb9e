"""WARC round trips, byte ranges, and magic bytes inside members."""

import gzip
import hashlib
import io
import random
import zlib

import pytest

from salesabc.llm import warc


def pages(seed=1):
    r = random.Random(seed)
    rows = [(i, f"http://h/{i}", "".join(r.choices("ab<>é \n", k=r.choice([0, 10, 998, 1000, 5000])))) for i in range(60)]
    big = "é" * 500
    rows += [(100, "u", big), (101, "u", big), (102, "u", big), (103, "u", "y" * 999), (104, "u", "y" * 999), (105, None, None), (106, "a\r\nWARC-Type: x", ""), (107, "u", big), (107, "u", big), (None, "u", big)]
    rows += [(108, "u", "\x1f\x08 text" * 300), (109, "u", "z" * 300_000)]
    return rows


def brute(rows):
    keep = {}
    for key, _, html in rows:
        b = (html or "").encode()
        if len(b) >= 1000 and key is not None:
            keep[b] = max(keep.get(b, key), key)
    out = []
    for key, _, html in rows:
        b = (html or "").encode()
        to = keep.get(b)
        to = None if to == key else to
        out.append((key, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [1 << 20, 700, 5000])
def test_round_trip(spark, split):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").selectExpr("*", "'clash' AS payload", "'clash' AS key", "'clash' AS uri")
    got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in warc.round_trip(df.repartition(3, "page_id"), split_bytes=split).collect()]
    assert sorted(got, key=str) == brute(pages())


def test_nothing(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(df).count() == 0


def test_archives_are_standard_gzip(spark, tmp_path):
    df = spark.createDataFrame(pages()[:5], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_warc(df, str(tmp_path)).collect()
    assert sum(m["records"] for m in manifest) == 5
    text = b"".join(gzip.open(m["path"]).read() for m in manifest)
    assert text.count(b"WARC/1.1\r\n") == 5
    listed = warc.list_archives(spark, str(tmp_path))
    assert {r["bytes"] for r in listed.collect()} == {m["bytes"] for m in manifest}
    assert warc.read_warc(listed).count() == 5


def stored(payload):
    """A member whose block is stored without compression, so its bytes appear as they are."""
    plain = warc.record(1, "u", payload)
    data = zlib.decompress(plain, 31)
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def test_every_split_owns_each_record_once():
    inner = warc.record(99, "inner", b"not a record of this file")
    noise = bytes(random.Random(2).choices(b"\x1f\x8b\x08\x00ab", k=4000))
    members = [warc.record(0, "u", b"x" * 10), stored(b"a" + inner + b"b" + inner[:40]), stored(noise), warc.record(3, "u", b""), stored(b"\x1f\x8b\x08" * 50), warc.record(5, "u", b"q" * 5000)]
    data = b"".join(members)
    starts, at = [], 0
    for m in members:
        starts.append(at)
        at += len(m)
    for step in (37, 100, 999, len(data)):
        got = [p for lo in range(0, len(data), step) for p, *_ in warc.records_in(io.BytesIO(data), len(data), lo, min(len(data), lo + step))]
        assert got == starts


def test_damage_is_an_error():
    data = warc.record(0, "u", b"x" * 3000) + warc.record(1, "u", b"y" * 3000)
    with pytest.raises((zlib.error, ValueError)):
        list(warc.records_in(io.BytesIO(data[:-5]), len(data) - 5, 0, len(data) - 5))


def test_no_damaged_record_is_lost_silently(spark):
    """Two bytes changed in each record in turn, at its start, inside and at its end, read in ranges of several sizes."""
    r = random.Random(8)
    members = [warc.record(i, f"http://h/{i}", "".join(r.choices("abcdef <>", k=r.choice([5, 400, 3000, 9000]))).encode()) for i in range(40)]
    whole = b"".join(members)
    index, files, raised = [], [], 0
    starts = [sum(map(len, members[:i])) for i in range(40)]
    for split in (600, 5000, 1 << 20):
        cases = [("whole", whole)]
        for i, m in enumerate(members):
            for place in (0, 3, len(m) // 2, len(m) - 6):
                data = bytearray(whole)
                data[starts[i] + place] ^= 0xFF
                data[starts[i] + place + 1] ^= 0xFF
                cases.append((f"{i}-{place}", bytes(data)))
        for name, data in cases:
            path = f"{split}-{name}"
            try:
                found = [(path, p, q) for lo in range(0, len(data), split) for p, q, *_ in warc.records_in(io.BytesIO(data), len(data), lo, min(len(data), lo + split))]
            except (zlib.error, ValueError, KeyError):
                raised += 1
                continue
            index += [(*x, split) for x in found]
            files.append((path, len(data), 40, split))
    bad = set()
    for split in (600, 5000, 1 << 20):
        rows = spark.createDataFrame([x[:3] for x in index if x[3] == split], "path string, offset long, stop long")
        given = spark.createDataFrame([x[:3] for x in files if x[3] == split], "path string, bytes long, records long")
        bad |= {x["path"] for x in warc.damaged_files(rows, given, split).collect()}
        assert {x["path"] for x in warc.damaged_files(rows, given.drop("records"), split).collect()} <= bad
    assert bad == {f[0] for f in files} - {f"{s}-whole" for s in (600, 5000, 1 << 20)}
    assert raised > 0 and len(bad) > 0


def test_a_file_without_records_is_damaged(spark):
    index = spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("b", 0, 10), ("c", 0, 10), ("c", 12, 20)], "path string, offset long, stop long")
    files = spark.createDataFrame([("a", 20, 2), ("b", 10, 2), ("c", 20, 2), ("d", 5, 0), ("e", 0, 0)], "path string, bytes long, records long")
    assert {r["path"] for r in warc.damaged_files(index, files, 8).collect()} == {"b", "c", "d"}
    with pytest.raises(ValueError, match="damaged"):
        warc.require_whole(index, files, 8)


def test_query_over_pages(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in QUERIES["op2_warc"](spark, sf).collect()]
    assert sorted(got, key=str) == brute(rows)
