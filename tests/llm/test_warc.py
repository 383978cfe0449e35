import hashlib

import pytest

from boxlake.llm import warc
from boxlake.llm.common import scratch_dir

PAGES = "page_id bigint, url string, html string, payload string, sha256 string, k string, n string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PAGES)


BIG, SMALL = "<p>größe\r\n\r\n</p>" * 100, "<p>x</p>"
ROWS = [(1, "http://a", BIG), (2, "http://b\r\nEvil: 1", BIG), (2, "http://b2", BIG), (3, None, SMALL), (4, "u", SMALL), (5, "u", None), (6, "u", ""), (None, "u", BIG), (7, "u", BIG + "!"), (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "z" * 1000), (11, "u", "z" * 1000)]


def brute(rows):
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        newest = max((j for j, _, u in rows if (u or "") == (t or "") and j is not None), default=None)
        refers = newest if len(data) >= 1000 and newest is not None and (i is None or i < newest) else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_records_match_brute_force(spark):
    assert sorted((tuple(x) for x in warc.records(pages(spark, ROWS)).collect()), key=str) == brute(ROWS)
    assert warc.records(pages(spark, [])).count() == 0


def test_archive_keeps_payloads_once_and_headers_exactly(spark):
    path = scratch_dir(spark)
    warc.write(pages(spark, ROWS), path)
    kept = warc.payloads(spark, path).collect()
    assert sorted(hashlib.sha256(x.payload).hexdigest() for x in kept) == sorted({hashlib.sha256((t or "").encode()).hexdigest() for *_, t in ROWS})
    back = warc.restore(spark, path).collect()
    assert sorted(((x.page_id, bytes(x.payload)) for x in back), key=str) == sorted(((i, (t or "").encode()) for i, _, t in ROWS), key=str)
    assert all("\r\nEvil" not in x.header for x in back)


def test_files_round_trip(spark):
    path = scratch_dir(spark)
    warc.write(pages(spark, ROWS), path)
    for kind in ("gzip", "none"):
        warc.export_files(spark, path, f"{path}/{kind}", kind)
        got = sorted((x.header, bytes(x.block)) for x in warc.import_files(spark, f"{path}/{kind}").collect())
        assert got == sorted((x.header, bytes(x.payload) if "WARC-Type: response" in x.header else b"") for x in warc.restore(spark, path).collect())


def test_damaged_payload_fails(spark):
    path = scratch_dir(spark)
    warc.write(pages(spark, ROWS[:1]), path)
    spark.createDataFrame([("0" * 64, bytearray(b"x"))], "sha256 string, payload binary").write.mode("append").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.payloads(spark, path).collect()


def warc_bytes(records):
    return [h + b + b"\r\n\r\n" for h, b in records]


def test_foreign_records_are_restored_byte_for_byte(spark, tmp_path):
    import gzip

    head = lambda n, x=b"": b"WARC/1.0\r\nwarc-type: resource\r\nX-Odd: \xff\xfe " + x + b"\r\nContent-length:  %d\r\n\r\n" % n
    blocks = [b"", b"\r\n\r\nWARC/1.0\r\n\r\n", b"\0\x80" * 900, b"\0\x80" * 900, b"plain"]
    records = [(head(len(b), str(i).encode()), b) for i, b in enumerate(blocks)] + [(head(5), b"plain")] * 2
    (tmp_path / "a.warc").write_bytes(b"".join(warc_bytes(records[:3])))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in warc_bytes(records[3:])))
    path = scratch_dir(spark)
    warc.archive(warc.import_files(spark, str(tmp_path), rows=2), path)
    back = warc.originals(spark, path)
    assert sorted((bytes(x.header_bytes), bytes(x.block)) for x in back.collect()) == sorted(records)
    assert warc.payloads(spark, path).count() == len(set(blocks))
    assert back.select(warc.field("X-Odd").alias("f")).filter("f is not null").count() == len(records)


@pytest.mark.parametrize("data, said", [(b"WARC/1.0\r\nA: b\r\n\r\nbody", "without a length"), (b"WARC/1.0\r\nContent-Length: 9\r\n\r\nbody", "cut off"), (b"no record", "cut off")])
def test_damaged_files_say_what_is_wrong(data, said):
    with pytest.raises(ValueError, match=said):
        list(warc._parse(iter([data])))


def test_reading_takes_time_in_proportion_to_the_file():
    import gzip
    import os
    import time

    def took(n):
        record = lambda k: b"WARC/1.0\r\nContent-Length: 2000\r\n\r\n" + os.urandom(1990) + b"%010d" % k + b"\r\n\r\n"
        data = b"".join(gzip.compress(record(k), 1) for k in range(n))
        began, got = time.process_time(), [b[-10:] for _, b in warc._parse(warc._members(data))]
        assert got == [b"%010d" % k for k in range(n)]
        return time.process_time() - began

    took(100)
    assert took(16_000) < 3 * took(8_000) + 0.5  # 32 MB and 16 MB


@pytest.mark.parametrize("piece", [7, 100, 1 << 20])
def test_records_in_any_pieces(monkeypatch, piece):
    import gzip

    monkeypatch.setattr(warc, "PIECE", piece)
    records = [(b"WARC/1.0\r\nContent-Length: %d\r\n\r\n" % len(b), b) for b in (b"", b"\r\n", b"x" * 5000, b"a\r\n\r\nb" * 50, b"end")]
    plain = b"".join(warc_bytes(records))
    for data in (plain, gzip.compress(plain), b"".join(gzip.compress(x) for x in warc_bytes(records)), b"".join(gzip.compress(x) + b"\0" * 3 for x in warc_bytes(records))):
        assert list(warc._parse(warc._members(data))) == records
    with pytest.raises(ValueError, match="cut off"):
        list(warc._parse(warc._members(gzip.compress(plain)[:-9])))
