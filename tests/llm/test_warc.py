import gzip
import hashlib
import io

from pyspark.sql import functions as F

from corpusloom.llm import warc

BIG, BIG2 = "x" * 1000, "é" * 600
PAGES = [(1, "http://a.example/1", BIG), (2, "http://a.example/2", BIG), (3, None, BIG), (4, "u\r\nWARC-Type: evil", BIG2), (5, "http://ü.example", BIG2), (6, "s", "small"), (7, "s", "small"), (8, "n", None), (9, "e", ""), (10, "l", "long\r\n\r\n" * 200_000), (None, "null", BIG + "y"), (11, "z", BIG + "y"), (12, "r", "rep" * 400), (12, "r", "rep" * 400)]


def brute(pages):
    last = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    out = []
    for i, _, h in pages:
        p = (h or "").encode()
        again = len(p) >= 1000 and i is not None and i < last[h or ""]
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", last[h or ""] if again else None))
    return sorted(out, key=str)


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def test_round_trip(spark):
    assert sorted([tuple(r) for r in warc.round_trip(frame(spark)).collect()], key=str) == brute(PAGES)
    assert warc.round_trip(frame(spark, [])).count() == 0


def test_pages_of_the_table(spark):
    p = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in p.collect()]
    assert sorted([tuple(r) for r in warc.round_trip(p).collect()], key=str) == brute(rows)


def test_pushed_predicates_skip_payloads(spark, tmp_path, monkeypatch):
    uri = f"file://{tmp_path}/w"
    warc.write_pages(frame(spark), uri)
    df = warc.read(spark, uri)
    assert {r.record_id for r in df.filter(F.col("record_type").isin("revisit")).collect()} == {"urn:page:1", "urn:page:2", "urn:page:4"}
    one = df.filter((F.col("target_uri") == "http://a.example/1") & (F.col("record_type") == "revisit")).collect()
    assert len(one) == 1 and one[0].refers_to == "urn:page:3" and one[0].payload is None and one[0].payload_bytes == 1000
    assert df.filter(F.col("record_type") == "x").count() == 0
    reader = warc.WarcReader({"path": uri})
    assert len(list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.EqualTo(("payload_bytes",), 3)]))) == 1
    # of the long record only the first bytes are decompressed where its payload isn't wanted
    name = max((tmp_path / "w").glob("*.gz"), key=lambda p: p.stat().st_size)
    taken = []
    more = warc._Source.more
    monkeypatch.setattr(warc._Source, "more", lambda self, n=warc.CHUNK: (taken.append(n), more(self, n))[1])
    with io.BufferedReader(io.FileIO(name)) as f:
        rows = list(warc.records(f, True, {"record_type": {"revisit"}}, True))
    assert max(taken) <= warc.CHUNK and all(r["record_type"] == "revisit" for r in rows)


def test_archives_of_others(spark, tmp_path):
    row = {"record_type": "response", "record_id": "urn:x", "date": "2000", "payload_digest": hashlib.sha1(b"hi").hexdigest(), "payload_bytes": 2, "payload": b"hi", "target_uri": "u", "refers_to": None}
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + warc.render(row) * 2)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(warc.render(row)))
    got = warc.read(spark, f"file://{tmp_path}").collect()
    assert sorted(bytes(r.payload) for r in got) == [b"abc"] * 2 + [b"hi"] * 3


def test_members_are_gzip_and_only_committed_files_are_read(spark, tmp_path):
    record = warc.render({"record_type": "response", "record_id": "i", "date": "d", "payload_digest": "00" * 20, "payload_bytes": 1, "payload": b"x", "target_uri": None, "refers_to": None})
    assert gzip.decompress(warc.member(record) * 2) == record * 2
    uri = f"file://{tmp_path}/w"
    warc.write_pages(frame(spark, PAGES[:3]), uri)
    (tmp_path / "w/part-lost.warc.gz").write_bytes(warc.member(record))
    assert warc.read(spark, uri).count() == 3
    small = warc.WarcReader({"path": uri, "split": "1"})
    assert len(small.partitions()) == len(list((tmp_path / "w").glob("part-*"))) - 1
