import gzip
import hashlib
import io
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import queries, warc

PAGES = [
    (1, "http://a.example/", "x" * 99),
    (2, "http://b.example/", "x" * 99),
    (3, "http://c.example/\r\nInjected: yes", "y" * 100),
    (4, None, "y" * 100),
    (5, "http://e.example/", "ü" * 50),
    (6, "http://f.example/", "ü" * 50),
    (7, "http://g.example/", None),
    (8, "http://h.example/", ""),
    (9, "http://i.example/", "long \r\n\r\n " * 40000),
    (None, "http://j.example/", "y" * 100),
    (10, "http://k.example/", "z" * 200),
    (10, "http://k.example/", "z" * 200),
]


@pytest.fixture
def archive(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "archive")
    queries.archive_records(pages).write.format("warc").mode("append").save(path)
    return path


def rows(spark, path, **options):
    return spark.read.format("warc").options(**options).load(path)


def test_round_trip(spark, archive):
    found = {}
    for r in rows(spark, archive).collect():
        found.setdefault(r["record_id"], []).append(r)
    assert sum(map(len, found.values())) == len(PAGES)
    for page, url, html in PAGES:
        if page is None:
            continue
        payload = (html or "").encode()
        for r in found[f"<urn:page:{page}>"]:
            assert r["payload_length"] == len(payload)
            assert r["payload_digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            assert r["target_uri"] == (" ".join(url.split()) if url else None)
            revisit = {4: 3, 6: 5}.get(page)
            assert r["record_type"] == ("revisit" if revisit else "response")
            assert r["refers_to"] == (f"<urn:page:{revisit}>" if revisit else None)
            assert r["payload"] == (None if revisit else payload)


def test_filters_are_pushed_down(spark, archive, plan):
    revisits = rows(spark, archive).filter("record_type = 'revisit'")
    assert revisits.count() == 2
    assert "= revisit" not in plan(revisits)  # the source has taken the test over
    uri = rows(spark, archive).filter("record_type = 'response' and target_uri = 'http://e.example/'")
    assert [r["record_id"] for r in uri.collect()] == ["<urn:page:5>"]
    assert rows(spark, archive).filter("payload_length > 1000").count() == 1
    both = rows(spark, archive).filter("record_type = 'response'").filter("record_type = 'revisit'")
    assert both.count() == 0


def test_payloads_can_be_left_out(spark, archive):
    found = rows(spark, archive, payload="false")
    assert found.filter("payload is not null").count() == 0
    assert found.agg(F.sum("payload_length")).first()[0] == sum(
        len((html or "").encode()) for _, _, html in PAGES
    )


def test_any_gzip_reader_opens_the_files(archive, tmp_path):
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "archive").glob("*.warc.gz"))
    assert plain.count(b"WARC/1.1\r\n") == len(PAGES)
    assert b"\r\nInjected" not in plain


def test_files_without_a_manifest_are_not_read(spark, archive, tmp_path):
    (tmp_path / "archive" / "left-over.warc.gz").write_bytes(b"half a record")
    assert rows(spark, archive).count() == len(PAGES)
    for manifest in (tmp_path / "archive").glob("manifest-*"):
        manifest.write_text("[]")
    assert rows(spark, archive).count() == 0


def test_a_folder_of_foreign_archives(spark, tmp_path):
    warc.register(spark)
    folder = tmp_path / "foreign"
    folder.mkdir()
    with pytest.raises(Exception, match="no manifest"):
        rows(spark, str(folder)).count()
    info = b"software: other/1.0\r\n"
    head = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}"
    chunked = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody"
    other = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:c>\r\nContent-Length: {len(chunked)}"
    for k in range(3):
        parts = [head.encode() + b"\r\n\r\n" + info, other.encode() + b"\r\n\r\n" + chunked]
        data = b"".join(gzip.compress(part + b"\r\n\r\n") for part in parts)
        (folder / f"{k}.warc.gz").write_bytes(data + gzip.compress(record(k, 3000)))
    found = rows(spark, str(folder))
    assert found.count() == 9
    assert {(r["payload"], r["payload_length"]) for r in found.filter("record_type = 'warcinfo'").collect()} == {
        (info, len(info))
    }
    assert {(r["payload"], r["payload_length"]) for r in found.filter("record_id = '<urn:c>'").collect()} == {
        (b"body", 4)
    }
    assert found.filter("payload_length = 3000").count() == 3


def test_extra_columns_do_not_clash(spark):
    pages = spark.createDataFrame(
        [(1, "u", "y" * 100, "a", 5), (2, "v", "y" * 100, "b", 6)],
        "page_id long, url string, html string, payload string, n long",
    )
    found = queries.archive_records(pages).orderBy("record_id").collect()
    assert [(r["record_type"], r["refers_to"]) for r in found] == [
        ("response", None),
        ("revisit", "<urn:page:1>"),
    ]


def test_no_pages(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    queries.archive_records(pages).write.format("warc").mode("append").save(str(tmp_path / "w"))
    assert rows(spark, str(tmp_path / "w")).count() == 0


def record(number, size=300_000):
    return warc.record_bytes(
        {
            "record_id": f"<urn:{number}>",
            "record_type": "response",
            "target_uri": f"http://{number}.example/",
            "date": "2024-01-01T00:00:00Z",
            "refers_to": None,
            "payload_digest": None,
            "payload_length": size,
            "payload": bytes(k * number % 251 for k in range(size)),
        }
    )


class Counted(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data

    def size(self):
        return len(self.getbuffer())


@pytest.mark.parametrize("pack", [warc.member, gzip.compress])
def test_foreign_members_and_skipping(pack):
    stream = Counted(b"".join(pack(record(k)) for k in range(1, 6)))
    found = list(warc.read_records(stream, {"target_uri": "http://4.example/"}, True))
    assert [r[0] for r in found] == ["<urn:4>"]
    assert found[0][-1] == bytes(k * 4 % 251 for k in range(300_000))


def test_unwanted_payloads_are_not_read():
    noise = [hashlib.sha256(bytes([k])).digest() for k in range(5)]
    plain = []
    for k in range(5):
        body = b"".join(hashlib.sha256(noise[k] + bytes([i % 256, i // 256])).digest() for i in range(20000))
        plain.append(record(k, 0)[:-4] + body)
    stream = Counted(b"".join(map(warc.member, plain)))
    assert list(warc.read_records(stream, {"record_type": "revisit"}, True)) == []
    assert stream.taken <= 5 * warc.CHUNK < stream.size() / 5


@pytest.mark.parametrize("pack", [warc.member, gzip.compress])
def test_small_records_share_reads(pack):
    stream = Counted(b"".join(pack(record(k, 2000)) for k in range(500)))
    assert len(list(warc.read_records(stream, {}, True))) == 500
    assert stream.taken <= 1.1 * stream.size()


def test_a_broken_payload_is_noticed():
    data = bytearray(warc.member(record(1)))
    data[-6] ^= 1  # in the check sum
    with pytest.raises(zlib.error):
        list(warc.read_records(Counted(bytes(data)), {}, True))


def test_headers_longer_than_a_megabyte():
    url = "http://long.example/" + "x" * (3 << 20)
    row = {
        "record_id": "<urn:1>",
        "record_type": "response",
        "target_uri": url,
        "date": "2024-01-01T00:00:00Z",
        "refers_to": None,
        "payload_digest": "sha256:1",
        "payload_length": 4,
        "payload": b"text",
    }
    revisit = row | {"record_type": "revisit", "refers_to": "<urn:1>", "payload": None}
    stream = Counted(b"".join(warc.member(warc.record_bytes(r)) for r in (row, revisit)))
    found = [dict(zip(row, r)) for r in warc.read_records(stream, {}, True)]
    assert found == [row, revisit]


def test_partitions_are_packed_by_size(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1000)
    monkeypatch.setattr(warc, "PARTITION_BYTES", 3000)
    writer = warc.WarcWriter(str(tmp_path / "w"), False)
    batch = pa.RecordBatch.from_pylist(
        [dict.fromkeys(warc.HEADERS, f"{k}") | {"payload_length": 9, "payload": b"123456789"} for k in range(60)]
    )
    writer.commit([writer.write(iter([batch])), None])
    parts = warc.WarcReader(str(tmp_path / "w"), True).partitions()
    names = [n for p in parts for n in p.names]
    assert len(parts) > 1 and len(names) == len(set(names)) > len(parts)
