import base64
import gzip
import hashlib
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from nightledger.llm import warc_index
from nightledger.llm.common import NULL_ID, shared_folder


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, size string, archive string")


def brute(rows, least=0):
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", NULL_ID), NULL_ID if i is None else i)
    out = []
    for i, _, h in rows:
        data, best = (h or "").encode(), top[h or ""]
        again = len(data) >= least and best != (NULL_ID if i is None else i)
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((str(i), len(data), name, "revisit" if again else "response", str(best) if again else "None"))
    return sorted(out)


def odd_pages():
    same = "<html>" + "ä" * 50 + "</html>"
    rows = [(k, f"http://Host{k % 7}.example.com:80/p/{k // 3}?q={k}#f", same if k % 3 else f"page {k}\r\n\r\nbody") for k in range(700)]
    rows += [(1000, None, None), (1001, "", ""), (1002, "no url", "x" * 300_000), (1003, "http://h.org/a b\r\nWARC-Type: x", "y")]
    return rows + [(None, "http://n.org", "only"), (None, "http://n.org", same), (5, "http://Host5.example.com:80/p/1?q=5#f", same), (1004, "http://h.org/", "tie"), (1004, "http://h.org/", "tie")]


def test_round_trip(spark):
    for least in (0, 100):
        rows = odd_pages()
        got = warc_index.archive_round_trip(pages(spark, rows), least=least).collect()
        assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == brute(rows, least)


def test_keys():
    assert warc_index.url_key("https://u@A.B.example.COM:8080/x?y#z") == "com,example,b,a:8080)/x?y"
    assert warc_index.url_key("http://example.com:80") == "com,example)/"
    assert warc_index.url_key(None) == ""


def test_lookup_reads_only_wanted_records(spark, monkeypatch):
    rows = odd_pages()
    folder = shared_folder(spark)
    captures = warc_index.write_archives(pages(spark, rows), f"{folder}/a")
    index = warc_index.build_index(captures, f"{folder}/i")
    assert index.firsts == sorted(index.firsts)
    wanted = captures.where(F.col("url_key").startswith("com,example,host3)") & (F.col("page_key") < 300))
    n = wanted.count()
    assert n > 20
    places = warc_index.lookup(wanted, index)
    assert sorted(map(tuple, places.collect())) == sorted(map(tuple, wanted.collect()))
    texts = warc_index.fetch(places.where("page_key = 3"), f"{folder}/a").collect()
    assert [r.payload for r in texts] == [b"page 3\r\n\r\nbody"]
    missing = spark.createDataFrame([("com,none)/", 1), ("", 0), ("zzz", 9)], "url_key string, page_key long")
    assert warc_index.lookup(missing, index).count() == 0


def test_records_are_gzip_members():
    data = warc_index.record(7, "http://a.org/", "é".encode(), None) + warc_index.record(8, "http://a.org/", "é".encode(), 7)
    text = gzip.decompress(data)
    assert text.count(b"WARC/1.1\r\n") == 2 and b"WARC-Refers-To: <urn:page:7>" in text


def test_records_have_the_fields_that_the_format_asks_for():
    for refers_to in (None, 9):
        when = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone(timedelta(hours=2)))
        head, _, rest = gzip.decompress(warc_index.record(8, "http://a.org/", b"x", refers_to, when)).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        assert version == "WARC/1.1" and fields["WARC-Date"] == "2026-01-02T01:04:05Z"
        assert {"WARC-Record-ID", "WARC-Type", "Content-Length", "WARC-Target-URI"} <= set(fields)
        assert rest[int(fields["Content-Length"]) :] == b"\r\n\r\n"
        assert ("WARC-Profile" in fields) == (refers_to is not None)


def test_records_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, monkeypatch):
    rows = [(k, f"http://h{k % 5}.org/{k}", str(k) + "".join(chr(33 + (k * i * 7919) % 90) for i in range(900))) for k in range(300)]
    folder = shared_folder(spark)
    captures = warc_index.write_archives(pages(spark, rows), f"{folder}/a")
    total = captures.agg(F.sum("size")).first()[0]
    monkeypatch.setattr(warc_index, "TASK_BYTES", total // 40)
    tasks = {r[0] for r in warc_index.fetch(captures, f"{folder}/a").select(F.spark_partition_id()).collect()}
    assert 30 <= len(tasks) <= 41
    monkeypatch.setattr(warc_index, "INDEX_LINES", 10)
    index = warc_index.build_index(captures, f"{folder}/i")
    assert 20 <= len(index.files) <= 30
    assert sorted(map(tuple, warc_index.lookup(captures, index).collect())) == sorted(map(tuple, captures.collect()))


def test_empty_table(spark):
    assert warc_index.archive_round_trip(pages(spark, [])).count() == 0
