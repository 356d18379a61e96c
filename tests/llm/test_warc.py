"""WARC: a plain check of every record, byte-range grouping, odd inputs."""

from __future__ import annotations

import base64
import hashlib

from tsuji.llm import warc
from tsuji.llm.queries import QUERIES
from tsuji.session import scratch_path

SF = "/root/testdata/sf0.01"


def plain(pages):
    biggest = {}
    for i, h in pages:
        d = (h or "").encode()
        biggest[d] = max(biggest.get(d, i), i)
    out = []
    for i, h in pages:
        d = (h or "").encode()
        out.append((i, len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(),
                    "response" if i == biggest[d] else "revisit", None if i == biggest[d] else biggest[d]))
    return sorted(out)


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = QUERIES["op7_warc"](spark, SF)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect())) == plain(pages)


def test_copies_nulls_and_odd_urls(spark):
    pages = [(1, "http://a/ü b?x=%41", "é" * 10), (2, None, "é" * 10), (3, " u\r\nX: y ", ""), (4, "u", None), (5, "u", "WARC/1.1\r\n\r\n\x00x"),
             (6, "u", "é" * 10)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert sorted(map(tuple, warc.archive_report(df).collect())) == plain([(i, h) for i, _, h in pages])
    folder = scratch_path(spark, "warc-test")
    index = warc.write(df, folder, min_bytes=5)
    back = {r.id: r for r in warc.read(index, folder).collect()}
    assert {i: r.url for i, r in back.items()} == {i: u for i, u, _ in pages}
    assert bytes(back[6].payload).decode() == "é" * 10 and back[1].payload is None and back[1].refers_to == 6
    assert back[3].type == back[4].type == "response" and bytes(back[5].payload).decode() == "WARC/1.1\r\n\r\n\x00x"
    chosen = warc.read(index.where("url = 'u' and id >= 5"), folder).collect()
    assert {r.id for r in chosen} == {5, 6}
    assert warc.archive_report(df.limit(0)).collect() == []
    none = spark.createDataFrame([(None, "u", "x"), (None, "u", "x"), (1, "u", "x")], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.archive_report(none).collect()) == [
        (0, "revisit", 1), (0, "revisit", 1), (1, "response", None)]


def test_ranges_join_neighbours_only():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 200, 5), ("b", 0, 5), ("b", 6, 50), ("b", 56, 60)]
    got = [(f, b, e, len(g)) for f, b, e, g in warc.ranges(rows, read_bytes=100, gap=20)]
    assert got == [("a", 0, 15, 2), ("a", 200, 205, 1), ("b", 0, 56, 2), ("b", 56, 116, 1)]
