"""Geodesic lengths against independent formulas; HTTP log parsing and transfer summaries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from road_rows import lines_df
from tsuji.functions import geodesy
from tsuji.operators import transfer


def _hav_py(lon1, lat1, lon2, lat2, r):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * r * math.asin(math.sqrt(h))


def test_sphere_length_matches_python(spark):
    coords = [(139.70, 35.65), (139.72, 35.66), (139.75, 35.70)]
    df = lines_df(spark, [("a", coords)])
    got = df.select(geodesy.length_sphere("line")).first()[0]
    exp = sum(_hav_py(*a, *b, geodesy.MEAN_RADIUS_M) for a, b in zip(coords, coords[1:]))
    assert abs(got - exp) < 1e-6


def test_spheroid_length_known_geodesic(spark):
    # Flinders Peak -> Buninyong (Vincenty 1975 test line): 54972.271 m on the GRS80/WGS84 ellipsoid
    a = (144 + 25 / 60 + 29.52440 / 3600, -(37 + 57 / 60 + 3.72030 / 3600))
    b = (143 + 55 / 60 + 35.38390 / 3600, -(37 + 39 / 60 + 10.15610 / 3600))
    df = lines_df(spark, [("a", [a, b])])
    hof = df.select(geodesy.length_spheroid("line")).first()[0]
    assert abs(hof - 54972.271) < 0.01
    rows = geodesy.with_spheroid_length(geodesy.segment_rows(df)).agg(F.sum("seg_len")).first()[0]
    assert abs(rows - hof) < 1e-6


def test_row_form_equals_array_form(spark):
    df = lines_df(spark, [(str(i), [(139 + i * 0.01, 35 + i * 0.002), (139.02 + i * 0.01, 35.01), (139.05, 35.03 + i * 0.001)])
                          for i in range(20)] + [("single", [(139, 35)]), ("empty", [])])
    arr = df.select(F.sum(geodesy.length_sphere("line"))).first()[0]
    seg = geodesy.with_sphere_length(geodesy.segment_rows(df, keep=("source_mesh",)))
    rows = seg.agg(F.sum("seg_len"), F.count_if(geodesy.is_first_segment())).first()
    assert abs(rows[0] - arr) < 1e-6
    assert rows[1] == 22        # every line counted once, including those without segments


HEAD = ("{'request': {'type': HEAD, 'url': 'https://h/f.parquet', 'headers': {User-Agent='t/1'}}, "
        "'response': {'status': OK_200, 'headers': {Content-Length='5000000'}}}")


def _get(a, b, total=5000000):
    return ("{'request': {'type': GET, 'headers': {User-Agent='t/1', Range='bytes=%d-%d'}}, "
            "'response': {'status': PartialContent_206, 'headers': {Content-Length='%d', "
            "Content-Range='bytes %d-%d/%d'}}}" % (a, b, b - a + 1, a, b, total))


def _logs(spark, msgs):
    return spark.createDataFrame([(i, 1, m) for i, m in enumerate(msgs)], "seq long, probe long, message string")


def test_parse_head_and_get(spark):
    rows = transfer.parse_log(_logs(spark, [HEAD, _get(100, 1099), "garbage"])).orderBy("seq").collect()
    assert (rows[0].method, rows[0].status, rows[0].range_header, rows[0].content_length) == ("HEAD", "OK_200", None, 5000000)
    assert (rows[1].method, rows[1].status, rows[1].range_header, rows[1].content_length, rows[1].total_size) == (
        "GET", "PartialContent_206", "100-1099", 1000, 5000000)
    assert (rows[2].method, rows[2].status, rows[2].content_length) == ("?", "?", None)


def test_summary_sums_only_get_bytes(spark):
    s = transfer.summarize_transfer(transfer.parse_log(_logs(spark, [HEAD, _get(0, 999), _get(5000, 5099)]))).first()
    assert (s.n_requests, s.n_get, s.get_bytes, s.full_size) == (3, 2, 1100, 5000000)
    assert s.fraction < 0.001


def test_summary_falls_back_to_content_range(spark):
    s = transfer.summarize_transfer(transfer.parse_log(_logs(spark, [_get(0, 999), _get(10, 19, 7000000)]))).first()
    assert s.full_size == 7000000


def test_summary_of_no_log(spark):
    empty = spark.createDataFrame([], "seq long, probe long, message string")
    s = transfer.summarize_transfer(transfer.parse_log(empty)).first()
    assert (s.n_requests, s.n_get, s.get_bytes, s.full_size, s.fraction) == (0, 0, 0, None, None)


def test_url_file_name_equals_urlparse_path_name(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from tsuji.functions.text import url_file_name
    urls = ["http://a.com/x/y.zip?q=1#f", "example.com/a/b.zip", "https://h/dir/", "https://h", "ftp://h/p/f.txt",
            "/rel/path.zip", "file:///tmp/z.zip", "https://h/a//b.geojson", "https://h/N13-24_3622_GEOJSON.zip"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: r.n for r in df.select("u", url_file_name("u").alias("n")).collect()}
    assert got == {u: Path(urlparse(u).path).name for u in urls}


def test_wkt_spacing_and_case(spark):
    from tsuji.functions.geom import line_from_wkt
    rows = [("LINESTRING(1 2,3 4)",), ("linestring ( 1 2 , 3 4 )",), ("  LineString(1.5   2.5, 3 4)  ",)]
    got = [[(p.x, p.y) for p in r[0]] for r in spark.createDataFrame(rows, "w string").select(line_from_wkt("w")).collect()]
    assert got == [[(1.0, 2.0), (3.0, 4.0)], [(1.0, 2.0), (3.0, 4.0)], [(1.5, 2.5), (3.0, 4.0)]]
