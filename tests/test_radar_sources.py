import gzip
import json
import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormspan.functions.radar import CLARKE_1866, GRS_80, TRIAL, rain_rate, scan_inches
from stormspan.operators import spatial
from stormspan.plans.radar import rain_grid
from stormspan.sources import readers, writers

SWEEP = "path string, site_lat double, site_lon double, azimuth double, first_gate double, gate_width double, gates array<double>"


def sweep(spark, *rays):
    return spark.createDataFrame(list(rays), SWEEP)


def dms(d, m, s):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


def test_published_geodesic(spark):
    # The worked example of the Geocentric Datum of Australia manual.
    # Its azimuth is rounded to 0.01", which is 1.3 mm (1.2e-8 degrees) at this range.
    ray = ("x", dms(-37, 57, 3.72030), dms(144, 25, 29.52440), dms(306, 52, 5.37), 54.972271, 1.0, [30.0])
    row = spatial.gates_to_points(sweep(spark, ray), ["path"], ellipsoid=GRS_80).first()
    assert row.lat == pytest.approx(dms(-37, 39, 10.15610), abs=1.5e-8)
    assert row.lon == pytest.approx(dms(143, 55, 35.38390), abs=1.5e-8)


def vincenty(lat, lon, azimuth, metres, shape=CLARKE_1866):
    a, f = shape.semi_major, shape.flattening
    b = a * (1 - f)
    az, tu = math.radians(azimuth), (1 - f) * math.tan(math.radians(lat))
    cu = 1 / math.hypot(1, tu)
    su, s1, sal = tu * cu, math.atan2(tu, math.cos(az)), cu * math.sin(az)
    c2 = 1 - sal * sal
    u2 = c2 * (a * a - b * b) / (b * b)
    big_a = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    big_b = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    sg = metres / (b * big_a)
    for _ in range(20):
        cm, ss, cs = math.cos(2 * s1 + sg), math.sin(sg), math.cos(sg)
        sg = metres / (b * big_a) + big_b * ss * (cm + big_b / 4 * (cs * (2 * cm * cm - 1) - big_b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
    cm, ss, cs = math.cos(2 * s1 + sg), math.sin(sg), math.cos(sg)
    out = math.atan2(su * cs + cu * ss * math.cos(az), (1 - f) * math.hypot(sal, su * ss - cu * cs * math.cos(az)))
    c = f / 16 * c2 * (4 + f * (4 - 3 * c2))
    turn = math.atan2(ss * math.sin(az), cu * cs - su * ss * math.cos(az)) - (1 - c) * f * sal * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
    return math.degrees(out), lon + math.degrees(turn)


def test_series_form_equals_iteration(spark):
    rays = [("x", None, None, float(az), 2.125, 20.0, [30.0] * 24) for az in range(0, 360, 15)]
    rows = spatial.gates_to_points(sweep(spark, *rays).withColumn("az", F.col("azimuth")), ["az"]).collect()
    assert len(rows) == 24 * 24
    for r in rows:
        lat, lon = vincenty(41.60444, -88.08472, r.az, (2.125 + r.gate * 20.0) * 1000)
        assert (r.lat, r.lon) == (pytest.approx(lat, abs=1e-10), pytest.approx(lon, abs=1e-10))


def test_missing_and_weak_gates_are_left_out(spark):
    ray = ("x", 41.6, -88.0, 10.0, 1.0, 1.0, [0.0, float("nan"), None, 20.0, 20.5])
    assert [r.gate for r in spatial.gates_to_points(sweep(spark, ray), ["path"]).collect()] == [4]
    assert [r.gate for r in spatial.gates_to_points(sweep(spark, ray), ["path"], floor_dbz=None).collect()] == [3, 4]


def ray_cast(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if min(y1, y2) < y <= max(y1, y2) and x <= max(x1, x2):
            if x1 == x2 or x <= (y - y1) * (x2 - x1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def polygons(spark, rings):
    rows = [(name, pos, [{"x": float(x), "y": float(y)} for x, y in ring]) for pos, (name, ring) in enumerate(rings)]
    return spark.createDataFrame(rows, "zone string, pos int, ring array<struct<x: double, y: double>>")


RINGS = [
    ("bowl", [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]),
    ("square", [(3, 3), (6, 3), (6, 6), (3, 6), (3, 3)]),
    ("far", [(50, 50), (51, 50), (51, 51)]),
]


def test_points_in_polygons_against_brute_force(spark):
    rng = np.random.default_rng(9)
    points = [(float(x), float(y)) for x, y in rng.integers(0, 14, (150, 2)) / 2] + [(2.0, 1.0), (3.0, 3.0), (6.0, 6.0), (-1.0, 2.0)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    shapes = polygons(spark, RINGS)
    want = {(i, name) for i, (x, y) in enumerate(points) for name, ring in RINGS if ray_cast(x, y, ring)}
    for cell in (0.7, 3.0):
        hits = {(r.id, r.zone) for r in spatial.points_in_polygons(df, shapes, cell=cell).collect()}
        firsts = {(r.id, r.zone) for r in spatial.first_polygon(df, shapes, cell=cell).collect()}
        assert hits == want
        assert firsts == {(i, next(n for n, _ in RINGS if (i, n) in want)) for i in {i for i, _ in want}}
    means = {r.zone: r.lat for r in spatial.zone_means(spatial.points_in_polygons(df, shapes), shapes, "lat").collect()}
    assert means["far"] == 0.0 and means["square"] > 3
    timed = spark.createDataFrame([(None, "square", 5.0), (1, "bowl", 2.0)], "t int, zone string, v double")
    by_time = {(r.t, r.zone): r.v for r in spatial.zone_means(timed, shapes, "v", by=["t"], zones=["bowl", "square"]).collect()}
    assert by_time == {(None, "square"): 5.0, (None, "bowl"): 0.0, (1, "bowl"): 2.0, (1, "square"): 0.0}


def test_rates(spark):
    row = spark.range(1).select(rain_rate(F.lit(40.0)), rain_rate(F.lit(40.0), TRIAL), scan_inches(F.lit(40.0))).first()
    assert row[0] == pytest.approx((10**4 / 200) ** 0.625) and row[1] == pytest.approx((10**4 / 300) ** 0.85)
    assert row[2] == pytest.approx(row[0] * 0.0833 / 25.4)


def test_sweep_files_to_grid(spark, tmp_path):
    for name, gates in {"KLOT20160812_010203.gz": [30.0, 40.0], "KLOT20160812_010703.gz": [10.0, 0.0], "KLOT20160812_011203.gz": None}.items():
        body = json.dumps(gates).encode() if gates else b"broken"
        (tmp_path / name).write_bytes(gzip.compress(body) if gates else body)

    def decode(path, content):
        import gzip
        import json

        gates = json.loads(gzip.decompress(content))
        return [dict(site_lat=41.7, site_lon=-87.9, azimuth=90.0, first_gate=5.0, gate_width=1.0, gates=gates)]

    sweeps = readers.decode_sweeps(readers.read_binary(spark, str(tmp_path)), decode)
    failed = sweeps.filter("error is not null").collect()
    assert [r.path.endswith("011203.gz") for r in failed] == [True]
    assert failed[0].error.startswith("BadGzipFile") and failed[0].gates is None
    shapes = polygons(spark, [("z", [(-87.94, 41.65), (-87.6, 41.65), (-87.6, 41.9), (-87.94, 41.9)])])
    rows = rain_grid(sweeps, shapes, ["z"], cell=0.2).collect()
    assert [r.timestamp for r in rows] == [datetime(2016, 8, 11, 20, 2, 3)]
    want = np.mean([(10 ** (d / 10) / 200) ** 0.625 * 0.0833 / 25.4 for d in (30.0, 40.0)])
    assert rows[0].z == pytest.approx(want)
    assert readers.read_binary(spark, str(tmp_path)).filter(readers.is_product("path", "0102")).count() == 1


def test_csv_round_trip_and_bad_rows(spark, tmp_path):
    df = spark.createDataFrame([("a, b", 1.5, "x"), (None, 2.0, "y")], "name string, v double, kind string")
    writers.write_csv(df, str(tmp_path / "plain"))
    back = readers.read_csv(spark, str(tmp_path / "plain"), "name string, v double, kind string")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    writers.write_csv(df, str(tmp_path / "parts"), partition_by=["kind"])
    assert sorted(p.name for p in (tmp_path / "parts").iterdir() if p.is_dir()) == ["kind=x", "kind=y"]
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text("t,v\n1,2.5\nnot a number,3\n")
    (folder / "2.csv").write_text("t,v\n7,1.0\n")
    many = readers.read_csv(spark, str(folder), "t int, v double", skip_bad=True)
    assert {(r.t, r.corrupt_row) for r in many.collect()} == {(1, None), (7, None), (None, "not a number,3")}
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        readers.read_csv(spark, str(folder), "t int, v double").collect()
    (tmp_path / "keys.csv").write_text("key\n2016/a.gz\n2016/b.gz\n")
    assert [r.key for r in readers.read_keys(spark, str(tmp_path / "keys.csv")).collect()] == ["2016/a.gz", "2016/b.gz"]


def test_geojson(spark, tmp_path):
    path = tmp_path / "points.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": "7", "REACH": "Cal R"}, "geometry": {"type": "Point", "coordinates": [-87.5, 41.7]}}]}))
    assert readers.read_feature_properties(spark, str(path), "id: string, REACH: string").collect()[0].REACH == "Cal R"
    point = readers.read_feature_points(spark, str(path), "id: string").first()
    assert (point.id, point.lat, point.lon) == ("7", 41.7, -87.5)
    shape = tmp_path / "zones.geojson"
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    shape.write_text(json.dumps({"features": [{"properties": {"id": "z1"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}, indent=1))
    zones = readers.read_polygons(spark, str(shape))
    assert [(r.zone, r.pos, [[p.x, p.y] for p in r.parts[0][0]]) for r in zones.collect()] == [("z1", 0, ring)]
    zones = zones.select("zone", "pos", F.col("parts")[0][0].alias("ring"))
    out = tmp_path / "out"
    writers.write_features(zones.withColumn("precip", F.lit(25.4) / 25.4), writers.polygon_geometry(), ["zone", "precip"], str(out))
    lines = [json.loads(x) for f in out.glob("part-*") for x in f.read_text().splitlines()]
    assert lines == [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {"zone": "z1", "precip": 1.0}}]
    writers.write_json_records(point_table := spark.createDataFrame([("a", None)], "n string, v double"), str(tmp_path / "json"))
    text = "".join(f.read_text() for f in (tmp_path / "json").glob("part-*"))
    assert json.loads(text) == {"n": "a", "v": None} and point_table.count() == 1


def test_html_table_and_file_names(spark, tmp_path):
    html = """<table cols="9"><tr><td>skip</td></tr><tr valign="top"><td><div> A &amp;
 B </div></td><td><div class="x"><b>2</b></div></td></tr></table>"""
    rows = readers.html_rows(spark.createDataFrame([(html,)], "html string"), "html", readers.TABLE_ROW, readers.TABLE_CELL)
    assert [(r.row_no, r.cells) for r in rows.collect()] == [(0, ["A &\n B", "2"])]
    (tmp_path / "a.txt").write_text("1\n2\n3\n4\n5\n6")
    blocks = readers.text_blocks(readers.read_text_whole(spark, str(tmp_path)), "value", 5, list("abcde"))
    assert [(r.block, r.a, r.e) for r in blocks.collect()] == [(0, "1", "5"), (1, "6", None)]
    named = spark.createDataFrame([("s3/KLOT20150801_000411_V06.gz",), ("none",)], "p string")
    assert [r[0] for r in named.select(readers.time_from_name("p")).collect()] == [datetime(2015, 8, 1, 0, 4, 11), None]


#: Two parts, the first with a hole that holds an island, and a shape with a slit.
PARTED = {
    "two": [[[(0, 0), (6, 0), (6, 6), (0, 6)], [(1, 1), (5, 1), (5, 5), (1, 5)], [(2, 2), (4, 2), (4, 4), (2, 4)]], [[(8, 1), (9.5, 2), (8.5, 4)]]],
    "slit": [[[(3, -3), (10, -3), (10, 3), (6.5, 3), (6.4, -2), (6.3, 3), (3, 3)]]],
}


def parted(spark):
    rows = [
        (zone, pos, [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in parts])
        for pos, (zone, parts) in enumerate(PARTED.items())
    ]
    rows.append(("nothing", 9, []))
    return spark.createDataFrame(rows, "zone string, pos int, parts array<array<array<struct<x: double, y: double>>>>")


@pytest.mark.parametrize("cell", [0.3, 2.0, 40.0])
def test_parts_and_holes_against_brute_force(spark, cell):
    import numpy as np

    rng = np.random.default_rng(4)
    points = [(float(x), float(y)) for x, y in np.concatenate([rng.uniform(-1, 11, (400, 2)), rng.integers(-4, 12, (200, 2)), rng.integers(-8, 24, (200, 2)) / 2])]
    points += points[:20]  # equal points stay apart
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)] + [(-1, None, 1.0)], "id int, lon double, lat double")

    def holds(parts, x, y):
        return sum(ray_cast(x, y, ring) for part in parts for ring in part) % 2 == 1

    want = sorted((i, zone) for i, (x, y) in enumerate(points) for zone, parts in PARTED.items() if holds(parts, x, y))
    shapes = parted(spark)
    got = spatial.points_in_polygons(df, shapes, cell=cell)
    assert got.columns == ["id", "lon", "lat", "zone"]
    assert sorted((r.id, r.zone) for r in got.collect()) == want
    firsts = {}
    for i, zone in want:
        firsts[i] = min(firsts.get(i, zone), zone, key=list(PARTED).index)
    assert {r.id: r.zone for r in spatial.first_polygon(df, shapes, cell=cell).collect()} == firsts


def test_cells_wholly_inside_need_no_ray(spark):
    sides = spatial.edges(parted(spark).filter("zone = 'two'"))
    cells = spatial.covering(spatial.edge_bands(sides, 0.5), 0.5).collect()
    touched = {(r.cell_x, r.cell_y) for r in cells if not r.sure}
    sure = {(r.cell_x, r.cell_y) for r in cells if r.sure} - touched
    for x, y in sure:  # all of its points are inside
        for a in (0.01, 0.25, 0.49):
            point = (x * 0.5 + a, y * 0.5 + a)
            assert sum(ray_cast(*point, ring) for part in PARTED["two"] for ring in part) % 2 == 1
    assert (5, 5) in sure and (2, 2) in touched and (13, 5) not in sure | touched


def test_multi_polygons_are_read_written_and_read_by_lines(spark, tmp_path):
    outer, hole = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]
    far = [[9, 9], [10, 9], [10, 10], [9, 9]]
    features = [
        {"properties": {"id": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[outer, hole], [far]]}},
        {"properties": {"id": "p"}, "geometry": {"type": "Polygon", "coordinates": [outer, hole]}},
        {"properties": {"id": "n"}, "geometry": None},
    ]
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps({"features": features}, indent=1))
    zones = readers.read_polygons(spark, str(whole))
    plain = {r.zone: r.parts and [[[[p.x, p.y] for p in ring] for ring in part] for part in r.parts] for r in zones.collect()}
    assert plain == {"m": [[outer, hole], [far]], "p": [[outer, hole]], "n": None}
    points = spark.createDataFrame([(3.0, 3.0), (1.9, 1.2), (9.9, 9.5), (6.0, 6.0)], "lon double, lat double")
    hits = spatial.points_in_polygons(points, zones).collect()
    assert sorted((r.zone, r.lon) for r in hits) == [("m", 3.0), ("m", 9.9), ("p", 3.0)]
    out = str(tmp_path / "lines")
    writers.write_features(zones.filter("parts is not null").withColumnRenamed("zone", "id"), writers.parts_geometry(), ["id"], out)
    again = readers.read_polygons(spark, out, lines=True)
    assert {r.zone: r.parts for r in again.collect()} == {r.zone: r.parts for r in zones.collect() if r.parts}
    dots = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 3.0)], "id string, lon double, lat double")
    writers.write_features(dots, writers.point_geometry(), ["id"], str(tmp_path / "dots"))
    back = readers.read_feature_points(spark, str(tmp_path / "dots"), "id: string", lines=True)
    assert {r.id: (r.lon, r.lat) for r in back.collect()} == {"a": (1.0, 2.0), "b": (None, 3.0)}
    odd = tmp_path / "odd.json"
    odd.write_text(json.dumps({"features": [{"properties": {"id": "x"}, "geometry": {"type": "LineString", "coordinates": far}}]}))
    with pytest.raises(Exception, match="not a polygon: LineString"):
        readers.read_polygons(spark, str(odd)).collect()


def test_vanished_binary_files_end_the_job_or_are_passed_over(spark, tmp_path):
    for name in ("a.gz", "b.gz"):
        (tmp_path / name).write_bytes(name.encode())
    strict = readers.read_binary(spark, str(tmp_path)).select("content")
    lenient = readers.read_binary(spark, str(tmp_path), skip_bad=True).select("content")
    assert strict.count() == lenient.count() == 2
    strict, lenient = strict.select("*"), lenient.select("*")
    (tmp_path / "b.gz").unlink()
    assert [bytes(r.content) for r in lenient.collect()] == [b"a.gz"]
    with pytest.raises(Exception, match="b.gz|FILE_NOT_EXIST"):
        strict.collect()
