"""Geometry, layers, statistics and plans that no query shows."""

import datetime as dt
import json
import math
import random
import sqlite3
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import timeutil, wkb
from tallyfold.operators import spatial, stats, value
from tallyfold.sources import features, scans
from tallyfold.streaming import changes

# ---- geometry ---------------------------------------------------------------------------------------


def ring_bytes(o, ring, size=2):
    return struct.pack(f"{o}I", len(ring)) + b"".join(struct.pack(f"{o}{size}d", *p, *[9.0] * (size - 2)) for p in ring)


def polygon(rings, o="<", srid=None, z=False):
    kind = 3 | (wkb.HAS_SRID if srid else 0) | (wkb.HAS_Z if z else 0)
    head = (b"\x01" if o == "<" else b"\x00") + struct.pack(f"{o}I", kind) + (struct.pack(f"{o}i", srid) if srid else b"")
    return head + struct.pack(f"{o}I", len(rings)) + b"".join(ring_bytes(o, r, 3 if z else 2) for r in rings)


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]


def test_binary_geometry(spark):
    multi = b"\x01" + struct.pack("<II", 6, 2) + polygon([SQUARE]) + polygon([[(10, 0), (11, 0), (11, 1), (10, 0)]], ">")
    point = b"\x01" + struct.pack("<Iidd", 1 | wkb.HAS_SRID, 3794, 1.5, -2)
    bow = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
    package = b"GP\x00\x03" + struct.pack("<i4d", 3794, 0, 4, 0, 4) + polygon([SQUARE])
    cases = {
        "plain": (polygon([SQUARE, HOLE]), None, "POLYGON", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))", 15.0, None),
        "extended": (polygon([SQUARE], ">", 3794, True), 3794, "POLYGON", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))", 16.0, None),
        "multi": (multi, None, "MULTIPOLYGON", "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0)), ((10 0, 11 0, 11 1, 10 0)))", 16.5, None),
        "point": (point, 3794, "POINT", "POINT (1.5 -2)", 0.0, None),
        "package": (package, 3794, "POLYGON", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))", 16.0, None),
        "bow": (polygon([bow]), None, "POLYGON", "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))", 0.0, "edges of a ring cross"),
        "open": (polygon([SQUARE[:-1]]), None, "POLYGON", "POLYGON ((0 0, 4 0, 4 4, 0 4))", 16.0, "a ring is not closed"),
        "inf": (polygon([[(0, 0), (math.inf, 0), (1, 1), (0, 0)]]), None, "POLYGON", "POLYGON ((0 0, inf 0, 1 1, 0 0))", None, "coordinates are not finite"),
        "short": (polygon([SQUARE])[:-3], None, None, None, None, None),
        "rest": (polygon([SQUARE]) + b"x", None, None, None, None, None),
        "null": (None, None, None, None, None, None),
    }
    df = spark.createDataFrame([(k, None if v[0] is None else bytearray(v[0]), 7) for k, v in cases.items()], "name string, g binary, srid2 int")
    got = {r.name: tuple(r)[2:] for r in wkb.decode(df, "g").collect()}
    assert got == {k: v[1:] for k, v in cases.items()}
    assert wkb.decode(df.limit(0).select("g"), "g").count() == 0


def test_common_areas():
    box = lambda x, y, w, h: f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}))"
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(0.1, 6), rng.uniform(0.1, 6)] for _ in range(2))
        want = max(0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])) * max(0, min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]))
        assert spatial.common_area(box(*a), box(*b)) == pytest.approx(want, abs=1e-9)
    ell = "POLYGON ((0 0, 4 0, 4 1, 1 1, 1 4, 0 4, 0 0))"  # not convex
    assert spatial.polygon_area(ell) == pytest.approx(7) and spatial.common_area(ell, box(0.5, 0.5, 3, 3)) == pytest.approx(0.5 * 3 + 0.5 * 2.5)
    ring = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))"  # a hole, turned the other way or not
    same = "POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))"
    for shape in (ring, same):
        assert spatial.polygon_area(shape) == pytest.approx(12) and spatial.common_area(shape, box(2, 2, 4, 4)) == pytest.approx(3)
    two = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 0, 6 0, 6 1, 5 1, 5 0)))"
    assert spatial.common_area(two, box(0.5, 0, 5, 1)) == pytest.approx(1.0)


def test_coverage_of_all_sizes(spark):
    rng = random.Random(2)
    shapes = [(i, rng.uniform(-100, 100), rng.uniform(-100, 100), 2.0 ** rng.uniform(-3, 7), 2.0 ** rng.uniform(-3, 7)) for i in range(120)]
    wkt = lambda s: f"POLYGON (({s[1]} {s[2]}, {s[1] + s[3]} {s[2]}, {s[1] + s[3]} {s[2] + s[4]}, {s[1]} {s[2] + s[4]}, {s[1]} {s[2]}))"
    df = spark.createDataFrame([(s[0], wkt(s)) for s in shapes] + [(-1, None), (-2, "POLYGON EMPTY")], "id int, wkt string")
    got = spatial.coverage_join(df.withColumnRenamed("id", "a"), df.withColumnRenamed("id", "b"), "a", "b", "wkt", 30).collect()
    want = set()
    for a in shapes:
        for b in shapes:
            w = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
            h = min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2])
            if w > 0 and h > 0 and 100 * w * h / (b[3] * b[4]) >= 30:
                want.add((a[0], b[0]))
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_coverage_of_copies_and_full_cells(spark, monkeypatch):
    """Copies are compared once, boxes without Python, and a cell with many shapes is dealt to several tasks."""
    monkeypatch.setattr(spatial, "BLOCK", 5)
    rng = random.Random(4)
    corners = [(rng.randrange(60), rng.randrange(60), rng.randrange(1, 30), rng.randrange(1, 30)) for _ in range(40)]
    box = lambda x, y, w, h: f"POLYGON (({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}))"
    rows = [(i, *corners[i % 40]) for i in range(120)]
    df = spark.createDataFrame([(r[0], box(*r[1:])) for r in rows], "id int, wkt string")
    join = lambda x, y: spatial.coverage_join(x.withColumnRenamed("id", "a"), y.withColumnRenamed("id", "b"), "a", "b", "wkt", 50)
    got = join(df, df)
    assert "MapInPandas" not in got._jdf.queryExecution().toString()
    want = {}
    for a in rows:
        for b in rows:
            w, h = (min(a[i] + a[i + 2], b[i] + b[i + 2]) - max(a[i], b[i]) for i in (1, 2))
            if w > 0 and h > 0 and 100 * w * h >= 50 * b[3] * b[4]:
                want[a[0], b[0]] = 100 * w * h / (b[3] * b[4])
    got = got.collect()
    assert len(got) == len(want) and {(r.a, r.b): round(r.covered_pct, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    ell = "POLYGON ((0 0, 4 0, 4 1, 1 1, 1 4, 0 4, 0 0))"
    turned = "POLYGON ((0 0, 2 -2, 4 0, 2 2, 0 0))"  # four corners and no box
    mixed = spark.createDataFrame([(1, box(0, 0, 4, 4)), (2, ell), (3, ell), (4, turned), (5, None), (6, "POLYGON ((0 0, 0 0, 0 0, 0 0, 0 0))")], "id int, wkt string")
    got = {(r.a, r.b): round(r.covered_pct, 6) for r in join(mixed, mixed).collect()}
    want = {(i, i): 100 for i in (1, 2, 3, 4)} | {(1, 2): 100, (1, 3): 100, (2, 3): 100, (3, 2): 100, (1, 4): 50}
    assert got == want


# ---- layers -----------------------------------------------------------------------------------------

ROWS = [(None, "n1"), (None, "n2"), *[(k, f"f{k}.{i}") for k in range(10) for i in range(1 + k % 3)]]


def served(low, high, nulls):
    """A service that pages by key (used by name, in the workers)."""
    if nulls:
        return [r for r in ROWS if r[0] is None]
    return [r for r in ROWS if r[0] is not None and (low is None or r[0] > low) and (high is None or r[0] <= high)]


def test_paged_service(spark):
    spark.dataSource.register(features.PagedFeatures)
    bounds = [2, 5]
    counts = [len(served(None, None, True)), *[len(served(a, z, False)) for a, z in ((None, 2), (2, 5), (5, None))]]
    read = lambda **o: spark.read.format("paged_features").options(schema="k long, v string", fetch=f"{__name__}:served", bounds=json.dumps(bounds), **o).load()
    assert sorted(map(str, map(tuple, read(counts=json.dumps(counts)).collect()))) == sorted(map(str, ROWS))
    assert read().rdd.getNumPartitions() == 4
    counts[2] += 1
    with pytest.raises(Exception, match="announced"):
        read(counts=json.dumps(counts)).collect()


def test_geopackage(spark, tmp_path):
    for n in range(2):
        with sqlite3.connect(tmp_path / f"{n}.gpkg") as db:
            db.execute("CREATE TABLE layer (id INTEGER PRIMARY KEY, name TEXT, geom BLOB)")
            db.executemany("INSERT INTO layer VALUES (?, ?, ?)", [(i, f"x{i}", b"GP\x00\x01" + struct.pack("<i", 3794) + polygon([SQUARE])) for i in range(n * 10, n * 10 + 25)])
    df = features.geopackage(spark, str(tmp_path / "*.gpkg"), "layer", "id long, name string, geom binary", rows=10)
    got = wkb.decode(df, "geom").collect()
    assert len(got) == 50 and {(r.srid, r.geom_area) for r in got} == {(3794, 16.0)} and sorted(r.id for r in got)[-1] == 34
    with pytest.raises(ValueError):
        features.geopackage(spark, str(tmp_path / "*.gpkg"), "layer; drop", "id long")


def test_xml_table(spark):
    df = spark.createDataFrame([(1, '<d><row n="1"><a>x</a></row><row><b>2</b></row></d>'), (2, "<d/>")], "k int, value string")
    got = features.xml_rows(df, "row", "_n int, a string, b int").collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 1, 'x', None)", "(1, None, None, 2)"]


def test_jdbc(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = spark.range(100).select(F.col("id").alias("K"), (F.col("id") * 2).alias("V"))
    rows.write.format("jdbc").option("url", url).option("dbtable", "T").save()
    one = scans.jdbc_scan(spark, url, 'SELECT K, V FROM T WHERE V > 100;')
    assert one.count() == 49
    parts = scans.jdbc_scan(spark, url, "SELECT K, V FROM T", key="K", bounds=(0, 100), parts=4)
    assert parts.rdd.getNumPartitions() == 4 and sorted(r.V for r in parts.collect()) == list(range(0, 200, 2))
    with pytest.raises(ValueError):
        scans.jdbc_scan(spark, url, "DELETE FROM T")


# ---- numbers and times ------------------------------------------------------------------------------


def test_exact_percentiles(spark, monkeypatch):
    rng = random.Random(3)
    rows = [("a", rng.choice([1.0, 2.0, rng.random() * 100])) for _ in range(3000)] + [("b", 5.0)] * 500 + [("c", None)] + [("d", 1.0)] + [(None, float(i)) for i in range(101)]
    df = spark.createDataFrame(rows, "g string, v double")
    for buckets in (64, 4):
        monkeypatch.setattr(stats, "BUCKETS", buckets)
        got = {r.g: tuple(r)[1:] for r in stats.exact_percentiles(df, ["g"], "v").collect()}
        want = {r.g: tuple(r.p) for r in df.where("v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, stats.QUANTILES))).alias("p")).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    table = {r.g: r for r in stats.valuation_statistics(df, ["g"], "v").collect()}
    assert table["c"].units == 1 and table["c"].p50 is None and table[None].p50 == 50.0


def test_out_of_range_times_are_kept(spark):
    df = spark.createDataFrame([("2024-02-29 01:02:03Z",), ("2023-02-29 01:02:03",), ("12024-01-01 00:00:00",), (None,)], "t string")
    got = [(r.x.at, r.x.kept) for r in df.select(timeutil.parse_kept(F.col("t")).alias("x")).collect()]
    assert got == [(dt.datetime(2024, 2, 29, 1, 2, 3), None), (None, "2023-02-29 01:02:03"), (None, "12024-01-01 00:00:00"), (None, None)]
    with pytest.raises(Exception, match="bad change time"):
        spark.createDataFrame([("soon",)], "t string").select(timeutil.parse_kept(F.col("t")).alias("x")).collect()


def test_rule_with_several_links_and_missing_parts(spark):
    """Six more cases of the rule: sums, unknown areas, moved links, dangling units, two parcels of one scope."""
    far = dt.datetime(2100, 1, 1)
    d = lambda y: dt.datetime(y, 1, 1)
    dec = lambda x: None if x is None else Decimal(x)
    cases = {1: (1, 1, 90, 3, 70), 2: (1, 2, 90, 3, 90), 3: (1, 3, 90, 3, 3), 4: (2, 1, 90, 3, 3), 5: (3, 1, 90, 3, 3), 6: (1, 1, 15, 3, 0)}
    parcels = spark.createDataFrame([(i, s, p, dec(sh), dec(pr), True, False, dec(w)) for i, (s, p, sh, pr, w) in cases.items()], "id int, scope_id int, parcel_id int, share decimal(20,2), previous decimal(20,2), included boolean, is_insert boolean, expected decimal(20,2)")
    scopes = spark.createDataFrame([(1, 1), (2, 9), (3, 1)], "id int, unit_id int")  # the unit of scope 2 is not there
    units = spark.createDataFrame([(1, None)], "id int, valid_to timestamp_ntz")
    buildings = spark.createDataFrame([(1, 1, 5), (2, 1, 6), (3, 2, 5), (4, 3, 7)], "id int, scope_id int, building_id int")
    parts = spark.createDataFrame([(1, True), (2, True), (3, True), (4, True)], "building_row int, included boolean")
    links = [(1, 1, 5, 12), (2, 1, 6, 8), (3, 2, 5, 0), (4, 3, 5, None)]
    links = spark.createDataFrame([(i, d(2000), far, p, b, dec(a), d(2021)) for i, p, b, a in links], "link_id int, date_from timestamp_ntz, date_to timestamp_ntz, parcel_id int, building_id int, area decimal(20,2), loaded_at timestamp_ntz")
    got = {r.id: (r.actual, r.expected) for r in value.share_minus_area(parcels, scopes, units, buildings, parts, links).collect()}
    assert all(a == w for a, w in got.values()), got


# ---- plans ------------------------------------------------------------------------------------------


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderkey")
    plan = physical(scans.keyset_page(o, ["o_custkey", "o_orderkey"], (500, 100), 10))
    assert "PushedFilters: [Or(GreaterThan(o_custkey,500)" in plan and "TakeOrderedAndProject" in plan


def test_gaps_are_counted_without_expanding_rows(spark, sf):
    from tallyfold.catalogue import QUERIES

    assert "Expand" not in physical(QUERIES["watermark_gaps"](spark, sf))
    assert physical(QUERIES["rule_share_minus_area"](spark, sf)).count("lineitem.parquet") == 1
    assert "Window" not in physical(QUERIES["duplicate_marker"](spark, sf))


def test_small_things(spark, sf, tmp_path):
    df = spark.range(1000)
    assert 50 < scans.sample(df, 0.1, 3).count() < 160 and scans.sample(df, 0.1, 3).count() == scans.sample(df, 0.1, 3).count()
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    t = changes.tumbling(changes.read_changes(spark, str(tmp_path / "in"), events.schema), "ts", "1 hour", "10 minutes", ["event_type"])
    q = t.writeStream.format("memory").queryName("tumbling_test").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("tumbling_test").agg(F.sum("n")).first()[0] == events.count()
