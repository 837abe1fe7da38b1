"""Golden and property tests of rules, guards, time, text and geometry functions."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyfold.functions import digest, geometry, text, timeutil
from tallyfold.operators import delta, quality, stats, temporal, value
from tallyfold.plans import contracts, rewrite
from tallyfold.sources import guards, scans

T0, T5, T9, T10 = (dt.datetime(2024, 1, d) for d in (1, 5, 9, 10))
US = dt.timedelta(microseconds=1)
SEC = dt.timedelta(seconds=1)
INV = "key long, changed timestamp_ntz"


def inv(spark, rows):
    return spark.createDataFrame(rows, INV)


def actions(df):
    return {r.key: r.action for r in df.collect()}


def test_diff_cases(spark):
    s = inv(spark, [(1, T0), (2, T5), (3, T0), (4, T0), (9, T10), (12, T0)])
    t = inv(spark, [(1, T0), (2, T0), (3, T5), (5, T0), (9, T0), (10, T10), (12, T10)])
    assert actions(delta.prepare_diff(s, t, F.lit(T9))) == {1: "equal", 2: "update", 3: "ahead", 4: "insert", 5: "remove", 12: "insert"}
    assert actions(delta.min_date_diff(s, t, F.lit(T0), F.lit(T9))) == {1: "equal", 2: "update", 3: "ahead", 4: "insert", 12: "ahead"}
    out = {r.key: r.outcome for r in delta.apply_recheck(delta.prepare_diff(s, t, F.lit(T9)), s.where("key <> 4"), t).collect()}
    assert out == {2: "written", 4: "disappeared", 12: "ahead"}
    assert actions(delta.prepare_diff(s.limit(0), t.limit(0), F.lit(T9))) == {}


def model(source, target, ahead, behind):
    if source is None:
        return "remove"
    if target is None:
        return "insert"
    gap = target - source
    if abs(gap) <= SEC and ((ahead and gap > dt.timedelta(0)) or (behind and gap < dt.timedelta(0))):
        return "equal"
    return "update" if gap < dt.timedelta(0) else "ahead" if gap > dt.timedelta(0) else "equal"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-2_500_000, 2_500_000)), st.one_of(st.none(), st.integers(-2_500_000, 2_500_000))), min_size=1, max_size=30), st.booleans(), st.booleans())
def test_decision_matches_model(spark, pairs, ahead, behind):
    at = lambda us: None if us is None else T5 + us * US
    df = spark.createDataFrame([(i, at(a), at(b)) for i, (a, b) in enumerate(pairs)], "i int, s timestamp_ntz, t timestamp_ntz")
    got = {r.i: r.d for r in df.select("i", delta.decision(F.col("s"), F.col("t"), ahead, behind).alias("d")).collect()}
    assert got == {i: model(at(a), at(b), ahead, behind) for i, (a, b) in enumerate(pairs)}


def test_leeway_is_inclusive(spark):
    for shift, want in ((SEC, "equal"), (SEC + US, "ahead"), (-SEC, "update")):
        s, t = inv(spark, [(1, T5)]), inv(spark, [(1, T5 + shift)])
        assert actions(delta.classify(s, t, ahead_leeway=True)) == {1: want}
    assert actions(delta.classify(inv(spark, [(1, T5 + SEC)]), inv(spark, [(1, T5)]), behind_leeway=True)) == {1: "equal"}


@pytest.mark.parametrize("rows,what", [([(None, T0)], "null keys"), ([(1, None)], "null times"), ([(1, T0), (1, T5)], "duplicates")])
def test_bad_inventories(spark, rows, what):
    with pytest.raises(delta.ReconciliationError, match=what):
        delta.assert_inventory(inv(spark, rows))
    delta.assert_inventory(inv(spark, [(1, T0), (2, T5)]))


def test_guards_of_mirrors_and_writes(spark):
    some, none = inv(spark, [(1, T0)]), inv(spark, [])
    with pytest.raises(delta.ReconciliationError):
        delta.guard_empty_source(none, some)
    delta.guard_empty_source(some, some)
    delta.guard_empty_source(none, none)
    with pytest.raises(delta.ReconciliationError):
        delta.newer_write_set(inv(spark, [(1, T0)]), inv(spark, [(1, T5)]))
    with pytest.raises(delta.ReconciliationError):
        delta.guard_stable_count(1, 2)
    with pytest.raises(delta.ReconciliationError):
        delta.assert_clean(some)


def test_rule_golden_rows(spark):
    far, old = dt.datetime(2100, 1, 1), dt.datetime(2020, 1, 1)
    cases = {  # id: (scope, parcel, share, previous, included, insert, expected)
        1: (10, 100, 60, 1, True, False, 8), 2: (10, 100, 50, 1, True, False, 0), 3: (10, 999, 60, 1, True, False, 1), 4: (10, 999, 60, 1, True, True, None), 5: (40, 100, 60, 1, True, False, None),
        6: (10, 100, None, 1, True, False, None), 7: (10, 999, None, 1, True, False, 1), 8: (10, 100, 60, 1, False, False, 1), 9: (10, 100, 60, 1, None, False, 1), 10: (20, 100, 60, 1, True, False, 1),
        11: (30, 100, 60, 1, True, False, 1), 12: (10, 101, 60, 1, True, False, 1), 13: (50, 101, 60, 1, True, False, 8), 14: (10, 102, 60, 1, True, False, 20), 15: (10, 103, 60, 1, True, False, 50), 16: (10, 104, 60, 1, True, False, 60),
        17: (10, 105, 60, 1, True, False, 55), 18: (10, 106, 60, 1, True, False, 1),
    }
    dec = lambda x: None if x is None else Decimal(x)
    parcels = spark.createDataFrame([(i, s, p, dec(sh), dec(pr), inc, ins, dec(e)) for i, (s, p, sh, pr, inc, ins, e) in cases.items()], "id int, scope_id int, parcel_id int, share decimal(20,2), previous decimal(20,2), included boolean, is_insert boolean, expected decimal(20,2)")
    scopes = spark.createDataFrame([(10, 1), (20, 1), (30, 1), (40, None), (50, 2)], "id int, unit_id int")
    units = spark.createDataFrame([(1, None), (2, old)], "id int, valid_to timestamp_ntz")
    buildings = spark.createDataFrame([(1, 10, 7), (2, 10, 7), (3, 20, 8), (4, 30, 7), (5, 50, 7), (6, 10, 9)], "id int, scope_id int, building_id int")
    parts = spark.createDataFrame([(1, True), (1, True), (2, True), (3, True), (4, False), (5, True), (6, True)], "building_row int, included boolean")
    d = lambda y: dt.datetime(y, 1, 1)
    links = [
        (1, d(2000), far, 100, 7, 52, d(2021)), (2, d(2000), old, 101, 7, 52, d(2021)), (3, d(2000), far, 102, 7, 99, d(2020)), (3, d(2000), far, 102, 7, 40, d(2021)), (4, d(2000), far, 103, 7, 4, d(2021)), (5, d(2000), far, 103, 9, 6, d(2021)),
        (6, d(2000), far, 104, 7, 0, d(2021)), (7, d(2000), far, 105, 7, None, d(2021)), (8, d(2000), far, 105, 9, 5, d(2021)), (9, d(2000), far, 106, 7, 30, d(2020)), (9, d(2000), far, 555, 7, 30, d(2021)),
    ]
    links = spark.createDataFrame([(*r[:5], dec(r[5]), r[6]) for r in links], "link_id int, date_from timestamp_ntz, date_to timestamp_ntz, parcel_id int, building_id int, area decimal(20,2), loaded_at timestamp_ntz")
    got = {r.id: r for r in value.share_minus_area(parcels, scopes, units, buildings, parts, links).collect()}
    assert {i: r.actual for i, r in got.items()} == {i: r.expected for i, r in got.items()}


def tier_model(v):
    if v < 0:
        return None
    step = Decimal(1) if v <= 100 else Decimal(10) if v <= 10_000 else Decimal(100) if v <= 500_000 else Decimal(1000)
    return (v / step).quantize(Decimal(1), rounding=ROUND_HALF_UP) * step


@settings(max_examples=10, deadline=None)
@given(st.lists(st.decimals(-10, 10**9, places=2), min_size=1, max_size=40))
def test_round_tiers(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, Decimal(100), Decimal("100.5"), Decimal(10_000), Decimal(500_000), Decimal("0.5")])], "i int, v decimal(20,2)")
    for r in df.select("v", value.round_tiers(F.col("v")).alias("r")).collect():
        assert r.r == tier_model(r.v)


def test_status_and_sums(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("1.01"), False, False), (Decimal("1.00"), Decimal("1.02"), False, False), (None, Decimal(1), None, None), (Decimal(1), None, False, None), (None, None, True, True), (Decimal(0), None, False, True)], "a decimal(10,2), b decimal(10,2), ea boolean, eb boolean")
    got = [r[0] for r in df.select(value.compare_status(F.col("a"), F.col("b"), F.lit(Decimal("0.01")), F.col("ea"), F.col("eb"))).collect()]
    assert got == ["EQUAL", "DIFFERENT", "MISSING_A", "MISSING_B", "ERROR_A", "ERROR_B"]
    assert df.agg(value.whole_sum("a")).first()[0] is None
    with pytest.raises(ValueError):
        value.assert_explained(spark.createDataFrame([(Decimal(1),)], "unexplained decimal(5,2)"))


# ---- time -------------------------------------------------------------------------------------------

ZONE = "Europe/Vienna"


def local_model(t):
    z = ZoneInfo(ZONE)
    hits = {t.replace(tzinfo=z, fold=f).astimezone(dt.UTC) for f in (0, 1)}
    hits = [h for h in hits if h.astimezone(z).replace(tzinfo=None) == t]
    return {0: "gap", 1: "ok", 2: "overlap"}[len(hits)], (hits[0].replace(tzinfo=None) if len(hits) == 1 else None)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.datetimes(dt.datetime(2015, 1, 1), dt.datetime(2030, 1, 1)), max_size=20))
def test_local_times(spark, times):
    edges = [dt.datetime(2026, 3, 29, 2, 30), dt.datetime(2026, 3, 29, 1, 59, 59), dt.datetime(2026, 3, 29, 3), dt.datetime(2026, 10, 25, 2, 30), dt.datetime(2026, 10, 25, 2), dt.datetime(2026, 10, 25, 3), dt.datetime(2026, 10, 25, 1, 59, 59), dt.datetime(2026, 7, 1, 2)]
    df = spark.createDataFrame([(t,) for t in times + edges], "t timestamp_ntz")
    for r in df.select("t", timeutil.local_status(F.col("t"), ZONE).alias("s"), timeutil.local_to_utc(F.col("t"), ZONE).alias("u")).collect():
        status, utc = local_model(r.t)
        assert r.s == status and (status != "ok" or r.u == utc)
    with pytest.raises(PySparkException):
        df.where("t = timestamp_ntz'2026-03-29 02:30:00'").select(timeutil.local_to_utc_strict(F.col("t"), ZONE)).collect()


def test_change_times(spark):
    good = {"2024-05-06 07:08:09": "2024-05-06 07:08:09.000000", "2024-05-06T07:08:09.5Z": "2024-05-06 07:08:09.500000", "2024-05-06 07:08:09.123456000+02:00": "2024-05-06 05:08:09.123456", "2024-01-01 00:10:00-0130": "2024-01-01 01:40:00.000000"}
    df = spark.createDataFrame([(k,) for k in good], "t string")
    got = {r.t: r.u for r in df.select("t", F.date_format(timeutil.parse_change_time(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("u")).collect()}
    assert got == good
    for bad in ("2024-05-06 07:08:09.1234567", "yesterday", None, ""):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(bad,)], "t string").select(timeutil.parse_change_time(F.col("t"))).collect()
    r = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 1, 1, 0, 0, 0, 499999))], "a timestamp_ntz, b timestamp_ntz").select(timeutil.round_seconds(F.col("a")), timeutil.round_seconds(F.col("b"))).first()
    assert (r[0].second, r[1].second) == (1, 0)


# ---- text, geometry, guards ------------------------------------------------------------------------


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text(spark):
    assert one(spark, *text.split_key(F.lit("a-b-12-007"), 3))[:] == ("a-b", "12", "007")
    assert one(spark, text.text_key(F.lit(1), F.lit(None).cast("int")), text.text_key(F.lit(1), F.lit(2)))[:] == (None, "1-2")
    assert one(spark, text.header_version(F.lit("x Version: 12 y")), text.header_version(F.lit("none")))[:] == (12, None)
    assert one(spark, text.plausible_year(F.lit(1990), F.lit(2000)), text.plausible_year(F.lit(0), F.lit(1)), text.plausible_year(F.lit(2001), F.lit(2000)))[:] == (None, None, 2001)
    for literal, want in {"{}": [], "{a}": ["a"], '{a,"b, c",NULL,"d\\"e"}': ["a", "b, c", None, 'd"e']}.items():
        assert one(spark, text.parse_array_literal(F.lit(literal)))[0] == want
    with pytest.raises(PySparkException):
        one(spark, text.zip_components(F.array(F.lit("a")), F.array(F.lit("1"), F.lit("2"))))
    assert one(spark, text.letter_prefix(F.lit("AB12")))[0] == "AB"


def test_geometry(spark):
    p = "POLYGON ((0 0, 1.5 0, 1 -2e0, 0 0))"
    r = one(spark, geometry.to_multipolygon(F.lit(p)), geometry.bounds(F.lit("SRID=3794;" + p)), geometry.finite(F.lit(p)), geometry.finite(F.lit("POINT (nan 1)")), geometry.finite(F.lit("POINT EMPTY")), geometry.join_polygons(F.lit(p + p)), geometry.geometry_type(F.lit("srid=1;point (1 2)")), geometry.point_square(F.lit(1.0), F.lit(2.0)))
    assert r[0] == "MULTIPOLYGON (((0 0, 1.5 0, 1 -2e0, 0 0)))" and tuple(r[1]) == (0.0, -2.0, 1.5, 0.0) and r[2] and not r[3] and not r[4]
    assert r[5] == "MULTIPOLYGON (((0 0, 1.5 0, 1 -2e0, 0 0)), ((0 0, 1.5 0, 1 -2e0, 0 0)))" and r[6] == "POINT"
    assert r[7] == "POLYGON ((0.975 1.975, 1.025 1.975, 1.025 2.025, 0.975 2.025, 0.975 1.975))"
    good, bad = geometry.quarantine(spark.createDataFrame([(p,), (None,), ("POINT (1 2)",)], "g string"), "g", ("POLYGON",))
    assert good.count() == 1 and bad.count() == 2


def test_sql_guards():
    assert guards.single_select(" select ';' as x ; ; ") == "select ';' as x"
    for bad in ("select 1; select 2", "delete from t", "", "-- select\ndrop table x"):
        with pytest.raises(ValueError):
            guards.single_select(bad)
    assert [guards.user_filter(x) for x in (None, " null ", "WHERE true;", "where a = 'x;y' ;")] == [None, None, None, "a = 'x;y'"]
    for bad in ("a in (select 1)", "1=1; drop table t"):
        with pytest.raises(ValueError):
            guards.user_filter(bad)
    with pytest.raises(ValueError):
        guards.identifier("a;b")


def test_contracts(spark):
    spec = contracts.TableSpec("t", "x.t", "id_key", ("id_key",), "changed")
    s = spark.createDataFrame([], "id_key long, changed timestamp_ntz, a string, page2 int").schema
    t = spark.createDataFrame([], "id string, id_key long, changed timestamp_ntz, a string, created_at timestamp").schema
    with pytest.raises(ValueError):
        spec.check(s, t)
    assert contracts.TableSpec("t", "x.t", "id_key", ("id_key", "page2"), "changed").check(s, t) == ["id_key", "changed", "a"]
    with pytest.raises(ValueError):
        contracts.TableSpec("t", "x.t", "k", ("a", "a"))
    f = contracts.FieldMapping
    contracts.Definition("d", (f("a", "x", "int", is_key=True), f("b", "y", "date", is_changed=True)))
    for bad in ((f("a", "x", "int"),), (f("a", "x", "int", True), f("b", "y", "int", True)), (f("a", "x", "int", True), f("a", "y", "date", False, True)), (f("a", "x", "geometry", True), f("b", "y", "geometry", False, True))):
        with pytest.raises(ValueError):
            contracts.Definition("d", bad)
    assert quality.schema_drift(s, t) == [("created_at", "extra"), ("id", "extra"), ("page2", "missing")]
    with pytest.raises(ValueError):
        contracts.require_same_schema(s, t)
    with pytest.raises(ValueError):
        contracts.single_watermark([{"is_watermark": True, "utc": False}])
    a, b = (contracts.RunIdentity("i", "s", "t", x).fingerprint() for x in ("1", "2"))
    assert a != b and contracts.schema_fingerprint(s) == contracts.schema_fingerprint(s)


def test_digests(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    for f in (digest.payload_digest, digest.row_digest):
        assert df.select(f("x", "y")).distinct().count() == 3
    u = one(spark, digest.stable_uuid("n", F.lit("1")), digest.stable_uuid("n", F.lit("2")))
    assert u[0] != u[1] and len(u[0]) == 36 and u[0][14] == "5" and u[0][19] in "89ab"


def test_rewrites_and_lookups(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, None, 6)], "id long, x string, v long")
    s = spark.createDataFrame([(1, None, 7), (3, "n", 8)], "id long, x string, v long")
    assert sorted(map(tuple, rewrite.upsert(t, s, ["id"]).collect())) == [(1, "a", 7), (2, None, 6), (3, "n", 8)]
    assert sorted(map(tuple, rewrite.upsert(t, s, ["id"], omit_null=False, immutable=("v",)).collect()), key=str) == [(1, None, 5), (2, None, 6), (3, "n", 8)]
    assert sorted(map(tuple, rewrite.delete_keys(t, s, ["id"]).collect())) == [(2, None, 6)]
    assert "WHEN MATCHED AND (t.v IS NULL OR s.v > t.v)" in rewrite.merge_sql("t", "s", ["id"], ["x", "v"], "v")
    with pytest.raises(ValueError):
        rewrite.clone_row(t, s)
    with pytest.raises(KeyError):
        quality.require_found(quality.lookup_with_presence(t, s.select("id", F.col("x").alias("c")), ["id"], "c"))
    with pytest.raises(ValueError):
        quality.collapse_identical(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), ["k"])
    with pytest.raises(ValueError):
        scans.payload(t.union(t), s, ["id"])
    with pytest.raises(ValueError):
        scans.describe(t, ["nope"])
    assert scans.keyset_page(t, ["id"], None, 1).first().id == 1 and scans.series(spark, 0, 5).count() == 5
    assert scans.column_facts(t, "t").count() == 3


def test_null_and_empty_tables(spark):
    e = inv(spark, [])
    for f in (delta.anomalies, delta.classify, delta.plan_changes, delta.gap_cohorts):
        assert f(e, e).count() == 0
    assert delta.mirror_stats(delta.mirror_delta(e, e)).first().source == 0
    assert stats.timestamp_ties(e, "changed", 10).count() == 0
    assert quality.parity(e, e, "changed", F.lit(T5)).first().source_rows == 0
    h = spark.createDataFrame([(1, None, None), (1, T0, None), (1, T0, T5)], "k int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert temporal.as_of(h, F.lit(T5)).count() == 1 and temporal.as_of(h, F.lit(T0)).count() == 2
    assert temporal.open_versions(h, far="2024-01-05").count() == 3


def test_positive_control(spark):
    """A wrong value that is put in must be found."""
    a = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    b = a.withColumn("v", F.when(F.col("id") == 17, "wrong").otherwise(F.col("v")))
    hit = [r for r in quality.row_compare(a, b, ["id"], ["v"]).collect() if r.changed_columns]
    assert [(r.id, r.changed_columns) for r in hit] == [(17, ["v"])]
