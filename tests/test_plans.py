"""Repair, incremental windows, publication, features and streams, end to end on small tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyfold.plans import incremental, store
from tallyfold.plans.contracts import RunIdentity
from tallyfold.plans.repair import Repair
from tallyfold.sources import features
from tallyfold.streaming import changes

D = lambda d: dt.datetime(2024, 1, d)


def test_repair_end_to_end(spark, tmp_path):
    s = spark.createDataFrame([(1, D(1), "a"), (2, D(5), "b"), (4, D(2), None)], "key long, changed timestamp_ntz, v string")
    t = spark.createDataFrame([(1, D(1), "a"), (2, D(1), "old"), (5, D(1), "gone"), (6, D(1), "moved")], "key long, changed timestamp_ntz, v string")
    me = RunIdentity("i", "s", "t", "x")
    run = Repair(spark, str(tmp_path / "run"), me)
    plan = {r.key: r.action for r in run.prepare(s.select("key", "changed"), t.select("key", "changed"), F.lit(D(9))).collect()}
    assert plan == {1: "equal", 2: "update", 4: "insert", 5: "remove", 6: "remove"}
    later = t.withColumn("changed", F.when(F.col("key") == 6, F.lit(D(3))).otherwise(F.col("changed")))
    out = {r.key: r.outcome for r in run.apply(s, later, "1", ["v"]).collect()}
    assert out == {2: "written", 4: "written"}
    now = store.current(spark, str(tmp_path / "run" / "target"))
    assert sorted((r.key, r.v) for r in now.collect()) == [(1, "a"), (2, "b"), (4, None), (6, "moved")]
    again = Repair(spark, str(tmp_path / "run"), me)  # a resumed run reads the same diff
    assert again.prepare(s.limit(0), t.limit(0), F.lit(D(9))).count() == 5
    assert run.verify(s, now.where("key <> 6"), F.lit(D(9))) == {"source_eligible": 3, "equal": 3, "updates": 0, "inserts": 0, "removals": 0, "warnings": 0}
    with pytest.raises(ValueError):
        Repair(spark, str(tmp_path / "run"), RunIdentity("other", "s", "t", "x"))


def test_incremental_windows(spark, tmp_path):
    rows = [(i, D(1 + i // 3)) for i in range(9)]
    src = spark.createDataFrame(rows, "k long, c timestamp_ntz")
    load = incremental.IncrementalLoad(spark, str(tmp_path / "w"), "c", ["k"], "f")
    with pytest.raises(ValueError):
        load.run(src, lambda df: None)
    with pytest.raises(ValueError):
        load.bootstrap(None)
    load.bootstrap(None, acknowledged=True)
    got = []
    take = lambda df: got.extend(r.k for r in df.collect())
    assert load.run(src, take)["rows"] == 9 and sorted(got) == list(range(9))
    more = src.union(spark.createDataFrame([(9, D(3)), (10, D(7)), (-1, D(3))], "k long, c timestamp_ntz"))
    got.clear()

    def fails(df):
        raise RuntimeError("down")

    with pytest.raises(RuntimeError):
        load.run(more, fails)
    later = more.where("k <> 10")  # the window is frozen: its snapshot is applied although the row is gone
    assert load.run(later, take)["lower"] == ["2024-01-07 00:00:00", "10"] and sorted(got) == [9, 10]
    assert load.adapt(src) == "2024-01-03 00:00:00"
    with pytest.raises(ValueError):
        incremental.IncrementalLoad(spark, str(tmp_path / "w"), "c", ["k"], "other").state()
    assert incremental.effective_lower(True, 1, 2, False, 3) == (None, "full load")
    assert incremental.effective_lower(False, 1, 2, True, 3)[0] == 3 and incremental.effective_lower(False, 1, 2, False, 3)[0] == 2 and incremental.effective_lower(False, 1, None, False, 3)[0] == 3


def test_publication(spark, tmp_path):
    root = str(tmp_path / "p")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    store.publish(a, root, "1")

    def refuse(df):
        raise ValueError("bad")

    with pytest.raises(ValueError):
        store.publish(a.union(a), root, "2", check=refuse)
    assert store.current(spark, root).count() == 1
    store.publish(a.union(a), root, "2")
    assert store.current(spark, root).count() == 2
    with pytest.raises(FileNotFoundError):
        store.current(spark, str(tmp_path / "none"))
    folder = store.Folder(spark, root)
    with folder.lock():
        with pytest.raises(RuntimeError), folder.lock():
            pass
    with folder.lock():
        pass
    path = str(tmp_path / "scoped")
    b = spark.createDataFrame([(1, "a"), (2, "b")], "k int, scope string")
    store.replace_scope(b, path, "scope")
    store.replace_scope(spark.createDataFrame([(9, "b")], "k int, scope string"), path, "scope")
    assert sorted((r.k, r.scope) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_features(spark, tmp_path):
    layer = features.LayerSpec("l", integers=("n",), dates=("d",), texts=("t",))
    f = lambda i, n, t: {"id": i, "properties": {"n": n, "d": "2024-05-01T10:00:00Z", "t": t}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    for p, fs in enumerate(([f("a", "1", "x"), f("b", None, "y")], [f("b", None, "y"), f("c", "3", None)])):
        (tmp_path / f"{p}.json").write_text(json.dumps({"type": "FeatureCollection", "features": fs}))
    got = features.geojson_pages(spark, str(tmp_path / "*.json"), layer)
    assert sorted((r.feature_id, r.n, r.t) for r in got.collect()) == [("a", 1, "x"), ("b", None, "y"), ("c", 3, None)]
    features.assert_exact_ids(got.select("feature_id"), got, "feature_id")
    with pytest.raises(ValueError):
        features.assert_exact_ids(got.select("feature_id"), got.where("feature_id <> 'a'"), "feature_id")
    (tmp_path / "2.json").write_text(json.dumps({"features": [f("a", "2", "x")]}))
    with pytest.raises(ValueError):
        features.geojson_pages(spark, str(tmp_path / "*.json"), layer)
    xml = spark.createDataFrame([('<w:FeatureCollection xmlns:w="u" numberMatched="42"/>',)], "value string")
    assert features.matched_count(xml).first().matched == 42
    xsd = spark.createDataFrame([('<s><complexType><sequence><element name="a"/><element name="b"/></sequence></complexType></s>',)], "value string")
    assert [r.name for r in features.element_names(xsd).orderBy("position").collect()] == ["a", "b"]
    (tmp_path / "inv.csv").write_text("feature_id,n\nq,1\nr,2\n")
    assert features.inventory_csv(spark, str(tmp_path / "inv.csv"), "feature_id string, n int").count() == 2
    assert layer.fingerprint() != features.LayerSpec("l", integers=("m",)).fingerprint() and len(layer.schema) == 5


def test_streams(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "ts", "value")
    events.repartition(3, "event_id").write.parquet(str(tmp_path / "in"))
    root = str(tmp_path / "latest")
    stream = changes.read_changes(spark, str(tmp_path / "in"), events.schema, 1)
    sink = changes.upsert_sink(root, ["user_id"], "ts")
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {r.user_id: r.e for r in events.groupBy("user_id").agg(F.max_by("event_id", "ts").alias("e")).collect()}
    assert {r.user_id: r.event_id for r in store.current(spark, root).collect()} == want
    sink(events.limit(1), 0)  # a batch that comes again changes nothing
    assert {r.user_id: r.event_id for r in store.current(spark, root).collect()} == want
    state = changes.latest_state(changes.read_changes(spark, str(tmp_path / "in"), events.schema), "user_id", "ts", ["event_id"])
    q = state.writeStream.format("memory").queryName("latest_state_test").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.user_id: r.event_id for r in spark.table("latest_state_test").collect()} == want
    assert changes.flag_late(events, dt.datetime(2024, 1, 2), "ts").where("late").count() == events.where("ts < '2024-01-02'").count()


def test_reports(spark, tmp_path):
    from tallyfold.plans.reports import read_summary, write_report

    root = str(tmp_path / "r")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    write_report(root, {"rows": a}, {"n": 1}, single_file=True)
    assert read_summary(spark, root) == {"n": 1, "tables": ["rows"]}
    assert spark.read.option("header", True).csv(f"{root}/rows").first().v == "x"
    bad = a.select("k", (F.raise_error(F.lit("down"))).cast("string").alias("v"))
    with pytest.raises(Exception, match="down"):
        write_report(root, {"rows": bad}, {"n": 2})
    assert read_summary(spark, root) is None  # no summary without its tables
