"""What a crash, a repeated run, a missing manifest or a row without a time must not do."""

import datetime as dt
import os
import shutil
import threading
import time

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import delta, quality
from tallyfold.plans import incremental, mirror, repair, rewrite, store, sync
from tallyfold.plans.contracts import RunIdentity
from tallyfold.sources import scans
from tallyfold.streaming import changes

D = lambda d: dt.datetime(2024, 1, d)
INV = "key long, changed timestamp_ntz"


def inv(spark, rows):
    return spark.createDataFrame(rows, INV)


def test_a_window_is_applied_once(spark, tmp_path):
    src = spark.createDataFrame([(i, D(1 + i // 3)) for i in range(9)], "k long, c timestamp_ntz")
    load = incremental.IncrementalLoad(spark, str(tmp_path / "w"), "c", ["k"], "f")
    load.bootstrap(None, acknowledged=True)
    sizes = []
    take = lambda df: sizes.append(df.count())
    for _ in range(3):
        load.run(src, take)
    assert sizes == [9]
    assert load.run(src.where("k < 5"), take)["rows"] == 0 and sizes == [9]  # the source went back
    assert load.run(src.union(spark.createDataFrame([(10, D(3))], src.schema)), take)["rows"] == 1
    assert load.run(src, take, full=True) == {"rows": 9, "lower": ["2024-01-03 00:00:00", "8"], "why": "full load"}
    assert load.run(src, take)["rows"] == 0


def test_switched_change_column_falls_back(spark, tmp_path):
    src = spark.createDataFrame([(i, D(1 + i), D(11 + i)) for i in range(4)], "k long, c timestamp_ntz, d timestamp_ntz")
    load = incremental.IncrementalLoad(spark, str(tmp_path / "w"), "c", ["k"], "f")
    load.bootstrap(None, acknowledged=True)
    load.run(src, lambda df: None)
    other = incremental.IncrementalLoad(spark, str(tmp_path / "w"), "d", ["k"], "f")
    got = other.run(src, lambda df: None, fallback=["2024-01-12 00:00:00", None])
    assert (got["rows"], got["why"]) == (2, "change column switched")


def manifests(root):
    return sorted(x for x in os.listdir(root) if x.startswith(store.MANIFEST))


def test_manifest_is_old_or_new(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "p")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    store.publish(a, root, "1")
    real = store.Folder.rename

    def dies(self, old, new):
        if new.startswith(store.MANIFEST):
            raise KeyboardInterrupt
        real(self, old, new)

    monkeypatch.setattr(store.Folder, "rename", dies)
    with pytest.raises(KeyboardInterrupt):
        store.publish(a.union(a), root, "1")  # the same version again
    assert store.current(spark, root).count() == 1
    monkeypatch.undo()
    store.publish(a.union(a), root, "1")
    assert store.current(spark, root).count() == 2
    store.verify_published(spark, root)
    assert len(store.expire(spark, root)) == 2 and store.current(spark, root).count() == 2
    for _ in range(6):
        store.publish(a, root, "9")
    assert len(manifests(root)) <= store.KEPT_TEXTS + 1 and store.current(spark, root).count() == 1


def test_missing_manifest_is_no_first_batch(spark, tmp_path):
    root = str(tmp_path / "s")
    sink = changes.upsert_sink(root, ["key"], "changed", buckets=4)
    sink(inv(spark, [(i, D(1)) for i in range(5)]), 0)
    sink(inv(spark, [(2, D(3)), (3, dt.datetime(2023, 1, 1)), (7, D(2))]), 1)
    assert sorted((r.key, r.changed) for r in store.current(spark, root).collect()) == [(0, D(1)), (1, D(1)), (2, D(3)), (3, D(1)), (4, D(1)), (7, D(2))]
    kept = {x: open(f"{root}/{x}").read() for x in manifests(root)}
    for x in kept:
        os.remove(f"{root}/{x}")
    with pytest.raises(RuntimeError, match="no manifest"):
        sink(inv(spark, [(9, D(9))]), 2)
    with pytest.raises(RuntimeError, match="no manifest"):
        store.publish(inv(spark, []), root, "3")


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "b")
    merge = lambda old, new: rewrite.upsert_if_newer(old, new, ["key"], "changed")
    assert store.rewrite_buckets(inv(spark, [(i, D(1)) for i in range(100)]), root, "1", ["key"], merge, 8) == 8
    assert store.rewrite_buckets(inv(spark, [(5, D(2))]), root, "2", ["key"], merge, 8) == 1
    assert store.rewrite_buckets(inv(spark, []), root, "3", ["key"], merge, 8) == 0
    assert store.expire(spark, root) == []  # both folders still hold buckets
    now = store.current(spark, root)
    assert now.count() == 100 and now.where("key = 5").first().changed == D(2)
    drop = lambda old, new: old.join(new, "key", "left_anti")
    store.rewrite_buckets(inv(spark, [(i, None) for i in range(100)]), root, "4", ["key"], drop, 8)
    assert store.current(spark, root).count() == 0 and len(store.expire(spark, root)) == 3


def test_written_rows_are_the_planned_ones(spark, tmp_path):
    root = str(tmp_path / "k")
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    store.publish(a, root, "1", planned=2)
    with pytest.raises(store.WriteMismatch):
        store.publish(a, root, "2", planned=3)
    assert store.current(spark, root).count() == 2
    maps = spark.createDataFrame([(1, {"a": 1}), (2, None)], "k int, m map<string,int>")
    store.publish(maps, str(tmp_path / "maps"), "1", planned=2)
    store.verify_published(spark, str(tmp_path / "maps"))
    part = next(p for p in (tmp_path / "k" / "v=1").iterdir() if p.name.endswith(".parquet"))
    shutil.rmtree(tmp_path / "k" / "v=1")
    spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string").write.parquet(str(part.parent))
    with pytest.raises(store.WriteMismatch):
        store.verify_published(spark, root)


def test_locks_of_dead_writers_are_taken_over(spark, tmp_path):
    folder = store.Folder(spark, str(tmp_path / "l"))
    with folder.lock(lease=60) as live:
        live.check()
        with pytest.raises(RuntimeError), folder.lock(lease=60):
            pass
        os.utime(tmp_path / "l" / "_LOCK", (1, 1))  # as if it had not been renewed for long
        with folder.lock(lease=60) as heir:
            heir.check()
            with pytest.raises(RuntimeError):
                live.check()
    assert not (tmp_path / "l" / "_LOCK").exists()
    with folder.lock(lease=0.8):
        time.sleep(1.2)
        with pytest.raises(RuntimeError), folder.lock(lease=0.8):  # it renews itself
            pass


def test_two_writers_do_not_publish_at_once(spark, tmp_path):
    root, errors = str(tmp_path / "two"), []
    a = spark.createDataFrame([(1,)], "k int")

    def slow(_):
        with pytest.raises(RuntimeError, match="another writer"):
            store.publish(a, root, "2")
        errors.append(1)

    t = threading.Thread(target=store.publish, args=(a, root, "1", slow))
    t.start()
    t.join()
    assert errors == [1] and store.current(spark, root).count() == 1


def test_a_source_row_without_a_time_is_never_removed(spark):
    s, t = inv(spark, [(1, None), (2, D(1)), (3, D(1))]), inv(spark, [(1, D(1)), (2, None), (4, D(1)), (5, None)])
    want = {1: "undated", 2: "undated", 3: "insert", 4: "remove", 5: "remove"}
    for df in (delta.classify(s, t), delta.prepare_diff(s, t, F.lit(D(9)))):
        assert {r.key: r.action for r in df.collect()} == want
    assert {r.key: r.action for r in delta.min_date_diff(s, t, F.lit(D(1)), F.lit(D(9))).collect()} == {2: "undated", 3: "insert"}


def test_mirror_refresh(spark, tmp_path):
    root, rows = str(tmp_path / "m"), [(1, D(1)), (2, D(1)), (2, D(1)), (3, None)]
    read = lambda: inv(spark, rows)
    assert mirror.refresh(spark, read, root, "1")["inserted"] == 3
    rows[:] = [(1, D(2)), (2, D(1))]
    assert mirror.refresh(spark, read, root, "2") == {"source": 2, "wanted": 1, "inserted": 0, "updated": 1, "unchanged": 1, "deleted": 1}
    rows[:] = []
    with pytest.raises(delta.ReconciliationError, match="empty"):
        mirror.refresh(spark, read, root, "3")
    with pytest.raises(delta.ReconciliationError):
        delta.mirror_delta(read(), store.current(spark, root))
    rows[:] = [(1, D(1)), (1, D(2))]
    with pytest.raises(ValueError, match="differ"):
        mirror.refresh(spark, read, root, "3")
    with pytest.raises(Exception, match="rows with one key differ"):
        delta.mirror_delta(read(), store.current(spark, root)).collect()
    calls = []

    def grows():
        calls.append(1)
        return inv(spark, [(1, D(1))] if len(calls) == 1 else [(1, D(1)), (2, D(1))])

    with pytest.raises(delta.ReconciliationError, match="changed during"):
        mirror.refresh(spark, grows, root, "4")
    assert store.current(spark, root).count() == 2


SYNC = "id long, changed timestamp_ntz, v string"


def test_safe_sync(spark, tmp_path):
    staging = spark.createDataFrame([(1, D(1), "a"), (2, D(5), "new"), (3, D(2), "c"), (9, None, "n")], SYNC)
    production = spark.createDataFrame([(1, D(1), "a"), (2, D(1), "old"), (4, D(1), "gone"), (9, None, "n")], SYNC)
    run = lambda name: sync.SafeSync(spark, str(tmp_path / name), "id", "changed", ["v"])
    r, target = run("one"), str(tmp_path / "target")
    r.freeze(staging)
    assert r.preflight(production) == {"insert": 1, "update": 1, "delete": 1, "unchanged": 2}
    with pytest.raises(sync.Moved):
        r.apply(staging.withColumn("v", F.upper("v")), production, target, "1")
    with pytest.raises(sync.Moved):
        r.apply(staging, production.withColumn("v", F.when(F.col("id") == 2, "touched").otherwise(F.col("v"))), target, "1")
    with pytest.raises(sync.Moved):
        r.apply(staging, production.union(spark.createDataFrame([(3, D(1), "other")], SYNC)), target, "1")
    r.apply(staging, production, target, "1")
    applied = store.current(spark, target)
    rows = lambda df: sorted((x.id, x.v) for x in df.collect())
    assert rows(applied) == [(1, "a"), (2, "new"), (3, "c"), (4, "gone"), (9, "n")]
    r.apply(staging, applied, target, "1b")  # a replay changes nothing
    assert rows(store.current(spark, target)) == rows(applied)
    with pytest.raises(sync.Moved, match="nothing is deleted"):
        r.delete(staging.where("id <> 1"), applied, target, "2")
    with pytest.raises(sync.Moved):
        r.delete(staging, applied.withColumn("v", F.when(F.col("id") == 4, "touched").otherwise(F.col("v"))), target, "2")
    r.delete(staging, applied, target, "2")
    assert rows(store.current(spark, target)) == [(1, "a"), (2, "new"), (3, "c"), (9, "n")]
    newer = run("two")
    newer.freeze(staging)
    with pytest.raises(delta.ReconciliationError, match="newer"):
        newer.preflight(production.withColumn("changed", F.lit(D(9))))
    with pytest.raises(delta.ReconciliationError, match="newer"):
        newer.preflight(production)  # the persisted preflight still holds the conflict
    with pytest.raises(delta.ReconciliationError):
        run("three").freeze(staging.union(staging))


def test_other_leeways_clear_the_diff(spark, tmp_path):
    s, t = inv(spark, [(1, D(1))]), inv(spark, [(1, D(1) + dt.timedelta(seconds=1))])
    me = RunIdentity("i", "s", "t", "x")
    one = repair.Repair(spark, str(tmp_path / "r"), me)
    assert one.prepare(s, t, F.lit(D(9))).first().action == "ahead"
    assert repair.Repair(spark, str(tmp_path / "r"), me).prepare(s.limit(0), t, F.lit(D(9))).first().action == "ahead"
    other = repair.Repair(spark, str(tmp_path / "r"), me, ahead_leeway=True)
    assert other.prepare(s, t, F.lit(D(9))).first().action == "equal"
    other.apply(s, t, "1", [])
    with pytest.raises(ValueError, match="other leeways"):
        repair.Repair(spark, str(tmp_path / "r"), me)


def test_checked_upsert(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "id long, x string, v long")
    ok = spark.createDataFrame([(1, "n", 6), (2, "m", 1), (3, "z", None)], "id long, x string, v long")
    assert sorted(map(tuple, rewrite.checked_upsert(t, ok, ["id"], "v").collect())) == [(1, "n", 6), (2, "m", 1), (3, "z", None)]
    for bad in ([(1, "n", 5)], [(1, "n", None)], [(3, "n", 5), (3, "n", 5)]):
        with pytest.raises(Exception, match="planned row"):
            rewrite.checked_upsert(t, spark.createDataFrame(bad, ok.schema), ["id"], "v").collect()


def test_numbers_follow_the_keys(spark):
    rows = [(k * 7919 % 10_007, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "k long, x long").repartition(7)
    got = {r.k: (r.gid, r["__mod"]) for r in rewrite.number_rows(df, ["k"], modulus=1000).collect()}
    assert got == {k: (i + 1, (i + 1) % 1000) for i, k in enumerate(sorted(k for k, _ in rows))}
    assert rewrite.number_rows(df.limit(0), ["k"]).count() == 0


def test_families_are_copied_once(spark):
    p = spark.createDataFrame([("a", None, 1), ("b", None, 2)], "id string, origin string, v int")
    c = spark.createDataFrame([("x", "a", None), ("y", "a", None), ("z", "b", None)], "id string, parent string, origin string")
    wanted = spark.createDataFrame([("a",), ("a",)], "id string")
    for _ in range(2):
        p, c = rewrite.copy_family(p, c, wanted, "id", "parent", "ns")
    assert p.count() == 3 and c.count() == 5
    new = p.where("origin = 'a'").first()
    assert new.v == 1 and {r.origin for r in c.where(F.col("parent") == new.id).collect()} == {"x", "y"}


def test_payload_guards(spark):
    wanted = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    fine = spark.createDataFrame([(1, "UPSERT"), (2, None)], "k long, op string")
    assert scans.checked_payload(fine, wanted, ["k"], "op").count() == 2
    for bad, what in (([(3, None)], "unrequested keys: 1"), ([(1, None), (1, None)], "several rows: 1"), ([(1, "DELETE")], "current rows: 1")):
        with pytest.raises(ValueError, match=what):
            scans.checked_payload(spark.createDataFrame(bad, fine.schema), wanted, ["k"], "op")


def test_invariants_fail_loudly(spark):
    s = inv(spark, [(1, D(1)), (2, None)])
    with pytest.raises(Exception, match="do not add up"):
        delta.date_movement(s, inv(spark, [(1, D(1)), (2, D(2))]), F.lit(D(1))).collect()
    got = delta.window_movement(inv(spark, [(1, D(3)), (2, D(3)), (3, D(1))]), inv(spark, [(1, D(2)), (4, D(5)), (3, D(4))]), F.lit(D(3))).first().asDict()
    assert got == {"old_rows": 2, "new_rows": 2, "new_keys": 2, "absent": 1, "moved_below": 1}


def test_audit_proves_itself(spark):
    s = spark.createDataFrame([(1, 5, "a"), (2, None, "b")], "k long, n long, t string")
    t = spark.createDataFrame([(1, 5, "a"), (2, 7, "x")], s.schema)
    got = {(r.column, r.state): r.n for r in quality.audit_with_control(s, t, ["k"], ["n", "t"], "n").collect()}
    assert got == {("n", "equal"): 1, ("n", "preserved"): 1, ("t", "equal"): 1, ("t", "different"): 1}
    assert quality.audit_with_control(s, t, ["k"], ["n"], "t").count() == 2
    with pytest.raises(ValueError, match="cannot be tried"):
        quality.audit_with_control(s, t.where("k = 2"), ["k"], ["n"], "n")
