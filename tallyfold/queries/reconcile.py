"""Delta, audit, mirror and rewrite queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.digest import payload_digest
from ..functions.timeutil import round_seconds
from ..operators import delta, quality
from ..plans import rewrite
from ..sources import scans
from .base import ACTION, SRC, TGT, day, query, source_orders, sql_instant, table, target_orders, ts

CUT = "2000-06-30"
JOIN = "FROM src s FULL JOIN tgt t ON s.key = t.key"


@query(f"WITH {SRC}, {TGT} SELECT coalesce(s.key, t.key) AS key, strftime(s.changed, '%Y-%m-%d') AS source_changed, strftime(t.changed, '%Y-%m-%d') AS target_changed, {ACTION} AS action {JOIN}")
def delta_classify(spark, sf):
    return delta.classify(source_orders(spark, sf), target_orders(spark, sf)).select("key", day("source_changed"), day("target_changed"), "action")


@query(f"WITH {SRC}, {TGT} SELECT {ACTION} AS action, count(*) AS n {JOIN} GROUP BY 1")
def delta_classify_counts(spark, sf):
    return delta.classify(source_orders(spark, sf), target_orders(spark, sf)).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SRC}, {TGT}, t2 AS (SELECT * FROM tgt WHERE changed <= TIMESTAMP '{CUT}')
SELECT coalesce(s.key, t.key) AS key, {ACTION} AS action FROM src s FULL JOIN t2 t ON s.key = t.key WHERE s.key IS NULL OR s.changed <= TIMESTAMP '{CUT}'""")
def delta_cutoff(spark, sf):
    return delta.prepare_diff(source_orders(spark, sf), target_orders(spark, sf), ts(CUT)).select("key", "action")


@query(f"WITH {SRC}, {TGT} SELECT s.key, {ACTION} AS action FROM src s LEFT JOIN tgt t ON s.key = t.key WHERE s.changed BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '{CUT}'")
def delta_min_date(spark, sf):
    return delta.min_date_diff(source_orders(spark, sf), target_orders(spark, sf), ts("1999-01-01"), ts(CUT)).select("key", "action")


def _shifted(spark, sf):
    shift = (F.pmod(F.col("key"), F.lit(7)) - 3) * F.expr("INTERVAL 500000 MICROSECOND")
    return source_orders(spark, sf).select("key", (F.col("changed") + shift).alias("changed"))


@query(f"""WITH {SRC}, t AS (SELECT key, changed + (key % 7 - 3) * INTERVAL '0.5 seconds' AS changed FROM src)
SELECT s.key, CASE WHEN t.changed > s.changed AND date_diff('microsecond', s.changed, t.changed) <= 1000000 THEN 'equal'
 WHEN t.changed < s.changed THEN 'update' WHEN t.changed > s.changed THEN 'ahead' ELSE 'equal' END AS ahead_only,
 CASE WHEN abs(date_diff('microsecond', s.changed, t.changed)) <= 1000000 THEN 'equal' WHEN t.changed < s.changed THEN 'update' ELSE 'ahead' END AS both_ways
FROM src s JOIN t ON s.key = t.key""")
def delta_leeway(spark, sf):
    s, t = source_orders(spark, sf), _shifted(spark, sf)
    both = delta.side_by_side(s, t)
    a, b = F.col("source_changed"), F.col("target_changed")
    return both.select("key", delta.decision(a, b, True, False).alias("ahead_only"), delta.decision(a, b, True, True).alias("both_ways"))


@query(f"""WITH {SRC}, {TGT}, n AS (SELECT key, CASE WHEN key % 23 <> 0 THEN changed END AS changed FROM tgt)
SELECT coalesce(s.key, t.key) AS key, CASE WHEN s.key IS NULL THEN 'delete' WHEN t.key IS NULL THEN 'insert' WHEN s.changed IS NOT DISTINCT FROM t.changed THEN 'unchanged'
 WHEN t.changed < s.changed THEN 'update' ELSE 'conflict' END AS action FROM src s FULL JOIN n t ON s.key = t.key""")
def plan_conflicts(spark, sf):
    t = target_orders(spark, sf).withColumn("changed", F.when(F.col("key") % 23 != 0, F.col("changed")))
    return delta.plan_changes(source_orders(spark, sf), t).select("key", "action")


@query(f"""WITH {SRC}, {TGT}, p AS (SELECT coalesce(s.key, t.key) AS key, {ACTION} AS action, s.changed AS planned, t.changed AS now_changed {JOIN}),
f AS (SELECT key, CASE WHEN key % 29 = 0 THEN changed + INTERVAL 1 HOUR ELSE changed END AS changed FROM src WHERE key % 31 <> 0)
SELECT p.key, CASE WHEN f.key IS NULL THEN 'disappeared' WHEN f.changed <> p.planned THEN 'changed' WHEN p.now_changed > f.changed THEN 'ahead' ELSE 'written' END AS outcome
FROM p LEFT JOIN f ON p.key = f.key WHERE p.action IN ('insert', 'update')""")
def apply_recheck_outcomes(spark, sf):
    s, t = source_orders(spark, sf), target_orders(spark, sf)
    fresh = s.where("key % 31 <> 0").withColumn("changed", F.when(F.col("key") % 29 == 0, F.col("changed") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("changed")))
    return delta.apply_recheck(delta.classify(s, t), fresh, t).select("key", "outcome")


@query(f"""WITH {SRC}, {TGT}, t2 AS (SELECT * FROM tgt WHERE changed <= TIMESTAMP '{CUT}'),
d AS (SELECT {ACTION} AS a FROM src s FULL JOIN t2 t ON s.key = t.key WHERE s.key IS NULL OR s.changed <= TIMESTAMP '{CUT}')
SELECT count(*) FILTER (a <> 'remove') AS source_eligible, count(*) FILTER (a = 'equal') AS equal, count(*) FILTER (a = 'update') AS updates,
 count(*) FILTER (a = 'insert') AS inserts, count(*) FILTER (a = 'remove') AS removals, count(*) FILTER (a = 'ahead') AS warnings FROM d""")
def verify_after_apply(spark, sf):
    return delta.verify_counts(source_orders(spark, sf), target_orders(spark, sf), ts(CUT))


@query(f"WITH {SRC}, {TGT} SELECT s.key, strftime(s.changed, '%Y-%m-%d') AS changed FROM src s LEFT JOIN tgt t ON s.key = t.key AND s.key % 11 <> 0 WHERE t.key IS NULL OR s.changed > t.changed")
def newer_write_set(spark, sf):
    t = target_orders(spark, sf).where("key % 11 <> 0")
    return delta.newer_write_set(source_orders(spark, sf), t).select("key", day("changed"))


# ---- audits ---------------------------------------------------------------------------------------

A_SRC = "a_src AS (SELECT CASE WHEN l_orderkey % 41 <> 0 THEN l_orderkey END AS key, CASE WHEN l_orderkey % 37 <> 0 THEN max(l_shipdate) END AS changed FROM lineitem GROUP BY l_orderkey UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 101 = 0)"
A_TGT = "a_tgt AS (SELECT CASE WHEN o_orderkey % 43 <> 0 THEN o_orderkey END AS key, CASE WHEN o_orderkey % 37 <> 0 AND o_orderkey % 53 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN m ELSE o_orderdate END END AS changed, 'u' || o_orderkey AS target_id FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderkey % 13 <> 0 UNION ALL SELECT o_orderkey, o_orderdate, 'd' || o_orderkey FROM orders WHERE o_orderkey % 97 = 0)"


def _audit_sides(spark, sf):
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    m = l.groupBy("l_orderkey").agg(F.max("l_shipdate").cast("timestamp_ntz").alias("m"))
    k = F.col("l_orderkey")
    s = m.select(F.when(k % 41 != 0, k).alias("key"), F.when(k % 37 != 0, F.col("m")).alias("changed")).union(o.where("o_orderkey % 101 = 0").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz")))
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("timestamp_ntz")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # orders are dealt by number, so AQE leaves the join, which groups lines too, in as many tasks
    t = o.where(k % 13 != 0).repartition(parts, k).join(m, k == F.col("l_orderkey"), "left").select(F.when(k % 43 != 0, k).alias("key"), F.when((k % 37 != 0) & (k % 53 != 0), F.when(k % 2 == 0, F.col("m")).otherwise(d)).alias("changed"), F.concat(F.lit("u"), k).alias("target_id"))
    return s, t.union(o.where("o_orderkey % 97 = 0").select(k, d, F.concat(F.lit("d"), k)))


@query(f"""WITH {A_SRC}, {A_TGT}, w AS (SELECT TIMESTAMP '1998-01-01' AS lo, TIMESTAMP '1999-01-01' AS hi, TIMESTAMP '1998-07-01' AS bound),
ks AS (SELECT key FROM a_src WHERE key IS NOT NULL UNION SELECT key FROM a_tgt WHERE key IS NOT NULL),
sc AS (SELECT key, count(*) AS n, max((changed >= lo AND changed < hi)::INT) AS inside, count(changed) AS dated FROM a_src, w GROUP BY key),
tc AS (SELECT key, count(*) AS n, max((changed >= lo AND changed < hi)::INT) AS inside, count(changed) AS dated FROM a_tgt, w GROUP BY key),
c AS (SELECT ks.key, CASE WHEN coalesce(sc.inside, 0) = 1 OR coalesce(tc.inside, 0) = 1 THEN 'WINDOW' ELSE 'UNKNOWN_DATE' END AS scope, coalesce(tc.n, 0) AS target_count
 FROM ks LEFT JOIN sc ON sc.key = ks.key LEFT JOIN tc ON tc.key = ks.key
 WHERE (coalesce(sc.inside, 0) = 1 OR coalesce(tc.inside, 0) = 1 OR (coalesce(sc.dated, 0) = 0 AND coalesce(tc.dated, 0) = 0)) AND coalesce(sc.n, 0) <= 1)
SELECT c.scope, c.key, t.target_id, c.target_count::BIGINT AS target_count,
 CASE WHEN s.key IS NULL THEN 'TARGET_ONLY' WHEN t.key IS NULL THEN 'MISSING_TARGET' WHEN s.changed IS NULL OR t.changed IS NULL THEN 'NULL_CHANGE'
  WHEN s.changed = t.changed THEN 'EQUAL' WHEN s.changed > t.changed THEN 'TARGET_STALE' ELSE 'TARGET_AHEAD' END AS category,
 CASE WHEN s.changed IS NULL THEN 'UNKNOWN' WHEN s.changed < bound THEN 'BELOW' WHEN s.changed = bound THEN 'AT' ELSE 'ABOVE' END AS relative_bound,
 NOT (s.changed >= lo AND s.changed < hi) AS source_outside, NOT (t.changed >= lo AND t.changed < hi) AS target_outside
FROM c LEFT JOIN a_src s ON s.key = c.key LEFT JOIN a_tgt t ON t.key = c.key, w""")
def window_audit(spark, sf):
    s, t = _audit_sides(spark, sf)
    return delta.window_audit(s, t, ts("1998-01-01"), ts("1999-01-01"), ts("1998-07-01")).drop("source_changed", "target_changed")


@query(f"""WITH {A_SRC}, {A_TGT}, sc AS (SELECT key, count(*) AS n FROM a_src WHERE key IS NOT NULL GROUP BY key), tc AS (SELECT key, count(*) AS n FROM a_tgt WHERE key IS NOT NULL GROUP BY key)
SELECT 'SOURCE' AS side, s.key, strftime(changed, '%Y-%m-%d') AS changed, n AS same_side_key_count FROM a_src s LEFT JOIN sc ON sc.key = s.key WHERE s.key IS NULL OR changed IS NULL OR n > 1
UNION ALL SELECT 'TARGET', t.key, strftime(changed, '%Y-%m-%d'), n FROM a_tgt t LEFT JOIN tc ON tc.key = t.key WHERE t.key IS NULL OR changed IS NULL OR n > 1""")
def anomalies(spark, sf):
    s, t = _audit_sides(spark, sf)
    return delta.anomalies(s, t).select("side", "key", day("changed"), "same_side_key_count")


@query(f"""WITH {SRC}, {TGT}, w AS (SELECT TIMESTAMP '2000-01-01 00:00:00' AS m, TIMESTAMP '2000-01-03 00:00:00' AS x),
j AS (SELECT s.key, s.changed AS s, t.changed AS t, t.key IS NULL AS missing FROM src s LEFT JOIN tgt t ON s.key = t.key)
SELECT count(*) FILTER (missing) AS missing_keys, count(*) FILTER (missing AND s <= m) AS missing_at_or_before, count(*) FILTER (missing AND s > m) AS missing_after,
 count(*) FILTER (missing AND s >= m AND s < x) AS missing_in_shifted_window, count(*) FILTER (s > t) AS stale_keys, count(*) FILTER (s > t AND s <= m) AS stale_at_or_before FROM j, w""")
def watermark_gaps(spark, sf):
    return delta.watermark_gaps(source_orders(spark, sf), target_orders(spark, sf), ts("2000-01-01"), ts("2000-01-03"))


@query(f"""WITH {SRC}, t AS (SELECT key, changed, date_trunc('month', changed) + INTERVAL 40 DAY AS loaded FROM src WHERE key % 13 <> 0),
l AS (SELECT loaded, max(changed) AS f FROM t GROUP BY loaded HAVING max(changed) <= loaded), m AS (SELECT * FROM src WHERE key % 13 = 0)
SELECT strftime(loaded, '%Y-%m-%d') AS loaded, strftime(f, '%Y-%m-%d') AS "from", count(DISTINCT key) AS missing_keys, strftime(min(changed), '%Y-%m-%d') AS earliest, strftime(max(changed), '%Y-%m-%d') AS latest
FROM l JOIN m ON m.changed >= f AND m.changed < f + INTERVAL 5 DAY GROUP BY loaded, f""")
def inferred_windows(spark, sf):
    s = source_orders(spark, sf)
    t = s.where("key % 13 <> 0").withColumn("loaded", F.date_trunc("MONTH", "changed").cast("timestamp_ntz") + F.expr("INTERVAL 40 DAY"))
    return delta.inferred_windows(s, t, "5 DAY").select(day("loaded"), day("from"), "missing_keys", day("earliest"), day("latest"))


@query("""WITH b AS (SELECT o_orderkey AS key, o_orderdate AS changed_at, o_orderpriority AS prio FROM orders WHERE o_orderkey % 5 <> 0),
n AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS changed_at, CASE WHEN o_orderkey % 14 <> 0 THEN o_orderpriority END AS prio FROM orders WHERE o_orderkey % 6 <> 0),
m AS (SELECT max(changed_at) AS top FROM b)
SELECT n.key, 'NEW_KEY' AS category, 'changed_at' AS field, NULL::VARCHAR AS old_value, strftime(n.changed_at, '%Y-%m-%d %H:%M:%S') AS new_value, n.changed_at < top AS late FROM n LEFT JOIN b ON b.key = n.key, m WHERE b.key IS NULL
UNION ALL SELECT b.key, 'ABSENT_KEY', 'changed_at', strftime(b.changed_at, '%Y-%m-%d %H:%M:%S'), NULL, NULL FROM b LEFT JOIN n ON b.key = n.key WHERE n.key IS NULL
UNION ALL SELECT b.key, 'CHANGED_TIMESTAMP', 'changed_at', strftime(b.changed_at, '%Y-%m-%d %H:%M:%S'), strftime(n.changed_at, '%Y-%m-%d %H:%M:%S'), NULL FROM b JOIN n ON b.key = n.key WHERE b.changed_at IS DISTINCT FROM n.changed_at
UNION ALL SELECT b.key, 'CHANGED_AUDIT_TIMESTAMP', 'prio', b.prio, n.prio, NULL FROM b JOIN n ON b.key = n.key WHERE b.prio IS DISTINCT FROM n.prio""")
def observation_diff(spark, sf):
    o = table(spark, sf, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    b = o.where(k % 5 != 0).select(k.alias("key"), d.alias("changed_at"), F.col("o_orderpriority").alias("prio"))
    n = o.where(k % 6 != 0).select(k.alias("key"), F.when(k % 9 == 0, d + F.expr("INTERVAL 1 DAY")).otherwise(d).alias("changed_at"), F.when(k % 14 != 0, F.col("o_orderpriority")).alias("prio"))
    return delta.observation_diff(b, n, ["changed_at", "prio"], changed="changed_at")


@query(f"""WITH {SRC}, {TGT}, m AS (SELECT max(changed) AS top FROM src)
SELECT count(*) AS keys, count(*) FILTER (t.changed < s.changed) AS backward, count(*) FILTER (t.changed > s.changed) AS forward, count(*) FILTER (t.changed = s.changed) AS unchanged, count(*) FILTER (t.key IS NULL) AS absent,
 count(*) FILTER (s.changed >= TIMESTAMP '1996-01-01' AND t.changed < TIMESTAMP '1996-01-01') AS moved_below_window, count(*) FILTER (t.changed > s.changed AND t.changed < top) AS forward_but_late
FROM src s LEFT JOIN tgt t ON s.key = t.key, m""")
def date_movement(spark, sf):
    return delta.date_movement(source_orders(spark, sf), target_orders(spark, sf), ts("1996-01-01"))


@query(f"""WITH {SRC}, {TGT} SELECT CASE WHEN t.key IS NULL THEN 'missing' ELSE 'stale' END AS gap, strftime(s.changed, '%Y-%m') AS source_month, strftime(t.changed, '%Y-%m') AS target_month,
 count(*) AS keys, strftime(min(s.changed), '%Y-%m-%d') AS earliest, strftime(max(s.changed), '%Y-%m-%d') AS latest
FROM src s LEFT JOIN tgt t ON s.key = t.key WHERE t.key IS NULL OR t.changed < s.changed GROUP BY 1, 2, 3""")
def gap_cohorts(spark, sf):
    return delta.gap_cohorts(source_orders(spark, sf), target_orders(spark, sf)).select("gap", "source_month", "target_month", "keys", day("earliest"), day("latest"))


COMPARED = """c AS (SELECT s.key, s.changed AS s, t.changed AS t, date_trunc('month', t.changed) + INTERVAL 40 DAY AS loaded,
 CASE WHEN t.key IS NULL THEN 'MISSING' WHEN s.changed = t.changed THEN 'EQUAL' WHEN s.changed > t.changed THEN 'STALE' ELSE 'AHEAD_OR_NULL' END AS category FROM src s LEFT JOIN tgt t ON s.key = t.key)"""


def _compared(spark, sf):
    t = target_orders(spark, sf).withColumn("loaded", F.date_trunc("MONTH", "changed").cast("timestamp_ntz") + F.expr("INTERVAL 40 DAY"))
    return delta.compare_capture(source_orders(spark, sf), t, loaded="loaded")


@query(f"WITH {SRC}, {TGT}, {COMPARED} SELECT strftime(s, '%Y-%m-%d') AS day, count(*) AS keys, count(*) FILTER (category = 'MISSING') AS missing, strftime(min(s), '%Y-%m-%d') AS earliest, strftime(max(s), '%Y-%m-%d') AS latest FROM c WHERE category <> 'EQUAL' GROUP BY 1")
def gap_days(spark, sf):
    return delta.gap_days(_compared(spark, sf)).select("day", "keys", "missing", day("earliest"), day("latest"))


@query(f"WITH {SRC}, {TGT}, {COMPARED} SELECT strftime(loaded, '%Y-%m-%d') AS loaded, count(*) AS keys, count(*) FILTER (category = 'STALE') AS stale, strftime(min(s), '%Y-%m-%d') AS earliest, strftime(max(s), '%Y-%m-%d') AS latest FROM c WHERE category <> 'MISSING' GROUP BY c.loaded")
def gap_loads(spark, sf):
    return delta.gap_loads(_compared(spark, sf)).select(day("loaded"), "keys", "stale", day("earliest"), day("latest"))


@query(f"WITH {SRC}, {TGT}, {COMPARED} SELECT strftime(s, '%Y-%m-%d') AS changed, count(*) AS keys, count(*) FILTER (category = 'EQUAL') AS equal, count(*) FILTER (category = 'MISSING') AS missing, count(*) FILTER (category = 'STALE') AS stale FROM c GROUP BY c.s HAVING count(*) FILTER (category = 'EQUAL') < count(*)")
def gap_ties(spark, sf):
    return delta.gap_ties(_compared(spark, sf)).select(day("changed"), "keys", "equal", "missing", "stale")


@query(f"""WITH {SRC}, {TGT}, b AS (SELECT * FROM src WHERE changed >= TIMESTAMP '1998-01-01'), j AS (SELECT b.key IS NOT NULL AS was, coalesce(t.changed >= TIMESTAMP '1998-01-01', false) AS now, t.key IS NOT NULL AS there FROM b FULL JOIN tgt t ON b.key = t.key)
SELECT count(*) FILTER (was) AS old_rows, count(*) FILTER (now) AS new_rows, count(*) FILTER (now AND NOT was) AS new_keys, count(*) FILTER (was AND NOT there) AS absent, count(*) FILTER (was AND there AND NOT now) AS moved_below FROM j""")
def window_movement(spark, sf):
    return delta.window_movement(source_orders(spark, sf), target_orders(spark, sf), ts("1998-01-01"))


@query(f"""WITH {SRC}, {TGT}, s AS (SELECT * FROM src WHERE changed < TIMESTAMP '{CUT}'), t AS (SELECT * FROM tgt WHERE changed < TIMESTAMP '{CUT}')
SELECT coalesce(s.key, t.key) AS key, CASE WHEN t.key IS NULL THEN 'source_only' WHEN s.key IS NULL THEN 'target_only' ELSE 'date_mismatch' END AS difference
FROM s FULL JOIN t ON s.key = t.key WHERE s.key IS NULL OR t.key IS NULL OR s.changed <> t.changed""")
def merge_audit(spark, sf):
    return delta.merge_audit(source_orders(spark, sf), target_orders(spark, sf), ts(CUT), ["key"]).select("key", "difference")


M_SRC = "m_src AS (SELECT key, CASE WHEN key % 61 <> 0 THEN changed END AS changed FROM src)"


def _mirror(spark, sf):
    s = source_orders(spark, sf).withColumn("changed", F.when(F.col("key") % 61 != 0, F.col("changed")))
    return delta.mirror_delta(s, target_orders(spark, sf))


@query(f"""WITH {SRC}, {TGT}, {M_SRC} SELECT coalesce(s.key, t.key) AS key, CASE WHEN s.key IS NULL THEN 'deleted' WHEN t.key IS NULL THEN 'inserted' WHEN s.changed IS NULL OR s.changed IS DISTINCT FROM t.changed THEN 'updated' ELSE 'unchanged' END AS state
FROM m_src s FULL JOIN tgt t ON s.key = t.key""")
def mirror_delta(spark, sf):
    return _mirror(spark, sf).select("key", "state")


@query(f"""WITH {SRC}, {TGT}, {M_SRC}, d AS (SELECT CASE WHEN s.key IS NULL THEN 'd' WHEN t.key IS NULL THEN 'i' WHEN s.changed IS NULL OR s.changed IS DISTINCT FROM t.changed THEN 'u' ELSE 'n' END AS x FROM m_src s FULL JOIN tgt t ON s.key = t.key)
SELECT count(*) FILTER (x <> 'd') AS source, count(*) FILTER (x IN ('i', 'u')) AS wanted, count(*) FILTER (x = 'i') AS inserted, count(*) FILTER (x = 'u') AS updated, count(*) FILTER (x = 'n') AS unchanged, count(*) FILTER (x = 'd') AS deleted FROM d""")
def mirror_delta_stats(spark, sf):
    return delta.mirror_stats(_mirror(spark, sf))


# ---- rewrites ---------------------------------------------------------------------------------------

C_SRC = "c_src AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS bal, c_mktsegment AS seg, 100 + c_custkey % 50 AS ver FROM customer WHERE c_custkey % 4 <> 0)"
C_TGT = "c_tgt AS (SELECT c_custkey AS id, c_acctbal + 1 AS bal, CASE WHEN c_custkey % 5 <> 0 THEN 'OLD' END AS seg, CASE WHEN c_custkey % 9 <> 0 THEN 120 + c_custkey % 10 END AS ver, 'c' || c_custkey AS created FROM customer WHERE c_custkey % 6 <> 0)"


def _customers(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    s = c.where(k % 4 != 0).select(k.alias("id"), F.when(k % 3 != 0, F.col("c_acctbal")).alias("bal"), F.col("c_mktsegment").alias("seg"), (k % 50 + 100).alias("ver"))
    t = c.where(k % 6 != 0).select(k.alias("id"), (F.col("c_acctbal") + 1).alias("bal"), F.when(k % 5 != 0, "OLD").alias("seg"), F.when(k % 9 != 0, k % 10 + 120).alias("ver"), F.concat(F.lit("c"), k).alias("created"))
    return s, t


@query(f"WITH {C_SRC}, {C_TGT} SELECT coalesce(s.id, t.id) AS id, coalesce(s.bal, t.bal) AS bal, coalesce(s.seg, t.seg) AS seg, CASE WHEN t.id IS NULL THEN s.ver ELSE t.ver END AS ver, t.created FROM c_src s FULL JOIN c_tgt t ON s.id = t.id")
def null_preserving_upsert(spark, sf):
    s, t = _customers(spark, sf)
    return rewrite.upsert(t, s, ["id"], immutable=("ver",))


@query(f"""WITH {C_SRC}, {C_TGT}, j AS (SELECT s.*, t.id AS tid, t.bal AS tb, t.seg AS tg, t.ver AS tv, t.id IS NULL OR (s.id IS NOT NULL AND (t.ver IS NULL OR s.ver > t.ver)) AS newer FROM c_src s FULL JOIN c_tgt t ON s.id = t.id)
SELECT coalesce(id, tid) AS id, CASE WHEN newer THEN bal ELSE tb END AS bal, CASE WHEN newer THEN seg ELSE tg END AS seg, CASE WHEN newer THEN ver ELSE tv END AS ver FROM j""")
def upsert_if_newer(spark, sf):
    s, t = _customers(spark, sf)
    return rewrite.upsert_if_newer(t.drop("created"), s, ["id"], "ver")


@query(f"WITH {SRC}, {TGT} SELECT t.key, strftime(t.changed, '%Y-%m-%d') AS changed FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.key = t.key AND s.changed = t.changed AND s.key % 2 = 0)")
def guarded_delete(spark, sf):
    return rewrite.guarded_delete(target_orders(spark, sf), source_orders(spark, sf).where("key % 2 = 0"), ["key"], "changed").select("key", day("changed"))


@query(f"WITH {SRC}, {TGT} SELECT t.key FROM tgt t WHERE EXISTS (SELECT 1 FROM src s WHERE s.key = t.key)")
def delete_not_in_source(spark, sf):
    return rewrite.keep_in_source(target_orders(spark, sf), source_orders(spark, sf), ["key"]).select("key")


@query("WITH f AS (SELECT p_partkey AS k, CASE WHEN p_size % 5 <> 0 THEN p_size END AS v FROM part WHERE p_partkey % 3 = 0) SELECT p_partkey, CASE WHEN f.k IS NOT NULL THEN f.v ELSE -1 END::BIGINT AS model FROM part LEFT JOIN f ON f.k = p_partkey")
def backfill_column(spark, sf):
    p = table(spark, sf, "part")
    found = p.where("p_partkey % 3 = 0").select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_size")).cast("long").alias("v"))
    return rewrite.backfill(p.select("p_partkey", F.lit(-1).cast("long").alias("model")), found, "p_partkey", "model", "v")


@query("SELECT s_suppkey, s_name, 'template' AS note, s_suppkey * 2 AS twice FROM supplier")
def clone_template(spark, sf):
    s = table(spark, sf, "supplier")
    template = spark.createDataFrame([(0, "x", "template", 0)], "s_suppkey long, s_name string, note string, twice long")
    return rewrite.clone_row(template, s.select("s_suppkey", "s_name", (F.col("s_suppkey") * 2).alias("twice")))


@query("SELECT c_custkey, c_acctbal, c_acctbal >= 0 AS ok FROM customer WHERE c_acctbal IS NOT NULL")
def quarantine_split(spark, sf):
    good, bad = rewrite.split_valid(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), F.col("c_acctbal") >= 0)
    return good.withColumn("ok", F.lit(True)).union(bad.withColumn("ok", F.lit(False)))


@query("SELECT count(*) AS n, min(g) AS low, max(g) AS high, count(DISTINCT g) AS distinct_ids FROM (SELECT row_number() OVER (ORDER BY o_orderkey) AS g FROM orders)")
def stable_row_numbers(spark, sf):
    g = rewrite.number_rows(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return g.agg(F.count(F.lit(1)).alias("n"), F.min("gid").alias("low"), F.max("gid").alias("high"), F.count_distinct("gid").alias("distinct_ids"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE 'new' END AS state FROM orders")
def idempotent_copy(spark, sf):
    """Every order is sent; those that are there already stay as they are, and sending all again adds nothing."""
    o = table(spark, sf, "orders").select("o_orderkey")
    sent = o.withColumn("state", F.lit("new"))
    once = rewrite.copy_absent(o.where("o_orderkey % 3 = 0").withColumn("state", F.lit("old")), sent, "o_orderkey")
    return rewrite.copy_absent(once, sent, "o_orderkey")


@query("""WITH k AS (SELECT count(*) AS n FROM orders), c AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
SELECT 'parent' AS kind, 2 * k.n AS n, 2 * k.n AS distinct_ids, k.n AS copies FROM k UNION ALL SELECT 'child', 2 * c.n, 2 * c.n, c.n FROM c""")
def family_copy(spark, sf):
    """Orders with their lines, copied twice under ids made from the sources' ids: the second time adds nothing."""
    none = F.lit(None).cast("string").alias("origin")
    p = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), none)
    c = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct().select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_orderkey").cast("string").alias("parent"), none)
    wanted = p.select("id")
    for _ in range(2):
        p, c = rewrite.copy_family(p, c, wanted, "id", "parent", "orders")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # ids are dealt before they are counted, beside no other step
    count = lambda df, kind: df.repartition(parts, "id").agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("distinct_ids"), F.count("origin").alias("copies"))
    return count(p, "parent").union(count(c, "child"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey)::BIGINT AS gid, (row_number() OVER (ORDER BY o_orderkey) % 1000)::BIGINT AS __mod FROM orders")
def numbers_in_key_order(spark, sf):
    return rewrite.number_rows(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], modulus=1000).select("o_orderkey", "gid", "__mod")


@query(f"WITH {SRC}, {TGT}, t AS (SELECT * FROM tgt WHERE key % 11 <> 0), w AS (SELECT s.* FROM src s LEFT JOIN t ON s.key = t.key WHERE t.key IS NULL OR s.changed > t.changed) SELECT coalesce(w.key, t.key) AS key, strftime(coalesce(w.changed, t.changed), '%Y-%m-%d') AS changed FROM t FULL JOIN w ON t.key = w.key")
def checked_upsert(spark, sf):
    """Only newer rows are sent, and each of them has to take effect."""
    t = target_orders(spark, sf).where("key % 11 <> 0")
    return rewrite.checked_upsert(t, delta.newer_write_set(source_orders(spark, sf), t), ["key"], "changed").select("key", day("changed"))


@query(f"""WITH {SRC}, {TGT} SELECT count(*) FILTER (t.key IS NOT NULL) AS production_rows, count(*) FILTER (t.key IS NULL) AS inserts, count(*) FILTER (t.changed < s.changed) AS updates,
 count(*) FILTER (s.key IS NULL) AS deletes, count(*) FILTER (s.changed = t.changed) AS unchanged, count(*) FILTER (t.changed > s.changed) AS conflicts {JOIN}""")
def safe_sync_counts(spark, sf):
    from ..plans.sync import sync_counts

    return sync_counts(source_orders(spark, sf), target_orders(spark, sf), "key", "changed")


# ---- proofs and comparisons -------------------------------------------------------------------------


@query("""SELECT count(*) AS total_rows, 0::BIGINT AS null_keys, count(DISTINCT l_orderkey) AS distinct_keys,
 (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS l FROM lineitem) WHERE l IS NOT NULL) AS distinct_pages, count(*) FILTER (l_linenumber = 7) AS null_page_rows FROM lineitem""")
def prove_source(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("l_linenumber"))
    p = quality.prove_source(l, "l_orderkey", ["l_orderkey", "l_linenumber"])
    return p.select("total_rows", F.col("null_keys").cast("long").alias("null_keys"), "distinct_keys", "distinct_pages", F.col("null_page_rows").cast("long").alias("null_page_rows"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) AS versions FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def conflicting_duplicates(spark, sf):
    return quality.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query("SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def identical_duplicates(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    return quality.collapse_identical(l, ["l_orderkey", "l_returnflag", "l_linestatus"])


@query(f"""WITH {SRC}, {TGT} SELECT (SELECT count(*) FROM src) AS source_rows, (SELECT count(*) FROM src WHERE changed <= TIMESTAMP '{CUT}') AS source_to_cutoff, (SELECT count(*) FROM src WHERE changed <= TIMESTAMP '{CUT}') AS source_rounded,
 (SELECT count(*) FROM tgt) AS target_rows, (SELECT count(*) FROM tgt WHERE changed <= TIMESTAMP '{CUT}') AS target_to_cutoff, (SELECT count(*) FROM tgt WHERE changed <= TIMESTAMP '{CUT}') AS target_rounded""")
def parity(spark, sf):
    return quality.parity(source_orders(spark, sf), target_orders(spark, sf), "changed", ts(CUT))


P_SRC = "p_src AS (SELECT o_orderkey AS key, o_orderdate + (o_orderkey % 5) * INTERVAL 250 MILLISECOND AS changed FROM orders)"


@query(f"""WITH {P_SRC}, p_tgt AS (SELECT key, changed + INTERVAL 200 MILLISECOND AS changed FROM p_src WHERE key % 13 <> 0), c AS (SELECT TIMESTAMP '{CUT}' AS cut_at)
SELECT (SELECT count(*) FROM p_src) AS source_rows, (SELECT count(*) FROM p_src, c WHERE changed <= cut_at) AS source_to_cutoff, (SELECT count(*) FROM p_src, c WHERE date_trunc('second', changed + INTERVAL 500 MILLISECOND) <= cut_at) AS source_rounded,
 (SELECT count(*) FROM p_tgt) AS target_rows, (SELECT count(*) FROM p_tgt, c WHERE changed <= cut_at) AS target_to_cutoff, (SELECT count(*) FROM p_tgt, c WHERE date_trunc('second', changed + INTERVAL 500 MILLISECOND) <= cut_at) AS target_rounded""")
def parity_of_seconds(spark, sf):
    """Parity with fractions of seconds around the cutoff, where rounding changes the counts."""
    s = source_orders(spark, sf).withColumn("changed", F.col("changed") + (F.col("key") % 5) * F.expr("INTERVAL 250000 MICROSECOND"))
    t = s.where("key % 13 <> 0").withColumn("changed", F.col("changed") + F.expr("INTERVAL 200000 MICROSECOND"))
    return quality.parity(s, t, "changed", ts(CUT))


@query(f"WITH {SRC}, t AS (SELECT max(changed) AS m FROM src WHERE key % 10 = 3 AND changed < TIMESTAMP '2000-01-01') SELECT strftime(m, '%Y-%m-%d') AS target_max, strftime(max(changed), '%Y-%m-%d') AS source_max, count(*) FILTER (changed >= m) AS candidates_inclusive, count(*) FILTER (changed > m) AS candidates_strict FROM src, t GROUP BY m")
def high_water(spark, sf):
    s = source_orders(spark, sf)
    t = s.where((F.col("key") % 10 == 3) & (F.col("changed") < ts("2000-01-01")))
    return quality.high_water(s, t, "changed").select(day("target_max"), day("source_max"), "candidates_inclusive", "candidates_strict")


R_CMP = f"WITH {C_SRC}, {C_TGT} "


@query(R_CMP + """SELECT coalesce(s.id, t.id) AS id, CASE WHEN t.id IS NULL THEN 'left_only' WHEN s.id IS NULL THEN 'right_only' ELSE 'both' END AS presence,
 CASE WHEN s.id IS NULL OR t.id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN s.bal IS DISTINCT FROM t.bal THEN 'bal' END, CASE WHEN s.seg IS DISTINCT FROM t.seg THEN 'seg' END, CASE WHEN s.ver IS DISTINCT FROM t.ver THEN 'ver' END) END AS changed_columns FROM c_src s FULL JOIN c_tgt t ON s.id = t.id""")
def row_compare_columns(spark, sf):
    s, t = _customers(spark, sf)
    return quality.row_compare(s, t, ["id"], ["bal", "seg", "ver"]).withColumn("changed_columns", F.array_join("changed_columns", ","))


@query(R_CMP + """SELECT count(*) FILTER (t.id IS NULL) AS left_only, count(*) FILTER (s.id IS NULL) AS right_only, count(*) FILTER (s.id = t.id) AS both,
 count(*) FILTER (s.id = t.id AND s.bal IS DISTINCT FROM t.bal) AS bal_mismatches, count(*) FILTER (s.id = t.id AND s.seg IS DISTINCT FROM t.seg) AS seg_mismatches, count(*) FILTER (s.id = t.id AND s.ver IS DISTINCT FROM t.ver) AS ver_mismatches FROM c_src s FULL JOIN c_tgt t ON s.id = t.id""")
def mismatch_counters(spark, sf):
    s, t = _customers(spark, sf)
    cols = ["bal", "seg", "ver"]
    return quality.mismatch_counts(quality.row_compare(s, t, ["id"], cols), cols)


@query(R_CMP + """, u AS (SELECT 'bal' AS c, s.bal::VARCHAR AS l, t.bal::VARCHAR AS r FROM c_src s JOIN c_tgt t ON s.id = t.id UNION ALL SELECT 'seg', s.seg, t.seg FROM c_src s JOIN c_tgt t ON s.id = t.id)
SELECT c AS "column", CASE WHEN l IS NULL AND r IS NOT NULL THEN 'preserved' WHEN l IS NOT DISTINCT FROM r THEN 'equal' ELSE 'different' END AS state, count(*) AS n FROM u GROUP BY 1, 2""")
def payload_audit_counts(spark, sf):
    s, t = _customers(spark, sf)
    return quality.mapped_payload_audit(s, t, ["id"], ["bal", "seg"])


@query(R_CMP + """, d AS (SELECT coalesce(s.id, t.id) AS id, CASE WHEN t.id IS NULL THEN 'left_only' WHEN s.id IS NULL THEN 'right_only' WHEN s.bal IS DISTINCT FROM t.bal OR s.seg IS DISTINCT FROM t.seg OR s.ver IS DISTINCT FROM t.ver THEN 'different' END AS kind FROM c_src s FULL JOIN c_tgt t ON s.id = t.id)
SELECT id, kind FROM d WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY kind ORDER BY id) <= 10""")
def difference_examples(spark, sf):
    s, t = _customers(spark, sf)
    return quality.difference_examples(quality.row_compare(s, t, ["id"], ["bal", "seg", "ver"]), ["id"]).select("id", "kind")


@query(R_CMP + """, u AS (SELECT 'ver' AS c, s.ver::VARCHAR AS l, t.ver::VARCHAR AS r FROM c_src s JOIN c_tgt t ON s.id = t.id UNION ALL SELECT 'seg', s.seg, t.seg FROM c_src s JOIN c_tgt t ON s.id = t.id)
SELECT c AS "column", CASE WHEN l IS NULL AND r IS NOT NULL THEN 'preserved' WHEN l IS NOT DISTINCT FROM r THEN 'equal' ELSE 'different' END AS state, count(*) AS n FROM u GROUP BY 1, 2""")
def audit_with_control(spark, sf):
    """The audit has to find a planted wrong value before its counts are given."""
    s, t = _customers(spark, sf)
    return quality.audit_with_control(s, t, ["id"], ["ver", "seg"], "ver")


@query("""SELECT 'o_orderkey' AS candidate, count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_keys, 0::BIGINT AS null_rows, true AS is_unique FROM orders
UNION ALL SELECT 'o_custkey,o_orderdate', count(*), count(DISTINCT (o_custkey, o_orderdate)), 0, count(*) = count(DISTINCT (o_custkey, o_orderdate)) FROM orders""")
def unique_key_coverage(spark, sf):
    return quality.unique_key_coverage(table(spark, sf, "orders"), [["o_orderkey"], ["o_custkey", "o_orderdate"]]).withColumns({"total_rows": F.col("total_rows").cast("long"), "null_rows": F.col("null_rows").cast("long")})


_FIELD = "'{t}:' || length({v}::VARCHAR) || ':' || {v}"
_NAME, _BRAND = _FIELD.format(t="string", v="p_name"), "'string:' || length({0}) || ':' || {0}"
_SIZE = "CASE WHEN p_size % 7 <> 0 THEN " + _FIELD.format(t="{size}", v="p_size") + " ELSE 'null' END"


@query(f"""WITH x AS (SELECT p_partkey AS id, sha256(concat_ws(';', {_NAME}, {_BRAND.format("p_brand")}, {_SIZE.format(size="int")})) AS d FROM part),
y AS (SELECT p_partkey AS id, sha256(concat_ws(';', {_NAME}, {_BRAND.format("(CASE WHEN p_partkey % 10 = 0 THEN 'B' ELSE p_brand END)")}, {_SIZE.format(size="int")})) AS d FROM part)
SELECT x.id, x.d AS digest FROM x JOIN y ON x.id = y.id WHERE x.d <> y.d""")
def payload_digest_diff(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand", F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("p_size"))
    q = p.withColumn("p_brand", F.when(F.col("id") % 10 == 0, "B").otherwise(F.col("p_brand")))
    d = payload_digest("p_name", "p_brand", "p_size")
    return p.select("id", d.alias("digest")).join(q.select("id", d.alias("other")), "id").where("digest <> other").select("id", "digest")


@query("WITH c AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS v FROM nation WHERE n_nationkey % 5 <> 0) SELECT c_custkey, c.v AS looked_up, c.k IS NOT NULL AS found FROM customer LEFT JOIN c ON c.k = c_nationkey")
def lookup_missing_is_not_null(spark, sf):
    n = table(spark, sf, "nation")
    cache = n.where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).alias("v"))
    return quality.lookup_with_presence(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), cache, ["c_nationkey"], "v").select("c_custkey", "looked_up", "found")


# ---- scans --------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders WHERE (o_custkey, o_orderkey) > (500, 100) ORDER BY o_custkey, o_orderkey LIMIT 1000")
def keyset_page(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return scans.keyset_page(o, ["o_custkey", "o_orderkey"], (500, 100), 1000).select("o_orderkey", "o_custkey", day("o_orderdate"))


@query(f"WITH {SRC} SELECT key, strftime(changed, '%Y-%m-%d') AS changed FROM src WHERE (changed > TIMESTAMP '1997-03-01' OR (changed = TIMESTAMP '1997-03-01' AND key > 500)) AND (changed < TIMESTAMP '1998-03-01' OR (changed = TIMESTAMP '1998-03-01' AND key <= 9000))")
def frozen_window(spark, sf):
    return scans.frozen_window(source_orders(spark, sf), "changed", ["key"], ("1997-03-01", 500), ("1998-03-01", 9000)).select("key", day("changed"))


@query(f"WITH {SRC} SELECT strftime(changed, '%Y-%m-%d') AS changed, key FROM src ORDER BY src.changed DESC, key DESC LIMIT 1")
def upper_watermark(spark, sf):
    return scans.upper_watermark(source_orders(spark, sf), "changed", ["key"]).select(day("changed"), "key")


@query("SELECT count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15'")
def fence_count(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return scans.fence(e, "ts", ts("2024-01-15")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT o_orderkey, o_orderkey % 7 FROM orders) GROUP BY 1, 2")
def composite_key_lookup(spark, sf):
    wanted = table(spark, sf, "orders").select(F.concat_ws("-", F.col("o_orderkey"), F.col("o_orderkey") % 7).alias("k"))
    return scans.lookup_text_key(table(spark, sf, "lineitem"), wanted, "k", ["l_orderkey", "l_linenumber"]).groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_orderstatus FROM (SELECT * FROM orders WHERE o_totalprice > 1000) WHERE o_orderstatus = 'F' AND o_custkey < 300")
def wrapped_query_filter(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders_saved")
    saved = scans.query_scan(spark, "SELECT * FROM orders_saved WHERE o_totalprice > 1000;", where="WHERE o_orderstatus = 'F' AND o_custkey < 300;")
    return saved.select("o_orderkey", "o_orderstatus")


@query(f"WITH e AS (SELECT event_id, ts, to_timestamp(0) AS z FROM events) SELECT event_id, {sql_instant('date_trunc(' + chr(39) + 'second' + chr(39) + ', ts + INTERVAL 500 MILLISECOND)', 'rounded')} FROM e")
def rounded_seconds(spark, sf):
    e = table(spark, sf, "events").select("event_id", round_seconds(F.col("ts").cast("timestamp_ntz")).alias("r"))
    return e.select("event_id", F.date_format("r", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("rounded"))
