"""Temporal, value, statistics, selection, set and function queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry, text, timeutil
from ..operators import stats, temporal, value
from .base import HIST, day, history, instant, query, sql_instant, table, ts

ZONE = "Europe/Vienna"


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# ---- temporal -------------------------------------------------------------------------------------


@query(f"SELECT user_id, event_id, {sql_instant('ts')}, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, sf):
    return temporal.latest_per_key(_events(spark, sf), ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]).select("user_id", "event_id", instant("ts"), "event_type")


@query(f"SELECT user_id, {sql_instant('ts')}, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_by_aggregate(spark, sf):
    return temporal.latest_by_max(_events(spark, sf), ["user_id"], ["ts", "event_id"], ["ts", "event_id", "event_type"]).select("user_id", instant("ts"), "event_id", "event_type")


@query("""WITH l AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey * 8 + l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT l_orderkey, l_linenumber, l_partkey FROM l QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_quantity DESC, l_linenumber DESC) = 1""")
def two_level_latest(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("link", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    d = lambda *c: [F.col(x).desc_nulls_last() for x in c]
    return temporal.two_level_latest(l, "link", "l_orderkey", d("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"), d("l_shipdate", "l_quantity", "l_linenumber")).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"WITH {HIST} SELECT version_id, entity_id FROM hist WHERE valid_from <= TIMESTAMP '1999-06-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1999-06-01')")
def as_of_date(spark, sf):
    return temporal.as_of(history(spark, sf), ts("1999-06-01")).select("version_id", "entity_id")


@query(f"WITH {HIST} SELECT version_id FROM hist WHERE valid_to IS NULL")
def open_intervals(spark, sf):
    return temporal.open_versions(history(spark, sf)).select("version_id")


@query(f"""WITH {HIST}, c AS (SELECT * FROM (VALUES (TIMESTAMP '1997-01-01'), (TIMESTAMP '1998-01-01'), (TIMESTAMP '2000-01-01')) v(cutoff)), u AS (SELECT c_custkey AS entity_id, cutoff FROM customer, c)
SELECT u.entity_id, strftime(cutoff, '%Y-%m-%d') AS cutoff, h.version_id, h.amount::DOUBLE AS amount FROM u LEFT JOIN hist h ON h.entity_id = u.entity_id AND valid_from <= cutoff AND (valid_to IS NULL OR valid_to > cutoff)""")
def multi_cutoff_as_of(spark, sf):
    cuts = F.explode(F.array(*[ts(f"{y}-01-01") for y in (1997, 1998, 2000)]))
    units = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity_id"), cuts.alias("cutoff"))
    return temporal.as_of_join(units, history(spark, sf), ["entity_id"], "cutoff").select("entity_id", day("cutoff"), "version_id", F.col("amount").cast("double").alias("amount"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(1000 * l_quantity::DECIMAL(18,4) / nullif(sum(l_quantity::DECIMAL(18,4)) OVER (PARTITION BY l_orderkey), 0), 2)::DOUBLE AS allocated FROM lineitem""")
def allocate_share(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("q", F.col("l_quantity").cast("decimal(18,4)"))
    return temporal.allocate_share(l, "l_orderkey", "q", F.lit(1000)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("allocated").cast("double").alias("allocated"))


BANDS = [(1, 10, 0, 1000, "small-cheap"), (1, 10, 1001, 99999, "small-dear"), (11, 30, 0, 99999, "middle"), (31, 50, 0, 1500, "large-low"), (31, 50, 1200, 99999, "large-high")]


@query("""WITH b AS (SELECT * FROM (VALUES (1, 10, 0, 1000, 'small-cheap'), (1, 10, 1001, 99999, 'small-dear'), (11, 30, 0, 99999, 'middle'), (31, 50, 0, 1500, 'large-low'), (31, 50, 1200, 99999, 'large-high')) v(s0, s1, p0, p1, label))
SELECT p_partkey, count(label) AS bands, CASE WHEN count(label) = 1 THEN max(label) END AS label FROM part LEFT JOIN b ON p_size BETWEEN s0 AND s1 AND p_retailprice BETWEEN p0 AND p1 GROUP BY p_partkey""")
def band_lookup(spark, sf):
    bands = spark.createDataFrame(BANDS, "s0 int, s1 int, p0 int, p1 int, label string")
    return temporal.banded_lookup(table(spark, sf, "part"), bands, [("p_size", "s0", "s1"), ("p_retailprice", "p0", "p1")], "label").select("p_partkey", "bands", "label")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(o.o_orderdate, '%Y-%m-%d') AS opened_at, strftime(c.o_orderdate, '%Y-%m-%d') AS closed_at, strftime(coalesce(c.o_orderdate, o.o_orderdate), '%Y-%m-%d') AS changed
FROM lineitem LEFT JOIN orders o ON o.o_orderkey = l_orderkey LEFT JOIN orders c ON c.o_orderkey = CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey + 1 END""")
def open_and_closing_revision(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_orderkey").alias("rev_open"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_orderkey") + 1).alias("rev_close"))
    j = temporal.current_and_closing(l, table(spark, sf, "orders"), "rev_open", "rev_close", "o_orderkey", "o_orderdate")
    return j.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", day("opened_at"), day("closed_at"), day("changed"))


# ---- values -----------------------------------------------------------------------------------------


@query("""WITH u AS (SELECT o_orderkey AS unit, 'p' || o_orderkey AS prepared_id, CASE WHEN o_orderkey % 41 = 0 THEN 'bad' WHEN o_orderkey % 43 = 0 THEN '  ' END AS prep_error FROM orders UNION ALL SELECT o_orderkey, 'q' || o_orderkey, NULL FROM orders WHERE o_orderkey % 67 = 0),
r AS (SELECT 'p' || l_orderkey AS prepared_id, min(l_partkey) AS result_id, sum(l_extendedprice::DECIMAL(20,2)) AS calculated, CASE WHEN l_orderkey % 4 <> 0 THEN round(sum(l_extendedprice::DECIMAL(20,2)), 0) END::DECIMAL(20,2) AS generalized, CASE WHEN l_orderkey % 29 = 0 THEN 'e' END AS calc_error FROM lineitem GROUP BY l_orderkey
 UNION ALL SELECT 'p' || o_orderkey, o_orderkey, o_totalprice::DECIMAL(20,2), NULL, NULL FROM orders WHERE o_orderkey % 53 = 0),
t AS (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(20,2)) AS s FROM lineitem GROUP BY 1),
v0 AS (SELECT o_orderkey AS unit, o_orderkey AS source_id, o_orderkey AS k, o_orderdate AS d, CASE WHEN o_orderkey % 3 = 0 THEN s + o_orderkey % 3 + (o_orderkey % 2) * 0.01 WHEN o_orderkey % 3 = 1 THEN s ELSE o_totalprice::DECIMAL(20,2) END::DECIMAL(20,2) AS a FROM orders LEFT JOIN t ON l_orderkey = o_orderkey),
v AS (SELECT unit, source_id, CASE WHEN k % 31 = 0 THEN 'ERROR' ELSE 'M' END AS model, CASE WHEN k % 23 = 0 THEN 101 ELSE 100 END AS model_ver, CASE WHEN k % 37 = 0 THEN 'X' WHEN k % 3 = 0 THEN 'A' END AS status, d AS valid_from, CASE WHEN k % 7 <> 0 THEN d + INTERVAL 2000 DAY END AS valid_to, a AS calculated, round(a, 0)::DECIMAL(20,2) AS generalized FROM v0
 UNION ALL SELECT o_orderkey, -o_orderkey, 'M', 100, NULL, TIMESTAMP '1990-01-01', NULL, 1, 1 FROM orders WHERE o_orderkey % 59 = 0),
c AS (SELECT unit, count(*) AS n FROM u GROUP BY unit),
a AS (SELECT prepared_id, count(*) AS n, max(calculated) AS calc, max(generalized) AS gen, max(result_id) AS id, count(nullif(trim(calc_error), '')) > 0 AS err FROM r GROUP BY 1),
l AS (SELECT *, status IS DISTINCT FROM 'X' AND model_ver = 100 AS live FROM v WHERE valid_from <= TIMESTAMP '2000-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2000-01-01')),
b AS (SELECT unit, count(*) FILTER (live AND model = 'M') AS n, max(calculated) FILTER (live AND model = 'M') AS calc, max(generalized) FILTER (live AND model = 'M') AS gen, max(source_id) FILTER (live AND model = 'M') AS id, bool_or(live AND model = 'ERROR') AS err FROM l GROUP BY unit),
j AS (SELECT u.unit, u.prepared_id, CASE WHEN c.n > 1 OR a.n > 1 OR b.n > 1 THEN 'AMBIGUOUS' WHEN nullif(trim(prep_error), '') IS NOT NULL OR a.err THEN 'ERROR_A' WHEN b.err THEN 'ERROR_B' END AS problem,
 CASE WHEN a.n = 1 THEN a.id END AS result_id, CASE WHEN b.n = 1 THEN b.id END AS source_id, CASE WHEN a.n = 1 THEN a.calc END AS ac, CASE WHEN b.n = 1 THEN b.calc END AS bc, CASE WHEN a.n = 1 THEN a.gen END AS ag, CASE WHEN b.n = 1 THEN b.gen END AS bg
 FROM u LEFT JOIN c ON c.unit = u.unit LEFT JOIN a ON a.prepared_id = u.prepared_id LEFT JOIN b ON b.unit = u.unit)
SELECT unit, prepared_id, result_id, source_id, ac::DOUBLE AS a_calc, bc::DOUBLE AS b_calc, (CASE WHEN problem IS NULL THEN ac - bc END)::DOUBLE AS delta_calc,
 coalesce(problem, CASE WHEN ac IS NULL THEN 'MISSING_A' WHEN bc IS NULL THEN 'MISSING_B' WHEN abs(ac - bc) > 0.01 THEN 'DIFFERENT' ELSE 'EQUAL' END) AS status_calc,
 ag::DOUBLE AS a_gen, bg::DOUBLE AS b_gen, (CASE WHEN problem IS NULL THEN ag - bg END)::DOUBLE AS delta_gen,
 coalesce(problem, CASE WHEN ag IS NULL THEN 'MISSING_A' WHEN bg IS NULL THEN 'MISSING_B' WHEN abs(ag - bg) > 0.01 THEN 'DIFFERENT' ELSE 'EQUAL' END) AS status_gen FROM j""")
def pair_at_cutoff(spark, sf):
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    k = F.col("o_orderkey")
    dec = lambda c: c.cast("decimal(20,2)")
    units = o.select(k.alias("unit"), F.concat(F.lit("p"), k).alias("prepared_id"), F.when(k % 41 == 0, "bad").when(k % 43 == 0, "  ").alias("prep_error")).union(o.where(k % 67 == 0).select(k, F.concat(F.lit("q"), k), F.lit(None).cast("string")))
    sums = l.groupBy("l_orderkey").agg(F.sum(dec(F.col("l_extendedprice"))).alias("s"), F.min("l_partkey").alias("first"))
    lk = F.col("l_orderkey")
    none = lambda t: F.lit(None).cast(t)
    results = sums.select(F.concat(F.lit("p"), lk).alias("prepared_id"), F.col("first").alias("result_id"), dec(F.col("s")).alias("calculated"), F.when(lk % 4 != 0, dec(F.round("s", 0))).alias("generalized"), F.when(lk % 29 == 0, "e").alias("calc_error"))
    results = results.union(o.where(k % 53 == 0).select(F.concat(F.lit("p"), k), k, dec(F.col("o_totalprice")), none("decimal(20,2)"), none("string")))
    amount = F.when(k % 3 == 0, F.col("s") + k % 3 + (k % 2) * F.lit("0.01").cast("decimal(3,2)")).when(k % 3 == 1, F.col("s")).otherwise(dec(F.col("o_totalprice")))
    d = F.col("o_orderdate").cast("timestamp_ntz")
    v = o.join(sums, k == lk, "left").withColumn("a", dec(amount))
    end = F.when(k % 7 != 0, d + F.expr("INTERVAL 2000 DAY"))
    vals = v.select(k.alias("unit"), k.alias("source_id"), F.when(k % 31 == 0, "ERROR").otherwise("M").alias("model"), F.when(k % 23 == 0, 101).otherwise(100).alias("model_ver"), F.when(k % 37 == 0, "X").when(k % 3 == 0, "A").alias("status"), d.alias("valid_from"), end.alias("valid_to"), F.col("a").alias("calculated"), dec(F.round("a", 0)).alias("generalized"))
    one = F.lit(1).cast("decimal(20,2)")
    vals = vals.union(o.where(k % 59 == 0).select(k, -k, F.lit("M"), F.lit(100), none("string"), ts("1990-01-01"), none("timestamp_ntz"), one, one))
    p = value.pair_at_cutoff(units, results, vals, ts("2000-01-01"), "M", 100, F.lit(0.01).cast("decimal(10,2)"))
    return p.select(*[F.col(x).cast("double").alias(x) if x[:2] in ("a_", "b_") or x.startswith("delta") else F.col(x) for x in p.columns])


@query("SELECT l_orderkey, CASE WHEN count(CASE WHEN l_partkey % 10 <> 0 THEN 1 END) = count(*) THEN sum(l_extendedprice::DECIMAL(20,2)) END::DOUBLE AS total FROM lineitem GROUP BY 1")
def all_or_nothing_sum(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_partkey") % 10 != 0, F.col("l_extendedprice").cast("decimal(20,2)")).alias("v"))
    return l.groupBy("l_orderkey").agg(value.whole_sum("v").cast("double").alias("total"))


@query("""WITH v AS (SELECT o_orderkey, (o_totalprice / (CASE o_orderkey % 4 WHEN 0 THEN 5000 WHEN 1 THEN 50 WHEN 2 THEN 1 ELSE -1 END))::DECIMAL(20,4) AS x FROM orders)
SELECT o_orderkey, CASE WHEN x < 0 THEN NULL WHEN x <= 100 THEN floor(x + 0.5) WHEN x <= 10000 THEN floor(x / 10 + 0.5) * 10 WHEN x <= 500000 THEN floor(x / 100 + 0.5) * 100 ELSE floor(x / 1000 + 0.5) * 1000 END::DOUBLE AS rounded FROM v""")
def round_tiers(spark, sf):
    by = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 5000 WHEN 1 THEN 50 WHEN 2 THEN 1 ELSE -1 END")
    return table(spark, sf, "orders").select("o_orderkey", value.round_tiers((F.col("o_totalprice") / by).cast("decimal(20,4)")).cast("double").alias("rounded"))


@query("""WITH a AS (SELECT o_custkey AS k, o_orderpriority AS p, count(*) AS n, max(o_orderkey) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2), b AS (SELECT o_custkey AS k, o_orderpriority AS p, count(*) AS n, max(o_orderkey) AS v FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2)
SELECT coalesce(a.k, b.k) AS o_custkey, coalesce(a.p, b.p) AS o_orderpriority, coalesce(a.n, 0) AS left_candidates, coalesce(b.n, 0) AS right_candidates, CASE WHEN a.n = 1 THEN a.v END AS left_value, CASE WHEN b.n = 1 THEN b.v END AS right_value, coalesce(a.n, 0) > 1 OR coalesce(b.n, 0) > 1 AS ambiguous FROM a FULL JOIN b ON a.k = b.k AND a.p = b.p""")
def guarded_pairing(spark, sf):
    o = table(spark, sf, "orders")
    return value.guarded_pair(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus <> 'F'"), ["o_custkey", "o_orderpriority"], "o_orderkey", "o_orderkey")


@query("""WITH r AS (SELECT * FROM (VALUES ('area', 'f_area', 'g1'), ('year', 'f_year', 'g1'), ('none', 'f_none', 'g2')) v(key, field, grp)),
a AS (SELECT p_partkey AS id, 'area' AS key, p_size::DECIMAL(10,2) AS v FROM part UNION ALL SELECT p_partkey, 'year', (1900 + p_size)::DECIMAL(10,2) FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_partkey, 'loose', 1::DECIMAL(10,2) FROM part WHERE p_partkey % 7 = 0),
b AS (SELECT p_partkey AS id, 'f_area' AS field, (p_size + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END)::DECIMAL(10,2) AS v FROM part UNION ALL SELECT p_partkey, 'f_year', (1900 + p_size)::DECIMAL(10,2) FROM part WHERE p_partkey % 5 <> 0 UNION ALL SELECT p_partkey, 'f_free', 2::DECIMAL(10,2) FROM part WHERE p_partkey % 11 = 0),
u AS (SELECT id FROM a UNION SELECT id FROM b)
SELECT u.id, r.key, r.field, r.grp, a.v::DOUBLE AS a_value, b.v::DOUBLE AS b_value, CASE WHEN a.v IS NULL THEN 'MISSING_A' WHEN b.v IS NULL THEN 'MISSING_B' WHEN a.v <> b.v THEN 'DIFFERENT' ELSE 'EQUAL' END AS status FROM u CROSS JOIN r LEFT JOIN a ON a.id = u.id AND a.key = r.key LEFT JOIN b ON b.id = u.id AND b.field = r.field
UNION ALL SELECT id, key, NULL, NULL, v::DOUBLE, NULL, 'UNTRANSLATED' FROM a WHERE key NOT IN (SELECT key FROM r) UNION ALL SELECT id, NULL, field, NULL, NULL, v::DOUBLE, 'UNTRANSLATED' FROM b WHERE field NOT IN (SELECT field FROM r)""")
def component_translation(spark, sf):
    p = table(spark, sf, "part")
    k, d = F.col("p_partkey"), lambda c: c.cast("decimal(10,2)").alias("value")
    a = p.select(k.alias("id"), F.lit("area").alias("key"), d(F.col("p_size"))).union(p.where(k % 3 != 0).select(k, F.lit("year"), d(F.col("p_size") + 1900))).union(p.where(k % 7 == 0).select(k, F.lit("loose"), d(F.lit(1))))
    b = p.select(k.alias("id"), F.lit("f_area").alias("field"), d(F.col("p_size") + F.when(k % 4 == 0, 1).otherwise(0))).union(p.where(k % 5 != 0).select(k, F.lit("f_year"), d(F.col("p_size") + 1900))).union(p.where(k % 11 == 0).select(k, F.lit("f_free"), d(F.lit(2))))
    rules = spark.createDataFrame([("area", "f_area", "g1"), ("year", "f_year", "g1"), ("none", "f_none", "g2")], "key string, field string, grp string")
    return value.translate_components(a, b, rules, ["id"]).withColumns({c: F.col(c).cast("double") for c in ("a_value", "b_value")})


@query("""WITH x AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice::DECIMAL(18,4) AS p, l_discount::DECIMAL(18,4) AS d, l_tax::DECIMAL(18,4) AS t FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, (p - (p - 10))::DOUBLE AS d_price, (d - 0.01)::DOUBLE AS d_discount, ((p + d + t) - ((p - 10) + 0.01 + t))::DOUBLE AS delta, ((p + d + t) - ((p - 10) + 0.01 + t) - (p - (p - 10)) - (d - 0.01))::DOUBLE AS unexplained FROM x""")
def difference_decomposition(spark, sf):
    dec = lambda c: F.col(c).cast("decimal(18,4)")
    p, d, t = dec("l_extendedprice"), dec("l_discount"), dec("l_tax")
    lo = F.lit("0.01").cast("decimal(18,4)")
    cols = value.decompose(p + d + t, (p - 10) + lo + t, {"price": (p, p - 10), "discount": (d, lo)})
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *[c.cast("double").alias(n) for n, c in cols.items()])


@query("""SELECT p_partkey, concat_ws(',', CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_retailprice < 950 THEN 'cheap' END, CASE WHEN p_brand = 'Brand#2' THEN 'brand' END) AS problems FROM part""")
def problem_list(spark, sf):
    pl = value.problem_list(large=F.col("p_size") > 40, cheap=F.col("p_retailprice") < 950, brand=F.col("p_brand") == "Brand#2")
    return table(spark, sf, "part").select("p_partkey", F.array_join(pl, ",").alias("problems"))


@query("""WITH parcels AS (SELECT o_orderkey AS id, o_custkey AS scope_id, o_orderkey % 700 AS parcel_id, CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice::DECIMAL(20,2) END AS share, 7::DECIMAL(20,2) AS previous, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey % 11 <> 0 END AS included, o_orderkey % 13 = 0 AS is_insert FROM orders),
scopes AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 17 <> 0 THEN c_nationkey END AS unit_id FROM customer),
units AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 = 0 THEN TIMESTAMP '1999-01-01' WHEN n_nationkey % 3 = 1 THEN TIMESTAMP '2050-01-01' END AS valid_to FROM nation),
buildings AS (SELECT p_partkey AS id, p_partkey % 1500 AS scope_id, p_size AS building_id FROM part), parts AS (SELECT p_partkey AS building_row, p_partkey % 3 <> 0 AS included FROM part UNION ALL SELECT p_partkey, true FROM part WHERE p_partkey % 4 = 0),
links AS (SELECT l_orderkey AS link_id, TIMESTAMP '1990-01-01' AS date_from, CASE WHEN l_linenumber % 2 = 0 THEN TIMESTAMP '2100-01-01' ELSE TIMESTAMP '2000-01-01' END AS date_to, l_partkey % 700 AS parcel_id, (l_suppkey % 50 + 1) AS building_id, l_quantity::DECIMAL(20,2) AS area, l_shipdate + l_partkey * INTERVAL 1 SECOND + l_suppkey * INTERVAL 1 HOUR + (l_extendedprice * 100)::BIGINT * INTERVAL 1 MICROSECOND AS loaded_at FROM lineitem),
target AS (SELECT *, CASE WHEN is_insert THEN NULL ELSE previous END AS prev FROM parcels WHERE included),
kn AS (SELECT * FROM links WHERE link_id IN (SELECT link_id FROM links WHERE parcel_id IN (SELECT parcel_id FROM target)) QUALIFY row_number() OVER (PARTITION BY link_id, date_from, date_to ORDER BY loaded_at DESC) = 1),
z AS (SELECT t.id, sum(kn.area) AS area FROM target t JOIN scopes s ON s.id = t.scope_id JOIN units u ON u.id = s.unit_id JOIN kn ON kn.parcel_id = t.parcel_id AND coalesce(u.valid_to, TIMESTAMP '2100-01-01') <= kn.date_to
 WHERE EXISTS (SELECT 1 FROM buildings b WHERE b.scope_id = t.scope_id AND b.building_id = kn.building_id AND EXISTS (SELECT 1 FROM parts d WHERE d.building_row = b.id AND d.included)) GROUP BY t.id),
calc AS (SELECT t.id, CASE WHEN s.unit_id IS NULL THEN NULL WHEN z.area IS NULL THEN t.prev WHEN t.share IS NULL THEN NULL ELSE greatest(t.share - z.area, 0) END AS new_value FROM target t LEFT JOIN scopes s ON s.id = t.scope_id LEFT JOIN z ON z.id = t.id)
SELECT p.id, (CASE WHEN c.id IS NULL THEN p.previous ELSE c.new_value END)::DOUBLE AS actual FROM parcels p LEFT JOIN calc c ON c.id = p.id""")
def rule_share_minus_area(spark, sf):
    o, c, n, p, l = (table(spark, sf, t) for t in ("orders", "customer", "nation", "part", "lineitem"))
    k = F.col("o_orderkey")
    parcels = o.select(k.alias("id"), F.col("o_custkey").alias("scope_id"), (k % 700).alias("parcel_id"), F.when(k % 19 != 0, F.col("o_totalprice").cast("decimal(20,2)")).alias("share"), F.lit(7).cast("decimal(20,2)").alias("previous"), F.when(k % 23 != 0, k % 11 != 0).alias("included"), (k % 13 == 0).alias("is_insert"))
    scopes = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 17 != 0, F.col("c_nationkey")).alias("unit_id"))
    nk = F.col("n_nationkey")
    units = n.select(nk.alias("id"), F.when(nk % 3 == 0, ts("1999-01-01")).when(nk % 3 == 1, ts("2050-01-01")).alias("valid_to"))
    pk = F.col("p_partkey")
    buildings = p.select(pk.alias("id"), (pk % 1500).alias("scope_id"), F.col("p_size").cast("long").alias("building_id"))
    parts = p.select(pk.alias("building_row"), (pk % 3 != 0).alias("included")).union(p.where(pk % 4 == 0).select(pk, F.lit(True)))
    loaded = F.col("l_shipdate").cast("timestamp_ntz") + F.col("l_partkey") * F.expr("INTERVAL 1 SECOND") + F.col("l_suppkey") * F.expr("INTERVAL 1 HOUR") + F.round(F.col("l_extendedprice") * 100).cast("long") * F.expr("INTERVAL 1 MICROSECOND")
    links = l.select(F.col("l_orderkey").alias("link_id"), ts("1990-01-01").alias("date_from"), F.when(F.col("l_linenumber") % 2 == 0, ts("2100-01-01")).otherwise(ts("2000-01-01")).alias("date_to"), (F.col("l_partkey") % 700).alias("parcel_id"), (F.col("l_suppkey") % 50 + 1).alias("building_id"), F.col("l_quantity").cast("decimal(20,2)").alias("area"), loaded.alias("loaded_at"))
    return value.share_minus_area(parcels, scopes, units, buildings, parts, links).select("id", F.col("actual").cast("double").alias("actual"))


@query("""WITH a AS (SELECT p_partkey AS m FROM part WHERE p_size > 5), bad AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE CASE WHEN l_linenumber = 1 THEN 7 ELSE l_partkey END NOT IN (SELECT m FROM a))
SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber <= 2 AND l_orderkey NOT IN (SELECT l_orderkey FROM bad)""")
def select_all_or_nothing(spark, sf):
    models = table(spark, sf, "part").where("p_size > 5").select(F.col("p_partkey").alias("m"))
    return value.select_whole_groups(table(spark, sf, "lineitem"), "l_orderkey", F.when(F.col("l_linenumber") == 1, F.lit(7).cast("long")).otherwise(F.col("l_partkey")), models, "m", F.col("l_linenumber") <= 2)


SEL = "m AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45), s AS (SELECT DISTINCT o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus = 'F')"


def _selection(spark, sf):
    m = table(spark, sf, "lineitem").where("l_quantity > 45").select("l_orderkey")
    return value.selection_diff(m, table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


@query(f"WITH {SEL} SELECT coalesce(m.l_orderkey, s.l_orderkey) AS l_orderkey, CASE WHEN s.l_orderkey IS NULL THEN 'manual_only' WHEN m.l_orderkey IS NULL THEN 'stored_only' ELSE 'both' END AS side FROM m FULL JOIN s ON m.l_orderkey = s.l_orderkey")
def selection_diff(spark, sf):
    return _selection(spark, sf)


@query(f"WITH {SEL} SELECT CASE WHEN s.l_orderkey IS NULL THEN 'manual_only' WHEN m.l_orderkey IS NULL THEN 'stored_only' ELSE 'both' END AS side, count(*) AS n FROM m FULL JOIN s ON m.l_orderkey = s.l_orderkey GROUP BY 1")
def selection_diff_counts(spark, sf):
    return _selection(spark, sf).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, CASE WHEN a IS NULL AND b IS NULL THEN 'BOTH_MISSING' WHEN a IS NULL THEN 'MISSING_A' WHEN b IS NULL THEN 'MISSING_B' WHEN a = b THEN 'EQUAL' WHEN a > b THEN 'A_HIGHER' ELSE 'B_HIGHER' END AS status FROM (SELECT o_orderkey, nullif(o_orderkey % 7, 0) AS a, nullif(o_orderkey % 5, 0) AS b FROM orders)")
def exact_compare(spark, sf):
    n = lambda m: F.nullif(F.col("o_orderkey") % m, F.lit(0))
    return table(spark, sf, "orders").select("o_orderkey", value.exact_status(n(7), n(5)).alias("status"))


# ---- statistics -------------------------------------------------------------------------------------

STAT_SRC = "s AS (SELECT c_mktsegment AS model, o_orderstatus AS unit_type, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice::DECIMAL(20,2) END AS v, CASE WHEN o_orderkey % 15 = 0 THEN 'e' WHEN o_orderkey % 16 = 0 THEN ' ' END AS err FROM orders JOIN customer ON o_custkey = c_custkey)"


def _stat(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    k = F.col("o_orderkey")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("model"), F.col("o_orderstatus").alias("unit_type"), F.when(k % 10 != 0, F.col("o_totalprice").cast("decimal(20,2)")).alias("v"), F.when(k % 15 == 0, "e").when(k % 16 == 0, " ").alias("err"))
    return stats.valuation_statistics(j, ["model", "unit_type"], "v", "err")


@query(f"""WITH {STAT_SRC} SELECT model, unit_type, round(quantile_cont(v::DOUBLE, 0.05), 4) AS p05, round(quantile_cont(v::DOUBLE, 0.25), 4) AS p25, round(quantile_cont(v::DOUBLE, 0.5), 4) AS p50, round(quantile_cont(v::DOUBLE, 0.75), 4) AS p75, round(quantile_cont(v::DOUBLE, 0.95), 4) AS p95,
 round(stddev_pop(v::DOUBLE), 3) AS deviation, round(avg(v::DOUBLE), 3) AS mean FROM s GROUP BY 1, 2""")
def stats_percentiles(spark, sf):
    d = _stat(spark, sf)
    return d.select("model", "unit_type", *[F.round(f"p{q}", 4).alias(f"p{q}") for q in ("05", "25", "50", "75", "95")], F.round("deviation", 3).alias("deviation"), F.round("mean", 3).alias("mean"))


@query(f"""WITH {STAT_SRC} SELECT model, unit_type, count(*) AS units, count(*) FILTER (v IS NULL) AS without_value, count(v) AS with_value, round(100.0 * count(*) FILTER (v IS NULL) / nullif(count(*), 0), 2)::DOUBLE AS without_pct,
 sum(v)::DOUBLE AS total, min(v)::DOUBLE AS low, max(v)::DOUBLE AS high, count(*) FILTER (trim(err) <> '') AS errors FROM s GROUP BY 1, 2""")
def stats_filter_counts(spark, sf):
    return _stat(spark, sf).select("model", "unit_type", "units", "without_value", "with_value", "without_pct", "total", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), "errors")


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(o_totalprice::DECIMAL(20,2))::DOUBLE AS total, grouping(o_orderstatus)::INT AS is_total_o_orderstatus, grouping(o_orderpriority)::INT AS is_total_o_orderpriority
FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""")
def grouping_sets_inventory(spark, sf):
    cols = ["o_orderstatus", "o_orderpriority"]
    return stats.grouping_inventory(table(spark, sf, "orders"), [cols, cols[:1], []], cols, [F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double").alias("total")])


@query("""WITH p AS (SELECT o_orderdate AS d, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM p)
SELECT strftime(d, '%Y-%m-%d') AS o_orderdate, n AS rows_at, b AS rows_before, (b // 100) <> ((b + n - 1) // 100) AS straddles FROM c WHERE n > 1""")
def ties_page_straddle(spark, sf):
    return stats.timestamp_ties(table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")), "o_orderdate", 100).select(day("o_orderdate"), "rows_at", "rows_before", "straddles")


@query("""SELECT strftime(((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Vienna'), '%Y-%m-%d') AS day, event_type, count(DISTINCT user_id) AS distinct_keys, count(*) AS row_count FROM events GROUP BY 1, 2""")
def daily_local(spark, sf):
    return stats.daily_local(_events(spark, sf), "ts", ZONE, ["event_type"], "user_id")


@query("SELECT year(o_orderdate)::BIGINT AS year, count(*) AS n FROM orders GROUP BY 1")
def year_histogram(spark, sf):
    return stats.year_histogram(table(spark, sf, "orders"), "o_orderdate")


@query("SELECT o_orderkey, (o_totalprice::DECIMAL(20,2) - 250000)::DOUBLE AS delta FROM orders ORDER BY abs(o_totalprice::DECIMAL(20,2) - 250000) DESC, o_orderkey LIMIT 25")
def topk_abs_delta(spark, sf):
    return stats.top_by_delta(table(spark, sf, "orders"), F.col("o_totalprice").cast("decimal(20,2)") - 250000, "o_orderkey", 25).select("o_orderkey", F.col("delta").cast("double").alias("delta"))


@query("SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS nth FROM orders QUALIFY nth <= 5")
def samples_per_category(spark, sf):
    return stats.samples_per_category(table(spark, sf, "orders"), "o_orderpriority", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 5).select("o_orderpriority", "o_orderkey", F.col("nth").cast("long").alias("nth"))


@query("SELECT o_orderkey, (SELECT count(*) FROM orders) AS pool_size FROM orders ORDER BY md5(o_orderkey::VARCHAR || 'seed') LIMIT 50")
def hash_sample(spark, sf):
    return stats.hash_sample(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "seed", 50)


@query("SELECT c_mktsegment, o_orderstatus, count(*) AS n, sum(count(*)) OVER (PARTITION BY c_mktsegment)::BIGINT AS total, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment), 2)::DOUBLE AS pct FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")
def status_percentages(spark, sf):
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return stats.status_percentages(j, ["c_mktsegment"], "o_orderstatus")


# ---- sets, joins, functions -------------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, 'customer' AS unit_type FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier")
def union_tagged(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return stats.tagged_union({"customer": c, "supplier": table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))})


@query("SELECT c_custkey, c_name, c_nationkey FROM (SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'x' ELSE c_name END AS c_name, c_nationkey FROM customer) EXCEPT SELECT c_custkey, c_name, c_nationkey FROM customer")
def except_minus_column(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    changed = c.withColumns({"c_name": F.when(F.col("c_custkey") % 50 == 0, "x").otherwise(F.col("c_name")), "c_acctbal": F.col("c_acctbal") + 1})
    return changed.drop("c_acctbal").subtract(c.drop("c_acctbal"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def key_union(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49 AND l_returnflag = 'R')) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)")
def nested_exists(spark, sf):
    c, o, l = (table(spark, sf, t) for t in ("customer", "orders", "lineitem"))
    hot = o.join(l.where("l_quantity > 49 AND l_returnflag = 'R'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return c.join(hot, F.col("o_custkey") == F.col("c_custkey"), "left_semi").join(o.where("o_totalprice > 480000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT DISTINCT l_orderkey, e.m AS effective FROM lineitem, LATERAL (SELECT CASE WHEN l_linenumber = 1 THEN 'lead' ELSE l_returnflag END AS m) e WHERE nullif(trim(e.m), '') IS NOT NULL")
def lateral_effective(spark, sf):
    m = F.when(F.col("l_linenumber") == 1, "lead").otherwise(F.col("l_returnflag"))
    return table(spark, sf, "lineitem").select("l_orderkey", m.alias("effective")).where(text.blank_to_null(F.col("effective")).isNotNull()).distinct()


@query("SELECT c_custkey, (SELECT max(o_orderkey) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS last_final FROM customer")
def scalar_subquery(spark, sf):
    m = table(spark, sf, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("last_final"))
    return table(spark, sf, "customer").select("c_custkey").join(m, "c_custkey", "left")


@query("SELECT o_orderkey, count(l_orderkey) AS later_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END, TIMESTAMP '2100-01-01') <= l_shipdate GROUP BY 1")
def theta_residual(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.coalesce(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("timestamp_ntz")), ts("2100-01-01")).alias("end"))
    l = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("timestamp_ntz").alias("ship"))
    return o.join(l, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("end") <= F.col("ship")), "left").groupBy("o_orderkey").agg(F.count("l_orderkey").alias("later_lines"))


@query("""SELECT o_orderkey, c_mktsegment, n_name, r_name, s.n AS lines, s.parts FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1) s ON s.l_orderkey = o_orderkey""")
def wide_star(spark, sf):
    o, c, n, r, l = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region", "lineitem"))
    s = l.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("l_partkey").alias("parts"))
    j = o.join(c, F.col("c_custkey") == F.col("o_custkey"), "left").join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(r, F.col("r_regionkey") == F.col("n_regionkey"), "left").join(s, "o_orderkey", "left")
    return j.select("o_orderkey", "c_mktsegment", "n_name", "r_name", "lines", "parts")


@query("""WITH RECURSIVE e AS (SELECT 'r' || r_regionkey AS parent, 'n' || n_nationkey AS child FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier),
w AS (SELECT 'r1' AS node, 0 AS depth UNION ALL SELECT e.child, w.depth + 1 FROM w JOIN e ON e.parent = w.node) SELECT node, depth FROM w""")
def recursive_dependency(spark, sf):
    n, s = table(spark, sf, "nation"), table(spark, sf, "supplier")
    n.select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("child")).union(s.select(F.concat(F.lit("n"), "s_nationkey"), F.concat(F.lit("s"), "s_suppkey"))).createOrReplaceTempView("dependency_edges")
    return spark.sql("WITH RECURSIVE w(node, depth) AS (SELECT 'r1', 0 UNION ALL SELECT e.child, w.depth + 1 FROM w JOIN dependency_edges e ON e.parent = w.node) SELECT node, depth FROM w")


@query("SELECT event_id, (props->>'$.k')::INT AS k FROM events WHERE (props->>'$.k')::INT BETWEEN 20 AND 40")
def json_path_filter(spark, sf):
    k = F.expr("variant_get(parse_json(props), '$.k', 'int')")
    return _events(spark, sf).select("event_id", k.alias("k")).where("k BETWEEN 20 AND 40")


@query("SELECT o_custkey, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def json_rows_inline(spark, sf):
    from ..sources.scans import json_rows

    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.to_json(F.collect_list(F.struct("o_orderkey"))).alias("body"))
    return json_rows(o, "body", "o_orderkey: bigint").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT p_partkey, p_name AS a, NULL::VARCHAR AS b, p_size::VARCHAR AS c FROM part")
def array_zip_components(spark, sf):
    literal = F.concat(F.lit('{"'), "p_name", F.lit('",NULL,'), "p_size", F.lit("}"))
    m = text.zip_components(F.array(F.lit("a"), F.lit("b"), F.lit("c")), text.parse_array_literal(literal))
    return table(spark, sf, "part").select("p_partkey", m.alias("m")).select("p_partkey", F.col("m.a").alias("a"), F.col("m.b").alias("b"), F.col("m.c").alias("c"))


@query("""SELECT p_partkey, regexp_extract(p_brand, '^[A-Za-z]+') AS prefix, CASE WHEN regexp_extract(p_brand, '#([0-9]+)', 1) = '' THEN NULL ELSE regexp_extract(p_brand, '#([0-9]+)', 1)::INT END AS number, len(regexp_extract_all(p_name, 'e'))::INT AS es,
 regexp_replace(p_name, 'RED|BLUE', 'colour', 'gi') AS renamed, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'PROMO' THEN 2 ELSE 9 END AS code FROM part""")
def regex_code_mapping(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.regexp_extract("p_brand", "^[A-Za-z]+", 0).alias("prefix"), F.nullif(F.regexp_extract("p_brand", "#([0-9]+)", 1), F.lit("")).try_cast("int").alias("number"), F.regexp_count("p_name", F.lit("e")).alias("es"), F.regexp_replace("p_name", "(?i)RED|BLUE", "colour").alias("renamed"), text.code_label(F.col("p_type"), {"ECONOMY": 1, "PROMO": 2}, 9).alias("code"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' ELSE 'high' END AS band, concat(c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, '-', c_nationkey) AS address,
 nullif(trim(CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE c_mktsegment END), '') AS cleaned FROM customer""")
def address_concat(spark, sf):
    k = F.col("c_custkey")
    band = text.status_ladder((F.col("c_acctbal") < 0, "debt"), (F.col("c_acctbal") < 1000, "low"), default="high")
    return table(spark, sf, "customer").select("c_custkey", band.alias("band"), text.concat_skipping_null(F.col("c_name"), F.when(k % 3 != 0, F.col("c_mktsegment")), F.lit("-"), F.col("c_nationkey").cast("string")).alias("address"), text.blank_to_null(F.when(k % 4 == 0, "  ").otherwise(F.col("c_mktsegment"))).alias("cleaned"))


@query("SELECT count(*) FILTER (s <> 'F') AS strict_kept, count(*) FILTER (s IS DISTINCT FROM 'F') AS null_kept FROM (SELECT CASE WHEN o_orderkey % 17 <> 0 THEN o_orderstatus END AS s FROM orders)")
def soft_delete_variants(spark, sf):
    s = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderstatus")).alias("s"))
    return s.agg(F.count_if(text.not_deleted_strict(F.col("s"), "F")).alias("strict_kept"), F.count_if(text.not_deleted(F.col("s"), "F")).alias("null_kept"))


@query("""SELECT o_custkey, string_agg(o_orderstatus || o_orderkey, '; ' ORDER BY o_orderkey) AS joined, bool_or(o_totalprice > 400000) AS any_big, bool_and(o_totalprice > 10000) AS all_some, (array_agg(o_orderkey ORDER BY o_orderdate, o_orderkey))[1] AS first_key, count(DISTINCT (o_orderstatus, o_orderpriority)) AS kinds FROM orders GROUP BY 1""")
def ordered_aggregates(spark, sf):
    o = table(spark, sf, "orders")
    o.createOrReplaceTempView("orders_for_aggregates")
    return spark.sql("""SELECT o_custkey, listagg(o_orderstatus || o_orderkey, '; ') WITHIN GROUP (ORDER BY o_orderkey) AS joined, bool_or(o_totalprice > 400000) AS any_big, bool_and(o_totalprice > 10000) AS all_some,
        min(struct(o_orderdate, o_orderkey)).o_orderkey AS first_key, count(DISTINCT struct(o_orderstatus, o_orderpriority)) AS kinds FROM orders_for_aggregates GROUP BY o_custkey""")


@query(f"""SELECT event_id, {sql_instant("((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Vienna')", 'local')}, 'ok' AS status FROM events""")
def local_to_utc(spark, sf):
    e = _events(spark, sf).withColumn("local", timeutil.utc_to_local(F.col("ts"), ZONE))
    back = timeutil.local_to_utc_strict(F.col("local"), ZONE)
    return e.select("event_id", instant("local"), F.when(back == F.col("ts"), timeutil.local_status(F.col("local"), ZONE)).alias("status"))


@query("""WITH e AS (SELECT (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Vienna' AS l, CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 21 = 0 THEN ts + INTERVAL 1 HOUR ELSE ts END AS u, ts AS e FROM events)
SELECT date_diff('minute', u, l)::BIGINT AS offset_minutes, count(*) AS total_rows, count(*) FILTER (u = e) AS correct, count(*) FILTER (u IS NULL) AS missing, 0::BIGINT AS unexpected, count(*) FILTER (u <> e) AS wrong FROM e GROUP BY 1""")
def utc_validation(spark, sf):
    from ..operators.quality import utc_validation as check

    k, t = F.col("event_id"), F.col("ts")
    e = _events(spark, sf).select(timeutil.utc_to_local(t, ZONE).alias("l"), F.when(k % 20 == 0, None).when(k % 21 == 0, t + F.expr("INTERVAL 1 HOUR")).otherwise(t).alias("u"), t.alias("e"))
    return check(e, "l", "u", F.col("e"))


@query("""SELECT p_partkey, 'MULTIPOLYGON' AS kind, p_size::DOUBLE AS xmin, (p_size + 10)::DOUBLE AS xmax FROM part""")
def geometry_text(spark, sf):
    x = F.col("p_size").cast("string")
    far = (F.col("p_size") + 10).cast("string")
    wkt = F.concat(F.lit("POLYGON (("), x, F.lit(" 0, "), far, F.lit(" 0, "), far, F.lit(" 5, "), x, F.lit(" 0))"))
    multi = geometry.to_multipolygon(wkt)
    return table(spark, sf, "part").select("p_partkey", geometry.geometry_type(multi).alias("kind"), geometry.bounds(multi).alias("b")).select("p_partkey", "kind", F.col("b.xmin").alias("xmin"), F.col("b.xmax").alias("xmax"))


@query("SELECT user_id, count(*) AS sessions, sum(n)::BIGINT AS events FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events)) GROUP BY 1, 2) GROUP BY 1")
def event_sessions(spark, sf):
    from ..streaming.changes import sessions

    return sessions(_events(spark, sf), "user_id", "ts", "30 minutes").groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("events"))


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS nth_change FROM events")
def change_order(spark, sf):
    from ..streaming.changes import batch_order

    return batch_order(_events(spark, sf), "user_id", "ts").select("user_id", "event_id", F.col("nth_change").cast("long").alias("nth_change"))


@query("SELECT c_mktsegment, c_custkey, count(*) OVER (PARTITION BY c_mktsegment, c_nationkey) AS same FROM customer")
def duplicate_marker(spark, sf):
    """Group sizes are aggregated and joined back, so a large group fills no window."""
    c = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_nationkey")
    n = c.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("same"))
    return c.join(n, ["c_mktsegment", "c_nationkey"]).select("c_mktsegment", "c_custkey", "same")


@query("SELECT o_custkey, count(*) AS n, string_agg('{\"k\":' || o_orderkey || ',\"s\":\"' || o_orderstatus || '\"}', ',' ORDER BY o_orderkey) AS body FROM orders GROUP BY 1")
def json_aggregate(spark, sf):
    one = F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s")))
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("o_orderkey", one.alias("j")))).alias("js"))
    return per.select("o_custkey", "n", F.array_join(F.transform("js", lambda x: x["j"]), ",").alias("body"))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, strftime(min(o_orderdate), '%Y-%m-%d') AS earliest, strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM (SELECT * FROM orders ORDER BY md5(o_orderkey::VARCHAR || 'cover') LIMIT 500) GROUP BY 1, 2""")
def coverage_sample(spark, sf):
    s = stats.hash_sample(table(spark, sf, "orders"), "o_orderkey", "cover", 500)
    return s.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("earliest"), F.max("o_orderdate").alias("latest")).select("o_orderstatus", "o_orderpriority", "n", day("earliest"), day("latest"))


@query("SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size END::INT AS version, CASE WHEN nullif(p_size - 20, 0) >= 10 THEN nullif(p_size - 20, 0) END::INT AS renovated FROM part")
def header_versions_and_years(spark, sf):
    header = F.when(F.col("p_size") % 9 == 0, "no header").otherwise(F.concat(F.lit("model Version: "), "p_size", F.lit(" of list")))
    return table(spark, sf, "part").select("p_partkey", text.header_version(header).alias("version"), text.plausible_year(F.col("p_size") - 20, F.lit(10)).alias("renovated"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_orderkey, l_linenumber, l_partkey) > (5000, 3, 700)")
def tuple_predicate(spark, sf):
    from ..sources.scans import tuple_after

    return table(spark, sf, "lineitem").where(tuple_after([F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], [F.lit(5000), F.lit(3), F.lit(700)])).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT o_custkey, count(*) FILTER (EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.09)) AS discounted, count(*) AS n FROM orders GROUP BY 1")
def filtered_count_exists(spark, sf):
    hit = table(spark, sf, "lineitem").where("l_discount > 0.09").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    j = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(hit, "o_orderkey", "left")
    return j.groupBy("o_custkey").agg(F.count("hit").alias("discounted"), F.count(F.lit(1)).alias("n"))


@query("SELECT c_nationkey, c_custkey, nth FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END DESC NULLS LAST, c_custkey) AS nth FROM customer) WHERE nth <= 3")
def sorted_with_null_placement(spark, sf):
    c = table(spark, sf, "customer").withColumn("b", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")))
    return stats.samples_per_category(c, "c_nationkey", [F.col("b").desc_nulls_last(), F.col("c_custkey")], 3).select("c_nationkey", "c_custkey", F.col("nth").cast("long").alias("nth"))


@query("""WITH l AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT o_orderkey, count(l_linenumber) AS links, sum(l_extendedprice::DECIMAL(20,2))::DOUBLE AS value, max(c_mktsegment) AS segment, CASE max(o_orderstatus) WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS state
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def current_state_view(spark, sf):
    o, c, l = (table(spark, sf, t) for t in ("orders", "customer", "lineitem"))
    d = [F.col(x).desc_nulls_last() for x in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    latest = temporal.latest_per_key(l, ["l_orderkey", "l_linenumber"], d)
    per = latest.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_linenumber").alias("links"), F.sum(F.col("l_extendedprice").cast("decimal(20,2)")).cast("double").alias("value"))
    j = o.join(per, "o_orderkey", "left").join(c, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("o_orderkey", F.coalesce("links", F.lit(0).cast("long")).alias("links"), "value", F.col("c_mktsegment").alias("segment"), text.code_label(F.col("o_orderstatus"), {"F": "final", "O": "open"}, "other").alias("state"))


@query("SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_windows(spark, sf):
    e = _events(spark, sf)
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


@query(f"SELECT user_id, event_id, {sql_instant('ts')} FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_latest_state(spark, sf):
    """Latest event of each user as a streaming aggregation over the events as files, run to completion; what changes goes
    to a bucketed table in the shared folder, batch by batch."""
    from ..plans.shared import shared_dir
    from ..plans.store import current
    from ..streaming.changes import latest_state, read_changes, upsert_sink

    root, schema = shared_dir(spark, "latest"), table(spark, sf, "events").schema
    state = latest_state(read_changes(spark, sf, schema, glob="events.parquet"), "user_id", "ts", ["event_id"])
    sink = upsert_sink(f"{root}/table", ["user_id"], "ts", buckets=8)
    q = state.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    return current(spark, f"{root}/table").select("user_id", "event_id", instant("ts"))


@query("""WITH l AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
e AS (SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
f AS (SELECT l_orderkey, l_linenumber AS first_line FROM l QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) = 1),
rooms AS (SELECT l_orderkey, sum(l_quantity::DECIMAL(20,2))::DOUBLE AS net, (sum(l_quantity::DECIMAL(20,2)) FILTER (EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25)))::DOUBLE AS usable FROM l GROUP BY 1),
zps AS (SELECT l_suppkey, sum(l_extendedprice::DECIMAL(20,2))::DOUBLE AS supplier_total FROM l GROUP BY 1),
comp AS (SELECT l_partkey, sum(l_quantity::DECIMAL(20,2))::DOUBLE AS returned FROM l WHERE l_returnflag = 'R' GROUP BY 1),
last AS (SELECT o_custkey, o_orderkey AS newest_order FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT l.l_orderkey, l.l_linenumber, p_name, s_name, sn.n_name AS supplier_nation, sr.r_name AS supplier_region, c_name, cn.n_name AS customer_nation, cr.r_name AS customer_region, e.event_type, f.first_line, net, usable, supplier_total, returned, newest_order
FROM l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer ON c_custkey = o.o_custkey LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN region cr ON cr.r_regionkey = cn.n_regionkey
LEFT JOIN part ON p_partkey = l.l_partkey LEFT JOIN supplier ON s_suppkey = l.l_suppkey LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey LEFT JOIN region sr ON sr.r_regionkey = sn.n_regionkey
LEFT JOIN e ON e.user_id = o.o_custkey LEFT JOIN f ON f.l_orderkey = l.l_orderkey LEFT JOIN rooms ON rooms.l_orderkey = l.l_orderkey LEFT JOIN zps ON zps.l_suppkey = l.l_suppkey LEFT JOIN comp ON comp.l_partkey = l.l_partkey LEFT JOIN last ON last.o_custkey = o.o_custkey""")
def wide_parts_view(spark, sf):
    """A star of fourteen left joins over latest versions.  Lines are dealt once by part, by supplier and by order, the
    customers' columns are joined to the orders first, and names of nations and regions come last.  Totals of parts and
    suppliers are aggregated before they are joined; windows are only over the latest lines of one order."""
    o, c, n, r, p, s, raw = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region", "part", "supplier", "lineitem"))
    d = lambda *cs: [F.col(x).desc_nulls_last() for x in cs]
    dec = lambda x: F.col(x).cast("decimal(20,2)")
    l = temporal.latest_per_key(raw, ["l_orderkey", "l_linenumber"], d("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"))
    e = temporal.latest_per_key(_events(spark, sf), ["user_id"], d("ts", "event_id")).select(F.col("user_id").alias("o_custkey"), "event_type")
    last = temporal.latest_per_key(o, ["o_custkey"], d("o_orderdate", "o_orderkey")).select("o_custkey", F.col("o_orderkey").alias("newest_order"))
    # both kinds of totals in one pass over the latest lines
    of = lambda kind, key, v: F.struct(F.lit(kind).alias("kind"), key.alias("key"), v.alias("v"))
    shares = F.array(of("supplier", F.col("l_suppkey"), dec("l_extendedprice")), of("part", F.when(F.col("l_returnflag") == "R", F.col("l_partkey")), dec("l_quantity")))
    totals = l.select(F.explode(shares).alias("x")).select("x.*").groupBy("kind", "key").agg(F.sum("v").cast("double").alias("total"))
    total = lambda kind, key, name: totals.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("total").alias(name))

    def dimension(df, key, to, cols, order):
        """Rows with their place among those of one key, so that sums take a line once."""
        w = Window.partitionBy(key)
        return df.withColumns({f"{to}_nth": F.row_number().over(w.orderBy(*order))}).select(F.col(key).alias(to), f"{to}_nth", *[F.col(x) if isinstance(x, str) else x(w) for x in cols])

    parts = dimension(p, "p_partkey", "l_partkey", ["p_name", lambda w: F.max(F.col("p_size") > 25).over(w).alias("large")], ["p_name"])
    suppliers = dimension(s, "s_suppkey", "l_suppkey", ["s_name", "s_nationkey"], ["s_name"])
    place = lambda of: n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias(f"{of[0]}_nationkey"), F.col("n_name").alias(f"{of}_nation"), F.col("r_name").alias(f"{of}_region"))
    orders = o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), "o_custkey", "left")
    orders = orders.join(e, "o_custkey", "left").join(last, "o_custkey", "left").drop("o_custkey")
    j = l.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    j = j.join(total("part", "l_partkey", "returned"), "l_partkey", "left").join(parts, "l_partkey", "left").drop("l_partkey")
    j = j.join(total("supplier", "l_suppkey", "supplier_total"), "l_suppkey", "left").join(suppliers, "l_suppkey", "left").drop("l_suppkey")
    quantity = F.when((F.coalesce("l_partkey_nth", F.lit(1)) == 1) & (F.coalesce("l_suppkey_nth", F.lit(1)) == 1), dec("l_quantity"))
    j = j.withColumns({"l_quantity": quantity, "_at": F.struct(F.col("l_shipdate").isNull(), "l_shipdate", "l_linenumber")})
    of_order = lambda x: F.when(F.col("l_orderkey").isNotNull(), x.over(Window.partitionBy("l_orderkey")))
    j = j.withColumns({"first_line": of_order(F.min("_at"))["l_linenumber"], "net": of_order(F.sum("l_quantity")).cast("double"), "usable": of_order(F.sum(F.when(F.col("large"), F.col("l_quantity")))).cast("double")})
    j = j.drop("_at", "l_shipdate").join(orders, "l_orderkey", "left").join(place("customer"), "c_nationkey", "left").join(place("supplier"), "s_nationkey", "left")
    return j.select("l_orderkey", "l_linenumber", "p_name", "s_name", "supplier_nation", "supplier_region", "c_name", "customer_nation", "customer_region", "event_type", "first_line", "net", "usable", "supplier_total", "returned", "newest_order")


@query("""WITH w AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2026-03-29 00:00:00' ELSE TIMESTAMP '2026-10-25 00:00:00' END + (event_id % 360) * INTERVAL 1 MINUTE AS l FROM events),
n AS (SELECT *, (((l - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Vienna' = l)::INT + (((l - INTERVAL 2 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Vienna' = l)::INT AS hits FROM w)
SELECT event_id, CASE hits WHEN 0 THEN 'gap' WHEN 1 THEN 'ok' ELSE 'overlap' END AS status FROM n""")
def local_time_edges(spark, sf):
    """Wall times around both changes of daylight saving: gaps, overlaps and their neighbours."""
    k = F.col("event_id")
    wall = F.when(k % 2 == 0, ts("2026-03-29")).otherwise(ts("2026-10-25")) + (k % 360) * F.expr("INTERVAL 1 MINUTE")
    return _events(spark, sf).select("event_id", timeutil.local_status(wall.cast("timestamp_ntz"), ZONE).alias("status"))


@query("""WITH a AS (SELECT s_suppkey AS id, ((s_suppkey * 53) % 400)::DOUBLE AS x, ((s_suppkey * 97) % 400)::DOUBLE AS y, (30 + s_suppkey % 60)::DOUBLE AS w, (30 + s_suppkey % 41)::DOUBLE AS h FROM supplier),
b AS (SELECT p_partkey AS id, ((p_partkey * 37) % 400)::DOUBLE AS x, ((p_partkey * 91) % 400)::DOUBLE AS y, p_size::DOUBLE AS w, (5 + p_size % 17)::DOUBLE AS h FROM part),
c AS (SELECT a.id AS a_id, b.id AS b_id, 100 * greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0) / (b.w * b.h) AS pct FROM a, b)
SELECT a_id, b_id, round(pct, 6) AS covered_pct FROM c WHERE pct >= 50 - 1e-9""")
def spatial_coverage(spark, sf):
    """Pairs of areas of which the first covers at least half of the second."""
    from ..operators.spatial import coverage_join

    def box(df, id_, x, y, w, h):
        at = lambda a, b: F.concat(a.cast("double").cast("string"), F.lit(" "), b.cast("double").cast("string"))
        ring = F.concat_ws(", ", at(x, y), at(x + w, y), at(x + w, y + h), at(x, y + h), at(x, y))
        return df.select(F.col(id_).alias("id"), F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("wkt"))

    s, p = F.col("s_suppkey"), F.col("p_partkey")
    a = box(table(spark, sf, "supplier"), "s_suppkey", s * 53 % 400, s * 97 % 400, s % 60 + 30, s % 41 + 30)
    b = box(table(spark, sf, "part"), "p_partkey", p * 37 % 400, p * 91 % 400, F.col("p_size"), F.col("p_size") % 17 + 5)
    pairs = coverage_join(a.withColumnRenamed("id", "a_id"), b.withColumnRenamed("id", "b_id"), "a_id", "b_id", "wkt", 50)
    return pairs.select("a_id", "b_id", F.round("covered_pct", 6).alias("covered_pct"))


@query("""WITH t AS (SELECT user_id, event_id, value, row_number() OVER w AS nth, min(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent, list_sort(list(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 3 PRECEDING)) AS b FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT *, b[len(b) // 2 + 1] AS baseline FROM t) SELECT user_id, event_id, nth::INT AS nth, baseline FROM m WHERE nth >= 6 AND baseline > 0 AND recent >= baseline * 2""")
def sustained_slowdowns(spark, sf):
    """Users whose last three events all took at least twice the median of those before."""
    return stats.slowdowns(_events(spark, sf), "user_id", ["ts", "event_id"], "value").select("user_id", "event_id", "nth", "baseline")


@query("""WITH a AS (SELECT l_orderkey AS u, l_linenumber AS part, l_orderkey * 100 + l_linenumber * 10 + l_partkey % 10 AS id, CASE WHEN l_partkey % 17 <> 0 THEN l_extendedprice::DECIMAL(20,2) END AS v FROM lineitem),
b AS (SELECT l_orderkey AS u, min(l_linenumber) AS part, l_orderkey AS id, (sum(l_extendedprice::DECIMAL(20,2)) + l_orderkey % 3)::DECIMAL(20,2) AS v FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY l_orderkey),
pa AS (SELECT u, count(DISTINCT part) AS n, count(*) > count(DISTINCT part) OR count(*) > count(DISTINCT id) AS amb, CASE WHEN count(v) = count(*) THEN sum(v) END AS v FROM a GROUP BY u),
pb AS (SELECT u, count(DISTINCT part) AS n, false AS amb, CASE WHEN count(v) = count(*) THEN sum(v) END AS v FROM b GROUP BY u),
j AS (SELECT coalesce(pa.u, pb.u) AS u, coalesce(pa.n, 0) AS a_parts, coalesce(pb.n, 0) AS b_parts, coalesce(pa.amb, false) OR coalesce(pb.amb, false) AS amb, pa.v AS av, pb.v AS bv FROM pa FULL JOIN pb ON pa.u = pb.u)
SELECT u, a_parts, b_parts, CASE WHEN NOT amb THEN av END::DOUBLE AS a_total, CASE WHEN NOT amb THEN bv END::DOUBLE AS b_total, CASE WHEN NOT amb THEN av - bv END::DOUBLE AS delta,
 CASE WHEN amb THEN 'AMBIGUOUS' WHEN av IS NULL THEN 'MISSING_A' WHEN bv IS NULL THEN 'MISSING_B' WHEN abs(av - bv) > 1 THEN 'DIFFERENT' ELSE 'EQUAL' END AS status FROM j""")
def parts_before_compare(spark, sf):
    l = table(spark, sf, "lineitem")
    k, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(20,2)")
    a = l.select(k.alias("u"), F.col("l_linenumber").alias("part"), (k * 100 + F.col("l_linenumber") * 10 + F.col("l_partkey") % 10).alias("id"), F.when(F.col("l_partkey") % 17 != 0, price).alias("v"))
    b = l.where(k % 7 != 0).groupBy(k.alias("u")).agg(F.min("l_linenumber").alias("part"), F.sum(price).alias("s")).select("u", "part", F.col("u").alias("id"), (F.col("s") + F.col("u") % 3).cast("decimal(20,2)").alias("v"))
    out = value.compare_parts(a, b, "u", "part", "id", "v", F.lit(1).cast("decimal(10,2)"))
    return out.select("u", "a_parts", "b_parts", *[F.col(c).cast("double").alias(c) for c in ("a_total", "b_total", "delta")], "status")


@query("""WITH a AS (SELECT o_orderkey AS u, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey END AS result, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS v, CASE WHEN o_orderkey % 13 = 0 THEN 'e' WHEN o_orderkey % 14 = 0 THEN ' ' END AS error FROM orders WHERE o_orderkey % 10 <> 0),
b AS (SELECT o_orderkey AS u, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey + o_orderkey % 2 END AS v, CASE WHEN o_orderkey % 17 = 0 THEN 'e' END AS error, 60 + (o_orderkey % 19 = 0)::INT AS m FROM orders WHERE o_orderkey % 11 <> 0 UNION ALL SELECT o_orderkey, 1, NULL, 60 FROM orders WHERE o_orderkey % 23 = 0),
ga AS (SELECT u, count(*) AS n, max(result) AS result, max(v) AS v, bool_or(nullif(trim(error), '') IS NOT NULL) AS e FROM a GROUP BY u), gb AS (SELECT u, count(*) AS n, max(v) AS v, bool_or(nullif(trim(error), '') IS NOT NULL) AS e, max(m) AS m FROM b GROUP BY u),
j AS (SELECT coalesce(ga.u, gb.u) AS u, CASE WHEN coalesce(ga.n, 0) > 1 OR coalesce(gb.n, 0) > 1 THEN 'AMBIGUOUS' WHEN gb.n = 1 AND gb.m IS DISTINCT FROM 60 THEN 'VERSION_MISMATCH' END AS diagnostic, ga.result, gb.n AS bn, ga.v AS av, gb.v AS bv, ga.e AS ae, gb.e AS be FROM ga FULL JOIN gb ON ga.u = gb.u),
p AS (SELECT *, concat_ws(',', CASE WHEN result IS NULL THEN 'MISSING_A' END, CASE WHEN bn IS NULL THEN 'MISSING_B' END, CASE WHEN ae THEN 'ERROR_A' END, CASE WHEN be THEN 'ERROR_B' END, CASE WHEN av IS NULL AND result IS NOT NULL THEN 'NO_VALUE_A' END, CASE WHEN bv IS NULL AND bn IS NOT NULL THEN 'NO_VALUE_B' END) AS ps FROM j)
SELECT u, diagnostic, CASE WHEN diagnostic IS NULL THEN CASE WHEN ps <> '' THEN ps WHEN av = bv THEN 'EQUAL' ELSE 'DIFFERENT' END END AS problems, CASE WHEN diagnostic IS NULL AND ps = '' THEN av - bv END AS delta FROM p""")
def problems_and_diagnostics(spark, sf):
    o = table(spark, sf, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    a = o.where(k % 10 != 0).select(k.alias("u"), F.when(k % 9 != 0, k).alias("result"), F.when(k % 4 != 0, c).alias("v"), F.when(k % 13 == 0, "e").when(k % 14 == 0, " ").alias("error"))
    b = o.where(k % 11 != 0).select(k.alias("u"), F.when(k % 5 != 0, c + k % 2).alias("v"), F.when(k % 17 == 0, "e").alias("error"), (F.lit(60) + (k % 19 == 0).cast("int")).alias("model_version"))
    b = b.union(o.where(k % 23 == 0).select(k, F.lit(1).cast("long"), F.lit(None).cast("string"), F.lit(60)))
    return value.compare_with_problems(a, b, "u", "v", F.lit(60)).withColumn("problems", F.array_join("problems", ","))


@query("SELECT 'p_partkey' AS column_name, count(*) AS row_count, 0::BIGINT AS null_count, min(p_partkey)::VARCHAR AS low, max(p_partkey)::VARCHAR AS high FROM part UNION ALL SELECT 'p_brand', count(*), count(*) FILTER (p_size % 5 = 0), min(p_brand) FILTER (p_size % 5 <> 0), max(p_brand) FILTER (p_size % 5 <> 0) FROM part")
def column_statistics(spark, sf):
    from ..sources.scans import column_statistics as facts

    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("p_brand"))
    return facts(p).drop("about_distinct")


@query("WITH e AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part) SELECT least(floor((p_retailprice - lo) * 10 / (hi - lo)), 9)::INT AS bin, count(*) AS n FROM part, e GROUP BY 1")
def value_histogram(spark, sf):
    from ..sources.scans import value_histogram as histogram

    return histogram(table(spark, sf, "part"), "p_retailprice", 10)
