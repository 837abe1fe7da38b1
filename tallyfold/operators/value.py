"""Comparison of two valuations of the same units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compare_status(a: Column, b: Column, tolerance: Column, error_a: Column | None = None, error_b: Column | None = None) -> Column:
    """ERROR_A > ERROR_B > MISSING_A > MISSING_B > DIFFERENT (beyond the tolerance) > EQUAL."""
    out = F.when(F.coalesce(error_a, F.lit(False)), "ERROR_A") if error_a is not None else F.when(F.lit(False), "")
    if error_b is not None:
        out = out.when(F.coalesce(error_b, F.lit(False)), "ERROR_B")
    return out.when(a.isNull(), "MISSING_A").when(b.isNull(), "MISSING_B").when(F.abs(a - b) > tolerance, "DIFFERENT").otherwise("EQUAL")


def exact_status(a: Column, b: Column) -> Column:
    """Comparison without tolerance: BOTH_MISSING, MISSING_A, MISSING_B, EQUAL, A_HIGHER, B_HIGHER."""
    return F.when(a.isNull() & b.isNull(), "BOTH_MISSING").when(a.isNull(), "MISSING_A").when(b.isNull(), "MISSING_B").when(a == b, "EQUAL").when(a > b, "A_HIGHER").otherwise("B_HIGHER")


def round_tiers(value: Column) -> Column:
    """Half-up to 1 up to 100, 10 up to 10,000, 100 up to 500,000 and 1,000 beyond; negative is unknown."""
    v = value.cast("decimal(20,4)")
    to = lambda step: (F.round(v / step, 0) * step).cast("decimal(20,0)")
    return F.when(v < 0, None).when(v <= 100, to(1)).when(v <= 10_000, to(10)).when(v <= 500_000, to(100)).otherwise(to(1_000))


def whole_sum(c: str) -> Column:
    """Aggregate: the sum, or NULL if any part is NULL."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def guarded_pair(left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str) -> DataFrame:
    """Pair values only where each side has exactly one candidate; never choose among several."""
    one = lambda df, v, p: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{p}_n"), F.max(v).alias(f"{p}_v"))
    j = one(left, left_value, "l").join(one(right, right_value, "r"), keys, "full")
    pick = lambda p: F.when(F.col(f"{p}_n") == 1, F.col(f"{p}_v"))
    z = lambda p: F.coalesce(F.col(f"{p}_n"), F.lit(0))
    return j.select(*keys, z("l").alias("left_candidates"), z("r").alias("right_candidates"), pick("l").alias("left_value"), pick("r").alias("right_value"), ((z("l") > 1) | (z("r") > 1)).alias("ambiguous"))


def pair_at_cutoff(units: DataFrame, results: DataFrame, valuations: DataFrame, cutoff: Column, model: str, version: int, tolerance: Column) -> DataFrame:
    """Prepared units against calculated results (side A) and dated valuations (side B) at a cutoff.

    ``units(unit, prepared_id, prep_error)``, ``results(prepared_id, result_id, calculated, generalized,
    calc_error)``, ``valuations(unit, source_id, model, model_ver, status, valid_from, valid_to,
    calculated, generalized)``.  Deleted valuations (status X; NULL is not deleted) do not count; an
    error record of the version is authoritative.  The two amounts are classified independently.
    """
    clean = lambda c: F.nullif(F.trim(c), F.lit(""))
    copies = units.groupBy("unit").agg(F.count(F.lit(1)).alias("prepared_n"))
    a = results.groupBy("prepared_id").agg(F.count(F.lit(1)).alias("a_n"), F.max("calculated").alias("a_calc"), F.max("generalized").alias("a_gen"), F.max("result_id").alias("a_id"), F.bool_or(clean(F.col("calc_error")).isNotNull()).alias("a_error"))
    live = ~F.col("status").eqNullSafe(F.lit("X")) & (F.col("model_ver") == version)
    mine = live & (F.col("model") == model)
    valid = valuations.where((F.col("valid_from") <= cutoff) & (F.col("valid_to").isNull() | (F.col("valid_to") > cutoff)))
    one = lambda c: F.max(F.when(mine, F.col(c)))
    b = valid.groupBy("unit").agg(F.count_if(mine).alias("b_n"), one("calculated").alias("b_calc"), one("generalized").alias("b_gen"), one("source_id").alias("b_id"), F.bool_or(F.coalesce(live & (F.col("model") == "ERROR"), F.lit(False))).alias("b_error"))
    j = units.join(copies, "unit", "left").join(a, "prepared_id", "left").join(b, "unit", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    problem = F.when((n("prepared_n") > 1) | (n("a_n") > 1) | (n("b_n") > 1), "AMBIGUOUS").when(clean(F.col("prep_error")).isNotNull() | F.coalesce("a_error", F.lit(False)), "ERROR_A").when(F.col("b_error"), "ERROR_B")
    j = j.withColumn("problem", problem)
    for p in ("a", "b"):
        for v in ("calc", "gen", "id"):
            j = j.withColumn(f"{p}_{v}", F.when(F.col(f"{p}_n") == 1, F.col(f"{p}_{v}")))
    delta = lambda v: F.when(F.col("problem").isNull(), F.col(f"a_{v}") - F.col(f"b_{v}"))
    status = lambda v: F.coalesce(F.col("problem"), compare_status(F.col(f"a_{v}"), F.col(f"b_{v}"), tolerance))
    return j.select("unit", "prepared_id", F.col("a_id").alias("result_id"), F.col("b_id").alias("source_id"), "a_calc", "b_calc", delta("calc").alias("delta_calc"), status("calc").alias("status_calc"), "a_gen", "b_gen", delta("gen").alias("delta_gen"), status("gen").alias("status_gen"))


def translate_components(a: DataFrame, b: DataFrame, rules: DataFrame, ids: list[str]) -> DataFrame:
    """Components of side A matched to fields of side B by a rule table; what has no rule stays visible.

    ``a(ids, key, value)``, ``b(ids, field, value)``, ``rules(key, field, grp)``.
    """
    va = a.select(*ids, "key", F.col("value").alias("a_value"))
    vb = b.select(*ids, "field", F.col("value").alias("b_value"))
    units = a.select(*ids).union(b.select(*ids)).distinct()
    if rules.count() > 10_000:
        raise ValueError("rules are a small table")
    wanted = units.crossJoin(F.broadcast(rules))  # a row per unit and rule, as the result has
    ruled = wanted.join(va, [*ids, "key"], "left").join(vb, [*ids, "field"], "left")
    status = F.when(F.col("a_value").isNull() & F.col("b_value").isNull(), "MISSING_A").otherwise(compare_status(F.col("a_value"), F.col("b_value"), F.lit(0)))
    out = ruled.select(*ids, "key", "field", "grp", "a_value", "b_value", status.alias("status"))
    left_a = va.join(F.broadcast(rules.select("key").distinct()), "key", "left_anti").select(*ids, "key", "a_value", F.lit("UNTRANSLATED").alias("status"))
    left_b = vb.join(F.broadcast(rules.select("field").distinct()), "field", "left_anti").select(*ids, "field", "b_value", F.lit("UNTRANSLATED").alias("status"))
    return out.unionByName(left_a, allowMissingColumns=True).unionByName(left_b, allowMissingColumns=True)


def decompose(total_a: Column, total_b: Column, parts: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Difference of totals as named part differences, with what they leave ``unexplained`` (decimal, exact)."""
    out = {f"d_{k}": x - y for k, (x, y) in parts.items()}
    explained = sum(out.values(), F.lit(0))
    return out | {"delta": total_a - total_b, "unexplained": (total_a - total_b) - explained}


def assert_explained(df: DataFrame, column: str = "unexplained") -> DataFrame:
    if not df.where(F.col(column) != 0).isEmpty():
        raise ValueError("differences do not add up")
    return df


def problem_list(**conditions: Column) -> Column:
    """Array of the names whose condition is true."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in conditions.items()]))


def share_minus_area(parcels: DataFrame, scopes: DataFrame, units: DataFrame, buildings: DataFrame, parts: DataFrame, links: DataFrame, far: str = "2100-01-01") -> DataFrame:
    """Rule value ``max(share - sum of linked areas, 0)`` for included parcels.

    The latest load of each link version counts once; a link counts if its building has an included part
    in the parcel's scope and the unit's end (the far date if open) is not after the link's end.  No known
    unit gives NULL, no counted link the previous value, no share NULL; parcels that are not included keep
    the previous value.  All lookups are equi-joins; several parts or rows of a building count once.

    Links are read once and summed per parcel, building and end before anything is joined to them, and parcels meet
    them through the buildings of their own scope, on parcel and building: no target meets links of
    buildings that cannot count.
    """
    prev = F.when(F.col("is_insert"), None).otherwise(F.col("previous"))
    target = parcels.where(F.col("included")).select("id", "scope_id", "parcel_id", "share", prev.alias("prev"))
    version = ["link_id", "date_from", "date_to"]
    latest = links.groupBy(*version).agg(F.max(F.struct("loaded_at", "parcel_id", "building_id", "area")).alias("l")).select("date_to", "l.parcel_id", "l.building_id", "l.area")
    live = buildings.join(parts.where(F.col("included")).select(F.col("building_row").alias("id")).distinct(), "id", "left_semi").select("scope_id", "building_id").distinct()
    sums = latest.join(live.select("building_id").distinct(), "building_id", "left_semi").groupBy("parcel_id", "building_id", "date_to").agg(F.sum("area").alias("area"))
    ends = scopes.select(F.col("id").alias("scope_id"), "unit_id").join(units.select(F.col("id").alias("unit_id"), F.coalesce("valid_to", F.lit(far).cast("timestamp_ntz")).alias("unit_end")), "unit_id")
    asked = target.select("scope_id", "parcel_id").distinct().join(ends, "scope_id").join(live, "scope_id")
    counted = asked.join(sums, ["parcel_id", "building_id"]).where("unit_end <= date_to")
    area = counted.groupBy("scope_id", "parcel_id").agg(F.sum("area").alias("area"))
    t = target.join(scopes.select(F.col("id").alias("scope_id"), "unit_id"), "scope_id", "left").join(area, ["scope_id", "parcel_id"], "left")
    new = F.when(F.col("unit_id").isNull(), None).when(F.col("area").isNull(), F.col("prev")).when(F.col("share").isNull(), None).otherwise(F.greatest(F.col("share") - F.col("area"), F.lit(0).cast("decimal(20,2)")))
    calc = t.select("id", new.alias("new_value"), F.lit(True).alias("ruled"))
    return parcels.join(calc, "id", "left").withColumn("actual", F.when(F.col("ruled"), F.col("new_value")).otherwise(F.col("previous"))).drop("new_value", "ruled")


def select_whole_groups(rows: DataFrame, group: str, effective: Column, available: DataFrame, name: str, lead: Column | None = None) -> DataFrame:
    """Groups of which every row's effective value is available (and that have a leading row)."""
    e = rows.withColumn("_e", effective)
    bad = e.join(available.select(F.col(name).alias("_e")), "_e", "left_anti").select(group).distinct()
    keep = (e if lead is None else e.where(lead)).select(group).distinct()
    return keep.join(bad, group, "left_anti")


def selection_diff(manual: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    m = manual.select(key).distinct().withColumn("_m", F.lit(True))
    s = stored.select(key).distinct().withColumn("_s", F.lit(True))
    side = F.when(F.col("_s").isNull(), "manual_only").when(F.col("_m").isNull(), "stored_only").otherwise("both")
    return m.join(s, key, "full").select(key, side.alias("side"))


def compare_parts(a: DataFrame, b: DataFrame, unit: str, part: str, row_id: str, value: str, tolerance: Column) -> DataFrame:
    """Totals over the parts of each unit, compared; parts are never paired by their position.

    A total is missing if one part's value is; a side on which a row or a part comes twice is ambiguous, and then
    neither total nor difference is given.
    """

    def side(df: DataFrame, p: str) -> DataFrame:
        per = df.groupBy(unit, part).agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("known"), F.sum(value).alias("v"))
        rows = df.groupBy(unit, row_id).agg(F.count(F.lit(1)).alias("m")).groupBy(unit).agg((F.max("m") > 1).alias("twice"))
        sums = per.groupBy(unit).agg(F.count(F.lit(1)).alias(f"{p}_parts"), (F.max("n") > 1).alias("several"), (F.sum("known") == F.sum("n")).alias("whole"), F.sum("v").alias("total"))
        return sums.join(rows, unit).select(unit, f"{p}_parts", (F.col("several") | F.col("twice")).alias(f"{p}_ambiguous"), F.when(F.col("whole"), F.col("total")).alias(f"{p}_total"))

    j = side(a, "a").join(side(b, "b"), unit, "full")
    no = lambda c: F.coalesce(c, F.lit(False))
    ambiguous = no("a_ambiguous") | no("b_ambiguous")
    shown = lambda p: F.when(~ambiguous, F.col(f"{p}_total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    status = F.when(ambiguous, "AMBIGUOUS").otherwise(compare_status(F.col("a_total"), F.col("b_total"), tolerance))
    return j.select(unit, zero("a_parts"), zero("b_parts"), shown("a").alias("a_total"), shown("b").alias("b_total"), (shown("a") - shown("b")).alias("delta"), status.alias("status"))


def compare_with_problems(a: DataFrame, b: DataFrame, unit: str, value: str, version: Column) -> DataFrame:
    """One row a unit with all problems of its two sides, or DIFFERENT / EQUAL, and what keeps it from being compared.

    ``a(unit, result, value, error)``, ``b(unit, value, error, model_version)``.  Several candidates on a side or another
    model version than ``version`` are a ``diagnostic``; then no problem list and no difference is given.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    ga = a.groupBy(unit).agg(F.count(F.lit(1)).alias("a_n"), F.max("result").alias("result"), F.max(value).alias("a_v"), F.bool_or(blank("error").isNotNull()).alias("a_e"))
    gb = b.groupBy(unit).agg(F.count(F.lit(1)).alias("b_n"), F.max(value).alias("b_v"), F.bool_or(blank("error").isNotNull()).alias("b_e"), F.max("model_version").alias("b_m"))
    j = ga.join(gb, unit, "full")
    n = lambda c: F.coalesce(c, F.lit(0))
    diagnostic = F.when((n("a_n") > 1) | (n("b_n") > 1), "AMBIGUOUS").when(~F.col("b_m").eqNullSafe(version) & (n("b_n") == 1), "VERSION_MISMATCH")
    no_a, no_b = F.col("result").isNull(), n("b_n") == 0
    no = lambda c: F.coalesce(c, F.lit(False))
    found = problem_list(MISSING_A=no_a, MISSING_B=no_b, ERROR_A=no("a_e"), ERROR_B=no("b_e"), NO_VALUE_A=F.col("a_v").isNull() & ~no_a, NO_VALUE_B=F.col("b_v").isNull() & ~no_b)
    delta = F.when(diagnostic.isNull() & (F.size(found) == 0), F.col("a_v") - F.col("b_v"))
    verdict = F.when(F.size(found) > 0, found).otherwise(F.array(F.when(F.col("a_v") == F.col("b_v"), "EQUAL").otherwise("DIFFERENT")))
    return j.select(unit, diagnostic.alias("diagnostic"), F.when(diagnostic.isNull(), verdict).alias("problems"), delta.alias("delta"))
