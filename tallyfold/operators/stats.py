"""Reports: valuation statistics, grouped inventories, ties, calendars, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.search import rank_in
from ..functions.timeutil import local_day
from ..plans.shared import cut

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


BUCKETS = 64


def valuation_statistics(df: DataFrame, groups: list[str], value: str, error: str | None = None) -> DataFrame:
    """Counts, share without a value, sums, extremes, exact percentiles and deviation per group."""
    v = F.col(value)
    n, without = F.count(F.lit(1)), F.count_if(v.isNull())
    aggs = [
        n.alias("units"), without.alias("without_value"), F.count(value).alias("with_value"),
        F.round(100 * without / F.nullif(n, F.lit(0)), 2).cast("double").alias("without_pct"),
        F.sum(v.cast("decimal(20,2)")).cast("double").alias("total"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(v.cast("double")).alias("mean"),
        F.stddev_pop(v.cast("double")).alias("deviation"),
    ]
    if error:
        aggs.append(F.count_if(F.trim(error) != "").alias("errors"))
    base = cut(df.groupBy(*groups).agg(*aggs, _sketch(v)))  # a row a group
    sketch = base.select(F.struct(*groups).alias("g"), F.col("with_value").alias("all"), "_bounds")
    exact = _ranks(df, groups, value, sketch, QUANTILES).withColumnRenamed("g", "_g")
    return base.join(exact, F.struct(*groups) == F.col("_g"), "left").drop("_g", "_bounds")


def exact_percentiles(df: DataFrame, groups: list[str], value: str, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """``groups p05 p25 ...``: interpolated percentiles, exact, in memory that does not grow with a group."""
    sketch = df.groupBy(F.struct(*groups).alias("g")).agg(F.count(value).alias("all"), _sketch(F.col(value))).where(F.col("all") > 0)
    ranks = _ranks(df, groups, value, cut(sketch), quantiles)
    return ranks.select("g.*", *[c for c in ranks.columns if c != "g"])


def _sketch(v: Column) -> Column:
    return F.percentile_approx(v.cast("double"), [i / BUCKETS for i in range(1, BUCKETS)], 1000).alias("_bounds")


def _ranks(df: DataFrame, groups: list[str], value: str, sketch: DataFrame, quantiles: tuple[float, ...]) -> DataFrame:
    """Equal values are counted first.  A bounded sketch per group cuts its values into ``BUCKETS`` ranges; sums over the
    ranges tell in which of them the wanted ranks lie, whatever the sketch's error, and only those ranges are put in
    order.  The counted values are written once and read twice."""
    known = df.where(F.col(value).isNotNull()).groupBy(F.struct(*groups).alias("g"), F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    bucket = rank_in(F.col("_bounds"), F.col("v"), BUCKETS).alias("bucket")  # the sketch gives them in order
    placed = cut(known.join(sketch, "g").select("g", "v", "n", "all", bucket))
    sums = placed.groupBy("g", "all", "bucket").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows a group
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("q"), (F.lit(q) * (F.col("all") - 1)).alias("at"), F.lit(up).alias("up")) for i, q in enumerate(quantiles) for up in (0, 1)]))
    rank = F.least(F.floor(F.col("w.at")) + F.col("w.up"), F.col("all") - 1)
    hits = sums.withColumn("w", wanted).withColumn("rank", rank).where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
    hits = hits.select("g", "bucket", "before", F.struct("rank", "w.q", "w.up", (F.col("w.at") - F.floor(F.col("w.at"))).alias("frac")).alias("h"))
    asked = hits.groupBy("g", "bucket", "before").agg(F.collect_list("h").alias("hs"))  # two a quantile at most
    inside = Window.partitionBy("g", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ordered = placed.drop("all").join(asked, ["g", "bucket"]).withColumn("first", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    found = ordered.select("g", "v", "first", "n", F.explode("hs").alias("h")).where((F.col("h.rank") >= F.col("first")) & (F.col("h.rank") < F.col("first") + F.col("n")))
    end = lambda i, up: F.max(F.when((F.col("h.q") == i) & (F.col("h.up") == up), F.col("v")))
    part = lambda i: F.max(F.when(F.col("h.q") == i, F.col("h.frac")))
    names = [f"p{round(q * 100):02d}" for q in quantiles]
    return found.groupBy("g").agg(*[((1 - part(i)) * end(i, 0) + part(i) * end(i, 1)).alias(n) for i, n in enumerate(names)])


def slowdowns(df: DataFrame, series: str, order: list[str], value: str, last: int = 3, factor: float = 2.0, least: int = 6) -> DataFrame:
    """Rows at which the newest ``last`` measurements of a series are all at least ``factor`` times the (upper) median of
    those before them; a series starts to be judged with its ``least``-th measurement.

    A series is one run's measurements (pages of a load): its history is bounded and ordered in one task.
    """
    w = Window.partitionBy(series).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, -last)
    known = df.where(F.col(value).isNotNull())
    t = known.withColumns({"nth": F.row_number().over(w), "_before": F.array_sort(F.collect_list(value).over(upto)), "least_recent": F.min(value).over(w.rowsBetween(1 - last, 0))})
    t = t.withColumn("baseline", F.get("_before", F.floor(F.size("_before") / 2).cast("int"))).drop("_before")
    return t.where((F.col("nth") >= least) & (F.col("baseline") > 0) & (F.col("least_recent") >= F.col("baseline") * factor))


def tagged_union(parts: dict[str, DataFrame], tag: str = "unit_type") -> DataFrame:
    """UNION ALL of different tables with a tag; absent columns are NULL."""
    out = None
    for name, df in parts.items():
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def grouping_inventory(df: DataFrame, sets: list[list[str]], columns: list[str], aggs: list[Column]) -> DataFrame:
    """GROUPING SETS with one ``is_total_<column>`` flag per column."""
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    return out.agg(*aggs, *[F.grouping(c).cast("int").alias(f"is_total_{c}") for c in columns])


def timestamp_ties(df: DataFrame, changed: str, page: int) -> DataFrame:
    """Change times that several rows share: rows before them in order, and whether a page boundary cuts through.

    Running totals are taken per month on the counts and carried by the months' sums, so the order
    of all change times never meets in one task.
    """
    per = df.groupBy(changed).agg(F.count(F.lit(1)).alias("rows_at")).withColumn("_m", F.date_trunc("MONTH", changed))
    months = per.groupBy("_m").agg(F.sum("rows_at").alias("n"))
    carried = months.select("_m", F.coalesce(F.sum("n").over(Window.orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # one row a month
    inside = Window.partitionBy("_m").orderBy(changed).rowsBetween(Window.unboundedPreceding, -1)
    j = per.join(carried, "_m").withColumn("rows_before", F.col("base") + F.coalesce(F.sum("rows_at").over(inside), F.lit(0)))
    cut = F.floor(F.col("rows_before") / page) != F.floor((F.col("rows_before") + F.col("rows_at") - 1) / page)
    return j.where("rows_at > 1").select(changed, "rows_at", F.col("rows_before").cast("long").alias("rows_before"), cut.alias("straddles"))


def daily_local(df: DataFrame, changed: str, zone: str, groups: list[str], key: str) -> DataFrame:
    """Distinct keys and rows per local calendar day."""
    return df.groupBy(local_day(F.col(changed), zone).alias("day"), *groups).agg(F.count_distinct(key).alias("distinct_keys"), F.count(F.lit(1)).alias("row_count"))


def year_histogram(df: DataFrame, changed: str) -> DataFrame:
    return df.groupBy(F.year(changed).cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def top_by_delta(df: DataFrame, delta: Column, key: str, k: int) -> DataFrame:
    """The ``k`` largest absolute deltas (ties by key): a top-k report."""
    return df.withColumn("delta", delta).orderBy(F.abs("delta").desc(), key).limit(k)


def samples_per_category(df: DataFrame, category: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each category: a report's examples, limited per task before the shuffle."""
    w = Window.partitionBy(category).orderBy(*order)
    return df.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)


def hash_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """A sample that any engine reproduces: the ``n`` smallest MD5 of key and seed, with the pool's size."""
    pool = df.agg(F.count(F.lit(1)).alias("pool_size"))
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)).cast("binary"))
    return df.withColumn("_o", order).orderBy("_o").limit(n).drop("_o").crossJoin(pool)  # one row


def status_percentages(df: DataFrame, groups: list[str], status: str) -> DataFrame:
    """Rows and percentage of each status in its group (totals by aggregation, no window)."""
    per = df.groupBy(*groups, status).agg(F.count(F.lit(1)).alias("n"))
    total = per.groupBy(*groups).agg(F.sum("n").alias("total"))
    return per.join(total, groups).withColumn("pct", F.round(100 * F.col("n") / F.col("total"), 2).cast("double"))
