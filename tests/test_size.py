"""Queries on larger tables: what they shuffle and hold, and rows that only odd tables show."""

import os
import re

import duckdb
import pytest

from tallyfold import catalogue
from tallyfold.operators import delta, quality
from tallyfold.plans import rewrite
from tallyfold.queries import reconcile

from .test_queries import TABLES, rows


@pytest.fixture
def odd(tmp_path, sf):
    """Copies of the smallest tables in which some are replaced: ``odd(part="SELECT ...")``."""

    def make(**replaced):
        con = duckdb.connect()
        for t in TABLES:
            if os.path.exists(f"{sf}/{t}.parquet"):
                con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        for t in TABLES:
            con.sql(f"COPY ({replaced.get(t, f'SELECT * FROM {t}')}) TO '{tmp_path}/{t}.parquet'")
        con.close()
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        return str(tmp_path), con

    return make


def same_as_sql(spark, name, at, con):
    df = catalogue.QUERIES[name](spark, at)
    want = con.sql(catalogue.ORACLES[name])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())
    return df


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")


def stages(df):
    """Operators between the exchanges of a plan, as ``(name, grouping keys)``."""
    out, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        at = re.match(r"[ :]*[+:]- ", line)
        if not at:
            continue
        deep, name = at.end(), re.sub(r"^\*?\(?\d*\)? ?", "", line[at.end() :])
        while above and above[-1][0] >= deep:
            above.pop()
        mine = above[-1][1] if above and not above[-1][2] else []
        if not mine:
            out.append(mine)
        keys = re.search(r"keys=\[(.*?)\], functions", name)
        mine.append((name.split("(")[0].split()[0], re.sub(r"#\d+L?", "", keys.group(1)) if keys else ""))
        above.append((deep, mine, name.startswith("Exchange")))
    return out


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["prove_source", "conflicting_duplicates"])
def test_no_task_holds_tables_of_two_kinds_of_keys(spark, sf, name):
    found = stages(catalogue.QUERIES[name](spark, sf))
    assert found and all(len({k for _, k in s if k}) <= 1 for s in found)


def test_proof_counts_nulls(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, None, "a"), (None, 1, "a"), (None, 1, "a"), (2, 1, "a")], "k long, n long, t string")
    got = lambda page: quality.prove_source(df, "k", page).first().asDict()
    assert got(["k", "n"]) == {"total_rows": 6, "null_keys": 2, "distinct_keys": 2, "distinct_pages": 2, "null_page_rows": 3}
    assert got(["n", "t"]) == {"total_rows": 6, "null_keys": 2, "distinct_keys": 2, "distinct_pages": 2, "null_page_rows": 1}


def test_anomalies_join_repeated_keys_only(spark, no_broadcast):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 5), (3, None), (None, 5), (None, None)], "key long, changed long")
    out = delta.anomalies(df, df.where("key = 1 AND changed IS NOT NULL"))
    assert not any("SortMergeJoin" in {n for n, _ in s} and any(k for _, k in s) for s in stages(out))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [("SOURCE", 1, 5, 2), ("SOURCE", 1, None, 2), ("SOURCE", 3, None, 1), ("SOURCE", None, 5, None), ("SOURCE", None, None, None)]))


def test_audit_join_keeps_its_tasks(spark, sf, no_broadcast):
    """Lines are grouped in the task that sorts both sides, so these tasks must not be merged to a few."""
    target = reconcile._audit_sides(spark, sf)[1]
    assert target.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_whole_rows_as_keys_need_no_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "k long, t string")
    spark.sparkContext.setJobGroup("collapse", "collapse")
    one = quality.collapse_identical(df, ["k", "t"])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("collapse")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert one.count() == 2
    with pytest.raises(ValueError, match="differ"):
        quality.collapse_identical(df, ["k"])


def test_copies_are_dealt_before_they_are_counted(spark, sf, no_broadcast):
    found = stages(catalogue.QUERIES["family_copy"](spark, sf))
    joins = [s for s in found if "SortMergeJoin" in {n for n, _ in s}]
    assert joins and not any(k == "id" and n == "HashAggregate" for s in joins if any(n == "Union" for n, _ in s) for n, k in s)


def test_family_join_keeps_its_tasks(spark, no_broadcast):
    """The semi join holds the table of wanted ids, so its tasks must not be merged to a few."""
    p = spark.range(1000).selectExpr("string(id) AS id", "string(NULL) AS origin")
    c = p.selectExpr("id", "id AS parent", "origin")
    added = rewrite.copy_family(p, c, p.union(p), "id", "parent", "ns")[0].where("origin IS NOT NULL")
    assert added.count() == 1000
    plan = added._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"LeftSemi(.|\n)*?REPARTITION_BY_NUM", plan)


def test_wide_view_deals_lines_once(spark, sf, no_broadcast):
    assert exchanges(catalogue.QUERIES["wide_parts_view"](spark, sf)) <= 26


def test_wide_view_of_repeated_dimensions(spark, odd):
    """A part or supplier found twice repeats its lines, and their order's sums stay."""
    twice = {"part": "SELECT * FROM part UNION ALL SELECT * REPLACE (p_name || '2' AS p_name) FROM part WHERE p_partkey % 3 = 0", "supplier": "SELECT * FROM supplier UNION ALL SELECT * REPLACE (s_name || '2' AS s_name) FROM supplier WHERE s_suppkey % 2 = 0"}
    at, con = odd(**twice, lineitem="SELECT * REPLACE (CASE WHEN l_orderkey % 9 <> 0 THEN l_orderkey END AS l_orderkey, CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END AS l_suppkey) FROM lineitem")
    same_as_sql(spark, "wide_parts_view", at, con)
