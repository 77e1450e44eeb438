"""Every registered query against its SQL on the smallest data, and its plan."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from innkeep.domain import load_queries
from compare import TABLES, rows_of, same_kind

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")

# Operators that a plan must not hold: row-at-a-time or all-pairs work.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")

# Queries whose result is one row or a first-n list, gathered at the end.
GATHERS = {
    "quality_gate", "quality_gate_columns", "day_count", "distinct_counts", "column_profile",
    "unparsed_report", "unparsed_samples", "next_pending_units",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


QUERIES, ORACLES = load_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = db.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    assert sorted(df.columns) == sorted(names)
    assert all(same_kind(f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields)
    assert got == rows_of(names, relation.fetchall())
    plan = final_plan(df)
    assert not [word for word in FORBIDDEN if word in plan]
    if name not in GATHERS:
        # rows spread by their number may need one task only, at this size
        gathered = [line for line in plan.splitlines() if "SinglePartition" in line]
        assert all("REPARTITION_BY_NUM" in line for line in gathered)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "unit_id" and df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def plan_of(spark, name):
    return final_plan(entry.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["latest_row", "first_by_order"])
def test_first_rows_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    partial, final = plan.index("Partial"), plan.index("Final")
    assert plan.count("WindowGroupLimit") >= 2
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_occupancy_needs_one_aggregation_and_no_sort(spark):
    plan = plan_of(spark, "monthly_occupancy").split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan
    assert "partial_bit_or" in plan


def test_daily_occupancy_aggregates_by_hash(spark):
    plan = plan_of(spark, "daily_occupancy")
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "pruned_scan")
    assert re.search(r"PushedFilters: \[.*EqualTo\(status_id,5\)", plan)
    assert "ReadSchema: struct<id:bigint,unit_id:bigint,status_id:bigint,startdate:date>" in plan


def test_unit_days_join_each_rate_table_once(spark):
    plan = plan_of(spark, "unit_day_sales").split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[[^\]]*l_extendedprice", plan)
    assert len(scans) == 2
