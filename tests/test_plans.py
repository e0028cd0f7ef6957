"""Plan-shape guards for the registered queries (no product joins, pushdown, partial limits)."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E

SF = os.environ.get("ZONELENS_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(fn(spark, SF)) for name, fn in E.queries().items()}


def test_no_product_joins(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad, bad


@pytest.mark.parametrize("name", ["top_asn", "ip_churn", "ns_domains", "ns_concentration", "kind_counts"])
def test_filters_and_columns_reach_the_scan(plans, name):
    p = plans[name]
    assert "ReadSchema: struct<" in p
    if name != "kind_counts":
        assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(k,", p)
    assert "ReadSchema: struct<k:string,topic:string,d:string,s:string,m:string" not in p   # pruned


@pytest.mark.parametrize("name", ["ns_audit_topk", "volume_audit", "sample_first_n"])
def test_ranked_filters_limit_before_the_shuffle(plans, name):
    assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name]


def test_partition_pruning(plans):
    assert "PartitionFilters: [isnotnull(half" in plans["top_asn"]
    assert "PartitionFilters: [isnotnull(date" in plans["ns_audit_recent"]


def test_distinct_counts_are_two_stage(plans):
    p = plans["volume_concentration"]
    assert "partial_count(distinct" in p
