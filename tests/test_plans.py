"""Plan shape, with Spark's own broadcasts off so that only ours remain."""

import pytest

from tidings.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(spark, name):
    return catalogue.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["union_topics_dedup", "ingest_topic_cap", "relevance_mart", "density_relevance", "graph_relations_upsert",
                                  "relation_lifecycle", "relation_asof_dates", "interval_overlaps", "confidence_merge", "facets", "graph_mentions"])
def test_no_cross_or_nested_loop_join(no_auto_broadcast, name):
    p = plan(no_auto_broadcast, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["union_topics_dedup", "ingest_topic_cap"])
def test_rank_limits_run_before_the_shuffle(no_auto_broadcast, name):
    assert plan(no_auto_broadcast, name).count("WindowGroupLimit") == 2


def test_scans_read_only_what_they_need(no_auto_broadcast):
    p = plan(no_auto_broadcast, "nonempty_scan")
    assert "ReadSchema: struct<text:string,source:string>" in p and "Not(EqualTo(text,))" in p
    assert "text" not in plan(no_auto_broadcast, "facets")


def test_tokens_are_made_once_per_row(no_auto_broadcast):
    """No emptiness filter in front of the explode that would tokenise again."""
    p = plan(no_auto_broadcast, "relevance_mart")
    assert "Filter ((size(regexp_extract_all" not in p
