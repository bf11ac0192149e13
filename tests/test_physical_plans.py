"""What the plans must and must not hold, with broadcasts off as at scale."""

import pytest

import checks.dictionaries  # noqa: F401
from checks.feeds import history, raw_feeds
from checks.identity import crosswalk
from checks.registry import QUERIES
from checks.staged_tables import staged_table
from rosterlake.plans.catalog import APPEND, ENTITIES, NEW_ONLY
from rosterlake.plans.typed_load import build_rows
from rosterlake.session import METHOD_LIMIT

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check_joins(text):
    # Only the bounded tables of hot keys and of their lookup rows are broadcast.
    for line in text.splitlines():
        assert "BroadcastHashJoin" not in line or "_hot#" in line or "_h_" in line, line
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text
    assert "Window" not in text


@pytest.mark.parametrize("name", sorted(ENTITIES))
def test_typed_tables(spark, no_broadcast, name):
    entity = ENTITIES[name]
    text = plan(build_rows(entity, raw_feeds(spark, SF, name), history(spark, SF, name)))
    check_joins(text)
    if entity.rule == APPEND:
        assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    elif entity.rule == NEW_ONLY:
        assert "LeftAnti" in text


@pytest.mark.parametrize("name", ["send_jobs", "list_membership"])
def test_history_is_shuffled_once(spark, no_broadcast, name):
    df = build_rows(ENTITIES[name], raw_feeds(spark, SF, name), history(spark, SF, name))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # The rows when made distinct and when joined, and the history when grouped by key.
    assert final.count("Exchange hashpartitioning") == 3


def test_hot_keys_are_looked_for_before_the_distinct(spark, no_broadcast):
    text = plan(build_rows(ENTITIES["list_membership"], raw_feeds(spark, SF, "list_membership"), history(spark, SF, "list_membership")))
    # The scan for hot keys reads what the keys need and no more.
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text


def test_crosswalk(spark, no_broadcast):
    check_joins(plan(crosswalk(spark, SF)))


def test_staged_tables(spark, no_broadcast):
    text = plan(staged_table(spark, SF, "clicks"))
    check_joins(text)
    # The scan for hot keys reads what the key needs and no more.
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


def test_columns_are_dealt_out_before_they_are_grouped(spark, no_broadcast):
    """A task that reads much holds no group per row."""
    text = plan(QUERIES["schema_diff"](spark, SF))
    assert text.count("REPARTITION_BY_COL") == 1
    reading = text[text.index("REPARTITION_BY_COL"):]
    assert "Aggregate" not in reading and text.count("Aggregate") == 2


def test_wide_projections_are_not_run_interpreted(spark):
    key, limit = METHOD_LIMIT
    entity, feeds = ENTITIES["clicks"], raw_feeds(spark, SF, "clicks")
    assert spark.conf.get(key) == limit
    try:
        # A session that names a limit of its own, and one without the library's settings.
        spark.conf.set(key, "65535")
        fused = sorted(build_rows(entity, feeds).collect(), key=repr)
        assert spark.conf.get(key) == "65535"
        spark.conf.unset(key)
        assert sorted(build_rows(entity, feeds).collect(), key=repr) == fused
        assert spark.conf.get(key) == limit
    finally:
        spark.conf.set(key, limit)
