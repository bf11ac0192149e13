"""Plans: no cross join, no Python where it is not wanted, texts shuffled no more than needed."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import curriculum as C
from rosterlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["op5_shards", "op7_curriculum", "op9_urls", "op11_secrets"])
def test_native_queries_run_no_python(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


@pytest.mark.parametrize("key", ["op3_warc", "op4_fingerprints", "op8_simhash", "op10_voronoi", "op12_spelling", "op13_value_codes"])
def test_no_cross_join(spark, key):
    assert not re.search("CartesianProduct|BroadcastNestedLoop", plan_of(QUERIES[key](spark, SF)))


def test_mixing_shuffles_texts_twice(spark, bundled):
    """Once to the slices of their source, once to the ranges of their places."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(C.mix_documents(bundled("documents")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(re.findall(r"Exchange hashpartitioning\(key#\d+, slice", plan)) == 2  # the texts, and the slices' sums
    assert plan.count("rangepartitioning") == 1


def test_scores_of_quality_stay_in_the_scan(spark, bundled):
    from rosterlake.llm import rule_ensemble as R
    model = R.RuleModel([(R.Rule((("symbols", 0.5, float("inf")),)), -1.0)], 1.0)
    plan = plan_of(R.scored(bundled("documents"), model, F.col("doc_id")))
    assert "Exchange" not in plan and not re.search("Python|Pandas|Arrow", plan)


def test_pieces_and_ids_are_not_broadcast(spark, bundled, monkeypatch):
    """Packed files of a row a piece or a document tell less than its rows take in the driver."""
    from rosterlake.llm import packing as P, rule_ensemble as R
    monkeypatch.setattr(P, "tokenizer", lambda path: type("Letters", (), {"encode_batch": lambda self, texts: [np.frombuffer(t.encode(), np.uint8).astype("<u2") for t in texts]})())
    plan = plan_of(P.pack(bundled("documents").limit(5), "none"))
    assert re.search(r"SortMergeJoin \[sequence_id", plan) and not re.search(r"BroadcastHashJoin \[sequence_id", plan)
    plans, make = [], R.written
    monkeypatch.setattr(R, "written", lambda df, label: plans.append((label, plan_of(df))) or make(df, label))
    R.train(bundled("documents"), bundled("labels"))
    assert [label for label, plan in plans if "SortMergeJoin" in plan] == ["labelled"] and "BroadcastExchange" not in plans[0][1]
