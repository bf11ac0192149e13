"""The rule ensemble: statistics, rules, compiled scores and held-out accuracy."""

import math
import zlib

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from rosterlake.llm import rule_ensemble as R


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in R.quality_scores(docs, labels).collect()}
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    told = [(rows[r.doc_id], r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert len(told) > 100 and sum(r.predicted == q for r, q in told) / len(told) > 0.97
    assert sum(r.predicted == 0 for r, q in told if q == 1) <= 1


def test_held_out_labels_have_no_say(spark, bundled):
    docs, labels = bundled("documents"), bundled("labels")
    turned = labels.withColumn("quality", F.when(R.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("one")})
    first = {r.doc_id: r.score for r in R.quality_scores(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in R.quality_scores(renamed, turned).collect()}


def test_edges(spark, edge_docs, no_docs, bundled):
    labels = bundled("labels")
    model = R.train(bundled("documents"), labels)
    rows = R.scored(edge_docs, model, F.col("doc_id")).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.row in (1, 2)}) == 1
    kept = R.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert R.quality_scores(no_docs, labels).collect() == []
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 1)], "doc_id long, quality int")
    assert {r.score for r in R.quality_scores(edge_docs, odd).collect()} == {0.5}
    assert {r.score for r in R.quality_scores(edge_docs, labels.limit(0)).collect()} == {0.5}
    good = spark.createDataFrame([(i, 1) for i in (3, 4, 5, 6, 6, 7, 8, 11)], "doc_id long, quality int")
    assert {r.score > 0.99 for r in R.quality_scores(edge_docs, good).collect()} == {True}


def test_statistics(spark):
    rows = spark.createDataFrame([("A b b *c* 12.\nD",), (None,)], "text string")
    got = R.with_statistics(rows).collect()
    assert got[0].symbols == pytest.approx(2 / 6) and got[0].capitals == pytest.approx(2 / 15) and got[0].repeats == pytest.approx(1 / 6)
    assert got[0].lines == pytest.approx(1 / 6) and got[0].digits == pytest.approx(2 / 15) and got[0].word_length == pytest.approx(15 / 6)
    assert got[1].log_characters == 0 and got[1].symbols == 0


def test_rules_are_the_paths_of_the_tree(spark):
    rows = spark.range(400).selectExpr("cast(id % 20 as double) as a", "cast(id % 7 as double) as b", "cast(id % 20 > 8 and id % 7 < 3 as double) as label")
    made = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    tree = RandomForestClassifier(numTrees=1, maxDepth=3, seed=1).fit(made).trees[0]
    rules = R.tree_rules(tree.toDebugString, ["a", "b"])
    # Every node but the root is a rule (of equal bounds one), and each row fulfils one leaf's rule at least.
    assert 2 <= len(rules) <= tree.numNodes - 1
    fired = rows.select(sum(r.column() for r in rules).alias("n")).agg(F.min("n"), F.max("n")).first()
    assert 1 <= fired[0] and fired[1] <= 3 * 2


def test_compiled_score_is_the_logistic_of_the_rules(spark):
    model = R.RuleModel([(R.Rule((("a", 1.0, math.inf),)), 2.0), (R.Rule((("a", -math.inf, 3.0), ("b", 0.0, 1.0))), -1.0)], 0.5)
    rows = spark.createDataFrame([(a, b) for a in (0.0, 1.0, 2.0, 3.0, 4.0) for b in (0.0, 0.5, 1.0, 2.0)], "a double, b double")
    for r in rows.select("a", "b", model.score().alias("s")).collect():
        z = 0.5 + 2.0 * (r.a > 1) - 1.0 * (r.a <= 3 and 0 < r.b <= 1)
        assert r.s == pytest.approx(1 / (1 + math.exp(-z)))
