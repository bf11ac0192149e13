"""Rows without repeats by business key, and the document load that asks for it."""

import io
from contextlib import redirect_stdout

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rosterlake.operators.business_keys import latest_by_key, without_known
from rosterlake.plans.document_load import load_path
from rosterlake.sinks import json_load as J

SCHEMA = "a string, b int, at int, value string"
ROWS = st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None]), st.sampled_from([1, 2, None]),
                          st.sampled_from(["", "v", None])), max_size=12)


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(day=ROWS, target=ROWS)
def test_like_brute_force(spark, rows, day, target):
    def order(row):
        return [(v is not None, v if v is not None else 0) for v in (row[2],)] + [
            (v is not None, v if v is not None else 0) for v in (row[0], row[1])] + [(row[3] is not None, row[3] or "")]

    best, alone = {}, []
    for row in day:
        if row[0] is None or row[1] is None:
            alone.append(row)
        elif row[:2] not in best or order(row) > order(best[row[:2]]):
            best[row[:2]] = row
    latest = latest_by_key(spark.createDataFrame(day, SCHEMA), ["a", "b"], ["at"])
    assert rows(latest) == sorted([*best.values(), *alone], key=repr)
    known = {row[:2] for row in target}
    fresh = without_known(latest, spark.createDataFrame(target, SCHEMA), ["a", "b"])
    assert rows(fresh) == sorted([*[r for k, r in best.items() if k not in known], *alone], key=repr)
    assert fresh.columns == ["a", "b", "at", "value"]


def test_one_hot_key_and_odd_names(spark, rows):
    hot = spark.range(30_000).select(F.lit("k").alias("the.key"), F.col("id").alias("n"))
    assert rows(latest_by_key(hot, ["the.key"], ["n"])) == [("k", 29_999)]
    empty = latest_by_key(hot.where("n < 0"), ["the.key"])
    assert empty.count() == 0 and without_known(empty, hot, ["the.key"]).count() == 0


def test_target_is_filtered_by_range_and_bloom_filter(spark, tmp_path):
    target, day = str(tmp_path / "target"), str(tmp_path / "day")
    spark.range(50_000).selectExpr("id as k", "cast(id as string) as other").write.parquet(target)
    spark.range(40_000, 60_000).selectExpr("id as k", "'new' as other").write.parquet(day)
    conf = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fresh = without_known(spark.read.parquet(day), spark.read.parquet(target), ["k"])
        text = plan(fresh)
        assert fresh.count() == 10_000 and fresh.agg(F.min("k")).head()[0] == 50_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scan = next(part for part in text.split("\n\n") if "Scan parquet" in part and "/target" in part)
    assert "GreaterThanOrEqual(k,40000)" in scan and "LessThanOrEqual(k,59999)" in scan and "ReadSchema: struct<k:bigint>" in scan
    assert "might_contain" in text


def test_document_days(spark, tmp_path, rows):
    landing, location = str(tmp_path / "landing"), str(tmp_path / "table")

    def land(day, *titles):
        documents = [("reviews", day, f'{{"status":"OK","results":[{{"display_title":"{t}","date_updated":"{d}","headline":"{h}"}}]}}')
                     for t, d, h in titles]
        J.land_documents(spark.createDataFrame(documents, "path string, ds string, value string"), landing)

    def load(day):
        load_path(spark, landing, "reviews", day, "keyed_reviews", location, key=["display_title"], latest=["date_updated"])

    land("20240101", ("One", "2024-01-01", "old"), ("One", "2024-01-02", "new"), ("Two", "2024-01-01", "two"))
    load("20240101")
    held = [("One", "new"), ("Two", "two")]
    assert rows(spark.table("keyed_reviews"), "display_title", "headline") == held
    load("20240101")
    assert rows(spark.table("keyed_reviews"), "display_title", "headline") == held
    land("20240102", ("Two", "2024-01-05", "later"), ("Three", "2024-01-05", "three"))
    load("20240102")
    assert rows(spark.table("keyed_reviews"), "display_title", "headline") == [*held[:1], ("Three", "three"), *held[1:]]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load("20240109")
