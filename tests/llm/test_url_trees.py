"""URL rules and features against plain code; trees against the model they come from."""

import math

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from rosterlake.llm import url_trees as U

URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/1?x=1", "http://a.example.org/en/12#f", "http://a.example.org/en/2", "http://notorg/en", "http://org/",
        "http://org", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/fr", "http://x.net/fr/", "http://ÄX.Com/de/é?a=b&c=d", "a://b://c/d", "http://x.org?q=/es/", "http://x\ny.org/a\nb?c"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
    end = min([rest.find(c, at) for c in "?#" if rest.find(c, at) >= 0] or [len(rest)])
    path = rest[at:end]
    fits = []
    for verdict, rule in U.RULES:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "x", 3, "y") for i, u in enumerate(URLS)] + [(4, URLS[4], "x", 3, "y"), (None, URLS[5], "x", 3, "y")],
                                 "page_id long, url string, host string, n int, top string")


def test_rules(spark, pages):
    rows = U.judged(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path, rule, verdict = plain(URLS[5 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict
    assert U.judged(pages.limit(0)).collect() == []


def test_without_both_labels(spark):
    one = spark.createDataFrame([(1, "http://x.net/a"), (2, "http://x.org/a")], "page_id long, url string")
    assert {r.verdict for r in U.judged(one).collect()} == {"allow"}
    assert {r.verdict for r in U.judged(one, (("block", "org/"),)).collect()} == {"block"}
    assert {r.verdict for r in U.judged(one, ()).collect()} == {"allow"}


def test_features(spark, pages):
    for r in U.lexical(U.host_and_path(pages.select("page_id", "url"))).collect():
        url = r.url or ""
        chars = [url.count(c) / len(url) for c in set(url)]
        assert r.entropy == pytest.approx(-sum(p * math.log2(p) for p in chars), abs=1e-9)
        assert r.length == len(url) and r.digit_ratio == pytest.approx(sum(c in "0123456789" for c in url) / max(1, len(url)))
    got = {r.url: r for r in U.lexical(U.host_and_path(pages.select("url"))).collect()}
    assert got[URLS[14]].parameters == 2 and got[URLS[4]].depth == 2 and got[URLS[5]].host_labels == 3 and got[URLS[5]].has_fragment == 1


def test_trained_trees_learn_the_labels_and_compile_exactly(spark):
    urls = U.host_and_path(spark.range(600).selectExpr("id as page_id", "concat('http://', case when id % 3 = 0 then 'cheap-pills-99' else 'plain' end, '.example.net/a/', id) as url"))
    labelled = urls.withColumn("allowed", ~F.contains("host", F.lit("cheap")))
    model = U.train(labelled, train_rows=300)
    seen = model.with_rates(U.lexical(urls)).select("host", model.allows().alias("ok")).collect()
    assert len(seen) == 600 and all(r.ok == ("cheap" not in r.host) for r in seen)
    rows = spark.range(500).selectExpr("cast(id % 20 as double) as a", "cast(id % 7 as double) as b", "cast(id % 20 > 8 and id % 7 < 3 as double) as label")
    made = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    trees = GBTClassifier(maxIter=3, maxDepth=3, seed=1).fit(made)
    margin = sum(F.lit(float(w)) * U.compiled(t.toDebugString, ["a", "b"]) for t, w in zip(trees.trees, trees.treeWeights))
    for r in trees.transform(made).select("rawPrediction", margin.alias("m")).distinct().collect():
        assert r.rawPrediction[1] == pytest.approx(r.m)


def test_suffixes_are_counted_over_all_labelled_urls(spark):
    rows = [(f"http://h{i}.{'com' if i % 3 else 'net'}/a{i}.{'html' if i % 2 else 'php'}", bool(i % 3)) for i in range(120)]
    urls = U.host_and_path(spark.createDataFrame(rows + rows[:7], "url string, allowed boolean"))
    model = U.train(urls, train_rows=10)
    assert {r["top"]: r["top_rows"] for r in model.rates["top"].collect()} == {"com": 80.0, "net": 40.0}
    assert {r["extension"]: r["extension_rows"] for r in model.rates["extension"].collect()} == {"html": 60.0, "php": 60.0}
