"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

A rule fits its host and all subdomains where the path starts with its path; the longest
fitting rule decides. URLs with a label (in the query, those that a rule decides) train
boosted trees on features of the URL's characters; the trees are compiled into nested
conditions, so the verdict is a column expression like the rest.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no rule
and is judged by the trees; repeated rows are judged each; other columns are ignored; with
one label value the verdict is that value, without labels it is allow; no rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.tables import written

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
TRAIN_ROWS = 20_000  # labelled URLs that the trees are grown on, at most
TREES = 12
DEPTH = 4
SEED = 11
PRIOR_ROWS = 10.0  # rows by which a suffix's rate is drawn to the rate of all

# name: expression over `url` (never null), `n` (its length, at least 1), `host` and `path`
FEATURES = {
    "length": "char_length(url)",
    "host_length": "char_length(host)",
    "host_labels": "regexp_count(host, '[^.]+')",
    "depth": "regexp_count(path, '/[^/]+')",
    "digit_ratio": "regexp_count(url, '[0-9]') / n",
    "host_digits": "regexp_count(host, '[0-9]')",
    "hyphens": "regexp_count(host, '-')",
    "parameters": "regexp_count(url, '[?&][^=&#?]+=')",
    "has_fragment": "case when contains(url, '#') then 1 else 0 end",
    "encoded": "regexp_count(url, '%[0-9A-Fa-f]{2}')",
    # Shannon entropy in bits, from the counts of the distinct characters.
    "entropy": "aggregate(transform(array_distinct(split(url, '')), c -> cast(n - char_length(replace(url, c, '')) as double)), "
               "0.0D, (s, c) -> s - case when c > 0 then c / n * ln(c / n) / ln(2.0D) else 0.0D end)",
}
SUFFIXES = {"top": "regexp_extract(host, '([^.]+)$', 1)", "extension": "regexp_extract(path, '[.]([A-Za-z0-9]{1,8})$', 1)"}


def host_and_path(urls: DataFrame) -> DataFrame:
    """Adds ``host`` (letters A to Z lower-cased) and ``path``."""
    rest = F.expr("case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end")
    # Only A to Z are lower-cased, whatever else a host holds.
    return urls.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumns({
        "host": F.translate(F.regexp_extract("_rest", r"(?s)\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        "path": F.regexp_extract("_rest", r"(?s)\A[^/?#]*([^?#]*)", 1)}).drop("_rest")


def ruled(urls: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule that fits, or null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # later ones, being longer, win
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return urls.withColumn("_best", best).withColumns({"rule": F.col("_best.rule"), "rule_verdict": F.col("_best.verdict")}).drop("_best")


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features and suffixes of ``url``, ``host`` and ``path``."""
    known = urls.withColumn("_url", F.col("url")).withColumn("url", F.coalesce("url", F.lit(""))).withColumn("n", F.greatest(F.length("url"), F.lit(1)))
    return known.withColumns({k: F.expr(f"cast({e} as double)") for k, e in FEATURES.items()} | {k: F.expr(e) for k, e in SUFFIXES.items()}).withColumn(
        "url", F.col("_url")).drop("_url", "n")


class UrlTrees:
    """Suffix rates and the compiled margin of the boosted trees (above 0: allow)."""

    def __init__(self, rates: dict[str, DataFrame], prior: float, margin: Column | None) -> None:
        self.rates, self.prior, self.margin = rates, prior, margin

    def with_rates(self, urls: DataFrame) -> DataFrame:
        for name, rates in self.rates.items():  # as many suffixes as there are: Spark decides by size how to join
            urls = urls.join(rates, name, "left").withColumns({
                f"{name}_rate": F.coalesce(f"{name}_rate", F.lit(self.prior)), f"{name}_rows": F.coalesce(f"{name}_rows", F.lit(0.0))})
        return urls

    def allows(self) -> Column:
        return F.lit(self.prior >= 0.5) if self.margin is None else self.margin > 0


def _names() -> list[str]:
    return [*FEATURES, *[f"{s}_{k}" for s in SUFFIXES for k in ("rate", "rows")]]


def compiled(text: str, names: list[str]) -> Column:
    """A tree, as the model prints it, as nested conditions."""
    def node(lines: Iterator[str]) -> Column:
        line = next(lines)
        if line.startswith("Predict:"):
            return F.lit(float(line.split()[1]))
        feature, value = line.split("(feature ")[1].rstrip(")").split(" <= ")
        yes = node(lines)
        next(lines)  # the Else that goes with it
        return F.when(F.col(names[int(feature)]) <= F.lit(float(value)), yes).otherwise(node(lines))

    return node(line for line in map(str.strip, text.splitlines()) if line.startswith(("If", "Else", "Predict")))


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH) -> UrlTrees:
    """Trees from ``labelled(url, host, path, allowed)``: grown on at most ``train_rows`` distinct URLs, the first in hash order."""
    urls = labelled.where("url is not null and allowed is not null").groupBy("url", "host", "path").agg(F.avg(F.col("allowed").cast("double")).alias("share"))
    distinct = written(urls.select("url", "host", "path", (F.col("share") >= 0.5).cast("double").alias("label")), "labelled-urls")
    share = distinct.agg(F.avg("label")).first()[0]
    if share in (None, 0.0, 1.0):
        return UrlTrees({}, 1.0 if share is None else share, None)
    # Suffixes are counted over all labelled URLs; only the rows that the trees grow on are a sample.
    rates = {s: written(distinct.select("label", F.expr(e).alias(s)).groupBy(s).agg(
        ((F.sum("label") + PRIOR_ROWS * share) / (F.count("*") + PRIOR_ROWS)).alias(f"{s}_rate"), F.count("*").cast("double").alias(f"{s}_rows")), "rates")
        for s, e in SUFFIXES.items()}
    sample = written(lexical(distinct.orderBy(F.md5("url"), "url").limit(train_rows)), "sampled-urls")
    model = UrlTrees(rates, share, None)
    rows = VectorAssembler(inputCols=_names(), outputCol="features").transform(model.with_rates(sample)).select("features", "label").coalesce(2).cache()
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, seed=SEED, stepSize=0.3).fit(rows)
    rows.unpersist()
    model.margin = F.lit(0.0)
    for tree, weight in zip(boosted.trees, boosted.treeWeights):
        model.margin = model.margin + F.lit(float(weight)) * compiled(tree.toDebugString, _names())
    return model


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; URLs that a rule decides train the trees for the others."""
    urls = ruled(host_and_path(pages.select("page_id", "url")), rules)
    model = train(urls.where("rule is not null").withColumn("allowed", F.col("rule_verdict") == "allow"))
    learned = F.when(model.allows(), "allow").otherwise("block")
    return model.with_rates(lexical(urls)).select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", learned).alias("verdict"))
