"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Paths of small random-forest trees, grown on labelled rows, become conjunctions of bounds
on statistics. A logistic regression with an L1 penalty weighs them and drops most. What is
left is compiled into one Spark column expression, so scoring stays in the scan of the
texts. Only the text is an input of the score.

Defined results: a null text is empty; an empty text is scored like any other; repeated
labels count once; labels that are null, conflict or lack a document are left out; with
one label value or none, every score is that value's, or 0.5. No rows give none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.tables import digits_hash, unsent, written

TRAIN_ROWS = 20_000  # labelled documents that the rules are fitted on, at most
TREES = 16
DEPTH = 3
BINS = 256  # candidate bounds of a statistic; most texts have none of some marks, so few would all lie at zero
PENALTY = 0.002
SEED = 7

# name: expression over `text`, `n` (characters), `words` and `m` (words, at least 1)
STATISTICS = {
    "log_characters": "ln(1.0D + n)",
    "word_length": "n / m",
    "symbols": "regexp_count(text, '[^\\\\p{L}\\\\p{N}\\\\s.,+()@:/-]') / m",
    "marks": "regexp_count(text, '[.,]') / m",
    "capitals": "regexp_count(text, '\\\\p{Lu}') / greatest(n, 1)",
    "digits": "regexp_count(text, '[0-9]') / greatest(n, 1)",
    "lines": "regexp_count(text, '\\n') / m",
    "repeats": "size(filter(zip_with(words, slice(words, 2, size(words)), (a, b) -> a = b), x -> x)) / m",
}


@dataclass(frozen=True)
class Rule:
    """Bounds ``low < statistic <= high``, by statistic."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, low, high in self.bounds:
            if low > float("-inf"):
                holds = holds & (F.col(name) > F.lit(low))
            if high < float("inf"):
                holds = holds & (F.col(name) <= F.lit(high))
        return holds.cast("double")


@dataclass
class RuleModel:
    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self) -> Column:
        """From 0 to 1, over the columns of ``with_statistics``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.lit(weight) * rule.column()
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def with_statistics(rows: DataFrame) -> DataFrame:
    """Replaces ``text`` by its statistics; the other columns stay."""
    split = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumns({
        "n": F.length("text"), "words": F.split(F.trim(F.lower("text")), r"\s+")}).withColumn("m", F.greatest(F.size("words"), F.lit(1)))
    return split.select(*[c for c in rows.columns if c != "text"], *[F.expr(f"cast({e} as double)").alias(s) for s, e in STATISTICS.items()])


def tree_rules(text: str, names: list[str]) -> set[Rule]:
    """All paths from the root of a tree, as the model prints it, to a node below."""
    rules: set[Rule] = set()
    path: dict[int, tuple[str, str, float]] = {}
    for depth, _, feature, sign, value in re.findall(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$", text, re.M):
        path = {d: t for d, t in path.items() if d < len(depth)} | {len(depth): (names[int(feature)], sign, float(value))}
        bounds: dict[str, list[float]] = {}
        for name, s, v in path.values():
            low_high = bounds.setdefault(name, [float("-inf"), float("inf")])
            low_high[s == "<="] = (min if s == "<=" else max)(low_high[s == "<="], v)
        rules.add(Rule(tuple((n, *b) for n, b in sorted(bounds.items()))))
    return rules


def fit(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleModel:
    """A model of ``label`` (0.0 or 1.0) from the statistics in ``sample``, which is small and written."""
    share = sample.agg(F.avg("label")).first()[0]
    if share in (None, 0.0, 1.0):
        return RuleModel([], {None: 0.0, 0.0: -20.0, 1.0: 20.0}[share])
    names = list(STATISTICS)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(sample).coalesce(2).cache()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=BINS, seed=SEED, featureSubsetStrategy="onethird").fit(rows)
    rules = sorted(set().union(*[tree_rules(t.toDebugString, names) for t in forest.trees]), key=repr)
    if not rules:
        return RuleModel([], 0.0)
    fired = VectorAssembler(inputCols=[f"rule{k}" for k in range(len(rules))], outputCol="features").transform(
        rows.select("label", *[r.column().alias(f"rule{k}") for k, r in enumerate(rules)]))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(fired)
    rows.unpersist()
    return RuleModel([(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w], float(lasso.intercept))


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text",
          train_rows: int = TRAIN_ROWS) -> RuleModel:
    """Rules fitted on at most ``train_rows`` labelled documents that are not held out, the first in hash order."""
    wanted = (labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").cast("double").alias("label"))
              .where(F.col("label").isin(0.0, 1.0) & F.col("id").isNotNull() & ~held_out(F.col("id")))
              .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").drop("high")
              .join(unsent(docs.select(F.col(f"`{id_column}`").alias("id"))), "id", "left_semi")
              .orderBy(digits_hash("id"), "id").limit(train_rows))
    # At most train_rows ids and labels.
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")).join(
        F.broadcast(written(wanted, "labelled")), "id")
    return fit(written(with_statistics(rows).drop("id"), "statistics"))


def scored(docs: DataFrame, model: RuleModel, row: Column, text_column: str = "text") -> DataFrame:
    """``row, score``."""
    return with_statistics(docs.select(row.alias("row"), F.col(f"`{text_column}`").alias("text"))).select("row", model.score().alias("score"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, train(docs, labels), F.col("doc_id")).select(
        F.col("row").alias("doc_id"), held_out(F.col("row")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least 0.5."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return scored(docs, train(docs, labels), whole).where("score >= 0.5").select("row.*")
