"""Mixing sources to target weights that change over the course of training.

A source's share of the words is its weight's, up to a cap on its repeats; what a capped
source leaves goes to the others by weight. Its schedule says how its weight runs over
training time 0 to 1. The schedule's integral, scaled to the target, is the demand for
its words by then; so the words a source has given before a document, looked up in the
inverse of the integral, are the document's place in training. Documents are sorted into
ranges of it.

A source's words are summed in hash order of its ids, first within slices of the hash and
then over the slices' sums, so that a source of any size spreads over all tasks.

Defined results: a null text has no words and is never taken; a null source is a source
of its own, last in order; a null id is hashed like any other; repeated rows count each;
no rows give none. Of a document at the edge of a source's target, a part of the words is
taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from rosterlake.llm.tables import digits_hash, numbered, written
from rosterlake.session import shuffle_partitions

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
CAP = 2.0  # times a source's words
# One per weight: knots (time, relative weight) of a line; heavy sources fade, light ones rise.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
HASH_BITS = 60
SLICES = 4  # slices of a source per shuffle partition, at least
POSITIONS = 10 ** 9  # places over the whole of training


def sized(docs: DataFrame, row: Column, id_column: str = "doc_id", text_column: str = "text",
          source_column: str = "source") -> DataFrame:
    """``row`` with what mixing needs of it."""
    source = F.col(f"`{source_column}`").cast("string")
    # Sources by a key that is never null, so that windows and joins over them share one shuffle.
    return docs.select(row.alias("row"), source.alias("source"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"),
                       digits_hash(F.col(f"`{id_column}`")).alias("hash"),
                       F.coalesce(F.regexp_count(F.col(f"`{text_column}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def by_rank(values: tuple, rank: str) -> Column:
    return F.element_at(F.array(*values), (F.pmod(F.col(rank), F.lit(len(values))) + 1).cast("int"))


def segments(knots: tuple[tuple[float, float], ...]) -> Column:
    """Line pieces of a schedule of integral 1: start, length, weights at both ends, integral before."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total = sum(areas)
    return F.array(*[
        F.struct(F.lit(t0).alias("t"), F.lit(t1 - t0).alias("h"), F.lit(w0 / total).alias("w0"), F.lit(w1 / total).alias("w1"),
                 F.lit(sum(areas[:k]) / total).alias("before"))
        for k, ((t0, w0), (t1, w1)) in enumerate(zip(knots, knots[1:]))])


def weighed(sources: DataFrame, weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES) -> DataFrame:
    """Weights and schedules dealt to ``sources(source, source_size)`` in turn, by code point, null last."""
    ranked = numbered(sources.withColumn("last", F.col("source").isNull()), ["last", "source"], "rank").drop("last")
    return ranked.withColumns({"weight": by_rank(tuple(F.lit(w) for w in weights), "rank").cast("double"),
                               "schedule": by_rank(tuple(map(segments, schedules)), "rank")})


def with_targets(sources: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds ``target``: words to take of each source, ``share`` of all and at most ``cap`` of its own."""
    total = F.sum("source_size").cast("double")
    all_words = share * (sources.agg(total).first()[0] or 0.0)
    capped, held, words, weight = F.lit(False), -1, 0.0, 0.0
    while True:  # each round caps more sources, or ends
        left = sources.where(~capped).agg(F.count("*"), F.sum("weight")).first()
        at_cap = sources.where(capped).agg(F.count("*"), total).first()
        words, weight = all_words - cap * (at_cap[1] or 0.0), left[1] or 1.0
        if at_cap[0] == held:
            break
        held = at_cap[0]
        capped = capped | (F.col("weight") * F.lit(words) / F.lit(weight) > F.col("source_size") * F.lit(cap))
    return sources.withColumn("target", F.when(capped, F.col("source_size") * F.lit(cap))
                              .otherwise(F.col("weight") * F.lit(words) / F.lit(weight)))


def place(part: Column, schedule: Column) -> Column:
    """Training time by which the part of its demand has been met: the inverse of the schedule's integral."""
    piece = F.element_at(F.filter(schedule, lambda s: s["before"] <= part), -1)
    m, w0 = part - piece["before"], piece["w0"]
    root = w0 + F.sqrt(w0 * w0 + F.lit(2.0) * ((piece["w1"] - w0) / piece["h"]) * m)
    return piece["t"] + F.when(root > 0, F.lit(2.0) * m / root).otherwise(F.lit(0.0))


def plan(rows: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple = WEIGHTS,
         schedules: tuple = SCHEDULES) -> DataFrame:
    """Per row of ``sized``: ``row, size, source, source_size, target, taken``, and what places its passes.

    ``passes`` is how often it is taken whole, ``part`` the words of a last pass, ``before``
    the source's words before it in a pass, ``demand`` all that is taken of the source.
    """
    bits = max(1, (SLICES * shuffle_partitions(rows.sparkSession) - 1).bit_length())
    rows = rows.withColumn("slice", F.shiftright("hash", HASH_BITS - bits))
    slices = written(rows.groupBy("key", "source", "slice").agg(F.sum("size").alias("slice_size")), "slices")
    sources = with_targets(weighed(slices.groupBy("key", "source").agg(F.sum("slice_size").alias("source_size")), weights, schedules), share, cap)
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("start", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0))).select("key", "slice", "start")
    starts = starts.join(sources.drop("source"), "key").select("key", "slice", "start", "source_size", "target", "schedule")
    within = Window.partitionBy("key", "slice").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["key", "slice"])
    demand = F.floor("target").cast("long")
    return placed.select("row", "size", "source", "source_size", "target", demand.alias("demand"), "schedule",
                         (F.col("start") + F.col("own")).alias("before")).withColumns({
        "passes": F.when(F.col("source_size") > 0, F.expr("demand div source_size")).otherwise(F.lit(0)),
        "part": F.greatest(F.lit(0), F.least(F.col("size"), F.col("demand") - F.expr(
            "case when source_size > 0 then demand div source_size else 0 end") * F.col("source_size") - F.col("before"))),
    }).withColumn("taken", F.col("passes") * F.col("size") + F.col("part"))


def position(nth_pass: Column) -> Column:
    """Place in training, from 0 to POSITIONS, of a planned row's pass (from 0)."""
    given = (nth_pass * F.col("source_size") + F.col("before")).cast("double") / F.col("demand").cast("double")
    return F.floor(place(given, F.col("schedule")) * F.lit(float(POSITIONS))).cast("long")


def mixed(planned: DataFrame) -> DataFrame:
    """One row per planned row, sorted into ranges of its first place in training; null where none is taken."""
    first = F.when(F.col("taken") > 0, position(F.lit(0)))
    return planned.withColumn("position", first).repartitionByRange(
        shuffle_partitions(planned.sparkSession), "position", "before").sortWithinPartitions("position", "before")


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
                  **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, in ranges of their places in training.

    A document at the edge of its source's target is taken if at least half of it would be.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    planned = plan(sized(docs, row, id_column, text_column, source_column), **settings)
    whole = F.col("passes") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)
    each = planned.withColumn("whole", whole).where("whole > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("whole"))))
    return each.select("row", position(F.col("nth") - 1).alias("position"), "before").repartitionByRange(
        shuffle_partitions(docs.sparkSession), "position", "before").sortWithinPartitions("position", "before").select("row.*")
