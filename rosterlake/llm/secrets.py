"""Secrets in texts: fixed rules, and two character models that tell random strings from ordinary ones.

The rules find assignments to telling names, access keys and long hexadecimal runs. What they cover
is blanked, and every other long run of the characters keys are written in, if it holds a letter and a
digit, is judged by two Markov models of its characters: the mean over its pairs of the logarithm of how
much likelier the second follows the first in random strings than in ordinary ones. Both models are counts of pairs in a
labelled sample of TRAIN_DOCS documents: random are the rules' access keys and hexadecimal runs, and digests of
the documents' ids in the usual alphabets; ordinary is all else, also written as identifiers are.

Everything is column expressions: a text's matches and the pieces between them give the places, so
nothing is shuffled but the counts of pairs, of which there are no more than the alphabet's square.

Defined results: a null text is empty; places count code points, the end is exclusive; a very long text is
scanned whole, in one row; equal and repeated rows are found alike, each on its own; documents without an
id are scanned and not learned from; without documents to learn from nothing is added to the rules' spans;
other columns are ignored; no rows give none.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.tables import digits_hash, written

# The rules, in the order of their kinds, and the least length of what they accept.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]"
LEAST_RUN = 16
# A run takes part in a match anyway only if it is long enough, so shorter ones are not listed.
PATTERNS = {"assign": ASSIGN, "access": ACCESS.replace("+", f"{{{ACCESS_LENGTH - 4},}}"), "hex": HEX.replace("+", f"{{{HEX_LENGTH},}}")}
KINDS = (*PATTERNS, "model")
# How a word ``w`` occurs in ordinary long runs: names in several spellings, paths, filling and ruled lines.
FORMS = ("w", "upper(w)", "concat(w, '_', w)", "concat(w, '-', w)", "concat(w, '/', w)", "concat(w, upper(left(w, 1)), substring(w, 2))",
         "concat(w, cast(length(w) as varchar(9)), '_', w)", "repeat(left(w, 1), 4)", "'----====____////++++'")
TRAIN_DOCS = 2_000  # ids that the models are counted on, at most
UNITS = 1000  # weights are whole numbers of a thousandth, so sums do not depend on their order
LEAST_MEAN = 2 * UNITS  # of a random string's pairs
BLOCK_BITS = 6
SPANS = "array<struct<start:int,end:int,value:string>>"


def _accepted(kind: str, value: Column) -> Column:
    return F.length(F.regexp_extract(value, ASSIGN, 2)) >= ASSIGN_VALUE if kind == "assign" else F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is formed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(steps: Column) -> Column:
    """Running sums, by blocks, so that the work of long arrays does not grow as their square."""
    block = 1 << BLOCK_BITS
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))

    def cut(steps: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(steps) - 1, BLOCK_BITS)), lambda b: F.slice(steps, b * block + 1, F.lit(block)))

    def summed(blocks: Column) -> Column:
        before = F.aggregate(blocks, F.array(F.lit(0)), lambda sums, s: add(sums, F.aggregate(s, F.lit(0), lambda a, b: a + b)))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda s, start: F.slice(
            F.aggregate(s, F.array(start), add), F.lit(2), F.size(s))))

    return _let(_let(steps, cut), summed)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _spans(text: Column, matches: Column, pattern: str) -> Column:
    """``start, end, value`` of the matches, from the lengths of the pieces between them."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, v: g + F.length(v))
    spans = F.zip_with(_running(steps), matches, lambda e, v: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(SPANS))


def _blanked(text: Column, kind: str) -> Column:
    """The text with spaces for every character of the kind's accepted matches."""
    def pieces(text: Column, matches: Column) -> Column:
        filled = F.transform(matches, lambda v: F.when(_accepted(kind, v), F.repeat(F.lit(" "), F.length(v))).otherwise(v))
        between = F.zip_with(F.split(text, PATTERNS[kind], -1), F.concat(filled, F.array(F.lit(""))), lambda piece, v: F.concat(piece, v))
        return F.when(F.size(matches) > 0, F.array_join(between, "")).otherwise(text)

    return _let(text, lambda t: _let(_matches(t, PATTERNS[kind]), lambda m: pieces(t, m)))


def ruled(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``found``: the spans per kind and ``rest``, the text with what the rules cover blanked, kind by kind."""
    def found(text: Column, matches: dict[str, Column]) -> Column:
        if len(matches) < len(PATTERNS):
            kind = list(PATTERNS)[len(matches)]
            return _let(_matches(text, PATTERNS[kind]), lambda m: found(text, matches | {kind: m}))
        rest = text
        for kind in PATTERNS:
            rest = _blanked(rest, kind)
        spans = [F.filter(_spans(text, m, PATTERNS[k]), _accepts(k)).alias(k) for k, m in matches.items()]
        return F.struct(*spans, F.when(sum(map(F.size, matches.values())) > 0, rest).otherwise(text).alias("rest"))

    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return docs.select(F.col(f"`{id_column}`").alias("doc_id"), _let(text, lambda t: found(t, {})).alias("found"))


def _accepts(kind: str) -> Callable[[Column], Column]:
    return lambda span: _accepted(kind, span["value"])


def _pairs(value: Column) -> Column:
    """Numbers of the pairs of adjacent characters, all of ``SYMBOLS``."""
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1)

    def of(codes: Column) -> Column:
        count = F.greatest(F.size(codes) - 1, F.lit(0))
        return F.zip_with(F.slice(codes, F.lit(1), count), F.slice(codes, F.lit(2), count), lambda a, b: a * len(SYMBOLS) + b)

    return _let(codes, of)


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", train_docs: int = TRAIN_DOCS) -> list[int]:
    """The weight of each pair of characters: how much likelier it is in random strings, in thousandths of a nat.

    One is added to each count. Documents are those of the first ``train_docs`` ids in hash order.
    """
    ids = docs.select(F.col(f"`{id_column}`").alias("doc_id")).where("doc_id is not null").distinct().orderBy(digits_hash("doc_id"), "doc_id").limit(train_docs)
    # At most train_docs ids.
    sample = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text")).join(F.broadcast(written(ids, "sampled")), "doc_id")
    sample = written(ruled(sample).select("doc_id", "found.*"), "labelled-texts")
    hexadecimal = F.sha2(F.col("doc_id").cast("string"), 256)
    digests = F.array(hexadecimal, F.upper(hexadecimal), F.rtrim(F.base64(F.unhex(hexadecimal)), F.lit("=")))
    known = F.transform(F.concat("access", "hex"), lambda s: s["value"])
    random = sample.select(F.explode(F.concat(digests, known)).alias("value"))
    words = sample.select(F.explode(_matches(F.col("rest"), RUN + "+")).alias("w")).distinct()
    ordinary = words.select(F.explode(F.expr(f"array({', '.join(FORMS)})")).alias("value"))
    tokens = random.withColumn("label", F.lit(1)).unionByName(ordinary.withColumn("label", F.lit(0)))
    counted = tokens.select("label", F.explode(_pairs(F.col("value"))).alias("pair")).groupBy("label", "pair").count().collect()  # two per pair at most
    size = len(SYMBOLS)
    counts = [[1] * size * size for _ in range(2)]
    for row in counted:
        counts[row.label][row.pair] += row["count"]
    after = [[sum(c[a * size:(a + 1) * size]) for a in range(size)] for c in counts]
    shares = [[c[p] / t[p // size] for p in range(size * size)] for c, t in zip(counts, after)]
    return [round(UNITS * (math.log(r) - math.log(o))) for o, r in zip(*shares)]


def score(value: Column, weights: list[int]) -> Column:
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    return F.aggregate(_pairs(value), F.lit(0).cast("long"), lambda total, pair: total + F.get(table, pair))


def secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", train_docs: int = TRAIN_DOCS, least_mean: int = LEAST_MEAN) -> DataFrame:
    """``doc_id`` and per kind the spans ``start, end, value`` of each row."""
    weights = train(docs, id_column, text_column, train_docs)
    pattern = f"{RUN}{{{LEAST_RUN},}}"

    def random(value: Column) -> Column:
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (score(value, weights) >= least_mean * (F.length(value) - 1))

    def added(rest: Column, runs: Column) -> Column:
        spans = F.filter(_spans(rest, runs, pattern), lambda s: random(s["value"]))
        return F.when(F.exists(runs, random), spans).otherwise(F.array().cast(SPANS))

    model = _let(F.col("found.rest"), lambda rest: _let(_matches(rest, pattern), lambda runs: added(rest, runs)))
    return ruled(docs, id_column, text_column).select("doc_id", *[f"found.{k}" for k in PATTERNS], model.alias("model"))


def listed(found: DataFrame) -> DataFrame:
    """``doc_id``, the number of each rule's spans, and the spans as text: ``kind:start:end``, by start and then kind."""
    def of_kind(place: int) -> Column:
        return F.transform(KINDS[place], lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("kind"), s["end"].alias("end")))

    def text(kinds: tuple[str, ...]) -> Column:
        names = F.array(*map(F.lit, kinds))
        return F.array_join(F.transform(F.array_sort(F.concat(*map(of_kind, range(len(kinds))))), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS], F.sha2(text(tuple(PATTERNS)), 256).alias("base_sha256"),
                        text(KINDS).alias("spans"), F.size("model").cast("long").alias("n_model"))
