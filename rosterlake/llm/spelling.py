"""Spelling variants: words one edit apart, found by dynamic programming along sorted lists.

Words are runs of letters of all texts, one of 31 of them (by a hash of document and word)
short of a letter. A word of the vocabulary is compared with a sorted list by an edit matrix of three
diagonals: the list's words extend it row by row, neighbours reuse the rows of their common prefix,
and where a row is beyond one edit, all words with that prefix are passed over.

The list is cut so that no task needs the vocabulary: of two words one edit apart, the shorter
of m letters, the first difference lies in the first or the second half of these letters, and
what lies outside that half is equal. So a list holds the words that agree outside a half,
which for the second half is a range of the sorted vocabulary. Lists that grow beyond
LIST_WORDS are cut again, into one list per place of the difference; such a list holds no
more than two letters' worth of words. A pair is met in one list only.

A word's form is its near word of largest count, if that is at least ten times its own;
forms are followed to the last in rounds that double the steps.

Defined results: a null text has no words, a null id counts as empty text; letters are those of
``LETTERS``, only A to Z are lower-cased; repeated rows count as often as they occur; of near words
of one count the first in code-point order is the form; words of any length are compared whole;
other columns are ignored; no rows give none.
"""

from __future__ import annotations

import string
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.tables import written

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
TYPO_EVERY = 31
FORM_TIMES = 10
LIST_WORDS = 20_000
_END = chr(0x10FFFF)


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_letters: int = LEAST_LETTERS,
               least_count: int = LEAST_COUNT, typo_every: int = TYPO_EVERY) -> DataFrame:
    """``word, n`` of the words long and frequent enough. Shorter runs only get shorter, so they are not read."""
    runs = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.col(f"`{text_column}`"), F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0))).alias("run"))
    lower = runs.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = lower.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    cut = F.expr("concat(substring(run, 1, cast(h % char_length(run) as int)), substring(run, cast(h % char_length(run) as int) + 2))")
    words = hashed.select(F.when(F.col("h") % typo_every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _listed(words: DataFrame, spans: Column) -> DataFrame:
    """``m, lo, hi, key, word, n``: a word in each list of the words that agree outside ``lo`` to ``hi``."""
    return words.withColumn("span", F.explode(spans)).select(
        "m", "span.lo", "span.hi", F.expr("concat(left(word, span.lo), ' ', right(word, m - span.hi))").alias("key"), "word", "n")


def near(words: Sequence[str], query: str) -> Iterator[int]:
    """Places in the sorted ``words`` that are exactly one edit from ``query``."""
    padded = f"\0{query}\0\0"
    rows, at, before = [(2, 0, 1)], 0, ""
    while at < len(words):
        word = words[at]
        depth = 0
        for a, b in zip(before[:len(rows) - 1], word):
            if a != b:
                break
            depth += 1
        del rows[depth + 1:]
        (left, middle, right), before = rows[-1], word
        for k in range(depth, len(word)):
            letter = word[k]
            left = min(left + (padded[k] != letter), middle + 1)
            middle = min(middle + (padded[k + 1] != letter), right + 1, left + 1)
            right = min(right + (padded[k + 2:k + 3] != letter), middle + 1)
            rows.append((left, middle, right))
            if left > 1 and middle > 1 and right > 1:
                at = bisect_right(words, word[:k + 1] + _END, at)
                break
        else:
            apart = len(query) - len(word)
            if abs(apart) <= 1 and (left, middle, right)[apart + 1] == 1:
                yield at
            at += 1


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per list and word: how many near words, and the count and the first word of the most frequent."""
    names = ["word", "n_near", "best_n", "best"]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    found: list[list] = []
    for (m, lo, hi, _), members in groupby(rows(), key=lambda r: r[:4]):
        # What lies before and behind is equal; the list is sorted by what does not.
        members = sorted((w[lo:len(w) - (m - hi)], w, n) for *_, w, n in members)
        if len(members) == 1:
            continue
        rest, whole, counts = zip(*members)
        # number, largest count, and the word of that count
        best: list[list] = [[0, 0, ""] for _ in members]
        for a, word in enumerate(whole):
            if len(word) != m:
                continue
            for b in near(rest, rest[a]):  # of the longer words, pairs among themselves are another list's
                if hi < m and rest[b][:hi - lo] == rest[a][:hi - lo]:
                    continue  # they differ behind `hi`: another list's pair
                for one, other in ((a, b), (b, a))[:1 + (len(whole[b]) > m)]:
                    entry = best[one]
                    entry[0] += 1
                    if (-counts[other], whole[other]) < (-entry[1], entry[2]):
                        entry[1:] = counts[other], whole[other]
        found += [[w, *b] for w, b in zip(whole, best) if b[0]]
        if len(found) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=names)
            found = []
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=names)


def neighbours(words: DataFrame, least_letters: int = LEAST_LETTERS, list_words: int = LIST_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have near words."""
    roles = words.withColumn("m", F.explode(F.expr(f"filter(array(char_length(word), char_length(word) - 1), m -> m >= {least_letters})")))
    halves = _listed(roles, F.expr("array(named_struct('lo', 0, 'hi', m div 2), named_struct('lo', m div 2, 'hi', m))"))
    keys = ["m", "lo", "hi", "key"]
    large = written(halves.groupBy(*keys).count().where(F.col("count") > list_words).drop("count"), "large-lists")
    if not large.isEmpty():
        cut = halves.join(large, keys, "left_semi").withColumnsRenamed({"lo": "from", "hi": "to"})
        places = _listed(cut, F.expr("transform(sequence(from, to - 1), k -> named_struct('lo', k, 'hi', k + 1))"))
        halves = halves.join(large, keys, "left_anti").unionByName(places)
    partial = halves.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _compared, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best"))


def _followed(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form. A form is ten times as frequent, so there are no cycles."""
    links = written(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(links.join(further, "root", "left"), "further")
        links = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next is not null").isEmpty():
            return links


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", list_words: int = LIST_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word."""
    words = written(vocabulary(docs, id_column, text_column), "vocabulary")
    found = words.join(neighbours(words, list_words=list_words), "word", "left")
    frequent = F.col("best_n") >= FORM_TIMES * F.col("n")
    formed = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best")).alias("form"),
                                  F.when(frequent, F.col("best_n")).alias("form_n")), "forms")
    roots = _followed(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
