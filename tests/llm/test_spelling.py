"""Spelling variants against all pairs of words, and the scan of a sorted list against an edit matrix."""

import random
import re
import zlib
from collections import Counter

import pytest

from rosterlake.llm import spelling as S


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, out = {}, []
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 10 * n else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts.get(forms[w])))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, word string, form string").repartition(3)
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(docs, **more).collect()), key=repr)


def made(seed, words=60, rows=80):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abéz") for _ in range(rng.randint(6, 10))) for _ in range(words)] + ["aaaaaaaa", "aaaaaaa", "aaaaaaab", "abababab", "bababababa"]
    weights = [rng.choice((1, 1, 30)) for _ in base]

    def typed(w):
        if rng.random() < 0.3:
            at = rng.randrange(len(w) + 1)
            w = w[:at] + rng.choice(("", "a", "Z", "×")) + w[at + rng.randint(0, 1):]
        return w.upper() if rng.random() < 0.1 else w

    return [(i, " ".join(map(typed, rng.choices(base, weights, k=40)))) for i in range(rows)]


@pytest.mark.parametrize("list_words", [S.LIST_WORDS, 12, 1])
def test_against_all_pairs(spark, list_words):
    rows = made(list_words)
    got = run(spark, rows, list_words=list_words)
    assert got == plain(rows) and len(got) > 150 and sum(f is not None for _, f, *_ in got) > 30


def test_chains_of_forms(spark):
    """Three steps of forms, each ten times as frequent."""
    rows = [(None, " ".join(["abcdefghiz"] * 2 + ["abcdefghi"] * 20 + ["abcdefgh"] * 200 + ["abcdefg"] * 2000)), (None, None), (None, "")]
    got = run(spark, rows)
    assert got == plain(rows) and {r[2] for r in got} == {"abcdefg"}


def test_edges(spark, edge_docs, no_docs):
    assert S.variants(no_docs).collect() == []
    got = sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(edge_docs).collect()), key=repr)
    assert got == plain([(r.doc_id, r.text) for r in edge_docs.collect()])
    long = "q" * 3000
    rows = [(1, f"{long} {long}x {long} {long}x ABCDEFGÉ abcdefgé abcdefgÉ abc7defghij")] * 2  # a repeated row
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("seed", range(5))
def test_scan_of_a_sorted_list(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abÿ") for _ in range(rng.randint(0, 6))) for _ in range(200)})
    for query in words[::3] + ["", "c", "abcab"]:
        assert [words[k] for k in S.near(words, query)] == [w for w in words if one_edit(w, query)]
