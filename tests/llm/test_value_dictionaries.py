"""Codes and codebooks against plain loops over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from rosterlake.llm import value_dictionaries as V


def plain(rows, parts, entries, rounds):
    """``(id, code, error, label_error)`` of all rows, sorted, and the codebooks' digest."""
    kept = [(i, [max(-2 ** 62, min(2 ** 62, math.floor(1024 * x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = -(-max(len(v) for _, v, _ in kept) // parts)
    vectors = [v + [0] * (parts * size - len(v)) for _, v, _ in kept]
    books = [[v[p * size:(p + 1) * size] for v in vectors[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for step in range(rounds + 1):
        found = [[nearest(p, v[p * size:(p + 1) * size]) for p in range(parts)] for v in vectors]
        if step < rounds:
            for p in range(parts):
                for k in range(len(books[p])):
                    own = [v[p * size:(p + 1) * size] for v, f in zip(vectors, found) if f[p][1] == k]
                    if own:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    errors = [sum(d for d, _ in f) for f in found]
    totals = {}
    for (_, _, label), e in zip(kept, errors):
        totals[label] = totals.get(label, 0) + e
    most = 2 ** 63 - 1
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), min(e, most), min(totals[label], most))
                   for (i, _, label), f, e in zip(kept, found, errors)), key=repr), digest


def run(spark, rows, kind="array<float>", **more):
    df = spark.createDataFrame([(i, v, label, "x", [1]) for i, v, label in rows], f"vec_id long, embedding {kind}, label int, code string, v array<int>").repartition(3)
    out = V.compressed(df, **more).collect()
    digests = {r.codebooks_sha256 for r in out}
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in out), key=repr), digests.pop() if digests else None


@pytest.mark.parametrize("parts,entries,rounds", [(4, 256, 4), (4, 16, 4), (2, 3, 2), (1, 5, 0)])
def test_against_loops(spark, monkeypatch, parts, entries, rounds):
    monkeypatch.setattr(V, "BATCH_ROWS", 50)
    rng = random.Random(entries)
    centres = [[rng.gauss(0, 0.3) for _ in range(8)] for _ in range(9)]
    rows = [(i, np.float32([c + rng.gauss(0, 0.1) for c in centres[i % 9]]).tolist(), i % 3 or None) for i in range(300)]
    rows += [(i, rows[5][1], 1) for i in range(300, 420)]  # one vector of a large share
    rng.shuffle(rows)
    assert run(spark, rows, parts=parts, entries=entries, rounds=rounds) == plain(rows, parts, entries, rounds)


def test_edges(spark):
    rows = [(5, [1.0, 2.0, -0.5], 1), (5, [0.5], None), (5, [0.5], None), (None, [0.0009, -0.0009, 3.0, 4.0, 5.0], 1), (3, None, 1), (4, [], 2), (6, [None, 1.0], 1),
            (7, [float("nan")], 1), (8, [float("inf")], 1), (9, [1e300, -1e300], 7), (10, [1e7, -1e7], 7), (11, [3e5], 7)]
    for entries in (2, 4, 256):
        assert run(spark, rows, kind="array<double>", entries=entries) == plain(rows, 4, entries, 4)
    assert run(spark, []) == ([], None) and run(spark, [(1, None, 1)]) == ([], None)
    assert run(spark, [(1, [], 1)])[0] == [(1, "00000000", 0, 0)]
    assert V.compressed(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        run(spark, rows[:1], entries=257)


def test_tables_give_the_distances():
    rng = np.random.default_rng(3)
    for scale in (300, 2 ** 20, 2 ** 61):
        parts, entries = rng.integers(-scale, scale, (200, 5)), rng.integers(-scale, scale, (30, 5))
        exact = ((parts.astype(object)[:, None, :] - entries.astype(object)[None, :, :]) ** 2).sum(2)
        best, least = V.nearest(parts, entries)
        assert best.tolist() == exact.argmin(1).tolist() and [int(x) for x in least] == exact.min(1).tolist()
    assert V.nearest(np.array([[1]]), np.array([[0], [2], [0]]))[0].tolist() == [0]
