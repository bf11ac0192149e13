"""The mix against plain arithmetic, and its places against the schedules' integrals."""

import math
import re

import pytest
from pyspark.sql import functions as F

from rosterlake.llm import curriculum as C


def run(docs):
    return C.mixed(C.plan(C.sized(docs, F.struct("doc_id", "text", "source"))))


def targets(sizes):
    """sizes: {source: words}; reshares what is above the cap until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: C.WEIGHTS[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        total = sum(w for s, w in weight.items() if s not in capped)
        goal = {s: 2 * sizes[s] if s in capped else left * weight[s] / total for s in sizes}
        above = {s for s in sizes if s not in capped and goal[s] > 2 * sizes[s]}
        if not above:
            return goal
        capped |= above


def test_edges_and_bundled(spark, edge_docs, no_docs, bundled):
    assert run(no_docs).collect() == []
    for docs in (edge_docs, bundled("documents").repartition(5)):
        rows = run(docs).collect()
        sizes = {}
        for r in docs.collect():
            sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        goal, taken = targets(sizes), {}
        assert len(rows) == docs.count()
        for r in rows:
            assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.row.text or "")) and r.source_size == sizes[r.source]
            assert r.target == pytest.approx(goal[r.source]) and 0 <= r.taken <= 2 * r.size
            assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= C.POSITIONS)
            taken[r.source] = taken.get(r.source, 0) + r.taken
        assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)
        assert sorted(map(repr, run(docs.repartition(3)).collect())) == sorted(map(repr, rows))


def test_places_follow_the_schedules(spark):
    """At any time of training, a source has given the integral of its schedule."""
    docs = spark.range(3000).selectExpr("id as doc_id", "'w w w w' as text", "case when id % 10 < 4 then 'a' when id % 10 < 7 then 'b' else 'c' end as source")
    rows = run(docs).collect()
    by_source = {}
    for r in rows:
        for nth in range(r.passes + (r.part > 0)):
            given = (nth * r.source_size + r.before) / r.demand
            by_source.setdefault(r.source, []).append((given, r.position if nth == 0 else None))
    for turn, source in enumerate("abc"):
        (_, w0), (_, w1) = C.SCHEDULES[turn]
        for given, place in by_source[source]:
            if place is not None:
                t = place / C.POSITIONS
                assert w0 * t + (w1 - w0) * t * t / 2 == pytest.approx(given, abs=1e-6)


def test_schedule_of_several_lines(spark):
    knots = ((0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0))
    areas = [0.5, 0.375, 0.5]
    def integral(t):
        done = 0.0
        for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
            if t >= t1:
                done += area
            elif t > t0:
                done += (t - t0) * (w0 + (w0 + (w1 - w0) * (t - t0) / (t1 - t0))) / 2
        return done / sum(areas)
    rows = spark.range(101).select((F.col("id") / 100).alias("part")).withColumn("t", C.place(F.col("part"), C.segments(knots))).collect()
    assert all(math.isclose(integral(r.t), r.part, abs_tol=1e-9) for r in rows)


def test_documents_of_the_mix(spark, edge_docs, no_docs):
    mixed = C.mix_documents(edge_docs)
    assert mixed.columns == edge_docs.columns and C.mix_documents(no_docs).collect() == []
    times = {}
    for r in mixed.collect():
        times[(r.doc_id, r.n)] = times.get((r.doc_id, r.n), 0) + 1
    plans = C.plan(C.sized(edge_docs, F.struct("doc_id", "n"))).collect()
    for r in plans:
        whole = r.passes + (r.part > 0 and 2 * r.part >= r.size)
        assert times.get((r.row.doc_id, r.row.n), 0) == whole
