"""Near copies against all pairs, on made and bundled texts."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import components as C, near_copies as N, tables as T


def plain(texts):
    """The least place of each text's group, by comparing all pairs of word shingles."""
    sets = []
    for t in texts:
        words = (t or "").encode().lower().split()
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for b in range(len(sets)):
        for a in range(b):
            common = len(sets[a] & sets[b])
            if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common) and (common or not (sets[a] or sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(sets))]


def edited(rng, words, steps):
    words = list(words)
    for _ in range(steps):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_against_all_pairs(spark, monkeypatch, rounds):
    monkeypatch.setattr(N, "BLOCK_SETS", 16)  # so that dense groups are cut into blocks
    monkeypatch.setattr(N, "HUB_SETS", 16)
    monkeypatch.setattr(N, "ROUNDS", rounds)
    rng = random.Random(5)
    texts = [None, "", " \n", "a", "A", "one two three four five"]
    for size in (12, 40, 100, 300):
        for copies in (3, 60):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            texts += [edited(rng, words, rng.randint(0, max(1, size // 20))) for _ in range(copies)]
    words = [f"w{k}" for k in range(49)]  # 45 shingles, 40 of them common to both: 40 / 50 is 0.8 itself
    texts += [" ".join(words), " ".join(words[5:] + [f"v{k}" for k in range(5)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = sorted({root for root in plain(texts)})
    assert 20 < len(expected) < len(texts) and len(texts) - 1 not in expected
    assert sorted(r.doc_id for r in N.keep_one(docs).collect()) == expected


def in_reach(one, other):
    """Whether a half of two fingerprints differs in at most one bit."""
    x = (one ^ other) % (1 << 64)
    return min((x >> 32).bit_count(), (x & 0xFFFFFFFF).bit_count()) <= 1


def test_deletion_variants_find_what_they_reach(spark, monkeypatch):
    """Without MinHash keys the groups are those of the alike pairs that share a variant of their fingerprints."""
    monkeypatch.setattr(N, "_by_bands", lambda marked: marked.selectExpr("fp", "size", "0L as key").where("false"))
    rng = random.Random(3)
    texts = ["", "a"]
    for size in (60, 200, 500):
        for steps in (1, 2, 4, 8):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            texts += [" ".join(words), edited(rng, words, steps), edited(rng, words, steps)]
    sets = N.shingle_sets(texts)
    prints = [N.fingerprint(s) for s in sets]
    root, pairs, alike = list(range(len(texts))), 0, 0
    for b in range(len(texts)):
        for a in range(b):
            if len(sets[a]) and len(sets[b]) and N.alike(sets[a], sets[b]):
                alike += 1
                if in_reach(prints[a], prints[b]):
                    pairs += 1
                    low, high = sorted((root[a], root[b]))
                    root = [low if r == high else r for r in root]
    assert 5 < pairs < alike
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in N.keep_one(docs).collect()) == sorted(set(root))


def test_fingerprint_in_blocks(monkeypatch):
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)
    whole = sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > 1000)
    for size in (1, 7, 1 << 16):
        monkeypatch.setattr(N, "COUNTED_HASHES", size)
        assert N.fingerprint(hashes) % (1 << 64) == whole
    assert N.fingerprint(hashes[:0]) == 0


def test_bundled_against_all_pairs(spark, bundled):
    rows = sorted((r.doc_id, r.text) for r in bundled("documents").collect())
    roots = plain([t for _, t in rows])
    assert sorted(r.doc_id for r in N.keep_one(bundled("documents")).collect()) == sorted({rows[k][0] for k in roots})


def test_edge_rows(spark, edge_docs, no_docs):
    kept = N.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 8, 9, 10, 11] and ids.count(None) == 1
    assert N.keep_one(no_docs).collect() == []


def test_sets_and_keys(monkeypatch):
    sets = N.shingle_sets(["", "a b c d e f", "x", "A b  c d e f g a b c d e"])
    assert [len(s) for s in sets] == [0, 2, 1, 7] and set(sets[1].tolist()) < set(sets[3].tolist())
    assert (N.band_keys(sets[1:])[1] == N.band_keys(sets[2:3])[0]).all() and N.BLOCK_SETS == 256
    monkeypatch.setattr(N, "MATRIX_COLUMNS", 3)
    assert N.linked(sets[1:]) == [0, 1, 2] and N.linked([sets[3], sets[1], sets[3][1:]]) == [0, 1, 0]
    assert N.linked([np.array([k], np.uint64) for k in (3, 3, 4)]) == [0, 0, 2]
    assert N.linked([np.array([k], np.uint64) for k in (3, 4, 5)], [7, 8, 7]) == [0, 1, 0]
    assert N.alike(sets[3], sets[3][1:]) and not N.alike(sets[1], sets[3]) and not N.alike(np.empty(0, np.uint64), sets[1])
    nine, ten = np.arange(9, dtype=np.uint64), np.arange(1, 11, dtype=np.uint64)
    assert N.alike(nine, ten[:8]) and N.alike(nine, ten[:9]) and not N.alike(nine, ten)


def test_edges_grow_with_the_sets(spark, monkeypatch):
    """Of near copies of one text, as many edges leave the comparisons as there are sets, not their square."""
    counts = []
    whole = N.components
    monkeypatch.setattr(N, "components", lambda edges: (counts.append(edges.count()), whole(edges))[1])
    per_set = []
    for copies in (150, 600):
        rng = random.Random(copies)
        words = [f"w{k}" for k in range(200)]
        docs = spark.createDataFrame([(k, edited(rng, words, rng.randint(1, 6))) for k in range(copies)], "doc_id long, text string")
        counts.clear()
        kept = N.keep_one(docs).agg(F.count("*")).first()[0]
        per_set.append(sum(counts) / copies)
        assert kept < copies / 2
    assert per_set[1] < 1.5 * per_set[0] and max(per_set) < 4


def test_a_row_a_set_is_few_files_whatever_the_partitions(spark, monkeypatch):
    rng, held = random.Random(5), {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    rows = []
    for _ in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        rows += [" ".join(words), edited(rng, words, 1)]
    paths, make = [], T.scratch_dir
    monkeypatch.setattr(T, "scratch_dir", lambda session, label: paths.append((label, make(session, label))) or paths[-1][1])
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        kept = N.keep_one(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain(rows)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {label: len(list(Path(path.removeprefix("file:")).glob("part-*"))) for label, path in paths}
    assert all(files[label] <= 1 for label in ("nodes", "asked", "hubs", "labels", "lower", "rooted", "named", "groups")), files


def test_few_links_are_followed_without_a_shuffle(spark, monkeypatch):
    """Tasks of the driver's do not grow with the shuffle partitions where there is little to share out."""
    plans, make = [], C.written
    monkeypatch.setattr(C, "written", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or make(df, *a))
    edges = make(spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 999), (5000, 1000), (7, 7)], "src long, dst long"), "edges")
    got = {r.node: r.label for r in N.components(edges).collect()}
    assert all(got[k] == 0 for k in range(301)) and got[5000] == got[1000] == 999 and len(got) == 304
    assert len(plans) > 4 and not [p for p in plans if "Exchange" in p]
    monkeypatch.setattr(C, "ONE_TASK_EDGES", 10)
    assert {r.node: r.label for r in N.components(edges).collect()} == got
    assert "Exchange" in plans[-1]


@pytest.fixture
def joins(spark, monkeypatch):
    """Name of each table written by near copies, and the kinds of joins that made it."""
    found, make = [], N.written

    def run(df, label, *a):
        table = make(df, label, *a)
        plan = df._jdf.queryExecution().executedPlan().toString()
        found.append((label, set(re.findall(r"\w+Join|BroadcastExchange", plan))))
        return table

    for module in (N, C):
        monkeypatch.setattr(module, "written", run)
    return found


@pytest.mark.parametrize("index", [N._by_variants, N._by_bands])
def test_an_exploded_index_is_not_broadcast(spark, joins, index):
    """After an explode Spark still counts the rows before it: 64 keys a set seem as small as the set's row."""
    sets = [(fp, 9, fp // 2 * 0x9E3779B97F4A7C15 % (1 << 63), [fp // 2, -fp]) for fp in range(1, 500)]
    keys = index(T.written(spark.createDataFrame(sets + sets, "fp long, size long, bits long, keys array<long>"), "marked"))
    of = {}
    for r in keys.distinct().collect():
        of.setdefault(r.key, []).append((r.key, r.fp, r.size))
    got = N._shared(keys).collect()
    assert sorted(tuple(r) for r in got) == sorted(row for rows in of.values() if len(rows) > 1 for row in rows)
    assert got
    assert joins == [("shared-keys", {"SortMergeJoin"})]


def test_no_table_of_many_rows_is_broadcast(spark, monkeypatch, joins):
    """Files of a table are smaller than its rows; beyond SENT_ROWS the number of rows decides, not their size."""
    monkeypatch.setattr(T, "SENT_ROWS", 3)
    monkeypatch.setattr(C, "ONE_TASK_EDGES", 3)
    monkeypatch.setattr(N, "ROUNDS", 0)
    rng, texts = random.Random(5), []
    for size in (40, 100, 300):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [edited(rng, words, rng.randint(0, size // 20)) for _ in range(30)]
    kept = N.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain(texts)))
    # What is left out lists hubs, clusters or repeated ids, of which there are few here.
    made = [(label, kinds) for label, kinds in joins if label not in ("hub-links", "blocks", "rest-links", "clusters", "repeated")]
    assert {"shared-keys", "sets", "index", "asked", "labels", "lower", "left", "rooted", "groups"} <= {label for label, _ in made}
    assert not [x for x in made if "BroadcastExchange" in x[1]]
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()


def test_tables_of_few_rows_may_be_broadcast(spark):
    few = spark.range(5)
    kinds = [few.join(T.unsent(few, rows), "id")._jdf.queryExecution().executedPlan().toString() for rows in (5, T.SENT_ROWS, T.SENT_ROWS + 1, None)]
    assert ["BroadcastHashJoin" in k for k in kinds] == [True, True, False, False] and all("SortMergeJoin" in k for k in kinds[2:])
