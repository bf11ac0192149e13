"""Fingerprints and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from rosterlake.llm import simhash as S
from rosterlake.llm.components import components


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def reachable(fingerprints, bits):
    """Component number of each fingerprint, by all pairs."""
    parent = list(range(len(fingerprints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    values = np.array(fingerprints, np.uint64)
    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= bits):
            a, b = find(k), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def test_edges(spark, edge_docs, no_docs):
    got = S.simhash_components(edge_docs).collect()
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    prints = [plain(t) for _, t in docs]
    roots = reachable(prints, 3)
    least = {}
    for (i, _), root in zip(docs, roots):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    want = sorted(((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(docs, prints, roots)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    assert S.simhash_components(no_docs).collect() == []


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"W{i}  x\t{i % 7}" for i in range(3000))
    whole = plain(text)
    for size in (1, 17, 1000):
        monkeypatch.setattr(S, "BLOCK_BYTES", size)
        assert S.fingerprint(text) % (1 << 64) == whole
        assert S.fingerprint("a") % (1 << 64) == plain("a") and S.fingerprint("a b") % (1 << 64) == plain("a b")


@pytest.mark.parametrize("bits", [1, 2, 3, 4, 5])
def test_components_of_dense_and_sparse_groups(spark, bits):
    rng = random.Random(bits)
    prints = [0, (1 << 64) - 1, 1 << 63]
    for _ in range(12):  # dense groups around centres, with steps of up to one bit more than links reach
        centre = rng.getrandbits(64)
        for _ in range(40):
            f = centre
            for _ in range(rng.randint(0, bits + 2)):
                f ^= 1 << rng.randrange(64)
            prints.append(f)
    prints += [rng.getrandbits(64) for _ in range(200)]
    for k in range(0, 64 - bits, 7):  # chains across the segments' edges
        prints.append(((1 << bits) - 1) << k)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    found = S.classes(spark.createDataFrame(rows, "id long, fp long"), "id", bits).collect()
    first = {r.fp: r.first for r in found}
    roots = reachable(prints, bits)
    assert len(first) == len(set(prints))
    assert [first[fp] for _, fp in rows] == [min(i for i, r in enumerate(roots) if r == root) for root in roots]


def test_a_pair_meets_once(spark):
    """Each linked pair of labels comes from one key, however many they share."""
    prints = [0, 1, 3, 7, 1 << 40, (1 << 40) | 3]
    labelled = spark.createDataFrame([(f, f) for f in prints], "fp long, label long")
    got = sorted((r.src, r.dst) for r in S._link(labelled, 3).collect())
    assert got == sorted((a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3)


def test_path_of_many_nodes(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 999), (5000, 1000)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(got[k] == 0 for k in range(301)) and got[5000] == got[1000] == 999
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_keep_one(spark, edge_docs, no_docs):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    components_of = {r.doc_id: r.component_id for r in S.simhash_components(edge_docs).collect()}
    assert sorted(i for i, _ in ids if i is not None) == sorted(i for i, c in components_of.items() if i is not None and i == c)
    assert [i for i, _ in ids].count(9) == 1 and [i for i, _ in ids].count(None) == 1
    assert S.keep_one(no_docs).collect() == []
