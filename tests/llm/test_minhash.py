"""Fingerprints against exact likenesses of the shingle sets."""

import base64
import hashlib
import re

import numpy as np

from rosterlake.llm import minhash as M


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def exact(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs, spread):
    docs = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is None, d[0], d[1]))
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.n_chars))
    assert len(rows) == len(docs)
    own, following = [], []
    for k, (row, (i, text)) in enumerate(zip(rows, docs)):
        after = docs[(k + 1) % len(docs)][1]
        cut = len(text) // 4
        changed = text[:len(text) - cut] + after[:cut]
        assert (row.doc_id, row.n_chars, row.edited_sha256) == (i, len(text), hashlib.sha256(changed.encode()).hexdigest())
        own.append(row.near_edited - exact(text, changed))
        following.append(row.near_next - exact(text, after))
    for errors in (own, following):
        assert np.abs(errors).max() < 5 * spread and np.std(errors) < spread
    by_text = {}
    for row, (_, text) in zip(rows, docs):
        by_text.setdefault(text, set()).add(row.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert len(base64.b64decode(rows[0].fingerprint)) == 1 + (1 << M.BIN_BITS) * M.KEPT_BITS // 8


def test_bundled(spark, bundled):
    docs = bundled("documents").repartition(5)
    check(M.fingerprints(docs).collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 0.02)


def test_edges(spark, edge_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    check(M.fingerprints(edge_docs).collect(), docs, 0.05)
    assert M.fingerprints(no_docs).collect() == []
    one = M.fingerprints(edge_docs.where("doc_id = 6")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_likeness_is_unbiased():
    rng = np.random.default_rng(3)
    for share, size in ((0.2, 40), (0.5, 400), (0.9, 3000), (0.5, 6)):
        errors = []
        for _ in range(30):
            common = [f"c{x}" for x in rng.integers(1 << 60, size=int(size * share))]
            texts = [" ".join(common + [f"{s}{x}" for x in rng.integers(1 << 60, size=size - len(common))]) for s in "ab"]
            bits, some = M.signatures(texts)
            errors.append(M.likeness(bits[0], some[0], bits[1], some[1]) - exact(*texts))
        assert abs(np.mean(errors)) < 0.03


def test_densification_takes_the_first_filled_bin_of_each_order():
    texts = ["a b c d e f", " ".join(f"w{i}" for i in range(300))]
    (hashes, parent), orders = M.shingle_hashes(texts), M._orders(1 << M.BIN_BITS)
    for t in (0, 1):
        values = {}
        for h in hashes[parent == t]:
            b, v = int(h) >> (64 - M.BIN_BITS), int(h) & ((1 << (64 - M.BIN_BITS)) - 1)
            values[b] = min(v, values.get(b, v))
        kept = [values[next(o for o in [b, *orders[b]] if o in values)] for b in range(1 << M.BIN_BITS)]
        with np.errstate(over="ignore"):
            want = M._mix(np.array(kept, np.uint64) + np.arange(1 << M.BIN_BITS, dtype=np.uint64) * M.MULTIPLIER) & np.uint64((1 << M.KEPT_BITS) - 1)
        assert (M.signatures(texts)[0][t] == want).all()
