"""Packing against the tokenizer itself: every id once, sequences gapless, little padding."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rosterlake.llm import packing as P
from rosterlake.llm import tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts):
    return [np.array(e.ids + [2], "<u4") for e in Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_pieces(pieces, docs):
    """``docs``: list of (id, text). Pieces of equal ids are told apart by their documents' tokens alone."""
    assert len(pieces) == 0 or {len(p) for p in pieces} == {9}
    want = sorted(((i, len(t), zlib.crc32(t)) for (i, _), t in zip(docs, ids_of([t for _, t in docs]))), key=repr)
    whole = [p for p in pieces if p.start == 0 and p.length == p.doc_tokens]
    cut = [p for p in pieces if p not in whole]
    got = [(p.doc_id, p.length, p.ids_crc32) for p in whole]
    of = dict(zip([d for d, _ in docs], ids_of([t for _, t in docs])))
    for doc in {p.doc_id for p in cut}:
        at = 0
        for p in sorted((p for p in cut if p.doc_id == doc), key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(of[doc][at:at + p.length])
            at += p.length
        assert at == len(of[doc])
        got.append((doc, at, zlib.crc32(of[doc])))
    assert sorted(got, key=repr) == want
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    open_ones = [n for n in sequences.values() if n & (n - 1)]
    assert all(n <= 4096 for n in sequences.values()) and len(open_ones) <= 1
    return sequences


def test_edges(spark, edge_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    pieces = P.pack(edge_docs, VOCABULARY, chunk_tokens=2000).collect()
    check_pieces(pieces, docs)
    assert P.pack(no_docs, VOCABULARY).collect() == []


def test_bundled_over_many_tasks(spark, bundled):
    docs = bundled("documents").repartition(7)
    pieces = P.pack(docs, VOCABULARY, chunk_tokens=20_000).collect()
    sequences = check_pieces(pieces, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    # All windows of a tier in a step hold the step's tokens, but for the last step of the tier.
    steps = {}
    for p in pieces:
        steps.setdefault((p.tier, p.step_group), set()).add(p.sequence_id)
    last = {tier: max(g for t, g in steps if t == tier) for tier, _ in steps}
    for (tier, group), own in steps.items():
        assert len(own) == P.STEP_TOKENS // tier or group == last[tier]
    assert set(last) <= set(P.TIERS) and len(last) > 1 and sum(sequences.values()) == sum(p.length for p in pieces)


def test_step_groups_have_like_cost(spark, bundled):
    pieces = P.pack(bundled("documents"), VOCABULARY, step_tokens=8192).collect()
    costs = {}
    for p in pieces:
        key = (p.tier, p.step_group, p.sequence_id)
        costs[key] = costs.get(key, 0) + p.length ** 2
    for tier in P.TIERS:
        groups = {}
        for (t, g, _), c in costs.items():
            if t == tier:
                groups.setdefault(g, []).append(c)
        for low, high in zip(sorted(groups)[:-1], sorted(groups)[1:]):
            assert max(groups[low]) <= min(groups[high])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60))
def test_packer_keeps_every_id(lengths):
    packer, ids, at = P.Packer((8, 16, 32, 64)), np.arange(sum(lengths), dtype="<u4"), 0
    for doc, n in enumerate(lengths):
        packer.add(P.Piece(doc, ids[at:at + n], 0, n))
        at += n
    packer.pack()
    assert packer.tokens < 64 * 2 and all(sum(len(p.ids) for t, s, _, p in packer.full if s == k) == next(t for t, s, _, _ in packer.full if s == k)
                                          for k in {s for _, s, _, _ in packer.full})
    packer.finish()
    assert packer.tokens == 0
    assert sorted(np.concatenate([p.ids for *_, p in packer.full]).tolist() if packer.full else []) == ids.tolist()
    totals = {}
    for _, s, _, p in packer.full:
        totals[s] = totals.get(s, 0) + len(p.ids)
    assert sum(n & (n - 1) > 0 for n in totals.values()) <= 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdE'stZé1 2.,!#|\n\t İσΣ字\x1c<|>_-"), max_size=40), max_size=8))
def test_cached_ids_equal_the_tokenizers(texts):
    tokens.KEPT_WORDS, kept = 3, tokens.KEPT_WORDS
    try:
        mine = tokens.WordTokenizer(VOCABULARY) if not hasattr(test_cached_ids_equal_the_tokenizers, "t") else test_cached_ids_equal_the_tokenizers.t
        test_cached_ids_equal_the_tokenizers.t = mine
        for _ in range(2):
            assert [a.tolist() for a in mine.encode_batch(texts)] == [a[:-1].tolist() for a in ids_of(texts)]
    finally:
        tokens.KEPT_WORDS = kept
