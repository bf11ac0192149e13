"""Shards against a directory that doubles and splits bucket by bucket."""

import hashlib

from pyspark.sql import functions as F

from rosterlake.llm import sharding as S


def bits_of(key, content):
    def digits(parts, n):
        text = "|".join("\\N" if p is None else str(p) for p in parts)
        return bin(int(hashlib.md5(text.encode()).hexdigest()[:n], 16))[2:].zfill(4 * n)
    return digits([key], S.KEY_DIGITS) + digits(content, S.ROW_DIGITS)


def split(rows, prefix, limit):
    """rows: (bits, size, row) -> {row index: (prefix, bytes)}"""
    total = sum(s for _, s, _ in rows)
    if total <= limit or len(prefix) == S.HASH_BITS:
        return {k: (prefix, total) for _, _, k in rows}
    out = {}
    for bit in "01":
        out |= split([r for r in rows if r[0][len(prefix)] == bit], prefix + bit, limit)
    return out


def run(docs, limit):
    return S.shards(docs, F.struct("doc_id", "text"), F.col("source"), [F.col("doc_id"), F.col("text")], F.octet_length("text"), limit)


def test_against_recursion(spark, edge_docs, no_docs, bundled):
    for docs, limit in ((edge_docs, 40), (edge_docs, 1 << 30), (bundled("documents"), 9_000)):
        # A source may exceed the limit: the content's bits then cut it.
        given = docs.select("doc_id", "text", "source").collect()
        want = split([(bits_of(r.source, [r.doc_id, r.text]), len((r.text or "").encode()), k) for k, r in enumerate(given)], "", limit)
        got = run(docs, limit).collect()
        assert sorted(((r.row.doc_id, r.row.text, r.size, r.shard, r.depth, r.shard_bytes, r.oversized) for r in got), key=repr) == sorted(
            ((r.doc_id, r.text, len((r.text or "").encode()), *((p := want[k])[0], len(p[0]), p[1], p[1] > limit)) for k, r in enumerate(given)), key=repr)
    assert run(no_docs, 10).collect() == []


def test_one_key_of_all_rows_is_cut(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', 10) as text", "'one' as source")
    got = run(docs, 500).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(got) >= 60 and all(r.s <= 500 for r in got)


def test_equal_rows_above_the_limit_are_told(spark):
    docs = spark.range(20).selectExpr("1 as doc_id", "'xxxxx' as text", "'one' as source")
    got = run(docs, 50).collect()
    assert len(got) == 20 and all(r.oversized and r.depth == S.HASH_BITS for r in got)
