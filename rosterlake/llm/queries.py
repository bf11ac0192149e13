"""The operators over the bundled tables, one query each, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterlake.llm import curriculum, secrets, sharding
from rosterlake.llm.licences import licence_scan
from rosterlake.llm.minhash import fingerprints
from rosterlake.llm.packing import pack
from rosterlake.llm.rule_ensemble import quality_scores
from rosterlake.llm.simhash import simhash_components
from rosterlake.llm.spelling import variants
from rosterlake.llm.tables import table, written
from rosterlake.llm.url_trees import judged
from rosterlake.llm.value_dictionaries import compressed
from rosterlake.llm.voronoi import voronoi_top_k
from rosterlake.llm.warc import page_digests

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: licences in order, how many known sentences, first and last character of what was found."""
    found = licence_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join(F.transform("licences", lambda x: x["name"]), ",").alias("licences"),
                        F.array_join("unmatched", ",").alias("unmatched"), F.size("sentences").alias("sentences"),
                        F.array_min(F.transform("sentences", lambda x: x["start"])).alias("first_start"),
                        F.array_max(F.transform("sentences", lambda x: x["end"])).alias("last_end"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), VOCABULARY)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_digests(table(spark, sf_dir, "pages"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = sharding.shards(docs, F.col("doc_id"), F.col("doc_id"), [F.col("doc_id"), F.col("text")], F.octet_length("text"))
    return placed.withColumnRenamed("row", "doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(curriculum.sized(table(spark, sf_dir, "documents"), F.col("doc_id")), "sized")
    return curriculum.mixed(curriculum.plan(rows)).select(
        F.col("row").alias("doc_id"), "size", "source_size", "target", "taken", "position")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def op10_voronoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_top_k(table(spark, sf_dir, "embeddings"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.listed(secrets.secrets(table(spark, sf_dir, "documents")))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_value_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))


def _rounds(rounds: int) -> str:
    """SQL of ``nearest0, books1, nearest1, ...``: each round's assignment and the codebooks that follow from it."""
    def nearest(k: int) -> str:
        return f"""nearest{k} as (
            select row, label, vec_id, v.part, any_value(v.v) as v, min(d * 256 + entry) as best
            from (select p.*, entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
                  from pieces p join books{k} b on p.part = b.part) v
            group by row, label, vec_id, v.part)"""

    return ",\n        ".join(f"""{nearest(k)},
        sums{k} as (select part, best % 256 as entry, unnest(v) as x, unnest(range(len(v))) as place from nearest{k}),
        means{k} as (select part, entry, place, floor(sum(x)::double / count(*))::bigint as x from sums{k} group by part, entry, place),
        lists{k} as (select part, entry, list(x order by place) as v from means{k} group by part, entry),
        books{k + 1} as (select b.part, b.entry, coalesce(l.v, b.v) as v from books{k} b left join lists{k} l on b.part = l.part and b.entry = l.entry)"""
                              for k in range(rounds)) + ",\n        " + nearest(rounds)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_licences, op2_packing, op3_warc, op4_fingerprints, op5_shards, op6_quality, op7_curriculum,
                            op8_simhash, op9_urls, op10_voronoi, op11_secrets, op12_spelling, op13_value_codes)}

SQL: dict[str, str] = {
    "op3_warc": """
        with payloads as (
            select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as bytes, sha256(coalesce(html, '')) as digest from pages),
        firsts as (select digest, min(page_id) as first_id from payloads where bytes >= 100 group by digest)
        select page_id, bytes::bigint as payload_bytes, digest as payload_digest,
               case when bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
               case when bytes >= 100 and page_id <> first_id then first_id end as refers_to
        from payloads left join firsts using (digest)""",
    "op5_shards": f"""
        with rows as (
            select doc_id, coalesce(strlen(text), 0)::bigint as size,
                   lpad(bin(('0x' || substr(md5(coalesce(doc_id::varchar, '\\N')), 1, {sharding.KEY_DIGITS}))::bigint), {4 * sharding.KEY_DIGITS}, '0')
                   || lpad(bin(('0x' || substr(md5(coalesce(doc_id::varchar, '\\N') || '|' || coalesce(text, '\\N')), 1, {sharding.ROW_DIGITS}))::bigint),
                           {4 * sharding.ROW_DIGITS}, '0') as bits
            from documents),
        deep as (select *, unnest(range({sharding.HASH_BITS + 1}))::int as depth from rows),
        sums as (select *, sum(size) over (partition by depth, substr(bits, 1, depth))::bigint as shard_bytes from deep)
        select doc_id, size, substr(bits, 1, depth) as shard, depth, shard_bytes, shard_bytes > {sharding.LIMIT_BYTES} as oversized
        from sums where shard_bytes <= {sharding.LIMIT_BYTES} or depth = {sharding.HASH_BITS}
        qualify row_number() over (partition by doc_id order by depth) = 1""",
    "op7_curriculum": """
        with sizes as (
            select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
                   ('0x' || substr(md5(coalesce(doc_id::varchar, '\\N')), 1, 15))::bigint as hash
            from documents),
        sources as (
            select source, sum(size)::bigint as source_size, (row_number() over (order by source is null, source) - 1) % 3 as turn
            from sizes group by source),
        weighed as (
            select *, [3.0::double, 1.0::double, 2.0::double][turn + 1] as weight, 1.5::double * sum(source_size) over () as wanted,
                   [1.5::double, 1.0::double, 0.5::double][turn + 1] as w0, [0.5::double, 1.0::double, 1.5::double][turn + 1] as w1
            from sources),
        ordered as (
            select *, row_number() over o as place,
                   wanted - 2.0::double * coalesce(sum(source_size) over (o rows between unbounded preceding and 1 preceding), 0) as words,
                   sum(weight) over (o rows between current row and unbounded following) as weights
            from weighed window o as (order by 2.0::double * source_size / weight, turn, source)),
        edge as (
            select coalesce(min(place), 1000000000) as place from ordered where weight * words / weights <= 2.0::double * source_size),
        rest as (select words, weights from ordered where place = (select place from edge)),
        targets as (
            select source, source_size, w0, w1,
                   case when o.place < e.place then 2.0::double * source_size else weight * r.words / r.weights end as target
            from ordered o, edge e left join rest r on true),
        planned as (
            select doc_id, size, source_size, target, floor(target)::bigint as demand, w0, w1,
                   coalesce(sum(size) over (partition by s.source order by hash, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
            from sizes s join targets t on s.source is not distinct from t.source),
        taken as (
            select *, case when source_size > 0 then demand // source_size else 0 end as passes from planned),
        parts as (
            select *, (passes * size + greatest(0, least(size, demand - passes * source_size - before)))::bigint as taken,
                   before::double / demand::double as given from taken)
        select doc_id, size::bigint as size, source_size, target, taken,
               case when taken > 0 then floor(case when w0 + sqrt(w0 * w0 + 2.0::double * (w1 - w0) * given) > 0
                   then 2.0::double * given / (w0 + sqrt(w0 * w0 + 2.0::double * (w1 - w0) * given)) else 0.0 end * 1e9::double)::bigint end as position
        from parts""",
    "op10_voronoi": """
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
            where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scores as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
            from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
        select query_id, rank, vec_id, score from (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scores) where rank <= 5""",
    # The checksum's table from its rule, one step per bit; letters beyond A to Z take two bytes each.
    "op12_spelling": """
        with recursive steps as (
            select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as steps
            from range(256) t(i)),
        runs as (
            select coalesce(doc_id::varchar, '') as id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
            from documents),
        counted as (select id, run, count(*) as n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
                case when unicode(c) < 128 then [unicode(c)::bigint] else [(192 + (unicode(c) >> 6))::bigint, (128 + (unicode(c) & 63))::bigint] end)) as bytes
            from runs where length(run) >= 7 group by id, run),
        hashed as (
            select run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) as h
            from counted, steps),
        words as (
            select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(n)::bigint as n
            from hashed group by word having length(word) >= 7 and sum(n) >= 2),
        shorter as (
            select word, place, left(word, place::int) || substr(word, place::int + 2) as rest from (select word, unnest(range(length(word))) as place from words)),
        pairs as (
            select a.word, b.word as other from shorter a join shorter b on a.rest = b.rest and a.place = b.place where a.word <> b.word
            union select s.word, w.word from shorter s join words w on s.rest = w.word
            union select w.word, s.word from shorter s join words w on s.rest = w.word),
        near as (
            select p.word, count(*) as n_near, max(o.n) as best_n, arg_min(o.word, (-o.n, o.word)) as best
            from pairs p join words o on p.other = o.word group by p.word),
        forms as (
            select word, n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * n then best end as form, case when best_n >= 10 * n then best_n end as form_n
            from words left join near using (word)),
        paths as (
            select word, word as root, 0 as steps from forms
            union all select p.word, f.form, steps + 1 from paths p join forms f on p.root = f.word where f.form is not null),
        roots as (select word, arg_max(root, steps) as root from paths group by word)
        select word, form, root, n, n_near, form_n from forms join roots using (word)""",
    "op13_value_codes": f"""
        with kept as (
            select row_number() over (order by vec_id nulls last) - 1 as row, vec_id, label,
                   list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        pieces as (
            select row, vec_id, label, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] as v
            from (select *, unnest(range(4)) as part from kept)),
        books0 as (select part, row as entry, v from pieces where row < 256),
        {_rounds(4)},
        errors as (
            select row, vec_id, label, string_agg(printf('%02x', (best % 256)::bigint), '' order by part) as code, sum(best // 256)::bigint as error
            from nearest4 group by row, vec_id, label)
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
               (select sha256(string_agg(list_aggregate(v, 'string_agg', ','), ',' order by part, entry)) from books4) as codebooks_sha256
        from errors""",
}
