"""Writes into the scratch folder, read back, and the JSON documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.identity import CROSSWALK, crosswalk
from checks.registry import check, table
from rosterlake.operators.business_keys import latest_by_key, without_known
from rosterlake.operators.incremental import with_audit
from rosterlake.session import scratch_dir
from rosterlake.sinks import json_load as J
from rosterlake.sinks import ledger as L
from rosterlake.sinks import tables as S
from rosterlake.sources import json_documents as JD
from rosterlake.sources import manifest as M

RUN_DATE = "2024-02-01"


def _day(text: str = RUN_DATE):
    return F.lit(text).cast("date")


def _fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


_MANIFEST_SQL = """
select 'in/' || c_name || '.csv' as blob_name, 'level2_' || lower(c_mktsegment) as table_name, c_name || '.csv' as file_name,
       'n' as is_table_new, 'n' as has_table_schema_changed, {} as table_loaded_successfully, {} as table_rows_loaded,
       cast(null as varchar) as dialect_field_delimiter, cast(null as varchar) as dialect_quote_delimiter,
       '20240201_000000' as table_load_date from customer {}"""


def _manifest(spark, sf_dir):
    files = table(spark, sf_dir, "customer").selectExpr("concat('in/', c_name, '.csv') as blob_name", "c_mktsegment", "c_name")
    wanted = files.selectExpr("concat(c_name, '.csv') as file_name", "concat('level2_', c_mktsegment) as given_table")
    return M.build_manifest(files.select("blob_name"), F.lit(RUN_DATE).cast("timestamp_ntz"), blob_path="in/", only=wanted)


@check("manifest_save", _MANIFEST_SQL.format("'n'", "cast(0 as bigint)", ""))
def _(spark, sf_dir):
    root = scratch_dir(spark, "manifest")
    _manifest(spark, sf_dir).write.json(root)
    return spark.read.schema(M.MANIFEST).json(root)


@check("load_row_audit", _MANIFEST_SQL.format(
    "case when n is null then 'n' else 'y' end", "coalesce(n, 0)",
    """left join (select 'level2_' || lower(c_mktsegment) as t, count(*) as n from customer join orders on o_custkey = c_custkey
       where c_mktsegment <> 'MACHINERY' group by 1) on t = 'level2_' || lower(c_mktsegment)"""))
def _(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    loaded = (table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .select(F.lower(F.concat(F.lit("level2_"), "c_mktsegment")).alias("table_name")))
    return M.with_load_results(_manifest(spark, sf_dir), loaded)


@check("load_write_mode", """
select 'truncated' as target, * from orders where o_orderstatus = 'F'
union all select 'appended', * from orders""")
def _(spark, sf_dir):
    root, orders = scratch_dir(spark, "modes"), table(spark, sf_dir, "orders")
    first, second = orders.where("o_orderstatus <> 'F'"), orders.where("o_orderstatus = 'F'")
    for target, mode in (("truncated", "truncate"), ("appended", "append")):
        S.load(first, f"{root}/{target}", mode)
        S.load(second, f"{root}/{target}", mode)
    back = [spark.read.parquet(f"{root}/{t}").select(F.lit(t).alias("target"), "*") for t in ("truncated", "appended")]
    return back[0].unionByName(back[1])


@check("snapshot_archive", f"""
select *, date '2024-01-31' as snapshot_date from orders where o_orderstatus <> 'P'
union all select *, date '2024-01-30' from orders""")
def _(spark, sf_dir):
    root, orders = scratch_dir(spark, "snapshots"), table(spark, sf_dir, "orders")
    S.snapshot(orders, root, _day("2024-01-31"))
    S.snapshot(orders, root, _day())
    # The same day again: its snapshot is replaced, the other stays.
    S.snapshot(orders.where("o_orderstatus <> 'P'"), root, _day())
    return spark.read.parquet(root)


@check("snapshot_name", """
select o_orderkey, 'orders_' || strftime(o_orderdate - interval 1 day, '%Y%m%d') as name from orders""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", S.snapshot_name(F.lit("orders"), F.col("o_orderdate").cast("date")).alias("name"))


@check("table_copy", "select * from lineitem")
def _(spark, sf_dir):
    root = scratch_dir(spark, "copy")
    S.copy_table(spark, f"{sf_dir}/lineitem.parquet", root)
    return spark.read.parquet(root)


@check("publish_final", "select 'part' as source, p_partkey as key, p_name as name from part "
       "union all select 'supplier', s_suppkey, s_name from supplier")
def _(spark, sf_dir):
    root, stage, final = scratch_dir(spark, "final"), _fresh_name("stage"), _fresh_name("final")
    spark.sql(f"CREATE DATABASE {stage} LOCATION '{root}/stage'")
    columns = {"part": ("p_partkey", "p_name"), "supplier": ("s_suppkey", "s_name")}
    for name in columns:
        S.publish(table(spark, sf_dir, name), f"{stage}.{name}", f"{root}/stage", "1")
    # Published twice: the second version takes the place of the first.
    for version in ("1", "2"):
        S.copy_database(spark, stage, final, f"{root}/final", version)
    out = [spark.table(f"{final}.{n}").select(F.lit(n).alias("source"), F.col(key).alias("key"), F.col(name).alias("name"))
           for n, (key, name) in columns.items()]
    return out[0].unionByName(out[1])


@check("ods_append", "select o_orderkey, o_custkey, count(*) as copies, true as has_load from (select * from orders union all "
       "select * from orders where o_orderstatus = 'F') group by o_orderkey, o_custkey")
def _(spark, sf_dir):
    root, orders = scratch_dir(spark, "ods"), table(spark, sf_dir, "orders")
    # Loads append by name and check nothing: what comes again is there again.
    S.append(with_audit(orders.select("o_orderkey", "o_custkey")), root)
    S.append(with_audit(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")), root)
    return spark.read.parquet(root).groupBy("o_orderkey", "o_custkey").agg(
        F.count(F.lit(1)).alias("copies"), (F.count("load_id") == F.count("load_ts")).alias("has_load"))


@check("stg_overwrite", CROSSWALK + "select * from crosswalk")
def _(spark, sf_dir):
    root = scratch_dir(spark, "crosswalk")
    S.overwrite(table(spark, sf_dir, "region"), root)
    S.overwrite(crosswalk(spark, sf_dir), root)
    return spark.read.parquet(root)


@check("schema_recreate", "select o_orderkey, o_orderstatus, false as first_new, true as changed from orders")
def _(spark, sf_dir):
    root, name = scratch_dir(spark, "recreated"), _fresh_name("orders")
    orders = table(spark, sf_dir, "orders")
    old, new = orders.select("o_orderkey", "o_custkey"), orders.select("o_orderkey", "o_orderstatus")
    S.recreate_if_changed(spark, name, old.schema, root, "1")
    S.insert_by_name(old, name)
    is_new, changed = S.recreate_if_changed(spark, name, new.schema, root, "2")
    S.insert_by_name(new, name)
    return spark.table(name).select("*", F.lit(is_new).alias("first_new"), F.lit(changed).alias("changed"))


@check("create_if_missing", "select o_orderkey, o_custkey, true as created, false as created_again from orders")
def _(spark, sf_dir):
    root, name = scratch_dir(spark, "created"), _fresh_name("runs")
    first = S.create_if_missing(spark, name, "o_orderkey bigint, o_custkey bigint", root)
    again = S.create_if_missing(spark, name, "o_orderkey bigint, o_custkey bigint", root)
    S.insert_by_name(table(spark, sf_dir, "orders"), name)
    return spark.table(name).select("*", F.lit(first).alias("created"), F.lit(again).alias("created_again"))


@check("run_ledger", "select distinct cast(ts as date) as dt, event_type as pipeline from events")
def _(spark, sf_dir):
    root = scratch_dir(spark, "ledger")
    runs = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("dt"), F.col("event_type").alias("pipeline"))
    S.append(L.new_runs(runs.where("pipeline <> 'click'")), root)
    S.append(L.new_runs(runs, spark.read.parquet(root)), root)
    return spark.read.parquet(root)


_PATH = "concat('in/', cast(o_orderdate as date), '/', cast(o_orderkey as string), '.csv')"


@check("processed_files", f"select {_PATH} as path from orders where o_orderdate >= timestamp '1998-01-01 00:00:00'")
def _(spark, sf_dir):
    root = scratch_dir(spark, "processed")
    files = table(spark, sf_dir, "orders").selectExpr(f"{_PATH} as path", "o_orderdate")
    S.append(L.processed_entries(files.where("o_orderdate < timestamp_ntz '1998-01-01 00:00:00'"), _day()), root)
    return M.not_yet_processed(files.select("path"), spark.read.parquet(root))


# ---------------------------------------------------------------- JSON documents

# Events as reviews, some without an object or a date. A document holds a fixed number of them.
PER_DOCUMENT = 500
REVIEW = ("event_type as display_title", "case when value > 100 then 'PG' end as mpaa_rating",
          "cast(user_id % 2 as int) as critics_pick", "props as headline",
          "cast(cast(ts as date) as string) as publication_date")


def _documents(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "floor(event_id / 500) as doc", *REVIEW,
        "case when user_id % 3 = 0 then named_struct('type', event_type, 'width', user_id) end as multimedia")
    results = F.struct(*[c for c in rows.columns if c != "doc"])
    # At most PER_DOCUMENT elements per group.
    docs = rows.groupBy("doc").agg(F.to_json(F.struct(
        F.lit("OK").alias("status"), F.collect_list(results).alias("results"))).alias("value"))
    return docs.select(F.lit("reviews").alias("path"), F.format_string("202401%02d", F.col("doc") % 28 + 1).alias("ds"), "value", "doc")


def _landed_rows(spark, sf_dir):
    root = scratch_dir(spark, "json")
    J.land_documents(_documents(spark, sf_dir), root)
    return JD.result_rows(JD.read_documents(spark, root, multi_line=False))


_RESULTS = """
select event_id, event_type as display_title, case when value > 100 then 'PG' end as mpaa_rating, user_id % 2 as critics_pick,
       props as headline, strftime(ts, '%Y-%m-%d') as publication_date,
       case when user_id % 3 = 0 then '{"type":"' || event_type || '","width":' || cast(user_id as varchar) || '}' end as multimedia
from events"""


@check("json_results_rows", f"select * exclude (multimedia), multimedia is not null as has_object from ({_RESULTS})")
def _(spark, sf_dir):
    rows = _landed_rows(spark, sf_dir)
    return rows.withColumn("has_object", F.col("multimedia").isNotNull()).drop("multimedia")


@check("json_nested_to_string", _RESULTS)
def _(spark, sf_dir):
    return JD.objects_to_text(_landed_rows(spark, sf_dir))


# One key that holds an object, a text or nothing.
@check("json_mixed_objects", """
select event_id, case when user_id % 3 = 0 then '{"type":"' || event_type || '","width":' || cast(user_id as varchar) || '}'
                      when user_id % 3 = 1 then '"' || event_type || '"' end as multimedia from events""")
def _(spark, sf_dir):
    element = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"multimedia":'), F.expr(
        """case when user_id % 3 = 0 then to_json(named_struct('type', event_type, 'width', user_id))
                when user_id % 3 = 1 then concat('"', event_type, '"') else 'null' end"""), F.lit("}"))
    # At most PER_DOCUMENT elements per group.
    docs = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / PER_DOCUMENT).alias("doc")).agg(
        F.concat(F.lit('{"results":['), F.array_join(F.collect_list(element), ","), F.lit("]}")).alias("value"))
    return JD.mixed_objects_to_text(JD.result_variants(docs))


@check("json_landing", "select 'reviews' as path, 20240101 + floor(event_id / 500.0)::int % 28 as ds, event_id from events")
def _(spark, sf_dir):
    root, docs = scratch_dir(spark, "landing"), _documents(spark, sf_dir)
    J.land_documents(docs.withColumn("value", F.lit("{}")), root)
    # Landed again, a day's documents take the place of the earlier ones.
    J.land_documents(docs, root)
    held = F.from_json("value", "results array<struct<event_id bigint>>").getField("results")
    return spark.read.text(root).select("path", "ds", F.explode(held).alias("r")).select("path", "ds", "r.event_id")


def _text_nulls(names):
    return ", ".join(f"cast(null as varchar) as {n}" for n in names)


@check("json_insert_typed", f"""
select display_title, mpaa_rating, cast(critics_pick as int) as critics_pick, cast(null as varchar) as byline, headline,
       cast(null as varchar) as summary_short, cast(publication_date as date) as publication_date,
       cast(null as date) as opening_date, cast(null as date) as date_updated, cast(null as varchar) as link, multimedia,
       true as has_id from ({_RESULTS})""")
def _(spark, sf_dir):
    root, name = scratch_dir(spark, "reviews"), _fresh_name("reviews")
    rows = JD.objects_to_text(_landed_rows(spark, sf_dir)).drop("event_id")
    S.create_if_missing(spark, name, J.AUDIT + J.REVIEWS, root)
    S.insert_by_name(J.with_identity(J.typed_documents(rows, J.REVIEWS)), name)
    back = spark.table(name)
    return back.select(*[c for c in back.columns if c not in ("id", "ingested_at")],
                       (F.col("id").isNotNull() & F.col("ingested_at").isNotNull()).alias("has_id"))


# Part descriptions as titles: some exceed the column.
TITLE = "concat(p_name, ' ', p_type, ' ', p_brand, case when p_size > 25 then repeat(' of great length', 2) else '' end)"


@check("varchar_check", f"""
select p_partkey, t as display_title, length(t) > 50 as rejected from (select p_partkey, {TITLE} as t from part)""")
def _(spark, sf_dir):
    root, name = scratch_dir(spark, "titles"), _fresh_name("titles")
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{TITLE} as display_title")
    listed = "p_partkey bigint, display_title varchar(50)"
    S.create_if_missing(spark, name, listed, root)
    S.insert_by_name(rows.where(~J.too_long(listed)), name)
    kept = spark.table(name).withColumn("rejected", F.lit(False))
    return kept.unionByName(rows.where(J.too_long(listed)).withColumn("rejected", F.lit(True)))


# A batch of events by user and kind, the latest of each; the target holds what every seventh event names.
@check("insert_new_business_keys", """
with ranked as (select user_id, event_type, event_id, ts,
                       row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from events)
select user_id, event_type, event_id, ts from ranked r where n = 1 and not exists (
    select 1 from events e where e.event_id % 7 = 0 and e.user_id = r.user_id and e.event_type = r.event_type)""")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    day, key = scratch_dir(spark, "day"), ["user_id", "event_type"]
    S.overwrite(latest_by_key(events, key, ["ts", "event_id"]), day)
    return without_known(spark.read.schema(events.schema).parquet(day), events.where("event_id % 7 = 0"), key)
