"""Naming rules and manifests. File names are made from the bundled rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from rosterlake.functions import names as N
from rosterlake.sources import manifest as M

LOAD_TS = "2024-02-01 03:04:05"

# One archive per event, one member file per event type.
ARCHIVE = "concat('drop_', event_type, '_', cast(20240100 + user_id % 28 + 1 as string), '.zip')"
MEMBER = "concat(case when user_id % 2 = 0 then 'ClickImpression' else 'NotSent' end, '.', event_type, '.csv')"


@check("ingest_feed_from_path", f"""
select event_id, left(a, length(a) - 13) as folder from (select event_id, {ARCHIVE} as a from events)""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{ARCHIVE} as a")
    return rows.select("event_id", N.feed_folder("a").alias("folder"))


@check("ingest_table_name", f"""
select event_id, event_type || '_' || lower(split_part(m, '.', 1)) as table_name
from (select event_id, event_type, {MEMBER} as m from events)""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{ARCHIVE} as a", f"{MEMBER} as m")
    return rows.select("event_id", N.landing_table(N.feed_folder("a"), "m").alias("table_name"))


# One file per order: folder by status, name by priority, extension by year, some folder markers.
BLOB = ("concat(case when o_orderstatus = 'F' then 'in/level2/' when o_orderstatus = 'O' then 'in/pilots/' "
        "else 'old/level2/' end, case when o_totalprice < 20000 then '' else concat("
        "case when o_orderpriority = '5-LOW' then 'tmp_' else 'trk_' end, 'Orders_', cast(o_custkey as string), "
        "'_', cast(20240000 + o_orderkey as string), case when o_orderpriority = '2-HIGH' then '.v2' else '' end, "
        "case when o_orderpriority = '1-URGENT' then '.txt' else '.csv' end) end)")
IN_FOLDER = f"""
select b as blob_name, substr(b, 4) as file_name from (select {BLOB} as b from orders)
where b like 'in/%' and right(b, 1) <> '/'"""


def _files(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(f"{BLOB} as blob_name")


def _flat(spark, sf_dir):
    """File names without their folders."""
    return _files(spark, sf_dir).select("blob_name", F.substring_index("blob_name", "/", -1).alias("file_name"))


FLAT = f"select b as blob_name, split_part(b, '/', 3) as file_name from (select {BLOB} as b from orders)"


def _manifest_sql(files: str, name: str, where: str = "true") -> str:
    return f"""
select blob_name, table_name, file_name, 'n' as is_table_new, 'n' as has_table_schema_changed,
       'n' as table_loaded_successfully, cast(0 as bigint) as table_rows_loaded,
       cast(null as varchar) as dialect_field_delimiter, cast(null as varchar) as dialect_quote_delimiter,
       '20240201_030405' as table_load_date
from (select *, lower({name}) as table_name from ({files})) where {where}"""


def _stamp():
    return F.lit(LOAD_TS).cast("timestamp_ntz")


@check("manifest_build", _manifest_sql(IN_FOLDER, "split_part(file_name, '.', 1)"))
def _(spark, sf_dir):
    return M.build_manifest(_files(spark, sf_dir), _stamp(), blob_path="in/")


@check("manifest_filter_prefix", f"select * from ({FLAT}) where file_name like 'trk%'")
def _(spark, sf_dir):
    return M.with_prefix(_flat(spark, sf_dir), "trk")


@check("manifest_filter_type", f"select * from ({FLAT}) where split_part(file_name, '.', -1) = 'csv'")
def _(spark, sf_dir):
    return M.with_type(_flat(spark, sf_dir), "csv")


# The list names every order of the customers in one market; those of low balance with a table.
WANTED = ("concat('Orders_', cast(c_custkey as string))",
          "case when c_acctbal < 2000 then concat('GIVEN_', cast(c_custkey as string)) end")
WANTED_FILE = ("concat('level2/trk_Orders_', cast(o_custkey as string), '_', cast(20240000 + o_orderkey as string), '.csv')")


@check("manifest_filter_list", _manifest_sql(f"""
select f.blob_name, f.file_name, w.given from ({IN_FOLDER}) f join (
  select {WANTED_FILE} as file_name, {WANTED[1]} as given
  from orders join customer on c_custkey = o_custkey where c_mktsegment = 'BUILDING') w using (file_name)""",
    "coalesce(given, 'p_' || split_part(split_part(file_name, '.', 1), '/', 1) || '/' || regexp_replace(split_part(split_part(file_name, '.', 1), '/', 2), '_[^_]*$', ''))"))
def _(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    wanted = (orders.join(customer.where("c_mktsegment = 'BUILDING'"), orders.o_custkey == customer.c_custkey)
              .selectExpr(f"{WANTED_FILE} as file_name", f"{WANTED[1]} as given_table"))
    return M.build_manifest(_files(spark, sf_dir), _stamp(), blob_path="in/", only=wanted,
                            remove_tail="_", add_prefix="p_")


@check("name_strip_prefix", f"select blob_name, replace(file_name, 'trk_', '') as name from ({FLAT})")
def _(spark, sf_dir):
    return _flat(spark, sf_dir).select("blob_name", N.without_prefix("file_name", "trk_").alias("name"))


@check("name_strip_trailing", f"""
select blob_name, case when contains(stem, '_') then left(stem, length(stem) - strpos(reverse(stem), '_')) else stem end as name
from (select blob_name, split_part(file_name, '.', 1) as stem from ({FLAT}))""")
def _(spark, sf_dir):
    return _flat(spark, sf_dir).select("blob_name", N.without_tail(N.file_stem("file_name"), "_").alias("name"))


@check("name_affix_lower", f"""
select blob_name, 'pre_' || lower(split_part(file_name, '.', 1)) || '_etl' as name from ({FLAT})""")
def _(spark, sf_dir):
    return _flat(spark, sf_dir).select("blob_name", N.affixed(N.file_stem("file_name"), "Pre_", "_ETL").alias("name"))


# Header-like text of whole documents' titles: words in mixed case, with the marks headers carry.
HEADER = ("concat(case when event_id % 3 = 0 then ' Send' when event_id % 3 = 1 then '2nd' else 'DE' end, "
          "case event_type when 'click' then 'URLID' when 'view' then 'ClientID ' when 'error' then 'E-mail/Addr' "
          "when 'signup' then '__Join Date' else 'price$' end, cast(user_id as string), '___', props)")


@check("header_snake_case", f"""
with h as (select event_id, {HEADER} as header from events),
s1 as (select *, translate(trim(header), '/ -', '___') as t from h),
s2 as (select *, regexp_replace(t, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g') as u from s1),
s3 as (select *, replace(lower(regexp_replace(u, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '__', '_') as v from s2)
select event_id, header, regexp_replace(v, '(^[^a-zA-Z])|(\\W)', '_', 'g') as name from s3""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{HEADER} as header")
    return rows.withColumn("name", N.column_name("header"))
