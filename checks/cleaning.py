"""Cleaning and typing over text made from whole bundled tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.feeds import duck_sql, spark_sql
from checks.registry import check, table
from checks.typed_tables import BLANKS
from rosterlake.functions import clean as C
from rosterlake.operators.incremental import with_audit
from rosterlake.operators.quality import typed_and_rejected

DIRTY = ("case when event_id % 11 = 0 then concat(' ', chr(9), chr(10)) when event_id % 7 = 0 then '' "
         "when event_id % 5 = 0 then concat(chr(9), ' ', props, chr(10), ' ') else props end")


@check("clean_blank_to_null", f"select event_id, nullif(trim({DIRTY}, {BLANKS}), '') as props from events")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{DIRTY} as props")
    return rows.select("event_id", C.blank_to_null("props").alias("props"))


NUMBER = "case when l_linenumber = 3 then null else concat(case when l_returnflag = 'R' then '-' else '' end, cast(l_orderkey as string)) end"


@check("clean_to_bigint", f"select l_orderkey, l_linenumber, l_partkey, cast({NUMBER} as bigint) as number from lineitem")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", f"{NUMBER} as t")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", C.to_bigint("t").alias("number"))


FLAG = "case o_orderstatus when 'F' then 'True' when 'P' then 'FALSE' else case when o_totalprice > 200000 then 'false' end end"


@check("clean_to_bool", f"select o_orderkey, cast({FLAG} as boolean) as flag from orders")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{FLAG} as t")
    return rows.select("o_orderkey", C.to_bool("t").alias("flag"))


MOMENT = "case when event_id % 7 = 0 then ' ' when event_id % 5 = 0 then concat(' ', {ts:ts}, chr(9)) else lower({ts:ts}) end"


@check("clean_to_timestamp", duck_sql(f"""
select event_id, strptime(nullif(trim({MOMENT}, {BLANKS}), ''), '%m/%d/%Y %I:%M:%S %p') as moment from events"""))
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{spark_sql(MOMENT)} as t")
    return rows.select("event_id", C.to_time("t").alias("moment"))


# Copies that differ in padding only become one row once typed.
LOOSE = "case when l_linenumber % 2 = 0 then concat(' ', l_returnflag) else l_returnflag end"


@check("distinct_typed", f"""
select distinct cast(cast(l_suppkey as varchar) as bigint) as l_suppkey, nullif(trim({LOOSE}), '') as l_returnflag,
       strptime({duck_sql('{ts:l_shipdate}')}, '%m/%d/%Y %I:%M:%S %p') as l_shipdate from lineitem""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_suppkey as string) as l_suppkey", f"{LOOSE} as l_returnflag",
        f"{spark_sql('{ts:l_shipdate}')} as l_shipdate")
    return rows.select(C.to_bigint("l_suppkey").alias("l_suppkey"), C.blank_to_null("l_returnflag").alias("l_returnflag"),
                       C.to_time("l_shipdate").alias("l_shipdate")).distinct()


@check("audit_load_id", "select count(*) as loaded, count(*) as load_ids, cast(0 as bigint) as missing from lineitem")
def _(spark, sf_dir):
    rows = with_audit(table(spark, sf_dir, "lineitem"))
    # Counting distinct ids is itself the check, so every id travels once.
    return rows.agg(F.count(F.lit(1)).alias("loaded"), F.countDistinct("load_id").alias("load_ids"),
                    F.count(F.when(F.col("load_id").isNull(), 1)).alias("missing"))


@check("audit_load_ts", "select count(*) as loaded, true as one_stamp, true as recent from lineitem")
def _(spark, sf_dir):
    rows = with_audit(table(spark, sf_dir, "lineitem"))
    return rows.agg(
        F.count(F.lit(1)).alias("loaded"), (F.min("load_ts") == F.max("load_ts")).alias("one_stamp"),
        (F.max("load_ts") > F.current_timestamp() - F.expr("interval 1 day")).alias("recent"))


@check("project_star", "select 'n' as before, supplier.*, s_acctbal as behind from supplier")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    return rows.select(F.lit("n").alias("before"), *rows.columns, F.col("s_acctbal").alias("behind"))


# Text that does not fit its type, here and there.
BROKEN = {
    "number": "case when event_id % 13 = 0 then '' when event_id % 17 = 0 then 'x' else cast(event_id as string) end",
    "moment": "case when event_id % 19 = 0 then '13/40/2021 1:00:00 AM' when event_id % 7 = 0 then ' ' else {ts:ts} end",
    "flag": "case when event_id % 23 = 0 then '1' when value > 100 then 'True' end",
}
KINDS = {"number": C.BIGINT, "moment": C.TIME, "flag": C.BOOL}


@check("dq_rejects", duck_sql(f"""
with r as (select event_id, {', '.join(f'{e} as {c}' for c, e in BROKEN.items())} from events),
t as (select *, try_cast(number as bigint) as number_t, try_strptime(nullif(trim(moment), ''), '%m/%d/%Y %I:%M:%S %p') as moment_t,
             case lower(flag) when 'true' then true when 'false' then false end as flag_t from r)
select event_id, number, moment, flag,
       concat_ws(',', case when number is not null and number_t is null then 'number' end,
                 case when nullif(trim(moment), '') is not null and moment_t is null then 'moment' end,
                 case when flag is not null and flag_t is null then 'flag' end) as bad_columns
from t where (number is not null and number_t is null) or (nullif(trim(moment), '') is not null and moment_t is null)
   or (flag is not null and flag_t is null)"""))
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", *[f"{spark_sql(e)} as {c}" for c, e in BROKEN.items()])
    rejected = typed_and_rejected(rows, KINDS)[1]
    return rejected.withColumn("bad_columns", F.concat_ws(",", "bad_columns"))
