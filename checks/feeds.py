"""Tracking feeds, history and person lookups made from the bundled tables.

Every expression is SQL that Spark and DuckDB read alike, so both sides of a check start
from the same rows. Only time formatting differs; ``{ts:x}`` stands for it. Each feed
takes whole tables: two feeds overlap, and together they hold every row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from checks.registry import table
from rosterlake.plans.catalog import ENTITIES, Entity

SPARK_TIME = r"date_format(\1, 'MM/dd/yyyy hh:mm:ss a')"
DUCK_TIME = r"strftime(\1, '%m/%d/%Y %I:%M:%S %p')"


def spark_sql(expr: str) -> str:
    return re.sub(r"\{ts:([^}]*)\}", SPARK_TIME, expr)


def duck_sql(expr: str) -> str:
    return re.sub(r"\{ts:([^}]*)\}", DUCK_TIME, expr)


def text(expr: str) -> str:
    return f"cast({expr} as string)"


def key_of(n: str) -> str:
    """Contact id, account id, prefixed mail or candidate id, by turns."""
    return (f"case {n} % 4 when 0 then concat('C', {text(n)}) when 1 then concat('A', {text(n)}) "
            f"when 2 then concat('P', {text(n + ' % 40')}, '_u', {text(n)}, '@mail') "
            f"else concat('L', {text(n)}) end")


def padded(expr: str, n: str) -> str:
    return f"case when {n} % 5 = 0 then concat('  ', {expr}, ' ') else {expr} end"


def blanked(expr: str, n: str) -> str:
    return f"case when {n} % 7 = 0 then '  ' else {expr} end"


class Base:
    """One bundled table as the source of some entities."""

    def __init__(self, table: str, row: str, feeds: dict[str, str], columns: dict[str, str]):
        self.table, self.row, self.feeds, self.columns = table, row, feeds, columns

    def raw(self, entity: Entity, column: str) -> str:
        if column in self.columns:
            return self.columns[column]
        # Any other text column: labelled by its name, padded or blank by turns.
        value = f"concat('{column} ', {text(self.row + ' % 50')})"
        return blanked(padded(value, self.row), self.row)


_USER = "user_id"
EVENTS = Base("events", "event_id",
    {"level2": "event_type <> 'view'", "pilots": "event_type <> 'click'"},
    {
        "client_id": text("user_id % 3 + 1"),
        "send_id": text("event_id % 100"),
        "subscriber_key": padded(key_of("user_id"), "event_id"),
        "email_address": f"concat('u', {text('user_id')}, '@mail')",
        "subscriber_id": text("user_id"),
        "list_id": text("user_id % 25"),
        "event_date": padded("{ts:ts}", "event_id"),
        "event_type": "event_type",
        "batch_id": text("event_id % 10"),
        "smtp_code": "case when event_type = 'error' then '550' else '250' end",
        "is_unique": "case when value > 100 then 'True' when value > 50 then 'false' end",
        "is_unique_for_url": "case when value > 150 then 'TRUE' else 'False' end",
    })
CUSTOMER = Base("customer", "c_custkey",
    {"level2": "c_mktsegment <> 'BUILDING'", "pilots": "c_mktsegment <> 'FURNITURE'"},
    {
        "client_id": text("c_custkey % 3 + 1"),
        "subscriber_key": padded(key_of("c_custkey"), "c_custkey"),
        "email_address": f"concat('u', {text('c_custkey')}, '@mail')",
        "subscriber_id": text("c_custkey"),
        "status": "c_mktsegment",
        "date_held": "case when c_acctbal < 0 then '01/02/2021 12:00:00 AM' else ' ' end",
        "date_created": "'1/2/2021 3:04:05 PM'",
        "date_unsubscribed": "case when c_acctbal > 5000 then '12/31/2021 12:30:00 pm' end",
    })
ORDERS = Base("orders", "o_orderkey",
    {"all_bu": "o_orderpriority <> '5-LOW'", "level2": "o_orderstatus <> 'O'",
     "pilots": "o_orderstatus <> 'F'"},
    {
        "client_id": text("o_custkey % 3 + 1"),
        "send_id": text("o_orderkey"),
        "subscriber_key": padded(key_of("o_custkey"), "o_orderkey"),
        "email_address": f"concat('u', {text('o_custkey')}, '@mail')",
        "subscriber_id": text("o_custkey"),
        "list_id": text("o_orderkey % 25"),
        "date_joined": "{ts:o_orderdate}",
        "date_unsubscribed": "case when o_orderstatus = 'F' then {ts:o_orderdate} else '' end",
        "join_type": padded("o_orderpriority", "o_orderkey"),
        "old_status": "o_orderstatus",
        "new_status": blanked("o_orderpriority", "o_orderkey"),
        "date_changed": "{ts:o_orderdate}",
        "sched_time": "{ts:o_orderdate}",
        "sent_time": "case when o_orderstatus = 'F' then {ts:o_orderdate} end",
        "is_multipart": "case when o_totalprice > 100000 then 'True' else 'False' end",
    })
PART = Base("part", "p_partkey",
    {"all_bu": "p_size > 10", "level2": "p_type <> 'PROMO'", "pilots": "p_type <> 'ECONOMY'"},
    {
        "client_id": text("p_size % 3 + 1"),
        "list_id": text("p_partkey"),
        "name": "p_name",
        "date_created": "'1/2/2021 3:04:05 PM'",
        "list_type": "p_type",
    })
LINEITEM = Base("lineitem", "l_orderkey",
    {"all_bu": "l_returnflag <> 'N'", "level2": "l_returnflag <> 'A'", "pilots": "l_returnflag <> 'R'"},
    {
        "client_id": text("l_suppkey % 3 + 1"),
        "send_id": text("l_orderkey"),
        "list_id": text("l_linenumber"),
        "impression_region_id": text("l_partkey"),
        "event_date": "{ts:l_shipdate}",
        "date_created": "{ts:l_shipdate}",
        "de_client_id": "case when l_quantity > 10 then cast(l_suppkey as string) end",
        "status": "l_linestatus",
    })

_BASES = {"subscribers": CUSTOMER, "attributes": CUSTOMER, "list_membership": ORDERS,
          "status_change": ORDERS, "send_jobs": ORDERS, "lists": PART,
          "multiple_data_extension_send_lists": LINEITEM, "send_job_impression": LINEITEM}


def base_of(entity: str) -> Base:
    return _BASES.get(entity, EVENTS)


def raw_feeds(spark: SparkSession, sf_dir: str, name: str) -> list[DataFrame]:
    entity, base = ENTITIES[name], base_of(name)
    rows = table(spark, sf_dir, base.table)
    return [
        rows.where(base.feeds[feed]).selectExpr(
            *[f"{spark_sql(base.raw(entity, c))} as {c}" for c in entity.columns])
        for feed in entity.feeds
    ]


def raw_sql(name: str) -> str:
    entity, base = ENTITIES[name], base_of(name)
    columns = ", ".join(f"{duck_sql(base.raw(entity, c))} as {c}" for c in entity.columns)
    return " union all ".join(
        f"select {columns} from {base.table} where {base.feeds[feed]}" for feed in entity.feeds)


# ---- What was loaded before: (table, condition, stored columns). Text nulls where unset.

_MEMBER = {
    "client_id": "cast(o_custkey % 3 + 1 as bigint)",
    "subscriber_key": key_of("o_custkey"),
    "subscriber_id": text("o_custkey"),
    "list_id": "cast(o_orderkey % 25 as bigint)",
    "date_joined": "o_orderdate",
    "join_type": "case when o_orderkey % 4 = 0 then 'changed' else o_orderpriority end",
}
HISTORY = {
    "attributes": [("customer", "c_mktsegment in ('BUILDING', 'MACHINERY')", {
        "client_id": "cast(1 as bigint)",
        "subscriber_key": f"case when c_nationkey = 3 then concat(' ', {key_of('c_custkey')}) else {key_of('c_custkey')} end",
        "subscriber_id": text("c_custkey")})],
    "subscribers": [("customer", "c_mktsegment in ('BUILDING', 'MACHINERY')", {
        "client_id": "cast(c_custkey % 3 + 1 as bigint)",
        "subscriber_key": f"case when c_nationkey = 3 then concat(' ', {key_of('c_custkey')}) else {key_of('c_custkey')} end",
        "subscriber_id": text("c_custkey")})],
    "lists": [("part", "p_size < 25", {
        "client_id": "cast(p_size % 3 + 1 as bigint)", "list_id": "p_partkey"})],
    "multiple_data_extension_send_lists": [("lineitem", "l_shipdate < timestamp '1998-01-01 00:00:00'", {
        "client_id": "cast(l_suppkey % 3 + 1 as bigint)", "send_id": "l_orderkey",
        "list_id": "cast(l_linenumber as bigint)"})],
    "send_jobs": [("orders", "o_orderdate < timestamp '1998-01-01 00:00:00'", {
        "client_id": "cast(o_custkey % 3 + 1 as bigint)", "send_id": "o_orderkey"})],
    # Two stored versions of a key; the second differs in what may be null.
    "list_membership": [
        ("orders", "o_orderdate < timestamp '1999-01-01 00:00:00'", _MEMBER),
        ("orders", "o_orderdate < timestamp '1996-01-01 00:00:00'",
         {**_MEMBER, "date_unsubscribed": "case when o_orderstatus = 'F' then o_orderdate end",
          "unsubscribe_reason": "'asked'"}),
    ],
}
_NULL_TYPE = {"bigint": "bigint", "string": "string", "timestamp_ntz": "timestamp_ntz", "boolean": "boolean"}


def history(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    if name not in HISTORY:
        return None
    frames = [
        table(spark, sf_dir, t).where(condition.replace("timestamp '", "timestamp_ntz '")).selectExpr(
            *[f"{columns.get(c, 'null')} :: {_NULL_TYPE[kind]} as {c}" if c not in columns
              else f"{columns[c]} as {c}" for c, kind in ENTITIES[name].types.items()])
        for t, condition, columns in HISTORY[name]
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def history_sql(name: str) -> str:
    duck_type = {**_NULL_TYPE, "timestamp_ntz": "timestamp"}
    parts = []
    for t, condition, columns in HISTORY[name]:
        cols = ", ".join(
            f"{columns[c]} as {c}" if c in columns else f"cast(null as {duck_type[kind]}) as {c}"
            for c, kind in ENTITIES[name].types.items())
        parts.append(f"select 'loaded' as load_id, {cols} from {t} where {condition}")
    return " union all ".join(parts)


# ---- Subscribers' history and the person lookups.

LOOKUPS = {
    # Two ids for some keys, so that the crosswalk can repeat a key.
    "subscribers_ods": ("customer", {
        "subscriber_key": f"case when c_custkey % 97 = 0 then null else {key_of('c_custkey')} end",
        "subscriber_id": text("c_custkey")},
        "orders", {
        "subscriber_key": key_of("o_custkey"),
        "subscriber_id": "case when o_orderpriority = '1-URGENT' then concat('x', cast(o_custkey as string)) else cast(o_custkey as string) end"}),
    "contacts": ("customer", {
        "id": f"concat('C', {text('c_custkey')})",
        "account_id": f"case when c_nationkey = 7 then null else concat('ACC', {text('c_custkey % 60')}) end"}),
    "accounts": ("customer", {
        "id": f"case when c_nationkey = 5 then concat('C', {text('c_custkey')}) else concat('A', {text('c_custkey')}) end"}),
    "enrollees": ("orders", {
        "account_id": f"case when o_orderstatus = 'P' then null when o_custkey % 2 = 0 then concat('ACC', {text('o_custkey % 60')}) else concat('A', {text('o_custkey')}) end",
        "alt_account_id": f"case when o_orderpriority = '2-HIGH' then null else concat('C', {text('o_custkey')}) end",
        "source_key": f"case when o_orderpriority = '5-LOW' then ' ' else concat(' P', {text('o_orderkey % 300')}, ' ') end"}),
    "pim_open": ("part", {
        "source_key": f"concat('P', {text('p_partkey % 250')})",
        "key_label": "case when p_size > 10 then 'pim_id' else 'other' end",
        "person_id": "case when p_type = 'PROMO' then null else 100000 + p_partkey end",
        "demographic_id": "case when p_type = 'LARGE' then null else 900000 - p_partkey end"}),
    "pim_restricted": ("supplier", {
        "source_key": f"concat('P', {text('s_suppkey % 70')})",
        "key_label": "case when s_acctbal > 0 then 'pim_id' else 'other' end",
        "person_id": "case when s_nationkey = 4 then null else 500000 + s_suppkey end",
        "demographic_id": "case when s_nationkey = 9 then null else 600000 + s_suppkey end"}),
    "crm_open": ("customer", {
        "source_key": f"case when c_nationkey = 2 then concat('P', {text('c_custkey % 40')}) else concat('L', {text('c_custkey')}) end",
        "key_label": "case when c_acctbal > 3000 then 'candidate_id' else 'other' end",
        "person_id": "case when c_mktsegment = 'BUILDING' then null else 200000 + c_custkey end",
        "demographic_id": "case when c_mktsegment = 'MACHINERY' then null else 700000 - c_custkey end"}),
    "crm_restricted": ("customer", {
        "source_key": f"case when c_nationkey = 6 then concat('P', {text('c_custkey % 40')}) else concat('L', {text('c_custkey')}) end",
        "key_label": "case when c_acctbal < 5000 then 'candidate_id' else 'other' end",
        "person_id": "case when c_mktsegment = 'FURNITURE' then null else 300000 + c_custkey end",
        "demographic_id": "case when c_mktsegment = 'HOUSEHOLD' then null else 800000 - c_custkey end"}),
}


def lookup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = LOOKUPS[name]
    frames = [
        table(spark, sf_dir, spec[i]).selectExpr(*[f"{e} as {c}" for c, e in spec[i + 1].items()])
        for i in range(0, len(spec), 2)
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def lookups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = [n for n in LOOKUPS if n != "subscribers_ods"]
    return {"subscribers": lookup(spark, sf_dir, "subscribers_ods"),
            **{n: lookup(spark, sf_dir, n) for n in names}}


def lookup_sql(name: str) -> str:
    spec = LOOKUPS[name]
    return " union all ".join(
        f"select {', '.join(f'{e} as {c}' for c, e in spec[i + 1].items())} from {spec[i]}"
        for i in range(0, len(spec), 2))


def lookup_ctes() -> str:
    return ", ".join(f"{name} as ({lookup_sql(name)})" for name in LOOKUPS)
