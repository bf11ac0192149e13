"""Feed unions and incremental rules on the plain bundled tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from rosterlake.functions.clean import blank_to_null, to_bigint
from rosterlake.operators import incremental as G
from rosterlake.operators.skew import lookup_join

# Three feeds of orders with different column order; together they hold every row, some more than once.
FEEDS = (("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
         ("o_orderpriority", "o_orderkey", "o_orderstatus", "o_custkey"),
         ("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority"))
WHERE = ("o_orderstatus <> 'F'", "o_orderstatus <> 'O'", "o_orderpriority = '5-LOW'")
UNION = " union all ".join(f"select {', '.join(FEEDS[0])} from orders where {w}" for w in WHERE)


def _feeds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return [orders.where(w).select(*c) for w, c in zip(WHERE, FEEDS)]


@check("union_all_feeds", UNION)
def _(spark, sf_dir):
    return G.union_feeds(_feeds(spark, sf_dir))


# Customer and segment of part of the columns: nulls compare equal.
_SET = "select c_nationkey, case when c_acctbal < 0 then null else c_mktsegment end as segment from customer where {}"


@check("union_distinct_feeds", f"{_SET.format('c_acctbal < 5000')} union {_SET.format('c_acctbal > 1000')}")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_nationkey", "c_acctbal", F.expr("case when c_acctbal < 0 then null else c_mktsegment end as segment"))
    return G.union_feeds([rows.where(w).drop("c_acctbal") for w in ("c_acctbal < 5000", "c_acctbal > 1000")], distinct=True)


# Orders to load; loaded are those with a returned line. Some keys are null.
_KEY = "case when o_orderpriority = '5-LOW' then null else o_orderkey end"


@check("anti_join_new_rows", f"""
select o.* from (select *, {_KEY} as k from orders) o
left join (select distinct l_orderkey from lineitem where l_returnflag = 'R') l on l.l_orderkey = o.k
where l.l_orderkey is null""")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("k", F.expr(_KEY))
    loaded = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return G.new_rows(orders, loaded, [F.col("k")], [F.col("l_orderkey")])


# Line items against the versions loaded per order and line: another flag, date or a null.
STORED_COLUMNS = ("l_orderkey as k", "l_linenumber as n", "l_returnflag as flag",
                  "case when l_linestatus = 'F' then l_shipdate end as shipped")
FRESH_COLUMNS = ("l_orderkey as k", "l_linenumber as n", "l_partkey as p",
                 "case when l_quantity > 25 then 'A' else l_returnflag end as flag",
                 "case when l_returnflag <> 'N' then l_shipdate end as shipped")
STORED = f"select {', '.join(STORED_COLUMNS)} from lineitem where l_quantity < 40"
STORED_LINES = f"select {', '.join(STORED_COLUMNS)}, l_shipdate as newest from lineitem where l_quantity < 20"
FRESH = f"select {', '.join(FRESH_COLUMNS)} from lineitem"
SAME_KEY = "s.k = f.k and s.n = f.n"
STRICT = "(s.flag <> f.flag or s.shipped <> f.shipped)"
SAFE = "(s.flag is distinct from f.flag or s.shipped is distinct from f.shipped)"


def _versions(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.selectExpr(*FRESH_COLUMNS), lineitem.where("l_quantity < 40").selectExpr(*STORED_COLUMNS)


def _arguments(spark, sf_dir):
    fresh, stored = _versions(spark, sf_dir)
    return (fresh, stored, [F.col("k"), F.col("n")], [F.col("k"), F.col("n")],
            [F.col("flag"), F.col("shipped")], [F.col("flag"), F.col("shipped")])


@check("changed_rows", f"select * from ({FRESH}) f where exists (select 1 from ({STORED}) s where {SAME_KEY} and {STRICT})")
def _(spark, sf_dir):
    return G.changed_rows(*_arguments(spark, sf_dir))


@check("changed_rows_null_safe", f"select * from ({FRESH}) f where exists (select 1 from ({STORED}) s where {SAME_KEY} and {SAFE})")
def _(spark, sf_dir):
    return G.changed_rows(*_arguments(spark, sf_dir), null_safe=True)


@check("insert_new_or_changed", f"""
select distinct f.*, true as has_id, true as has_ts from ({FRESH}) f left join ({STORED}) s on {SAME_KEY}
where s.k is null or {STRICT}""")
def _(spark, sf_dir):
    rows = G.with_audit(G.new_or_changed(*_arguments(spark, sf_dir)).distinct())
    return rows.select("k", "n", "p", "flag", "shipped", (F.length("load_id") == 36).alias("has_id"),
                       F.col("load_ts").isNotNull().alias("has_ts"))


# Lines of an order as its versions: incoming rows against the one shipped last.
_NEWEST = f"select * from ({STORED_LINES}) qualify row_number() over (partition by k order by newest desc, n desc) = 1"


@check("insert_latest_changed", f"""
select f.* from ({FRESH}) f left join ({_NEWEST}) s on s.k = f.k where s.k is null or {STRICT}""")
def _(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    fresh, stored = lineitem.selectExpr(*FRESH_COLUMNS), lineitem.where("l_quantity < 20").selectExpr(*STORED_COLUMNS, "l_shipdate as newest")
    values = [F.col("flag"), F.col("shipped")]
    return G.new_or_changed(fresh, stored, [F.col("k")], [F.col("k")], values, values, latest=[F.col("newest"), F.col("n")])


@check("join_on_expression_keys", """
select o_orderkey, c_name from (select o_orderkey, case when o_orderkey % 5 = 0 then '  ' || cast(o_custkey as varchar) || ' '
  when o_orderpriority = '5-LOW' then ' ' else cast(o_custkey as varchar) end as t from orders) o
left join customer on c_custkey = cast(nullif(trim(t), '') as bigint)""")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 5 = 0 then concat('  ', cast(o_custkey as string), ' ') "
        "when o_orderpriority = '5-LOW' then ' ' else cast(o_custkey as string) end as t")
    keyed = orders.select("o_orderkey", to_bigint(blank_to_null("t")).alias("c_custkey"))
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return lookup_join(keyed, names, ["c_custkey"], "left").drop("c_custkey")
