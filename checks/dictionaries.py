"""Column dictionaries. Every part is a file whose header line is made from its attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from rosterlake.session import scratch_dir
from rosterlake.sources import dictionary as D

FILE = "concat('Part_', cast(p_partkey as string), '.csv')"
TABLE = "concat('part_', cast(p_partkey as string))"
FIRST, SECOND, THIRD = "concat('ID ', p_brand)", "concat(p_name, '|Name')", "concat('sys', p_type, 'Size')"
# The second field holds the separator and is quoted.
HEADER = f"concat({FIRST}, '|\"', {SECOND}, '\"|', {THIRD})"


def _name(x: str) -> str:
    t = f"regexp_replace(translate(trim({x}), '/ -', '___'), '(.)([A-Z][a-z]+)', '\\1_\\2', 'g')"
    u = f"replace(lower(regexp_replace({t}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '__', '_')"
    return f"regexp_replace({u}, '(^[^a-zA-Z])|(\\W)', '_', 'g')"


HEADERS = f"""
select {TABLE} as table_name, {FILE} as src_file_name, col as src_col_name, {_name('col')} as tgt_col_name,
       'STRING' as tgt_col_type, 'NULLABLE' as tgt_col_mode, cast(ord as bigint) as tgt_col_ord
from (select *, {FIRST} as col, 1 as ord from part union all select *, {SECOND}, 2 from part
      union all select *, {THIRD}, 3 from part)"""


def dictionary(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(f"{TABLE} as table_name", f"{FILE} as file_name", f"{HEADER} as header")
    return D.dictionary_from_headers(rows)


check("dictionary_from_header", HEADERS)(dictionary)

# Dictionary rows name the part's table, its file, both or neither.
EXTERNAL = ("case when p_size > 25 then {t} else 'other' end", "case when p_size % 2 = 0 then {f} else 'other.csv' end")


@check("dictionary_external", f"""
with files as (select {TABLE} as table_name, {FILE} as file_name from part),
d as (select {EXTERNAL[0].format(t=TABLE)} as t, {EXTERNAL[1].format(f=FILE)} as f, {FIRST} as column_name,
             case when p_size > 10 then 'INT64' else 'STRING' end as data_type, 'NULLABLE' as nullable,
             cast(p_size as bigint) as ord from part)
select table_name, file_name as src_file_name, column_name as src_col_name, {_name('column_name')} as tgt_col_name,
       data_type as tgt_col_type, nullable as tgt_col_mode, ord as tgt_col_ord
from files join d on d.t = files.table_name or d.f = files.file_name""")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    files = part.selectExpr(f"{TABLE} as table_name", f"{FILE} as file_name")
    external = part.selectExpr(
        f"{EXTERNAL[0].format(t=TABLE)} as table_name", f"{EXTERNAL[1].format(f=FILE)} as file_name",
        f"{FIRST} as column_name", "case when p_size > 10 then 'INT64' else 'STRING' end as data_type",
        "'NULLABLE' as nullable", "cast(p_size as bigint) as ordinal_position")
    # A file in another column order: its headings count.
    root = scratch_dir(spark, "dictionary")
    external.select(*sorted(external.columns)).write.option("header", True).csv(root)
    return D.dictionary_from_external(files, D.read_external(spark, root))


@check("schema_existing", f"""
select tgt_col_ord as ordinal_position, table_name, tgt_col_name as column_name from ({HEADERS})
where tgt_col_name not like 'sys%'""")
def _(spark, sf_dir):
    return D.unmanaged_columns(D.as_columns(dictionary(spark, sf_dir)), "sys")


# The table as it stands: large parts lost their third column, small ones have another first.
STANDING = f"""
select tgt_col_ord as ordinal_position, table_name,
       case when tgt_col_ord = 1 and p_size < 10 then 'id' else tgt_col_name end as column_name
from ({HEADERS}) join part on table_name = {TABLE} where not (tgt_col_ord = 3 and p_size > 40)"""


@check("schema_diff", f"""
with new as (select tgt_col_ord as ordinal_position, table_name, tgt_col_name as column_name from ({HEADERS})),
old as ({STANDING})
select *, 'new' as side from (select * from new except select * from old)
union all select *, 'existing' from (select * from old except select * from new)""")
def _(spark, sf_dir):
    new = D.as_columns(dictionary(spark, sf_dir))
    part = table(spark, sf_dir, "part").selectExpr(f"{TABLE} as table_name", "p_size")
    old = (new.join(part, "table_name").where("not (ordinal_position = 3 and p_size > 40)")
           .withColumn("column_name", F.expr("case when ordinal_position = 1 and p_size < 10 then 'id' else column_name end")))
    return D.column_differences(new, old)


@check("schema_to_json", f"""
select table_name, '[' || string_agg('{{"description":"' || src_file_name || '~' || src_col_name || '","name":"' || tgt_col_name
       || '","type":"' || tgt_col_type || '","mode":"' || tgt_col_mode || '"}}', ',' order by tgt_col_ord) || ']' as schema_json
from ({HEADERS}) group by table_name""")
def _(spark, sf_dir):
    return D.schema_json(dictionary(spark, sf_dir))
