"""Files written from the bundled tables and read back, against the tables themselves."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from checks.feeds import base_of, raw_feeds, raw_sql
from checks.registry import check, table
from checks.typed_tables import clean_sql
from rosterlake.functions.clean import blank_to_null
from rosterlake.plans.catalog import ALL_FEEDS, ENTITIES
from rosterlake.session import scratch_dir
from rosterlake.sources import archive as A
from rosterlake.sources import delimited as D
from rosterlake.sources import zip_source as Z
from rosterlake.sources.feeds import feed_counts, landed_files, read_landed
from rosterlake.sources.quoted_lines import read_files

TURNS = ["conv_id", "turn", "role", "text"]
# Turns per archive: an archive is one task's work, so the number of archives grows instead.
TURNS_PER_ARCHIVE = 2_000


def _quoted(c: str):
    return F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))


def zipped_turns(spark, sf_dir):
    """A folder with the conversation turns as zip archives of bounded size, written by the tasks
    that read them; a repeated task writes the same files again."""
    root = scratch_dir(spark, "zipped_turns")
    opened = Z.opened

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, len(batch), TURNS_PER_ARCHIVE):
                part = batch.iloc[start:start + TURNS_PER_ARCHIVE]
                system, folder = opened(f"{root}/{task}-{n // 10_000}")
                system.create_dir(folder, recursive=True)
                with system.open_output_stream(f"{folder}/drop_level2_2024{n % 10_000:04d}.zip") as out, \
                        zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("readme.txt", "not taken")
                    z.writestr("Turns.csv", "\n".join(["conv_id|turn|role|text", *part["line"]]) + "\n")
                n += 1
        yield pd.DataFrame({"archives": [n]})
    lines = table(spark, sf_dir, "conversations").select(
        F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", _quoted("text")).alias("line"))
    lines.mapInPandas(pack, "archives bigint").write.mode("overwrite").format("noop").save()
    return root


@check("ingest_zip_members", "select 'level2' as feed, 'turns' as file_stem, conv_id, turn, role, text from conversations")
def _(spark, sf_dir):
    records = A.with_feed(Z.read_zip_records(spark, zipped_turns(spark, sf_dir))).where("record_no > 0")
    rows = D.parse_records(records, "record", TURNS)
    return D.accepted_rows(rows).select("feed", "file_stem", F.col("conv_id").cast("bigint"),
                                        F.col("turn").cast("bigint"), "role", "text")


def _written(spark, sf_dir, name: str, label: str) -> dict[str, str]:
    """Raw feeds of an entity as pipe-delimited files below one folder per feed."""
    root = scratch_dir(spark, label)
    entity = ENTITIES[name]
    for feed, rows in zip(entity.feeds, raw_feeds(spark, sf_dir, name)):
        (rows.write.option("sep", "|").option("quote", '"').option("escape", '"').option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{root}/drop_{feed}/{name}"))
    return root


_BOUNCE = ENTITIES["bounces"].columns


@check("ingest_feed_loop", f"""
select feed, coalesce(n, 0) as landed from (values ('all_bu'), ('level2'), ('pilots')) f(feed) left join (
  select 'level2' as feed, count(*) as n from events where {base_of('bounces').feeds['level2']}
  union all select 'pilots', count(*) from events where {base_of('bounces').feeds['pilots']}) using (feed)""")
def _(spark, sf_dir):
    root = _written(spark, sf_dir, "bounces", "feeds")
    rows = read_landed(spark, landed_files(spark, root), _BOUNCE)
    return feed_counts(rows, ALL_FEEDS)


@check("csv_read_options", "select " + ", ".join(f"{clean_sql('r.' + c)} as {c}" for c in ENTITIES["clicks"].columns)
       + f" from ({raw_sql('clicks')}) r")
def _(spark, sf_dir):
    root = _written(spark, sf_dir, "clicks", "clicks")
    columns = ENTITIES["clicks"].columns
    rows = D.accepted_rows(D.read_delimited(spark, f"{root}/*/*", columns))
    return rows.select(*[blank_to_null(c).alias(c) for c in columns])


@check("csv_quoted_line_ends", """
select doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) as text, lang from documents
union all select page_id, null, url from pages""")
def _(spark, sf_dir):
    root = scratch_dir(spark, "quoted")
    documents, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    # Whole texts with their line ends in quotes, and files that hold none.
    documents.select(F.concat_ws("|", F.col("doc_id").cast("string"), _quoted("text"), "lang").alias("value")).write.text(f"{root}/quoted")
    pages.select(F.concat_ws("|", F.col("page_id").cast("string"), F.lit(""), "url").alias("value")).write.text(f"{root}/plain")
    rows = D.accepted_rows(read_files(spark, [f"{root}/quoted", f"{root}/plain"], ["doc_id", "text", "lang"], header=False))
    return rows.select(F.col("doc_id").cast("bigint"), F.regexp_replace("text", "\r\n?", "\n").alias("text"), "lang")


# Whole, surplus (also with an empty surplus field) and short rows.
LINE = ("concat(cast(o_orderkey as string), '|', case when o_orderpriority = '2-HIGH' then concat('\"', o_orderstatus, '|\"') "
        "else o_orderstatus end, case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then '' else concat('|', o_orderpriority) end, "
        "case when o_orderstatus = 'P' then '|extra|more' when o_orderstatus = 'O' and o_orderpriority = '1-URGENT' then '|' else '' end)")


@check("csv_bad_row_limit", """
select o_orderkey, case when o_orderpriority = '2-HIGH' then o_orderstatus || '|' else o_orderstatus end as status,
       case when short then null else o_orderpriority end as priority,
       case when short then 'short' when o_orderstatus = 'P' or (o_orderstatus = 'O' and o_orderpriority = '1-URGENT') then 'surplus' else 'ok' end as row_status,
       count(*) filter (where short) over () > 100 as over_limit
from (select *, o_orderpriority = '5-LOW' and o_orderstatus = 'F' as short from orders)""")
def _(spark, sf_dir):
    root = scratch_dir(spark, "lines")
    table(spark, sf_dir, "orders").selectExpr(f"{LINE} as value").write.text(root)
    columns = ["o_orderkey", "status", "priority"]
    # The part files of one folder are one file to the limit.
    rows = D.read_delimited(spark, root, columns, header=False).withColumn("_folder", F.regexp_extract("_file", "^(.*)/", 1))
    over = D.files_over_limit(rows, by="_folder").select("_folder", F.lit(True).alias("over"))
    return rows.join(over, "_folder", "left").select(
        F.col("o_orderkey").cast("bigint"), "status", "priority", F.col(D.STATUS).alias("row_status"),
        F.coalesce("over", F.lit(False)).alias("over_limit"))


@check("ingest_raw_lines", "select unnest(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))) as value from documents")
def _(spark, sf_dir):
    root = scratch_dir(spark, "raw")
    table(spark, sf_dir, "documents").select(F.col("text").alias("value")).write.text(root)
    return D.read_lines(spark, root).select("value")


@check("schema_autodetect", "select p_partkey as partkey, p_name as name, p_size as size, p_retailprice as retailprice from part")
def _(spark, sf_dir):
    root = scratch_dir(spark, "typed")
    (table(spark, sf_dir, "part").selectExpr("p_partkey + 3000000000 as partkey", "p_name as name", "p_size as size", "p_retailprice as retailprice")
     .write.option("sep", "|").option("header", True).csv(root))
    # The offset makes the key too long for an int, so that the inferred type is told.
    return D.read_inferred(spark, root).withColumn("partkey", F.col("partkey") - 3000000000)


# Each region of the business writes with another delimiter; quoted text holds the others.
SEPS = {"FURNITURE": ",", "BUILDING": "|", "MACHINERY": ";", "AUTOMOBILE": "\t", "HOUSEHOLD": ":"}


@check("file_profile_dialect", """
select c_mktsegment as segment, count(*) as lines, false as quoted_line_ends,
       case c_mktsegment when 'FURNITURE' then ',' when 'BUILDING' then '|' when 'MACHINERY' then ';' when 'AUTOMOBILE' then chr(9) else ':' end as field_delimiter,
       case when c_mktsegment = 'HOUSEHOLD' then '''' else '"' end as quote_delimiter,
       case c_mktsegment when 'FURNITURE' then ',' when 'MACHINERY' then ';' when 'AUTOMOBILE' then chr(9) when 'BUILDING' then null else ':' end as dialect_field_delimiter,
       case when c_mktsegment = 'HOUSEHOLD' then '''' end as dialect_quote_delimiter
from customer group by c_mktsegment""")
def _(spark, sf_dir):
    sep = F.coalesce(*[F.when(F.col("c_mktsegment") == s, F.lit(d)) for s, d in SEPS.items()])
    quote = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("'")).otherwise(F.lit('"'))
    lines = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.col("c_custkey").cast("string"), sep, quote, F.lit("a,b;c"), quote, sep, F.col("c_name"), sep,
                 F.col("c_nationkey").cast("string")).alias("value"))
    return D.file_profiles(lines, by="segment")
