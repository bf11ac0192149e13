"""The nineteen staged tables: typed rows with the resolved person in front, or as they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.feeds import lookups, raw_feeds
from checks.identity import CROSSWALK, crosswalk
from checks.registry import check
from checks.typed_tables import SHORT, rows_sql, typed_table
from rosterlake.functions.clean import blank_to_null
from rosterlake.operators.changes import changed_keys
from rosterlake.operators.enrich import enrich
from rosterlake.operators.identity import identities_by_key, identity_crosswalk
from rosterlake.operators.incremental import union_feeds
from rosterlake.operators.skew import hot_keys
from rosterlake.plans.catalog import ENTITIES
from rosterlake.plans.staged_load import PIECES, load_pieces, staged_rows
from rosterlake.session import scratch_dir
from rosterlake.sinks import tables


def staged_sql(name: str) -> str:
    if not ENTITIES[name].enriched:
        return rows_sql(name)
    return CROSSWALK + f"""
select coalesce(x.person_id, -1) as person_id, coalesce(x.demographic_id, -1) as demographic_id,
       coalesce(x.is_restricted, 0) as is_restricted, src.*
from ({rows_sql(name)}) src left join crosswalk x on x.subscriber_key = src.subscriber_key"""


def staged_table(spark, sf_dir, name):
    rows = typed_table(spark, sf_dir, name)
    if not ENTITIES[name].enriched:
        return rows
    # Hot keys show in the landed text already; one narrow scan finds them.
    landed = union_feeds(raw_feeds(spark, sf_dir, name)).select(blank_to_null("subscriber_key").alias("subscriber_key"))
    return enrich(rows, identities_by_key(crosswalk(spark, sf_dir)), hot_keys(landed, ["subscriber_key"]))


for _name in ENTITIES:
    check(f"stg_{SHORT.get(_name, _name)}", staged_sql(_name))(
        lambda spark, sf_dir, name=_name: staged_table(spark, sf_dir, name))


@check("stg_clicks_incremental", staged_sql("clicks"))
def _(spark, sf_dir):
    """The clicks loaded on two days: of the first all but purchases, under the lookups without
    the restricted persons and with other contacts. The second day's pieces make up for both."""
    root = scratch_dir(spark, "stg_clicks_incremental")
    clicks = typed_table(spark, sf_dir, "clicks")
    tables.overwrite(clicks.withColumn("load_run", F.when(F.col("event_type") == "purchase", "2").otherwise("1")),
                     f"{root}/typed", "load_run")
    typed = spark.read.schema(f"{', '.join(f'{c} {t}' for c, t in clicks.dtypes)}, load_run string").parquet(f"{root}/typed")
    now = lookups(spark, sf_dir)
    then = {**now, "pim_restricted": now["pim_restricted"].where("false"),
            "contacts": now["contacts"].withColumn("account_id", F.concat("account_id", F.lit("x")))}
    for day, people in (("1", then), ("2", now)):
        tables.overwrite(identities_by_key(identity_crosswalk(**people)), f"{root}/by_key/{day}")
    before, after = (spark.read.parquet(f"{root}/by_key/{day}") for day in "12")

    def load(day, runs, last, identities, changed):
        load_pieces(typed.where(F.col("load_run").isin(*runs)), last, runs, day, f"{root}/staged", f"{root}/pieces/{day}",
                    identities, changed)

    none = spark.createDataFrame([], PIECES)
    load("1", {"1": "1"}, none, before, changed_keys(before.where("false"), before))
    load("2", {"1": "1", "2": "2"}, spark.read.schema(PIECES).parquet(f"{root}/pieces/1"), after, changed_keys(before, after))
    return staged_rows(spark, ["person_id", "demographic_id", "is_restricted", *clicks.columns], f"{root}/staged", f"{root}/pieces/2")
