"""Crosswalk steps and the whole crosswalk, against one list of candidates in plain SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.feeds import lookup, lookup_ctes, lookups
from checks.registry import check
from rosterlake.operators import identity as I

_PREFIX = "case when contains(subscriber_key, '_') then split_part(subscriber_key, '_', 1) end"

# What the lookups know, as lists: ids of the CRM, program keys by account, and one list of
# people in which ``turn`` says how late a source is asked.
LISTS = f"""
with {lookup_ctes()},
subs as (select distinct subscriber_key, subscriber_id, {_PREFIX} as prefix from subscribers_ods),
crm as (
  select id as crm_key, coalesce(account_id, case when exists (from accounts a where a.id = c.id) then id end) as account_id
  from contacts c
  union
  select id, id from accounts a where not exists (from contacts c where c.id = a.id)),
programs as (
  select coalesce(account_id, alt_account_id) as account_id, nullif(trim(source_key), '') as clean_key from enrollees),
places as (
  select distinct subscriber_key, prefix, account_id, crm_key is not null as in_crm
  from subs left join crm on crm_key = subscriber_key),
reach as (
  select distinct p.*, e.account_id is not null as enrolled, clean_key, coalesce(clean_key, prefix) as lookup_key
  from places p left join programs e on in_crm and e.account_id = p.account_id),
people as (
  select 1 as turn, * from pim_open where key_label = 'pim_id' union all
  select 2, * from pim_restricted where key_label = 'pim_id' union all
  select unnest([3, 5]), * from crm_open where key_label = 'candidate_id' union all
  select unnest([4, 6]), * from crm_restricted where key_label = 'candidate_id')
"""
# Per place and turn the greatest id offered and whether none may be; a turn counts if every
# earlier one may offer none, and the last offers the unknown person to all.
CROSSWALK = LISTS + """, questions as (
  select subscriber_key, account_id, lookup_key, unnest([1, 2]) as turn, lookup_key as asked from reach union all
  select subscriber_key, account_id, lookup_key, unnest([3, 4]), subscriber_key from reach where not in_crm union all
  select subscriber_key, account_id, lookup_key, unnest([5, 6]), prefix from reach where not in_crm),
offers as (
  select subscriber_key, account_id, lookup_key, q.turn,
         max(person_id) as person, bool_or(person_id is null) as no_person,
         max(demographic_id) as demographic, bool_or(demographic_id is null) as no_demographic
  from questions q left join people p on p.turn = q.turn and p.source_key = asked group by all
  union all select distinct subscriber_key, account_id, lookup_key, 7, -1, true, -1, true from reach),
counted as (
  select *, coalesce(bool_and(no_person) over earlier, true) as person_counts,
         coalesce(bool_and(no_demographic) over earlier, true) as demographic_counts
  from offers window earlier as (partition by subscriber_key, account_id, lookup_key order by turn
                                 rows between unbounded preceding and 1 preceding)),
resolved as (
  select subscriber_key, account_id, max(person) filter (person_counts) as person,
         max(demographic) filter (demographic_counts) as demographic,
         bool_or(turn in (2, 4, 6) and person is not null) as restricted
  from counted group by all),
crosswalk as (
  select s.subscriber_key, subscriber_id, prefix as possible_pim, account_id, cast(person as bigint) as person_id,
         cast(demographic as bigint) as demographic_id, cast(restricted as int) as is_restricted
  from subs s join resolved r on r.subscriber_key is not distinct from s.subscriber_key)
"""


def crosswalk(spark, sf_dir):
    return I.identity_crosswalk(**lookups(spark, sf_dir))


def _keys(spark, sf_dir):
    return I.distinct_keys(lookup(spark, sf_dir, "subscribers_ods"))


def _accounts_of_keys(spark, sf_dir):
    return I.account_ids(_keys(spark, sf_dir), lookup(spark, sf_dir, "contacts"),
                         lookup(spark, sf_dir, "accounts"))


@check("xw_subscriber_keys", LISTS + "select subscriber_key, subscriber_id, prefix as possible_pim from subs")
def _(spark, sf_dir):
    return I.subscriber_keys(lookup(spark, sf_dir, "subscribers_ods"))


@check("xw_key_prefix", f"""
select event_id, lookup_key, {_PREFIX.replace('subscriber_key', 'lookup_key')} as prefix
from (select event_id, case when event_type = 'click' then '_' || props when event_type = 'view' then props
             else event_type || '_' || cast(user_id as string) || '_' || props end as lookup_key from events)""")
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "case when event_type = 'click' then '_' || props when event_type = 'view' then props "
        "else event_type || '_' || cast(user_id as string) || '_' || props end as lookup_key")
    return rows.withColumn("prefix", I.key_prefix("lookup_key"))


@check("xw_contact_match", LISTS + """
select distinct k.subscriber_key, c.id as contact_id, c.account_id as contact_account_id
from (select distinct subscriber_key from subs where subscriber_key is not null) k
left join contacts c on c.id = k.subscriber_key""")
def _(spark, sf_dir):
    return I.contact_match(_keys(spark, sf_dir), lookup(spark, sf_dir, "contacts"))


@check("xw_account_match", LISTS + """
select distinct k.subscriber_key, a.id as matched_account_id
from (select distinct subscriber_key from subs where subscriber_key is not null) k
left join accounts a on a.id = k.subscriber_key""")
def _(spark, sf_dir):
    return I.account_match(_keys(spark, sf_dir), lookup(spark, sf_dir, "accounts"))


@check("xw_account_id", LISTS + """
select subscriber_key, account_id, in_crm from places where subscriber_key is not null""")
def _(spark, sf_dir):
    return _accounts_of_keys(spark, sf_dir)


@check("xw_enrollee_match", LISTS + """
select subscriber_key, account_id, bool_or(in_crm) as in_crm,
       case when bool_or(enrolled) then count(distinct clean_key) end as enrollee_keys,
       case when bool_or(enrolled) then bool_or(clean_key is null) end as keyless
from reach where subscriber_key is not null group by subscriber_key, account_id""")
def _(spark, sf_dir):
    return I.enrollee_match(_accounts_of_keys(spark, sf_dir), lookup(spark, sf_dir, "enrollees"),
                            I.hot_keys(lookup(spark, sf_dir, "contacts"), ["account_id"]))


def _source(keys_sql: str, turn: int) -> str:
    return LISTS + f"""
select k.lookup_key, max(p.person_id) as person_id, max(p.demographic_id) as demographic_id
from ({keys_sql}) k left join people p on p.source_key = k.lookup_key and p.turn = {turn}
group by k.lookup_key"""


def _people(keys, opened, restricted, label):
    """The index the crosswalk looks persons up in, here of one table alone."""
    index = I.person_index(opened, restricted, label)
    found = I.unique_lookup_join(keys, index, ["lookup_key"], "left")
    return found.select("lookup_key", *[F.col(f"best_{i}").alias(i) for i in I.IDS])


_PIM_KEYS = "select distinct lookup_key from reach where lookup_key is not null"
_OUTSIDE = "select distinct {0} as lookup_key from reach where not in_crm and {0} is not null"


def _pim_keys(spark, sf_dir):
    """Enrollee keys of the matched accounts, and the prefixes that stand in for them."""
    rows = I.enrollee_match(_accounts_of_keys(spark, sf_dir), lookup(spark, sf_dir, "enrollees"))
    prefixes = rows.where(F.col("keyless").isNull() | F.col("keyless")).select(
        I.key_prefix("subscriber_key").alias("lookup_key"))
    reached = rows.where(F.col("enrollee_keys") > 0).select("account_id").distinct()
    keys = I.enrollee_keys(lookup(spark, sf_dir, "enrollees")).join(reached, "account_id", "left_semi")
    return (keys.select(F.col("enrollee_key").alias("lookup_key")).unionByName(prefixes)
            .where(F.col("lookup_key").isNotNull()).distinct())


def _outside(spark, sf_dir, key):
    rows = _accounts_of_keys(spark, sf_dir).where(~F.col("in_crm"))
    return (rows.select(key.alias("lookup_key")).where(F.col("lookup_key").isNotNull()).distinct())


def _one_table(spark, sf_dir, keys, people, label):
    rows = lookup(spark, sf_dir, people)
    sides = (rows, rows.where("false")) if people.endswith("_open") else (rows.where("false"), rows)
    return _people(keys, *sides, label)


for _turn, _name, _table in ((1, "xw_pim_open", "pim_open"), (2, "xw_pim_restricted", "pim_restricted")):
    check(_name, _source(_PIM_KEYS, _turn))(
        lambda spark, sf_dir, people=_table: _one_table(spark, sf_dir, _pim_keys(spark, sf_dir), people, I.ENROLLEE_LABEL))

for _turn, _name, _table, _column in (
        (3, "xw_candidate_open", "crm_open", "subscriber_key"),
        (4, "xw_candidate_restricted", "crm_restricted", "subscriber_key"),
        (5, "xw_candidate_prefix_open", "crm_open", "prefix"),
        (6, "xw_candidate_prefix_restricted", "crm_restricted", "prefix")):
    check(_name, _source(_OUTSIDE.format(_column), _turn))(
        lambda spark, sf_dir, people=_table, column=_column: _one_table(
            spark, sf_dir, _outside(spark, sf_dir, F.col(column) if column == "subscriber_key"
                                    else I.key_prefix("subscriber_key")), people, I.CANDIDATE_LABEL))


def _resolved(spark, sf_dir):
    tables = lookups(spark, sf_dir)
    return I.resolve_keys(tables["subscribers"], tables["contacts"], tables["accounts"], tables["enrollees"],
                          I.person_index(tables["pim_open"], tables["pim_restricted"], I.ENROLLEE_LABEL),
                          I.person_index(tables["crm_open"], tables["crm_restricted"], I.CANDIDATE_LABEL))


_PER_ACCOUNT = CROSSWALK + """
select subscriber_key, account_id, {} from crosswalk where subscriber_key is not null
group by subscriber_key, account_id"""


@check("xw_priority_ids", _PER_ACCOUNT.format("max(person_id) as person_id, max(demographic_id) as demographic_id"))
def _(spark, sf_dir):
    return _resolved(spark, sf_dir).drop("is_restricted")


@check("xw_restricted_flag", _PER_ACCOUNT.format("max(is_restricted) as is_restricted"))
def _(spark, sf_dir):
    return _resolved(spark, sf_dir).select("subscriber_key", "account_id", "is_restricted")


@check("xw_group", CROSSWALK + "select subscriber_key, subscriber_id, possible_pim, account_id from crosswalk")
def _(spark, sf_dir):
    keys = I.subscriber_keys(lookup(spark, sf_dir, "subscribers_ods"))
    accounts = _accounts_of_keys(spark, sf_dir).drop("in_crm")
    hot = I.hot_keys(lookup(spark, sf_dir, "subscribers_ods"), ["subscriber_key"])
    return I.lookup_join(keys, accounts, ["subscriber_key"], "left", hot)


check("identity_crosswalk", CROSSWALK + "select * from crosswalk")(crosswalk)


@check("xw_shared_keys", CROSSWALK + """
select subscriber_key, count(*) as crosswalk_rows from crosswalk where subscriber_key is not null
group by subscriber_key having count(*) > 1""")
def _(spark, sf_dir):
    return I.shared_keys(crosswalk(spark, sf_dir))
