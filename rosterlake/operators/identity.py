"""Identity crosswalk: which person a subscriber key stands for.

A key may be a contact id, an account id, a candidate id, or ``<source key>_<mail>``.
Contacts and accounts lead over program enrollees to a source key; that key, or the
prefix in front of the first underscore, is looked up in the open and the restricted
person tables, and so is a candidate id.

The lookups multiply: one subscriber times its enrollees times the rows of each person
table. Only maxima over those combinations are wanted, so no combination is ever built.
Each person table is first cut down to one row per source key that says

* ``best``   the greatest id the key can yield,
* ``gap``    whether it can also yield none (no row, or a row with a null id),

and a chain of sources is evaluated from those two: a later source counts exactly when
every earlier one has a gap. All later joins meet one row per key.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.clean import blank_to_null
from rosterlake.operators.skew import hot_keys, lookup_join, unique_lookup_join

# Key labels in the person tables, and the ids and flag of an unknown person.
ENROLLEE_LABEL = "pim_id"
CANDIDATE_LABEL = "candidate_id"
UNKNOWN_ID = -1
NOT_RESTRICTED = 0

IDS = ("person_id", "demographic_id")
CROSSWALK_COLUMNS = ("subscriber_key", "subscriber_id", "possible_pim", "account_id",
                     "person_id", "demographic_id", "is_restricted")
# Copies of one identity under one key travel in rows of at most this many.
COPIES_PER_ROW = 4096


# ---------------------------------------------------------------- subscriber keys

def key_prefix(key: Column | str) -> Column:
    """Text before the first underscore; null without one; '' when it comes first."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(F.contains(key, F.lit("_")), F.substring_index(key, "_", 1))


def subscriber_keys(subscribers: DataFrame) -> DataFrame:
    """Distinct key and id over the whole history; the prefix follows from the key."""
    return (
        subscribers.select("subscriber_key", "subscriber_id").distinct()
        .withColumn("possible_pim", key_prefix("subscriber_key"))
    )


def distinct_keys(subscribers: DataFrame) -> DataFrame:
    return subscribers.select("subscriber_key").where(F.col("subscriber_key").isNotNull()).distinct()


# ---------------------------------------------------------------- CRM matches

def contact_match(keys: DataFrame, contacts: DataFrame) -> DataFrame:
    """keys plus contact_id and contact_account_id (null where no contact has the key)."""
    found = contacts.where(F.col("id").isNotNull()).select(
        F.col("id").alias("contact_id"), F.col("account_id").alias("contact_account_id")
    ).distinct()
    return keys.join(found, keys["subscriber_key"] == found["contact_id"], "left")


def account_match(keys: DataFrame, accounts: DataFrame) -> DataFrame:
    """keys plus matched_account_id. The account's own parent reference can never be
    needed, for a matched account has an id."""
    found = accounts.where(F.col("id").isNotNull()).select(
        F.col("id").alias("matched_account_id")
    ).distinct()
    return keys.join(found, keys["subscriber_key"] == found["matched_account_id"], "left")


def account_ids(keys: DataFrame, contacts: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per key and account: subscriber_key, account_id, in_crm.

    Both joins run on the key that ``distinct_keys`` already partitioned by.
    """
    rows = account_match(contact_match(keys, contacts), accounts)
    return (
        rows.groupBy(
            "subscriber_key",
            F.coalesce("contact_account_id", "matched_account_id").alias("account_id"),
        )
        .agg(F.max(F.col("contact_id").isNotNull() | F.col("matched_account_id").isNotNull()).alias("in_crm"))
    )


def enrollee_keys(enrollees: DataFrame) -> DataFrame:
    """Distinct (account_id, enrollee_key); a blank source key is null."""
    return (
        enrollees.select(
            F.coalesce("account_id", "alt_account_id").alias("account_id"),
            blank_to_null("source_key").alias("enrollee_key"),
        )
        .where(F.col("account_id").isNotNull())
        .distinct()
    )


def enrollee_match(accounts_of_keys: DataFrame, enrollees: DataFrame,
                   hot: DataFrame | None = None) -> DataFrame:
    """Per key and account: how many distinct enrollee keys the account has, and whether
    an enrollee without one exists. Enrollees collapse to one row per account first."""
    per_account = enrollee_keys(enrollees).groupBy("account_id").agg(
        F.count("enrollee_key").alias("enrollee_keys"),
        F.max(F.col("enrollee_key").isNull()).alias("keyless"),
    )
    return unique_lookup_join(accounts_of_keys, per_account, ["account_id"], "left", hot)


# ---------------------------------------------------------------- person tables

def _pair(i: str) -> list[Column]:
    """best and gap of "open, else restricted" for one id."""
    best, gap = {}, {}
    for side, mine in (("open", ~F.col("restricted")), ("restricted", F.col("restricted"))):
        best[side] = F.max(F.when(mine, F.col(i)))
        some_row = F.max(mine)
        some_null = F.max(mine & F.col(i).isNull())
        gap[side] = ~some_row | some_null
    return [
        F.greatest(best["open"], F.when(gap["open"], best["restricted"])).alias(f"best_{i}"),
        (gap["open"] & gap["restricted"]).alias(f"gap_{i}"),
    ]


def person_index(opened: DataFrame, restricted: DataFrame, label: str) -> DataFrame:
    """One row per source key over an open and a restricted person table; a single
    aggregation whose map side already folds a key's copies."""
    def tagged(people: DataFrame, flag: bool) -> DataFrame:
        return people.where((F.col("key_label") == label) & F.col("source_key").isNotNull()).select(
            F.col("source_key").alias("lookup_key"), *IDS, F.lit(flag).alias("restricted"))
    hit = F.col("restricted") & F.col("person_id").isNotNull()
    return tagged(opened, False).unionByName(tagged(restricted, True)).groupBy("lookup_key").agg(
        *[c for i in IDS for c in _pair(i)], F.max(hit).alias("restricted"))


def _of(index: DataFrame, key: str, tag: str) -> DataFrame:
    """The index under the names of one lookup. All its columns are kept wherever it is
    used, so that its aggregation is planned alike each time and runs once."""
    return index.select(F.col("lookup_key").alias(key),
                        *[F.col(c).alias(f"{tag}_{c}") for c in index.columns if c != "lookup_key"])


def _best(tag: str, i: str) -> Column:
    return F.col(f"{tag}_best_{i}")


def _gap(tag: str, i: str) -> Column:
    """A key without a row in the index has nothing to offer."""
    return F.coalesce(F.col(f"{tag}_gap_{i}"), F.lit(True))


def _restricted(tag: str) -> Column:
    return F.coalesce(F.col(f"{tag}_restricted"), F.lit(False))


def _chain(steps: list[tuple[Column, Column]]) -> Column:
    """Greatest value of "first non-null of the steps, else unknown" over all combinations."""
    terms, open_so_far = [], None
    for best, gap in steps:
        terms.append(best if open_so_far is None else F.when(open_so_far, best))
        open_so_far = gap if open_so_far is None else open_so_far & gap
    return F.greatest(*terms, F.when(open_so_far, F.lit(UNKNOWN_ID).cast("bigint")))


# ---------------------------------------------------------------- resolution

def account_people(enrollees: DataFrame, pim: DataFrame, salt: bool = True) -> DataFrame:
    """One row per account: what its enrollees' source keys yield."""
    pairs = enrollee_keys(enrollees)
    # A hot key shows in the raw table, so the sketch needs no second distinct.
    raw = enrollees.select(blank_to_null("source_key").alias("enrollee_key"))
    hot = hot_keys(raw, ["enrollee_key"]) if salt else None
    found = unique_lookup_join(pairs, _of(pim, "enrollee_key", "e"), ["enrollee_key"], "left", hot)
    keyed = F.col("enrollee_key").isNotNull()
    return found.groupBy("account_id").agg(
        *[F.max(F.when(keyed, _best("e", i))).alias(f"a_best_{i}") for i in IDS],
        *[F.max(keyed & _gap("e", i)).alias(f"a_gap_{i}") for i in IDS],
        F.max(keyed & _restricted("e")).alias("a_restricted"),
        F.max(~keyed).alias("a_keyless"),
    )


def resolve_keys(subscribers: DataFrame, contacts: DataFrame, accounts: DataFrame,
                 enrollees: DataFrame, pim: DataFrame, crm: DataFrame, salt: bool = True) -> DataFrame:
    """One row per subscriber key and account with the resolved person. Null keys are
    left out: they match nothing. ``pim`` and ``crm`` come from ``person_index``."""
    keys = account_ids(distinct_keys(subscribers), contacts, accounts).withColumn(
        "possible_pim", key_prefix("subscriber_key"))

    # On the key itself: keys are distinct, so nothing can be hot here.
    candidates = _of(crm, "s_key", "s")
    keys = keys.join(candidates, keys["subscriber_key"] == candidates["s_key"], "left").drop("s_key")

    # On the prefix: many keys may share one. The two indexes lie partitioned by their
    # key, so putting them side by side shuffles nothing.
    prefixes = subscribers.select(key_prefix("subscriber_key").alias("possible_pim"))
    both = _of(pim, "possible_pim", "p").join(_of(crm, "possible_pim", "q"), "possible_pim", "full")
    keys = unique_lookup_join(keys, both, ["possible_pim"], "left",
                       hot_keys(prefixes, ["possible_pim"]) if salt else None)

    # On the account: many contacts may share one.
    people = account_people(enrollees, pim, salt).withColumn("a_found", F.lit(True))
    keys = unique_lookup_join(keys, people, ["account_id"], "left",
                       hot_keys(contacts, ["account_id"]) if salt else None)

    in_crm = F.col("in_crm")
    # The prefix stands in for an enrollee key: without any enrollee, or beside one that has none.
    by_prefix = F.col("a_found").isNull() | F.col("a_keyless")

    def crm_id(i: str) -> Column:
        yields_nothing = F.coalesce(F.col(f"a_gap_{i}"), F.lit(False)) | (by_prefix & _gap("p", i))
        return F.greatest(_best("a", i), F.when(by_prefix, _best("p", i)),
                          F.when(yields_nothing, F.lit(UNKNOWN_ID).cast("bigint")))

    def other_id(i: str) -> Column:
        return _chain([(_best(t, i), _gap(t, i)) for t in ("p", "s", "q")])

    restricted = F.when(in_crm, _restricted("a") | (by_prefix & _restricted("p"))).otherwise(
        reduce(or_, [_restricted(t) for t in ("p", "s", "q")]))
    return keys.select(
        "subscriber_key", "account_id",
        *[F.when(in_crm, crm_id(i)).otherwise(other_id(i)).alias(i) for i in IDS],
        F.when(restricted, F.lit(1)).otherwise(F.lit(NOT_RESTRICTED)).alias("is_restricted"),
    )


def identity_crosswalk(subscribers: DataFrame, contacts: DataFrame, accounts: DataFrame,
                       enrollees: DataFrame, pim_open: DataFrame, pim_restricted: DataFrame,
                       crm_open: DataFrame, crm_restricted: DataFrame,
                       salt: bool = True) -> DataFrame:
    """One row per (subscriber_key, subscriber_id, possible_pim, account_id).

    The person is resolved once per key and then handed to each of the key's ids.
    """
    resolved = resolve_keys(subscribers, contacts, accounts, enrollees,
                            person_index(pim_open, pim_restricted, ENROLLEE_LABEL),
                            person_index(crm_open, crm_restricted, CANDIDATE_LABEL), salt)
    pairs = subscriber_keys(subscribers)
    hot = hot_keys(subscribers, ["subscriber_key"]) if salt else None
    rows = lookup_join(pairs, resolved, ["subscriber_key"], "left", hot)
    return rows.select(
        "subscriber_key", "subscriber_id", "possible_pim", "account_id",
        *[F.coalesce(i, F.lit(UNKNOWN_ID).cast("bigint")).alias(i) for i in IDS],
        F.coalesce("is_restricted", F.lit(NOT_RESTRICTED)).alias("is_restricted"),
    )


def identities_by_key(crosswalk: DataFrame) -> DataFrame:
    """The crosswalk as a lookup: one row per key and identity, with how often it occurs.

    Enrichment repeats an event once per crosswalk row of its key. A key with very many
    ids would put as many rows into one join group; counted, they are a handful.
    """
    counted = (
        crosswalk.where(F.col("subscriber_key").isNotNull())
        .groupBy("subscriber_key", *IDS, "is_restricted")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    one, step = F.lit(1).cast("bigint"), F.lit(COPIES_PER_ROW).cast("bigint")
    return (
        counted.withColumn("_row", F.explode(F.sequence(one, F.ceil(F.col("n") / step))))
        .select("subscriber_key", *IDS, "is_restricted",
                F.least(step, F.col("n") - step * (F.col("_row") - one)).alias("copies"))
    )


def shared_keys(crosswalk: DataFrame) -> DataFrame:
    """Keys with more than one crosswalk row: enrichment repeats their events."""
    return (
        crosswalk.where(F.col("subscriber_key").isNotNull())
        .groupBy("subscriber_key").agg(F.count(F.lit(1)).alias("crosswalk_rows"))
        .where(F.col("crosswalk_rows") > 1)
    )
