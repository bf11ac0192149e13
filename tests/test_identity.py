import random

import duckdb
import pytest

from rosterlake.operators import identity as I
from rosterlake.operators.enrich import enrich
from rosterlake.operators.skew import hot_keys

PEOPLE = "source_key string, key_label string, person_id bigint, demographic_id bigint"
SCHEMAS = {
    "subscribers": "subscriber_key string, subscriber_id string",
    "contacts": "id string, account_id string",
    "accounts": "id string",
    "enrollees": "account_id string, alt_account_id string, source_key string",
    "pim_open": PEOPLE, "pim_restricted": PEOPLE, "crm_open": PEOPLE, "crm_restricted": PEOPLE,
}
# Every combination, straight from the rule.
NAIVE = """
with s as (select distinct subscriber_key, subscriber_id,
             case when contains(subscriber_key, '_') then split_part(subscriber_key, '_', 1) end as possible_pim from subscribers),
m as (select s.*, coalesce(c.account_id, a.id) as account_id, (c.id is null and a.id is null) as outside
      from s left join contacts c on c.id = s.subscriber_key left join accounts a on a.id = s.subscriber_key),
e as (select m.*, coalesce(nullif(trim(x.source_key), ''), m.possible_pim) as k from m left join enrollees x
      on not m.outside and coalesce(x.account_id, x.alt_account_id) = m.account_id)
select e.subscriber_key, e.subscriber_id, e.possible_pim, e.account_id,
  max(coalesce(p1.person_id, p2.person_id, c1.person_id, c2.person_id, c3.person_id, c4.person_id, -1)),
  max(coalesce(p1.demographic_id, p2.demographic_id, c1.demographic_id, c2.demographic_id, c3.demographic_id, c4.demographic_id, -1)),
  max(case when coalesce(p2.person_id, c2.person_id, c4.person_id) is null then 0 else 1 end)
from e
left join pim_open p1 on p1.source_key = e.k and p1.key_label = 'pim_id'
left join pim_restricted p2 on p2.source_key = e.k and p2.key_label = 'pim_id'
left join crm_open c1 on e.outside and c1.source_key = e.subscriber_key and c1.key_label = 'candidate_id'
left join crm_restricted c2 on e.outside and c2.source_key = e.subscriber_key and c2.key_label = 'candidate_id'
left join crm_open c3 on e.outside and c3.source_key = e.possible_pim and c3.key_label = 'candidate_id'
left join crm_restricted c4 on e.outside and c4.source_key = e.possible_pim and c4.key_label = 'candidate_id'
group by 1, 2, 3, 4"""


def frames(spark, data):
    return {n: spark.createDataFrame(data.get(n, []), s) for n, s in SCHEMAS.items()}


def naive(data):
    con = duckdb.connect()
    for n, s in SCHEMAS.items():
        con.execute(f"create table {n} ({s.replace(' string', ' varchar')})")
        if data.get(n):
            con.executemany(f"insert into {n} values ({', '.join('?' * len(s.split(',')))})", data[n])
    return sorted(con.execute(NAIVE).fetchall(), key=repr)


def crosswalk(spark, data, **kw):
    return sorted((tuple(r) for r in I.identity_crosswalk(**frames(spark, data), **kw).collect()), key=repr)


def random_data(seed):
    r = random.Random(seed)
    keys = ["a", "b", "c", "a_x", "b_y", "_z", "d_1_2", None]
    ids = [None, -7, -1, 0, 3, 8, 12]
    pick = lambda xs: r.choice(xs)

    def people():
        return [(pick(["a", "b", "c", "d", "", "a_x", "b_y", None]), pick(["pim_id", "candidate_id", "candidate_id"]), pick(ids), pick(ids))
                for _ in range(r.randrange(0, 14))]
    return {
        "subscribers": [(pick(keys), pick(["1", "2", None])) for _ in range(12)],
        "contacts": [(pick(["a", "a_x", "_z", None]), pick(["acc", "a", "b", None])) for _ in range(r.randrange(0, 5))],
        "accounts": [(pick(["a", "b_y", "c", None]),) for _ in range(r.randrange(0, 4))],
        "enrollees": [(pick(["acc", "a", None]), pick(["c", "b_y", None]), pick(["a", " b ", " ", None, "c"])) for _ in range(r.randrange(0, 7))],
        "pim_open": people(), "pim_restricted": people(), "crm_open": people(), "crm_restricted": people(),
    }


@pytest.mark.parametrize("seed", range(14))
def test_equals_all_combinations(spark, seed):
    data = random_data(seed)
    assert crosswalk(spark, data, salt=seed % 2 == 0) == naive(data)


def test_equals_all_combinations_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for seed in (101, 102):
            data = random_data(seed)
            # One prefix, one account and one key hold much of the data.
            data["subscribers"] += [(f"a_{i}", "1") for i in range(60)] + [("b", str(i)) for i in range(60)] + [(f"n{i}", None) for i in range(20)]
            data["contacts"] += [(f"n{i}", "acc") for i in range(20)]
            assert crosswalk(spark, data) == naive(data)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_prefix(spark):
    df = spark.createDataFrame([("PIM1_a@b",), ("abc",), ("_x",), ("a_b_c",), (None,)], "k string")
    assert [r[0] for r in df.select(I.key_prefix("k")).collect()] == ["PIM1", None, "", "a", None]


def test_open_id_wins_and_the_flag_stays(spark):
    data = {"subscribers": [("p_m", "1")], "pim_open": [("p", "pim_id", 5, 6)], "pim_restricted": [("p", "pim_id", 50, 60)]}
    assert crosswalk(spark, data) == [("p_m", "1", "p", None, 5, 6, 1)]


def test_a_null_id_lets_the_next_source_in(spark):
    data = {"subscribers": [("p_m", "1")], "pim_open": [("p", "pim_id", None, 6), ("p", "pim_id", 5, 6)],
            "pim_restricted": [("p", "pim_id", 9, 60)]}
    assert crosswalk(spark, data) == [("p_m", "1", "p", None, 9, 6, 1)]


def test_a_contact_keeps_candidates_out(spark):
    data = {"subscribers": [("k", "1")], "contacts": [("k", "acc")], "crm_open": [("k", "candidate_id", 5, 6)]}
    assert crosswalk(spark, data) == [("k", "1", None, "acc", -1, -1, 0)]


def test_enrichment_repeats_rows_of_shared_keys(spark, rows, monkeypatch):
    monkeypatch.setattr(I, "COPIES_PER_ROW", 4)
    walk = [("k", str(i), None, None, 1, 2, 0) for i in range(9)] + [("k", "x", None, None, 3, 4, 1), ("m", "1", None, None, 5, 6, 0),
                                                                     (None, "1", None, None, -1, -1, 0)]
    walk = spark.createDataFrame(walk, "subscriber_key string, subscriber_id string, possible_pim string, account_id string, "
                                       "person_id bigint, demographic_id bigint, is_restricted int")
    events = spark.createDataFrame([("k", 1), ("m", 2), ("gone", 3), (None, 4)], "subscriber_key string, n int")
    by_key = I.identities_by_key(walk)
    assert by_key.where("subscriber_key = 'k' and person_id = 1").count() == 3
    out = enrich(events, by_key, hot_keys(events, ["subscriber_key"]))
    assert out.columns == ["person_id", "demographic_id", "is_restricted", "subscriber_key", "n"]
    assert rows(out) == sorted([(1, 2, 0, "k", 1)] * 9 + [(3, 4, 1, "k", 1), (5, 6, 0, "m", 2), (-1, -1, 0, "gone", 3), (-1, -1, 0, None, 4)], key=repr)
    assert rows(I.shared_keys(walk)) == [("k", 10)]
