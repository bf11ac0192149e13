import random
from dataclasses import replace

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterlake.operators import incremental as G
from rosterlake.operators.skew import hot_keys, lookup_join, unique_lookup_join
from rosterlake.plans.catalog import ENTITIES
from rosterlake.plans.typed_load import build_rows

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SMALL = st.lists(st.tuples(*[st.sampled_from([None, "a", "b"])] * 3), min_size=1, max_size=8)


def frame(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, k string, x string, y string")


def unlike(a, b):
    return a is not None and b is not None and a != b


@RELAXED
@given(SMALL, SMALL)
def test_rules_equal_brute_force(spark, new, old):
    n, o = frame(spark, new), frame(spark, old)
    key, values = [F.col("k")], [F.col("x"), F.col("y")]

    def versions(r):
        return [s for s in old if s[0] == r[0] and r[0] is not None]

    def ids(df):
        return sorted(r["i"] for r in df.collect())

    def latest(r):
        return max((s for s in enumerate(old) if s[1] in versions(r)), default=(0, None))[1]

    newest = [i for i, r in enumerate(new) if latest(r) is None or unlike(r[1], latest(r)[1]) or unlike(r[2], latest(r)[2])]
    fresh = [i for i, r in enumerate(new) if not versions(r)]
    seen = [i for i, r in enumerate(new) if any(unlike(r[1], s[1]) or unlike(r[2], s[2]) for s in versions(r))]
    safe = [i for i, r in enumerate(new) if any(r[1:] != s[1:] for s in versions(r))]
    assert ids(G.new_rows(n, o, key, key)) == fresh
    assert ids(G.new_or_changed(n, o, key, key, values, values, latest=[F.col("i")])) == newest
    assert ids(G.changed_rows(n, o, key, key, values, values)) == seen
    assert ids(G.changed_rows(n, o, key, key, values, values, null_safe=True)) == safe
    assert ids(G.new_or_changed(n, o, key, key, values, values)) == sorted(fresh + seen)
    assert ids(G.new_or_changed(n, o, key, key, values, values, salt=False)) == sorted(fresh + seen)


def test_hot_and_null_keys_are_spread_and_nothing_is_lost(spark):
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = random.Random(5)
        keys = ["hot"] * 400 + [None] * 400 + [f"k{r.randrange(300)}" for _ in range(400)]
        left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
        right = spark.createDataFrame([("hot", 1), (None, 9)] + [(f"k{i}", i) for i in range(150)], "k string, v int")
        hot = hot_keys(left, ["k"])
        assert hot.count() == 1
        truth = {"hot": 1, **{f"k{i}": i for i in range(150)}}
        joined = {x["i"]: x["v"] for x in lookup_join(left, right, ["k"], "left", hot).collect()}
        assert joined == {i: truth.get(k) for i, k in enumerate(keys)}
        unhit = {k: v for k, v in truth.items() if k != "hot"}
        for join in (lookup_join, unique_lookup_join):
            for how, keep in (("left", lambda k, t: True), ("left_anti", lambda k, t: k not in t),
                              ("left_semi", lambda k, t: k in t), ("inner", lambda k, t: k in t)):
                if how == "left_semi" and join is unique_lookup_join:
                    continue
                for h in (hot, None):
                    # Also when the hot key is not in the lookup.
                    for table, known in ((right, truth), (right.where("k <> 'hot'"), unhit)):
                        out = join(left, table, ["k"], how, h)
                        assert out.columns == (["i", "k", "v"] if how in ("left", "inner") else ["i", "k"])
                        got = sorted((x["i"], x["v"] if "v" in out.columns else None) for x in out.collect())
                        assert got == [(i, known.get(k) if "v" in out.columns else None)
                                       for i, k in enumerate(keys) if keep(k, known)], (join, how)
        # The hot key and the null key both reach more than one partition.
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for join in (lookup_join, unique_lookup_join):
            parts = join(left, right, ["k"], "left", hot).withColumn("p", F.spark_partition_id())
            spread = {x["k"]: x["n"] for x in parts.groupBy("k").agg(F.countDistinct("p").alias("n")).collect()}
            assert spread["hot"] > 1 and spread[None] > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_feeds_unite_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, None)], "n int, t string")
    b = spark.createDataFrame([("x", 1), (None, 2)], "t string, n int")
    assert rows(G.union_feeds([a, b])) == [(1, "x"), (1, "x"), (2, None), (2, None)]
    assert rows(G.union_feeds([a, b], distinct=True)) == [(1, "x"), (2, None)]


def raw(spark, entity, *given):
    columns = ENTITIES[entity].columns
    return spark.createDataFrame([tuple(g.get(c) for c in columns) for g in given],
                                 ", ".join(f"{c} string" for c in columns))


def stored(spark, entity, df):
    return G.with_audit(df) if df is not None else spark.createDataFrame([], ENTITIES[entity].schema())


def test_new_only_tables(spark):
    """Padded keys never match what is stored trimmed, and null keys match nothing."""
    entity = ENTITIES["subscribers"]
    given = [{"client_id": "1", "subscriber_key": k, "subscriber_id": "s"} for k in ("k1", " k2", None)]
    first = build_rows(entity, [raw(spark, "subscribers", *given)], stored(spark, "subscribers", None))
    assert first.count() == 3
    again = build_rows(entity, [raw(spark, "subscribers", *given)], stored(spark, "subscribers", first))
    assert sorted(str(r["subscriber_key"]) for r in again.collect()) == ["None", "k2"]
    # A known key with another status is no new row.
    changed = [{**given[0], "status": "held"}]
    assert build_rows(entity, [raw(spark, "subscribers", *changed)], stored(spark, "subscribers", first)).count() == 0
    trimmed = ENTITIES["lists"]
    lists = [{"client_id": "1", "list_id": "7"}]
    loaded = build_rows(trimmed, [raw(spark, "lists", *lists)] * 3, stored(spark, "lists", None))
    assert loaded.count() == 1
    assert build_rows(trimmed, [raw(spark, "lists", *lists)], stored(spark, "lists", loaded)).count() == 0


def test_membership_changes(spark):
    entity = ENTITIES["list_membership"]
    base = {"client_id": "1", "subscriber_key": "k", "subscriber_id": "s", "list_id": "3",
            "join_type": "a", "date_joined": "1/2/2021 3:04:05 PM"}

    def load(history, *given):
        return build_rows(entity, [raw(spark, "list_membership", *given)], stored(spark, "list_membership", history))

    v1 = load(None, base)
    assert load(v1, base).count() == 0
    # From null to a value goes unseen; another join type is seen.
    assert load(v1, {**base, "date_unsubscribed": "1/3/2021 3:04:05 PM"}).count() == 0
    v2 = load(v1, {**base, "join_type": " b "})
    assert [r["join_type"] for r in v2.collect()] == ["b"]
    # With two versions stored, even the latest one differs from the other.
    both = v1.unionByName(v2)
    assert load(both, {**base, "join_type": "b"}).count() == 1
    # Against the latest alone it is in already; the first version is a change again.
    day = lambda n: F.lit(f"2021-01-0{n}").cast("timestamp")
    versions = G.with_audit(v1, day(1)).unionByName(G.with_audit(v2, day(2)))
    only = replace(entity, latest_only=True)
    for join_type, n in (("b", 0), ("a", 1), ("c", 1)):
        assert build_rows(only, [raw(spark, "list_membership", {**base, "join_type": join_type})], versions).count() == n


def test_event_tables_append_and_drop_copies_within_a_batch(spark):
    entity = ENTITIES["bounces"]
    rows = raw(spark, "bounces", {"client_id": "1", "event_type": " x"}, {"client_id": "1", "event_type": "x "})
    assert build_rows(entity, [rows, rows]).count() == 1


def test_audit_columns(spark):
    df = G.with_audit(spark.range(500))
    assert df.columns == ["load_id", "id", "load_ts"]
    r = df.agg(F.countDistinct("load_id"), F.countDistinct("load_ts")).head()
    assert tuple(r) == (500, 1)


def test_catalog_is_complete():
    kinds = [k for e in ENTITIES.values() for k in e.types.values()]
    assert len(ENTITIES) == 19 and len(kinds) == 223
    assert {k: kinds.count(k) for k in set(kinds)} == {"string": 137, "bigint": 60, "timestamp_ntz": 22, "boolean": 4}
    rules = [e.rule for e in ENTITIES.values()]
    assert (rules.count("append"), rules.count("new_only"), rules.count("new_or_changed")) == (13, 5, 1)
    assert sum(e.enriched for e in ENTITIES.values()) == 15
    assert sum(len(e.feeds) for e in ENTITIES.values()) == 43
