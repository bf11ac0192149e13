"""Two days end to end on small archives."""

import os
import re
import zipfile
from datetime import timedelta

import pytest

from pyspark.sql import functions as F

from rosterlake.plans import daily_load as P
from rosterlake.plans import retention
from rosterlake.plans.catalog import ALL_FEEDS, ENTITIES
from rosterlake.sinks import tables

T1 = "01/02/2021 03:04:05 PM"


def header(entity):
    """Column names as an export spells them."""
    return "|".join("".join(w.capitalize() for w in c.split("_")) for c in entity.columns)


def line(entity, **given):
    out = []
    for c, kind in entity.types.items():
        default = {"bigint": "1", "string": f"{c} text", "timestamp_ntz": T1, "boolean": "True"}[kind]
        out.append(given.get(c, default))
    return "|".join('"' + v.replace('"', '""') + '"' for v in out)


def drop(folder, day, rows_of, feeds=ALL_FEEDS):
    folder.mkdir(exist_ok=True)
    for feed in feeds:
        with zipfile.ZipFile(folder / f"drop_{feed}_{day}.zip", "w") as z:
            for entity in ENTITIES.values():
                if feed in entity.feeds:
                    name = "".join(w.capitalize() for w in entity.name.split("_"))
                    text = "\n".join([header(entity), *rows_of(entity, feed)]) + "\n"
                    z.writestr(f"{name}.csv", text)


def test_two_days(spark, tmp_path, rows):
    spark.sql("create database if not exists daily_test")
    house = P.Warehouse(str(tmp_path / "house"), "daily_test", "daily_test_archive")
    people = "source_key string, key_label string, person_id bigint, demographic_id bigint"
    lookups = {
        "contacts": spark.createDataFrame([("k1", "acc")], "id string, account_id string"),
        "accounts": spark.createDataFrame([], "id string"),
        "enrollees": spark.createDataFrame([("acc", None, " P9 ")], "account_id string, alt_account_id string, source_key string"),
        "pim_open": spark.createDataFrame([("P9", "pim_id", 11, 12)], people),
        "pim_restricted": spark.createDataFrame([("P9", "pim_id", 99, 98)], people),
        "crm_open": spark.createDataFrame([], people),
        "crm_restricted": spark.createDataFrame([], people),
    }

    def day_one(entity, feed):
        yield line(entity, subscriber_key="k1", email_address="two\nlines", list_id="5")
        yield line(entity, subscriber_key=" k2 ", list_id="6")

    drop(tmp_path / "in", "20210102", day_one)
    P.run_day(spark, str(tmp_path / "in"), house, lookups, "20210103", "2021-01-03")
    clicks = spark.table("daily_test.clicks")
    # The same two rows came in two feeds; the quoted line end survived.
    assert rows(clicks, "person_id", "demographic_id", "is_restricted", "subscriber_key", "email_address") == [
        (-1, -1, 0, "k2", "email_address text"), (11, 12, 1, "k1", "two\nlines")]
    assert spark.table("daily_test.lists").count() == 2

    # The same run again leaves the same rows.
    P.run_day(spark, str(tmp_path / "in"), house, lookups, "20210103", "2021-01-03", snapshots=False)
    assert spark.table("daily_test.clicks").count() == 2

    def day_two(entity, feed):
        yield line(entity, subscriber_key="k1", email_address="two\nlines", list_id="5", join_type="other")

    # One feed is missing: it adds nothing, the others do.
    drop(tmp_path / "in", "20210103", day_two, feeds=("all_bu", "level2"))
    # The second key has become a contact: its rows of the first day follow.
    lookups["contacts"] = spark.createDataFrame([("k1", "acc"), ("k2", "acc")], "id string, account_id string")
    P.run_day(spark, str(tmp_path / "in"), house, lookups, "20210104", "2021-01-04")
    for name in ("clicks", "opens", "list_membership", "subscribers"):
        persons = spark.table(f"daily_test.{name}").select("person_id", "is_restricted").distinct()
        assert rows(persons) == [(11, 1)], name
    assert rows(spark.table("daily_test_archive.final_clicks_20210103"), "person_id", "subscriber_key") == [(-1, "k2"), (11, "k1")]
    assert spark.table("daily_test.clicks").count() == 3       # events append
    assert spark.table("daily_test.lists").count() == 2        # known keys do not
    assert spark.table("daily_test.list_membership").count() == 3   # a changed one does
    assert P.typed_as_of(spark, house, ENTITIES["clicks"], "20210103").count() == 2
    # The snapshot of the day before the second run shows what the first one left.
    # The crosswalk is published, and archived as it stood.
    assert spark.table("daily_test.crosswalk").count() >= spark.table("daily_test_archive.final_crosswalk_20210103").count() == 2
    for layer, n in (("final", 2), ("typed", 2), ("text", 4)):
        assert spark.table(f"daily_test_archive.{layer}_clicks_20210103").count() == n, layer

    # More bad rows in one file than a load puts up with stop it before anything is published.
    def day_bad(entity, feed):
        yield from ["1|short"] * (101 if entity.name == "opens" and feed == "level2" else 0)

    drop(tmp_path / "bad", "20210104", day_bad)
    with pytest.raises(ValueError, match="101 bad rows"):
        P.run_day(spark, str(tmp_path / "bad"), house, lookups, "20210104x", "2021-01-04", snapshots=False)
    assert spark.table("daily_test.clicks").count() == 3

    # What a run typed before it died counts for nobody; the next run takes the archives.
    died = spark.read.parquet(house.path("typed", "clicks") + "/load_run=20210104").withColumn("load_run", F.lit("20210104z"))
    tables.replace_partitions(died, house.path("typed", "clicks"), "load_run")

    # Nothing new has come: no event is added.
    P.run_day(spark, str(tmp_path / "in"), house, lookups, "20210105", "2021-01-05", snapshots=False)
    assert spark.table("daily_test.clicks").count() == 3

    # Nothing that has changed within the time of grace goes.
    assert retention.unnamed(spark, house) == []
    before = {name: rows(spark.table(f"{db}.{name}")) for db, name in published(spark)}
    gone = retention.sweep(spark, house, timedelta(0))
    assert retention.unnamed(spark, house, timedelta(0)) == []
    # The failed attempt, the one that died and the first of a repeated run are gone, whatever layer they were in.
    left = [d for d, _, _ in os.walk(house.root)]
    assert any("load_run=20210104z" in g for g in gone) and not [d for d in left if "load_run=20210104z" in d]
    assert any("version=20210104x" in g for g in gone) and not [d for d in left if "20210104x" in d and "/rejects/" not in d]
    assert len({v for d in left for v in re.findall(r"/text/clicks/version=([^/]+)", d)}) == 2
    # Every table and view reads as before, and the next day loads.
    assert {name: rows(spark.table(f"{db}.{name}")) for db, name in published(spark)} == before
    P.run_day(spark, str(tmp_path / "in"), house, lookups, "20210106", "2021-01-06", snapshots=False)
    assert spark.table("daily_test.clicks").count() == 3


def published(spark):
    return [(db, t.name) for db in ("daily_test", "daily_test_archive") for t in spark.catalog.listTables(db)
            if not t.isTemporary and t.name.split("_")[0] in ("clicks", "lists", "crosswalk", "final", "typed")
            and any(n in t.name for n in ("clicks", "crosswalk"))]


def test_misfits_are_set_apart(spark, tmp_path, rows):
    house, entity = P.Warehouse(str(tmp_path / "house")), ENTITIES["opens"]
    good = {"bigint": "1", "string": "some text", "timestamp_ntz": T1, "boolean": "True"}
    given = [{"send_id": "no number"}, {"send_id": "77"}, {"send_id": "78", "event_date": "some day"}]
    text = [("level2", *[g.get(c, good[k]) for c, k in entity.types.items()]) for g in given]
    tables.overwrite(spark.createDataFrame(text, ", ".join(f"{c} string" for c in ("feed", *entity.columns))), house.path("text", "opens", "v"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        P.load_typed(spark, house, [], "run", "v", entity)
    with pytest.raises(ValueError, match="opens: 2 rows do not fit their types, 1 may"):
        P.load_typed(spark, house, [], "run", "v", entity, max_misfits=1)
    assert not (tmp_path / "house" / "typed").exists() or not rows(P.typed_table(spark, house, entity, ["run"]))
    P.load_typed(spark, house, [], "run", "v", entity, max_misfits=2)
    assert rows(P.typed_table(spark, house, entity, ["run"]), "send_id") == [(77,)]
    apart = spark.read.parquet(house.path("misfits", "opens", "v"))
    assert rows(apart, "send_id", "feed", F.concat_ws(",", "bad_columns")) == [
        ("78", "level2", "event_date"), ("no number", "level2", "send_id")]
