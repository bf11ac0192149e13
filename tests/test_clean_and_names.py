from datetime import datetime

import pytest

from rosterlake.functions import clean as C
from rosterlake.functions import names as N
from rosterlake.operators.quality import typed_and_rejected


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_blank_text_becomes_null(spark):
    values = ["  ", " ab ", "\tab\n", "a b", " x　", "", None]
    assert one(spark, values, C.blank_to_null("v")) == [None, "ab", "ab", "a b", "x", None, None]


def test_numbers(spark):
    assert one(spark, ["12", "-3", None], C.to_bigint("v")) == [12, -3, None]
    for bad in ("", "x", "1.5"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            one(spark, [bad], C.to_bigint("v"))


def test_booleans(spark):
    assert one(spark, ["True", "false", "TRUE", None], C.to_bool("v")) == [True, False, True, None]
    for bad in ("1", "yes", ""):
        with pytest.raises(Exception, match="not a boolean"):
            one(spark, [bad], C.to_bool("v"))


def test_times(spark):
    values = ["1/2/2021 3:04:05 PM", " 01/02/2021 12:00:00 AM ", "12/31/2020 12:30:00 pm", " ", None]
    assert one(spark, values, C.to_time("v")) == [
        datetime(2021, 1, 2, 15, 4, 5), datetime(2021, 1, 2), datetime(2020, 12, 31, 12, 30), None, None]
    with pytest.raises(Exception):
        one(spark, ["13/40/2021 1:00:00 AM"], C.to_time("v"))


def test_stored_time_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        # This hour does not exist in that zone on that day.
        spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
        for f in (C.to_time, C.try_time):
            assert one(spark, ["3/14/2021 2:30:00 AM"], f("v").cast("string")) == ["2021-03-14 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rejects_name_their_columns(spark):
    raw = spark.createDataFrame(
        [(1, "5", "True", T) for T in ("1/2/2021 3:04:05 PM", " ")] + [(2, "", "1", "13/40/2021 1:00:00 AM"), (3, None, None, None)],
        "id int, n string, b string, t string")
    good, bad = typed_and_rejected(raw, {"n": C.BIGINT, "b": C.BOOL, "t": C.TIME})
    assert sorted(r["id"] for r in good.collect()) == [1, 1, 3]
    assert [(r["id"], r["bad_columns"]) for r in bad.collect()] == [(2, ["n", "b", "t"])]


def test_header_names(spark):
    headers = {"SendURLID": "send_urlid", "DEClientID": "de_client_id", "2ndName": "_nd_name",
               "E-mail/Addr": "e_mail_addr", "a___b": "a__b", " Client ID ": "client_id", "IsUniqueForURL": "is_unique_for_url",
               "price$": "price_", "größe": "größe", "": ""}
    assert one(spark, list(headers), N.column_name("v")) == list(headers.values())


def test_file_names(spark):
    assert one(spark, ["drop_level2_20240131.zip"], N.feed_folder("v")) == ["drop_level2"]
    df = spark.createDataFrame([("drop_all_bu", "ClickImpression.v2.csv")], "f string, n string")
    assert df.select(N.landing_table("f", "n")).head()[0] == "all_bu_clickimpression"
    assert one(spark, ["a_b_20240101", "plain", "tail_", "_x"], N.without_tail("v", "_")) == ["a_b", "plain", "tail", ""]
    assert one(spark, ["a.b.c"], N.without_tail("v", ".")) == ["a.b"]
    # Once no delimiter is left, dropping the tail changes nothing.
    assert one(spark, ["plain"], N.without_tail(N.without_tail("v", "_"), "_")) == ["plain"]
    assert one(spark, ["trk_a_trk_b"], N.without_prefix("v", "trk_")) == ["a_b"]
    assert one(spark, ["Ab"], N.affixed("v", "P_", "_S")) == ["p_ab_s"]
