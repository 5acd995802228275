"""Scalar helpers on edge rows."""

import datetime

from pyspark.sql import functions as F

from stockroom.functions import codes, months, numeric, text


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_norm_code(spark):
    assert one(spark, codes.norm_code, "0086-12") == "8612"
    assert one(spark, codes.norm_code, "000") == "000"
    assert one(spark, codes.norm_code, "861234.0") == "861234"   # float text tail dropped
    assert one(spark, codes.norm_code, None) == ""


def test_clean_and_safe_names(spark):
    assert one(spark, codes.clean_code, "123.0") == "123"
    assert one(spark, codes.clean_code, None) == ""
    assert one(spark, codes.safe_name, "A&B Wines, Inc.") == "A_B Wines_ Inc."
    assert one(spark, codes.safe_name, "") == "Unknown"
    long = ["v" * 60 + x for x in "ab"]
    names = [one(spark, codes.safe_name, x) for x in long]
    assert names[0] != names[1] and all(n.startswith("v" * 60 + "-") for n in names)


def test_parse_by_store(spark):
    r = one(spark, codes.parse_by_store, "North: 3;bad;South:x;Ea:st:2.7")
    assert [(x["store"], x["qty"]) for x in r] == [("North", 3), ("Ea:st", 2)]


def test_norm_text(spark):
    assert one(spark, codes.norm_text, "  Josh  Cellars' CAB!! ") == "josh cellars cab"


def test_months(spark):
    assert one(spark, months.parse_months_stem, "Buy in SOND") == [9, 10, 11, 12]
    assert one(spark, months.parse_months_stem, "march/june") == [3, 6]
    assert one(spark, months.parse_months_stem, "ALL") == []
    assert one(spark, months.parse_months_token, "Jan, 7 & sept 13") == [1, 7, 9]


def test_weeks_to_next_buy_month(spark):
    df = spark.createDataFrame([([3, 9], 3), ([6], 6), ([1, 2], 5), (None, 1), ([12, 1], 12)], "ms array<int>, cur int")
    r = [x["w"] for x in df.select(months.weeks_to_next_buy_month("ms", "cur").alias("w")).collect()]
    assert r[0] == 6 * 4.345
    assert r[1] == 52.0                      # one buy month a year -> capped at 52
    assert r[2] == 0.0 and r[3] == 0.0
    assert abs(r[4] - 4.345) < 1e-9          # Dec -> Jan wraps


def test_file_date(spark):
    assert one(spark, months.file_date, "Report 2026-06-11.xlsx") == datetime.date(2026, 6, 11)
    assert one(spark, months.file_date, "Report 6.15.26.xlsx") == datetime.date(2026, 6, 15)
    assert one(spark, months.file_date, "Report 2026-13-45 6.15.26.xlsx") == datetime.date(2026, 6, 15)
    assert one(spark, months.file_date, "Report.xlsx") is None


def test_fourth_thursday(spark):
    for y, d in [(2023, 23), (2024, 28), (2025, 27), (2026, 26)]:
        r = spark.range(1).select(months.fourth_thursday_of_november(F.lit(y)).alias("d")).first()["d"]
        assert r == datetime.date(y, 11, d)


def test_round_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-0.4,), (2.675,)], "v double")
    r = [x["r"] for x in df.select(numeric.round_even("v", 0).alias("r")).collect()]
    assert r == [2.0, 4.0, 0.0, 3.0]


def test_brand_and_potency(spark):
    assert one(spark, text.brand_of, "Old Milwaukee 12pk") == "Old Milwaukee"
    assert one(spark, text.brand_of, "Wyld Gummies") == "Wyld"
    assert one(spark, text.potency_of, "Gummy 10 MG x5") == 10
    assert one(spark, text.potency_of, "Gummy") is None
    assert one(spark, text.potency_of, "Lot 12345678901234567890123 mg, 10 mg") is None


def test_expand_ad_line(spark):
    r = one(spark, text.expand_ad_line, "Josh Cab / All 19 Crimes (all types)")
    assert [(x["q"], x["is_brand"]) for x in r] == [("Josh Cab", False), ("19 Crimes", True)]


def test_expand_abbrev(spark):
    assert one(spark, text.expand_abbrev, "horologist sb") == "horologist sauvignon blanc"


def test_keyword_score(spark):
    words = text.query_words("How many Blue Widget items do we have?")
    assert words == ["blue", "widget"]
    assert one(spark, lambda c: text.keyword_score(c, words), "Blue widget 12") == 2


def test_age_label_and_money(spark):
    for secs, text in ((30, "30 sec ago"), (600, "10 min ago"), (7200, "2 hours ago"), (200000, "2 days ago"), (None, "")):
        row = spark.createDataFrame([(None if secs is None else float(secs),)], "s double").select(numeric.age_label("s")).first()
        assert row[0] == text
    assert one(spark, numeric.money_or_zero, "$1,234.50") == 1234.5 and one(spark, numeric.money_or_zero, "n/a") == 0.0
    assert one(spark, numeric.loose_num, "about 5.50 ea") == 5.5 and one(spark, numeric.loose_num, "-") is None
