import datetime as dt
import string

from pyspark.sql import functions as F

from casegrid.functions import text as TX


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_strip_judge_titles_vectors(spark):
    assert _one(spark, TX.strip_judge_titles, "Judge James CBE") == "James"
    got = [_one(spark, TX.strip_judge_titles, s) for s in ["Chief Mark", "Judge James CBE", "Jeremy"]]
    assert got == ["Mark", "James", "Jeremy"]
    # capwords runs first in the pipeline, so upper-case titles survive as 'Cbe'
    assert _one(spark, lambda c: TX.strip_judge_titles(TX.capwords(c)), "Judge JAMES CBE") == "James Cbe"


def test_capwords_capitalize_title_match_python(spark):
    samples = ["  hello   wORLD  ", "o'brien smith-jones", "MR JUSTICE", "a", "élan vital"]
    for s in samples:
        assert _one(spark, TX.capwords, s) == string.capwords(s)
        assert _one(spark, TX.capitalize, s) == s.capitalize()
    for s in ["o'brien smith-jones", "SMITH'S & co", "1st of may", "élan vital"]:
        assert _one(spark, TX.title_case, s) == s.title()


def test_listing_dates(spark):
    assert _one(spark, TX.parse_listing_date, "5 Feb 2022") == dt.date(2022, 2, 5)
    assert _one(spark, TX.parse_listing_date, "5 Feb 2022, midnight") == dt.date(2022, 2, 5)
    assert _one(spark, TX.parse_listing_date, None) is None
    assert _one(spark, TX.parse_listing_date, "") is None
    assert _one(spark, TX.parse_listing_date, "not a date") is None
    assert _one(spark, TX.format_ddmmyyyy, dt.date(2024, 8, 11), "date") == "11-08-2024"


def test_truncate_middle(spark):
    text = " ".join(f"w{i}" for i in range(20))
    assert _one(spark, lambda c: TX.truncate_middle(c, 10, 10), text) == text
    got = _one(spark, lambda c: TX.truncate_middle(c, 3, 2), text)
    assert got == "w0 w1 w2[...] w18 w19"
    # tokens re-concatenate to the input exactly
    df = spark.createDataFrame([("  a  b\nc  ",)], "x string")
    assert "".join(df.select(TX.tokens("x")).first()[0]) == "  a  b\nc  "


def test_topics_and_email(spark):
    assert _one(spark, TX.topic_name, "High Court (King's Bench Division)") == \
        "c12-courts-High-Court-Kings-Bench-Division"
    assert _one(spark, TX.topic_display, "c12-courts-High-Court-Kings-Bench-Division") == \
        "High Court Kings Bench Division"
    assert _one(spark, TX.extract_email, "mail me: a.b_c@x-y.co.uk thanks") == "a.b_c@x-y.co.uk"
    assert _one(spark, TX.extract_email, "no address") == ""


def test_verdict_whitelist(spark):
    assert _one(spark, TX.standardise_verdict, "Guilty") == "Guilty"
    assert _one(spark, TX.standardise_verdict, "guilty") == "Other"
    assert _one(spark, TX.standardise_verdict, None) is None
