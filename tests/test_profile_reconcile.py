import datetime as dt

from tidemark.operators.profile import blank_profile, blank_profile_rows, describe, preview
from tidemark.operators.reconcile import mismatches
from tidemark.operators.projection import UnknownColumnError, dates_to_string, star_except

import pytest


def test_blank_profile_cases(spark):
    df = spark.createDataFrame(
        [(None, " ", 1.5, dt.date(2024, 1, 1)), (None, "x", None, None), (None, "", 2.0, dt.date(2024, 1, 2))],
        "allnull string, s string, d double, day date")
    r = blank_profile(df).first().asDict()
    assert r == {"total_rows": 3, "allnull_blanks": 3, "s_blanks": 2, "d_blanks": 1, "day_blanks": 1}
    rows = {x["metric"]: x["value"] for x in blank_profile_rows(df).collect()}
    assert rows["total_rows"] == 3 and rows["s_blanks"] == 2


def test_blank_profile_empty_table_sums_are_null(spark):
    df = spark.createDataFrame([], "a string, b int")
    r = blank_profile(df).first().asDict()
    assert r == {"total_rows": 0, "a_blanks": None, "b_blanks": None}


def gold(spark, rows):
    return spark.createDataFrame(rows, "`Personnel Number` string, `Actual Personnel Area` string, "
                                       "`Personnel area` string, `Post Type` string, Adj_Start_Date date, x int")


def test_mismatch_semantics(spark):
    d = dt.date(2024, 1, 1)
    g = gold(spark, [
        ("1", "A", "B", "01", d, 1),        # mismatch
        ("2", "Unknown", "B", "07", d, 2),  # 'Unknown' counts
        ("3", None, "B", "01", d, 3),       # NULL actual drops
        ("4", "A", "B", "99", d, 4),        # post type outside the list
        (" ", "A", "B", "01", d, 5),        # blank key
        ("6", "A", "A", "01", d, 6),        # equal
    ])
    m = mismatches(g, "Actual Personnel Area", "Personnel area", "PA0001_Personnel_Area", "ZPOST_Personnel_Area")
    assert m.columns == ["Personnel Number", "Adj_Start_Date", "PA0001_Personnel_Area", "ZPOST_Personnel_Area",
                         "Post Type", "x"]
    assert sorted(r["x"] for r in m.collect()) == [1, 2]
    assert dict(m.dtypes)["Adj_Start_Date"] == "string"


def test_mismatch_without_date_columns(spark):
    g = gold(spark, [("1", "A", "B", "01", None, 1)]).drop("Adj_Start_Date")
    m = mismatches(g, "Actual Personnel Area", "Personnel area", "a", "p")
    assert m.count() == 1 and "Adj_Start_Date" not in m.columns


def test_star_except_is_strict(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `B.c` int, d int")
    assert star_except(df, ["b.C"]).columns == ["a", "d"]
    with pytest.raises(UnknownColumnError):
        star_except(df, ["nope"])


def test_dates_to_string_preview_describe(spark):
    df = spark.createDataFrame([(dt.date(9999, 12, 31), 1)], "d date, n int")
    assert dates_to_string(df).first()["d"] == "9999-12-31"
    assert preview(df, 5).count() == 1
    assert describe(df) == [("d", "date"), ("n", "int")]
