from pyspark.sql import functions as F

from tidemark.sources import layouts as L


def files_frame(spark, rows):
    return spark.createDataFrame(rows, "file string, first_line string, headers array<string>")


def test_first_match_wins_and_fallbacks(spark):
    sig = L.POSITION_COST_SIGNATURE
    df = files_frame(spark, [
        ("/r/both.txt", "Table To Be Searched  PA0001", sig + ["x"]),
        ("/r/dump.txt", "Table To Be Searched  PA0008", ["a"]),
        ("/r/marker_no_name.txt", "Table To Be Searched", ["a"]),
        ("/r/lower.name.txt", "Table To Be Searched  pa0001", ["a"]),
        ("/r/plain.txt", "Report", ["a"]),
        ("/r/short_sig.txt", "Report", sig[:9]),
    ])
    got = {r["file"]: (r["layout"], r["table_name"]) for r in L.match_layouts(df).collect()}
    assert got["/r/both.txt"] == ("position_cost", "ZPOST")
    assert got["/r/dump.txt"] == ("table_dump", "PA0008")
    assert got["/r/marker_no_name.txt"] == ("table_dump", "marker_no_name")
    assert got["/r/lower.name.txt"] == ("table_dump", "lower.name")
    assert got["/r/plain.txt"] == ("generic", "plain")
    assert got["/r/short_sig.txt"] == ("generic", "short_sig")


def test_rename_only_when_widths_agree_and_comma_strip(spark):
    h35 = L.POSITION_COST_SIGNATURE + [f"c{i}" for i in range(25)]
    assert L.final_headers(h35, L.POSITION_COST) == L.POSITION_COST_HEADERS
    assert L.final_headers(h35[:34], L.POSITION_COST) == h35[:34]
    cells = ["1,000"] * 35
    rows = spark.createDataFrame([(cells,)], "cells array<string>")
    t = L.to_table(rows, h35, L.POSITION_COST).first().asDict()
    assert t["Fund Code"] == "1000" and t["Description of Fund Code"] == "1000" and t["Cost Center"] == "1000"
    assert t["Transfer Reserve"] == "1,000"        # 'Reserve' is not a keyword ('Reserves' is)
    assert t["Post Title"] == "1,000"


def test_unique_headers():
    assert L.unique_headers(["a", "A", "a", "", "b", " "]) == ["a", "A_1", "a_2", "C3", "b", "C5"]


def test_short_rows_are_padded_with_null(spark):
    rows = spark.createDataFrame([(["1"],), (["1", "2"],)], "cells array<string>")
    got = sorted((tuple(r) for r in L.to_table(rows, ["a", "b"]).collect()), key=repr)
    assert set(got) == {("1", None), ("1", "2")}
