import pytest
from helpers import many, rows
from pyspark.sql import functions as F

from padron.functions import cells
from padron.operators.mentions import decode_flag, tender_mentions
from padron.sources.tables import flatten_columns, select_columns, tender_lists


def test_text_cells(spark):
    texts = ["['a', None, 'b']", "[\"O'Hara\", 'x']", "[True, False]", "solo", "nan", None, "[not a list", "[]"]
    got = many(spark, texts, cells.parse_text_cell)
    assert got == [["a", None, "b"], ["O'Hara", "x"], ["true", "false"], ["solo"], [None], [None], ["[not a list"], []]


def test_array_cells(spark):
    arrays = [["['a', 'b']"], [None, "x"], ["x", None], ["nan", None], [], None]
    got = many(spark, arrays, lambda c: cells.list_cell(c, True), "array<string>")
    assert got == [["a", "b"], [None], ["x", None], [None], [None], [None]]


def test_items_are_trimmed_and_lowered(spark):
    assert many(spark, [[" A\t", None, "B "]], cells.tidy_items, "array<string>") == [["a", None, "b"]]
    assert many(spark, [[" A "]], lambda c: cells.tidy_items(c, lower=False), "array<string>") == [["A"]]


def test_flags(spark):
    assert many(spark, ["true", "false", "", None, "x"], cells.flag_from_text) == [True, False, None, None, False]
    assert many(spark, ["S", "N", "x", None], cells.flag_from_letter) == [True, False, None, None]


def test_duplicate_leaf_names_are_refused(spark):
    df = spark.createDataFrame([((1,), (2,))], "a struct<x:int>, b struct<X:int>")
    with pytest.raises(ValueError):
        select_columns(flatten_columns(df), lambda c: True)


def tenders(spark):
    party = "WinningParty struct<ID:string,Name:array<string>,CityName:array<string>>"
    return spark.createDataFrame(
        [
            ("p", 1, " T1 ", (("['B1', 'B2']", ["One", "Two"], None), "true")),
            ("p", 2, "T2", (("B3", ["Three"], ["City"]), None)),
            ("p", 3, "T3", (("['B4', 'B5']", ["Four"], None), None)),
            ("p", 4, "T4", ((None, ["Five"], None), None)),
        ],
        f"l1 string, l2 int, id string, R struct<{party},SMEAwardedIndicator:string>",
    )


def test_tender_mentions(spark):
    lists = tender_lists(tenders(spark), ["l1", "l2"])
    party = ["ID", "Name", "CityName", "SMEAwardedIndicator"]
    # T1 knows one flag for two winners, T3 one name for two IDs, T4 no ID
    assert rows(decode_flag(tender_mentions(lists, party)), "identifier", "id_tender", "pos", "ID", "Name", "CityName") == [
        ("p/2", "T2", 0, "b3", "three", "city")
    ]
    fewer = ["ID", "Name", "CityName"]
    got = rows(tender_mentions(lists, fewer), "id_tender", "pos", "ID", "Name", "CityName")
    assert got == [("T1", 0, "b1", "one", None), ("T1", 1, "b2", "two", None), ("T2", 0, "b3", "three", "city")]
    assert rows(tender_mentions(lists, fewer, strict=True), "id_tender") == [("T2",)]


def test_pad(spark):
    assert many(spark, [["a"]], lambda c: cells.pad(c, F.lit(3)), "array<string>") == [["a", None, None]]
