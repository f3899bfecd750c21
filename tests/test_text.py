"""Golden cases of the address text rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.functions import text as tx


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "s string").select(f(F.col("s")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("raw", "full"),
    [("Fő u.", "Fő utca"), ("Teréz krt.", "Teréz körút"), ("Fő út", "Fő út"), ("  Duna   RKP ", "Duna rakpart"), ("Kossuth ltp.", "Kossuth lakótelep"), ("hrsz", "helyrajzi szám"), ("", ""), (None, None), ("Áu", "Áu")],
)
def test_street(spark, raw, full):
    assert one(spark, raw, tx.expand_street) == full


@pytest.mark.parametrize(
    ("raw", "full"),
    [("31-B épület", "31 B"), ("21/A", "21 A"), ("112-114", "112-114"), ("31-B", "31 B"), ("10a", "10 A"), ("12 lépcsőház 3", "12"), (" ", " "), (None, None), ("10ő", "10 Ő")],
)
def test_standard_number(spark, raw, full):
    assert one(spark, raw, tx.standard_number) == full


@pytest.mark.parametrize(("raw", "full"), [("1/B A", "1/B"), ("10 A B", "10 A"), ("2-4D D", "2-4D"), ("007/0012 100 000", "7/12 100 0"), ("00", "0"), ("{=5<>bldg. 3", "5 . 3"), (None, None)])
def test_repair_number(spark, raw, full):
    assert one(spark, raw, tx.repair_number) == full


def test_repair_needs_two_passes_here(spark):
    once = one(spark, "1/B A B", tx.repair_number)
    assert once == "1/B B" and one(spark, once, tx.repair_number) == "1/B"


@pytest.mark.parametrize(
    ("raw", "parsed"),
    [("12-14 C", (12, 14, "C")), ("12", (12, 12, None)), ("7 b", (7, 7, "B")), ("5-5", None), ("14-12", None), ("", None), (None, None), ("12 AB", None), ("99999999999", None)],
)
def test_parse(spark, raw, parsed):
    r = one(spark, raw, tx.parse_house)
    assert (tuple(r) if r else None) == parsed


def test_lenient_parse_turns_ranges(spark):
    assert tuple(one(spark, "14-12", tx.parse_house_lenient)) == (12, 14, None)


@pytest.mark.parametrize(
    ("raw", "key"), [("Fő u", "fő utca"), ("Fő u.", "fő utca"), ("Fő u .", "fő utca"), ("Fő út.", "fő út"), ("Fő ​u", "fő utca"), (None, None)]
)
def test_street_key(spark, raw, key):
    assert one(spark, raw, tx.street_key) == key


@pytest.mark.parametrize(("raw", "key"), [("29.0", "29"), (" 2 9 ", "29"), ("12 a", "12a"), (None, None)])
def test_number_key(spark, raw, key):
    assert one(spark, raw, tx.number_key) == key


@pytest.mark.parametrize(("raw", "parts"), [("Fő utca 12/A", ("Fő utca", "12/A")), ("12 Fő utca", ("", "12 Fő utca")), ("Fő utca", (None, None)), (None, (None, None))])
def test_split_at_digit(spark, raw, parts):
    df = spark.createDataFrame([(raw,)], "s string")
    a, b = tx.split_at_digit(F.col("s"))
    assert tuple(df.select(a.alias("a"), b.alias("b")).first()) == parts


def test_leading_digit_moves_to_the_street(spark):
    df = spark.createDataFrame([("", "12 Fő utca"), ("Fő utca", "012 HRSZ"), ("Fő utca", "7"), (None, None)], "street string, number string")
    a, b = tx.move_misplaced(F.col("street"), F.col("number"))
    assert [tuple(r) for r in df.select(a, b).collect()] == [("12 Fő utca", None), ("012 HRSZ", None), ("Fő utca", "7"), (None, None)]


def test_split_last_number(spark):
    a, b = tx.split_last_number(F.col("s"))
    rows = spark.createDataFrame([("Fő 3 utca 12/A",), ("Fő utca",)], "s string").select(a, b).collect()
    assert [tuple(r) for r in rows] == [("Fő 3 utca", "12/A"), ("Fő utca", None)]


def test_fold(spark):
    assert one(spark, "Őrült Árvíz", tx.fold_ascii) == "Orult Arviz"


def test_coordinates(spark):
    df = spark.createDataFrame([(["1", "19.5", "47.1"], 19.5, 47.1), (["46", "17"], None, None), (["x"], 47.0, 19.0), (["1"], None, None)], "a array<string>, lat double, lon double")
    rows = df.select(tx.repair_coordinates(F.col("a"), F.col("lat"), F.col("lon")).alias("r")).collect()
    assert [tuple(r.r) for r in rows] == [(47.1, 19.5), (46.0, 17.0), (47.0, 19.0), (None, None)]
