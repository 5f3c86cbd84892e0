from __future__ import annotations

import pytest

from factloom import derive_substring, strip_headings


def test_only_ascii_white_space_is_stripped(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], ["Sale Key", "City\tKey", "A  B", "N B", " x.y\n"])
    assert strip_headings(df).columns == ["SaleKey", "CityKey", "AB", "N B", "x.y"]
    assert strip_headings(df).first() == (1, 2, 3, 4, 5)


@pytest.mark.parametrize("names", [["A B", "AB"], ["A B", "ab"]])
def test_headings_that_become_equal_are_named(spark, names):
    with pytest.raises(ValueError, match="not distinct"):
        strip_headings(spark.createDataFrame([(1, 2)], names))


def test_case_counts_where_the_session_says_so(spark):
    df = spark.createDataFrame([(1, 2)], ["A B", "ab"])
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert strip_headings(df).columns == ["AB", "ab"]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_substring_counts_characters_from_one(spark):
    texts = [None, "", "abc", "abcd", "abcdefghij", "a😀bcdéfghi"]
    df = spark.createDataFrame([(t,) for t in texts], "Description string")
    got = [r.Desc1 for r in derive_substring(df, "Desc1", "Description", 4, 6).collect()]
    assert got == [None, "", "", "d", "defghi", "cdéfgh"]


def test_derived_column_comes_last_and_keeps_the_others(spark):
    df = spark.createDataFrame([("abcdefghij", 1)], ["a.b", "n"])
    assert derive_substring(df, "d", "a.b", 1, 2).columns == ["a.b", "n", "d"]


def test_existing_target_column_is_refused(spark):
    df = spark.createDataFrame([("a", "b")], ["Description", "Desc1"])
    with pytest.raises(ValueError, match="not distinct"):
        derive_substring(df, "Desc1", "Description", 4, 6)
