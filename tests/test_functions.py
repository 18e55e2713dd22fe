import datetime as dt

from pyspark.sql import functions as F

from histloom.functions import (bounds, clean_string, composite_id, expired, flatten_whitespace,
                                hash_key, hash_uuid, nullable_hash, prehash_value, to_boolean,
                                yes_no_to_boolean)


def one(spark, *cols):
    return spark.range(1).select(*cols).collect()[0]


def test_clean_string_blank_is_null(spark):
    r = one(spark, clean_string(F.lit("  a b ")).alias("a"), clean_string(F.lit("   ")).alias("b"),
            clean_string(F.lit(None).cast("string")).alias("c"), clean_string(F.lit(12)).alias("d"))
    assert (r.a, r.b, r.c, r.d) == ("a b", None, None, "12")


def test_prehash_tokens_and_separator(spark):
    r = one(spark, prehash_value(F.lit(" x "), F.lit(""), F.lit(None).cast("string"), F.lit(3)).alias("p"))
    assert r.p == "x|~|~|3"


def test_hash_uuid_layout_and_null(spark):
    r = one(spark, hash_uuid(F.lit("a|b")).alias("h"), hash_uuid(F.lit(None).cast("string")).alias("n"))
    assert r.h == "d0726241-0206-76b1-4aa6-298ce6a18b21"
    assert r.n is None


def test_hash_key_ignores_surrounding_blanks(spark):
    r = one(spark, hash_key(F.lit(" A "), F.lit("b")).alias("x"), hash_key(F.lit("A"), F.lit("b ")).alias("y"))
    assert r.x == r.y


def test_nullable_hash(spark):
    r = one(spark, nullable_hash(F.lit(None).cast("string")).alias("n"), nullable_hash(F.lit("P")).alias("p"))
    assert r.n is None and r.p == one(spark, hash_key(F.lit("P")).alias("k")).k


def test_composite_id(spark):
    assert one(spark, composite_id(F.lit("00001"), F.lit(" "), F.lit(7)).alias("c")).c == "00001|~|7"


def test_indicator_to_boolean(spark):
    vals = ["Y", " y", "N", "T", "F", "x", "R", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = df.select(yes_no_to_boolean("v").alias("yn"), to_boolean("v").alias("tb")).collect()
    assert [r.yn for r in got] == [True, True, False, None, None, None, None, None]
    assert [r.tb for r in got] == [True, True, False, True, False, None, None, None]


def test_bounds_defaults(spark):
    df = spark.createDataFrame([(None, None), (dt.date(2000, 1, 2), dt.date(2001, 1, 1))], "b date, e date")
    b = bounds("b", "e", "0001-01-01", "9999-12-31")
    rows = df.select(*[v.alias(k) for k, v in b.items()]).collect()
    assert rows[0].begin_dt == dt.date(1, 1, 1) and rows[0].end_dt == dt.date(9999, 12, 31)
    assert rows[0].end_dtm == dt.datetime(9999, 12, 31)
    assert rows[1].begin_dtm == dt.datetime(2000, 1, 2)


def test_expired_null_is_false(spark):
    df = spark.createDataFrame([(None,), (dt.date(1999, 1, 1),), (dt.date(2002, 1, 1),)], "e date")
    assert [r.x for r in df.select(expired("e", "2001-01-01").alias("x")).collect()] == [False, True, False]


def test_flatten_whitespace(spark):
    r = one(spark, flatten_whitespace(F.lit(" a\r\nb\tc\nd\re ")).alias("f"))
    assert r.f == "a b c d e"
