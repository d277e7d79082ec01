"""PostgreSQL semantics of the column helpers (F rows, traps 1-8)."""

import pytest
from pyspark.sql import functions as F

from recount.functions import pg


def _one(spark, col, schema, row):
    return spark.createDataFrame([row], schema).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "phone,code,expected",
    [
        ("+966500000001", "966", "500000001"),
        ("966500000001", "966", "500000001"),
        ("500000001", "966", "500000001"),
        (None, "966", ""),
        ("+966500000001", None, ""),  # trap 2: a null code always gives ''
        ("500000001", None, ""),
        ("0501234567890123456789", "966", "0501234567890123"),  # cut to 16
        ("+9665", "966", "5"),
    ],
)
def test_normalize_phone(spark, phone, code, expected):
    got = _one(spark, pg.normalize_phone("p", "c"), "p string, c string", (phone, code))
    assert got == expected


def test_country_code_null_gives_plus(spark):
    assert _one(spark, pg.country_code("c"), "c string", (None,)) == "+"  # trap 1
    assert _one(spark, pg.country_code("c"), "c string", ("966",)) == "+966"


def test_concat_ignores_null_and_strict_propagates(spark):
    schema = "a string, b string"
    assert _one(spark, pg.concat(F.col("a"), " ", F.col("b")), schema, ("x", None)) == "x "
    assert _one(spark, pg.concat_strict(F.col("a"), "_", F.col("b")), schema, ("x", None)) is None


def test_regexp_replace_first_only(spark):  # trap 4
    assert _one(spark, pg.regexp_replace_first("s", " ", ""), "s string", ("a b c",)) == "ab c"
    assert _one(spark, pg.regexp_replace_all("s", " ", ""), "s string", ("a b c",)) == "abc"
    assert _one(spark, pg.regexp_replace_first("s", "x", "y"), "s string", ("abc",)) == "abc"
    # '.' crosses newlines as in PostgreSQL
    assert _one(spark, pg.regexp_replace_first("s", "b", "B"), "s string", ("a\nb\nb",)) == "a\nB\nb"


@pytest.mark.parametrize(
    "name,ident,expected",
    [
        ("3-M Company", 7, "3M_7"),
        ("-dash first", 3, "DD_3"),
        ("a--bcd", 5, "A _5"),
        ("A b", 1, "A_B_1"),
        ("Nike", 9, "NIKE_9"),
        ("Brand x", 2, "BR_2"),
        (None, 4, None),
    ],
)
def test_brand_code(spark, name, ident, expected):
    got = _one(spark, pg.brand_code("n", "i"), "n string, i bigint", (name, ident))
    assert got == expected


def test_slug(spark):
    assert _one(spark, pg.slug("n"), "n string", ("Big Sale 10% off!",)) == "BIG_SALE_10_OFF"


def test_digit_casts(spark):  # trap 6, trap 8
    schema = "z string"
    assert _one(spark, pg.digits_or_null("z", "int"), schema, ("11564",)) == 11564
    assert _one(spark, pg.digits_or_null("z", "int"), schema, ("99999999999",)) is None  # out of range
    assert _one(spark, pg.digits_or_null("z", "int"), schema, ("123\n",)) is None  # Java $ would match
    assert _one(spark, pg.digits_or("z", -1), schema, ("abc",)) == -1
    assert _one(spark, pg.digits_or("z", -1), schema, (None,)) == -1
    assert _one(spark, pg.only_digits_or_null("z"), schema, ("12-34 a",)) == 1234
    assert _one(spark, pg.only_digits_or_null("z"), schema, ("none",)) is None


def test_strip_trailing_number(spark):
    assert _one(spark, pg.strip_trailing_number("s"), "s string", ("Acme-12",)) == "Acme"
    assert _one(spark, pg.strip_trailing_number("s"), "s string", ("Acme-12\n",)) == "Acme-12\n"
    assert _one(spark, pg.strip_trailing_number("s"), "s string", ("A-1-2",)) == "A-1"


def test_substring_and_left(spark):
    schema = "s string"
    assert _one(spark, pg.substring("s", 8), schema, ("Spree::CreditCard",)) == "CreditCard"
    assert _one(spark, pg.substring("s", F.lit(None).cast("int")), schema, ("abc",)) is None
    assert _one(spark, pg.substring("s", 2, 2), schema, ("abcd",)) == "bc"
    assert _one(spark, pg.left("s", 2), schema, ("abcd",)) == "ab"


def test_weekday_and_value_map(spark):
    schema = "d int"
    assert _one(spark, pg.weekday_name("d", "sunday"), schema, (3,)) == "wednesday"
    assert _one(spark, pg.weekday_name("d", "sunday"), schema, (None,)) == "sunday"
    assert _one(spark, pg.weekday_name("d", ""), schema, (9,)) == ""


def test_null_ordering_follows_postgres(spark):  # trap 3
    from pyspark.sql import Window

    df = spark.createDataFrame([(1, None), (1, 5), (1, 7)], "k int, v int")
    w_desc = Window.partitionBy("k").orderBy(pg.desc("v"))
    w_asc = Window.partitionBy("k").orderBy(pg.asc("v"))
    first_desc = df.withColumn("r", F.row_number().over(w_desc)).filter("r = 1").first()["v"]
    first_asc = df.withColumn("r", F.row_number().over(w_asc)).filter("r = 1").first()["v"]
    assert first_desc is None and first_asc == 5


def test_divide_follows_operand_types(spark):  # trap 5
    df = spark.createDataFrame([(7, 2, -7)], "a int, b int, c int")
    assert df.select(pg.divide("a", "b", "int", "int")).first()[0] == 3
    assert df.select(pg.divide("c", "b", "int", "int")).first()[0] == -3  # toward zero
    dec = spark.createDataFrame([(7, 2)], "a int, b int").selectExpr("CAST(a AS decimal(5,2)) a", "CAST(b AS decimal(5,2)) b")
    assert float(dec.select(pg.divide("a", "b", "decimal(5,2)", "decimal(5,2)")).first()[0]) == 3.5
