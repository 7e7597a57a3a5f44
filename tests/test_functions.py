import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierwise.functions import cleaning, dates, keys, measures


def one(df, *columns):
    return tuple(df.select(*columns).first())


@pytest.fixture(scope="module")
def unit(spark):
    return spark.range(1)


def variant(text):
    return F.parse_json(F.lit(text))


def test_variant_numbers_round(unit):
    doc = variant('{"a": 1.6, "b": 2.5, "c": null, "d": 1}')
    get = lambda p: cleaning.variant_field(doc, p, "bigint")
    assert one(unit, get("$.a"), get("$.b"), get("$.c"), get("$.missing")) == (2, 3, None, None)
    assert one(unit, cleaning.variant_field(doc, "$.d", "boolean")) == (True,)


def test_bad_cast_raises_unless_lenient(unit):
    doc = variant('{"a": "not a number"}')
    assert one(unit, cleaning.variant_field(doc, "$.a", "bigint", strict=False)) == (None,)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        unit.select(cleaning.variant_field(doc, "$.a", "bigint")).collect()


def test_clean_up(unit):
    assert one(
        unit,
        cleaning.blank_to_null(F.lit("  ")),
        cleaning.blank_to_null(F.lit(" x ")),
        cleaning.zero_to_null(F.lit(0)),
        cleaning.zero_to_null(F.lit(7)),
        cleaning.standard_upper(F.lit(" drama ")),
        cleaning.or_unknown(F.lit(None).cast("string")),
    ) == (None, "x", None, 7, "DRAMA", "UNKNOWN")


def test_map_labels_gives_default_for_null_and_unlisted(spark, rows):
    df = spark.createDataFrame([("US",), ("XX",), (None,)], "c string")
    got = rows(df.select("c", cleaning.map_labels(F.col("c"), {"US": "NORTH"}, "OTHER")))
    assert got == [("US", "NORTH"), ("XX", "OTHER"), (None, "OTHER")]


def test_compare_flag(spark, rows):
    df = spark.createDataFrame([(1, 2, 1), (2, 2, 2), (3, 3, 2), (4, None, 2)], "i int, a int, b int")
    got = rows(df.select("i", cleaning.compare_flag(F.col("a"), F.col("b"))))
    assert got == [(1, "PROFITABLE"), (2, "BREAK_EVEN"), (3, "PROFITABLE"), (4, "UNKNOWN")]


@pytest.mark.parametrize(
    "text, expected",
    [("2023-07-15", dt.date(2023, 7, 15)), ("", None), ("2023-02-30", None), ("x", None), (None, None), ("0001-01-01", None)],
)
def test_clean_date(unit, text, expected):
    assert one(unit, dates.clean_date(F.lit(text).cast("string"), "yyyy-MM-dd")) == (expected,)


def test_safe_date_without_format(unit):
    assert one(unit, dates.safe_date(F.lit("2023-07-15"))) == (dt.date(2023, 7, 15),)
    assert one(unit, dates.safe_date(F.lit("15/07/2023"))) == (None,)


def test_calendar_attributes(unit):
    sunday = F.lit(dt.date(2023, 1, 1))
    assert one(unit, dates.day_of_week(sunday), dates.date_key(sunday), dates.quarter_label(sunday)) == (0, 20230101, "Q1")
    october = F.lit(dt.date(2022, 10, 1))
    assert one(
        unit, dates.fiscal_year(october), dates.fiscal_year(october, 1), dates.fiscal_year(october, 11)
    ) == (2023, 2022, 2022)


def test_seasons_cover_all_months(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = [r[0] for r in df.select(dates.release_season(F.col("m"))).collect()]
    assert got == ["WINTER"] * 3 + ["SPRING"] * 2 + ["SUMMER"] * 3 + ["FALL"] * 2 + ["HOLIDAY"] * 2
    assert one(spark.range(1), dates.release_season(F.lit(None).cast("int"))) == (None,)


def test_date_parts_names(spark):
    df = spark.createDataFrame([(dt.date(2023, 7, 3),)], "d date").select(*dates.date_parts("d", "release"))
    assert df.first().asDict() == {
        "release_year": 2023, "release_month": 7, "release_quarter": 3, "release_day": 3,
        "release_dow": 1, "release_day_name": "Mon", "release_month_label": "2023-07",
    }


def test_surrogate_keys(unit):
    null = F.lit(None).cast("string")
    single, pair, none = (
        keys.surrogate_key(F.lit(28)), keys.surrogate_key(F.lit(1), F.lit("a")), keys.surrogate_key(null),
    )
    assert one(unit, single, pair == F.md5(F.lit("1-a"))) == ("33e75ff09dd601bbe69f351039152189", True)
    assert one(unit, none == F.md5(F.lit(keys.NULL_TOKEN)), none == keys.surrogate_key(F.lit(""))) == (True, False)
    with pytest.raises(ValueError):
        keys.surrogate_key()


def test_document_hash_ignores_key_order(unit):
    a, b = variant('{"x": 1, "y": [1, 2]}'), variant('{"y":[1,2],"x":1}')
    assert one(unit, keys.document_hash(a) == keys.document_hash(b)) == (True,)


@pytest.mark.parametrize(
    "revenue, budget, expected",
    [(22000000, 5000000, Decimal("340.00")), (1, 3, Decimal("-66.67")), (0, 3, Decimal("-100.00")),
     (5, 0, None), (None, 3, None), (5, None, None), (5, 5, Decimal("0.00"))],
)
def test_return_pct(spark, revenue, budget, expected):
    df = spark.createDataFrame([(revenue, budget)], "r bigint, b bigint")
    assert one(df, measures.return_pct(F.col("r"), F.col("b"))) == (expected,)


def test_rounded_aggregates_are_exact(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(big,), (big,), (None,)], "x bigint")
    total, mean, none = df.agg(
        measures.rounded_sum(F.col("x"), 1, 1_000_000),
        measures.rounded_mean(F.col("x"), 2, 1_000_000),
        measures.rounded_mean(F.when(F.col("x") < 0, F.col("x")), 2),
    ).first()
    assert (total, mean, none) == (Decimal(18_000_000_000_000), Decimal(9_000_000_000_000), None)


def test_share_of_nothing_is_null(unit):
    assert one(unit, measures.share_pct(F.lit(0), F.lit(0))) == (None,)
    assert one(unit, measures.share_pct(F.lit(1), F.lit(3))) == (Decimal("33.3"),)


def test_weighted_rating(unit):
    value = measures.weighted_rating(F.lit(8.0), F.lit(300), 100, F.lit(6.0))
    assert one(unit, value) == (7.5,)
