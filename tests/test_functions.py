from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sparkmart.functions.decode import product_size, size_type, style
from sparkmart.functions.keys import date_key, version_id
from sparkmart.operators.staging import Field, conform, staged
from sparkmart.plans.calendar import date_spine, dim_calendar, key_to_date, spine_over
from sparkmart.plans.dims import customers


def test_date_key_of_dates_and_timestamps(spark):
    df = spark.createDataFrame(
        [(date(2024, 2, 29), datetime(1999, 12, 31, 23, 59, 59)), (None, None)],
        "d date, t timestamp_ntz",
    )
    assert rows(df.select(date_key("d").alias("d"), date_key("t").alias("t"))) == [
        (None, None),
        (20240229, 19991231),
    ]


def test_key_to_date_inverts_date_key(spark):
    spine = date_spine(spark, date(2001, 3, 5))
    back = spine.where(key_to_date(date_key("full_date")) != F.col("full_date"))
    assert spine.count() == 430 and back.count() == 0


def test_version_id_is_md5_of_joined_parts(spark):
    import hashlib

    df = spark.createDataFrame([(7, date(2024, 1, 2))], "k bigint, d date")
    expected = hashlib.md5(b"7~2024-01-02").hexdigest()
    assert rows(df.select(version_id("k", "d"))) == [(expected,)]


def test_customer_codes(spark):
    staged_customers = spark.createDataFrame(
        [(1, "M", "F", "Y"), (2, "X", "M", "N"), (3, None, None, None)],
        "customer_key bigint, marital_status string, gender string, home_owner string",
    )
    for name, kind in (
        ("prefix", "string"), ("first_name", "string"), ("last_name", "string"),
        ("birth_date", "date"), ("email_address", "string"), ("yearly_income", "decimal(18,2)"),
        ("total_children", "bigint"), ("education_level", "string"), ("occupation", "string"),
    ):
        staged_customers = staged_customers.withColumn(name, F.lit(None).cast(kind))
    no_sales = spark.createDataFrame([], "customer_key bigint")
    dim = customers(staged_customers, no_sales)
    assert rows(dim, "customer_key", "marital_status", "gender", "is_home_owner") == [
        (-1, "N/A", "N/A", False),
        (1, "Married", "Female", True),
        (2, "N/A", "Male", False),
        (3, "N/A", "N/A", False),
    ]


@pytest.mark.parametrize(
    ("size", "code", "expected"),
    [
        ("M", "U", ("M", "Clothing", "Unisex")),
        ("48", "0", ("48", "Frame (cm)", "N/A")),
        ("0", None, (None, "No Size", "N/A")),
        ("62 ", "W", ("62 ", "Frame (cm)", "Women")),
        ("48.5", "M", ("48.5", "No Size", "Men")),
        ("-1", "Q", ("-1", "No Size", "Q")),
        ("99999999999", "U", ("99999999999", "No Size", "Unisex")),
        (None, "U", (None, "No Size", "Unisex")),
    ],
)
def test_product_codes(spark, size, code, expected):
    df = spark.createDataFrame([(size, code)], "size string, code string")
    out = df.select(product_size(F.col("size")), size_type(F.col("size")), style(F.col("code")))
    assert tuple(out.first()) == expected


def test_calendar_attributes(spark):
    spine = spark.createDataFrame([(date(2021, 1, 1),), (date(2024, 5, 18),)], "full_date date")
    assert rows(dim_calendar(spine)) == [
        (20210101, date(2021, 1, 1), 2021, 1, "Q1-2021", 1, "Jan", "2021-01", 1, 53, "Fri", 5, False),
        (20240518, date(2024, 5, 18), 2024, 2, "Q2-2024", 5, "May", "2024-05", 18, 20, "Sat", 6, True),
    ]


def test_date_spine_has_no_limit_and_is_complete(spark):
    assert date_spine(spark, date(2100, 1, 1)).agg(F.max("full_date")).first()[0] == date(2100, 1, 1)
    assert date_spine(spark, date(1999, 1, 1)).count() == 0
    a = spark.createDataFrame([(date(2024, 1, 30),)], "d date")
    b = spark.createDataFrame([(date(2024, 2, 2),), (None,)], "d date")
    assert spine_over([(a, "d"), (b, "d")]).count() == 4


def test_conform_casts_renames_and_fails_on_bad_keys(spark):
    raw = spark.createDataFrame([("1", "2.5", "x")], "k string, v string, other string")
    good = conform(raw, [Field("key", "bigint", "k"), Field("v", "decimal(18,2)")])
    assert good.dtypes == [("key", "bigint"), ("v", "decimal(18,2)")]
    lenient = conform(raw, [Field("other", "bigint", lenient=True)])
    assert rows(lenient) == [(None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(raw, [Field("other", "bigint")]).collect()


def test_staged_drops_unlisted_columns(spark):
    raw = spark.createDataFrame(
        [("4", "North", "Utopia", "Nowhere", "x")],
        "sales_territory_key string, region string, country string, continent string, extra string",
    )
    assert staged("territories", raw).columns == ["sales_territory_key", "region", "country", "continent"]
