"""Scalar expressions on hand-made edge values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.functions import calendar as cal
from tradewind.functions import retail, text


def one(spark, rows, schema, **columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_cities(spark):
    rows = [("mogi-guacu d'oeste",), ("RIO DE janeiro",), (" são josé 2nd ",), (None,), ("",)]
    got = one(spark, rows, "c string", c=text.clean_city("c"))
    assert [r[0] for r in got] == ["Mogi-Guacu D'Oeste", "Rio De Janeiro", "São José 2nd", "Unknown", ""]


def test_tokens_and_parses(spark):
    rows = [("2020-01-02 03:04:05",), ("NaN",), ("",), (None,), ("soon",)]
    got = one(spark, rows, "t string", t=text.parse_timestamp("t"), v=text.has_value("t"))
    assert got == [(datetime(2020, 1, 2, 3, 4, 5), True), (None, False), (None, False), (None, False), (None, True)]
    got = one(spark, [("1.5",), ("NaN",), ("x",), (None,)], "t string", n=text.parse_number("t"))
    assert [r[0] for r in got] == [1.5, 0.0, 0.0, 0.0]


def test_calendar_edges(spark):
    rows = [("2021-01-03",), ("2020-06-30",), ("2020-07-01",), ("2020-12-31",), (None,)]
    d = F.col("d").cast("date")
    got = one(
        spark, rows, "d string", key=cal.date_key(d), dow=cal.iso_day_of_week(d), week=F.weekofyear(d),
        fy=cal.fiscal_year(d), fq=cal.fiscal_quarter(d), weekend=cal.is_weekend(d),
    )
    assert got == [
        (20210103, 7, 53, 2021, 1, True), (20200630, 2, 27, 2020, 2, False), (20200701, 3, 27, 2021, 3, False),
        (20201231, 4, 53, 2021, 4, False), (None, None, None, None, None, None),
    ]


def test_volume_and_sizes(spark):
    rows = [(1000.0,), (1000.01,), (10000.0,), (50000.0,), (50000.01,), (None,)]
    got = one(spark, rows, "v double", s=retail.size_category("v"), t=retail.size_category_strict("v", F.lit(1.0), F.lit(1.0)))
    assert [r[0] for r in got] == ["Small", "Medium", "Medium", "Large", "Extra Large", "Small"]
    assert got[-1][1] == "Unknown"


def test_delays(spark):
    base = datetime(2020, 1, 10)
    rows = [(base, datetime(2020, 1, 10, 12)), (base, datetime(2020, 1, 4, 23)), (base, datetime(2020, 1, 15)), (base, None)]
    got = one(
        spark, rows, "a timestamp_ntz, b timestamp_ntz", floor=cal.elapsed_days("b", "a"), cal=cal.elapsed_days("b", "a", "calendar"),
        hours=cal.elapsed_hours("b", "a"), down=cal.elapsed_hours("b", "a", "floor"),
    )
    assert got == [(0, 0, 12, 12), (-6, -6, -121, -121), (5, 5, 120, 120), (0, 0, 0, 0)]
    rows = [(-6,), (-5,), (0,), (1,), (5,), (6,)]
    got = one(spark, rows, "d int", c=retail.delivery_category("d"), o=retail.on_time("d"))
    assert [r[0] for r in got] == ["Early", "On Time", "On Time", "Slightly Late", "Slightly Late", "Very Late"]
    assert [r[1] for r in got] == [True, True, True, False, False, False]


def test_half_hour_rounding_differs(spark):
    rows = [(datetime(2020, 1, 1, 10), datetime(2020, 1, 1, 8, 30))]
    got = one(spark, rows, "a timestamp_ntz, b timestamp_ntz", t=cal.elapsed_hours("b", "a"), f=cal.elapsed_hours("b", "a", "floor"))
    assert got == [(-1, -2)]


def test_lifecycle_without_purchase(spark):
    names = ["purchase", "approved", "carrier", "delivered", "estimated"]
    df = spark.createDataFrame([(None,) * 5], ", ".join(f"{n} timestamp_ntz" for n in names))
    row = df.withColumns(retail.fill_lifecycle(*names)).first()
    assert tuple(row) == (
        None, datetime(2018, 1, 1, 2), datetime(2018, 1, 3, 2), datetime(2018, 1, 11), datetime(2018, 1, 16)
    )


def test_reviews_and_ratios(spark):
    rows = [(None,), (0,), (1,), (2,), (3,), (4,), (5,), (6,)]
    got = one(spark, rows, "s int", c=retail.review_category("s"))
    assert [r[0] for r in got] == ["Unknown", "Poor", "Poor", "Poor", "Fair", "Good", "Excellent", "Unknown"]
    got = one(spark, [(3, 2), (3, 0)], "a int, b int", r=retail.safe_ratio("a", "b"), d=retail.safe_ratio("a", "b", "decimal(10,2)"))
    assert got[0][0] == 1.5 and got[1][0] == 0.0 and float(got[1][1]) == 0.0


@pytest.mark.parametrize("state,region", [("SP", "Sudeste"), ("AC", "Norte"), ("BA", "Nordeste"), ("GO", "Centro-Oeste"), ("RS", "Sul"), ("XX", "Unknown")])
def test_regions_agree_with_sql_function(spark, state, region):
    retail.register_sql_functions(spark)
    assert spark.sql(f"SELECT get_brazilian_region('{state}')").first()[0] == region
    assert spark.range(1).select(retail.state_region(F.lit(state))).first()[0] == region
