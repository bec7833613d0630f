"""Series fill and sales report on the shipped fixtures (FIXTURES.md §2)."""

import datetime as dt

from conftest import rows
from plover.operators import report as RP
from plover.operators import series as SR

PRICES = [("2019-09-25", "23.23"), ("2019-09-26", "32.54"), ("2019-09-27", "34.55"), ("2019-09-28", "null"),
          ("2019-09-29", "null"), ("2019-09-30", "54.22"), ("2019-10-01", "null"), ("2019-10-02", "null"),
          ("2019-10-03", "null"), ("2019-10-04", "null"), ("2019-10-05", "null"), ("2019-10-06", "null"),
          ("2019-10-07", "null"), ("2019-10-08", "33.80"), ("2019-10-09", "33.83")]


def _series(spark):
    df = spark.createDataFrame(PRICES, "price_date string, price string")
    # the text 'null' marks a missing price; try_cast keeps ANSI mode happy
    return df.selectExpr("cast(price_date as date) price_date", "try_cast(nullif(price, 'null') as double) price")


def _expected():
    exp = {}
    for d, p in PRICES:
        exp[dt.date.fromisoformat(d)] = float(p) if p != "null" else None
    for d in ("2019-09-28", "2019-09-29"):
        exp[dt.date.fromisoformat(d)] = 34.55
    for i in range(1, 8):
        exp[dt.date(2019, 10, i)] = 54.22
    return sorted(exp.items())


def test_forward_fill_golden(spark):
    got = rows(SR.forward_fill(_series(spark), "price_date", "price", bucket_days=3), "price_date", "price")
    assert got == _expected()


def test_range_join_fill_golden(spark):
    out = SR.fill_by_range_join(_series(spark), "price_date", "price", bucket_days=3, ordered=True)
    assert [r["price_date"] for r in out.collect()] == [d for d, _ in _expected()]
    got = rows(out, "price_date", "price")
    assert got == _expected()


def test_range_join_drops_tail(spark):
    df = spark.createDataFrame([("2020-01-01", 1.0), ("2020-01-02", None), ("2020-01-03", 2.0),
                                ("2020-01-04", None)], "d string, v double").selectExpr("cast(d as date) d", "v")
    assert len(rows(SR.fill_by_range_join(df, "d", "v"))) == 3
    assert rows(SR.forward_fill(df, "d", "v"), "v") == [(1.0,), (1.0,), (2.0,), (2.0,)]


SHOP = [("a", 1, 150), ("a", 1, 150), ("a", 2, 1100), ("a", 3, 100), ("b", 1, 200), ("b", 2, 200),
        ("b", 3, 300), ("c", 1, 100), ("c", 2, 100), ("c", 3, 100)]


def test_sales_report_golden(spark):
    sales = spark.createDataFrame(SHOP, "shop string, month int, sale int")
    region = spark.createDataFrame([("a", "湖北"), ("b", "湖北"), ("c", "陕西")], "shop string, province string")
    got = rows(RP.sales_report(sales, region), "shop", "month", "province", "sale_cnt", "province_sale",
               "shop_account_cnt")
    assert got == [("a", 1, "湖北", 300, 500, 300), ("a", 2, "湖北", 1100, 1300, 1400), ("a", 3, "湖北", 100, 400, 1500),
                   ("b", 1, "湖北", 200, 500, 200), ("b", 2, "湖北", 200, 1300, 400), ("b", 3, "湖北", 300, 400, 700),
                   ("c", 1, "陕西", 100, 100, 100), ("c", 2, "陕西", 100, 100, 200), ("c", 3, "陕西", 100, 100, 300)]
