"""Cumulative sales report (W33)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sales_report(sales: DataFrame, shop_region: DataFrame, shop: str = "shop", month: str = "month",
                 sale: str = "sale", province: str = "province") -> DataFrame:
    """Per shop and month: sales, running total of the shop, and the total
    of the shop's province in that month.

    One aggregate to (shop, month) – partial, before the shuffle. The
    running total is a window per shop over its months (one row per
    month). The province total is summed from the shop-month rows by a
    second aggregate and joined back, rather than a window per province,
    so a province with a very large share of the shops is combined
    map-side instead of held in one task.
    """
    x = (sales.join(shop_region.select(shop, province), shop)
         .groupBy(shop, month).agg(F.max(province).alias("province"), F.sum(sale).alias("sale_cnt")))
    run = Window.partitionBy(shop).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    reg = x.groupBy("province", month).agg(F.sum("sale_cnt").alias("province_sale"))
    return (x.join(reg, ["province", month])
            .select(shop, month, "province", "sale_cnt", "province_sale",
                    F.sum("sale_cnt").over(run).alias("shop_account_cnt")))
