"""Work that must not grow faster than the facts: months are laid out after counting, and nothing is expanded on its way to a shuffle."""

import re
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import functions as F

from conftest import SMALL
from ledgerloom.functions.cutoffs import Cutoffs
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.plans.merchant_daily import merchant_daily
from ledgerloom.plans.user_profile import preferred_categories, user_profile
from ledgerloom.sources.samples import sample_warehouse
from test_plans import plan
from verification.compare import difference
from verification.model_queries import QUERIES

AT = Cutoffs.month_starts(date(2000, 1, 1), date(2002, 1, 1))


def shop(spark):
    """Purchases of a user without id, of unknown users and products, with ties, and of categories bought often."""
    wh = sample_warehouse(spark, SMALL)
    products = spark.createDataFrame([("a", "tea"), ("b", "ink"), ("c", "ink"), ("d", "pots"), ("e", None)], "product_id string, category_name string")
    lines = [("u1", "a", 1, 2), ("u1", "b", 3, 2), ("u1", "c", 5, 5), ("u1", "a", 9, 7), ("u1", "d", 9, 6), ("u2", "x", 2, 3), ("u2", "d", 4, 3), ("u2", "e", 11, 9)]
    lines += [(None, "a", 2, 8), ("nobody", "b", 2, 8), ("u1", "b", 12, 1)]
    rows = [(f"{u}-{p}-{m}-{n}", u, p, datetime(2000, m, 1 + 5 * (n % 5), 9)) for u, p, m, times in lines for n in range(times)]
    orders = spark.createDataFrame(rows, "order_id string, user_id string, product_id string, order_time timestamp")
    orders = orders.withColumn("order_amount", F.lit(3).cast("decimal(10,2)"))
    users = spark.createDataFrame([("u1", datetime(1999, 5, 1)), ("u2", datetime(2000, 3, 1)), (None, datetime(2000, 1, 1))], "user_id string, created_time timestamp")
    nothing = {name: getattr(wh, name).filter("user_id < ''") for name in ("returns", "actions")}
    return replace(wh, users=users, products=products, orders=orders, **nothing)


def test_a_preference_is_one_row_for_each_month_with_a_purchase(spark):
    wh = shop(spark)
    months = wh.orders.select("user_id", F.trunc("order_time", "month")).distinct().count()
    # a purchase on the first of a month is seen on that day, others at the next month start
    assert preferred_categories(wh.orders, wh.products, AT).count() <= 2 * months < 25


def test_all_months_at_once_equal_each_month_alone(spark):
    wh = shop(spark)
    many = user_profile(wh, AT).toPandas()
    assert len(many) == 3 * 25
    for day in (date(2000, 1, 1), date(2000, 4, 1), date(2000, 6, 1), date(2000, 10, 1), date(2001, 1, 1), date(2002, 1, 1)):
        alone = user_profile(wh, Cutoffs.on(day)).toPandas()
        assert difference(many[many.stat_date == day].reset_index(drop=True), alone) is None


def test_the_months_of_users_are_not_shuffled_again(spark):
    text = plan(QUERIES["ads_user_monthly_snapshot"](spark, SMALL))
    assert not re.search(r"hashpartitioning\(stat_month#\d+, user_id#\d+, \d+\)|hashpartitioning\(user_id#\d+, stat_month#\d+, \d+\)", text)


def test_days_of_merchants_are_laid_out_behind_all_shuffles(spark):
    text = plan(merchant_daily(sample_warehouse(spark, SMALL), date(1999, 1, 1), date(1999, 12, 31)))
    assert "Exchange" not in text.split("Generate explode")[0]


def test_merchants_without_sales_unknown_ones_and_empty_ids(spark):
    wh = shop(spark)
    products = spark.createDataFrame([("a", "m1"), ("b", "m1"), ("z", "m2"), ("c", None)], "product_id string, merchant_id string")
    returns = spark.createDataFrame([("r1", "m1"), ("r2", "gone"), ("r3", None)], "return_id string, merchant_id string")
    returns = returns.withColumn("apply_time", F.lit(datetime(2000, 1, 3)))
    rows = merchant_daily(replace(wh, products=products, returns=returns), date(2000, 1, 1), date(2000, 1, 31))
    found = {r[0]: r[1:] for r in rows.groupBy("merchant_id").agg(F.count("*"), F.sum("order_count"), F.sum("refund_count")).collect()}
    assert found == {"m1": (31, 2, 1), "m2": (31, 0, 0), None: (31, 0, 0)}


def test_daily_sales_count_products_without_an_expand(spark):
    wh = shop(spark)
    # a product that is listed twice still counts once
    products = spark.createDataFrame([("a", "m1"), ("b", "m1"), ("b", "m1"), ("d", None)], "product_id string, merchant_id string")
    products = products.withColumn("product_category_id", F.lit("k"))
    returns = spark.createDataFrame([], "return_id string, order_id string, user_id string, apply_time timestamp")
    wh = replace(wh, products=products, returns=returns)
    sales = daily_sales(wh)
    assert "Expand" not in plan(sales)
    expected = (
        wh.orders.join(products, "product_id")
        .groupBy(F.to_date("order_time").alias("stat_date"), "merchant_id", F.col("product_category_id").alias("category_id"))
        .agg(F.count("order_id").alias("order_count"), F.countDistinct("user_id").alias("customer_count"), F.countDistinct("product_id").alias("product_count"))
    )
    assert difference(sales.select(*expected.columns).toPandas(), expected.toPandas()) is None


def test_touched_users_are_picked_from_counted_rows(spark):
    """Many touched users cannot be broadcast; facts are then counted by user, not sorted to drop those of others."""
    wh = shop(spark)
    orders = wh.orders.unionByName(wh.orders.limit(1).withColumns({"user_id": F.lit("u3"), "order_time": F.lit(datetime(1990, 1, 1))}))
    users = wh.users.unionByName(spark.createDataFrame([("u3", datetime(1990, 1, 1))], wh.users.schema))
    wh = replace(wh, orders=orders, users=users.withColumn("updated_time", F.col("created_time")))
    at = Cutoffs.on(date(2000, 12, 1), open_end=True)
    changed = user_profile(wh, at, changed_only=True)
    assert changed._jdf.queryExecution().analyzed().toString().count("LeftSemi") == 1
    every = user_profile(wh, at).filter("user_id <> 'u3'")
    assert {r.user_id for r in changed.select("user_id").collect()} == {"u1", "u2"}
    assert difference(changed.toPandas(), every.toPandas()) is None
