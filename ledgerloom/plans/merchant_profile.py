"""Merchant profile: lifetime and recent counters, response times, service level, alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, is_true, ratio, ratio_or_zero, whole_hours, zero_if_null
from ledgerloom.functions.cutoffs import Cutoffs, in_window
from ledgerloom.operators.fold import fold, running_totals
from ledgerloom.schemas import Warehouse

MONEY = "decimal(24,2)"


def service_level(returns, orders):
    """A-D from 100 minus the squared return percentage, at 80, 60 and 40; D without orders."""
    points = 100 - F.pow(ratio(returns, orders) * 100, F.lit(2))
    return (
        F.when(orders == 0, "D").when(points >= 80, "A").when(points >= 60, "B").when(points >= 40, "C").otherwise("D")
    )


def merchant_profile(
    wh: Warehouse, daily: DataFrame, at: Cutoffs, changed_only: bool = False, carried: DataFrame | None = None
) -> DataFrame:
    """One row per merchant and snapshot date.

    ``daily`` is the merchant day table. ``changed_only`` keeps merchants with a day row, return,
    operation or master-data change in the 30 days before the snapshot. The columns named
    ``daily_sales_*_30d`` cover 7 days; the names are kept from the table's definition. ``carried``
    (``Lifetime.merchants`` after the day) replaces the count over all facts, of which only the 30 days are read then.
    """
    c = F.col
    if carried is not None and not at.single:
        raise ValueError("the incremental form works on one date")
    since = None if carried is None else at.lower(30)
    if carried is not None:
        daily = daily.filter(c("stat_date") >= F.lit(since))
    day_of = {"returns": F.to_date("apply_time"), "operations": F.to_date("operation_time")}

    members = at.grid(
        wh.merchants.select(
            "merchant_id",
            F.to_date("register_time").alias("register_date"),
            "merchant_name",
            F.lit(True).alias("member"),
            "updated_time",
        )
    ).withColumn("touched", F.to_date("updated_time") >= F.date_sub("as_of", 30))
    assortment = at.grid(
        wh.products.groupBy("merchant_id").agg(
            F.count("product_id").alias("total_product_count"),
            F.count_if(c("product_status") == "active").alias("on_sale_product_count"),
        )
    )
    trading = at.spread(daily.select("merchant_id", "stat_date", "daily_sales", "order_count"), c("stat_date"))
    trading = trading.select(
        "merchant_id",
        "as_of",
        F.when(c("is_new"), c("daily_sales")).alias("life_sales"),
        F.when(c("is_new"), c("order_count")).alias("life_orders"),
        F.when(in_window(c("stat_date"), 30), c("daily_sales")).alias("recent_sales"),
        F.when(in_window(c("stat_date"), 30), c("order_count")).alias("recent_orders"),
        F.when(in_window(c("stat_date"), 7), c("daily_sales").cast("double")).alias("week_sales"),
        (c("stat_date") >= F.date_sub("as_of", 30)).alias("touched"),
    )
    hours = F.when(
        c("approved_time").isNotNull(), whole_hours(c("apply_time"), c("approved_time"))
    ).when(c("rejected_time").isNotNull(), whole_hours(c("apply_time"), c("rejected_time")))
    taken_back = at.spread(
        between_days(wh.returns, "apply_time", since, at.upper()).select(
            "merchant_id", "return_id", day_of["returns"].alias("day"), hours.alias("hours")
        ),
        c("day"),
    ).select(
        "merchant_id",
        "as_of",
        F.when(c("is_new"), c("return_id")).alias("life_return"),
        F.when(in_window(c("day"), 30), c("return_id")).alias("recent_return"),
        F.when(c("is_new"), c("hours")).alias("return_hours"),
        (c("day") >= F.date_sub("as_of", 30)).alias("touched"),
    )
    # shipping delay is summed per product before the product's merchant is looked up
    shipped = (
        between_days(wh.orders, "order_time", None, at.upper())
        .filter(c("shipping_time").isNotNull() & c("order_time").isNotNull())
        .select(
            "product_id",
            at.first_seen(F.to_date("order_time")).alias("as_of"),
            whole_hours(c("order_time"), c("shipping_time")).alias("hours"),
        )
        .groupBy("product_id", "as_of")
        .agg(F.sum("hours").alias("ship_hours"), F.count("hours").alias("ship_count"))
        .join(wh.products.select("product_id", "merchant_id"), "product_id")
        .select("merchant_id", "as_of", "ship_hours", "ship_count")
    )
    withdrawn = (
        between_days(wh.operations, "operation_time", at.lower(1), at.last)
        .filter(c("operation_type") == "remove_product")
        .select("merchant_id", F.date_add(day_of["operations"], 1).alias("as_of"), F.lit(1).alias("offline"))
        .filter(at.contains(c("as_of")))
    )
    counted = {
        "total_sales_amount": F.sum("life_sales"),
        "total_order_count": F.sum("life_orders"),
        "total_return_count": F.count("life_return"),
        "return_hours": F.sum("return_hours"),
        "return_answers": F.count("return_hours"),
        "ship_hours": F.sum("ship_hours"),
        "ship_count": F.sum("ship_count"),
    }
    frames = [members, assortment, trading, taken_back, withdrawn]
    if carried is None:
        frames.append(shipped)
    else:
        known = [F.col(m).alias(f"carried_{m}") for m in counted]
        frames.append(at.grid(carried.select("merchant_id", *known)))
        counted = {m: F.max(f"carried_{m}") for m in counted}
    if changed_only:
        operated = at.spread(
            between_days(wh.operations, "operation_time", at.lower(30), None).select(
                "merchant_id", day_of["operations"].alias("day")
            ),
            c("day"),
        )
        frames.append(
            operated.select("merchant_id", "as_of", (c("day") >= F.date_sub("as_of", 30)).alias("touched"))
        )

    folded = fold(
        ["merchant_id", "as_of"],
        {
            "member": F.max("member"),
            "touched": F.max("touched"),
            "register_date": F.max("register_date"),
            "merchant_name": F.max("merchant_name"),
            "total_product_count": F.max("total_product_count"),
            "on_sale_product_count": F.max("on_sale_product_count"),
            **counted,
            "last_30d_sales_amount": F.sum("recent_sales"),
            "last_30d_order_count": F.sum("recent_orders"),
            "last_30d_return_count": F.count("recent_return"),
            "daily_sales_avg_30d": F.avg("week_sales"),
            "daily_sales_stddev_30d": F.stddev_pop("week_sales"),
            "zero_sales_days_7d": F.count_if(c("week_sales") == 0),
            "offline": F.sum("offline"),
        },
        *frames,
    )
    if not at.single:
        lifetime = [
            "total_sales_amount",
            "total_order_count",
            "total_return_count",
            "return_hours",
            "return_answers",
            "ship_hours",
            "ship_count",
        ]
        folded = running_totals(folded, ["merchant_id"], "as_of", lifetime)
    kept = folded.filter(c("member") & c("touched")) if changed_only else folded.filter(c("member"))
    orders, returns = zero_if_null(c("total_order_count")), zero_if_null(c("total_return_count"))
    recent_orders = zero_if_null(c("last_30d_order_count"))
    return kept.select(
        c("as_of").alias("stat_date"),
        "merchant_id",
        "register_date",
        "merchant_name",
        service_level(returns, orders).alias("merchant_level"),
        zero_if_null(c("total_product_count")).alias("total_product_count"),
        zero_if_null(c("on_sale_product_count")).alias("on_sale_product_count"),
        zero_if_null(c("total_sales_amount"), MONEY).cast(MONEY).alias("total_sales_amount"),
        orders.alias("total_order_count"),
        returns.alias("total_return_count"),
        ratio_or_zero(c("ship_hours"), c("ship_count")).alias("avg_response_time_hours_shop"),
        ratio_or_zero(c("return_hours"), c("return_answers")).alias("avg_response_time_hours_return"),
        zero_if_null(c("last_30d_sales_amount"), MONEY).cast(MONEY).alias("last_30d_sales_amount"),
        recent_orders.alias("last_30d_order_count"),
        zero_if_null(c("last_30d_return_count")).alias("last_30d_return_count"),
        ratio_or_zero(c("last_30d_return_count"), recent_orders).alias("last_30d_return_rate"),
        F.coalesce("daily_sales_avg_30d", F.lit(0.0)).alias("daily_sales_avg_30d"),
        F.coalesce("daily_sales_stddev_30d", F.lit(0.0)).alias("daily_sales_stddev_30d"),
        zero_if_null(c("zero_sales_days_7d")).alias("zero_sales_days_7d"),
        is_true(c("offline") > 5).alias("sudden_offline_flag"),
    )
