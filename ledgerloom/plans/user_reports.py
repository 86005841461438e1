"""Monthly and yearly user reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import ordered_text, ratio, ratio_or_zero, zero_if_null
from ledgerloom.functions.months import ReportMonths, add_months
from ledgerloom.operators.latest import latest_snapshot
from ledgerloom.schemas import Warehouse

MONEY = "decimal(28,2)"
TOP_CATEGORIES = 5

# Labels.
STAGE_NEW, STAGE_SHRINKING, STAGE_ACTIVE, STAGE_LOST, STAGE_PLAIN, STAGE_SLEEPING = (
    "新客",
    "消费降级（预沉睡）",
    "活跃",
    "流失",
    "无明显特征",
    "沉睡",
)
RISK_RETURNS, RISK_BRUSHING, NORMAL = "异常退货", "刷单嫌疑", "正常"
HIGH_RISK, TOP_RISK = "高风险", "超级高风险"
LEVEL_TOP, LEVEL_HIGH, LEVEL_MID, LEVEL_PLAIN = "优质", "高潜质", "中潜质", "普通"
YEAR_TOP, YEAR_HIGH, YEAR_MID, YEAR_PLAIN = "年度优质用户", "年度高潜质用户", "年度潜质用户", "普通用户"
UNKNOWN_CATEGORY = "未知"


def brushing_suspects(wh: Warehouse, months: ReportMonths) -> DataFrame:
    """Users with more than 10 orders in a day, or 50 in a month, at one merchant, with the months they did so.

    Only such users go into the last grouping, whose lists are bounded by the report months.
    """
    c = F.col
    return (
        months.measured(wh.orders, "order_time")
        .filter(c("user_id").isNotNull())
        .select(months.label(c("order_time")), "user_id", "product_id", "order_id", F.to_date("order_time").alias("order_date"))
        .join(wh.products.select("product_id", "merchant_id"), "product_id", "left")
        .groupBy("stat_month", "user_id", "merchant_id", "order_date")
        .agg(F.count("order_id").alias("orders"))
        .groupBy("stat_month", "user_id", "merchant_id")
        .agg(F.max("orders").alias("busiest_day"), F.sum("orders").alias("month_orders"))
        # an unknown merchant has day counts but no month of its own
        .filter((c("busiest_day") > 10) | ((c("month_orders") > 50) & c("merchant_id").isNotNull()))
        .groupBy("user_id")
        .agg(F.collect_set("stat_month").alias("suspect_months"))
    )


def user_monthly(
    wh: Warehouse, profile: DataFrame, months: ReportMonths, history: DataFrame | None = None
) -> DataFrame:
    """Month counters from the newest profile at each label date, running totals, lifecycle and risk.

    Running totals continue the previous month's row: ``history`` supplies the month before the first,
    later months continue the ones computed here.
    """
    c = F.col
    counters = {
        "last_30d_login_days": "month_login_days",
        "last_30d_view_cnt": "month_view_cnt",
        "last_30d_order_cnt": "month_order_cnt",
        "last_30d_order_amount": "month_order_amount",
        "last_30d_return_cnt": "month_return_cnt",
    }
    base = latest_snapshot(
        profile, "user_id", ["register_date", "user_level", "preferred_category", *counters], months
    ).withColumnsRenamed(counters)
    carried = ["total_order_amount", "total_order_count", "total_return_count", "previous_orders"]
    if history is not None:
        before = history.filter(c("stat_month") == F.lit(add_months(months.first, -1))).select(
            "user_id",
            F.lit(months.first).alias("stat_month"),
            "total_order_amount",
            "total_order_count",
            "total_return_count",
            c("month_order_cnt").alias("previous_orders"),
        )
        base = base.join(before, ["user_id", "stat_month"], "left")
    else:
        base = base.withColumns({name: F.lit(None).cast("bigint") for name in carried})

    by_month = Window.partitionBy("user_id").orderBy("stat_month")
    upto = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def continued(total: str, month: str) -> Column:
        earlier = F.max(total).over(upto)
        return F.sum(month).over(upto) + F.coalesce(earlier, F.lit(0))

    consecutive = F.lag("stat_month").over(by_month) == F.add_months("stat_month", -1)
    previous = F.coalesce(F.when(consecutive, F.lag("month_order_cnt").over(by_month)), c("previous_orders"))
    totals = base.select(
        "user_id",
        "stat_month",
        "register_date",
        "user_level",
        "preferred_category",
        *counters.values(),
        continued("total_order_amount", "month_order_amount").cast(MONEY).alias("total_order_amount"),
        continued("total_order_count", "month_order_cnt").alias("total_order_count"),
        continued("total_return_count", "month_return_cnt").alias("total_return_count"),
        previous.alias("previous_orders"),
    )
    stage = (
        F.when(
            (c("register_date") >= c("stat_month")) & (c("register_date") < F.add_months("stat_month", 1)), STAGE_NEW
        )
        .when(
            (c("previous_orders") > 0) & (c("month_order_cnt") < c("previous_orders").cast("double") * 0.3),
            STAGE_SHRINKING,
        )
        .when(c("user_level").isin(LEVEL_TOP, LEVEL_HIGH, LEVEL_MID), STAGE_ACTIVE)
        .when(c("month_order_cnt") == 0, STAGE_LOST)
        .otherwise(STAGE_PLAIN)
    )
    risk = (
        F.when(
            (c("month_return_cnt") >= 50) & (ratio(c("month_return_cnt"), c("month_order_cnt")) > 0.7), RISK_RETURNS
        )
        .when(F.array_contains("suspect_months", c("stat_month")), RISK_BRUSHING)
        .otherwise(NORMAL)
    )
    return (
        totals.join(wh.users.select("user_id", "user_name"), "user_id", "left")
        .join(brushing_suspects(wh, months), "user_id", "left")
        .select(
            "stat_month",
            "user_id",
            "user_name",
            "register_date",
            "user_level",
            "total_order_amount",
            "total_order_count",
            "total_return_count",
            "month_login_days",
            "month_view_cnt",
            "month_order_cnt",
            "month_order_amount",
            "month_return_cnt",
            ratio_or_zero(c("month_order_amount"), c("month_order_cnt")).alias("month_avg_order_amount"),
            "preferred_category",
            stage.alias("lifecycle_stage"),
            risk.alias("risk_flag"),
        )
    )


def annual_level(top: Column, high: Column, mid: Column, plain: Column) -> Column:
    """Level of a year from the number of months at each monthly level."""
    return (
        F.when((top >= 9) & (mid + plain == 0), YEAR_TOP)
        .when((top + high >= 9) & (plain == 0), YEAR_HIGH)
        .when(top + high + mid >= 9, YEAR_MID)
        .otherwise(YEAR_PLAIN)
    )


def annual_risk(year: Column, registered: Column, risky_months: Column, before: Column, before2: Column) -> Column:
    """Risk of a year: users under watch are judged more strictly the longer they have been flagged.

    ``before`` and ``before2`` are the flags of the two previous years; NULL when there was no row.
    """
    flagged, flagged2 = before.isin(HIGH_RISK, TOP_RISK), before2.isin(HIGH_RISK, TOP_RISK)
    usual = F.when(risky_months > 3, HIGH_RISK).otherwise(NORMAL)
    second_year = F.when(flagged, F.when(risky_months > 1, HIGH_RISK).otherwise(NORMAL)).otherwise(usual)
    later = F.when(flagged & flagged2, F.when(risky_months > 0, TOP_RISK).otherwise(NORMAL)).otherwise(usual)
    return (
        F.when(registered == year, usual)
        .when(registered == year - 1, second_year)
        .when(registered <= year - 2, later)
        .otherwise(NORMAL)
    )


def top_categories(monthly: DataFrame) -> DataFrame:
    """The five categories most often among a user's monthly preferences of a year, as text.

    Each month's list is cut after five entries. A user's categories are bounded by the category list.
    """
    c = F.col
    counts = (
        monthly.filter(c("preferred_category").isNotNull() & (c("preferred_category") != ""))
        .select(
            F.year("stat_month").alias("stat_year"),
            "user_id",
            F.explode(F.slice(F.split("preferred_category", ","), 1, 5)).alias("category"),
        )
        .withColumn("category", F.trim("category"))
        .filter(c("category") != "")
        .groupBy("stat_year", "user_id", "category")
        .agg(F.count(F.lit(1)).alias("months"))
    )
    ranked = counts.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("stat_year", "user_id").orderBy(c("months").desc(), "category")),
    ).filter(c("rank") <= TOP_CATEGORIES)
    return ranked.groupBy("stat_year", "user_id").agg(
        ordered_text(F.collect_list(F.struct("rank", "category")), "category").alias("preferred_category")
    )


def user_yearly(
    wh: Warehouse,
    monthly: DataFrame,
    first_year: int,
    last_year: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Year sums over the months labelled January to December, totals at the next January label, annual
    level, risk with two years of its own history, top categories and lifecycle; one row per user.

    Several years are computed together: the per-user year rows are laid side by side once, and the flags
    follow each other as column expressions. ``history`` supplies the two years before the first.
    """
    c = F.col
    last_year = last_year or first_year
    years = list(range(first_year, last_year + 1))
    inside = monthly.filter(
        (c("stat_month") >= F.lit(date(first_year, 1, 1))) & (c("stat_month") < F.lit(date(last_year + 1, 1, 1)))
    )
    keys = ["user_id", "stat_year"]
    summed = (
        inside.withColumn("stat_year", F.year("stat_month"))
        .groupBy(*keys)
        .agg(
            F.sum("month_login_days").alias("year_login_days"),
            F.sum("month_view_cnt").alias("year_view_cnt"),
            F.sum("month_order_cnt").alias("year_order_cnt"),
            F.sum("month_order_amount").cast(MONEY).alias("year_order_amount"),
            F.sum("month_return_cnt").alias("year_return_cnt"),
            annual_level(
                F.count_if(c("user_level") == LEVEL_TOP),
                F.count_if(c("user_level") == LEVEL_HIGH),
                F.count_if(c("user_level") == LEVEL_MID),
                F.count_if(c("user_level") == LEVEL_PLAIN),
            ).alias("user_level"),
            F.count_if(c("risk_flag") != NORMAL).alias("risky_months"),
            F.sum(F.when(F.month("stat_month") >= 10, c("month_order_cnt"))).alias("last_months_orders"),
        )
    )
    january = F.trunc("stat_month", "year") == c("stat_month")
    totals = monthly.filter(
        january & c("stat_month").between(date(first_year + 1, 1, 1), date(last_year + 1, 1, 1))
    ).select(
        "user_id",
        (F.year("stat_month") - 1).alias("stat_year"),
        "total_order_amount",
        "total_order_count",
        "total_return_count",
    )
    risk_input = summed.groupBy("user_id").agg(
        *[F.max(F.when(c("stat_year") == y, c("risky_months"))).alias(f"risky_{y}") for y in years]
    )
    # the profile's registration date is the day of the user's creation, so its history need not be read
    people = wh.users.select("user_id", "user_name", F.to_date("created_time").alias("register_date"))
    people = people.join(risk_input, "user_id", "left")
    earlier = {first_year - 1: F.lit(None).cast("string"), first_year - 2: F.lit(None).cast("string")}
    if history is not None:
        flags = (
            history.filter(c("stat_year").isin(list(earlier)))
            .groupBy("user_id")
            .agg(*[F.max(F.when(c("stat_year") == y, c("risk_flag"))).alias(f"flag_{y}") for y in earlier])
        )
        people = people.join(flags, "user_id", "left")
    else:
        people = people.withColumns({f"flag_{y}": value for y, value in earlier.items()})

    for y in years:
        computed = annual_risk(
            F.lit(y), F.year("register_date"), zero_if_null(c(f"risky_{y}")), c(f"flag_{y - 1}"), c(f"flag_{y - 2}")
        )
        # a user without months in the year still gets a row, flagged normal
        people = people.withColumn(
            f"flag_{y}", F.when(c(f"risky_{y}").isNotNull(), computed).otherwise(F.lit(NORMAL))
        )
    per_year = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(y).alias("stat_year"),
                    c(f"flag_{y}").alias("risk_flag"),
                )
                for y in years
            ]
        )
    ).alias("y")
    spine = people.select("user_id", "user_name", "register_date", per_year).select("user_id", "user_name", "register_date", "y.*")

    level = c("user_level")
    stage = (
        F.when(zero_if_null(c("last_months_orders")) == 0, STAGE_LOST)
        .when(level.isin(LEVEL_TOP, LEVEL_HIGH), STAGE_ACTIVE)
        .otherwise(STAGE_SLEEPING)
    )
    return (
        spine.join(summed, keys, "left")
        .join(totals, keys, "left")
        .join(top_categories(inside), keys, "left")
        .select(
            "stat_year",
            "user_id",
            "user_name",
            "register_date",
            F.coalesce(level, F.lit(LEVEL_PLAIN)).alias("user_level"),
            zero_if_null(c("total_order_amount"), MONEY).cast(MONEY).alias("total_order_amount"),
            zero_if_null(c("total_order_count")).alias("total_order_count"),
            zero_if_null(c("total_return_count")).alias("total_return_count"),
            zero_if_null(c("year_login_days")).alias("year_login_days"),
            zero_if_null(c("year_view_cnt")).alias("year_view_cnt"),
            zero_if_null(c("year_order_cnt")).alias("year_order_cnt"),
            zero_if_null(c("year_order_amount"), MONEY).cast(MONEY).alias("year_order_amount"),
            zero_if_null(c("year_return_cnt")).alias("year_return_cnt"),
            ratio_or_zero(c("year_order_amount"), c("year_order_cnt")).alias("year_avg_order_amount"),
            F.coalesce("preferred_category", F.lit(UNKNOWN_CATEGORY)).alias("preferred_category"),
            stage.alias("lifecycle_stage"),
            "risk_flag",
        )
    )
