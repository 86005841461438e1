"""The warehouse's models as registered queries: whole history, and the forms run for one day."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cutoffs import Cutoffs
from ledgerloom.functions.months import ReportMonths, add_months
from ledgerloom.plans.business_health import business_health
from ledgerloom.plans.daily_reports import merchant_daily_snapshot, platform_daily_snapshot
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.plans.merchant_daily import merchant_daily
from ledgerloom.plans.merchant_profile import merchant_profile
from ledgerloom.plans.merchant_reports import merchant_monthly, merchant_yearly
from ledgerloom.plans.platform_reports import platform_monthly, platform_yearly, promotion_detail, retention
from ledgerloom.plans.product_summary import product_summary
from ledgerloom.plans.user_profile import user_profile
from ledgerloom.plans.user_reports import user_monthly, user_yearly
from ledgerloom.session import staged, staged_alone
from ledgerloom.sources.samples import sample_warehouse
from verification import oracles as o
from verification import report_oracles as r
from verification.shape import plain

ONE_DAY = date.fromisoformat(o.ONE_DAY)
STORED = Cutoffs.on(ONE_DAY, open_end=True)


class Models:
    """The model chain over one set of sample tables; every member is a lazy plan, built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.wh = sample_warehouse(spark, sf_dir)

    @cached_property
    def facts_span(self) -> tuple[date, date]:
        """Days of the first and the last fact."""
        wh = self.wh
        times = [wh.orders.select("order_time"), wh.returns.select("apply_time"), wh.actions.select("action_time")]
        stacked = times[0].union(times[1]).union(times[2]).toDF("at")
        first, last = stacked.agg(F.to_date(F.min("at")), F.to_date(F.max("at"))).first()
        return first, last

    @property
    def years(self) -> tuple[int, int]:
        first, last = self.facts_span
        return first.year, last.year

    @property
    def cutoffs(self) -> Cutoffs:
        """The month starts after the first and the last fact, and those between."""
        first, last = self.facts_span
        return Cutoffs.month_starts(add_months(first.replace(day=1), 1), add_months(last.replace(day=1), 1))

    @property
    def months(self) -> ReportMonths:
        return ReportMonths(self.cutoffs.first, self.cutoffs.last)

    @cached_property
    def days(self) -> DataFrame:
        return merchant_daily(self.wh, self.facts_span[0], self.cutoffs.last)

    @cached_property
    def health(self) -> DataFrame:
        return business_health(self.wh)

    @cached_property
    def merchants(self) -> DataFrame:
        return merchant_profile(self.wh, self.days, self.cutoffs)

    @cached_property
    def users(self) -> DataFrame:
        return user_profile(self.wh, self.cutoffs)

    @cached_property
    def snapshots(self) -> DataFrame:
        return merchant_daily_snapshot(self.days, self.merchants)

    @cached_property
    def merchant_months(self) -> DataFrame:
        return merchant_monthly(self.wh, self.snapshots, self.months)

    @cached_property
    def merchant_years(self) -> DataFrame:
        # as the stored table in a daily run: the shuffles of the months are off the disks before the year's customers are counted
        return merchant_yearly(self.wh, staged_alone(self.merchant_months, "merchant-months"), *self.years)

    @cached_property
    def merchant_counters(self) -> DataFrame:
        """The monthly merchant report for the platform's reports, which read its counters alone."""
        return merchant_monthly(self.wh, merchant_daily_snapshot(self.days, self.merchants, lazy=True), self.months)

    @cached_property
    def user_months(self) -> DataFrame:
        return user_monthly(self.wh, self.users, self.months)

    @cached_property
    def user_years(self) -> DataFrame:
        # read by several branches of the report, as the stored table is in a daily run
        return user_yearly(self.wh, staged(self.user_months, "user-months"), *self.years)

    @cached_property
    def platform_months(self) -> DataFrame:
        return self._platform_months(apart=True)

    def _platform_months(self, apart: bool) -> DataFrame:
        daily = platform_daily_snapshot(self.health)
        return platform_monthly(self.wh, daily, self.merchant_counters, self.users, self.months, apart)

    @cached_property
    def platform_years(self) -> DataFrame:
        merchant_years = merchant_yearly(self.wh, self.merchant_counters, *self.years)
        return platform_yearly(self.wh, self._platform_months(apart=False), merchant_years, *self.years)


def _day_with_history(m: Models) -> DataFrame:
    """One day run against the stored 30 days before it, as the daily job does."""
    history = m.days.filter(F.col("stat_date") < F.lit(ONE_DAY))
    return merchant_daily(m.wh, ONE_DAY, history=history)


def _health_with_history(m: Models) -> DataFrame:
    return business_health(
        m.wh, ONE_DAY, ONE_DAY, history=m.health.filter(F.col("stat_date") < F.lit(ONE_DAY))
    )


# name -> (what to compute, SQL)
CHECKED = {
    "dws_daily_sales": (lambda m: daily_sales(m.wh), o.daily_sales_sql()),
    "dws_daily_sales_one_day": (lambda m: daily_sales(m.wh, ONE_DAY, ONE_DAY), o.daily_sales_sql(o.ONE_DAY)),
    "dws_merchant_daily": (lambda m: m.days, o.merchant_daily_sql()),
    "dws_merchant_daily_one_day": (_day_with_history, o.merchant_daily_sql(f"WHERE stat_date = DATE '{o.ONE_DAY}'")),
    "dws_merchant_profile": (lambda m: m.merchants, o.merchant_profile_sql(o.MONTH_DATES, True)),
    "dws_merchant_profile_one_day": (
        lambda m: merchant_profile(m.wh, m.days, STORED),
        o.merchant_profile_sql(o.DAY_DATE, False),
    ),
    "dws_merchant_profile_changed": (
        lambda m: merchant_profile(m.wh, m.days, STORED, changed_only=True),
        o.merchant_profile_sql(o.DAY_DATE, False, True),
    ),
    "dws_product_summary": (lambda m: product_summary(m.wh, ONE_DAY), o.product_summary_sql()),
    "dws_product_summary_changed": (
        lambda m: product_summary(m.wh, ONE_DAY, changed_only=True),
        o.product_summary_sql(True),
    ),
    "dws_user_profile": (lambda m: m.users, o.user_profile_sql(o.MONTH_DATES, True)),
    "dws_user_profile_one_day": (lambda m: user_profile(m.wh, STORED), o.user_profile_sql(o.DAY_DATE, False)),
    "dws_user_profile_changed": (
        lambda m: user_profile(m.wh, STORED, changed_only=True),
        o.user_profile_sql(o.DAY_DATE, False, True),
    ),
    "dws_business_daily_health": (lambda m: m.health, o.health_sql()),
    "dws_business_daily_health_one_day": (
        _health_with_history,
        o.health_sql(f"WHERE stat_date = DATE '{o.ONE_DAY}'"),
    ),
    "ads_merchant_daily_snapshot": (lambda m: m.snapshots, r.merchant_snapshot_sql()),
    "ads_platform_daily_snapshot": (lambda m: platform_daily_snapshot(m.health), r.platform_daily_sql()),
    "ads_merchant_monthly_snapshot": (lambda m: m.merchant_months, r.merchant_monthly_sql()),
    "ads_user_monthly_snapshot": (lambda m: m.user_months, r.user_monthly_sql()),
    "ads_platform_monthly_summary": (lambda m: m.platform_months, r.platform_monthly_sql()),
    "ads_platform_promotion_detail": (lambda m: promotion_detail(m.wh, m.users, m.months), r.promotion_detail_sql()),
    "ads_merchant_yearly_snapshot": (lambda m: m.merchant_years, r.merchant_yearly_sql()),
    "ads_user_yearly_snapshot": (lambda m: m.user_years, r.user_yearly_sql()),
    "ads_platform_yearly_summary": (lambda m: m.platform_years, r.platform_yearly_sql()),
    "user_retention_by_year": (lambda m: retention(m.wh, *m.years), r.retention_sql()),
}


def _bind(build):
    return lambda spark, sf_dir: plain(build(Models(spark, sf_dir)))


QUERIES = {name: _bind(build) for name, (build, _) in CHECKED.items()}
ORACLES = {name: sql for name, (_, sql) in CHECKED.items()}
