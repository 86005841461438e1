"""Rebuild what depends on late or repeated loads: only the days, windows and months that their facts reach.

A load notes the event dates it changes (``operators/load_manifest.py``). A sale of day d reaches the sales of d, the day tables of
the 30 days after it, whose comparisons look back on it, the lifetime counters of every later snapshot, and the reports of the months
that hold any of these. Only days that are built are rebuilt: later ones will see the fact anyway.

Loads of dimensions are not followed; a repeat that gives a product another category or merchant needs ``backfill``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import EVENT_DATE
from ledgerloom.functions.cutoffs import LONGEST_WINDOW, Cutoffs
from ledgerloom.operators.load_manifest import Pending
from ledgerloom.plans.business_health import business_health
from ledgerloom.plans.daily_reports import merchant_daily_snapshot, platform_daily_snapshot
from ledgerloom.plans.daily_run import Store, build_due_reports
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.plans.merchant_daily import merchant_daily
from ledgerloom.plans.merchant_profile import merchant_profile
from ledgerloom.plans.product_summary import product_summary_days
from ledgerloom.plans.user_profile import user_profile
from ledgerloom.schemas import Warehouse
from ledgerloom.session import remove

# Facts each day table reads, and for how many days after its own a fact is looked back on.
SALES, RETURNS, ACTIONS, OPERATIONS = "orders", "returns", "user_actions", "merchant_operations"
REACH = {
    "dws_daily_sales": ((SALES, RETURNS), 0),
    "dws_merchant_daily": ((SALES, RETURNS), LONGEST_WINDOW),
    "dws_business_daily_health": ((SALES, RETURNS, ACTIONS), LONGEST_WINDOW),
}
# Facts whose lifetime counters each snapshot table restates.
LIFETIME = {
    "dws_product_summary": (SALES, RETURNS),
    "dws_merchant_profile": (SALES, RETURNS, OPERATIONS),
    "dws_user_profile": (SALES, RETURNS, ACTIONS),
}


def reached(days: list[date], reach: int, built: list[date]) -> list[date]:
    """The built days that the given days or the ``reach`` days after them are."""
    hit = {day + timedelta(days=n) for day in days for n in range(reach + 1)}
    return [day for day in sorted(built) if day in hit]


def spans(days: list[date]) -> list[tuple[date, date]]:
    """Runs of consecutive days, each to be computed at once; days between the runs stay untouched."""
    runs: list[tuple[date, date]] = []
    for day in days:
        if runs and day - runs[-1][1] == timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def days_of_returns(wh: Warehouse, ordered: list[date]) -> list[date]:
    """Days on which orders of the given days came back: daily sales book the order's amount on the day of the return.

    Orders are read from their days' folders only, returns without a bound, as one may be dated before its order.
    """
    if not ordered:
        return []
    day = F.col(EVENT_DATE) if EVENT_DATE in wh.orders.columns else F.to_date("order_time")
    changed = wh.orders.filter(day.isin(ordered)).select("order_id")
    back = wh.returns.select("order_id", F.to_date("apply_time").alias("day")).join(changed, "order_id", "left_semi")
    return [row[0] for row in back.select("day").distinct().collect()]


def changed_days(pending: Pending, tables: tuple[str, ...]) -> list[date]:
    return sorted({day for table in tables for day in pending.days.get(table, [])})


def built_days(store: Store) -> list[date]:
    """From the first to the last day that any day table holds: a day on which nothing was sold has no folder, but is built."""
    found = sorted({day for name in REACH for day in store.built(name)})
    return [found[0] + timedelta(days=n) for n in range((found[-1] - found[0]).days + 1)] if found else []


def refresh_days(wh: Warehouse, store: Store, pending: Pending, tables: tuple[str, ...] = tuple(REACH)) -> dict[str, list[date]]:
    """Rebuild the reached days of the day tables; gives back which ones, by table.

    A run of days is one pass over its facts, with the 30 days before it from the stored table: they are of no changed day's reach,
    or belong to an earlier run, which is rebuilt first.
    """
    built, rebuilt = built_days(store), {}
    for name in tables:
        facts, reach = REACH[name]
        days = changed_days(pending, facts)
        if name == "dws_daily_sales":
            days = sorted({*days, *days_of_returns(wh, pending.days.get(SALES, []))})
        rebuilt[name] = reached(days, reach, built)
        for first, last in spans(rebuilt[name]):
            store.replace_days(name, day_table(wh, store, name, first, last), [d for d in rebuilt[name] if first <= d <= last])
    return rebuilt


def day_table(wh: Warehouse, store: Store, name: str, first: date, last: date) -> DataFrame:
    if name == "dws_daily_sales":
        return daily_sales(wh, first, last)
    build = merchant_daily if name == "dws_merchant_daily" else business_health
    return build(wh, first, last, history=store.get(name))


def refresh(wh: Warehouse, store: Store) -> dict[str, list[date]]:
    """Bring all built tables up to date with the loads since the last call; gives back the rebuilt days by table.

    Snapshot tables are restated from the first changed day on, as a run on each day would have done (``Cutoffs.on``), the
    product table in one pass, profiles date by date. Reports follow for the months that begin after the first changed
    day. What is pending is forgotten last, so a run that stops is repeated by the next call.
    """
    pending = store.manifest().pending()
    rebuilt, built = refresh_days(wh, store, pending), built_days(store)
    for name, facts in LIFETIME.items():
        changed = changed_days(pending, facts)
        rebuilt[name] = [day for day in built if changed and day >= changed[0]]
    for first, last in spans(rebuilt["dws_product_summary"]):
        days = [d for d in rebuilt["dws_product_summary"] if first <= d <= last]
        store.replace_days("dws_product_summary", product_summary_days(wh, first, last), days)
    days, health = store.get("dws_merchant_daily"), store.get("dws_business_daily_health")
    for day in rebuilt["dws_merchant_profile"]:
        store.replace_days("dws_merchant_profile", merchant_profile(wh, days, Cutoffs.on(day)), [day])
    for day in rebuilt["dws_user_profile"]:
        store.replace_days("dws_user_profile", user_profile(wh, Cutoffs.on(day)), [day])
    profiles = store.get("dws_merchant_profile")
    rebuilt["ads_platform_daily_snapshot"] = rebuilt["dws_business_daily_health"]
    for day in rebuilt["ads_platform_daily_snapshot"]:
        store.replace_days("ads_platform_daily_snapshot", platform_daily_snapshot(health, day), [day])
    rebuilt["ads_merchant_daily_snapshot"] = sorted({*rebuilt["dws_merchant_daily"], *rebuilt["dws_merchant_profile"]})
    for day in rebuilt["ads_merchant_daily_snapshot"]:
        store.replace_days("ads_merchant_daily_snapshot", merchant_daily_snapshot(days, profiles, day), [day])
    first = min((d for found in rebuilt.values() for d in found), default=None)
    for month in store.built("ads_merchant_monthly_snapshot") if first else []:
        if month > first:
            # the one report whose rows can vanish: a promotion without orders of a level any more
            remove(store.spark, f"{store.path('ads_platform_promotion_detail')}/stat_month={month}")
            build_due_reports(wh, store, month)
    store.manifest().done(pending)
    return rebuilt
