"""Sources, sinks, upsert, quality checks and report links as registered queries.

The storage queries write to a fresh folder under the shared scratch directory and read it back.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerloom.functions.months import add_months
from ledgerloom.operators import quality
from ledgerloom.operators.changes import changed_products, changed_users
from ledgerloom.operators.links import due_reports, report_links
from ledgerloom.plans.business_health import business_health
from ledgerloom.plans.daily_run import Store, clean_load
from ledgerloom.plans.daily_sales import daily_sales
from ledgerloom.schemas import USER_ACTIONS
from ledgerloom.session import scratch_path, staged
from ledgerloom.sources.extracts import read_extract, write_extract
from ledgerloom.sources.samples import SampleTables, sample_warehouse
from ledgerloom.sources.tables import append_clean, overwrite, read_table, stored, upsert
from verification.cleaning_queries import clean_sql, cleaned, named
from verification.dirty import EXTRACTS
from verification.oracles import ONE_DAY, ORDER_LINES, daily_sales_sql, health_sql, with_views
from verification.shape import plain

DAY = date.fromisoformat(ONE_DAY)
NEW_YEAR = date(2001, 1, 1)
BASE_URL = "https://reports.example"
PUBLIC_IDS = {2: "aa", 3: "bb", 4: "cc", 5: "dd", 6: "ee", 7: "ff", 8: "gg", 9: "hh"}

QUERIES, ORACLES = {}, {}


def register(name, sql=None):
    def wrap(build):
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


# --- files -------------------------------------------------------------------------------------------

_ACTIONS = with_views(("raw_rows", named(EXTRACTS["user_actions"])), final="SELECT * FROM raw_rows")


@register(
    "extract_write_and_read",
    f"""SELECT CAST(action_id AS VARCHAR) AS action_id, user_id, nullif(session_id, '') AS session_id, action_type,
 nullif(action_time, '') AS action_time, product_id, stay_duration_seconds,
 nullif(is_abnormal, '') AS is_abnormal, abnormal_reason FROM ({_ACTIONS})""",
)
def _extract(spark, sf_dir):
    t = SampleTables(spark, sf_dir)
    root = scratch_path(spark, "extracts")
    write_extract(t.sql(EXTRACTS["user_actions"]), root, "user_actions", DAY)
    back = read_extract(spark, root, "user_actions", DAY)
    return back.select(
        "action_id",
        "user_id",
        F.nullif("session_id", F.lit("")).alias("session_id"),
        "action_type",
        F.nullif("action_time", F.lit("")).alias("action_time"),
        "product_id",
        "stay_duration_seconds",
        F.nullif("is_abnormal", F.lit("")).alias("is_abnormal"),
        "abnormal_reason",
    )


_STORED_ACTIONS = f"SELECT *, CAST(action_time AS DATE) AS event_date FROM ({clean_sql('user_actions')})"


def _store_actions(spark, sf_dir) -> str:
    """Two appends, as on two days, into folders by event date."""
    path = scratch_path(spark, "actions")
    actions = cleaned(SampleTables(spark, sf_dir), "user_actions").rows
    early = F.col("action_time") < F.lit("2024-01-16").cast("timestamp")
    append_clean(actions.filter(early), path, USER_ACTIONS)
    append_clean(actions.filter(~early), path, USER_ACTIONS)
    return path


@register("stored_fact_append", _STORED_ACTIONS)
def _append(spark, sf_dir):
    return read_table(spark, _store_actions(spark, sf_dir))


@register(
    "stored_fact_pruned_read",
    f"""SELECT event_date, action_type, count(*) AS n FROM ({_STORED_ACTIONS})
WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY 1, 2""",
)
def _pruned(spark, sf_dir):
    rows = read_table(spark, _store_actions(spark, sf_dir))
    rows = rows.filter(F.col("event_date").between(date(2024, 1, 10), date(2024, 1, 20)))
    return rows.groupBy("event_date", "action_type").agg(F.count(F.lit(1)).alias("n"))


@register("table_overwrite", health_sql("WHERE stat_date >= DATE '2000-01-01'"))
def _overwrite(spark, sf_dir):
    path = scratch_path(spark, "health")
    health = business_health(sample_warehouse(spark, sf_dir))
    overwrite(health.filter(F.col("stat_date") < F.lit(date(2000, 1, 1))), path)
    overwrite(health.filter(F.col("stat_date") >= F.lit(date(2000, 1, 1))), path)
    return stored(spark, path)


@register("table_upsert", daily_sales_sql())
def _upsert(spark, sf_dir):
    """Wrong figures for one year and no rows after it; the upserts put right and add."""
    path = scratch_path(spark, "daily-sales")
    keys = ["stat_date", "merchant_id", "category_id"]
    # yearly folders keep the number of folders small
    # the three upserts take their rows from one computation
    sales = staged(daily_sales(sample_warehouse(spark, sf_dir)).select(F.year("stat_date").alias("stat_year"), "*"), "sales")
    wrong = sales.filter("stat_year <= 1998").withColumn(
        "sales_amount", F.when(F.col("stat_year") == 1998, F.lit(-1).cast("decimal(20,2)")).otherwise(F.col("sales_amount"))
    )
    upsert(wrong, path, ["stat_year", *keys])
    upsert(sales.filter("stat_year >= 1998"), path, ["stat_year", *keys])
    # a rerun changes nothing
    upsert(sales.filter("stat_year = 2000"), path, ["stat_year", *keys])
    return stored(spark, path).select(*[c for c in sales.columns if c != "stat_year"])


@register(
    "load_without_good_rows",
    "SELECT 'users' AS table_name, 'not_null' AS rule, 'user_id' AS column_name, count(*) AS n, 0 AS stored_rows FROM customer",
)
def _bad_load(spark, sf_dir):
    """A load in which every row is refused still leaves its refused rows."""
    root, store = scratch_path(spark, "extracts"), Store(spark, scratch_path(spark, "store"))
    users = SampleTables(spark, sf_dir).sql(EXTRACTS["users"]).withColumn("user_id", F.lit(" "))
    write_extract(users, root, "users", DAY)
    good = clean_load(spark, root, store, "users", DAY)
    refused = store.get("rejected_rows").groupBy("table_name", "rule", "column_name").agg(F.count(F.lit(1)).alias("n"))
    return refused.withColumn("stored_rows", F.lit(good))


@register(
    "load_repeated",
    f"""SELECT day AS load_date, count(*) AS n, count(DISTINCT user_id) AS ids FROM ({clean_sql("users")}),
(SELECT DATE '{ONE_DAY}' AS day UNION ALL SELECT DATE '{ONE_DAY}' + 1) GROUP BY 1""",
)
def _load_twice(spark, sf_dir):
    """The first day's load runs twice and is stored once; the same extract of the next day gets new ids; a third load is repeated
    without any good row, and nothing of it stays."""
    root, store = scratch_path(spark, "extracts"), Store(spark, scratch_path(spark, "store"))
    users = SampleTables(spark, sf_dir).sql(EXTRACTS["users"])
    for day in (DAY, DAY + timedelta(days=1)):
        write_extract(users, root, "users", day)
    write_extract(users, root, "users", DAY + timedelta(days=2))
    for day in (DAY, DAY, DAY + timedelta(days=1), DAY + timedelta(days=2)):
        clean_load(spark, root, store, "users", day)
    again = scratch_path(spark, "extracts")
    write_extract(users.withColumn("user_id", F.lit(" ")), again, "users", DAY + timedelta(days=2))
    clean_load(spark, again, store, "users", DAY + timedelta(days=2))
    loads = store.get("dwd_users").groupBy("load_date")
    return loads.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("ids"))


# --- changed entities --------------------------------------------------------------------------------

_D = f"DATE '{ONE_DAY}' - 30"


@register(
    "changed_users",
    with_views(
        final=f"""SELECT user_id FROM users WHERE updated_time >= {_D} UNION SELECT user_id FROM dwd_orders WHERE order_time >= {_D}
UNION SELECT user_id FROM returns WHERE apply_time >= {_D} UNION SELECT user_id FROM user_actions WHERE action_time >= {_D}"""
    ),
)
def _changed_users(spark, sf_dir):
    return changed_users(sample_warehouse(spark, sf_dir), DAY)


@register(
    "changed_products",
    with_views(
        ORDER_LINES,
        final=f"""SELECT product_id FROM dim_products WHERE updated_time >= {_D}
UNION SELECT product_id FROM dwd_orders WHERE order_time >= {_D}
UNION SELECT o.product_id FROM returns r JOIN order_lines o ON r.order_id = o.order_id WHERE r.apply_time >= {_D}""",
    ),
)
def _changed_products(spark, sf_dir):
    return changed_products(sample_warehouse(spark, sf_dir), DAY)


# --- quality -----------------------------------------------------------------------------------------


@register(
    "quality_orphans",
    """SELECT event_id, user_id FROM events WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id * 40)""",
)
def _orphans(spark, sf_dir):
    t = SampleTables(spark, sf_dir)
    # keys stretched so that some of them have no parent
    events = t["events"].select("event_id", "user_id", (F.col("user_id") * 40).alias("key"))
    return quality.orphans(events, "key", t["customer"], "c_custkey").select("event_id", "user_id")


@register(
    "quality_missing_cells",
    with_views(
        final="""SELECT 'promotion_id' AS column_name, count(*) AS missing FROM dwd_orders WHERE promotion_id IS NULL
UNION ALL SELECT 'shipping_time', count(*) FROM dwd_orders WHERE shipping_time IS NULL
UNION ALL SELECT 'user_id', count(*) FROM dwd_orders WHERE user_id IS NULL"""
    ),
)
def _missing(spark, sf_dir):
    return quality.missing_cells(sample_warehouse(spark, sf_dir).orders, ["promotion_id", "shipping_time", "user_id"])


@register(
    "quality_repeated_keys",
    """SELECT concat(l_orderkey, '-', l_linenumber) AS line_id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
)
def _repeated(spark, sf_dir):
    t = SampleTables(spark, sf_dir)
    return quality.repeated_keys(t.sql("SELECT concat(l_orderkey, '-', l_linenumber) AS line_id FROM {lineitem}"), "line_id")


_PADDED = "CASE WHEN refund_amount > 50000 THEN refund_amount + 1 ELSE refund_amount END"


@register(
    "quality_refund_rules",
    with_views(
        (
            "padded",
            f"""SELECT return_id, order_id, {_PADDED} AS refund_amount,
 CASE WHEN rejected_time IS NULL THEN apply_time ELSE apply_time - INTERVAL 9 DAY END AS apply_time FROM returns""",
        ),
        ("joined", "SELECT p.*, o.order_amount, o.order_time FROM padded p JOIN dwd_orders o ON o.order_id = p.order_id"),
        final="""SELECT return_id, order_id, 'refund_above_amount' AS rule FROM joined WHERE refund_amount > order_amount
UNION ALL SELECT return_id, order_id, 'return_before_order' FROM joined WHERE apply_time <= order_time""",
    ),
)
def _refunds(spark, sf_dir):
    from dataclasses import replace

    wh = sample_warehouse(spark, sf_dir)
    early = F.col("apply_time") - F.expr("INTERVAL 9 DAY")
    bent = wh.returns.withColumn("refund_amount", F.expr(_PADDED)).withColumn(
        "apply_time", F.when(F.col("rejected_time").isNull(), F.col("apply_time")).otherwise(early)
    )
    return quality.refund_violations(replace(wh, returns=bent))


@register(
    "quality_time_order",
    """SELECT l_orderkey, l_partkey, l_extendedprice, o_orderdate, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate < o_orderdate""",
)
def _time_order(spark, sf_dir):
    t = SampleTables(spark, sf_dir)
    pairs = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    keyed = pairs.select(
        F.struct("l_orderkey", "l_partkey", "l_extendedprice").alias("order_id"),
        F.col("o_orderdate").alias("order_time"),
        "l_shipdate",
    )
    found = quality.order_time_violations(keyed, "l_shipdate")
    return found.select("order_id.*", F.col("order_time").alias("o_orderdate"), "l_shipdate")


@register(
    "quality_alerts",
    with_views(
        final=f"""SELECT * FROM (SELECT 'referential_integrity' AS check_type, 'returns without order' AS problem_description,
 (SELECT count(*) FROM returns WHERE order_id NOT IN (SELECT order_id FROM dwd_orders)) AS problem_count, 'critical' AS severity
UNION ALL SELECT 'missing_values', 'orders without user', (SELECT count(*) FROM dwd_orders WHERE user_id IS NULL), 'high'
UNION ALL SELECT 'missing_values', 'orders without order id', (SELECT count(*) FROM dwd_orders WHERE order_id IS NULL), 'critical'
UNION ALL SELECT 'duplicates', 'order ids stored twice',
 (SELECT count(*) FROM (SELECT order_id FROM dwd_orders GROUP BY 1 HAVING count(*) > 1)), 'critical'
UNION ALL SELECT 'duplicates', 'return ids stored twice',
 (SELECT count(*) FROM (SELECT return_id FROM returns GROUP BY 1 HAVING count(*) > 1)), 'critical'
UNION ALL SELECT 'outliers', 'refunds that break a rule', (SELECT count(*) FROM returns r JOIN dwd_orders o
 ON r.order_id = o.order_id WHERE r.refund_amount > o.order_amount OR r.apply_time <= o.order_time), 'medium'
UNION ALL SELECT 'outliers', 'orders shipped before they were placed',
 (SELECT count(*) FROM dwd_orders WHERE shipping_time < order_time), 'low') WHERE problem_count > 0
UNION ALL SELECT 'run', 'orders checked', (SELECT count(*) FROM dwd_orders), 'low'"""
    ),
)
def _alerts(spark, sf_dir):
    wh = sample_warehouse(spark, sf_dir)
    alerts = quality.warehouse_alerts(wh, DAY).unionByName(quality.alert("run", "orders checked", wh.orders, "low", DAY))
    return alerts.select("check_type", "problem_description", "problem_count", "severity")


# --- report links ------------------------------------------------------------------------------------


def _links_sql(day: str, year: str, first_of_month: bool, first_of_year: bool) -> str:
    def entity(table, key, name, dashboard, period):
        return f"""SELECT '{name}' AS report, {key} AS entity_id, DATE '{day}' AS create_date,
 '{BASE_URL}/public/dashboard/{PUBLIC_IDS[dashboard]}?id=' || {key} || '&date={period}' AS link FROM {table}"""

    def platform(name, dashboard):
        return f"""SELECT '{name}' AS report, CAST(NULL AS VARCHAR) AS entity_id, DATE '{day}' AS create_date,
 '{BASE_URL}/public/dashboard/{PUBLIC_IDS[dashboard]}?date={day}' AS link"""

    parts = [entity("dim_merchants", "merchant_id", "merchant_daily", 4, day), platform("platform_daily", 7)]
    if first_of_month:
        parts += [
            entity("users", "user_id", "user_monthly", 2, day),
            entity("dim_merchants", "merchant_id", "merchant_monthly", 5, day),
            platform("platform_monthly", 8),
        ]
    if first_of_year:
        parts += [
            entity("users", "user_id", "user_yearly", 3, year),
            entity("dim_merchants", "merchant_id", "merchant_yearly", 6, year),
            platform("platform_yearly", 9),
        ]
    return with_views(final="\nUNION ALL ".join(parts))


@register("report_links_new_year", _links_sql("2001-01-01", "2001", True, True))
def _links_new_year(spark, sf_dir):
    wh = sample_warehouse(spark, sf_dir)
    return report_links(wh.users, wh.merchants, NEW_YEAR, BASE_URL, PUBLIC_IDS)


@register("report_links_plain_day", _links_sql(ONE_DAY, "2000", False, False))
def _links_day(spark, sf_dir):
    wh = sample_warehouse(spark, sf_dir)
    return report_links(wh.users, wh.merchants, DAY, BASE_URL, PUBLIC_IDS)


@register("report_links_upsert", _links_sql("2001-01-01", "2001", True, True))
def _links_upsert(spark, sf_dir):
    """Old links are replaced, a rerun adds nothing."""
    wh = sample_warehouse(spark, sf_dir)
    path, keys = scratch_path(spark, "links"), ["create_date", "report", "entity_id"]
    upsert(report_links(wh.users, wh.merchants, NEW_YEAR, "https://old.example", PUBLIC_IDS), path, keys)
    for _ in range(2):
        upsert(report_links(wh.users, wh.merchants, NEW_YEAR, BASE_URL, PUBLIC_IDS), path, keys)
    return stored(spark, path).select("report", "entity_id", "create_date", "link")


@register(
    "due_reports_by_order_day",
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders,
 2 + CASE WHEN day(o_orderdate) = 1 THEN 3 ELSE 0 END
   + CASE WHEN day(o_orderdate) = 1 AND month(o_orderdate) = 1 THEN 3 ELSE 0 END AS reports
FROM orders GROUP BY o_orderdate""",
)
def _due(spark, sf_dir):
    """How many reports are due on each day that has orders; the calendar rule evaluated per kind of day."""
    plain_day, month_start, year_start = (len(due_reports(d)) for d in (date(2000, 1, 2), add_months(NEW_YEAR, 1), NEW_YEAR))
    first = F.dayofmonth("o_orderdate") == 1
    kind = F.when(first & (F.month("o_orderdate") == 1), year_start).when(first, month_start).otherwise(plain_day)
    orders = SampleTables(spark, sf_dir)["orders"]
    return orders.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("orders")).select(
        F.to_date("o_orderdate").alias("day"), "orders", kind.cast("int").alias("reports")
    )
