"""DuckDB SQL for the model queries, written from the tables' definitions."""

from __future__ import annotations

from ledgerloom.sources.samples import BASE_TABLES, VIEWS

# the day that the one-day forms are run for
ONE_DAY = "2000-06-15"


def view_sql(name: str) -> str:
    text = VIEWS[name]
    for table in [*BASE_TABLES, *VIEWS]:
        text = text.replace("{" + table + "}", table)
    return text


# steps that several others read
SHARED = {"dwd_orders", "order_lines", "span", "merchant_counters", "merchant_daily", "user_profile", "merchant_profile", "user_monthly"}


def with_views(*ctes: tuple[str, str], final: str) -> str:
    """A query over the views and steps; the range of days comes from the facts themselves."""
    steps = {**{name: view_sql(name) for name in VIEWS}, **dict([SPAN]), **dict(ctes)}
    parts = [f"{name} AS {'MATERIALIZED ' if name in SHARED else ''}({text})" for name, text in steps.items()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final


def shaped(sql: str, doubles: str = "", bigints: str = "") -> str:
    """Fix the output types: doubles rounded to 6 digits, counters as BIGINT."""
    items = [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in doubles.split()]
    items += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints.split()]
    if not items:
        return sql
    return f"SELECT * REPLACE ({', '.join(items)}) FROM ({sql}) shaped_rows"


# From the first fact's day to the first of the month after the last fact, so that every fact is in a reported month.
SPAN = (
    "span",
    """SELECT CAST(min(t) AS DATE) AS first_day, CAST(date_trunc('month', max(t)) + INTERVAL 1 MONTH AS DATE) AS last_day,
  CAST(date_trunc('month', min(t)) + INTERVAL 1 MONTH AS DATE) AS first_month, year(min(t)) AS first_year, year(max(t)) AS last_year
FROM (SELECT order_time AS t FROM dwd_orders UNION ALL SELECT apply_time FROM returns UNION ALL SELECT action_time FROM user_actions)""",
)
DAYS = ("days", "SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS stat_date FROM span")
MONTHS = ("months", "SELECT CAST(unnest(generate_series(first_month, last_day, INTERVAL 1 MONTH)) AS DATE) AS m FROM span")

ORDER_LINES = (
    "order_lines",
    """SELECT o.*, CAST(o.order_time AS DATE) AS order_date, p.merchant_id, p.product_category_id AS category_id,
  p.category_name, p.product_name, CAST(date_trunc('month', o.order_time) + INTERVAL 1 MONTH AS DATE) AS label
FROM dwd_orders o JOIN dim_products p ON o.product_id = p.product_id""",
)

# --- daily sales -----------------------------------------------------------------------------------


SALES_MEASURES = (
    "measures",
    """SELECT order_date AS stat_date, merchant_id, category_id, order_amount AS sold, order_id AS sale, user_id AS buyer,
    product_id, NULL::DECIMAL(10,2) AS refunded, NULL::VARCHAR AS refund, NULL::VARCHAR AS refunder FROM order_lines
  UNION ALL
  SELECT CAST(r.apply_time AS DATE), l.merchant_id, l.category_id, NULL, NULL, NULL, NULL, l.order_amount, r.return_id, r.user_id
  FROM order_lines l JOIN returns r ON r.order_id = l.order_id""",
)


def daily_sales_query(day: str | None) -> str:
    """Sold and returned order lines, stacked as measures of a day, merchant and category, counted once."""
    chosen = f"WHERE stat_date = DATE '{day}'" if day else ""
    return f"""SELECT stat_date, merchant_id, category_id, coalesce(sum(sold), 0) AS sales_amount, count(DISTINCT sale) AS order_count,
  count(DISTINCT buyer) AS customer_count, count(DISTINCT product_id) AS product_count,
  coalesce(sum(refunded), 0) AS return_amount, count(DISTINCT refund) AS return_count,
  count(DISTINCT refunder) AS return_customer_count,
  coalesce(100 * count(DISTINCT refund) / nullif(count(DISTINCT sale), 0), 0) AS return_rate
FROM measures {chosen} GROUP BY stat_date, merchant_id, category_id"""


def daily_sales_sql(day: str | None = None) -> str:
    return shaped(
        with_views(ORDER_LINES, SALES_MEASURES, final=daily_sales_query(day)),
        "sales_amount return_amount return_rate",
        "order_count customer_count product_count return_count return_customer_count",
    )


# --- merchant day table ----------------------------------------------------------------------------

# Every merchant has a row for every day, so a number of days back is a number of rows back.
MERCHANT_DAILY_CTES = [
    ORDER_LINES,
    DAYS,
    (
        "merchant_counters",
        """WITH measures AS (
  SELECT merchant_id, order_date AS stat_date, order_amount AS sold, order_id AS sale, user_id AS buyer, NULL AS refund FROM order_lines
  UNION ALL SELECT merchant_id, CAST(apply_time AS DATE), NULL, NULL, NULL, return_id FROM returns
  UNION ALL SELECT merchant_id, stat_date, NULL, NULL, NULL, NULL FROM (SELECT DISTINCT merchant_id FROM dim_products), days)
SELECT stat_date, merchant_id, coalesce(sum(sold), 0) AS daily_sales, count(DISTINCT sale) AS order_count,
  count(DISTINCT buyer) AS customer_count, count(DISTINCT refund) AS refund_count
FROM measures WHERE merchant_id IN (SELECT merchant_id FROM dim_products) GROUP BY ALL""",
    ),
    (
        "merchant_daily",
        """SELECT stat_date, merchant_id, daily_sales, order_count, customer_count, refund_count,
  100 * CAST(daily_sales - lag(daily_sales) OVER days_back AS DOUBLE) / CAST(nullif(lag(daily_sales) OVER days_back, 0) AS DOUBLE) AS sales_mom,
  100 * CAST(daily_sales - lag(daily_sales, 7) OVER days_back AS DOUBLE) / CAST(nullif(lag(daily_sales, 7) OVER days_back, 0) AS DOUBLE) AS sales_yoy,
  100 * (order_count - lag(order_count) OVER days_back) / nullif(lag(order_count) OVER days_back, 0) AS order_count_mom,
  coalesce(100 * refund_count / nullif(order_count, 0), 0) AS refund_rate,
  coalesce(CAST(daily_sales AS DOUBLE) > avg(CAST(daily_sales AS DOUBLE)) OVER last_thirty
    + 3 * stddev_pop(CAST(daily_sales AS DOUBLE)) OVER last_thirty, FALSE) AS abnormal_sales_flag,
  daily_sales = 0 AS zero_sales_flag
FROM merchant_counters
WINDOW days_back AS (PARTITION BY merchant_id ORDER BY stat_date),
  last_thirty AS (PARTITION BY merchant_id ORDER BY stat_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
    ),
]
MERCHANT_DAILY_DOUBLES = "daily_sales sales_mom sales_yoy order_count_mom refund_rate"
MERCHANT_DAILY_BIGINTS = "order_count customer_count refund_count"


def merchant_daily_sql(where: str = "") -> str:
    return shaped(
        with_views(*MERCHANT_DAILY_CTES, final=f"SELECT * FROM merchant_daily {where}"),
        MERCHANT_DAILY_DOUBLES,
        MERCHANT_DAILY_BIGINTS,
    )


# --- platform health -------------------------------------------------------------------------------

# weight, counter and whether more is worse, for the score. Fixed values.
HEALTH_SCORE = [
    (0.25, "daily_sales", False), (0.20, "active_users", False), (0.20, "conversion_rate", False),
    (0.20, "refund_rate", True), (0.15, "new_users", False),
]


def health_score() -> str:
    terms = []
    for weight, counter, worse in HEALTH_SCORE:
        share = f"CAST({counter} AS DOUBLE) / nullif(usual_{counter} * 1.2, 0)"
        capped = f"CASE WHEN {share} IS NOT NULL THEN least({share}, 1.0) END"
        terms.append(f"{weight} * (1 - {capped})" if worse else f"{weight} * {capped}")
    return " + ".join(terms)


HEALTH_CTES = [
    (
        "health_counters",
        """WITH measures AS (
  SELECT CAST(order_time AS DATE) AS stat_date, order_amount AS sold, order_id AS sale, user_id AS buyer,
    NULL AS refund, NULL AS seen, NULL AS joined FROM dwd_orders
  UNION ALL SELECT CAST(apply_time AS DATE), NULL, NULL, NULL, return_id, NULL, NULL FROM returns
  UNION ALL SELECT CAST(action_time AS DATE), NULL, NULL, NULL, NULL, user_id, CASE WHEN action_type = 'register' THEN user_id END
  FROM user_actions WHERE action_type IN ('register','login','browse','favorite','add_cart','purchase','search'))
SELECT stat_date, sum(sold) AS daily_sales, count(DISTINCT sale) AS daily_orders, nullif(count(DISTINCT seen), 0) AS active_users,
  nullif(count(DISTINCT joined), 0) AS new_users, count(DISTINCT refund) AS refund_count,
  coalesce(count(DISTINCT buyer) / nullif(count(DISTINCT seen), 0), 0) AS conversion_rate,
  count(DISTINCT refund) / count(DISTINCT sale) AS refund_rate, CAST(sum(sold) AS DOUBLE) / count(DISTINCT sale) AS avg_order_amount
FROM measures GROUP BY stat_date HAVING count(sale) > 0""",
    ),
    (
        "health_usual",
        "SELECT *, "
        + ", ".join(
            f"avg({'CAST(daily_sales AS DOUBLE)' if c == 'daily_sales' else c}) OVER before AS usual_{c}" for _, c, _ in HEALTH_SCORE
        )
        + """ FROM health_counters
WINDOW before AS (ORDER BY stat_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
    ),
    (
        "health",
        f"""SELECT stat_date, daily_sales, daily_orders, active_users, new_users, conversion_rate, refund_count,
  refund_rate, avg_order_amount, round({health_score()}, 0) AS health_score, {health_score()} AS health_score_raw,
  coalesce(CAST(daily_sales AS DOUBLE) <= CAST(0.8 AS DOUBLE) * usual_daily_sales, FALSE) AS sales_drop_warning,
  coalesce(conversion_rate <= CAST(0.9 AS DOUBLE) * usual_conversion_rate, FALSE) AS conversion_drop_warning,
  coalesce(refund_rate >= CAST(1.1 AS DOUBLE) * usual_refund_rate, FALSE) AS refund_spike_warning FROM health_usual""",
    ),
]
HEALTH_DOUBLES = "daily_sales conversion_rate refund_rate health_score active_users new_users"
HEALTH_BIGINTS = "daily_orders refund_count"


def health_sql(where: str = "") -> str:
    return shaped(
        with_views(*HEALTH_CTES, final=f"SELECT * FROM health {where}"),
        HEALTH_DOUBLES + " avg_order_amount health_score_raw",
        HEALTH_BIGINTS,
    )


# --- merchant profile ------------------------------------------------------------------------------


def merchant_profile_ctes(dates: str, bounded: bool = True, changed_only: bool = False):
    """``dates`` is SQL giving one DATE column as_of.

    All that happens to a merchant is one list of events with a day; a snapshot folds the events that its date sees, over
    the merchant's life and over the days just before.
    """
    seen = "e.day <= a.as_of" if bounded else "TRUE"
    before = lambda days: f"FILTER (WHERE e.day >= a.as_of - {days} AND e.day < a.as_of)"
    life = f"FILTER (WHERE {seen})"
    touched = """WHERE EXISTS (SELECT 1 FROM merchant_touched t WHERE t.merchant_id = f.merchant_id AND t.day >= f.as_of - 30)"""
    return [
        ("as_ofs", dates),
        (
            "merchant_events",
            """SELECT merchant_id, stat_date AS day, daily_sales AS sales, order_count AS orders, NULL::VARCHAR AS refund, NULL::DOUBLE AS shipped_after,
  NULL::DOUBLE AS answered_after, NULL::INTEGER AS removed FROM merchant_daily
UNION ALL SELECT merchant_id, CAST(apply_time AS DATE), NULL, NULL, return_id, NULL,
  epoch(coalesce(approved_time, rejected_time) - apply_time) // 3600, NULL FROM returns
UNION ALL SELECT merchant_id, order_date, NULL, NULL, NULL, epoch(shipping_time - order_time) // 3600, NULL, NULL FROM order_lines
UNION ALL SELECT merchant_id, CAST(operation_time AS DATE), NULL, NULL, NULL, NULL, NULL, 1 FROM merchant_operations
  WHERE operation_type = 'remove_product'""",
        ),
        (
            "merchant_touched",
            """SELECT merchant_id, stat_date AS day FROM merchant_daily UNION SELECT merchant_id, apply_time FROM returns
UNION SELECT merchant_id, operation_time FROM merchant_operations UNION SELECT merchant_id, updated_time FROM dim_merchants""",
        ),
        (
            "merchant_offer",
            """SELECT merchant_id, count(DISTINCT product_id) AS listed,
  count(DISTINCT product_id) FILTER (WHERE product_status = 'active') AS on_sale FROM dim_products GROUP BY merchant_id""",
        ),
        (
            "merchant_folds",
            f"""SELECT a.as_of, merchant_id, sum(sales) {life} AS sales, sum(orders) {life} AS orders,
  count(DISTINCT refund) {life} AS refunds, avg(shipped_after) {life} AS shipped_after, avg(answered_after) {life} AS answered_after,
  sum(sales) {before(30)} AS sales30, sum(orders) {before(30)} AS orders30, count(DISTINCT refund) {before(30)} AS refunds30,
  avg(CAST(sales AS DOUBLE)) {before(7)} AS mean7, stddev_pop(CAST(sales AS DOUBLE)) {before(7)} AS sigma7,
  count(*) FILTER (WHERE sales = 0 AND e.day >= a.as_of - 7 AND e.day < a.as_of) AS zero_days, sum(removed) {before(1)} AS removed
FROM as_ofs a JOIN merchant_events e ON {seen} OR e.day < a.as_of GROUP BY ALL""",
        ),
        (
            "merchant_profile",
            f"""WITH f AS (SELECT a.as_of, m.*, f.* EXCLUDE (as_of, merchant_id),
    100 - pow(f.refunds / nullif(f.orders, 0) * 100, 2) AS points FROM dim_merchants m CROSS JOIN as_ofs a
  LEFT JOIN merchant_folds f ON f.merchant_id = m.merchant_id AND f.as_of = a.as_of)
SELECT f.as_of AS stat_date, f.merchant_id, CAST(f.register_time AS DATE) AS register_date, f.merchant_name,
  CASE WHEN points >= 80 THEN 'A' WHEN points >= 60 THEN 'B' WHEN points >= 40 THEN 'C' ELSE 'D' END AS merchant_level,
  coalesce(o.listed, 0) AS total_product_count, coalesce(o.on_sale, 0) AS on_sale_product_count,
  coalesce(sales, 0) AS total_sales_amount, coalesce(orders, 0) AS total_order_count, coalesce(refunds, 0) AS total_return_count,
  coalesce(shipped_after, 0) AS avg_response_time_hours_shop, coalesce(answered_after, 0) AS avg_response_time_hours_return,
  coalesce(sales30, 0) AS last_30d_sales_amount, coalesce(orders30, 0) AS last_30d_order_count,
  coalesce(refunds30, 0) AS last_30d_return_count, coalesce(refunds30 / nullif(orders30, 0), 0) AS last_30d_return_rate,
  coalesce(mean7, 0) AS daily_sales_avg_30d, coalesce(sigma7, 0) AS daily_sales_stddev_30d,
  coalesce(zero_days, 0) AS zero_sales_days_7d, coalesce(removed, 0) > 5 AS sudden_offline_flag
FROM f LEFT JOIN merchant_offer o ON o.merchant_id = f.merchant_id {touched if changed_only else ""}""",
        ),
    ]


MONTH_DATES = "SELECT CAST(unnest(generate_series(first_month, last_day, INTERVAL 1 MONTH)) AS DATE) AS as_of FROM span"
DAY_DATE = f"SELECT DATE '{ONE_DAY}' AS as_of"


def merchant_profile_sql(dates: str, bounded: bool, changed_only: bool = False) -> str:
    return shaped(
        with_views(
            *MERCHANT_DAILY_CTES,
            *merchant_profile_ctes(dates, bounded, changed_only),
            final="SELECT * FROM merchant_profile",
        ),
        "total_sales_amount avg_response_time_hours_shop avg_response_time_hours_return last_30d_sales_amount "
        "last_30d_return_rate daily_sales_avg_30d daily_sales_stddev_30d",
        "total_product_count on_sale_product_count total_order_count total_return_count last_30d_order_count "
        "last_30d_return_count zero_sales_days_7d",
    )


# --- product summary -------------------------------------------------------------------------------


def product_summary_sql(changed_only: bool = False, dates: str | None = None, bounded: bool = False) -> str:
    """Sales and returns of a product as one list of events; each date folds what it sees of it."""
    d = f"DATE '{ONE_DAY}'"
    seen = "e.happened < a.as_of + INTERVAL 1 DAY" if bounded else "TRUE"
    week = "e.happened >= a.as_of - INTERVAL 7 DAY AND e.happened < a.as_of"
    touched = f"""WHERE p.updated_time >= {d} - 30 OR p.product_id IN (SELECT product_id FROM product_events WHERE happened >= {d} - 30)"""
    return shaped(
        with_views(
            ("product_dates", dates or DAY_DATE),
            (
                "product_events",
                """SELECT product_id, order_time AS happened, order_id AS sale, order_amount AS amount, NULL::VARCHAR AS refund FROM dwd_orders
UNION ALL SELECT o.product_id, r.apply_time, NULL, NULL, r.return_id FROM returns r JOIN dwd_orders o ON o.order_id = r.order_id""",
            ),
            (
                "product_folds",
                f"""SELECT a.as_of, e.product_id, sum(amount) AS amount, count(DISTINCT sale) AS sales, count(DISTINCT refund) AS refunds,
  count(DISTINCT sale) FILTER (WHERE {week}) AS sales7, count(DISTINCT refund) FILTER (WHERE {week}) AS refunds7
FROM product_dates a JOIN product_events e ON {seen} GROUP BY ALL""",
            ),
            final=f"""SELECT stat_date, product_id, merchant_id, product_name, category_id, category_name, shelf_time, product_status, last_status_change,
  total_sales_amount, total_sales_quantity, current_stock, lasts AS stock_turnover_days, total_return_times,
  coalesce(total_return_times / nullif(total_sales_quantity, 0), 0) AS return_rate, last_7d_sales_quantity, last_7d_return_times,
  coalesce(lasts > 15, FALSE) AS stock_over_15d_flag, coalesce(lasts > 30, FALSE) AS stock_over_30d_flag
FROM (SELECT a.as_of AS stat_date, p.product_id, p.merchant_id, p.product_name, p.product_category_id AS category_id, p.category_name,
    p.listing_time AS shelf_time, p.product_status, p.updated_time AS last_status_change, p.current_stock,
    coalesce(f.amount, 0) AS total_sales_amount, coalesce(f.sales, 0) AS total_sales_quantity, coalesce(f.refunds, 0) AS total_return_times,
    coalesce(f.sales7, 0) AS last_7d_sales_quantity, coalesce(f.refunds7, 0) AS last_7d_return_times,
    p.current_stock * 7::DOUBLE / nullif(f.sales7, 0) AS lasts
  FROM dim_products p CROSS JOIN product_dates a LEFT JOIN product_folds f ON f.product_id = p.product_id AND f.as_of = a.as_of
  {touched if changed_only else ""})""",
        ),
        "total_sales_amount stock_turnover_days return_rate",
        "total_sales_quantity total_return_times last_7d_sales_quantity last_7d_return_times",
    )


# --- user profile ----------------------------------------------------------------------------------


# points for more than so many login days, orders and spent in the last 30 days. Fixed values.
USER_POINTS = [("logins", [(27, 15), (20, 10), (10, 5)]), ("orders30", [(10, 15), (5, 5)]), ("amount30", [(50000, 55), (10000, 30), (1000, 15)])]


def user_points() -> str:
    steps = [(c, " ".join(f"WHEN {c} > {over} THEN {points}" for over, points in levels)) for c, levels in USER_POINTS]
    return " + ".join(f"CASE {step} ELSE 0 END" for _, step in steps)


def user_profile_ctes(dates: str, bounded: bool = True, changed_only: bool = False):
    """Orders, returns and actions of a user as one list of events; each snapshot date folds what it sees of it."""
    seen = "CAST(e.happened AS DATE) <= a.as_of" if bounded else "TRUE"
    new = f"e.happened >= a.as_of - 30 AND {seen}"
    touched = f"""WHERE u.user_id IN (SELECT user_id FROM user_events WHERE happened >= DATE '{ONE_DAY}' - 30
  UNION SELECT user_id FROM users WHERE updated_time >= DATE '{ONE_DAY}' - 30)"""
    return [
        ("user_dates", dates),
        (
            "user_events",
            """SELECT user_id, order_time AS happened, order_id AS sale, order_amount AS amount, product_id, NULL::VARCHAR AS refund, NULL::VARCHAR AS action FROM dwd_orders
UNION ALL SELECT user_id, apply_time, NULL, NULL, NULL, return_id, NULL FROM returns
UNION ALL SELECT user_id, action_time, NULL, NULL, NULL, NULL, action_type FROM user_actions""",
        ),
        (
            "user_folds",
            f"""SELECT a.as_of, user_id, count(DISTINCT sale) AS orders, sum(amount) AS amount, max(happened) FILTER (WHERE sale IS NOT NULL) AS last_order,
  count(DISTINCT refund) AS refunds, count(DISTINCT sale) FILTER (WHERE {new}) AS orders30, coalesce(sum(amount) FILTER (WHERE {new}), 0) AS amount30,
  count(DISTINCT refund) FILTER (WHERE {new}) AS refunds30, count(*) FILTER (WHERE action = 'browse' AND {new}) AS views,
  count(DISTINCT CAST(happened AS DATE)) FILTER (WHERE action = 'login' AND {new}) AS logins
FROM user_dates a JOIN user_events e ON {seen} GROUP BY ALL""",
        ),
        (
            "user_tastes",
            f"""SELECT as_of, user_id, coalesce(string_agg(category_name, ',' ORDER BY n DESC, category_name) FILTER (WHERE n > 5),
    (list(category_name ORDER BY n DESC, category_name))[1]) AS names
FROM (SELECT a.as_of, e.user_id, p.category_name, count(*) AS n FROM user_dates a JOIN user_events e ON e.sale IS NOT NULL AND {seen}
  LEFT JOIN dim_products p ON p.product_id = e.product_id GROUP BY ALL) GROUP BY ALL""",
        ),
        (
            "user_profile",
            f"""WITH f AS (SELECT a.as_of, u.user_id, u.created_time, t.names, f.last_order, coalesce(f.orders, 0) AS orders,
    coalesce(f.amount, 0) AS amount, coalesce(f.refunds, 0) AS refunds, coalesce(f.orders30, 0) AS orders30, coalesce(f.amount30, 0) AS amount30,
    coalesce(f.refunds30, 0) AS refunds30, coalesce(f.logins, 0) AS logins, coalesce(f.views, 0) AS views
  FROM users u CROSS JOIN user_dates a LEFT JOIN user_folds f ON f.user_id = u.user_id AND f.as_of = a.as_of
  LEFT JOIN user_tastes t ON t.user_id = u.user_id AND t.as_of = a.as_of {touched if changed_only else ""}),
scored AS (SELECT *, {user_points()} AS score FROM f)
SELECT as_of AS stat_date, user_id, CAST(created_time AS DATE) AS register_date, amount AS total_order_amount,
  orders AS total_order_count, refunds AS total_return_count, last_order AS last_order_date, logins AS last_30d_login_days,
  views AS last_30d_view_cnt, orders30 AS last_30d_order_cnt, amount30 AS last_30d_order_amount, refunds30 AS last_30d_return_cnt,
  coalesce(CAST(amount30 AS DOUBLE) / nullif(orders30, 0), 0) AS avg_order_amount_30d, score AS user_score,
  CASE WHEN score >= 80 THEN '优质' WHEN score >= 60 THEN '高潜质' WHEN score >= 30 THEN '中潜质' ELSE '普通' END AS user_level,
  coalesce(names, '未知') AS preferred_category FROM scored""",
        ),
    ]


def user_profile_sql(dates: str, bounded: bool, changed_only: bool = False) -> str:
    return shaped(
        with_views(*user_profile_ctes(dates, bounded, changed_only), final="SELECT * FROM user_profile"),
        "total_order_amount last_30d_order_amount avg_order_amount_30d",
        "total_order_count total_return_count last_30d_login_days last_30d_view_cnt last_30d_order_cnt last_30d_return_cnt",
    )
