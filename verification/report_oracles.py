"""DuckDB SQL for the report queries, written from the tables' definitions."""

from __future__ import annotations

from verification.oracles import (
    HEALTH_BIGINTS,
    HEALTH_CTES,
    HEALTH_DOUBLES,
    MERCHANT_DAILY_BIGINTS,
    MERCHANT_DAILY_CTES,
    MERCHANT_DAILY_DOUBLES,
    MONTH_DATES,
    MONTHS,
    ORDER_LINES,
    merchant_profile_ctes,
    shaped,
    user_profile_ctes,
    with_views,
)

SNAPSHOT = (
    "merchant_snapshot",
    """SELECT d.stat_date, d.merchant_id, p.merchant_name, p.merchant_level, d.daily_sales, d.order_count,
  d.customer_count, d.refund_count, d.sales_mom, d.sales_yoy, d.order_count_mom, d.refund_rate, d.zero_sales_flag,
  d.abnormal_sales_flag
FROM merchant_daily d LEFT JOIN merchant_profile p ON p.stat_date = d.stat_date AND p.merchant_id = d.merchant_id""",
)
PLATFORM_DAILY = (
    "platform_daily",
    """SELECT stat_date, daily_sales, daily_orders, active_users, new_users, conversion_rate, refund_count, refund_rate,
  health_score, sales_drop_warning, conversion_drop_warning, refund_spike_warning FROM health""",
)
MERCHANT_SNAPSHOT_CTES = [*MERCHANT_DAILY_CTES, *merchant_profile_ctes(MONTH_DATES), SNAPSHOT]


def merchant_snapshot_sql() -> str:
    return shaped(
        with_views(*MERCHANT_SNAPSHOT_CTES, final="SELECT * FROM merchant_snapshot"),
        MERCHANT_DAILY_DOUBLES,
        MERCHANT_DAILY_BIGINTS,
    )


def platform_daily_sql() -> str:
    return shaped(
        with_views(*HEALTH_CTES, PLATFORM_DAILY, final="SELECT * FROM platform_daily"), HEALTH_DOUBLES, HEALTH_BIGINTS
    )


MERCHANT_MONTHLY_CTES = [
    MONTHS,
    (
        "merchant_sums",
        """SELECT CAST(date_trunc('month', stat_date) + INTERVAL 1 MONTH AS DATE) AS stat_month, merchant_id, sum(daily_sales) AS total_sales,
  sum(order_count) AS order_count, sum(refund_count) AS refund_count FROM merchant_daily GROUP BY ALL""",
    ),
    (
        "merchant_tops",
        """SELECT label AS stat_month, merchant_id, list(product_name ORDER BY n DESC, product_name, product_id) AS names
FROM (SELECT label, merchant_id, product_id, product_name, count(DISTINCT order_id) AS n FROM order_lines GROUP BY ALL) GROUP BY ALL""",
    ),
    (
        "merchant_customers",
        "SELECT label AS stat_month, merchant_id, count(DISTINCT user_id) AS n FROM order_lines GROUP BY ALL",
    ),
    (
        "merchant_monthly",
        """SELECT s.stat_date AS stat_month, s.merchant_id, s.merchant_name, s.merchant_level, t.total_sales, t.order_count,
  coalesce(c.n, 0) AS customer_count, t.refund_count, coalesce(t.refund_count / nullif(t.order_count, 0), 0) AS refund_rate,
  coalesce(array_to_string(p.names[1:5], ','), '') AS top_products,
  CASE WHEN CAST(t.total_sales AS DOUBLE) > CAST(1.2 AS DOUBLE) * coalesce(CAST(e.total_sales AS DOUBLE), 0) THEN '上升'
       WHEN CAST(t.total_sales AS DOUBLE) < CAST(0.8 AS DOUBLE) * coalesce(CAST(e.total_sales AS DOUBLE), 0) THEN '下降'
       ELSE '平稳' END AS sales_trend
FROM merchant_snapshot s JOIN months ON m = s.stat_date
LEFT JOIN merchant_sums t ON t.stat_month = m AND t.merchant_id = s.merchant_id
LEFT JOIN merchant_customers c ON c.stat_month = m AND c.merchant_id = s.merchant_id
LEFT JOIN merchant_tops p ON p.stat_month = m AND p.merchant_id = s.merchant_id
LEFT JOIN merchant_sums e ON e.stat_month = m - INTERVAL 1 MONTH AND e.merchant_id = s.merchant_id
  AND e.stat_month >= (SELECT first_month FROM span)""",
    ),
]


def merchant_monthly_sql() -> str:
    return shaped(
        with_views(*MERCHANT_SNAPSHOT_CTES, *MERCHANT_MONTHLY_CTES, final="SELECT * FROM merchant_monthly"),
        "total_sales refund_rate",
        "order_count customer_count refund_count",
    )


MERCHANT_YEARLY_CTES = [
    (
        "my_totals",
        """SELECT year(stat_month) AS stat_year, merchant_id, max(merchant_name) AS merchant_name,
  max(merchant_level) AS merchant_level, sum(total_sales) AS total_sales, sum(order_count) AS order_count,
  sum(refund_count) AS refund_count FROM merchant_monthly
WHERE year(stat_month) <= (SELECT last_year FROM span) GROUP BY 1, 2""",
    ),
    (
        "my_customers",
        """SELECT year(order_time) AS stat_year, merchant_id, count(DISTINCT user_id) AS n FROM order_lines GROUP BY 1, 2""",
    ),
    (
        "merchant_yearly",
        """SELECT t.stat_year, t.merchant_id, t.merchant_name, t.merchant_level, t.total_sales, t.order_count,
  coalesce(c.n, 0) AS customer_count, t.refund_count,
  round(CASE WHEN t.order_count = 0 THEN 0 ELSE CAST(t.refund_count AS DOUBLE) / CAST(t.order_count AS DOUBLE) END, 4) AS refund_rate,
  CASE WHEN coalesce(p.total_sales, 0) = 0 THEN NULL
       ELSE round(CAST(t.total_sales - p.total_sales AS DOUBLE) / CAST(p.total_sales AS DOUBLE) * 100, 2) END AS yoy_sales_growth
FROM my_totals t LEFT JOIN my_customers c USING (stat_year, merchant_id)
LEFT JOIN my_totals p ON p.merchant_id = t.merchant_id AND p.stat_year = t.stat_year - 1""",
    ),
]


def merchant_yearly_sql() -> str:
    return shaped(
        with_views(
            *MERCHANT_SNAPSHOT_CTES,
            *MERCHANT_MONTHLY_CTES,
            *MERCHANT_YEARLY_CTES,
            final="SELECT * FROM merchant_yearly",
        ),
        "total_sales refund_rate yoy_sales_growth",
        "order_count customer_count refund_count",
    )


USER_MONTHLY_CTES = [
    ORDER_LINES,
    MONTHS,
    *user_profile_ctes(MONTH_DATES),
    (
        "brushing",
        """SELECT label AS m, user_id FROM (SELECT *, sum(in_day) OVER (PARTITION BY label, user_id, merchant_id) AS in_month
  FROM (SELECT label, user_id, merchant_id, order_date, count(DISTINCT order_id) AS in_day FROM order_lines GROUP BY ALL))
WHERE in_day > 10 OR in_month > 50 GROUP BY ALL""",
    ),
    (
        "um_base",
        """SELECT m AS stat_month, p.*, sum(last_30d_order_amount) OVER w AS running_amount,
  sum(last_30d_order_cnt) OVER w AS running_orders, sum(last_30d_return_cnt) OVER w AS running_returns,
  lag(last_30d_order_cnt) OVER (PARTITION BY user_id ORDER BY m) AS previous_orders
FROM user_profile p JOIN months ON p.stat_date = m
WINDOW w AS (PARTITION BY user_id ORDER BY m ROWS UNBOUNDED PRECEDING)""",
    ),
    (
        "user_monthly",
        """SELECT b.stat_month, b.user_id, u.user_name, b.register_date, b.user_level,
  b.running_amount AS total_order_amount, b.running_orders AS total_order_count, b.running_returns AS total_return_count,
  b.last_30d_login_days AS month_login_days, b.last_30d_view_cnt AS month_view_cnt, b.last_30d_order_cnt AS month_order_cnt,
  b.last_30d_order_amount AS month_order_amount, b.last_30d_return_cnt AS month_return_cnt,
  CASE WHEN b.last_30d_order_cnt = 0 THEN 0 ELSE CAST(b.last_30d_order_amount AS DOUBLE) / b.last_30d_order_cnt END
    AS month_avg_order_amount,
  b.preferred_category,
  CASE WHEN b.register_date >= b.stat_month AND b.register_date < b.stat_month + INTERVAL 1 MONTH THEN '新客'
       WHEN coalesce(b.previous_orders, 0) > 0
         AND b.last_30d_order_cnt < CAST(b.previous_orders AS DOUBLE) * CAST(0.3 AS DOUBLE) THEN '消费降级（预沉睡）'
       WHEN b.user_level IN ('优质', '高潜质', '中潜质') THEN '活跃'
       WHEN b.last_30d_order_cnt = 0 THEN '流失' ELSE '无明显特征' END AS lifecycle_stage,
  CASE WHEN b.last_30d_return_cnt >= 50 AND b.last_30d_return_cnt / nullif(b.last_30d_order_cnt, 0) > 0.7 THEN '异常退货'
       WHEN s.user_id IS NOT NULL THEN '刷单嫌疑' ELSE '正常' END AS risk_flag
FROM um_base b LEFT JOIN users u ON u.user_id = b.user_id
LEFT JOIN brushing s ON s.m = b.stat_month AND s.user_id = b.user_id""",
    ),
]


def user_monthly_sql() -> str:
    return shaped(
        with_views(*USER_MONTHLY_CTES, final="SELECT * FROM user_monthly"),
        "total_order_amount month_order_amount month_avg_order_amount",
        "total_order_count total_return_count month_login_days month_view_cnt month_order_cnt month_return_cnt",
    )


# A year's risk looks at the flags of the two years before, so the years are walked one after the other.
USER_YEARLY_CTES = [
    (
        "year_rows",
        """SELECT year(stat_month) AS y, * FROM user_monthly WHERE year(stat_month) <= (SELECT last_year FROM span)""",
    ),
    (
        "year_sums",
        """SELECT y, user_id, sum(month_login_days) AS logins, sum(month_view_cnt) AS views, sum(month_order_cnt) AS orders,
  sum(month_order_amount) AS amount, sum(month_return_cnt) AS refunds, count(*) FILTER (WHERE risk_flag != '正常') AS risky,
  sum(month_order_cnt) FILTER (WHERE month(stat_month) >= 10) AS late_orders,
  list(array_position(['优质', '高潜质', '中潜质', '普通'], user_level)) AS ranks FROM year_rows GROUP BY ALL""",
    ),
    (
        "year_tastes",
        """SELECT y, user_id, array_to_string((list(taste ORDER BY n DESC, taste))[1:5], ',') AS names
FROM (SELECT y, user_id, taste, count(*) AS n FROM (SELECT y, user_id, trim(unnest(string_split(preferred_category, ',')[1:5])) AS taste
  FROM year_rows) WHERE taste != '' GROUP BY ALL) GROUP BY ALL""",
    ),
    (
        "year_risks",
        """SELECT first_year - 1 AS y, user_id, '正常' AS flag, '正常' AS flag_before FROM users, span
UNION ALL
SELECT r.y + 1, r.user_id, CASE
    WHEN s.risky IS NULL THEN '正常'
    WHEN year(u.created_time) = r.y AND r.flag != '正常' THEN CASE WHEN s.risky > 1 THEN '高风险' ELSE '正常' END
    WHEN year(u.created_time) < r.y AND r.flag != '正常' AND r.flag_before != '正常' THEN CASE WHEN s.risky > 0 THEN '超级高风险' ELSE '正常' END
    WHEN year(u.created_time) <= r.y + 1 AND s.risky > 3 THEN '高风险' ELSE '正常' END, r.flag
FROM year_risks r JOIN users u ON u.user_id = r.user_id LEFT JOIN year_sums s ON s.y = r.y + 1 AND s.user_id = r.user_id
WHERE r.y < (SELECT last_year FROM span)""",
    ),
    (
        "user_yearly",
        """SELECT CAST(r.y AS INTEGER) AS stat_year, u.user_id, u.user_name, CAST(u.created_time AS DATE) AS register_date,
  CASE WHEN s.user_id IS NULL THEN '普通'
       WHEN len(list_filter(ranks, lambda k: k <= 1)) >= 9 AND len(list_filter(ranks, lambda k: k >= 3)) = 0 THEN '年度优质用户'
       WHEN len(list_filter(ranks, lambda k: k <= 2)) >= 9 AND len(list_filter(ranks, lambda k: k = 4)) = 0 THEN '年度高潜质用户'
       WHEN len(list_filter(ranks, lambda k: k <= 3)) >= 9 THEN '年度潜质用户' ELSE '普通用户' END AS user_level,
  coalesce(t.total_order_amount, 0) AS total_order_amount, coalesce(t.total_order_count, 0) AS total_order_count,
  coalesce(t.total_return_count, 0) AS total_return_count, coalesce(s.logins, 0) AS year_login_days, coalesce(s.views, 0) AS year_view_cnt,
  coalesce(s.orders, 0) AS year_order_cnt, coalesce(s.amount, 0) AS year_order_amount, coalesce(s.refunds, 0) AS year_return_cnt,
  coalesce(CAST(s.amount AS DOUBLE) / nullif(CAST(s.orders AS DOUBLE), 0), 0) AS year_avg_order_amount,
  coalesce(c.names, '未知') AS preferred_category,
  CASE WHEN coalesce(s.late_orders, 0) = 0 THEN '流失' ELSE '沉睡' END AS lifecycle_stage, r.flag AS risk_flag
FROM year_risks r JOIN span ON r.y >= first_year JOIN users u ON u.user_id = r.user_id
LEFT JOIN year_sums s ON s.y = r.y AND s.user_id = r.user_id LEFT JOIN year_tastes c ON c.y = r.y AND c.user_id = r.user_id
LEFT JOIN user_monthly t ON t.user_id = r.user_id AND t.stat_month = make_date(CAST(r.y AS INTEGER) + 1, 1, 1)""",
    ),
]


def user_yearly_sql() -> str:
    return shaped(
        with_views(*USER_MONTHLY_CTES, *USER_YEARLY_CTES, final="SELECT * FROM user_yearly"),
        "total_order_amount year_order_amount year_avg_order_amount",
        "total_order_count total_return_count year_login_days year_view_cnt year_order_cnt year_return_cnt",
    )


def _mean2(amount: str, n: str) -> str:
    """amount / n to two digits, halves away from zero, in whole numbers so that ties are exact."""
    cents = f"CAST({amount} * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) / 100"


# One row per month, user level and promotion; orders without a promotion are the row of NULL, which the others of the level
# are held against.
PROMOTION_CTES = [
    (
        "promoted_sales",
        """SELECT m, promotion_id, coalesce(user_level, 'Normal') AS user_level, sum(order_amount) AS gmv, count(*) AS n
FROM dwd_orders JOIN months ON CAST(date_trunc('month', order_time) AS DATE) + INTERVAL 1 MONTH = m
LEFT JOIN user_profile ON stat_date = m AND user_profile.user_id = dwd_orders.user_id GROUP BY ALL""",
    ),
    (
        "compared_sales",
        """SELECT *, sum(gmv) FILTER (WHERE promotion_id IS NULL) OVER level AS base_gmv,
  CAST(sum(n) FILTER (WHERE promotion_id IS NULL) OVER level AS BIGINT) AS base_n
FROM promoted_sales WINDOW level AS (PARTITION BY m, user_level)""",
    ),
    (
        "promotion_detail",
        f"""SELECT m AS stat_month, promotion_id, promotion_name, user_level, {_mean2("gmv", "n")} AS avg_order_amount_promo,
  {_mean2("base_gmv", "base_n")} AS avg_order_amount_base,
  round((CAST(gmv AS DOUBLE) / n - CAST(base_gmv AS DOUBLE) / base_n) / nullif(CAST(base_gmv AS DOUBLE) / base_n, 0), 4) AS lift,
  n AS promo_order_cnt, base_n AS base_order_cnt, gmv AS promo_gmv, base_gmv
FROM compared_sales JOIN dim_promotions USING (promotion_id)
WHERE promotion_status = 'In Progress' AND start_time < m AND end_time >= m - INTERVAL 1 MONTH""",
    ),
]
PROFILE_MONTH_CTES = [ORDER_LINES, MONTHS, *user_profile_ctes(MONTH_DATES)]


def promotion_detail_sql() -> str:
    return shaped(
        with_views(*PROFILE_MONTH_CTES, *PROMOTION_CTES, final="SELECT * FROM promotion_detail"),
        "avg_order_amount_promo avg_order_amount_base lift promo_gmv base_gmv base_order_cnt",
        "promo_order_cnt",
    )


def _text(column: str, kind: str | None = None) -> str:
    value = f"CAST({column} AS {kind})" if kind else column
    return f"coalesce(CAST({value} AS VARCHAR), 'null')"


PLATFORM_MONTHLY_CTES = [
    PLATFORM_DAILY,
    # days of the platform and selling merchants as one list, so that a month is one fold of it
    (
        "month_events",
        """SELECT last_day(stat_date) + 1 AS m, daily_sales, daily_orders, refund_count, health_score, new_users, conversion_rate,
  NULL::VARCHAR AS seller FROM platform_daily
UNION ALL SELECT last_day(stat_month) + 1, NULL, NULL, NULL, NULL, NULL, NULL, merchant_id FROM merchant_monthly WHERE order_count > 0""",
    ),
    (
        "month_folds",
        """SELECT m, sum(daily_sales) AS total_gmv, sum(daily_orders) AS total_orders, sum(refund_count) AS total_returns,
  avg(health_score) AS avg_health_score, sum(new_users) AS total_new_user, avg(conversion_rate) AS avg_conversion_rate,
  count(DISTINCT seller) AS sellers FROM month_events GROUP BY m""",
    ),
    (
        "pm_category",
        """SELECT label AS m, coalesce(category_name, 'Unknown') AS category, count(DISTINCT order_id) AS n,
  CAST(sum(order_amount) AS DECIMAL(28,2)) AS gmv FROM order_lines GROUP BY 1, 2""",
    ),
    (
        "pm_category_json",
        """SELECT m, '{' || string_agg('"' || category || '":{"order_cnt":' || n || ',"gmv":' || gmv || '}', ',' ORDER BY category)
  || '}' AS js FROM pm_category GROUP BY 1""",
    ),
    (
        "pm_level_json",
        f"""SELECT stat_month, promotion_id, max(promotion_name) AS name, string_agg('"' || user_level
  || '":{{"avg_order_amount_promo":' || {_text("avg_order_amount_promo", "DECIMAL(20,2)")}
  || ',"avg_order_amount_base":' || {_text("avg_order_amount_base", "DECIMAL(20,2)")}
  || ',"lift":' || {_text("lift", "DECIMAL(20,4)")} || ',"promo_order_cnt":' || {_text("promo_order_cnt")}
  || ',"base_order_cnt":' || {_text("base_order_cnt")} || ',"promo_gmv":' || {_text("promo_gmv", "DECIMAL(28,2)")}
  || ',"base_gmv":' || {_text("base_gmv", "DECIMAL(28,2)")} || '}}', ',' ORDER BY user_level) AS effects
FROM promotion_detail GROUP BY 1, 2""",
    ),
    (
        "pm_promotion_json",
        """SELECT stat_month AS m, '{' || string_agg('"' || promotion_id || '":{"promotion_name":"' || name || '","effects":{'
  || effects || '}}', ',' ORDER BY promotion_id) || '}' AS js FROM pm_level_json GROUP BY 1""",
    ),
    (
        "platform_monthly",
        """SELECT m AS stat_month, f.* EXCLUDE (m, sellers), coalesce(sellers, 0) AS active_merchants,
  coalesce(c.js, '{}') AS category_sales, coalesce(p.js, '{}') AS promotion_effect
FROM months LEFT JOIN month_folds f USING (m) LEFT JOIN pm_category_json c USING (m) LEFT JOIN pm_promotion_json p USING (m)""",
    ),
]
PLATFORM_MONTH_BASE = [
    *MERCHANT_SNAPSHOT_CTES,
    *MERCHANT_MONTHLY_CTES,
    *user_profile_ctes(MONTH_DATES),
    *PROMOTION_CTES,
    *HEALTH_CTES,
    *PLATFORM_MONTHLY_CTES,
]
PLATFORM_DOUBLES = "total_gmv avg_health_score avg_conversion_rate total_orders total_returns total_new_user"
PLATFORM_BIGINTS = "active_merchants"


def platform_monthly_sql() -> str:
    return shaped(
        with_views(*PLATFORM_MONTH_BASE, final="SELECT * FROM platform_monthly"), PLATFORM_DOUBLES, PLATFORM_BIGINTS
    )


ACTIVE = "action_type IN ('register','login','browse','favorite','add_cart','purchase','search')"
RETENTION_CTES = [
    ("years", "SELECT unnest(range(first_year, last_year + 1)) AS y FROM span"),
    (
        "months_seen",
        f"SELECT year(action_time) AS y, user_id, list(DISTINCT month(action_time)) AS seen FROM user_actions WHERE {ACTIVE} GROUP BY ALL",
    ),
    (
        "retained",
        """SELECT y, round(100.0 * count(*) FILTER (WHERE list_contains(seen, 12)) / count(*), 2) AS rate
FROM months_seen WHERE list_contains(seen, 1) GROUP BY y""",
    ),
]


def retention_sql() -> str:
    return shaped(
        with_views(*RETENTION_CTES, final="SELECT CAST(y AS INTEGER) AS year, rate AS user_retention_rate FROM retained"),
        "user_retention_rate",
    )


def platform_yearly_sql() -> str:
    return shaped(
        with_views(
            *PLATFORM_MONTH_BASE,
            *MERCHANT_YEARLY_CTES,
            *RETENTION_CTES,
            (
                "py_totals",
                """SELECT year(stat_month) AS y, sum(total_gmv) AS gmv, sum(total_orders) AS orders, sum(total_returns) AS returned,
  avg(avg_health_score) AS score, sum(total_new_user) AS joined, avg(avg_conversion_rate) AS cvr
FROM platform_monthly GROUP BY 1""",
            ),
            (
                "py_category",
                "SELECT year(m) AS y, category, sum(n) AS n, CAST(sum(gmv) AS DECIMAL(28,2)) AS gmv FROM pm_category GROUP BY 1, 2",
            ),
            (
                "py_category_json",
                """SELECT y, '{' || string_agg('"' || category || '":{"gmv":' || gmv || ',"order_cnt":' || n || '}', ','
  ORDER BY category) || '}' AS js FROM py_category GROUP BY 1""",
            ),
            (
                "py_active",
                "SELECT stat_year AS y, count(DISTINCT merchant_id) AS n FROM merchant_yearly WHERE order_count > 0 GROUP BY 1",
            ),
            final="""SELECT make_date(y + 1, 1, 1) AS stat_year, t.gmv AS total_gmv, t.orders AS total_orders,
  t.returned AS total_returns, t.score AS avg_health_score, t.joined AS total_new_user, t.cvr AS avg_conversion_rate,
  coalesce(a.n, 0) AS active_merchants, coalesce(c.js, '{}') AS category_sales, coalesce(r.rate, 0) AS user_retention_rate
FROM years LEFT JOIN py_totals t USING (y) LEFT JOIN py_active a USING (y) LEFT JOIN py_category_json c USING (y)
LEFT JOIN retained r USING (y)""",
        ),
        PLATFORM_DOUBLES + " user_retention_rate",
        PLATFORM_BIGINTS,
    )
