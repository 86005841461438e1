"""The relational building blocks the models use, one query each, with whole-table SQL twins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    capped_share,
    exact_mean,
    growth_percent,
    json_object,
    ordered_text,
    ratio,
    ratio_or_zero,
    whole_hours,
    within_days,
)
from ledgerloom.sources.samples import SampleTables
from verification.oracles import ORDER_LINES, shaped, with_views
from verification.shape import plain

QUERIES, ORACLES = {}, {}
D = date(2000, 6, 15)
DS = "DATE '2000-06-15'"
c = F.col


def register(name: str, sql: str, doubles: str = "", bigints: str = "", ctes=(ORDER_LINES,)):
    def wrap(build):
        QUERIES[name] = lambda spark, sf_dir: plain(build(SampleTables(spark, sf_dir)))
        ORACLES[name] = shaped(with_views(*ctes, final=sql), doubles, bigints)
        return build

    return wrap


def lines(t: SampleTables):
    products = t["dim_products"].select("product_id", "merchant_id", "category_name", "product_name")
    return t["dwd_orders"].join(products, "product_id").withColumn("order_date", F.to_date("order_time"))


# --- projections and predicates ----------------------------------------------------------------------


@register("select_columns", "SELECT user_id AS customer, user_name AS name, CAST(created_time AS DATE) AS since FROM users")
def _(t):
    return t["users"].select(c("user_id").alias("customer"), c("user_name").alias("name"), F.to_date("created_time").alias("since"))


@register("filter_single_day", f"SELECT order_id, order_amount FROM order_lines WHERE order_date = {DS}", "order_amount")
def _(t):
    return t["dwd_orders"].filter(within_days(c("order_time"), D, D)).select("order_id", "order_amount")


@register(
    "filter_look_back_window",
    f"SELECT count(*) AS n, sum(order_amount) AS amount FROM order_lines WHERE order_date >= {DS} - 7 AND order_date < {DS}",
    "amount",
)
def _(t):
    week = within_days(c("order_time"), date(2000, 6, 8), date(2000, 6, 14))
    return t["dwd_orders"].filter(week).agg(F.count("*").alias("n"), F.sum("order_amount").alias("amount"))


@register(
    "filter_open_look_back",
    f"SELECT user_id, count(*) AS n FROM dwd_orders WHERE order_time >= {DS} - 30 GROUP BY 1",
)
def _(t):
    since = within_days(c("order_time"), date(2000, 5, 16), None)
    return t["dwd_orders"].filter(since).groupBy("user_id").agg(F.count("*").alias("n"))


@register(
    "filter_month_and_year_window",
    """SELECT 'month' AS period, count(*) AS n FROM dwd_orders WHERE order_time >= DATE '2000-07-01' - INTERVAL 1 MONTH
AND order_time < DATE '2000-07-01' UNION ALL SELECT 'year', count(*) FROM dwd_orders
WHERE order_time >= DATE '2001-01-01' - INTERVAL 1 YEAR AND order_time < DATE '2001-01-01'""",
)
def _(t):
    orders = t["dwd_orders"]

    def between(label, end, months):
        start = F.add_months(F.lit(end), -months).cast("timestamp")
        rows = orders.filter((c("order_time") >= start) & (c("order_time") < F.lit(end).cast("timestamp")))
        return rows.agg(F.lit(label).alias("period"), F.count("*").alias("n"))

    return between("month", date(2000, 7, 1), 1).unionByName(between("year", date(2001, 1, 1), 12))


@register(
    "filter_period_overlap",
    """SELECT promotion_id, promotion_name FROM dim_promotions WHERE promotion_status = 'In Progress'
AND start_time < DATE '2000-07-01' AND end_time >= DATE '2000-06-01'""",
)
def _(t):
    running = (c("start_time") < F.lit("2000-07-01").cast("timestamp")) & (
        c("end_time") >= F.lit("2000-06-01").cast("timestamp")
    )
    return t["dim_promotions"].filter((c("promotion_status") == "In Progress") & running).select("promotion_id", "promotion_name")


@register("filter_in_list", "SELECT action_type, count(*) AS n FROM user_actions WHERE action_type IN ('login', 'browse') GROUP BY 1")
def _(t):
    return t["user_actions"].filter(c("action_type").isin("login", "browse")).groupBy("action_type").agg(F.count("*").alias("n"))


@register(
    "filter_null_and_unequal",
    "SELECT order_status, count(*) AS n FROM dwd_orders WHERE promotion_id IS NULL AND order_status <> 'pending' GROUP BY 1",
)
def _(t):
    rows = t["dwd_orders"].filter(c("promotion_id").isNull() & (c("order_status") != "pending"))
    return rows.groupBy("order_status").agg(F.count("*").alias("n"))


@register(
    "filter_after_aggregate",
    "SELECT user_id, category_name, count(*) AS n FROM order_lines GROUP BY 1, 2 HAVING count(*) > 5",
)
def _(t):
    return lines(t).groupBy("user_id", "category_name").agg(F.count("*").alias("n")).filter("n > 5")


# --- joins -------------------------------------------------------------------------------------------


@register(
    "join_left_dimension",
    """SELECT o.order_id, p.promotion_name FROM dwd_orders o LEFT JOIN dim_promotions p ON o.promotion_id = p.promotion_id""",
)
def _(t):
    return t["dwd_orders"].join(t["dim_promotions"], "promotion_id", "left").select("order_id", "promotion_name")


@register(
    "join_left_with_key_check",
    """SELECT p.promotion_name, count(*) AS n FROM dwd_orders o LEFT JOIN dim_promotions p ON o.promotion_id = p.promotion_id
WHERE p.promotion_id IS NOT NULL GROUP BY 1""",
)
def _(t):
    return t["dwd_orders"].join(t["dim_promotions"], "promotion_id").groupBy("promotion_name").agg(F.count("*").alias("n"))


@register(
    "join_inner",
    "SELECT merchant_id, sum(order_amount) AS amount FROM order_lines GROUP BY 1",
    "amount",
)
def _(t):
    per_product = t["dwd_orders"].groupBy("product_id").agg(F.sum("order_amount").alias("amount"))
    joined = per_product.join(t["dim_products"].select("product_id", "merchant_id"), "product_id")
    return joined.groupBy("merchant_id").agg(F.sum("amount").alias("amount"))


@register(
    "join_spine",
    """SELECT m.merchant_id, coalesce(r.n, 0) AS returned FROM dim_merchants m LEFT JOIN
(SELECT merchant_id, count(*) AS n FROM returns WHERE rejected_time IS NOT NULL GROUP BY 1) r ON r.merchant_id = m.merchant_id""",
)
def _(t):
    refused = t["returns"].filter(c("rejected_time").isNotNull()).groupBy("merchant_id").agg(F.count("*").alias("n"))
    return t["dim_merchants"].join(refused, "merchant_id", "left").select("merchant_id", F.coalesce("n", F.lit(0)).alias("returned"))


@register(
    "join_composite_key",
    """SELECT o.order_date, o.merchant_id, o.n, r.returned FROM (SELECT order_date, merchant_id, count(*) AS n FROM order_lines GROUP BY 1, 2) o
LEFT JOIN (SELECT CAST(apply_time AS DATE) AS order_date, merchant_id, count(*) AS returned FROM returns GROUP BY 1, 2) r
ON o.order_date = r.order_date AND o.merchant_id = r.merchant_id""",
    "returned",
)
def _(t):
    keys = ["order_date", "merchant_id"]
    sold = lines(t).groupBy(*keys).agg(F.count("*").alias("n"))
    back = t["returns"].groupBy(F.to_date("apply_time").alias("order_date"), "merchant_id").agg(F.count("*").cast("double").alias("returned"))
    return sold.join(back, keys, "left")


@register(
    "join_two_hops",
    """SELECT o.category_name, count(*) AS n FROM returns r JOIN order_lines o ON r.order_id = o.order_id GROUP BY 1""",
)
def _(t):
    to_product = t["returns"].select("order_id").join(t["dwd_orders"].select("order_id", "product_id"), "order_id")
    per_product = to_product.groupBy("product_id").agg(F.count("*").alias("n"))
    joined = per_product.join(t["dim_products"].select("product_id", "category_name"), "product_id")
    return joined.groupBy("category_name").agg(F.sum("n").alias("n"))


@register(
    "join_one_row",
    """SELECT m.merchant_id, m.amount / a.amount * 100 AS share FROM
(SELECT merchant_id, CAST(sum(order_amount) AS DOUBLE) AS amount FROM order_lines GROUP BY 1) m,
(SELECT CAST(sum(order_amount) AS DOUBLE) AS amount FROM order_lines) a""",
    "share",
)
def _(t):
    per_product = t["dwd_orders"].groupBy("product_id").agg(F.sum("order_amount").alias("amount"))
    merchants = (
        per_product.join(t["dim_products"].select("product_id", "merchant_id"), "product_id")
        .groupBy("merchant_id")
        .agg(F.sum("amount").alias("amount"))
    )
    # a global aggregate is one row by construction, so broadcasting it is safe at any size
    total = t["dwd_orders"].agg(F.sum("order_amount").alias("total"))
    return merchants.crossJoin(F.broadcast(total)).select("merchant_id", (ratio(c("amount"), c("total")) * 100).alias("share"))


@register(
    "split_list_to_rows",
    """SELECT category, count(*) AS n FROM (SELECT trim(unnest(string_split(names, ','))) AS category FROM
 (SELECT user_id, string_agg(category_name, ',' ORDER BY category_name) AS names FROM
  (SELECT DISTINCT user_id, category_name FROM order_lines) GROUP BY 1)) GROUP BY 1""",
)
def _(t):
    pairs = lines(t).select("user_id", "category_name").distinct()
    lists = pairs.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list("category_name")), ",").alias("names"))
    parts = lists.select(F.explode(F.split("names", ",")).alias("category"))
    return parts.groupBy(F.trim("category").alias("category")).agg(F.count("*").alias("n"))


@register(
    "join_semi",
    "SELECT user_id, user_name FROM users WHERE user_id IN (SELECT user_id FROM returns)",
)
def _(t):
    return t["users"].join(t["returns"], "user_id", "left_semi").select("user_id", "user_name")


@register(
    "join_anti",
    "SELECT user_id, user_name FROM users WHERE user_id NOT IN (SELECT user_id FROM returns)",
)
def _(t):
    return t["users"].join(t["returns"], "user_id", "left_anti").select("user_id", "user_name")


@register(
    "join_own_history",
    """SELECT a.order_date, a.n, y.n AS day_before, w.n AS week_before FROM daily a
LEFT JOIN daily y ON y.order_date = a.order_date - 1 LEFT JOIN daily w ON w.order_date = a.order_date - 7""",
    "day_before week_before",
    ctes=(ORDER_LINES, ("daily", "SELECT order_date, count(*) AS n FROM order_lines GROUP BY 1")),
)
def _(t):
    daily = t["dwd_orders"].groupBy(F.to_date("order_time").alias("order_date")).agg(F.count("*").alias("n"))

    def shifted(days, name):
        return daily.select(F.date_add("order_date", days).alias("order_date"), c("n").cast("double").alias(name))

    return daily.join(shifted(1, "day_before"), "order_date", "left").join(shifted(7, "week_before"), "order_date", "left")


@register(
    "explode_json_map",
    """SELECT k, count(*) AS n, sum(v) AS total FROM (SELECT unnest(json_keys(props)) AS k,
 CAST(json_extract(props, '$.k') AS BIGINT) AS v FROM events) GROUP BY 1""",
    bigints="total",
)
def _(t):
    pairs = t["events"].select(F.explode(F.from_json("props", "MAP<STRING, BIGINT>")).alias("k", "v"))
    return pairs.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@register(
    "scalar_subqueries",
    """SELECT (SELECT count(*) FROM users) AS users, (SELECT count(*) FROM dwd_orders) AS orders,
 (SELECT count(*) FROM returns) AS returned""",
)
def _(t):
    def counted(name, label):
        return t[name].agg(F.count("*").alias(label))

    one_row = counted("users", "users").crossJoin(F.broadcast(counted("dwd_orders", "orders")))
    return one_row.crossJoin(F.broadcast(counted("returns", "returned")))


# --- aggregates --------------------------------------------------------------------------------------


@register("sum_or_zero", "SELECT user_id, coalesce(sum(CASE WHEN l_returnflag = 'R' THEN order_amount END), 0) AS amount FROM dwd_orders GROUP BY 1", "amount")
def _(t):
    amount = F.sum(F.when(c("l_returnflag") == "R", c("order_amount")))
    return t["dwd_orders"].groupBy("user_id").agg(F.coalesce(amount, F.lit(0).cast("decimal(20,2)")).alias("amount"))


@register(
    "count_distinct",
    "SELECT merchant_id, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT category_name) AS categories FROM order_lines GROUP BY 1",
)
def _(t):
    return lines(t).groupBy("merchant_id").agg(
        F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.countDistinct("category_name").alias("categories")
    )


@register(
    "conditional_aggregates",
    """SELECT user_id, sum(CASE WHEN order_status = 'completed' THEN order_amount ELSE 0 END) AS completed,
 count(CASE WHEN promotion_id IS NULL THEN 1 END) AS plain, count(DISTINCT CASE WHEN l_quantity > 25 THEN product_id END) AS bulky
FROM dwd_orders GROUP BY 1""",
    "completed",
)
def _(t):
    return t["dwd_orders"].groupBy("user_id").agg(
        F.sum(F.when(c("order_status") == "completed", c("order_amount")).otherwise(0)).alias("completed"),
        F.count_if(c("promotion_id").isNull()).alias("plain"),
        F.countDistinct(F.when(c("l_quantity") > 25, c("product_id"))).alias("bulky"),
    )


@register(
    "average_and_deviation",
    """SELECT merchant_id, CAST(sum(order_amount) AS DOUBLE) / count(*) AS mean, stddev_pop(CAST(order_amount AS DOUBLE)) AS sigma
FROM order_lines GROUP BY 1""",
    "mean sigma",
)
def _(t):
    return lines(t).groupBy("merchant_id").agg(
        exact_mean(c("order_amount"), "decimal(10,2)").alias("mean"),
        F.stddev_pop(c("order_amount").cast("double")).alias("sigma"),
    )


@register("maximum", "SELECT user_id, max(order_time) AS last_order, max(order_status) AS status FROM dwd_orders GROUP BY 1")
def _(t):
    return t["dwd_orders"].groupBy("user_id").agg(F.max("order_time").alias("last_order"), F.max("order_status").alias("status"))


@register(
    "ordered_text_aggregate",
    """SELECT user_id, string_agg(category_name, ',' ORDER BY n DESC, category_name) AS names
FROM (SELECT user_id, category_name, count(*) AS n FROM order_lines GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    counts = lines(t).groupBy("user_id", "category_name").agg(F.count("*").alias("n"))
    entry = F.struct((-c("n")).alias("rank"), "category_name")
    return counts.groupBy("user_id").agg(ordered_text(F.collect_list(entry), "category_name").alias("names"))


@register(
    "json_object_aggregate",
    """SELECT merchant_id, '{' || string_agg('"' || category_name || '":{"order_cnt":' || n || ',"gmv":' || amount || '}', ','
 ORDER BY category_name) || '}' AS js FROM (SELECT merchant_id, category_name, count(*) AS n, sum(order_amount) AS amount
FROM order_lines GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    sums = lines(t).groupBy("merchant_id", "category_name").agg(F.count("*").alias("order_cnt"), F.sum("order_amount").alias("gmv"))
    entry = F.struct("category_name", F.struct("order_cnt", "gmv").alias("value"))
    return sums.groupBy("merchant_id").agg(json_object(F.collect_list(entry)).alias("js"))


@register(
    "two_level_aggregate",
    """SELECT user_id, max(n) AS busiest_day, sum(n) AS total FROM
(SELECT user_id, order_date, count(*) AS n FROM order_lines GROUP BY 1, 2) GROUP BY 1""",
    bigints="total",
)
def _(t):
    days = t["dwd_orders"].groupBy("user_id", F.to_date("order_time").alias("day")).agg(F.count("*").alias("n"))
    return days.groupBy("user_id").agg(F.max("n").alias("busiest_day"), F.sum("n").alias("total"))


@register(
    "global_aggregate",
    """SELECT count(*) AS n, sum(order_amount) AS amount, (SELECT sum(order_amount) FROM dwd_orders WHERE order_status = 'none') AS nothing
FROM dwd_orders""",
    "amount nothing",
)
def _(t):
    nothing = F.sum(F.when(c("order_status") == "none", c("order_amount")))
    return t["dwd_orders"].agg(F.count("*").alias("n"), F.sum("order_amount").alias("amount"), nothing.alias("nothing"))


@register(
    "guarded_ratio",
    """SELECT user_id, CASE WHEN count(CASE WHEN l_returnflag = 'R' THEN 1 END) = 0 THEN 0
 ELSE count(promotion_id) / count(CASE WHEN l_returnflag = 'R' THEN 1 END) END AS rate FROM dwd_orders GROUP BY 1""",
    "rate",
)
def _(t):
    return t["dwd_orders"].groupBy("user_id").agg(
        ratio_or_zero(F.count("promotion_id"), F.count_if(c("l_returnflag") == "R")).alias("rate")
    )


@register(
    "mean_whole_hours",
    """SELECT merchant_id, avg(CASE WHEN approved_time IS NOT NULL THEN epoch(approved_time - apply_time) // 3600
 WHEN rejected_time IS NOT NULL THEN epoch(rejected_time - apply_time) // 3600 END) AS hours FROM returns GROUP BY 1""",
    "hours",
)
def _(t):
    hours = F.when(c("approved_time").isNotNull(), whole_hours(c("apply_time"), c("approved_time"))).when(
        c("rejected_time").isNotNull(), whole_hours(c("apply_time"), c("rejected_time"))
    )
    return t["returns"].groupBy("merchant_id").agg(exact_mean(hours, "bigint").alias("hours"))


# --- windows and set operations ----------------------------------------------------------------------


@register(
    "top_one_per_group",
    """SELECT user_id, category_name FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category_name) AS rn
FROM (SELECT user_id, category_name, count(*) AS n FROM order_lines GROUP BY 1, 2)) WHERE rn = 1""",
)
def _(t):
    counts = lines(t).groupBy("user_id", "category_name").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-c("n")).alias("rank"), "category_name")).getField("category_name")
    return counts.groupBy("user_id").agg(best.alias("category_name"))


@register(
    "top_five_per_group",
    """SELECT merchant_id, string_agg(product_id, ',' ORDER BY rn) AS products FROM (SELECT *, row_number() OVER
 (PARTITION BY merchant_id ORDER BY n DESC, product_id) AS rn FROM
 (SELECT merchant_id, product_id, count(*) AS n FROM order_lines GROUP BY 1, 2)) WHERE rn <= 5 GROUP BY 1""",
)
def _(t):
    counts = t["dwd_orders"].groupBy("product_id").agg(F.count("*").alias("n"))
    joined = counts.join(t["dim_products"].select("product_id", "merchant_id"), "product_id")
    rank = F.row_number().over(Window.partitionBy("merchant_id").orderBy(c("n").desc(), "product_id"))
    ranked = joined.withColumn("rank", rank).filter("rank <= 5")
    return ranked.groupBy("merchant_id").agg(
        ordered_text(F.collect_list(F.struct("rank", "product_id")), "product_id").alias("products")
    )


@register(
    "trailing_thirty_days",
    """SELECT d.stat_date, sum(n) AS orders FROM
(SELECT DISTINCT CAST(unnest(generate_series(order_date + 1, order_date + 30, INTERVAL 1 DAY)) AS DATE) AS stat_date
 FROM (SELECT DISTINCT order_date FROM order_lines)) d
JOIN (SELECT order_date, count(*) AS n FROM order_lines GROUP BY 1) o
  ON o.order_date >= d.stat_date - 30 AND o.order_date < d.stat_date GROUP BY 1""",
    bigints="orders",
    ctes=(ORDER_LINES,),
)
def _(t):
    daily = t["dwd_orders"].groupBy(F.to_date("order_time").alias("day")).agg(F.count("*").alias("n"))
    later = F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", 30))).alias("stat_date")
    return daily.select(later, "n").groupBy("stat_date").agg(F.sum("n").alias("orders"))


@register(
    "period_growth",
    """SELECT a.m, CASE WHEN b.amount IS NULL OR b.amount = 0 THEN NULL
 ELSE CAST(a.amount - b.amount AS DOUBLE) / CAST(b.amount AS DOUBLE) * 100 END AS growth FROM monthly a
LEFT JOIN monthly b ON b.m = a.m - INTERVAL 1 MONTH""",
    "growth",
    ctes=(
        ORDER_LINES,
        ("monthly", "SELECT CAST(date_trunc('month', order_time) AS DATE) AS m, sum(order_amount) AS amount FROM dwd_orders GROUP BY 1"),
    ),
)
def _(t):
    monthly = t["dwd_orders"].groupBy(F.trunc("order_time", "month").alias("m")).agg(F.sum("order_amount").alias("amount"))
    before = monthly.select(F.add_months("m", 1).alias("m"), c("amount").alias("earlier"))
    return monthly.join(before, "m", "left").select("m", growth_percent(c("amount"), c("earlier")).alias("growth"))


@register(
    "union_distinct",
    "SELECT user_id FROM dwd_orders UNION SELECT user_id FROM returns UNION SELECT user_id FROM user_actions",
)
def _(t):
    parts = [t[name].select("user_id").distinct() for name in ("dwd_orders", "returns", "user_actions")]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@register("union_all", "SELECT user_id, 'order' AS what FROM dwd_orders UNION ALL SELECT user_id, 'return' FROM returns")
def _(t):
    sold = t["dwd_orders"].select("user_id", F.lit("order").alias("what"))
    return sold.unionByName(t["returns"].select("user_id", F.lit("return").alias("what")))


@register("select_distinct", "SELECT DISTINCT merchant_id FROM dim_products")
def _(t):
    return t["dim_products"].select("merchant_id").distinct()


@register(
    "set_intersection",
    "SELECT user_id FROM dwd_orders WHERE order_time < DATE '1996-01-01' INTERSECT SELECT user_id FROM dwd_orders WHERE order_time >= DATE '2001-01-01'",
)
def _(t):
    orders = t["dwd_orders"]
    early = orders.filter(c("order_time") < F.lit("1996-01-01").cast("timestamp")).select("user_id")
    return early.intersect(orders.filter(c("order_time") >= F.lit("2001-01-01").cast("timestamp")).select("user_id"))


# --- scalar functions --------------------------------------------------------------------------------


@register(
    "functions_numeric",
    """SELECT order_id, round(order_amount, 1) AS rounded, nullif(l_linenumber, 3) AS other, coalesce(nullif(l_linenumber, 3), 0) AS filled,
 CASE WHEN nullif(l_linenumber, 3) IS NULL THEN NULL ELSE least(l_linenumber / (5 * 1.2), 1) END AS share,
 pow(l_linenumber, 2) AS squared, CASE WHEN order_amount > 50000 THEN 'high' WHEN order_amount > 10000 THEN 'mid' ELSE 'low' END AS band
FROM dwd_orders""",
    "rounded other share squared",
)
def _(t):
    number = F.nullif(c("l_linenumber"), F.lit(3))
    band = F.when(c("order_amount") > 50000, "high").when(c("order_amount") > 10000, "mid").otherwise("low")
    return t["dwd_orders"].select(
        "order_id",
        F.round("order_amount", 1).alias("rounded"),
        number.cast("double").alias("other"),
        F.coalesce(number, F.lit(0)).alias("filled"),
        capped_share(number, F.lit(5.0)).alias("share"),
        F.pow("l_linenumber", F.lit(2)).alias("squared"),
        band.alias("band"),
    )


@register(
    "functions_time",
    """SELECT order_id, CAST(order_time AS DATE) AS day, CAST(order_time AS DATE) - 30 AS before, CAST(order_time AS DATE) + 7 AS after,
 CAST(CAST(order_time AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before, CAST(CAST(order_time AS DATE) - INTERVAL 1 YEAR AS DATE) AS year_before,
 year(order_time) AS y, month(order_time) AS m, epoch(shipping_time - order_time) // 3600 AS hours FROM dwd_orders""",
    "hours",
    "y m",
)
def _(t):
    day = F.to_date("order_time")
    return t["dwd_orders"].select(
        "order_id",
        day.alias("day"),
        F.date_sub(day, 30).alias("before"),
        F.date_add(day, 7).alias("after"),
        F.add_months(day, -1).alias("month_before"),
        F.add_months(day, -12).alias("year_before"),
        F.year("order_time").cast("bigint").alias("y"),
        F.month("order_time").cast("bigint").alias("m"),
        whole_hours(c("order_time"), c("shipping_time")).cast("double").alias("hours"),
    )


@register(
    "functions_text",
    """SELECT product_id, concat(category_name, ':', product_name) AS label, length(product_name) AS size, replace(product_name, ' ', '_') AS name,
 trim(concat('  ', category_name, ' ')) AS trimmed, string_split(product_name, ' ')[1] AS first_word FROM dim_products""",
    bigints="size",
)
def _(t):
    return t["dim_products"].select(
        "product_id",
        F.concat("category_name", F.lit(":"), "product_name").alias("label"),
        F.length("product_name").cast("bigint").alias("size"),
        F.replace("product_name", F.lit(" "), F.lit("_")).alias("name"),
        F.trim(F.concat(F.lit("  "), "category_name", F.lit(" "))).alias("trimmed"),
        F.substring_index("product_name", " ", 1).alias("first_word"),
    )


@register(
    "functions_json",
    """SELECT event_id, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS js, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
 json_keys(props)[1] AS first_key FROM events""",
)
def _(t):
    fields = F.from_json("props", "MAP<STRING, BIGINT>")
    return t["events"].select(
        "event_id",
        F.to_json(F.struct(c("event_id").alias("id"), c("event_type").alias("type"))).alias("js"),
        F.try_element_at(fields, F.lit("k")).alias("k"),
        F.json_object_keys("props")[0].alias("first_key"),
    )
