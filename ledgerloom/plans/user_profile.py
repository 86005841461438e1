"""User profile: lifetime and 30-day behaviour, score, level and preferred categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerloom.functions.columns import between_days, ratio_or_zero, zero_if_null
from ledgerloom.functions.cutoffs import Cutoffs, in_window
from ledgerloom.functions.months import month_numbers
from ledgerloom.operators.changes import changed_users
from ledgerloom.operators.fold import fold, gathered, running_totals
from ledgerloom.schemas import Warehouse

MONEY = "decimal(24,2)"

# Level names and points.
LEVELS = [(80, "优质"), (60, "高潜质"), (30, "中潜质")]
LOWEST_LEVEL = "普通"
UNKNOWN_CATEGORY = "未知"
LOGIN_POINTS = [(27, 15), (20, 10), (10, 5)]
ORDER_POINTS = [(10, 15), (5, 5)]
AMOUNT_POINTS = [(50000, 55), (10000, 30), (1000, 15)]


def ladder(value: Column, steps: list[tuple[int, int]]) -> Column:
    """Points of the first threshold the value exceeds, else 0."""
    chosen = F
    for over, points in steps:
        chosen = chosen.when(value > over, F.lit(points))
    return chosen.otherwise(F.lit(0))


def user_score(login_days: Column, orders: Column, amount: Column) -> Column:
    return ladder(login_days, LOGIN_POINTS) + ladder(orders, ORDER_POINTS) + ladder(amount, AMOUNT_POINTS)


def user_level(score: Column) -> Column:
    chosen = F
    for at_least, name in LEVELS:
        chosen = chosen.when(score >= at_least, F.lit(name))
    return chosen.otherwise(F.lit(LOWEST_LEVEL))


def preferred_categories(orders: DataFrame, products: DataFrame, at: Cutoffs, carried: DataFrame | None = None) -> DataFrame:
    """Per user: categories bought more than five times, else the one bought most; for one snapshot.

    Of several snapshots only those with a purchase have a row: ``frequent`` are the categories bought more than five times,
    NULL where none of them was bought again, and ``most`` is the best of the categories bought then. Totals never fall, so the
    last list and the best so far hold until the next row (``tastes_so_far``), and no month is repeated per category.
    Purchases of one snapshot are counted per product before the category is looked up; ``carried`` has the counts already.
    A user's list is bounded by the number of categories, so collecting it is safe.
    """
    c = F.col
    many = F.expr(
        "listagg(CASE WHEN buy_count > 5 THEN category_name END, ',') "
        "WITHIN GROUP (ORDER BY buy_count DESC, category_name)"
    )
    most = F.min(F.struct((-c("buy_count")).alias("rank"), c("category_name")))
    categories = products.select("product_id", "category_name")
    if at.single:
        counts = carried.withColumn("as_of", F.lit(at.last)) if carried is not None else (
            between_days(orders, "order_time", None, at.upper())
            .select("user_id", "product_id", at.first_seen(F.to_date("order_time")).alias("as_of"))
            .groupBy("user_id", "product_id", "as_of")
            .agg(F.count(F.lit(1)).alias("bought"))
            .join(categories, "product_id", "left")
            .groupBy("user_id", "category_name", "as_of")
            .agg(F.sum("bought").alias("buy_count"))
        )
        preferred = F.coalesce(many, most.getField("category_name"))
        return counts.groupBy("user_id", "as_of").agg(preferred.alias("preferred_category"))

    # a product is seldom bought twice by a user in a month: counting before the look-up would only shuffle once more
    counts = (
        between_days(orders, "order_time", None, at.upper())
        .select("user_id", "product_id", at.first_seen(F.to_date("order_time")).alias("as_of"))
        .join(categories, "product_id", "left")
        .groupBy("user_id", "category_name", "as_of")
        .agg(F.count(F.lit(1)).alias("buy_count"))
    )
    totals = running_totals(counts, ["user_id", "category_name"], "as_of", ["buy_count"])
    following = F.lead("as_of").over(Window.partitionBy("user_id", "category_name").orderBy("as_of"))
    frequent = (c("buy_count") > 5) & c("category_name").isNotNull()
    # snapshots at which a user's list changes: a total stands at each of them until the category's next purchase
    changes = F.collect_set(F.when(frequent, c("as_of"))).over(Window.partitionBy("user_id"))
    totals = totals.withColumn("following", following).withColumn("changes", changes)
    stands = F.filter("changes", lambda at_: (at_ >= c("as_of")) & (c("following").isNull() | (at_ < c("following"))))
    rows = totals.select(
        "user_id", "category_name", "buy_count", F.explode(F.when(frequent, stands).otherwise(F.array("as_of"))).alias("as_of")
    )
    return rows.groupBy("user_id", "as_of").agg(many.alias("frequent"), most.alias("most"))


def tastes_so_far(upto: WindowSpec) -> Column:
    """The preferred categories after each row of ``preferred_categories``; ``upto`` runs over a user's rows up to it."""
    last_list = F.last("frequent", ignorenulls=True).over(upto)
    return F.coalesce(last_list, F.min("most").over(upto).getField("category_name"))


def standing(cells: DataFrame, at: Cutoffs) -> DataFrame:
    """Members at every snapshot, from their rows at the first one and at those with facts.

    Lifetime counters and preferences stand until the user's next row; the 30-day counters are those of a row's own snapshot. The
    windows see a row per user and snapshot with facts, and share one exchange by user, which the result keeps.
    """
    c = F.col
    by_user = Window.partitionBy("user_id").orderBy("as_of")
    upto = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ["total_order_amount", "total_order_count", "total_return_count"]
    maxima = ["last_order_date", "member", "register_date"]
    totals = {m: F.sum(m).over(upto) for m in sums} | {m: F.max(m).over(upto) for m in maxima}
    until = F.coalesce(F.lead("as_of").over(by_user), F.add_months(F.lit(at.last), 1))
    # a NULL user's facts are counted, but no preference is looked up for them
    preferred = F.when(c("user_id").isNotNull(), tastes_so_far(upto))
    filled = gathered(cells, "user_id").withColumns({**totals, "preferred_category": preferred, "until": until}).filter("member")
    # counted in whole months, as a sequence of dates costs far more than one of numbers
    months_on = F.explode(month_numbers(c("as_of"), c("until")))
    rows = filled.withColumn("n", months_on).withColumn("at", F.add_months("as_of", c("n")))
    own = c("at") == c("as_of")
    recent = {m: F.when(own, c(m)) for m in ["last_30d_login_days", "last_30d_view_cnt", "last_30d_order_amount"]}
    counts = {m: F.when(own, c(m)).otherwise(F.lit(0).cast("bigint")) for m in ["last_30d_order_cnt", "last_30d_return_cnt"]}
    return rows.withColumns(recent | counts).drop("as_of", "until", "n", "frequent", "most").withColumnRenamed("at", "as_of")


def user_profile(
    wh: Warehouse, at: Cutoffs, changed_only: bool = False, carried: DataFrame | None = None, tastes: DataFrame | None = None
) -> DataFrame:
    """One row per user and snapshot date.

    The 30-day counters run from 30 days before the snapshot through the snapshot day (``Cutoffs.on(day,
    open_end=True)``: through everything stored). ``changed_only`` is the incremental form: users touched
    since 30 days before the day. Other users are dropped from the counted rows, one a user: where the touched ones are too
    many to broadcast, dropping their facts would shuffle and sort every fact row instead of map-side aggregates.
    ``carried`` and ``tastes`` (``Lifetime.users``, ``Lifetime.tastes`` after the day) replace the count over all facts,
    of which only the 30 days are read then.
    """
    c = F.col
    since = None if carried is None else at.lower(30)
    users, orders, returns, actions = wh.users, wh.orders, wh.returns, wh.actions
    if not at.single and (changed_only or carried is not None):
        raise ValueError("the incremental form works on one date")

    def recent(day: str = "day") -> Column:
        return in_window(c(day), 30, closed=True, open_end=at.open_end)

    # further snapshots of a user are laid out after all counting, so the grid is never shuffled
    members = users.select(
        "user_id", F.to_date("created_time").alias("register_date"), F.lit(True).alias("member"), F.lit(at.first).alias("as_of")
    )
    bought = at.spread(
        between_days(orders, "order_time", since, at.upper()).select(
            "user_id", "order_id", "order_time", "order_amount", F.to_date("order_time").alias("day")
        ),
        c("day"),
    ).select(
        "user_id",
        "as_of",
        F.when(c("is_new"), c("order_amount")).alias("life_amount"),
        F.when(c("is_new"), c("order_id")).alias("life_order"),
        F.when(c("is_new"), c("order_time")).alias("last_order"),
        F.when(recent(), c("order_amount")).alias("recent_amount"),
        F.when(recent(), c("order_id")).alias("recent_order"),
    )
    returned = at.spread(
        between_days(returns, "apply_time", since, at.upper()).select(
            "user_id", "return_id", F.to_date("apply_time").alias("day")
        ),
        c("day"),
    ).select(
        "user_id",
        "as_of",
        F.when(c("is_new"), c("return_id")).alias("life_return"),
        F.when(recent(), c("return_id")).alias("recent_return"),
    )
    # one row per user and day, so login days can be counted without a distinct
    active_days = (
        between_days(actions, "action_time", at.lower(30), at.upper())
        .filter(c("action_type").isin("login", "browse"))
        .groupBy("user_id", F.to_date("action_time").alias("day"))
        .agg(
            F.max((c("action_type") == "login").cast("int")).alias("logged_in"),
            F.count_if(c("action_type") == "browse").alias("views"),
        )
    )
    active = at.spread(active_days, c("day")).filter(recent()).select("user_id", "as_of", "logged_in", "views")

    frames = [members, bought, returned, active]
    lifetime = {
        "total_order_amount": F.sum("life_amount"),
        "total_order_count": F.count("life_order"),
        "total_return_count": F.count("life_return"),
        "last_order_date": F.max("last_order"),
    }
    if carried is not None:
        frames.append(at.grid(carried))
        lifetime = {m: zero_if_null(F.sum(m)) if m.endswith("count") else F.max(m) for m in lifetime}
    folded = fold(
        ["user_id", "as_of"],
        {
            "member": F.max("member"),
            "register_date": F.max("register_date"),
            **lifetime,
            "last_30d_login_days": F.sum("logged_in"),
            "last_30d_view_cnt": F.sum("views"),
            "last_30d_order_cnt": F.count("recent_order"),
            "last_30d_order_amount": F.sum("recent_amount"),
            "last_30d_return_cnt": F.count("recent_return"),
        },
        *frames,
    )
    if changed_only:
        folded = folded.join(changed_users(wh, at.last), "user_id", "left_semi")
    # every snapshot with a purchase has a folded row, so no preference is lost
    tastes_at = preferred_categories(orders, wh.products, at, tastes)
    folded = folded.join(tastes_at, ["user_id", "as_of"], "left")
    if not at.single:
        folded = standing(folded, at)
    amount = zero_if_null(c("last_30d_order_amount"), MONEY).cast(MONEY)
    logins, views = zero_if_null(c("last_30d_login_days")), zero_if_null(c("last_30d_view_cnt"))
    return (
        folded.filter(c("member"))
        .withColumn("user_score", user_score(logins, c("last_30d_order_cnt"), amount))
        .select(
            c("as_of").alias("stat_date"),
            "user_id",
            "register_date",
            zero_if_null(c("total_order_amount"), MONEY).cast(MONEY).alias("total_order_amount"),
            "total_order_count",
            "total_return_count",
            "last_order_date",
            logins.alias("last_30d_login_days"),
            views.alias("last_30d_view_cnt"),
            "last_30d_order_cnt",
            amount.alias("last_30d_order_amount"),
            "last_30d_return_cnt",
            ratio_or_zero(c("last_30d_order_amount"), c("last_30d_order_cnt")).alias("avg_order_amount_30d"),
            "user_score",
            user_level(c("user_score")).alias("user_level"),
            F.coalesce("preferred_category", F.lit(UNKNOWN_CATEGORY)).alias("preferred_category"),
        )
    )
