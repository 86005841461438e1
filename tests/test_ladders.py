"""Boundary values of the scoring, level, lifecycle and risk rules."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.columns import capped_share, growth_percent, ratio
from ledgerloom.plans.merchant_profile import service_level
from ledgerloom.plans.user_profile import user_level, user_score
from ledgerloom.plans.user_reports import annual_level, annual_risk


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "days,orders,amount,score",
    [(27, 0, 0, 10), (28, 0, 0, 15), (20, 5, 0, 5), (10, 6, 0, 5), (0, 11, 1000, 15), (0, 0, 1001, 15), (0, 0, 10001, 30), (28, 11, 50001, 85)],
)
def test_user_score(spark, days, orders, amount, score):
    assert value(spark, user_score(F.lit(days), F.lit(orders), F.lit(amount))) == score


@pytest.mark.parametrize("score,level", [(80, "优质"), (79, "高潜质"), (60, "高潜质"), (59, "中潜质"), (30, "中潜质"), (29, "普通")])
def test_user_level(spark, score, level):
    assert value(spark, user_level(F.lit(score))) == level


# 100 - (returns / orders * 100)^2 at 80, 60, 40
@pytest.mark.parametrize("returns,orders,level", [(0, 0, "D"), (0, 1, "A"), (44, 1000, "A"), (45, 1000, "B"), (63, 1000, "B"), (64, 1000, "C"), (77, 1000, "C"), (78, 1000, "D")])
def test_service_level(spark, returns, orders, level):
    assert value(spark, service_level(F.lit(returns), F.lit(orders))) == level


@pytest.mark.parametrize(
    "top,high,mid,plain,level",
    [
        (9, 3, 0, 0, "年度优质用户"),
        (9, 2, 1, 0, "年度高潜质用户"),
        (9, 2, 0, 1, "年度潜质用户"),
        (8, 1, 0, 0, "年度高潜质用户"),
        (0, 0, 9, 3, "年度潜质用户"),
        (0, 0, 8, 0, "普通用户"),
    ],
)
def test_annual_level(spark, top, high, mid, plain, level):
    assert value(spark, annual_level(*[F.lit(n) for n in (top, high, mid, plain)])) == level


HIGH, TOP, NORMAL = "高风险", "超级高风险", "正常"


@pytest.mark.parametrize(
    "registered,risky,before,before2,flag",
    [
        (2000, 3, None, None, NORMAL),
        (2000, 4, None, None, HIGH),
        (1999, 2, HIGH, None, HIGH),
        (1999, 1, HIGH, None, NORMAL),
        (1999, 3, NORMAL, None, NORMAL),
        (1998, 1, HIGH, TOP, TOP),
        (1998, 0, HIGH, HIGH, NORMAL),
        (1998, 3, HIGH, NORMAL, NORMAL),
        (1990, 4, None, None, HIGH),
        (2001, 9, None, None, NORMAL),
        (None, 9, None, None, NORMAL),
    ],
)
def test_annual_risk(spark, registered, risky, before, before2, flag):
    text = lambda v: F.lit(v).cast("string")
    column = annual_risk(F.lit(2000), F.lit(registered).cast("int"), F.lit(risky), text(before), text(before2))
    assert value(spark, column) == flag


def test_null_and_zero_arithmetic(spark):
    null = F.lit(None).cast("double")
    assert value(spark, capped_share(null, F.lit(1.0))) is None
    assert value(spark, capped_share(F.lit(1), F.lit(0.0))) is None
    assert value(spark, capped_share(F.lit(9), F.lit(1.0))) == 1.0
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, growth_percent(F.lit(3), F.lit(2))) == 50.0
