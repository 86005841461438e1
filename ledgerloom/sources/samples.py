"""Warehouse tables derived from the sample star schema (see FIXTURES.md).

Each view is one SELECT whose text means the same to Spark and to the checking engine, so the checks
can inline it. Everything is row-local or a key join; no view numbers or sorts rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schemas import Warehouse

# Columns of the sample files; stating them saves a footer-reading job per table and plan.
BASE_TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

VIEWS = {
    "users": """
SELECT concat('U', c_custkey) AS user_id, c_name AS user_name, concat('N', c_nationkey) AS us_address,
       TIMESTAMP '1995-01-01 00:00:00' + (c_custkey % 2404) * INTERVAL '1' DAY AS created_time,
       TIMESTAMP '1995-01-01 00:00:00' + (c_custkey % 2404) * INTERVAL '1' DAY AS updated_time
FROM {customer}""",
    "dim_merchants": """
SELECT concat('M', s_suppkey) AS merchant_id, s_name AS merchant_name,
       TIMESTAMP '1995-01-01 00:00:00' + (s_suppkey % 365) * INTERVAL '1' DAY AS register_time,
       CASE WHEN s_acctbal < 0 THEN 'inactive' ELSE 'active' END AS merchant_status,
       TIMESTAMP '1995-01-01 00:00:00' + (s_suppkey % 365) * INTERVAL '1' DAY AS updated_time
FROM {supplier}""",
    "dim_products": """
SELECT concat('P', p_partkey) AS product_id,
       concat('M', p_partkey % (SELECT count(*) FROM {supplier})) AS merchant_id,
       p_name AS product_name, concat('CAT', p_type) AS product_category_id, p_type AS category_name,
       TIMESTAMP '1995-01-01 00:00:00' + (p_partkey % 365) * INTERVAL '1' DAY AS listing_time,
       p_size * 2 AS current_stock,
       CASE p_size % 4 WHEN 0 THEN 'inactive' WHEN 1 THEN 'out_of_stock' ELSE 'active' END AS product_status,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       TIMESTAMP '1995-01-01 00:00:00' + (p_partkey % 365) * INTERVAL '1' DAY AS updated_time
FROM {part}""",
    "dim_promotions": """
SELECT DISTINCT concat('PROMO', substr(o_orderpriority, 1, 1)) AS promotion_id,
       substr(o_orderpriority, 3) AS promotion_name,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Full reduction' WHEN '2' THEN 'Discount'
            WHEN '3' THEN 'Coupon' WHEN '4' THEN 'Limited-Time Sale' ELSE 'Bundle Deal' END AS promotion_type,
       TIMESTAMP '1995-01-01 00:00:00' AS start_time, TIMESTAMP '2001-12-31 00:00:00' AS end_time,
       CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN 'Completed' ELSE 'In Progress' END AS promotion_status
FROM {orders}""",
    "dwd_orders": """
SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
                 CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING)) AS order_id,
       concat('U', o_custkey) AS user_id, concat('P', l_partkey) AS product_id,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS order_amount,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'shipped' END AS order_status,
       CASE WHEN l_discount >= 0.03 THEN concat('PROMO', substr(o_orderpriority, 1, 1)) END AS promotion_id,
       o_orderdate + l_linenumber * INTERVAL '1' HOUR AS order_time,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + (6 * l_linenumber) * INTERVAL '1' HOUR END AS shipping_time,
       l_returnflag, l_linestatus, l_quantity, l_linenumber
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "returns": """
SELECT concat('R', o.order_id) AS return_id, o.order_id, o.user_id, p.merchant_id,
       o.order_time + (1 + o.l_linenumber) * INTERVAL '1' DAY AS apply_time,
       CASE WHEN o.l_linestatus = 'F' THEN o.order_time + (1 + o.l_linenumber) * INTERVAL '1' DAY
            + INTERVAL '30' HOUR END AS approved_time,
       CASE WHEN o.l_linestatus = 'O' AND o.l_linenumber % 2 = 0 THEN o.order_time
            + (1 + o.l_linenumber) * INTERVAL '1' DAY + INTERVAL '12' HOUR END AS rejected_time,
       o.order_amount AS refund_amount
FROM {dwd_orders} o JOIN {dim_products} p ON o.product_id = p.product_id
WHERE o.l_returnflag = 'R' AND o.l_quantity <= 7""",
    "user_actions": """
SELECT event_id AS action_id, concat('U', user_id) AS user_id,
       CASE event_type WHEN 'view' THEN 'browse' WHEN 'click' THEN 'login' WHEN 'signup' THEN 'register'
            WHEN 'purchase' THEN 'purchase' ELSE 'logout' END AS action_type,
       TIMESTAMP '1995-01-01 00:00:00' + ((event_id * 37) % 2404) * INTERVAL '1' DAY
       + (event_id % 86400) * INTERVAL '1' SECOND AS action_time
FROM {events}""",
    "merchant_operations": """
SELECT p.merchant_id,
       CASE l.l_linenumber % 4 WHEN 0 THEN 'add_product' WHEN 1 THEN 'remove_product'
            WHEN 2 THEN 'update_price' ELSE 'update_stock' END AS operation_type,
       CAST(l.l_extendedprice AS DECIMAL(10,2)) AS new_place, p.product_id, l.l_shipdate AS operation_time
FROM {lineitem} l JOIN {dim_products} p ON concat('P', l.l_partkey) = p.product_id""",
}


class SampleTables:
    """Base tables and derived views by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in BASE_TABLES:
                reader = self.spark.read.schema(BASE_TABLES[name])
                self._built[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                self._built[name] = self.sql(VIEWS[name])
        return self._built[name]

    def sql(self, text: str) -> DataFrame:
        """Run SQL that names tables and views in braces."""
        used = {n: self[n] for n in [*BASE_TABLES, *VIEWS] if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


def sample_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    t = SampleTables(spark, sf_dir)
    return Warehouse(
        users=t["users"],
        merchants=t["dim_merchants"],
        products=t["dim_products"],
        promotions=t["dim_promotions"],
        orders=t["dwd_orders"],
        returns=t["returns"],
        actions=t["user_actions"],
        operations=t["merchant_operations"],
    )
