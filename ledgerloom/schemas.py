"""Table definitions of the cleaned layer: columns, types, required cells, enums and keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Reference:
    """Foreign key: column -> table.column; ``nullable`` keeps rows that leave it blank."""

    column: str
    table: str
    ref_column: str
    nullable: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    types: dict[str, str]
    required: list[str]
    strict_required: list[str] = field(default_factory=list)
    key: str | None = None
    times: list[str] = field(default_factory=list)
    required_times: list[str] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)
    enums: dict[str, list[str]] = field(default_factory=dict)
    nullable_enums: frozenset[str] = frozenset()
    booleans: list[str] = field(default_factory=list)
    json: list[str] = field(default_factory=list)
    references: list[Reference] = field(default_factory=list)
    times_first: bool = False
    event_time: str | None = None
    # columns the table fills with the load time
    stamps: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# Columns, types, enum domains and required cells of the nine cleaned tables.
USERS = TableSpec(
    name="users",
    types={"user_id": "string", "user_name": "string", "us_address": "string"},
    required=["user_id", "user_name"],
    key="user_id",
    stamps=["created_time", "updated_time"],
)
MERCHANTS = TableSpec(
    name="dim_merchants",
    types={
        "merchant_id": "string",
        "merchant_name": "string",
        "register_time": "timestamp",
        "merchant_status": "string",
        "contact_info": "string",
    },
    required=["merchant_id", "merchant_name", "register_time"],
    key="merchant_id",
    times=["register_time"],
    required_times=["register_time"],
    enums={"merchant_status": ["active", "inactive", "banned"]},
    stamps=["updated_time"],
)
PROMOTIONS = TableSpec(
    name="dim_promotions",
    types={
        "promotion_id": "string",
        "promotion_name": "string",
        "promotion_type": "string",
        "applicable_categories": "string",
        "discount_rules": "string",
        "start_time": "timestamp",
        "end_time": "timestamp",
        "promotion_status": "string",
        "target_audience": "string",
    },
    required=[
        "promotion_id",
        "promotion_name",
        "promotion_type",
        "discount_rules",
        "start_time",
        "end_time",
        "promotion_status",
    ],
    key="promotion_id",
    times=["start_time", "end_time"],
    enums={
        "promotion_type": ["Full reduction", "Discount", "Coupon", "Limited-Time Sale", "Bundle Deal"],
        "promotion_status": ["Not Started", "In Progress", "Completed", "Cancelled"],
    },
    json=["applicable_categories", "discount_rules"],
    times_first=True,
)
PRODUCTS = TableSpec(
    name="dim_products",
    types={
        "product_id": "string",
        "merchant_id": "string",
        "product_name": "string",
        "product_category_id": "string",
        "category_name": "string",
        "listing_time": "timestamp",
        "delisting_time": "timestamp",
        "current_stock": "bigint",
        "product_status": "string",
        "price": "decimal(10,2)",
        "average_rating": "decimal(3,2)",
        "rating_count": "bigint",
        "product_lifecycle": "string",
    },
    required=[
        "product_id",
        "merchant_id",
        "product_name",
        "product_category_id",
        "category_name",
        "listing_time",
        "product_status",
        "price",
    ],
    key="product_id",
    times=["listing_time", "delisting_time"],
    required_times=["listing_time"],
    enums={
        "product_status": ["active", "inactive", "out_of_stock", "banned"],
        "product_lifecycle": ["new", "hot", "normal", "declining", "discontinued"],
    },
    nullable_enums=frozenset({"product_lifecycle"}),
    references=[Reference("merchant_id", "dim_merchants", "merchant_id")],
    stamps=["updated_time"],
)
ORDERS = TableSpec(
    name="orders",
    types={
        "order_id": "string",
        "user_id": "string",
        "product_id": "string",
        "order_amount": "decimal(10,2)",
        "order_status": "string",
        "shipping_address": "string",
        "promotion_id": "string",
        "coupon_info": "string",
        "data_quality_flag": "string",
        "order_time": "timestamp",
        "payment_time": "timestamp",
        "shipping_time": "timestamp",
        "complete_time": "timestamp",
    },
    required=["order_id", "user_id", "product_id", "order_amount", "order_status", "order_time"],
    strict_required=[
        "order_id",
        "user_id",
        "product_id",
        "order_amount",
        "order_status",
        "shipping_address",
        "coupon_info",
        "data_quality_flag",
        "order_time",
        "payment_time",
        "shipping_time",
        "complete_time",
    ],
    key="order_id",
    times=["order_time", "payment_time", "shipping_time", "complete_time"],
    required_times=["order_time"],
    enums={
        "order_status": ["pending", "paid", "shipped", "completed", "cancelled", "refunded"],
        "data_quality_flag": ["valid", "invalid", "suspicious"],
    },
    nullable_enums=frozenset({"data_quality_flag"}),
    json=["coupon_info"],
    references=[
        Reference("user_id", "users", "user_id"),
        Reference("product_id", "dim_products", "product_id"),
        Reference("promotion_id", "dim_promotions", "promotion_id", nullable=True),
    ],
    event_time="order_time",
)
USER_ACTIONS = TableSpec(
    name="user_actions",
    types={
        "user_id": "string",
        "session_id": "string",
        "action_type": "string",
        "action_time": "timestamp",
        "product_id": "string",
        "stay_duration_seconds": "int",
        "device_type": "string",
        "is_abnormal": "int",
        "abnormal_reason": "string",
    },
    required=["user_id", "action_type", "action_time"],
    times=["action_time"],
    required_times=["action_time"],
    enums={
        "action_type": ["register", "login", "browse", "favorite", "add_cart", "purchase", "search", "logout"],
    },
    booleans=["is_abnormal"],
    references=[
        Reference("user_id", "users", "user_id"),
        Reference("product_id", "dim_products", "product_id", nullable=True),
    ],
    event_time="action_time",
)
RETURNS = TableSpec(
    name="returns",
    types={
        "return_id": "string",
        "order_id": "string",
        "user_id": "string",
        "merchant_id": "string",
        "return_reason_category": "string",
        "return_reason_detail": "string",
        "return_status": "string",
        "apply_time": "timestamp",
        "approved_time": "timestamp",
        "rejected_time": "timestamp",
        "shipped_back_time": "timestamp",
        "received_time": "timestamp",
        "refund_time": "timestamp",
        "refund_amount": "decimal(10,2)",
        "return_quantity": "int",
        "data_consistency_flag": "string",
    },
    required=[
        "return_id",
        "order_id",
        "user_id",
        "merchant_id",
        "return_reason_category",
        "return_status",
        "apply_time",
        "return_quantity",
    ],
    key="return_id",
    times=["apply_time", "approved_time", "rejected_time", "shipped_back_time", "received_time", "refund_time"],
    required_times=["apply_time"],
    enums={
        "return_reason_category": [
            "quality_issue",
            "wrong_item",
            "damaged",
            "size_issue",
            "not_as_described",
            "other",
        ],
        "return_status": ["applied", "approved", "rejected", "shipped_back", "received", "refunded"],
        "data_consistency_flag": ["consistent", "inconsistent"],
    },
    nullable_enums=frozenset({"data_consistency_flag"}),
    references=[
        Reference("order_id", "orders", "order_id"),
        Reference("user_id", "users", "user_id"),
        Reference("merchant_id", "dim_merchants", "merchant_id"),
    ],
    event_time="apply_time",
)
OPERATIONS = TableSpec(
    name="merchant_operations",
    types={
        "merchant_id": "string",
        "operation_type": "string",
        "new_place": "decimal(10,2)",
        "product_id": "string",
        "operation_time": "timestamp",
    },
    required=["merchant_id", "operation_type", "product_id", "operation_time"],
    times=["operation_time"],
    required_times=["operation_time"],
    enums={"operation_type": ["add_product", "remove_product", "update_price", "update_stock"]},
    references=[
        Reference("merchant_id", "dim_merchants", "merchant_id"),
        Reference("product_id", "dim_products", "product_id"),
    ],
    event_time="operation_time",
)
ALERTS = TableSpec(
    name="data_quality_alerts",
    types={
        "check_type": "string",
        "problem_description": "string",
        "problem_count": "int",
        "severity": "string",
        "check_time": "timestamp",
        "data_date": "date",
        "resolved": "int",
        "resolution_notes": "string",
        "resolved_time": "timestamp",
    },
    required=["check_type", "problem_description", "problem_count", "check_time", "data_date"],
    times=["check_time", "resolved_time"],
    required_times=["check_time"],
    dates=["data_date"],
    enums={"severity": ["low", "medium", "high", "critical"]},
    nullable_enums=frozenset({"severity"}),
    booleans=["resolved"],
    event_time="check_time",
)

# Cleaning order: a table comes after the ones its keys point to.
SPECS = {
    spec.name: spec
    for spec in (USERS, MERCHANTS, PROMOTIONS, ALERTS, PRODUCTS, OPERATIONS, USER_ACTIONS, ORDERS, RETURNS)
}


@dataclass(frozen=True)
class Warehouse:
    """The cleaned tables a model reads.

    Primary keys (order_id, return_id, user_id, merchant_id, product_id, promotion_id) are unique:
    the key repair in ``operators.keys`` makes them so and ``operators.quality`` checks it before the
    models run. The models therefore count rows where the definition counts distinct keys, which
    keeps those counters in the map-side part of the aggregate.
    """

    users: DataFrame
    merchants: DataFrame
    products: DataFrame
    promotions: DataFrame
    orders: DataFrame
    returns: DataFrame
    actions: DataFrame
    operations: DataFrame
