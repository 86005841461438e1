"""The cleaners as registered queries over dirty extracts, with SQL built from the same table definitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions.columns import TIME_FORMATS, parse_boolean, parse_timestamp
from ledgerloom.operators import cleaning as rules
from ledgerloom.operators.key_index import KeyIndex
from ledgerloom.operators.keys import repair_duplicates, resolve_conflicts, row_digest
from ledgerloom.plans.cleaners import clean_table
from ledgerloom.schemas import SPECS, TableSpec
from ledgerloom.session import scratch_path
from ledgerloom.sources.samples import BASE_TABLES, VIEWS, SampleTables
from verification.dirty import EXTRACTS, REFERENCED, STORED
from verification.oracles import with_views
from verification.shape import plain

STRPTIME = (
    "['%Y-%m-%d %H:%M:%S','%Y/%m/%d %H:%M','%d-%m-%Y %H:%M','%Y%m%d%H%M%S','%Y-%m-%d','%Y/%m/%d','%Y-%m-%d %H:%M',"
    "'%Y%m%d','%d/%m/%Y %H:%M','%Y-%m-%dT%H:%M:%S']"
)
TRUE_SQL, FALSE_SQL = "('true','t','yes','y','1')", "('false','f','no','n','0')"


def named(text: str) -> str:
    """Braces off: table and view names as DuckDB knows them."""
    for table in [*BASE_TABLES, *VIEWS]:
        text = text.replace("{" + table + "}", table)
    return text.replace("{{", "{").replace("}}", "}")


def extract(t: SampleTables, name: str):
    return t.sql(EXTRACTS[name])


def cleaned(t: SampleTables, name: str, strict: bool = False):
    spec = SPECS[name]
    references = {ref.table: t[REFERENCED[ref.table]] for ref in spec.references}
    stored = t.sql(STORED[name]) if name in STORED else None
    return clean_table(extract(t, name), spec, references, stored, strict)


# --- SQL twin ----------------------------------------------------------------------------------------


def parse_sql(c: str) -> str:
    return f"try_strptime(trim({c}), {STRPTIME})"


def boolean_sql(c: str) -> str:
    w = f"lower(trim({c}))"
    return f"""CASE WHEN {w} IN {TRUE_SQL} THEN 1 WHEN {w} IN {FALSE_SQL} THEN 0
 WHEN TRY_CAST({w} AS DOUBLE) IS NOT NULL THEN CASE WHEN TRY_CAST({w} AS DOUBLE) <> 0 THEN 1 ELSE 0 END ELSE 0 END"""


def enum_sql(c: str, allowed: list[str]) -> str:
    cases = " ".join(f"WHEN '{v.lower()}' THEN '{v}'" for v in allowed)
    return f"CASE lower(trim({c})) {cases} END"


def json_sql(c: str) -> str:
    return f"CASE WHEN json_valid({c}) THEN CAST(json({c}) AS VARCHAR) WHEN {c} IS NOT NULL THEN CAST(to_json({c}) AS VARCHAR) END"


def duplicate_ctes(source: str, key: str, columns: list[str]):
    """source -> deduped, by brute force over candidate numbers."""
    others = ", ".join(c for c in columns if c != key)
    return [
        ("ranked", f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _digest) AS rn FROM {source}"),
        (
            "taken",
            f"""SELECT DISTINCT regexp_extract({key}, '^(.*)_dup([1-9][0-9]*)$', 1) AS base,
 TRY_CAST(regexp_extract({key}, '^(.*)_dup([1-9][0-9]*)$', 2) AS BIGINT) AS k FROM {source}
WHERE regexp_matches({key}, '^(.*)_dup([1-9][0-9]*)$')""",
        ),
        (
            "candidates",
            f"""SELECT base, unnest(range(1, top + 1)) AS k FROM (SELECT {key} AS base,
 max(rn) + (SELECT count(*) FROM taken t WHERE t.base = {key}) AS top FROM ranked GROUP BY 1 HAVING max(rn) > 1)""",
        ),
        (
            "free",
            """SELECT base, k, row_number() OVER (PARTITION BY base ORDER BY k) AS nth FROM candidates c
WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.base = c.base AND t.k = c.k)""",
        ),
        (
            "deduped",
            f"""SELECT CASE WHEN rn = 1 THEN {key} ELSE {key} || '_dup' || k END AS {key}{', ' + others if others else ''}
FROM ranked LEFT JOIN free ON base = {key} AND nth = rn - 1""",
        ),
    ]


def conflict_ctes(name: str, key: str, columns: list[str]):
    others = ", ".join(c for c in columns if c != key)
    return [
        ("stored", named(STORED[name])),
        (
            "used",
            f"""SELECT DISTINCT regexp_extract(i, '^(.*)_new([1-9][0-9]*)$', 1) AS base,
 TRY_CAST(regexp_extract(i, '^(.*)_new([1-9][0-9]*)$', 2) AS BIGINT) AS k
FROM (SELECT {key} AS i FROM stored UNION ALL SELECT {key} FROM deduped) WHERE regexp_matches(i, '^(.*)_new([1-9][0-9]*)$')""",
        ),
        (
            "resolved",
            f"""SELECT CASE WHEN {key} IN (SELECT {key} FROM stored) THEN {key} || '_new' || (
 SELECT min(c.k) FROM (SELECT unnest(range(1, 12)) AS k) c
 WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.base = d.{key} AND u.k = c.k)) ELSE {key} END AS {key}
 {', ' + others if others else ''} FROM deduped d""",
        ),
    ]


def checked_ctes(spec: TableSpec, strict: bool = False):
    required = spec.strict_required if strict and spec.strict_required else spec.required
    source = named(EXTRACTS[spec.name])
    text = ", ".join(f"nullif(trim(CAST({c} AS VARCHAR)), '') AS {c}" for c in spec.columns)
    digest = "md5(concat_ws(chr(1), " + ", ".join(f"coalesce({c}, chr(2))" for c in spec.columns) + "))"
    parsed, conditions = [], []
    nulls = [(f"{c} IS NULL", "not_null", c) for c in required]
    times = [(f"p_{c} IS NULL", "timestamp", c) for c in spec.required_times]
    if spec.times_first:
        # an unreadable required time is found by the later check for missing cells
        nulls = [(f"p_{c} IS NULL" if c in spec.times else cond, rule, c) for cond, rule, c in nulls]
    conditions += times + nulls if spec.times_first else nulls + times
    for c in spec.times:
        parsed.append(f"{parse_sql(c)} AS p_{c}")
    for c in spec.dates:
        parsed.append(f"CAST({parse_sql(c)} AS DATE) AS p_{c}")
        conditions.append((f"p_{c} IS NULL", "date", c))
    for c, allowed in spec.enums.items():
        parsed.append(f"{enum_sql(c, allowed)} AS p_{c}")
        cond = f"p_{c} IS NULL" + (f" AND {c} IS NOT NULL" if c in spec.nullable_enums else "")
        conditions.append((cond, "enum", c))
    for c in spec.booleans:
        parsed.append(f"{boolean_sql(c)} AS p_{c}")
    for c in spec.json:
        parsed.append(f"{json_sql(c)} AS p_{c}")
    done = {*spec.times, *spec.dates, *spec.enums, *spec.booleans, *spec.json}
    for ref in spec.references:
        missing = f"{ref.column} NOT IN (SELECT {ref.ref_column} FROM {REFERENCED[ref.table]})"
        optional = ref.nullable and not strict
        conditions.append(
            (f"{ref.column} IS NOT NULL AND {missing}" if optional else f"({ref.column} IS NULL OR {missing})", "foreign_key", ref.column)
        )
    for c, kind in spec.types.items():
        if c not in done:
            parsed.append(f"TRY_CAST({c} AS {kind.upper().replace('STRING', 'VARCHAR')}) AS p_{c}")
            if c in required and kind != "string":
                conditions.append((f"p_{c} IS NULL", "type", c))
    rule = " ".join(f"WHEN {cond} THEN {i}" for i, (cond, _, _) in enumerate(conditions))
    return conditions, [
        ("raw_rows", source),
        ("text_rows", f"SELECT {text} FROM raw_rows"),
        ("parsed_rows", f"SELECT *, {digest} AS _digest, {', '.join(parsed)} FROM text_rows"),
        ("checked", f"SELECT *, CASE {rule} END AS broken FROM parsed_rows"),
        (
            "accepted",
            "SELECT _digest, " + ", ".join(f"p_{c} AS {c}" for c in spec.columns) + " FROM checked WHERE broken IS NULL",
        ),
    ]


def _final_columns(spec: TableSpec) -> str:
    """Decimals as doubles, like the Spark side."""
    out = []
    for c, kind in spec.types.items():
        out.append(f"round(CAST({c} AS DOUBLE), 6) AS {c}" if kind.startswith("decimal") else c)
    return ", ".join(out)


def clean_sql(name: str, strict: bool = False) -> str:
    spec = SPECS[name]
    _, ctes = checked_ctes(spec, strict)
    last = "accepted"
    if spec.key:
        ctes += duplicate_ctes("accepted", spec.key, spec.columns)
        last = "deduped"
        if name in STORED:
            ctes += conflict_ctes(name, spec.key, spec.columns)
            last = "resolved"
    return with_views(*ctes, final=f"SELECT {_final_columns(spec)} FROM {last}")


def rejected_sql(name: str) -> str:
    spec = SPECS[name]
    conditions, ctes = checked_ctes(spec)
    rule = " ".join(f"WHEN {i} THEN '{r}'" for i, (_, r, _) in enumerate(conditions))
    column = " ".join(f"WHEN {i} THEN '{c}'" for i, (_, _, c) in enumerate(conditions))
    # the offending cell is shown raw, except where the table's times were parsed before the check
    def shown(i, c, r):
        return f"WHEN {i} THEN " + ("NULL" if r == "not_null" else c)

    value = " ".join(shown(i, c, r) for i, (_, r, c) in enumerate(conditions))
    key = spec.key or "CAST(NULL AS VARCHAR)"
    return with_views(
        *ctes,
        final=f"""SELECT '{name}' AS table_name, {key} AS row_key, CASE broken {rule} END AS rule,
 CASE broken {column} END AS column_name, CASE broken {value} END AS value FROM checked WHERE broken IS NOT NULL""",
    )


QUERIES, ORACLES = {}, {}


def register(name: str, build, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(build(SampleTables(spark, sf_dir)))
    if sql is not None:
        ORACLES[name] = sql


for _name in SPECS:
    register(f"clean_{_name}", lambda t, n=_name: cleaned(t, n).rows, clean_sql(_name))
    register(f"rejected_{_name}", lambda t, n=_name: cleaned(t, n).rejected, rejected_sql(_name))
register("clean_orders_strict", lambda t: cleaned(t, "orders", strict=True).rows, clean_sql("orders", True))


# --- single rules ------------------------------------------------------------------------------------

_CHECKED = {name: checked_ctes(SPECS[name]) for name in SPECS}


def over_extract(name: str, final: str) -> str:
    return with_views(("raw_rows", named(EXTRACTS[name])), final=final)


register(
    "rule_extra_columns",
    lambda t: extract(t, "users").select(
        F.array_join(F.lit(rules.extra_columns(extract(t, "users"), SPECS["users"].columns)), ",").alias("extra"),
        "user_id",
    ),
    over_extract("users", "SELECT 'created_time' AS extra, user_id FROM raw_rows"),
)
register(
    "rule_not_null",
    lambda t: _kept(
        rules.require(rules.project(extract(t, "users"), SPECS["users"].columns, ["user_id"]), SPECS["users"].required)
    ),
    over_extract(
        "users",
        """SELECT nullif(trim(user_id), '') AS user_id, nullif(trim(user_name), '') AS user_name, nullif(trim(us_address), '') AS us_address
FROM raw_rows WHERE nullif(trim(user_id), '') IS NOT NULL AND nullif(trim(user_name), '') IS NOT NULL""",
    ),
)
register(
    "rule_timestamps",
    lambda t: extract(t, "user_actions").select(
        "action_id", "action_time", parse_timestamp(F.col("action_time")).alias("parsed")
    ),
    over_extract("user_actions", f"SELECT action_id, action_time, {parse_sql('action_time')} AS parsed FROM raw_rows"),
)
register(
    "rule_enum",
    lambda t: _kept(
        rules.normalize_enums(
            rules.project(extract(t, "dim_promotions"), ["promotion_type", "promotion_id"], []),
            {"promotion_type": SPECS["dim_promotions"].enums["promotion_type"]},
        )
    ),
    over_extract(
        "dim_promotions",
        f"""SELECT * FROM (SELECT {enum_sql("promotion_type", SPECS["dim_promotions"].enums["promotion_type"])} AS promotion_type,
 promotion_id FROM raw_rows) WHERE promotion_type IS NOT NULL""",
    ),
)
register(
    "rule_json",
    lambda t: rules.normalize_json(extract(t, "orders").select("order_id", "coupon_info"), "coupon_info"),
    over_extract("orders", f"SELECT order_id, {json_sql('coupon_info')} AS coupon_info FROM raw_rows"),
)
register(
    "rule_foreign_key",
    lambda t: _kept(
        rules.require_reference(
            rules.project(extract(t, "user_actions"), ["user_id", "product_id"], []),
            "product_id",
            t["dim_products"],
            "product_id",
        )
    ),
    over_extract(
        "user_actions",
        "SELECT user_id, product_id FROM raw_rows WHERE product_id IN (SELECT product_id FROM dim_products)",
    ),
)
register(
    "rule_foreign_key_optional",
    lambda t: _kept(
        rules.require_reference(
            rules.project(extract(t, "user_actions"), ["user_id", "product_id"], []),
            "product_id",
            t["dim_products"],
            "product_id",
            nullable=True,
        )
    ),
    over_extract(
        "user_actions",
        """SELECT user_id, product_id FROM raw_rows
WHERE product_id IS NULL OR product_id IN (SELECT product_id FROM dim_products)""",
    ),
)


def _kept(df):
    return df.filter(rules.good(df)).drop(rules.REJECT)


_LINE_IDS = """SELECT concat(l_orderkey, '-', l_linenumber) AS line_id, CAST(l_partkey AS STRING) AS part,
 CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) AS price FROM {lineitem}"""
_LINE_DIGEST = "md5(concat_ws(chr(1), line_id, part, price))"
register(
    "repair_duplicate_keys",
    lambda t: repair_duplicates(t.sql(_LINE_IDS), "line_id", row_digest(["line_id", "part", "price"])),
    with_views(
        ("source", f"SELECT *, {_LINE_DIGEST} AS _digest FROM ({named(_LINE_IDS)})"),
        *duplicate_ctes("source", "line_id", ["line_id", "part", "price"]),
        final="SELECT * FROM deduped",
    ),
)
register(
    "repair_stored_keys",
    lambda t: resolve_conflicts(t["users"].select("user_id", "user_name"), "user_id", t.sql(STORED["users"])),
    with_views(
        ("deduped", "SELECT user_id, user_name FROM users"),
        *conflict_ctes("users", "user_id", ["user_id", "user_name"]),
        final="SELECT * FROM resolved",
    ),
)


def _resolved_by_index(t):
    """The stored ids come in two loads, the second one twice."""
    users, old = t["users"].select("user_id", "user_name"), t.sql(STORED["users"])
    index = KeyIndex(t.spark, scratch_path(t.spark, "key-index"))
    half = F.coalesce(F.crc32(F.col("user_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    index.add(old.filter(half), "user_id", date(2024, 1, 1))
    index.add(old, "user_id", date(2024, 1, 2))
    index.add(old.filter(~half), "user_id", date(2024, 1, 2))
    return index.resolve(users, "user_id", but=date(2024, 1, 3))


register(
    "repair_keys_by_index",
    _resolved_by_index,
    with_views(
        ("deduped", "SELECT user_id, user_name FROM users"),
        *conflict_ctes("users", "user_id", ["user_id", "user_name"]),
        final="SELECT * FROM resolved",
    ),
)
register(
    "rule_boolean",
    lambda t: extract(t, "user_actions").select(
        "action_id", parse_boolean(F.col("is_abnormal")).cast("bigint").alias("is_abnormal")
    ),
    over_extract("user_actions", f"SELECT action_id, CAST({boolean_sql('is_abnormal')} AS BIGINT) AS is_abnormal FROM raw_rows"),
)
register(
    "rule_date",
    lambda t: _kept(
        rules.normalize_dates(rules.project(extract(t, "data_quality_alerts"), ["check_type", "data_date"], []), ["data_date"])
    ),
    over_extract(
        "data_quality_alerts",
        f"""SELECT * FROM (SELECT check_type, CAST({parse_sql("data_date")} AS DATE) AS data_date FROM raw_rows)
WHERE data_date IS NOT NULL""",
    ),
)
_NESTED = "SELECT event_id, concat('{{\"k\":1,\"in\":[{{\"k\":\"k\"}},', props, ']}}') AS props FROM {events}"
register(
    "rename_nested_key",
    lambda t: rules.rename_column(t.sql(_NESTED).withColumnRenamed("event_id", "k"), "k", "score", ["props"]),
    "SELECT event_id AS score, concat('{\"score\":1,\"in\":[{\"score\":\"k\"},', replace(props, '\"k\":', '\"score\":'), ']}') AS props FROM events",
)
register(
    "rule_cast",
    lambda t: rules.cast_types(
        rules.project(extract(t, "dim_products"), ["product_id", "current_stock", "price"], []),
        {"product_id": "string", "current_stock": "bigint", "price": "decimal(10,2)"},
        ["price"],
    ).select("product_id", "current_stock", "price", F.col("_reject.value").alias("refused")),
    over_extract(
        "dim_products",
        """SELECT product_id, TRY_CAST(current_stock AS DOUBLE)::BIGINT AS current_stock, TRY_CAST(price AS DECIMAL(10,2))::DOUBLE AS price,
 CASE WHEN TRY_CAST(price AS DECIMAL(10,2)) IS NULL THEN price END AS refused FROM raw_rows""",
    ),
)
register(
    "rejected_by_rule",
    lambda t: cleaned(t, "orders").rejected.groupBy("table_name", "rule", "column_name").agg(F.count("*").alias("n")),
    f"SELECT table_name, rule, column_name, count(*) AS n FROM ({rejected_sql('orders')}) GROUP BY 1, 2, 3",
)
assert len(TIME_FORMATS) == STRPTIME.count("%Y")
