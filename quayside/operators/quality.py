"""Declarative data tests. Each operator returns the rows that break the rule."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.config import ACCEPTED_VALUES


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number; NULLs are not compared."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
    )


def missing_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def missing_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs of many columns from one scan: one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "missing")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent and the number of rows that carry them; NULL keys pass.

    Child keys are folded before the join, so a key that many rows carry travels once.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return keys.join(parents, F.col(column) == F.col("_parent"), "left_anti")


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the list and the number of rows that carry them; NULL passes."""
    return df.filter(~_accepted(df, column, accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def _accepted(df: DataFrame, column: str, accepted: Sequence):
    c = F.col(column)
    return (c.cast("int") if df.schema[column].dataType.typeName() == "boolean" else c).isin(list(accepted))


@dataclass(frozen=True)
class Rule:
    table: str
    kind: str  # unique | not_null | relationships | accepted_values
    column: str
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


def _rules(
    table: str,
    unique: Sequence[str] = (),
    not_null: Sequence[str] = (),
    accepted: Sequence[str] = (),
    parents: Mapping[str, tuple[str, str]] = {},
) -> list[Rule]:
    return [
        *[Rule(table, "unique", c) for c in unique],
        *[Rule(table, "not_null", c) for c in not_null],
        *[Rule(table, "accepted_values", c) for c in accepted],
        *[Rule(table, "relationships", c, p, k) for c, (p, k) in parents.items()],
    ]


# The declared tests of the silver tables.
SILVER_RULES = [
    *_rules(
        "stg_order_items",
        unique=("order_item_id",),
        not_null=(
            "order_item_id",
            "order_id",
            "product_card_id",
            "department_id",
            "order_item_quantity",
            "sales",
            "order_profit",
        ),
        parents={
            "order_id": ("stg_order", "order_id"),
            "product_card_id": ("stg_product", "product_card_id"),
            "department_id": ("stg_department", "department_id"),
        },
    ),
    *_rules(
        "stg_order",
        unique=("order_id",),
        not_null=(
            "order_id",
            "customer_id",
            "payment_type",
            "order_date",
            "shipping_date",
            "order_status",
            "late_delivery_risk",
            "is_actual_late",
            "is_label_violation",
        ),
        parents={"customer_id": ("stg_customer", "customer_id")},
    ),
    *_rules(
        "stg_customer",
        unique=("customer_id",),
        not_null=("customer_id", "customer_full_name", "customer_segment", "customer_city", "customer_country"),
    ),
    *_rules(
        "stg_product",
        unique=("product_card_id",),
        not_null=(
            "product_card_id",
            "product_name",
            "product_price",
            "product_status",
            "category_id",
            "category_name",
            "department_id",
        ),
        parents={"department_id": ("stg_department", "department_id")},
    ),
    *_rules("stg_department", unique=("department_id",), not_null=("department_id", "department_name")),
]

# The declared tests of the gold tables.
GOLD_RULES = [
    *_rules("dim_customer", unique=("customer_id",), not_null=("customer_id", "customer_full_name")),
    *_rules(
        "dim_product",
        unique=("product_card_id",),
        not_null=("product_card_id", "product_name"),
        accepted=("product_status_label",),
    ),
    *_rules("dim_order", unique=("order_id",), not_null=("order_id", "order_date")),
    *_rules("dim_date", unique=("date_key", "date_day"), not_null=("date_key", "date_day")),
    *_rules(
        "fact_order_items",
        unique=("order_item_id",),
        not_null=("order_item_id", "order_id", "product_card_id", "customer_id"),
        parents={
            "order_id": ("dim_order", "order_id"),
            "product_card_id": ("dim_product", "product_card_id"),
            "customer_id": ("dim_customer", "customer_id"),
            "order_date_key": ("dim_date", "date_key"),
            "shipping_date_key": ("dim_date", "date_key"),
        },
    ),
    *_rules("mart_product_category_sales", unique=("category_name",)),
    *_rules("mart_product_discount_impact", unique=("order_item_discount_rate",)),
    *_rules("mart_supply_chain_shipping_mode", unique=("shipping_mode",)),
    *_rules("mart_supply_chain_region_delay", unique=("order_region",)),
    *_rules("mart_ai_monitoring_risk_by_region", unique=("order_region",)),
    *_rules(
        "feat_delivery_risk",
        not_null=(
            "order_item_quantity",
            "order_item_product_price",
            "sales",
            "payment_type",
            "market",
            "order_region",
            "order_country",
            "shipping_mode",
            "days_scheduled",
            "is_weekend",
            "order_month",
            "order_quarter",
            "ship_day_of_week",
            "is_urgent_shipping",
            "late_delivery_risk",
        ),
        accepted=(
            "payment_type",
            "shipping_mode",
            "customer_segment",
            "is_weekend",
            "order_quarter",
            "is_urgent_shipping",
            "late_delivery_risk",
        ),
    ),
    *_rules(
        "feat_customer",
        unique=("customer_id",),
        not_null=("customer_id", "customer_segment", "customer_country", "total_orders", "is_cross_border"),
        accepted=("customer_segment", "is_cross_border"),
    ),
]

Lookup = Callable[[str], DataFrame]


def _scan_rules(df: DataFrame, rules: Sequence[Rule], accepted: Mapping) -> DataFrame:
    """All NULL and accepted-value rules of a table from one scan."""

    def failing(rule: Rule):
        if rule.kind == "not_null":
            return F.col(rule.column).isNull()
        return ~_accepted(df, rule.column, accepted[rule.column])

    counts = df.agg(*[F.count_if(failing(r)).alias(r.name) for r in rules])
    return counts.unpivot([], [r.name for r in rules], "test_name", "failures")


def _keys_of(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """test_name, key: the given column of each test, from one scan; NULL keys drop out."""
    return (
        df.select(*[F.col(c).cast("string").alias(name) for name, c in columns.items()])
        .unpivot([], list(columns), "test_name", "key")
        .filter(F.col("key").isNotNull())
    )


def _key_rules(tables: Lookup, rules: Sequence[Rule]) -> DataFrame:
    """All uniqueness and relationship rules, of all tables, through one shuffle of their keys.

    Keys fold to one row per test and key below the shuffle, so a key that many rows carry travels once per task.
    Every child is scanned once, and every parent once.
    """
    children = [
        _keys_of(tables(table), {r.name: r.column for r in rules if r.table == table})
        for table in dict.fromkeys(r.table for r in rules)
    ]
    counted = reduce(DataFrame.unionByName, children).groupBy("test_name", "key").agg(F.count(F.lit(1)).alias("row_count"))
    related = [r for r in rules if r.kind == "relationships"]
    found = F.lit(False)
    if related:
        parents = [
            _keys_of(tables(parent), {r.name: r.parent_column for r in related if r.parent == parent})
            for parent in dict.fromkeys(r.parent for r in related)
        ]
        known = reduce(DataFrame.unionByName, parents).distinct().withColumn("_known", F.lit(True))
        counted = counted.join(known, ["test_name", "key"], "left")
        found = F.coalesce("_known", F.lit(False))
    unique = F.col("test_name").isin([r.name for r in rules if r.kind == "unique"])
    failing = F.when(unique, (F.col("row_count") > 1).cast("bigint")).otherwise(F.when(found, 0).otherwise(F.col("row_count")))
    return counted.groupBy("test_name").agg(F.sum(failing).alias("failures"))


def run_suite(tables: Lookup, rules: Sequence[Rule], accepted: Mapping | None = None) -> DataFrame:
    """One row per rule: test_name, table_name, test_kind, column_name, failures, passed."""
    if not rules:
        raise ValueError("no rules to run: none of their tables is there")
    accepted = {**ACCEPTED_VALUES, **(accepted or {})}
    scanned = [r for r in rules if r.kind in ("not_null", "accepted_values")]
    keyed = [r for r in rules if r.kind in ("unique", "relationships")]
    parts = [
        _scan_rules(tables(table), [r for r in scanned if r.table == table], accepted)
        for table in dict.fromkeys(r.table for r in scanned)
    ]
    if keyed:
        # A table without keys has no row here, so each rule begins with none.
        none = tables(keyed[0].table).sparkSession.createDataFrame([(r.name, 0) for r in keyed], "test_name string, failures bigint")
        both = none.unionByName(_key_rules(tables, keyed))
        parts.append(both.groupBy("test_name").agg(F.sum("failures").alias("failures")))
    results = reduce(DataFrame.unionByName, parts)
    meta = {r.name: r for r in rules}

    def label(attribute: str):
        pairs = [x for n, r in meta.items() for x in (F.lit(n), F.lit(getattr(r, attribute)))]
        return F.create_map(*pairs)[F.col("test_name")]

    return results.select(
        "test_name",
        label("table").alias("table_name"),
        label("kind").alias("test_kind"),
        label("column").alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


class QualityError(RuntimeError):
    pass


def require_passed(results: DataFrame) -> None:
    """Raise when any rule failed; the result has one row per declared rule, so it is small."""
    failed = [f"{r['test_name']} ({r['failures']})" for r in results.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityError(f"{len(failed)} data tests failed: " + ", ".join(sorted(failed)))
