"""Dimensions and wide facts. All joins are left joins: missing partners are normal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.joins import HotKeys, left_join


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_name", "email")


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "price", "category_id")


def dim_categories(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", "category_name")


def revenue():
    """int x decimal(10,2), exact."""
    return F.col("quantity") * F.col("unit_price")


def product_catalog(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their category name, which is NULL for an unknown category."""
    names = categories.select("category_id", "category_name")
    return products.join(names, "category_id", "left").select(
        "product_id", "product_name", "category_id", "category_name"
    )


def fct_orders(
    orders: DataFrame, customers: DataFrame, products: DataFrame, categories: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Orders with customer, product and category names; ``keep`` are further columns of the orders.

    The category hangs off the product, so the two small tables are joined
    first and the orders are joined twice, not three times. Spark broadcasts a
    dimension by its measured size and shuffles it when it outgrows the limit.
    """
    catalog = product_catalog(products, categories)
    names = customers.select("customer_id", "customer_name")
    return (
        orders.join(names, "customer_id", "left")
        .join(catalog, "product_id", "left")
        .select(
            "order_id",
            "order_ts",
            "currency",
            "customer_id",
            "customer_name",
            "product_id",
            "product_name",
            "category_id",
            "category_name",
            "quantity",
            "unit_price",
            revenue().alias("revenue"),
            "kafka_topic",
            "kafka_partition",
            "kafka_offset",
            "ingested_at",
            *keep,
        )
    )


# Columns both downstream facts take over from the order.
_FROM_ORDER = [
    "product_id",
    "product_name",
    "category_id",
    "category_name",
    "quantity",
    "unit_price",
    "revenue",
]


def _order_context(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "order_ts",
        *_FROM_ORDER,
        F.col("currency").alias("order_currency"),
        F.struct("kafka_partition", "kafka_offset").alias("_order_event"),
    )


def fct_payments(
    payments: DataFrame, orders: DataFrame, hot_orders: HotKeys = (), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Payments with their order. An order id that occurs twice yields two rows; ``keep`` are further columns of the payments.

    ``hot_orders`` are the order ids to split, see :func:`~parcelflow.operators.joins.hot_keys`.
    """
    paid = payments.select(
        "payment_id",
        "order_id",
        "customer_id",
        F.col("amount").alias("payment_amount"),
        F.col("currency").alias("payment_currency"),
        "payment_date",
        "ingested_at",
        *keep,
    )
    joined = left_join(paid, _order_context(orders), "order_id", "_order_event", hot_orders)
    return joined.select(
        "payment_id",
        "order_id",
        "customer_id",
        *_FROM_ORDER,
        "payment_amount",
        "payment_currency",
        "order_currency",
        "payment_date",
        "order_ts",
        "ingested_at",
        *keep,
    )


def shipment_payments(
    shipments: DataFrame, payments: DataFrame, hot_payments: HotKeys = (), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Shipments with the payment they name."""
    shipped = shipments.select(
        "shipment_id", "payment_id", "order_id", "customer_id", "ship_date", "ingested_at", *keep
    )
    paid = payments.select(
        "payment_id",
        "payment_date",
        F.col("amount").alias("payment_amount"),
        F.col("currency").alias("payment_currency"),
        F.struct("kafka_partition", "kafka_offset").alias("_payment_event"),
    )
    return left_join(shipped, paid, "payment_id", "_payment_event", hot_payments).drop("_payment_event")


def shipment_orders(shipments: DataFrame, orders: DataFrame, hot_orders: HotKeys = ()) -> DataFrame:
    """Shipments with the order they name."""
    return left_join(shipments, _order_context(orders), "order_id", "_order_event", hot_orders)


def fct_shipments(
    shipments: DataFrame,
    payments: DataFrame,
    orders: DataFrame,
    hot_payments: HotKeys = (),
    hot_orders: HotKeys = (),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Shipments with their payment and, independently of it, their order; ``keep`` are further columns of the shipments."""
    paid = shipment_payments(shipments, payments, hot_payments, keep)
    return shipment_orders(paid, orders, hot_orders).select(
        "shipment_id",
        "payment_id",
        "order_id",
        "customer_id",
        *_FROM_ORDER,
        "payment_amount",
        "payment_currency",
        "order_currency",
        "payment_date",
        "ship_date",
        "order_ts",
        "ingested_at",
        *keep,
    )


@dataclass(frozen=True)
class Follows:
    """What a fact's rows come from, for refreshing it from changes.

    ``left`` is the staged table, ``columns`` its columns by the fact's columns that hold them, ``joined`` the other tables
    by the fact's column they are joined on.
    """

    left: str
    columns: dict[str, str]
    joined: dict[str, str]


def _as_they_are(*names: str) -> dict[str, str]:
    return {name: name for name in ("event_id", *names, "ingested_at")}


FOLLOWS = {
    "fct_orders": Follows(
        "stg_orders",
        _as_they_are(
            "order_id", "customer_id", "product_id", "quantity", "unit_price", "currency", "order_ts",
            "kafka_topic", "kafka_partition", "kafka_offset",
        ),
        {"dim_customers": "customer_id", "dim_products": "product_id", "dim_categories": "category_id"},
    ),
    "fct_payments": Follows(
        "stg_payments",
        _as_they_are("payment_id", "order_id", "customer_id", "payment_date")
        | {"amount": "payment_amount", "currency": "payment_currency"},
        {"fct_orders": "order_id"},
    ),
    "fct_shipments": Follows(
        "stg_shipments",
        _as_they_are("shipment_id", "payment_id", "order_id", "customer_id", "ship_date"),
        {"stg_payments": "payment_id", "fct_orders": "order_id"},
    ),
}
