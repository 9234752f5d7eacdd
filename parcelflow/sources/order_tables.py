"""Commerce events derived from order, customer and part tables.

Each order row becomes one order message and, by its status, a payment and a
shipment message; a few messages are repeated or damaged so that every ingest
outcome occurs. One scan of the table yields all messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import iso_text
from parcelflow.operators.conflicts import insert_ignore

DIMENSION_TIME = "2024-01-01 00:00:00"

# Runs unchanged on Spark and on other SQL engines, so a check can start from it.
BASE_EVENTS = """
SELECT o_orderkey AS k,
       o_orderkey - (CASE WHEN o_orderkey % 50 = 49 THEN 1 ELSE 0 END) AS order_id,
       o_custkey + (CASE WHEN o_orderkey % 11 = 10 THEN 1000000000 ELSE 0 END) AS customer_id,
       o_orderkey % 100 + 1 AS product_id,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 5 + 1 AS INT) END AS quantity_raw,
       CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE CAST(o_orderkey % 5 + 1 AS INT) END AS quantity,
       CAST(o_totalprice AS DECIMAL(10,2)) AS unit_price,
       CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'JPY' END AS currency,
       o_orderkey + 1000000 AS payment_id,
       o_orderkey + 2000000 AS shipment_id,
       CAST(o_orderkey % 3 AS INT) AS kafka_partition,
       CAST(floor(o_orderkey / 3) AS BIGINT) AS kafka_offset,
       o_orderdate AS order_ts,
       o_orderdate + CASE o_orderkey % 3 WHEN 0 THEN INTERVAL '0' DAY WHEN 1 THEN INTERVAL '1' DAY
                                         ELSE INTERVAL '2' DAY END AS payment_date,
       o_orderdate + INTERVAL '5' DAY AS ship_date,
       o_orderstatus <> 'O' AS has_payment,
       o_orderstatus = 'F' AS has_shipment
FROM orders
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table of fewer files than cores; else leave it alone.

    A broker source does the same with its ``minPartitions`` option.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed row per order: the truth behind all its messages."""
    orders = spread(table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS))
    rows = spark.sql(BASE_EVENTS.replace("FROM orders", "FROM {orders}"), orders=orders)
    stamps = {c: F.col(c).cast("timestamp") for c in ("order_ts", "payment_date", "ship_date")}
    return rows.withColumns(stamps)


def kafka_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages of the order table in the Kafka shape.

    * a tenth of the events is delivered twice
    * some extra order messages have an unreadable value (offset 10000000 + k)
    * some have an undecodable key (offset 20000000 + k)
    """
    k = F.col("k")

    def message(topic: str, value, at: str, key=None, offset=None):
        return F.struct(
            (F.encode(F.col("order_id").cast("string"), "UTF-8") if key is None else key).alias("key"),
            value.alias("value"),
            F.lit(topic).alias("topic"),
            F.col("kafka_partition").alias("partition"),
            (F.col("kafka_offset") if offset is None else offset).alias("offset"),
            F.col(at).alias("timestamp"),
        )

    def body(*fields):
        # NULL fields are left out: an absent quantity is a missing JSON key
        return F.encode(F.to_json(F.struct(*fields)), "UTF-8")

    order = body(
        "order_id", "customer_id", "product_id",
        F.col("quantity_raw").alias("quantity"), "unit_price", "currency",
        iso_text(F.col("order_ts")).alias("timestamp"),
    )
    amount = (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)")
    payment = body(
        "payment_id", "order_id", "customer_id", amount.alias("amount"), "currency",
        iso_text(F.col("payment_date")).alias("payment_date"),
    )
    shipment = body(
        "shipment_id", "payment_id", "order_id", "customer_id",
        iso_text(F.col("ship_date")).alias("ship_date"),
    )
    events = F.array(
        message("orders", order, "order_ts"),
        F.when(F.col("has_payment"), message("payments", payment, "payment_date")),
        F.when(F.col("has_shipment"), message("shipments", shipment, "ship_date")),
    )
    damaged_value = (
        F.when(k % 4 == 0, F.encode(F.lit('{"order_id": '), "UTF-8"))
        .when(k % 4 == 1, F.encode(F.lit("null"), "UTF-8"))
        .when(k % 4 == 2, F.encode(F.lit('{"a":1} x'), "UTF-8"))
        .otherwise(F.unhex(F.lit("ff")))
    )
    damaged = F.array(
        F.when(k % 97 == 96, message("orders", damaged_value, "order_ts", offset=k + 10000000)),
        F.when(
            k % 193 == 192,
            message("orders", order, "order_ts", key=F.unhex(F.lit("ff")), offset=k + 20000000),
        ),
    )
    repeats = F.when(k % 10 == 0, events).otherwise(F.array().cast(f"array<{_MESSAGE}>"))
    every = F.array_compact(F.concat(events, repeats, damaged))
    return base_events(spark, sf_dir).select(F.inline(every))


_MESSAGE = "struct<key:binary,value:binary,topic:string,partition:int,offset:bigint,timestamp:timestamp>"


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types, numbered by their first part."""
    types = table(spark, sf_dir, "part").groupBy("p_type").agg(F.min("p_partkey").alias("category_id"))
    return types.select(
        F.col("category_id").cast("bigint").alias("category_id"),
        F.col("p_type").alias("name"),
        F.lit(DIMENSION_TIME).cast("timestamp").alias("ingested_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts inserted in key order; a name that is taken is ignored. Some name a category that does not exist."""
    parts = table(spark, sf_dir, "part")
    kept = insert_ignore(parts.select("p_partkey", "p_name", "p_type", "p_retailprice"), "p_name", "p_partkey")
    categories = raw_categories(spark, sf_dir).select("category_id", F.col("name").alias("type"))
    unknown = F.when(F.col("p_partkey") % 9 == 8, F.lit(1_000_000_000)).otherwise(F.lit(0))
    joined = kept.join(categories, F.col("type") == F.col("p_type"))
    return joined.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.lit(DIMENSION_TIME).cast("timestamp").alias("ingested_at"),
        (F.col("category_id") + unknown).cast("int").alias("category_id"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; the orders that find none name ids that do not exist."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.lit(DIMENSION_TIME).cast("timestamp").alias("ingested_at"),
    )
