"""Every operator as a query over the given tables.

Each function takes a session and a folder of tables and returns a DataFrame.
Amounts come out as doubles and times without zone, so that results compare
equal with other engines.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.functions import event_id, field, typed_field, with_row_id, with_strict_json
from parcelflow.operators import chain, quality
from parcelflow.operators.conflicts import insert_ignore
from parcelflow.operators.event_log import EventLog, quarantine_as_messages
from parcelflow.operators.incremental import IncrementalTable
from parcelflow.operators.ingest import bad_messages as find_bad_messages
from parcelflow.operators.joins import hot_keys, left_join
from parcelflow.plans import marts, staging
from parcelflow.plans.build import Warehouse, materialize_table as rebuild_table
from parcelflow.schemas import KAFKA_SCHEMA, MESSAGE_KEY, RAW_CUSTOMERS, TOPICS, Field
from parcelflow.session import configure, scratch_dir
from parcelflow.sources import order_tables as source
from parcelflow.sources import seeds
from parcelflow.sources.events import emit_counts as count_emitted
from parcelflow.sources.events import event_source, write_events
from parcelflow.sources.logs import log_scan as scan_logs
from parcelflow.sources.logs import render_line
from parcelflow.sources.tables import declare_table
from parcelflow.streaming.chain import as_raw_events, start_payments, start_shipments
from parcelflow.streaming.enrich import LateEvents, enrich_payments
from parcelflow.streaming.ingest import batch_counts
from parcelflow.streaming.ingest import stream_ingest as start_ingest


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, timestamps without zone."""

    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# --- stored input -----------------------------------------------------------

_files: dict[tuple[str, str], str] = {}
_landed: dict[tuple[str, str], EventLog] = {}
_history: dict[tuple[str, str], EventLog] = {}
_built: dict[tuple[str, str], Warehouse] = {}
_changed: dict[tuple[str, str], Warehouse] = {}


def _stored(spark: SparkSession, path: str) -> bool:
    """False once a scratch folder has been cleared away."""
    try:
        spark.read.schema("value string").parquet(path)
    except AnalysisException:
        return False
    return True


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """All messages of the tables as files in the Kafka shape, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _files or not _stored(spark, _files[key]):
        path = scratch_dir(spark, "messages")
        write_events(source.kafka_frame(spark, sf_dir), path=path)
        _files[key] = path
    return _files[key]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_source(spark, path=message_files(spark, sf_dir), streaming=False)


def new_log(spark: SparkSession, sf_dir: str, purpose: str) -> EventLog:
    """A fresh log that has ingested all messages, stamped with message time."""
    log = EventLog(spark, scratch_dir(spark, purpose))
    log.append(messages(spark, sf_dir), F.col("message_ts"))
    return log


def landed(spark: SparkSession, sf_dir: str) -> EventLog:
    """The log all read-only queries share: events are stored once, then read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed or not _stored(spark, _landed[key].path):
        _landed[key] = new_log(spark, sf_dir, "landed")
    return _landed[key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir).raw_events()


def _orders(spark, sf_dir):
    return staging.stg_orders(raw(spark, sf_dir))


def _payments(spark, sf_dir):
    return staging.stg_payments(raw(spark, sf_dir))


def _shipments(spark, sf_dir):
    return staging.stg_shipments(raw(spark, sf_dir))


def _customers(spark, sf_dir):
    return staging.stg_customers(source.raw_customers(spark, sf_dir))


def _products(spark, sf_dir):
    return staging.stg_products(source.raw_products(spark, sf_dir))


def _categories(spark, sf_dir):
    return staging.stg_categories(source.raw_categories(spark, sf_dir))


def _fct_orders(spark, sf_dir):
    return marts.fct_orders(
        _orders(spark, sf_dir), _customers(spark, sf_dir), _products(spark, sf_dir), _categories(spark, sf_dir)
    )


def _hot_orders(spark, sf_dir):
    # fct_orders keeps every staged order, so its keys can be measured on the narrow table
    return hot_keys(_orders(spark, sf_dir), "order_id")


def _hot_payments(spark, sf_dir):
    return hot_keys(_payments(spark, sf_dir), "payment_id")


def _envelope(raw_events: DataFrame) -> DataFrame:
    order_id = field(F.col("payload"), "order_id").cast("bigint").alias("order_id")
    return portable(raw_events.select(*MESSAGE_KEY, "kafka_key", order_id, "event_ts", "ingested_at"))


# --- ingest -----------------------------------------------------------------


def ingest_raw_events(spark, sf_dir):
    return _envelope(new_log(spark, sf_dir, "ingest").raw_events())


def ingest_dedup(spark, sf_dir):
    """All messages delivered again in a second batch; each is stored once."""
    log = new_log(spark, sf_dir, "dedup")
    log.append(messages(spark, sf_dir), F.col("message_ts"))
    received = log.read().filter(F.col("outcome").isin("written", "duplicate"))
    return received.groupBy(*MESSAGE_KEY).agg(
        F.count(F.when(F.col("outcome") == "written", 1)).alias("stored"),
        F.sum("copies").cast("bigint").alias("deliveries"),
    )


def ingest_onto_history(spark, sf_dir):
    """One message in a hundred delivered again onto a stored log: the log's counts of that append."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _history or not _stored(spark, _history[key].path):
        _history[key] = new_log(spark, sf_dir, "history")
    again = messages(spark, sf_dir).filter(F.col("offset") % 100 == 7)  # damaged ones among them
    counts = _history[key].append(again, F.col("message_ts"))
    rows = [(topic, outcome, n) for (topic, outcome), n in sorted(counts.items())]
    return spark.createDataFrame(rows, "topic string, outcome string, messages bigint")


def ingest_outcomes(spark, sf_dir):
    return landed(spark, sf_dir).outcomes()


def bad_messages(spark, sf_dir):
    return find_bad_messages(messages(spark, sf_dir)).select(*MESSAGE_KEY, "reason")


def dead_letter_redrive(spark, sf_dir):
    """Rejected for their key, repaired from the payload, and offered again."""
    log = new_log(spark, sf_dir, "redrive")
    rejected = log.quarantine().filter(F.col("reason") == "key is not utf-8")
    offered = quarantine_as_messages(rejected)
    parsed = with_strict_json(offered.withColumn("_text", F.col("value").cast("string")), "_text", "_json")
    repaired = parsed.withColumn("key", F.encode(field(F.col("_json"), "order_id"), "UTF-8"))
    log.redrive(repaired.select(KAFKA_SCHEMA.fieldNames()), F.col("message_ts"))
    return _envelope(log.raw_events())


def dead_letter_ledger(spark, sf_dir):
    """Three rounds of repairs for messages with an unreadable key: a fourth of them is repaired wrongly in the first two."""
    log = new_log(spark, sf_dir, "ledger")
    for round_ in range(3):
        rejected = log.quarantine().filter(F.col("reason") == "key is not utf-8")
        offered = quarantine_as_messages(rejected)
        parsed = with_strict_json(offered.withColumn("_text", F.col("value").cast("string")), "_text", "_json")
        order_id = field(F.col("_json"), "order_id")
        wrong = F.lit(round_ < 2) & (F.col("offset") % 4 == 0)
        repaired = parsed.withColumns(
            {
                "key": F.encode(order_id, "UTF-8"),
                "value": F.when(wrong, F.encode(F.lit(f"still wrong {round_}"), "UTF-8")).otherwise(F.col("value")),
            }
        )
        for _ in range(2):  # offering the same repairs again changes nothing
            log.redrive(repaired.select(*KAFKA_SCHEMA.fieldNames(), "reject_id"), F.col("message_ts"))
    return log.dead_letters().select(*MESSAGE_KEY, "reason", "attempts", "settled")


# --- projections ------------------------------------------------------------


def topic_filter(spark, sf_dir):
    return staging.topic_filter(raw(spark, sf_dir), "payments").select(*MESSAGE_KEY, "kafka_key")


def event_ids(spark, sf_dir):
    return raw(spark, sf_dir).select(event_id().alias("event_id"), *MESSAGE_KEY)


def row_id(spark, sf_dir):
    """Every stored event gets an id of its own: as many ids as rows, per topic."""
    rows = with_row_id(raw(spark, sf_dir).select("kafka_topic"))
    return rows.groupBy("kafka_topic").agg(F.count("id").alias("row_count"), F.countDistinct("id").alias("ids"))


def write_by_key(spark, sf_dir):
    """Messages written with the messages of each key in one file, as a broker puts them into one partition."""
    path = scratch_dir(spark, "by-key")
    write_events(messages(spark, sf_dir), path=path, by_key=True)
    stored = spark.read.schema(KAFKA_SCHEMA).parquet(path)
    stored = stored.select("key", F.input_file_name().alias("file"))
    by_key = stored.groupBy("key").agg(F.countDistinct("file").alias("files"), F.count("*").alias("n"))
    return by_key.groupBy(F.col("n").alias("messages"), "files").agg(F.count("*").alias("keys"))


def partition_of_key(spark, sf_dir):
    """Messages written by the partition that a broker of twelve would put their key into: keys, partitions and messages."""
    path = scratch_dir(spark, "by-partition")
    write_events(messages(spark, sf_dir), path=path, partitions=12)
    stored = spark.read.schema(T.StructType([*KAFKA_SCHEMA.fields, T.StructField("broker_partition", T.IntegerType())])).parquet(path)
    return stored.groupBy(F.hex("key").alias("key"), "broker_partition").agg(F.count("*").alias("messages"))


def _event_props(spark, sf_dir) -> DataFrame:
    events = source.table(spark, sf_dir, "events")
    return with_strict_json(events.select("event_id", "props"), "props", "payload")


def _event_values(spark, sf_dir) -> DataFrame:
    events = source.table(spark, sf_dir, "events")
    text = F.to_json(F.struct("value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts")))
    return with_strict_json(events.select("event_id", text.alias("text")), "text", "payload")


def json_field(spark, sf_dir):
    payload = F.col("payload")
    return _event_props(spark, sf_dir).select(
        "event_id", field(payload, "k").alias("k"), field(payload, "absent").alias("absent")
    )


def cast_bigint(spark, sf_dir):
    return _event_props(spark, sf_dir).select("event_id", typed_field(F.col("payload"), Field("k", "k", "bigint")))


def cast_bigint_forms(spark, sf_dir):
    """The same number in eight spellings, stored and read back: a decimal point is refused, an exponent is not."""
    events = source.table(spark, sf_dir, "events")
    n, form = F.get_json_object("props", "$.k"), F.col("event_id") % 8
    spellings = ["{}", '"{}"', "{}.0", "{}e3", "{}.5", '"{}.0"', '" {} "', "{}.0E1"]
    text = F.element_at(F.array(*[F.format_string(s.replace("{}", "%s"), n) for s in spellings]), form.cast("int") + 1)
    sent = events.select(
        F.encode(F.lit("1"), "UTF-8").alias("key"),
        F.encode(F.concat(F.lit('{"order_id":'), text, F.lit("}")), "UTF-8").alias("value"),
        F.lit("orders").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    log = EventLog(spark, scratch_dir(spark, "spellings"))
    log.append(sent, F.col("message_ts"))
    staged = staging.stg_orders(log.raw_events(), on_error="quarantine")
    refused = F.array_contains("failed_fields", "order_id").alias("refused")
    return staged.select(F.col("kafka_offset").alias("event_id"), "order_id", refused)


def cast_decimal(spark, sf_dir):
    amount = typed_field(F.col("payload"), Field("value", "amount", "decimal(12,2)"))
    return portable(_event_values(spark, sf_dir).select("event_id", amount))


def cast_timestamp(spark, sf_dir):
    ts = typed_field(F.col("payload"), Field("ts", "ts", "timestamp"))
    return portable(_event_values(spark, sf_dir).select("event_id", ts))


def json_default(spark, sf_dir):
    return _orders(spark, sf_dir).select("event_id", "quantity")


def revenue(spark, sf_dir):
    return portable(_orders(spark, sf_dir).select("event_id", marts.revenue().alias("revenue")))


# --- encoding and derivation ------------------------------------------------


def encode_events(spark, sf_dir):
    """Orders encoded as messages and read back."""
    encoded = chain.order_messages(_orders(spark, sf_dir))
    columns = ["event_id", "kafka_key", "order_id", "quantity", "unit_price", "currency", "order_ts"]
    return portable(staging.stg_orders(as_raw_events(encoded)).select(columns))


def emit_counts(spark, sf_dir):
    encoded = (
        chain.order_messages(_orders(spark, sf_dir))
        .unionByName(chain.payment_messages(_payments(spark, sf_dir)))
        .unionByName(chain.shipment_messages(_shipments(spark, sf_dir)))
    )
    return count_emitted(encoded)


def derive_payments(spark, sf_dir):
    rows = chain.derive_payments(_orders(spark, sf_dir))
    return portable(rows.drop("kafka_partition", "kafka_offset"))


def derive_shipments(spark, sf_dir):
    rows = chain.derive_shipments(_payments(spark, sf_dir))
    return portable(rows.drop("kafka_partition", "kafka_offset"))


# --- raw tables, seeds, staging, dimensions -----------------------------------


def scan_raw_customers(spark, sf_dir):
    warehouse = Warehouse(spark, scratch_dir(spark, "raw"))
    path, database = f"{warehouse.root}/raw/raw_customers", f"raw_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        declare_table(spark, database, "raw_customers", path, RAW_CUSTOMERS)
    warehouse.insert("raw_customers", source.raw_customers(spark, sf_dir))
    spark.catalog.refreshTable(f"{database}.raw_customers")
    return portable(spark.table(f"{database}.raw_customers"))


def seed_values(spark, sf_dir):
    """All orders looked up in the seeded dimensions; most find no partner."""
    facts = marts.fct_orders(
        _orders(spark, sf_dir),
        staging.stg_customers(seeds.seed_customers(spark)),
        staging.stg_products(seeds.seed_products(spark)),
        staging.stg_categories(seeds.seed_categories(spark)),
    )
    key = event_id().alias("event_id")
    return facts.select(key, "customer_name", "product_name", "category_id", "category_name")


def seed_insert_ignore(spark, sf_dir):
    parts = source.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return insert_ignore(parts, "p_name", "p_partkey")


def stg_orders(spark, sf_dir):
    return portable(_orders(spark, sf_dir))


def stg_payments(spark, sf_dir):
    return portable(_payments(spark, sf_dir))


def stg_shipments(spark, sf_dir):
    return portable(_shipments(spark, sf_dir))


def stg_products(spark, sf_dir):
    return portable(_products(spark, sf_dir))


def stg_customers(spark, sf_dir):
    return portable(_customers(spark, sf_dir))


def stg_categories(spark, sf_dir):
    return portable(_categories(spark, sf_dir))


def dim_customers(spark, sf_dir):
    return marts.dim_customers(_customers(spark, sf_dir))


def dim_products(spark, sf_dir):
    return portable(marts.dim_products(_products(spark, sf_dir)))


def dim_categories(spark, sf_dir):
    return marts.dim_categories(_categories(spark, sf_dir))


# --- joins and facts ----------------------------------------------------------


def join_customers(spark, sf_dir):
    names = _customers(spark, sf_dir).select("customer_id", "customer_name")
    orders = _orders(spark, sf_dir).select("event_id", "customer_id")
    return orders.join(names, "customer_id", "left")


def join_products(spark, sf_dir):
    names = _products(spark, sf_dir).select("product_id", "product_name", "category_id")
    return _orders(spark, sf_dir).select("event_id", "product_id").join(names, "product_id", "left")


def join_categories(spark, sf_dir):
    catalog = marts.product_catalog(_products(spark, sf_dir), _categories(spark, sf_dir))
    orders = _orders(spark, sf_dir).select("event_id", "product_id")
    return orders.join(catalog, "product_id", "left").select("event_id", "category_id", "category_name")


def join_payments_orders(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    joined = marts.fct_payments(_payments(spark, sf_dir), _unnamed(orders), _hot_orders(spark, sf_dir))
    return portable(joined.select("payment_id", "order_id", "product_id", "quantity", "unit_price", "order_ts"))


def join_shipments_payments(spark, sf_dir):
    joined = marts.shipment_payments(
        _shipments(spark, sf_dir), _payments(spark, sf_dir), _hot_payments(spark, sf_dir)
    )
    return portable(joined)


def join_shipments_orders(spark, sf_dir):
    orders = _unnamed(_orders(spark, sf_dir))
    joined = marts.shipment_orders(_shipments(spark, sf_dir), orders, _hot_orders(spark, sf_dir))
    return portable(joined.select("shipment_id", "order_id", "product_id", "quantity", "unit_price", "order_ts"))


def join_hot_orders(spark, sf_dir):
    """A third of the right rows share order 1; keys the right side lacks are listed too."""
    orders = source.table(spark, sf_dir, "orders")
    key, total = F.col("o_orderkey"), F.col("o_totalprice").alias("total")
    placed = orders.select(F.when(key % 3 == 0, F.lit(1)).otherwise(key).alias("order_id"), key.alias("line"), total)
    paid = orders.select(key.alias("payment_id"), F.when(key % 1000 == 1, F.lit(1)).otherwise(key + 1).alias("order_id"))
    hot = hot_keys(placed, "order_id", rows_per_task=100)
    assert hot, "the fixture has a hot order"
    return left_join(paid, placed, "order_id", "line", [*hot, (-1, 3), (3, 4), (6, 2)])


def _unnamed(orders: DataFrame) -> DataFrame:
    """Staged orders in the shape of the fact, without looking up names."""
    none = F.lit(None)
    return orders.withColumns(
        {
            "product_name": none.cast("string"),
            "category_id": none.cast("int"),
            "category_name": none.cast("string"),
            "revenue": marts.revenue(),
        }
    )


def fct_orders(spark, sf_dir):
    return portable(_fct_orders(spark, sf_dir))


def fct_payments(spark, sf_dir):
    facts = marts.fct_payments(_payments(spark, sf_dir), _fct_orders(spark, sf_dir), _hot_orders(spark, sf_dir))
    return portable(facts)


def fct_shipments(spark, sf_dir):
    facts = marts.fct_shipments(
        _shipments(spark, sf_dir),
        _payments(spark, sf_dir),
        _fct_orders(spark, sf_dir),
        _hot_payments(spark, sf_dir),
        _hot_orders(spark, sf_dir),
    )
    return portable(facts)


# --- building, increments, status -----------------------------------------------


def materialize_table(spark, sf_dir):
    """Built, rebuilt with other rows, and rebuilt again while a reader holds the version before."""
    customers = marts.dim_customers(_customers(spark, sf_dir))
    path = scratch_dir(spark, "dim_customers")
    rebuild_table(customers.withColumn("email", F.upper("email")), path)
    reader = rebuild_table(customers, path).read()
    rebuild_table(customers.limit(0), path)
    return reader


def new_warehouse(spark, sf_dir) -> Warehouse:
    """A fresh warehouse whose raw layer holds all events and dimension rows."""
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse"))
    loads = [
        lambda: warehouse.log.append(messages(spark, sf_dir), F.col("message_ts")),
        lambda: warehouse.insert("raw_categories", source.raw_categories(spark, sf_dir)),
        lambda: warehouse.insert("raw_products", source.raw_products(spark, sf_dir)),
        lambda: warehouse.insert("raw_customers", source.raw_customers(spark, sf_dir)),
    ]
    with ThreadPoolExecutor(len(loads)) as pool:  # independent tables, as parallel jobs
        for load in [pool.submit(inheritable_thread_target(spark)(load)) for load in loads]:
            load.result()
    return warehouse


def build_all(spark, sf_dir):
    return new_warehouse(spark, sf_dir).build()


def high_water_mark(spark, sf_dir):
    marks = raw(spark, sf_dir).groupBy("kafka_topic").agg(F.max("ingested_at").alias("high_water_mark"))
    return portable(marks)


# The first load sees the orders up to this day, but for some that come late.
_CUT = "1998-06-30 00:00:00"


def _two_loads(spark, sf_dir, mode: str) -> DataFrame:
    orders = staging.stg_orders(landed(spark, sf_dir).raw_events(blocks=True))
    number = F.col("kafka_offset") * 3 + F.col("kafka_partition")
    first = orders.filter((number % 40 != 3) & (F.col("ingested_at") <= F.lit(_CUT).cast("timestamp")))
    table = IncrementalTable(spark, scratch_dir(spark, "stg_orders"), orders.drop("offset_block").schema)
    for visible in (first, orders):
        table.load_strict(visible) if mode == "strict" else table.load_keyed(visible)
    return portable(table.read().select("event_id", "order_id", "quantity", "ingested_at"))


def incremental_strict(spark, sf_dir):
    return _two_loads(spark, sf_dir, "strict")


def incremental_keyed(spark, sf_dir):
    return _two_loads(spark, sf_dir, "keyed")


def incremental_upsert(spark, sf_dir):
    """All orders loaded, then those in dollars corrected."""
    orders = staging.stg_orders(landed(spark, sf_dir).raw_events(blocks=True))
    table = IncrementalTable(spark, scratch_dir(spark, "stg_orders"), orders.drop("offset_block").schema)
    table.upsert(orders)
    corrected = orders.filter(F.col("currency") == "USD").withColumn("quantity", F.col("quantity") + 1)
    table.upsert(corrected)
    return table.read().select("event_id", "order_id", "quantity")


def incremental_keyed_changed(spark, sf_dir):
    """The first source holds the odd orders, the second as many even ones; the table ends with both."""
    orders = staging.stg_orders(landed(spark, sf_dir).raw_events(blocks=True))
    number = F.col("kafka_offset") * 3 + F.col("kafka_partition")
    table = IncrementalTable(spark, scratch_dir(spark, "stg_orders"), orders.drop("offset_block").schema)
    table.load_keyed(orders.filter(number % 2 == 1))
    table.load_keyed(orders.filter(number % 2 == 0))
    return portable(table.read().select("event_id", "order_id", "quantity", "ingested_at"))


def incremental_keyed_repeated(spark, sf_dir):
    """Keyed on an order id that every order repeats: each load brings the ids it lacks, with all their rows."""
    orders = staging.stg_orders(landed(spark, sf_dir).raw_events(blocks=True))
    twice = orders.unionAll(orders)
    table = IncrementalTable(
        spark, scratch_dir(spark, "orders-twice"), orders.drop("offset_block").schema, key="order_id", buckets=4
    )
    for digit in (0, 1):  # even ids, then odd ones: each load is about as large as what is there
        table.load_keyed(twice.filter(F.col("order_id") % 2 == digit))
    table.load_keyed(twice)
    return portable(table.read().select("event_id", "order_id", "quantity", "ingested_at"))


def incremental_upsert_by_order(spark, sf_dir):
    """One row per order id, keyed on it: later events of an order, from any block, replace the earlier."""
    orders = staging.stg_orders(landed(spark, sf_dir).raw_events(blocks=True))
    number = F.col("kafka_offset") * 3 + F.col("kafka_partition")
    table = IncrementalTable(
        spark, scratch_dir(spark, "orders-by-id"), orders.drop("offset_block").schema, key="order_id", buckets=8
    )
    table.upsert(orders.filter(number % 50 != 49))
    table.upsert(orders.filter(number % 50 == 49))  # these repeat the order id before theirs
    return table.read().select("event_id", "order_id", "quantity")


def pipeline_status(spark, sf_dir):
    """Row counts of the log and the facts of a built warehouse, from footers and manifests."""
    return built_twice(spark, sf_dir).status()


def built_twice(spark, sf_dir) -> Warehouse:
    """A warehouse built on the first half of the messages, and again after the rest; kept per table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built or not _stored(spark, f"{_built[key].root}/wh/fct_shipments/manifest"):
        warehouse = Warehouse(spark, scratch_dir(spark, "built-twice"))
        warehouse.insert("raw_categories", source.raw_categories(spark, sf_dir))
        warehouse.insert("raw_products", source.raw_products(spark, sf_dir))
        warehouse.insert("raw_customers", source.raw_customers(spark, sf_dir))
        every = messages(spark, sf_dir)
        half = F.col("offset") % 2 == 0
        for part in (every.filter(half), every):
            warehouse.log.append(part, F.col("message_ts"))
            warehouse.build()
        _built[key] = warehouse
    return _built[key]


def built_by_changes(spark, sf_dir) -> Warehouse:
    """A warehouse whose facts followed later arrivals instead of being rebuilt; kept per table folder.

    What comes second: customers and products that orders already name, orders that are already paid, payments that
    are already shipped, and new events of every kind.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _changed or not _stored(spark, f"{_changed[key].root}/wh/fct_shipments/manifest"):
        warehouse = Warehouse(spark, scratch_dir(spark, "by-changes"), fact_parts=8)
        customers, products = source.raw_customers(spark, sf_dir), source.raw_products(spark, sf_dir)
        early, topic = F.col("offset") % 100, F.col("topic")
        late = ((topic == "orders") & early.isin(7, 9)) | ((topic == "payments") & early.isin(8, 9)) | (early == 9)
        warehouse.insert("raw_categories", source.raw_categories(spark, sf_dir))
        warehouse.insert("raw_products", products.filter("product_id % 40 <> 3"))
        warehouse.insert("raw_customers", customers.filter("customer_id % 50 <> 3"))
        warehouse.log.append(messages(spark, sf_dir).filter(~late), F.col("message_ts"))
        warehouse.build()
        warehouse.insert("raw_products", products)
        warehouse.insert("raw_customers", customers)
        warehouse.log.append(messages(spark, sf_dir), F.col("message_ts"))
        warehouse.build()
        assert set(warehouse.refreshed.values()) == {"changes"}, warehouse.refreshed
        _changed[key] = warehouse
    return _changed[key]


def build_fct_orders_delta(spark, sf_dir):
    return portable(built_by_changes(spark, sf_dir).ref("fct_orders"))


def build_fct_payments_delta(spark, sf_dir):
    return portable(built_by_changes(spark, sf_dir).ref("fct_payments"))


def build_fct_shipments_delta(spark, sf_dir):
    return portable(built_by_changes(spark, sf_dir).ref("fct_shipments"))


def build_fct_orders(spark, sf_dir):
    return portable(built_twice(spark, sf_dir).ref("fct_orders"))


def build_fct_payments(spark, sf_dir):
    return portable(built_twice(spark, sf_dir).ref("fct_payments"))


def build_fct_shipments(spark, sf_dir):
    return portable(built_twice(spark, sf_dir).ref("fct_shipments"))


# --- constraints ------------------------------------------------------------------


def dq_not_null(spark, sf_dir):
    return quality.check_not_null(source.base_events(spark, sf_dir), ["quantity_raw"]).select("k", "order_id")


def dq_unique(spark, sf_dir):
    return quality.check_unique(source.table(spark, sf_dir, "part"), ["p_name"])


def dq_check(spark, sf_dir):
    customers = source.table(spark, sf_dir, "customer")
    return quality.check_rule(customers, "c_acctbal >= 0").select("c_custkey", "c_acctbal")


def dq_primary_key(spark, sf_dir):
    return quality.check_primary_key(_orders(spark, sf_dir), ["order_id"])


def dq_relationships(spark, sf_dir):
    customers = source.raw_customers(spark, sf_dir)
    orders = _orders(spark, sf_dir).select("event_id", "customer_id")
    return quality.check_relationship(orders, "customer_id", customers, "customer_id")


# --- streams -----------------------------------------------------------------------


def _finish(query) -> None:
    query.awaitTermination()


def stream_ingest(spark, sf_dir):
    """The message files in several micro-batches into a log."""
    files = str(max(1, spark.sparkContext.defaultParallelism // 2))
    stream = event_source(spark, TOPICS, path=message_files(spark, sf_dir), maxFilesPerTrigger=files)
    log = EventLog(spark, scratch_dir(spark, "stream-log"))
    checkpoint = scratch_dir(spark, "stream-checkpoint")
    _finish(start_ingest(stream, log, checkpoint, F.col("message_ts"), availableNow=True))
    return _envelope(log.raw_events())


def stream_outcomes(spark, sf_dir):
    """Messages per topic and outcome, added up from the counters of the micro-batches."""
    stream = event_source(spark, TOPICS, path=message_files(spark, sf_dir), maxFilesPerTrigger="4")
    log, counts = EventLog(spark, scratch_dir(spark, "stream-log")), scratch_dir(spark, "stream-counts")
    _finish(start_ingest(stream, log, scratch_dir(spark, "stream-checkpoint"), F.col("message_ts"), counts, availableNow=True))
    by_batch = batch_counts(spark, counts)
    return by_batch.groupBy("topic", "outcome").agg(F.sum("messages").cast("bigint").alias("messages"))


def stream_chain(spark, sf_dir):
    """Stored orders -> payments -> shipments, one streaming query per step."""
    paid, shipped = scratch_dir(spark, "payments"), scratch_dir(spark, "shipments")
    orders = landed(spark, sf_dir).stream()
    _finish(start_payments(orders, scratch_dir(spark, "cp-payments"), path=paid, availableNow=True))
    payments = event_source(spark, ("payments",), path=paid)
    _finish(start_shipments(payments, scratch_dir(spark, "cp-shipments"), path=shipped, availableNow=True))
    derived = event_source(spark, ("shipments",), path=shipped, streaming=False)
    columns = ["shipment_id", "payment_id", "order_id", "customer_id", "ship_date"]
    return portable(staging.stg_shipments(as_raw_events(derived)).select(columns))


def _enriched(spark, sf_dir, max_delay: str, max_early: str, late: str, hot_orders=()) -> DataFrame:
    """Both streams joined in state.

    A closing event on each stream, beyond all bounds after the last, moves the watermark
    past all real payments, so that those without a match are released. It needs an
    order id (one that matches nothing): rows without a join key are dropped
    before the watermark sees them.
    """
    log = landed(spark, sf_dir)
    closers = scratch_dir(spark, "closing")
    after = F.expr(f"INTERVAL {max_delay} + INTERVAL {max_early} + INTERVAL {late} + INTERVAL 30 DAYS")
    last = log.raw_events().agg((F.max("event_ts") + after).alias("at"))
    last.write.parquet(closers)
    closing = spark.readStream.schema(last.schema).parquet(closers)

    def closed(rows: DataFrame, time: str, order_id: int) -> DataFrame:
        last_row = closing.select(F.col("at").alias(time), F.lit(order_id).cast("bigint").alias("order_id"))
        return rows.unionByName(last_row, allowMissingColumns=True)

    payments = closed(staging.stg_payments(log.stream()), "payment_date", -1)
    orders = closed(staging.stg_orders(log.stream()), "order_ts", -2)
    out = scratch_dir(spark, "enriched")
    counter = LateEvents()
    spark.streams.addListener(counter)
    query = (
        enrich_payments(payments, orders, max_delay, max_early, late, hot_orders)
        .writeStream.option("checkpointLocation", scratch_dir(spark, "cp-enriched"))
        .outputMode("append")
        .trigger(availableNow=True)
        .format("parquet")
        .start(out)
    )
    try:
        _finish(query)
        dropped = counter.of(query)
    finally:
        spark.streams.removeListener(counter)
    if dropped:
        raise RuntimeError(f"{dropped} events came behind the watermark")
    return portable(spark.read.parquet(out))


def stream_payment_enrich(spark, sf_dir):
    """All payments with their orders, whenever those were placed: equal to the left join of the stored tables.

    Some orders are dealt over several state partitions, which must not show.
    """
    return _enriched(spark, sf_dir, "3650 days", "3650 days", "3650 days", hot_orders=[(48, 4), (98, 3), (-5, 2)])


def stream_payment_enrich_bounded(spark, sf_dir):
    """Payments of at most a day after their order; the others come out bare."""
    return _enriched(spark, sf_dir, "1 day", "0 days", "1 day")


# Which service writes about which kind of event, when events are told as log lines.
_SERVICE = {
    "view": "api",
    "error": "kafka_consumer",
    "click": "kafka_producer_orders",
    "purchase": "kafka_producer_payments",
    "signup": "kafka_producer_shipments",
}


def log_scan(spark, sf_dir):
    """Events written as service logs, with traceback lines, and parsed back."""
    events = source.table(spark, sf_dir, "events")
    pairs = [F.lit(x) for pair in _SERVICE.items() for x in pair]
    service = F.element_at(F.create_map(*pairs), F.col("event_type"))
    failed = F.col("event_type") == "error"
    message = F.concat(F.lit("event "), F.col("event_id"), F.lit(" | user "), F.col("user_id"))
    line = render_line(F.col("ts"), F.when(failed, "ERROR").otherwise("INFO"), service, message)
    trace = F.when(failed, F.concat(F.lit("  raised at event "), F.col("event_id")))
    both = F.explode(F.array_compact(F.array(line, trace)))
    lines = events.select(both.alias("value"), service.alias("service"))
    path = scratch_dir(spark, "logs")
    lines.write.partitionBy("service").text(path)
    return portable(scan_logs(spark, path))


QUERIES = {
    "ingest_raw_events": ingest_raw_events,
    "ingest_dedup": ingest_dedup,
    "ingest_outcomes": ingest_outcomes,
    "ingest_onto_history": ingest_onto_history,
    "bad_messages": bad_messages,
    "dead_letter_redrive": dead_letter_redrive,
    "dead_letter_ledger": dead_letter_ledger,
    "topic_filter": topic_filter,
    "event_id": event_ids,
    "row_id": row_id,
    "write_by_key": write_by_key,
    "partition_of_key": partition_of_key,
    "json_field": json_field,
    "cast_bigint": cast_bigint,
    "cast_bigint_forms": cast_bigint_forms,
    "cast_decimal": cast_decimal,
    "cast_timestamp": cast_timestamp,
    "json_default": json_default,
    "revenue": revenue,
    "encode_events": encode_events,
    "emit_counts": emit_counts,
    "derive_payments": derive_payments,
    "derive_shipments": derive_shipments,
    "scan_raw_customers": scan_raw_customers,
    "seed_values": seed_values,
    "seed_insert_ignore": seed_insert_ignore,
    "stg_orders": stg_orders,
    "stg_payments": stg_payments,
    "stg_shipments": stg_shipments,
    "stg_products": stg_products,
    "stg_customers": stg_customers,
    "stg_categories": stg_categories,
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "dim_categories": dim_categories,
    "join_customers": join_customers,
    "join_products": join_products,
    "join_categories": join_categories,
    "join_payments_orders": join_payments_orders,
    "join_shipments_payments": join_shipments_payments,
    "join_shipments_orders": join_shipments_orders,
    "fct_orders": fct_orders,
    "fct_payments": fct_payments,
    "fct_shipments": fct_shipments,
    "materialize_table": materialize_table,
    "build_all": build_all,
    "high_water_mark": high_water_mark,
    "incremental_strict": incremental_strict,
    "incremental_keyed": incremental_keyed,
    "incremental_upsert": incremental_upsert,
    "pipeline_status": pipeline_status,
    "build_fct_orders": build_fct_orders,
    "build_fct_payments": build_fct_payments,
    "build_fct_shipments": build_fct_shipments,
    "build_fct_orders_delta": build_fct_orders_delta,
    "build_fct_payments_delta": build_fct_payments_delta,
    "build_fct_shipments_delta": build_fct_shipments_delta,
    "incremental_keyed_changed": incremental_keyed_changed,
    "incremental_keyed_repeated": incremental_keyed_repeated,
    "incremental_upsert_by_order": incremental_upsert_by_order,
    "join_hot_orders": join_hot_orders,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_check": dq_check,
    "dq_primary_key": dq_primary_key,
    "dq_relationships": dq_relationships,
    "stream_ingest": stream_ingest,
    "stream_outcomes": stream_outcomes,
    "stream_chain": stream_chain,
    "stream_payment_enrich": stream_payment_enrich,
    "stream_payment_enrich_bounded": stream_payment_enrich_bounded,
    "log_scan": log_scan,
}


def prepared(query):
    """The query with the session settings it relies on."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir.rstrip("/"))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run
