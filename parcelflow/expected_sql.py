"""The expected result of each query as plain SQL over the given tables.

Computed from typed columns, never through JSON, so that a wrong parse cannot
hide in both sides.
"""

from __future__ import annotations

from parcelflow.sources.order_tables import BASE_EVENTS

_DIM_TIME = "TIMESTAMP '2024-01-01 00:00:00'"


# The starter rows, spelled out again so that a wrong one cannot hide on both sides.
_CATEGORIES = """
    (1, 'Electronics'), (2, 'Home'), (3, 'Fashion'), (4, 'Beauty'), (5, 'Sports'),
    (6, 'Toys'), (7, 'Books'), (8, 'Groceries'), (9, 'Automotive'), (10, 'Office')
"""
_PRODUCTS = """
    (1, 'Smartphone', 699.99, 1), (2, 'Laptop', 1299.99, 1), (3, 'Headphones', 199.99, 1),
    (4, 'Coffee Maker', 89.99, 2), (5, 'Vacuum Cleaner', 149.99, 2), (6, 'Sofa', 899.99, 2),
    (7, 'T-Shirt', 19.99, 3), (8, 'Jeans', 49.99, 3), (9, 'Sneakers', 79.99, 3),
    (10, 'Lipstick', 29.99, 4), (11, 'Foundation', 39.99, 4), (12, 'Mascara', 24.99, 4),
    (13, 'Football', 29.99, 5), (14, 'Tennis Racket', 89.99, 5), (15, 'Yoga Mat', 39.99, 5),
    (16, 'Action Figure', 14.99, 6), (17, 'Board Game', 29.99, 6), (18, 'Doll', 19.99, 6),
    (19, 'Novel', 14.99, 7), (20, 'Cookbook', 24.99, 7), (21, 'Biography', 19.99, 7),
    (22, 'Organic Apples', 3.99, 8), (23, 'Milk', 2.49, 8), (24, 'Bread', 1.99, 8),
    (25, 'Car Oil', 29.99, 9), (26, 'Tire Inflator', 49.99, 9), (27, 'Car Vacuum', 39.99, 9),
    (28, 'Office Chair', 199.99, 10), (29, 'Desk Lamp', 49.99, 10), (30, 'Notebook', 5.99, 10)
"""
_CUSTOMERS = """
    (1, 'Alice Johnson', 'alice.johnson@example.com'), (2, 'Bob Smith', 'bob.smith@example.com'),
    (3, 'Charlie Brown', 'charlie.brown@example.com'), (4, 'Diana Prince', 'diana.prince@example.com'),
    (5, 'Ethan Hunt', 'ethan.hunt@example.com'), (6, 'Fiona Gallagher', 'fiona.gallagher@example.com'),
    (7, 'George Martin', 'george.martin@example.com'), (8, 'Hannah Baker', 'hannah.baker@example.com'),
    (9, 'Ian Fleming', 'ian.fleming@example.com'), (10, 'Jane Doe', 'jane.doe@example.com')
"""


def _staged(topic: str, condition: str, event_time: str, columns: str) -> str:
    return f"""
    SELECT '{topic}-' || kafka_partition || '-' || kafka_offset AS event_id, '{topic}' AS kafka_topic,
           kafka_partition, kafka_offset, CAST(order_id AS VARCHAR) AS kafka_key, {columns},
           {event_time} AS ingested_at, k
    FROM b WHERE {condition}"""


_ORDERS = _staged(
    "orders", "true", "order_ts",
    "order_id, customer_id, product_id, quantity, unit_price, currency, order_ts",
)
_PAYMENTS = _staged(
    "payments", "has_payment", "payment_date",
    "payment_id, order_id, customer_id, CAST(quantity * unit_price AS DECIMAL(12,2)) AS amount, currency, payment_date",
)
_SHIPMENTS = _staged(
    "shipments", "has_shipment", "ship_date", "shipment_id, payment_id, order_id, customer_id, ship_date"
)

_WITH = f"""
WITH b AS ({BASE_EVENTS}),
raw_categories AS (
    SELECT CAST(min(p_partkey) AS BIGINT) AS category_id, p_type AS name, {_DIM_TIME} AS ingested_at
    FROM part GROUP BY p_type),
raw_products AS (
    SELECT p.p_partkey AS product_id, p.p_name AS name, CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
           {_DIM_TIME} AS ingested_at,
           CAST(c.category_id + CASE WHEN p.p_partkey % 9 = 8 THEN 1000000000 ELSE 0 END AS INT) AS category_id
    FROM part p JOIN (SELECT min(p_partkey) AS k FROM part GROUP BY p_name) f ON f.k = p.p_partkey
    JOIN raw_categories c ON c.name = p.p_type),
raw_customers AS (
    SELECT c_custkey AS customer_id, c_name AS name,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email, {_DIM_TIME} AS ingested_at
    FROM customer),
o AS ({_ORDERS}),
p AS ({_PAYMENTS}),
s AS ({_SHIPMENTS}),
every AS (
    SELECT kafka_topic, kafka_partition, kafka_offset, kafka_key, order_id, ingested_at, k FROM o
    UNION ALL SELECT kafka_topic, kafka_partition, kafka_offset, kafka_key, order_id, ingested_at, k FROM p
    UNION ALL SELECT kafka_topic, kafka_partition, kafka_offset, kafka_key, order_id, ingested_at, k FROM s),
f AS (
    SELECT o.order_id, o.order_ts, o.currency, o.customer_id, c.name AS customer_name, o.product_id,
           pr.name AS product_name, pr.category_id, ca.name AS category_name, o.quantity, o.unit_price,
           CAST(o.quantity * o.unit_price AS DECIMAL(21,2)) AS revenue,
           o.kafka_topic, o.kafka_partition, o.kafka_offset, o.ingested_at
    FROM o LEFT JOIN raw_customers c ON c.customer_id = o.customer_id
    LEFT JOIN raw_products pr ON pr.product_id = o.product_id
    LEFT JOIN raw_categories ca ON ca.category_id = pr.category_id),
fp AS (
    SELECT p.payment_id, p.order_id, p.customer_id, f.product_id, f.product_name, f.category_id,
           f.category_name, f.quantity, f.unit_price, f.revenue, p.amount AS payment_amount,
           p.currency AS payment_currency, f.currency AS order_currency, p.payment_date, f.order_ts,
           p.ingested_at
    FROM p LEFT JOIN f ON f.order_id = p.order_id),
fs AS (
    SELECT s.shipment_id, s.payment_id, s.order_id, s.customer_id, f.product_id, f.product_name,
           f.category_id, f.category_name, f.quantity, f.unit_price, f.revenue,
           p.amount AS payment_amount, p.currency AS payment_currency, f.currency AS order_currency,
           p.payment_date, s.ship_date, f.order_ts, s.ingested_at
    FROM s LEFT JOIN p ON p.payment_id = s.payment_id LEFT JOIN f ON f.order_id = s.order_id)
"""

_MONEY = ("unit_price", "amount", "price", "revenue", "payment_amount")


def _columns(names: list[str], alias: str = "") -> str:
    prefix = f"{alias}." if alias else ""
    return ", ".join(
        f"CAST({prefix}{n} AS DOUBLE) AS {n}" if n in _MONEY else f"{prefix}{n} AS {n}" for n in names
    )


def _select(names: list[str], rest: str) -> str:
    return f"{_WITH} SELECT {_columns(names)} FROM {rest}"


_ENVELOPE = f"""{_WITH}
SELECT kafka_topic, kafka_partition, kafka_offset, kafka_key, order_id,
       ingested_at AS event_ts, ingested_at FROM every"""

_STAGED_HEAD = ["event_id", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_key"]


_STAGED = {
    "orders": ["order_id", "customer_id", "product_id", "quantity", "unit_price", "currency", "order_ts"],
    "payments": ["payment_id", "order_id", "customer_id", "amount", "currency", "payment_date"],
    "shipments": ["shipment_id", "payment_id", "order_id", "customer_id", "ship_date"],
}


def _contract(topic: str) -> list[str]:
    return [*_STAGED_HEAD, *_STAGED[topic], "ingested_at"]


_FACT_ORDER = ["product_id", "product_name", "category_id", "category_name", "quantity", "unit_price", "revenue"]
_CUT = "TIMESTAMP '1998-06-30 00:00:00'"
_FIRST_LOAD = f"(k % 40 <> 3 AND ingested_at <= {_CUT})"
_DERIVED_ID = "kafka_offset * 1048576 + kafka_partition"

_ENRICHED = """
        SELECT p.payment_id, p.order_id, o.product_id, o.quantity, CAST(o.unit_price AS DOUBLE) AS unit_price,
               CAST(CAST(o.quantity * o.unit_price AS DECIMAL(21,2)) AS DOUBLE) AS revenue,
               CAST(p.amount AS DOUBLE) AS payment_amount, p.currency AS payment_currency, p.payment_date,
               o.order_ts
        FROM p LEFT JOIN o ON o.order_id = p.order_id"""

_MODEL_ROWS = {
    "stg_orders": "o",
    "stg_payments": "p",
    "stg_shipments": "s",
    "stg_products": "raw_products",
    "stg_customers": "raw_customers",
    "stg_categories": "raw_categories",
    "dim_customers": "raw_customers",
    "dim_products": "raw_products",
    "dim_categories": "raw_categories",
    "fct_orders": "f",
    "fct_payments": "fp",
    "fct_shipments": "fs",
}

ORACLE = {
    "ingest_raw_events": _ENVELOPE,
    "stream_ingest": _ENVELOPE,
    "ingest_dedup": f"""{_WITH}
        SELECT kafka_topic, kafka_partition, kafka_offset, CAST(1 AS BIGINT) AS stored,
               CAST(CASE WHEN k % 10 = 0 THEN 4 ELSE 2 END AS BIGINT) AS deliveries FROM every""",
    "ingest_outcomes": f"""{_WITH}
        SELECT kafka_topic AS topic, 'written' AS outcome, count(*) AS messages FROM every GROUP BY 1
        UNION ALL
        SELECT kafka_topic, 'duplicate', count(*) FROM every WHERE k % 10 = 0 GROUP BY 1
        UNION ALL SELECT 'orders', 'bad', count(*) FROM b WHERE k % 97 = 96 HAVING count(*) > 0
        UNION ALL SELECT 'orders', 'error', count(*) FROM b WHERE k % 193 = 192 HAVING count(*) > 0""",
    "ingest_onto_history": f"""{_WITH}
        SELECT kafka_topic AS topic, 'duplicate' AS outcome,
               CAST(sum(CASE WHEN k % 10 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS messages
        FROM every WHERE kafka_offset % 100 = 7 GROUP BY 1
        UNION ALL SELECT 'orders', 'bad', count(*) FROM b
        WHERE k % 97 = 96 AND (k + 10000000) % 100 = 7 HAVING count(*) > 0
        UNION ALL SELECT 'orders', 'error', count(*) FROM b
        WHERE k % 193 = 192 AND (k + 20000000) % 100 = 7 HAVING count(*) > 0""",
    "bad_messages": f"""{_WITH}
        SELECT 'orders' AS kafka_topic, kafka_partition, k + 10000000 AS kafka_offset,
               CASE k % 4 WHEN 1 THEN 'value is json null' WHEN 3 THEN 'value is not utf-8'
                          ELSE 'value is not json' END AS reason
        FROM b WHERE k % 97 = 96""",
    "dead_letter_redrive": f"""{_ENVELOPE}
        UNION ALL
        SELECT 'orders', kafka_partition, k + 20000000, CAST(order_id AS VARCHAR), order_id, order_ts, order_ts
        FROM b WHERE k % 193 = 192""",
    "dead_letter_ledger": f"""{_WITH}
        SELECT 'orders' AS kafka_topic, kafka_partition, k + 10000000 AS kafka_offset,
               CASE k % 4 WHEN 1 THEN 'value is json null' WHEN 3 THEN 'value is not utf-8'
                          ELSE 'value is not json' END AS reason, CAST(0 AS BIGINT) AS attempts, false AS settled
        FROM b WHERE k % 97 = 96
        UNION ALL
        SELECT 'orders', kafka_partition, k + 20000000, 'key is not utf-8',
               CAST(CASE WHEN (k + 20000000) % 4 = 0 THEN 3 ELSE 1 END AS BIGINT), true
        FROM b WHERE k % 193 = 192""",
    "topic_filter": f"{_WITH} SELECT kafka_topic, kafka_partition, kafka_offset, kafka_key FROM p",
    "event_id": f"""{_WITH}
        SELECT kafka_topic || '-' || kafka_partition || '-' || kafka_offset AS event_id,
               kafka_topic, kafka_partition, kafka_offset FROM every""",
    "row_id": f"{_WITH} SELECT kafka_topic, count(*) AS row_count, count(*) AS ids FROM every GROUP BY 1",
    "write_by_key": f"""{_WITH},
        sent AS (
            SELECT kafka_key, CASE WHEN k % 10 = 0 THEN 2 ELSE 1 END AS n FROM every
            UNION ALL SELECT CAST(order_id AS VARCHAR), 1 FROM b WHERE k % 97 = 96
            UNION ALL SELECT 'undecodable', 1 FROM b WHERE k % 193 = 192)
        SELECT messages, CAST(1 AS BIGINT) AS files, count(*) AS keys
        FROM (SELECT CAST(sum(n) AS BIGINT) AS messages FROM sent GROUP BY kafka_key) t GROUP BY 1""",
    "partition_of_key": f"""{_WITH},
        sent AS (
            SELECT hex(encode(kafka_key)) AS key, CASE WHEN k % 10 = 0 THEN 2 ELSE 1 END AS n FROM every
            UNION ALL SELECT hex(encode(CAST(order_id AS VARCHAR))), 1 FROM b WHERE k % 97 = 96
            UNION ALL SELECT 'FF', 1 FROM b WHERE k % 193 = 192),
        keys AS (SELECT key, CAST(sum(n) AS BIGINT) AS messages, length(key) // 2 AS size FROM sent GROUP BY key),
        words AS (
            SELECT *, list_transform(range(size // 4), lambda i: ('0x' || substr(key, 8 * i + 7, 2) || substr(key, 8 * i + 5, 2)
                                     || substr(key, 8 * i + 3, 2) || substr(key, 8 * i + 1, 2))::UBIGINT) AS w,
                   substr(key, 8 * (size // 4) + 1) AS tail FROM keys),
        mixed AS (
            SELECT *, list_transform(list_transform(list_transform(w, lambda x: (x * 1540483477) & 4294967295),
                                                    lambda x: xor(x, x >> 24)), lambda x: (x * 1540483477) & 4294967295) AS m FROM words),
        folded AS (
            SELECT *, list_reduce(list_prepend(xor(2538058380::UBIGINT, size::UBIGINT), m::UBIGINT[]),
                                  lambda h, x: xor((h * 1540483477) & 4294967295, x)) AS body FROM mixed),
        rested AS (
            SELECT *, CASE WHEN tail = '' THEN body ELSE (xor(body, ('0x' || substr(tail, 5, 2) || substr(tail, 3, 2)
                               || substr(tail, 1, 2))::UBIGINT) * 1540483477) & 4294967295 END AS h FROM folded),
        stirred AS (SELECT *, (xor(h, h >> 13) * 1540483477) & 4294967295 AS g FROM rested)
        SELECT key, CAST((xor(g, g >> 15) & 2147483647) % 12 AS INT) AS broker_partition, messages FROM stirred""",
    "json_field": """
        SELECT event_id, props ->> 'k' AS k, props ->> 'absent' AS absent FROM events""",
    "cast_bigint": "SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k FROM events",
    "cast_bigint_forms": """
        SELECT event_id, CASE event_id % 8 WHEN 2 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 3 THEN k * 1000
                              WHEN 7 THEN k * 10 ELSE k END AS order_id, event_id % 8 IN (2, 4, 5) AS refused
        FROM (SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k FROM events)""",
    "cast_decimal": "SELECT event_id, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM events",
    "cast_timestamp": "SELECT event_id, ts FROM events",
    "json_default": f"{_WITH} SELECT event_id, quantity FROM o",
    "revenue": f"""{_WITH}
        SELECT event_id, CAST(CAST(quantity * unit_price AS DECIMAL(21,2)) AS DOUBLE) AS revenue FROM o""",
    "encode_events": _select(
        ["event_id", "kafka_key", "order_id", "quantity", "unit_price", "currency", "order_ts"], "o"
    ),
    "emit_counts": f"{_WITH} SELECT kafka_topic AS topic, count(*) AS sent FROM every GROUP BY 1",
    "derive_payments": f"""{_WITH}
        SELECT {_DERIVED_ID} AS payment_id, order_id, customer_id,
               CAST(CAST(quantity * unit_price AS DECIMAL(12,2)) AS DOUBLE) AS amount, currency,
               ingested_at AS payment_date FROM o""",
    "derive_shipments": f"""{_WITH}
        SELECT {_DERIVED_ID} AS shipment_id, payment_id, order_id, customer_id, ingested_at AS ship_date FROM p""",
    "stream_chain": f"""{_WITH}
        SELECT {_DERIVED_ID} AS shipment_id, {_DERIVED_ID} AS payment_id, order_id, customer_id,
               ingested_at AS ship_date FROM o""",
    "scan_raw_customers": f"{_WITH} SELECT * FROM raw_customers",
    "seed_values": f"""{_WITH},
        sc(customer_id, customer_name, email) AS (VALUES {_CUSTOMERS}),
        sp(product_id, product_name, price, category_id) AS (VALUES {_PRODUCTS}),
        sg(category_id, category_name) AS (VALUES {_CATEGORIES})
        SELECT o.event_id, sc.customer_name, sp.product_name, CAST(sp.category_id AS INT) AS category_id,
               sg.category_name
        FROM o LEFT JOIN sc ON sc.customer_id = o.customer_id LEFT JOIN sp ON sp.product_id = o.product_id
        LEFT JOIN sg ON sg.category_id = sp.category_id""",
    "seed_insert_ignore": "SELECT min(p_partkey) AS p_partkey, p_name FROM part GROUP BY p_name",
    "stg_orders": _select(_contract("orders"), "o"),
    "stg_payments": _select(_contract("payments"), "p"),
    "stg_shipments": _select(_contract("shipments"), "s"),
    "stg_products": f"""{_WITH}
        SELECT product_id, name AS product_name, CAST(price AS DOUBLE) AS price, category_id, ingested_at
        FROM raw_products""",
    "stg_customers": f"""{_WITH}
        SELECT customer_id, name AS customer_name, email, ingested_at FROM raw_customers""",
    "stg_categories": f"{_WITH} SELECT category_id, name AS category_name, ingested_at FROM raw_categories",
    "dim_customers": f"{_WITH} SELECT customer_id, name AS customer_name, email FROM raw_customers",
    "materialize_table": f"{_WITH} SELECT customer_id, name AS customer_name, email FROM raw_customers",
    "dim_products": f"""{_WITH}
        SELECT product_id, name AS product_name, CAST(price AS DOUBLE) AS price, category_id FROM raw_products""",
    "dim_categories": f"{_WITH} SELECT category_id, name AS category_name FROM raw_categories",
    "join_customers": f"""{_WITH}
        SELECT o.customer_id, o.event_id, c.name AS customer_name
        FROM o LEFT JOIN raw_customers c ON c.customer_id = o.customer_id""",
    "join_products": f"""{_WITH}
        SELECT o.product_id, o.event_id, pr.name AS product_name, pr.category_id
        FROM o LEFT JOIN raw_products pr ON pr.product_id = o.product_id""",
    "join_categories": f"""{_WITH}
        SELECT o.event_id, pr.category_id, ca.name AS category_name
        FROM o LEFT JOIN raw_products pr ON pr.product_id = o.product_id
        LEFT JOIN raw_categories ca ON ca.category_id = pr.category_id""",
    "join_payments_orders": f"""{_WITH}
        SELECT p.payment_id, p.order_id, {_columns(["product_id", "quantity", "unit_price", "order_ts"], "o")}
        FROM p LEFT JOIN o ON o.order_id = p.order_id""",
    "join_hot_orders": """
        WITH placed AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_orderkey END AS order_id,
                               o_orderkey AS line, o_totalprice AS total FROM orders),
             paid AS (SELECT o_orderkey AS payment_id,
                             CASE WHEN o_orderkey % 1000 = 1 THEN 1 ELSE o_orderkey + 1 END AS order_id FROM orders)
        SELECT paid.order_id, payment_id, line, total FROM paid LEFT JOIN placed ON placed.order_id = paid.order_id""",
    "join_shipments_payments": f"""{_WITH}
        SELECT s.shipment_id, s.payment_id, s.order_id, s.customer_id, s.ship_date, s.ingested_at,
               p.payment_date, CAST(p.amount AS DOUBLE) AS payment_amount, p.currency AS payment_currency
        FROM s LEFT JOIN p ON p.payment_id = s.payment_id""",
    "join_shipments_orders": f"""{_WITH}
        SELECT s.shipment_id, s.order_id, {_columns(["product_id", "quantity", "unit_price", "order_ts"], "o")}
        FROM s LEFT JOIN o ON o.order_id = s.order_id""",
    "fct_orders": _select(
        ["order_id", "order_ts", "currency", "customer_id", "customer_name", *_FACT_ORDER,
         "kafka_topic", "kafka_partition", "kafka_offset", "ingested_at"], "f",
    ),
    "fct_payments": _select(
        ["payment_id", "order_id", "customer_id", *_FACT_ORDER, "payment_amount", "payment_currency",
         "order_currency", "payment_date", "order_ts", "ingested_at"], "fp",
    ),
    "fct_shipments": _select(
        ["shipment_id", "payment_id", "order_id", "customer_id", *_FACT_ORDER, "payment_amount",
         "payment_currency", "order_currency", "payment_date", "ship_date", "order_ts", "ingested_at"], "fs",
    ),
    "build_all": _WITH
    + " UNION ALL ".join(
        f"SELECT '{model}' AS model, count(*) AS row_count FROM {rows}" for model, rows in _MODEL_ROWS.items()
    ),
    "high_water_mark": f"{_WITH} SELECT kafka_topic, max(ingested_at) AS high_water_mark FROM every GROUP BY 1",
    "incremental_strict": f"""{_WITH}
        SELECT event_id, order_id, quantity, ingested_at FROM o
        WHERE {_FIRST_LOAD} OR ingested_at > (SELECT max(ingested_at) FROM o WHERE {_FIRST_LOAD})""",
    "incremental_keyed": f"{_WITH} SELECT event_id, order_id, quantity, ingested_at FROM o",
    "incremental_upsert": f"""{_WITH}
        SELECT event_id, order_id, CAST(quantity + CASE WHEN currency = 'USD' THEN 1 ELSE 0 END AS INT) AS quantity
        FROM o""",
    "incremental_keyed_changed": f"{_WITH} SELECT event_id, order_id, quantity, ingested_at FROM o",
    "incremental_keyed_repeated": f"""{_WITH}
        SELECT event_id, order_id, quantity, ingested_at FROM o
        UNION ALL SELECT event_id, order_id, quantity, ingested_at FROM o""",
    "incremental_upsert_by_order": f"""{_WITH}
        SELECT event_id, order_id, quantity FROM o
        WHERE k % 50 = 49 OR NOT EXISTS (SELECT 1 FROM o x WHERE x.order_id = o.order_id AND x.k % 50 = 49)""",
    "pipeline_status": f"""{_WITH}
        SELECT (SELECT count(*) FROM every) AS raw_events_count, (SELECT count(*) FROM f) AS fct_orders_count,
               (SELECT count(*) FROM fp) AS fct_payments_count, (SELECT count(*) FROM fs) AS fct_shipments_count""",
    "dq_not_null": f"{_WITH} SELECT k, order_id FROM b WHERE quantity_raw IS NULL",
    "dq_unique": "SELECT p_name, count(*) AS row_count FROM part GROUP BY p_name HAVING count(*) > 1",
    "dq_check": "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)",
    "dq_primary_key": f"""{_WITH}
        SELECT order_id, count(*) AS row_count FROM b GROUP BY order_id HAVING count(*) > 1 OR order_id IS NULL""",
    "dq_relationships": f"""{_WITH}
        SELECT o.event_id, o.customer_id FROM o
        WHERE o.customer_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM raw_customers c WHERE c.customer_id = o.customer_id)""",
    "stream_payment_enrich": f"{_WITH} {_ENRICHED}",
    "stream_payment_enrich_bounded": f"""{_WITH} {_ENRICHED}
         AND o.order_ts BETWEEN p.payment_date - INTERVAL 1 DAY AND p.payment_date""",
    "log_scan": """
        WITH e AS (
            SELECT *, CASE event_type WHEN 'view' THEN 'api' WHEN 'error' THEN 'kafka_consumer'
                           WHEN 'click' THEN 'kafka_producer_orders' WHEN 'purchase' THEN 'kafka_producer_payments'
                           ELSE 'kafka_producer_shipments' END AS service,
                   CASE event_type WHEN 'view' THEN 'api' WHEN 'error' THEN 'kafka_consumer'
                           ELSE 'kafka_producer' END AS job,
                   CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
                   'event ' || event_id || ' | user ' || user_id AS message
            FROM events)
        SELECT date_trunc('second', ts) AS ts, level, service AS logger, message, job,
               strftime(ts, '%Y-%m-%d %H:%M:%S') || ' | ' || rpad(level, 8, ' ') || ' | ' || service || ' | ' || message
               AS line
        FROM e
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, job, '  raised at event ' || event_id FROM e WHERE event_type = 'error'""",
}
for _name in ("fct_orders", "fct_payments", "fct_shipments"):
    ORACLE[f"build_{_name}"] = ORACLE[f"build_{_name}_delta"] = ORACLE[_name]
ORACLE["stream_outcomes"] = ORACLE["ingest_outcomes"]
