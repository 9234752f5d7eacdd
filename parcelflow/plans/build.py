"""The warehouse: raw tables, the twelve models, and building them in order."""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions.keys import BLOCK_BITS
from parcelflow.operators.event_log import EventLog
from parcelflow.operators.facts import FactTable, Input, distinct_keys
from parcelflow.operators.incremental import IncrementalTable
from parcelflow.operators.versioned import VersionedTable
from parcelflow.operators.conflicts import insert_ignore
from parcelflow.operators.joins import HotKeys, hot_keys
from parcelflow.operators.quality import check_not_null, check_primary_key, check_rule, require
from parcelflow.plans import marts, staging
from parcelflow.schemas import RAW_CATEGORIES, RAW_CUSTOMERS, RAW_EVENTS, RAW_PRODUCTS, create_if_absent
from parcelflow.sources.seeds import seed_categories, seed_customers, seed_products


@dataclass(frozen=True)
class Model:
    """How a model is computed, from which models, and how it is kept."""

    materialized: str  # view | table | incremental | fact
    needs: tuple[str, ...]
    query: Callable[["Warehouse"], DataFrame]


MODELS: dict[str, Model] = {
    "stg_orders": Model("incremental", (), lambda w: w.staged("orders")),
    "stg_payments": Model("incremental", (), lambda w: w.staged("payments")),
    "stg_shipments": Model("incremental", (), lambda w: w.staged("shipments")),
    "stg_products": Model("view", (), lambda w: staging.stg_products(w.source("raw_products"))),
    "stg_customers": Model("view", (), lambda w: staging.stg_customers(w.source("raw_customers"))),
    "stg_categories": Model("view", (), lambda w: staging.stg_categories(w.source("raw_categories"))),
    "dim_customers": Model("table", ("stg_customers",), lambda w: marts.dim_customers(w.ref("stg_customers"))),
    "dim_products": Model("table", ("stg_products",), lambda w: marts.dim_products(w.ref("stg_products"))),
    "dim_categories": Model(
        "table", ("stg_categories",), lambda w: marts.dim_categories(w.ref("stg_categories"))
    ),
    "fct_orders": Model(
        "fact",
        ("stg_orders", "dim_customers", "dim_products", "dim_categories"),
        lambda w: w.fact_rows("fct_orders", w.ref("stg_orders")),
    ),
    "fct_payments": Model(
        "fact",
        ("stg_payments", "fct_orders"),
        lambda w: w.fact_rows("fct_payments", w.ref("stg_payments")),
    ),
    "fct_shipments": Model(
        "fact",
        ("stg_shipments", "stg_payments", "fct_orders"),
        lambda w: w.fact_rows("fct_shipments", w.ref("stg_shipments")),
    ),
}

# Hot-key lists: the joined model whose key column is measured.
_HOT = {"hot_orders": ("fct_orders", "order_id"), "hot_payments": ("stg_payments", "payment_id")}

_RAW_TABLES = {"raw_categories": RAW_CATEGORIES, "raw_products": RAW_PRODUCTS, "raw_customers": RAW_CUSTOMERS}
# Conflict key, primary key and required columns of each raw table
_RAW_KEYS = {
    "raw_categories": ("name", "category_id", ["category_id", "name", "ingested_at"]),
    "raw_products": ("name", "product_id", ["product_id", "name", "price", "ingested_at"]),
    "raw_customers": ("email", "customer_id", ["customer_id", "name", "email", "ingested_at"]),
}


class Warehouse:
    """Raw tables and models below one folder that all executors can reach.

    A stored event with a malformed field stops the build (``on_error="raise"``), or
    is left out of its staging table and listed by :meth:`failed`
    (``on_error="quarantine"``). ``fact_parts`` fixes the number of parts of a fact; by default it
    follows from the number of rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        block_bits: int = BLOCK_BITS,
        on_error: str = "raise",
        fact_parts: int | None = None,
    ):
        self.fact_parts = fact_parts
        self.spark, self.root, self.block_bits = spark, root.rstrip("/"), block_bits
        self.on_error = on_error
        self._loads: dict[str, IncrementalTable] = {}
        self._hot: dict[str, HotKeys] = {}
        self._measuring = {name: threading.Lock() for name in _HOT}
        self.refreshed: dict[str, str] = {}  # how each fact was brought up to date: full, changes or nothing
        self.log = EventLog(spark, f"{self.root}/raw/event_log", block_bits)
        for name, columns in _RAW_TABLES.items():
            create_if_absent(spark, self._raw(name), columns)

    # --- raw layer -------------------------------------------------------

    def source(self, name: str) -> DataFrame:
        """A raw table."""
        if name == "raw_events":
            return self.log.raw_events()
        return self.spark.read.schema(_RAW_TABLES[name]).parquet(self._raw(name))

    def staged(self, topic: str) -> DataFrame:
        """Typed events of a topic, with the folder column that loads prune on."""
        events = staging.typed_events(self.log.raw_events(blocks=True, topic=topic), topic, self.on_error)
        return staging.split_failed(events)[0] if self.on_error == "quarantine" else events

    def failed(self, topic: str) -> DataFrame:
        """Stored events of a topic with malformed fields, named in ``failed_fields``."""
        return staging.split_failed(staging.typed_events(self.log.raw_events(topic=topic), topic, "quarantine"))[1]

    def insert(self, name: str, rows: DataFrame) -> None:
        """Insert rows into a raw dimension table unless their name or email is taken.

        The table's constraints are checked first; a violation inserts nothing.
        """
        key, primary, required = _RAW_KEYS[name]
        stored = self.source(name)
        new = insert_ignore(rows.select(stored.columns), key, primary, stored).persist()
        try:
            require(f"{name}: not null", check_not_null(new, required))
            require(f"{name}: primary key", check_primary_key(new, [primary]))
            require(f"{name}: primary key taken", new.join(stored, primary, "left_semi"))
            if name == "raw_products":
                require(f"{name}: price >= 0", check_rule(new, "price >= 0"))
            new.write.mode("append").parquet(self._raw(name))
        finally:
            new.unpersist()

    def seed(self) -> None:
        """Insert the starter rows; those present already are left alone."""
        self.insert("raw_categories", seed_categories(self.spark))
        self.insert("raw_products", seed_products(self.spark))
        self.insert("raw_customers", seed_customers(self.spark))

    def _raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    # --- model layer -----------------------------------------------------

    def ref(self, name: str) -> DataFrame:
        """A built model; a view is computed on read."""
        model = MODELS[name]
        if model.materialized == "view":
            return model.query(self)
        if model.materialized == "incremental":
            return self._incremental(name).read()
        if model.materialized == "fact":
            return self._fact(name).read()
        return self._versioned(name).read()

    def materialize(self, name: str, mode: str = "keyed") -> None:
        """Build one model from what is stored now.

        ``mode`` is for incremental models: ``keyed`` loads every missing event,
        ``strict`` those above the high-water mark.
        """
        model = MODELS[name]
        if model.materialized == "view":
            model.query(self).createOrReplaceTempView(name)
        elif mode not in ("keyed", "strict"):
            raise ValueError(f"mode must be 'keyed' or 'strict', not {mode!r}")
        elif model.materialized == "table":
            # the version before this one goes a build later, when its readers are done
            self._versioned(name).vacuum()
            materialize_table(model.query(self), self._table(name), only_changed=True)
        elif model.materialized == "fact":
            self._refresh(name)
        else:
            table = self._incremental(name)
            table.tidy()
            (table.load_keyed if mode == "keyed" else table.load_strict)(model.query(self))

    def _refresh(self, name: str) -> None:
        """Bring a fact up to date from what changed in its inputs."""
        fact, follows = self._fact(name), marts.FOLLOWS[name]
        fact.table.vacuum()
        tables = {n: Input(self._stored(n), key, n.startswith("dim_")) for n, key in follows.joined.items()}
        left = Input(self._stored(follows.left), "event_id")
        self.refreshed[name] = fact.refresh(
            left, tables, lambda: self.ref(follows.left), lambda rows, whole: self.fact_rows(name, rows, whole), self.fact_parts
        )

    def fact_rows(self, name: str, left: DataFrame, whole: bool = True) -> DataFrame:
        """Fact rows of some left rows, with their ``event_id``; unless ``whole``, joined tables are cut to the keys at hand."""
        keep = ("event_id",)

        def partners(model: str, key: str) -> DataFrame:
            if whole:
                return self.ref(model)
            keys = distinct_keys(left, key)
            return self._fact(model).holding(keys) if model == "fct_orders" else self.ref(model).join(keys, key, "left_semi")

        if name == "fct_orders":
            dims = [self.ref(dim) for dim in ("dim_customers", "dim_products", "dim_categories")]
            return marts.fct_orders(left, *dims, keep=keep)
        hot_orders = self.hot("hot_orders") if whole else ()
        orders = partners("fct_orders", "order_id")
        if name == "fct_payments":
            return marts.fct_payments(left, orders, hot_orders, keep)
        hot_payments = self.hot("hot_payments") if whole else ()
        return marts.fct_shipments(left, partners("stg_payments", "payment_id"), orders, hot_payments, hot_orders, keep)

    def build(self, mode: str = "keyed", threads: int = 4) -> DataFrame:
        """Build all models in dependency order; returns name and row count of each.

        Models that do not depend on each other run as parallel Spark jobs.
        """
        order = TopologicalSorter({name: model.needs for name, model in MODELS.items()})
        order.prepare()
        self._hot.clear()
        # job groups and tags of the caller hold for the jobs started below
        step = inheritable_thread_target(self.spark)(lambda name: self.materialize(name, mode))
        running = {}
        with ThreadPoolExecutor(threads) as pool:
            while order.is_active():
                for name in order.get_ready():
                    running[pool.submit(step, name)] = name
                for job in wait(running, return_when=FIRST_COMPLETED).done:
                    job.result()
                    order.done(running.pop(job))
        return self.row_counts()

    def row_counts(self) -> DataFrame:
        """``model, row_count`` of all models."""
        counts = [
            self.ref(name).agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("row_count"))
            for name in MODELS
        ]
        result = counts[0]
        for count in counts[1:]:
            result = result.unionAll(count)
        return result

    def status(self) -> DataFrame:
        """Row counts of the log and the facts, from file footers and manifests."""
        facts = {name: self._versioned(name).count() for name in ("fct_orders", "fct_payments", "fct_shipments")}
        raw = self.source("raw_events").agg(F.count(F.lit(1)).alias("raw_events_count"))
        return raw.withColumns({f"{name}_count": F.lit(n).cast("bigint") for name, n in facts.items()})

    def declare(self, raw: str = "raw", wh: str = "wh") -> None:
        """Make the built warehouse queryable in SQL as ``raw.*`` and ``wh.*``.

        Views over the files, so they always show the current state.
        """
        for database in (raw, wh):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

        def view(name: str, columns: list[str], rows: str) -> None:
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(columns)} FROM {rows}")

        log = f"parquet.`{self.log.path}` WHERE outcome = 'written'"
        view(f"{raw}.raw_events", [c for c in RAW_EVENTS.fieldNames() if c != "spelled"], log)
        for name in _RAW_TABLES:
            view(f"{raw}.{name}", self.source(name).columns, f"parquet.`{self._raw(name)}`")
        for name, model in MODELS.items():
            if model.materialized == "view":
                view(f"{wh}.{name}", staging.RENAMED[name], f"{raw}.{name.replace('stg_', 'raw_')}")
            else:
                kept = self._stored(name)
                columns = self._fact(name).columns() if model.materialized == "fact" else kept.schema.fieldNames()
                self.spark.sql(f"CREATE OR REPLACE VIEW {wh}.{name} AS {kept.sql(columns)}")

    def hot(self, name: str) -> HotKeys:
        """Join keys to split, measured once per build, and only if a fact is built in full, on the table that is joined."""
        with self._measuring[name]:
            if name not in self._hot:
                model, key = _HOT[name]
                self._hot[name] = hot_keys(self.ref(model), key)
            return self._hot[name]

    def _table(self, name: str) -> str:
        return f"{self.root}/wh/{name}"

    def _versioned(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self._table(name))

    def _fact(self, name: str) -> FactTable:
        return FactTable(self.spark, self._table(name), "event_id", "order_id", marts.FOLLOWS[name].columns, hidden=True)

    def _stored(self, name: str) -> VersionedTable:
        """The files of a model that is not a view."""
        return self._incremental(name).table if MODELS[name].materialized == "incremental" else self._versioned(name)

    def _incremental(self, name: str) -> IncrementalTable:
        if name not in self._loads:
            schema = MODELS[name].query(self).drop("offset_block").schema
            self._loads[name] = IncrementalTable(
                self.spark, self._table(name), schema, "event_id", self.block_bits
            )
        return self._loads[name]


def materialize_table(df: DataFrame, path: str, only_changed: bool = False) -> VersionedTable:
    """Full rebuild: the new rows replace the table in one step; readers of the old ones keep them.

    With ``only_changed``, rows equal to those stored are not committed, so that whatever follows the table sees no change.
    """
    table = VersionedTable(df.sparkSession, path, df.schema, df.columns if only_changed else None)
    table.replace_all(df, only_changed)
    return table
