"""Payments joined with their orders while both stream in."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

MAX_HOT = 1000


def enrich_payments(
    payments: DataFrame,
    orders: DataFrame,
    max_delay: str = "7 days",
    max_early: str = "0 days",
    late: str = "1 day",
    hot_orders: list[tuple[int, int]] = (),
) -> DataFrame:
    """Left join of staged payment and order streams on the order id.

    A payment matches orders placed at most ``max_delay`` before and ``max_early`` after it; with
    bounds that span the data it is the plain left join. The bounds
    let Spark drop state: an order is kept until no payment can need it, and a
    payment without an order comes out with NULLs once the watermark, ``late``
    behind the newest event, has passed it. Events that arrive behind the watermark are dropped, as anywhere in
    Structured Streaming; :class:`LateEvents` tells how many.

    Many payments of one order would share a state partition. ``hot_orders``, (order id, pieces), deals the payments
    of those orders over that many partitions, each of which gets a copy of the order; other orders have one. Payments without
    an order id match nothing and are always dealt.
    """
    if len(hot_orders) > MAX_HOT:
        raise ValueError(f"at most {MAX_HOT} hot orders")
    listed = payments.sparkSession.createDataFrame(list(hot_orders), "_hot bigint, _pieces int")
    listed = F.broadcast(listed.groupBy("_hot").agg(F.max("_pieces").alias("_pieces")))  # at most MAX_HOT rows
    pieces = F.greatest(F.coalesce("_pieces", F.lit(1)), F.lit(1))
    dealt = F.xxhash64("payment_id")
    scattered = F.when(F.col("order_id").isNull(), F.pmod(dealt, F.lit(1024)))
    paid = (
        payments.withWatermark("payment_date", late)
        .join(listed, F.col("order_id") == F.col("_hot"), "left")
        .select(
            "payment_id",
            F.col("order_id").alias("_paid_order"),
            F.coalesce(scattered, F.pmod(dealt, pieces)).cast("int").alias("_paid_piece"),
            F.col("amount").alias("payment_amount"),
            F.col("currency").alias("payment_currency"),
            "payment_date",
        )
    )
    placed = (
        orders.withWatermark("order_ts", late)
        .join(listed, F.col("order_id") == F.col("_hot"), "left")
        .select(
            "order_id",
            F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_piece"),
            "product_id",
            "quantity",
            "unit_price",
            "order_ts",
        )
    )
    same = (F.col("_paid_order") == F.col("order_id")) & (F.col("_paid_piece") == F.col("_piece"))
    in_time = F.expr(f"order_ts BETWEEN payment_date - INTERVAL {max_delay} AND payment_date + INTERVAL {max_early}")
    return paid.join(placed, same & in_time, "left").select(
        "payment_id",
        F.col("_paid_order").alias("order_id"),
        "product_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("revenue"),
        "payment_amount",
        "payment_currency",
        "payment_date",
        "order_ts",
    )


def late_events(query: StreamingQuery) -> int:
    """Events of either stream that a query dropped behind the watermark, over the progress it still reports.

    Spark keeps the last hundred reports by default; :class:`LateEvents` counts over a whole run.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class LateEvents(StreamingQueryListener):
    """Adds up what every query drops behind its watermark, from its first batch to its last.

    Add it with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self):
        self._dropped: dict[str, int] = defaultdict(int)
        self._done: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        self._dropped[str(event.runId)] += 0

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._dropped[str(progress.runId)] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._done[str(event.runId)].set()

    def of(self, query: StreamingQuery, timeout: float = 60) -> int:
        """The events a finished query dropped; reports arrive in order, its end last."""
        run = str(query.runId)
        if not self._done[run].wait(timeout):
            raise TimeoutError(f"no report of the end of query {run}")
        return self._dropped[run]
