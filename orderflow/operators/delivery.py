"""V1-V8: the on-time-in-full definition, kept in one place.

ON TIME  the latest dispatch over all lines is on or before the promised date
         (a line never dispatched counts as 9999-12-31, i.e. late)
IN FULL  every line dispatched >= ordered
Cancelled orders and orders not yet due (promised + grace after as-of) are
excluded. ``days_late`` counts an unshipped line up to the as-of date.

Plan shape: dispatches are pre-aggregated per (order, line) with a map-side
partial aggregate, joined to the lines, and folded per order in one aggregate
over their sorted rows, which the due orders then join with one row each; the
product line comes from line 1's item inside that same aggregate, so no second
pass over the lines is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT, Params

NEVER = dt.date(9999, 12, 31)


def due_orders(orders: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """V1: not cancelled, promised date known and due by as-of (+ grace)."""
    return (orders
            .filter(F.col("cancellation_date").isNull()
                    & F.col("promised_delivery_date").isNotNull()
                    & (F.date_add("promised_delivery_date", params.grace_days)
                       <= F.lit(params.as_of)))
            .select("order_id", "customer_id", "po_date",
                    F.col("promised_delivery_date").alias("promised"),
                    "promised_date_source"))


def _with_shipments(lines: DataFrame, dispatches: DataFrame) -> DataFrame:
    """The lines with their shipped quantity (0 if none) and last dispatch."""
    shipped = dispatches.groupBy("order_id", "line_no").agg(
        F.sum("dispatched_qty").alias("shipped"), F.max("dispatch_date").alias("last_dispatch"))
    return (lines.select("order_id", "line_no", "item_id", "ordered_qty")
            .join(shipped, ["order_id", "line_no"], "left")
            .withColumn("shipped", F.coalesce("shipped", F.lit(0).cast("decimal(28,3)"))))


def line_shipments(tables, params: Params = DEFAULT) -> DataFrame:
    """V2: every line of a due order, its shipped quantity (0 if none) and last dispatch."""
    lines = tables.order_lines.join(due_orders(tables.orders, params).select("order_id"), "order_id",
                                    "left_semi")
    return _with_shipments(lines, tables.dispatches)


def otif(tables, params: Params = DEFAULT) -> DataFrame:
    """V8: one row per due order with in_full / on_time / otif / days_late."""
    line_full = F.when(F.col("shipped") >= F.col("ordered_qty"), 1).otherwise(0)
    # the lines come sorted by order from their join, so they are folded as they pass
    folded = _with_shipments(tables.order_lines, tables.dispatches).groupBy("order_id").agg(
        F.min(line_full).alias("in_full"),
        F.max(F.coalesce(F.col("last_dispatch"), F.lit(NEVER))).alias("last_dispatch"),
        F.max(F.coalesce(F.col("last_dispatch"), F.lit(params.as_of))).alias("_last_or_asof"),
        F.max(F.when(F.col("line_no") == 1, F.col("item_id"))).alias("_first_item"),
    )
    per_order = due_orders(tables.orders, params).distinct().join(folded, "order_id")
    items = tables.items.select(F.col("item_id").alias("_first_item"), "product_line")
    on_time = F.when(F.col("last_dispatch") <= F.col("promised"), 1).otherwise(0)
    return (per_order.join(items, "_first_item")
            .select(
                "order_id", "customer_id", "po_date", "promised", "promised_date_source",
                "product_line",
                F.col("in_full").cast("long").alias("in_full"),
                on_time.cast("long").alias("on_time"),
                (F.col("in_full") * on_time).cast("long").alias("otif"),
                "last_dispatch",
                F.datediff("_last_or_asof", "promised").cast("long").alias("days_late"),
            ))
