"""The delivery view sorts the lines once and folds them before the due orders join."""

import datetime as dt
import re
from types import SimpleNamespace

from orderflow.operators import delivery


def test_lines_are_sorted_once(spark, book, capsys):
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        capsys.readouterr()
        delivery.otif(book).explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set(key, was)
    assert "hashpartitioning(order_id" not in plan
    # lines, shipments, due orders; then the view and the items by item (eight at first)
    assert len(re.findall(r"- Sort \[", plan)) <= 5, plan


def test_repeated_orders_give_one_row_each_kind(spark):
    day = dt.date(2001, 1, 10)
    orders = spark.createDataFrame(
        [(1, "C1", day, day, "register", None), (1, "C1", day, day, "register", None),
         (1, "C2", day, day, "register", None), (2, None, day, day, "register", None),
         (3, "C1", day, day, "register", day), (None, "C1", day, day, "register", None)],
        "order_id long, customer_id string, po_date date, promised_delivery_date date, "
        "promised_date_source string, cancellation_date date")
    lines = spark.createDataFrame(
        [(1, 1, "I1", 5), (1, 1, "I1", 5), (1, 2, "I2", 3), (2, 1, "I1", 4), (3, 1, "I1", 4), (None, 1, "I1", 1)],
        "order_id long, line_no int, item_id string, ordered_qty int")
    sent = spark.createDataFrame(
        [(1, 1, day, 2.0), (1, 1, day, 3.0), (1, 2, day + dt.timedelta(2), 3.0), (None, 1, day, 1.0)],
        "order_id long, line_no int, dispatch_date date, dispatched_qty double").selectExpr(
        "order_id", "line_no", "dispatch_date", "cast(dispatched_qty as decimal(18,3)) dispatched_qty")
    items = spark.createDataFrame([("I1", "Vessel"), ("I2", "Pipe")], "item_id string, product_line string")
    got = delivery.otif(SimpleNamespace(orders=orders, order_lines=lines, dispatches=sent, items=items)).collect()
    assert sorted((r.order_id, str(r.customer_id), r.product_line, r.in_full, r.on_time, r.days_late) for r in got) == [
        (1, "C1", "Vessel", 1, 0, 2), (1, "C2", "Vessel", 1, 0, 2),
        (2, "None", "Vessel", 0, 0, (dt.date(2001, 8, 31) - day).days)]
