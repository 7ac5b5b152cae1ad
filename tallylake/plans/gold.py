"""Silver to Gold: dimensions and the order-line fact."""

from pyspark.sql import functions as F

from tallylake.functions.expressions import date_key
from tallylake.operators.ranking import global_row_number
from tallylake.schemas import GOLD, MONEY


def _goods():
    return (F.col("price") + F.col("freight_value")).cast(MONEY)


def dim_customers(customers):
    """One row per customer_id; customer_key is 1..n in the order of customer_id."""
    return global_row_number(customers, "customer_id", "customer_key").select(*GOLD["dim_customers"])


def dim_products(products):
    """One row per product_id with its volume; product_key is 1..n in the order of product_id."""
    sides = [F.col(f"product_{side}_cm").cast("bigint") for side in ("length", "height", "width")]
    sized = products.withColumn("product_volume_cm3", sides[0] * sides[1] * sides[2])
    return global_row_number(sized, "product_id", "product_key").select(*GOLD["dim_products"])


def dim_date(orders):
    """Every day from the first purchase to the end of the last: the day after it unless that one was at midnight."""
    bought = F.col("order_purchase_timestamp")
    span = orders.agg(F.min(bought).alias("first"), F.max(bought).alias("last"))
    last_day = F.to_date("last")
    end = F.when(F.col("last") == last_day.cast("timestamp_ntz"), last_day).otherwise(F.date_add(last_day, 1))
    day = F.col("full_date")
    return span.select(F.explode(F.sequence(F.to_date("first"), end)).alias("full_date")).select(
        "full_date",
        date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.when(F.weekday(day) >= 5, 1).otherwise(0).alias("is_weekend"),
    )


def payment_totals(payments):
    """Total payment per order."""
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("order_payment"))


def line_totals(items):
    """Lines, goods value (price + freight) and freight per order."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(_goods()).alias("goods_value"),
        F.sum("freight_value").alias("freight_value"),
    )


def order_totals(orders, items, payments):
    """Orders that have lines, one row each, with their line and payment totals.

    line_revenue is what the fact's payment_value adds up to over the order's lines: the order's payment once per
    line, or the goods value when nothing was paid. order_revenue counts the payment once. Lines are summed before
    the join, so all three joined sides have one row per order and share one partitioning.
    """
    paid = F.col("order_payment")
    return (
        orders.join(line_totals(items), "order_id")
        .join(payment_totals(payments), "order_id", "left")
        .withColumn("line_revenue", F.coalesce(paid * F.col("line_count"), F.col("goods_value")).cast("decimal(38,2)"))
        .withColumn("order_revenue", F.coalesce(paid, F.col("goods_value")).cast("decimal(38,2)"))
    )


def totals_from_fact(fact):
    """order_totals from a fact table: one row per order, keyed by customer_key."""
    same = ["order_id", "customer_key", "date_key", "order_status", "actual_delivery_days",
            "estimated_delivery_days", "is_delayed", "order_year", "order_month"]
    return fact.groupBy(*same).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(_goods()).alias("goods_value"),
        F.sum("freight_value").alias("freight_value"),
        F.sum("payment_value").cast("decimal(38,2)").alias("line_revenue"),
        F.sum("payment_allocated").cast(MONEY).cast("decimal(38,2)").alias("order_revenue"),
    )


def _meet(lines, order_side):
    """Lines with their order's columns, joined on a key of its own (see order_lines)."""
    key = F.concat(F.lit("="), "order_id").alias("_order")
    return lines.select("*", key).join(order_side.select("*", key).drop("order_id"), "_order").drop("_order")


def order_lines(orders, items, payments, allocate=False, bucketed=False):
    """Order lines with their order's columns and payment_value: the order's payment, else the line's goods value.

    The payment repeats on each line. With allocate, payment_allocated spreads it over the lines by goods value, so
    that it adds up to what was paid. Tables bucketed by order_id meet without an exchange when bucketed is set.
    Otherwise both sides of the lines' join have an exchange of their own, on a key of their own: only then does
    adaptive execution split an order that holds a large share of the lines.
    """
    order_side = orders.join(payment_totals(payments), "order_id", "left")
    if allocate:
        totals = line_totals(items).select("order_id", "line_count", "goods_value")
        order_side = order_side.join(totals, "order_id")
    lines = items.join(order_side, "order_id") if bucketed else _meet(items, order_side)
    paid = F.col("order_payment")
    lines = lines.withColumn("payment_value", F.coalesce(paid, _goods()).cast(MONEY))
    if allocate:
        paid, goods, whole = (c.cast("double") for c in (paid, _goods(), F.col("goods_value")))
        share = F.when(whole != 0, paid * goods / whole).otherwise(paid / F.col("line_count"))
        lines = lines.withColumn("payment_allocated", F.coalesce(share, goods)).drop("line_count", "goods_value")
    return lines.drop("order_payment")


def fact_orders(orders, items, payments, customers, products, bucketed=False):
    """The order-line fact with surrogate keys from dim_customers and dim_products.

    The customer key is looked up once per order, the product key once per line after the lines met their orders.
    """
    keyed_orders = orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "actual_delivery_days",
        "estimated_delivery_days", "is_delayed", "order_year", "order_month",
    ).join(customers.select("customer_id", "customer_key"), "customer_id", "left")
    chosen = items.select("order_id", "product_id", "price", "freight_value")
    lines = order_lines(keyed_orders, chosen, payments, True, bucketed)
    lines = lines.join(products.select("product_id", "product_key"), "product_id", "left")
    return lines.withColumn("date_key", date_key(F.col("order_purchase_timestamp"))).select(*GOLD["fact_orders"])


def fact_orders_denormalised(orders, items, payments, customers, products):
    """Order lines with natural keys, the order's total payment, customer city and state, and product category."""
    places = customers.select("customer_id", "customer_city", "customer_state")
    categories = products.select("product_id", "product_category_name")
    totals = payment_totals(payments).withColumnRenamed("order_payment", "total_payment")
    order_side = orders.join(places, "customer_id", "left").join(totals, "order_id", "left")
    return _meet(items, order_side).join(categories, "product_id", "left")
