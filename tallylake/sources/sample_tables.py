"""The TPC-H-like sample tables seen as raw retail tables.

Deterministic rules turn customer, part, orders and lineitem into customers, products, orders, order items and
payments with the defects a raw zone has: copied rows, missing values, negative and outlying payments.
"""

from pyspark.sql import functions as F

from tallylake.schemas import MONEY, ORDER_TIMESTAMPS


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_customers(spark, sf_dir):
    key = F.col("c_custkey")
    customers = (
        _read(spark, sf_dir, "customer")
        .join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.cast("string").alias("customer_id"),
            (key - F.when(key % 5 == 4, 1).otherwise(0)).cast("string").alias("customer_unique_id"),
            F.when(key % 7 != 0, 10000 + key % 90000).cast("int").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
            (key < 15).alias("copied"),
        )
    )
    return customers.unionByName(customers.where("copied")).drop("copied")


def raw_products(spark, sf_dir):
    size = F.col("p_size")
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 50 != 0, F.col("p_type")).alias("product_category_name"),
        (size * 100).alias("product_weight_g"),
        (size + 10).alias("product_length_cm"),
        (size + 5).alias("product_height_cm"),
        (size + 10).alias("product_width_cm"),
    )


def _plus(unit, amount, start):
    return F.timestamp_add(unit, amount.cast("int"), start)


def raw_orders(spark, sf_dir, as_text=False):
    """Orders with the first 25 repeated. as_text renders the timestamps as a CSV file holds them."""
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "canceled")
    )
    orders = (
        _read(spark, sf_dir, "orders")
        .withColumn("order_status", status)
        .withColumn("order_purchase_timestamp", _plus("HOUR", key % 24, F.col("o_orderdate")))
        .withColumn("order_estimated_delivery_date", _plus("DAY", 10 + key % 11, F.col("order_purchase_timestamp")))
    )
    delivered = F.col("order_status") == "delivered"
    shipped = delivered | (F.col("order_status") == "shipped")
    bought = F.col("order_purchase_timestamp")
    arrival = _plus("DAY", (key * 7) % 23 % 14 - 5, F.col("order_estimated_delivery_date"))
    orders = orders.select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        "order_status",
        "order_purchase_timestamp",
        F.when(F.col("order_status") != "canceled", _plus("MINUTE", 5 + key % 176, bought)).alias("order_approved_at"),
        F.when(shipped, _plus("DAY", 1 + key % 3, bought)).alias("order_delivered_carrier_date"),
        F.when(delivered, _plus("HOUR", key % 7, arrival)).alias("order_delivered_customer_date"),
        "order_estimated_delivery_date",
        (key < 25).alias("copied"),
    )
    if as_text:
        text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ORDER_TIMESTAMPS}
        orders = orders.withColumns(text)
    return orders.unionByName(orders.where("copied")).drop("copied")


def raw_order_items(spark, sf_dir):
    """Order lines; many (order, line number) pairs come in several versions."""
    price = F.col("l_extendedprice").cast(MONEY)
    freight = (price * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY)
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
    )


def raw_order_payments(spark, sf_dir):
    key = F.col("o_orderkey")
    total = F.col("o_totalprice").cast(MONEY)
    value = F.when(key % 997 == 0, F.lit(-50).cast(MONEY)).when(key % 991 == 0, (total * 25).cast(MONEY))
    return (
        _read(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") != "P")
        .select(
            key.cast("string").alias("order_id"),
            F.lit(1).alias("payment_sequential"),
            F.col("o_orderpriority").alias("payment_type"),
            (1 + key % 10).cast("int").alias("payment_installments"),
            value.otherwise(total).alias("payment_value"),
        )
    )


# Which ids have an unreadable text, in which column, and what it says.
_UNREADABLE = {
    "customers": ("customer_id", 11, "customer_zip_code_prefix", "unknown"),
    "products": ("product_id", 13, "product_weight_g", "heavy"),
    "orders": ("order_id", 17, "order_approved_at", "soon"),
    "order_items": ("order_id", 101, "price", "free"),
    "order_payments": ("order_id", 89, "payment_value", "abc"),
}


def raw_text(spark, sf_dir, table):
    """A raw table as a CSV file holds it: every value a text, some of them unreadable."""
    raw = globals()[f"raw_{table}"](spark, sf_dir, **({"as_text": True} if table == "orders" else {}))
    key, every, column, text = _UNREADABLE[table]
    bad = F.col(key).cast("int") % every == 0
    values = {c: F.col(c).cast("string") for c in raw.columns}
    values[column] = F.when(bad, F.lit(text)).otherwise(values[column])
    return raw.select(*[value.alias(c) for c, value in values.items()])
