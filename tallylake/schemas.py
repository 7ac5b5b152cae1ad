"""Column names and types of the raw, Silver and Gold tables."""

# Money is exact: sums over decimals do not depend on the order in which partitions are merged.
MONEY = "decimal(18,2)"

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

# Raw table -> column -> Silver type. Raw files are read as text and cast on the way to Silver.
RAW = {
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "int",
        "customer_city": "string",
        "customer_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_weight_g": "int",
        "product_length_cm": "int",
        "product_height_cm": "int",
        "product_width_cm": "int",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        **{name: "timestamp_ntz" for name in ORDER_TIMESTAMPS},
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": MONEY,
        "freight_value": MONEY,
    },
    "order_payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": MONEY,
    },
}

KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
}

GOLD = {
    "fact_orders": {
        "order_id": "string",
        "customer_key": "bigint",
        "product_key": "bigint",
        "date_key": "int",
        "order_status": "string",
        "price": MONEY,
        "freight_value": MONEY,
        "payment_value": MONEY,
        "payment_allocated": "double",
        "actual_delivery_days": "double",
        "estimated_delivery_days": "double",
        "is_delayed": "int",
        "order_year": "int",
        "order_month": "int",
    },
    "dim_customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_city": "string",
        "customer_state": "string",
        "customer_zip_code_prefix": "int",
        "customer_key": "bigint",
    },
    "dim_products": {
        **RAW["products"],
        "product_volume_cm3": "bigint",
        "product_key": "bigint",
    },
    "dim_date": {
        "full_date": "date",
        "date_key": "int",
        "year": "int",
        "quarter": "int",
        "month": "int",
        "month_name": "string",
        "day": "int",
        "day_of_week": "string",
        "is_weekend": "int",
    },
    "features_customer_rfm": {
        "customer_unique_id": "string",
        "recency_days": "int",
        "frequency_orders": "bigint",
        "monetary_spend": "decimal(28,2)",
        "r_score": "int",
        "f_score": "int",
        "m_score": "int",
        "rfm_combined_score": "string",
        "customer_segment": "string",
    },
}

PARTITIONS = {"fact_orders": ["order_year", "order_month"]}


def ddl(columns):
    return ", ".join(f"{name} {dtype}" for name, dtype in columns.items())
