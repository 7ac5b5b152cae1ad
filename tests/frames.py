"""Small hand-made tables."""

import datetime

from tallylake.schemas import RAW, ddl


def ts(text):
    return datetime.datetime.fromisoformat(text)


def table(spark, name, rows):
    """A typed raw table from dicts; columns that a row leaves out are null."""
    columns = RAW[name]
    plain = {c: "double" if t.startswith("decimal") else t for c, t in columns.items()}
    values = [
        tuple(float(row[c]) if plain[c] == "double" and c in row else row.get(c) for c in columns) for row in rows
    ]
    df = spark.createDataFrame(values, ddl(plain))
    return df.select(*[df[c].cast(t).alias(c) for c, t in columns.items()])


def order(order_id, customer_id="c1", status="delivered", at="2025-01-10 10:00:00", arrived=None, promised=None):
    return {
        "order_id": order_id, "customer_id": customer_id, "order_status": status,
        "order_purchase_timestamp": ts(at) if at else None,
        "order_delivered_customer_date": ts(arrived) if arrived else None,
        "order_estimated_delivery_date": ts(promised) if promised else None,
    }


def item(order_id, n=1, product="p1", price=10.0, freight=1.0):
    return {"order_id": order_id, "order_item_id": n, "product_id": product, "price": price, "freight_value": freight}


def payment(order_id, value, n=1):
    return {"order_id": order_id, "payment_sequential": n, "payment_value": value}


def customer(customer_id, person=None, state="SP", city="Campinas"):
    return {"customer_id": customer_id, "customer_unique_id": person or customer_id, "customer_zip_code_prefix": 1,
            "customer_state": state, "customer_city": city}


def product(product_id, category="toys", size=2):
    return {"product_id": product_id, "product_category_name": category, "product_weight_g": 5,
            "product_length_cm": size, "product_height_cm": size, "product_width_cm": size}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
