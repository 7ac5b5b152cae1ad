import datetime
import json
import warnings

import pytest
from pyspark.errors import PySparkException

from tallylake.operators.dedup import first_per_key, split_null_keys
from tallylake.plans import silver
from tallylake.schemas import RAW
from tallylake.sources.bronze import land, list_files, read_bronze, read_raw
from tests.frames import rows, ts

ORDERS = """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
z1,21155322,delivered,2025-01-01 12:00:00,2025-01-01 13:00:00,2025-01-02 00:00:00,2025-01-12 18:00:00,2025-01-11 12:00:00
a2,9e445642,canceled,2025-02-01 00:00:00,,,,2025-02-11 00:00:00
a2,other,shipped,2025-02-03 00:00:00,,,,2025-02-11 00:00:00
b3,c3,shipped,not a time,,,,2025-02-11 00:00:00
b3,c3,shipped,2025-02-03 00:00:00,,,,2025-02-11 00:00:00
"""


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "orders_raw.csv").write_text(ORDERS)
    (folder / "customers_raw.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01310,São Paulo,SP\nc1,u1,01310,São Paulo,SP\nc2,u2,,\"Foz, PR\",NA\n"
    )
    (folder / "products_raw.csv").write_text(
        "product_id,product_category_name,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "21155322,,100,10,5,10\n9e445642,toys,bad,10,5,10\n"
    )
    (folder / "order_items_raw.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "z1,1,21155322,s1,2025-01-05 00:00:00,10.005,1.5\nz1,1,21155322,s1,never,20,1.5\n"
    )
    (folder / "order_payments_raw.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "z1,1,boleto,1,11.5\na2,1,voucher,1,-50.0\nb3,1,voucher,1,\nb3,2,voucher,1,abc\nb3,3,voucher,1,0\n"
    )
    (folder / "notes.txt").write_text("not data")
    return folder


def test_landing_copies_text_and_later_dates_win(spark, landing, tmp_path):
    bronze = str(tmp_path / "bronze")
    names = land(spark, str(landing), bronze, datetime.date(2025, 9, 7))
    assert names == sorted(f"{t}_raw.csv" for t in ("customers", "products", "orders", "order_items", "order_payments"))
    first = read_bronze(spark, bronze, "orders")
    assert rows(first, "order_id", "customer_id", "order_purchase_timestamp") == sorted(
        (line.split(",")[0], line.split(",")[1], line.split(",")[3]) for line in ORDERS.splitlines()[1:]
    )
    (landing / "orders_raw.csv").write_text("\n".join(ORDERS.splitlines()[:2]) + "\n")
    land(spark, str(landing), bronze, datetime.date(2025, 10, 1))
    assert read_bronze(spark, bronze, "orders").count() == 1
    assert read_bronze(spark, bronze, "orders", on=datetime.date(2025, 9, 7)).count() == 5
    assert (tmp_path / "bronze" / "year=2025" / "month=09" / "day=07" / "orders_raw.csv").is_dir()


def test_landing_of_nothing(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert land(spark, str(tmp_path / "empty"), str(tmp_path / "bronze")) == []
    assert any("no .csv or .json" in str(w.message) for w in caught)
    with pytest.raises(PySparkException):
        land(spark, str(tmp_path / "missing"), str(tmp_path / "bronze"))


def test_listing_skips_other_files(spark, landing):
    assert list_files(spark, str(landing)).count() == 5


def test_plain_files_in_bronze_are_readable(spark, tmp_path):
    day = tmp_path / "bronze" / "year=2024" / "month=1" / "day=31"
    day.mkdir(parents=True)
    (day / "orders_raw.csv").write_text(ORDERS)
    assert read_bronze(spark, str(tmp_path / "bronze"), "orders").count() == 5
    with pytest.raises(FileNotFoundError):
        read_bronze(spark, str(tmp_path / "bronze"), "orders", on=datetime.date(2024, 1, 30))


def test_lines_that_do_not_fit_the_header_land_whole(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "order_payments_raw.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "a,1,boleto,1,5.0\nb,1,boleto,1,6.0,surplus\nc,1\nd,1,\" kept, \",,\"\"\n"
    )
    land(spark, str(folder), str(tmp_path / "bronze"), datetime.date(2025, 1, 2))
    path = str(tmp_path / "bronze/year=2025/month=01/day=02/order_payments_raw.csv")
    landed = spark.read.options(header=True, escape='"', ignoreLeadingWhiteSpace=False).csv(path)
    assert rows(landed, "order_id", "_misfit_line") == [
        ("a", None), ("b", "b,1,boleto,1,6.0,surplus"), ("c", "c,1"), ("d", None)
    ]
    raw = read_bronze(spark, str(tmp_path / "bronze"), "order_payments")
    assert rows(raw, "order_id", "payment_type", "payment_installments") == [
        ("a", "boleto", "1"), ("b", "boleto", "1"), ("c", None, None), ("d", " kept, ", None)
    ]


def test_header_decides_the_columns(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "product_width_cm,product_id,product_category_name,product_weight_g,product_length_cm,product_height_cm\n9,p,toys,1,2,3\n"
    )
    assert rows(read_raw(spark, str(tmp_path / "p.csv"), "products"), "product_id", "product_width_cm") == [("p", "9")]


def test_orders_keep_the_first_row_in_the_file(spark, landing):
    orders = silver.clean_orders(read_raw(spark, str(landing / "orders_raw.csv"), "orders"))
    got = {r["order_id"]: r for r in orders.collect()}
    assert len(got) == 3
    assert got["z1"]["customer_id"] == "21155322" and got["a2"]["customer_id"] == "9e445642"
    assert got["z1"]["actual_delivery_days"] == 11.25 and got["z1"]["estimated_delivery_days"] == 10.0
    assert got["z1"]["is_delayed"] == 1 and got["a2"]["is_delayed"] == 0
    assert got["b3"]["order_purchase_timestamp"] is None and got["b3"]["order_year"] is None
    assert (got["a2"]["order_year"], got["a2"]["order_month"]) == (2025, 2)


def test_first_in_file_holds_over_splits(spark, tmp_path):
    lines = ["order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
             "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date"]
    lines += [f"o{i % 100},c{99999 - i},shipped,,,,," for i in range(20000)]
    (tmp_path / "orders.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = read_raw(spark, str(tmp_path / "orders.csv"), "orders")
        assert raw.rdd.getNumPartitions() > 4
        got = rows(silver.clean_orders(raw), "order_id", "customer_id")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((f"o{i}", f"c{99999 - i}") for i in range(100))


def test_customers(spark, landing):
    customers = silver.clean_customers(read_raw(spark, str(landing / "customers_raw.csv"), "customers"))
    assert rows(customers, "customer_id", "customer_zip_code_prefix", "customer_city", "customer_state") == [
        ("c1", 1310, "São Paulo", "SP"), ("c2", 0, "Foz, PR", None)
    ]


def test_products(spark, landing):
    products = silver.clean_products(read_raw(spark, str(landing / "products_raw.csv"), "products"))
    assert rows(products, "product_id", "product_category_name", "product_weight_g") == [
        ("21155322", "unlabeled", 100), ("9e445642", "toys", None)
    ]


def test_order_items(spark, landing):
    raw = read_raw(spark, str(landing / "order_items_raw.csv"), "order_items")
    every = silver.clean_order_items(raw)
    assert rows(every.selectExpr("cast(price as string) p", "shipping_limit_date d"), "p", "d") == [
        ("10.01", ts("2025-01-05")), ("20.00", None)
    ]


def test_payments(spark, landing):
    payments = silver.clean_payments(read_raw(spark, str(landing / "order_payments_raw.csv"), "order_payments"))
    assert rows(payments.selectExpr("order_id", "cast(payment_value as double) v"), "order_id", "v") == [
        ("b3", 0.0), ("z1", 11.5)
    ]


def test_json_landing(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "order_payments_raw.json").write_text(
        '{"order_id": "z1", "payment_value": 11.5}\n{"order_id": "z2", "payment_value": -1}\n'
    )
    land(spark, str(folder), str(tmp_path / "bronze"), datetime.date(2025, 1, 2))
    raw = read_bronze(spark, str(tmp_path / "bronze"), "order_payments", "json")
    assert rows(silver.clean_payments(raw), "order_id", "payment_sequential") == [("z1", None)]


def test_dedup_is_idempotent_and_orders_as_asked(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), (None, 4, "z")], "k string, v int, w string")
    once = first_per_key(df, ["k"], [-df["v"]])
    assert rows(once, "k", "v", "w") == [("a", 2, "y"), (None, 4, "z")]
    assert rows(first_per_key(once, ["k"]), "k", "v", "w") == rows(once, "k", "v", "w")


def test_null_keys_are_quarantined(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    good, bad = split_null_keys(df, ["k"])
    assert rows(good, "k", "v") == [("a", 1)] and rows(bad, "k", "v") == [(None, 2)]


@pytest.mark.parametrize("fmt", ["csv", "json"])
@pytest.mark.parametrize("multiline", [False, True])
def test_order_of_parts_survives_landing(spark, tmp_path, fmt, multiline):
    """Parts of 1 and 2,001 rows: the key's first row stands in the first part, its other versions in the second."""
    folder = tmp_path / "raw" / f"customers_raw.{fmt}"
    folder.mkdir(parents=True)
    names = list(RAW["customers"])
    parts = [[("k", "FIRST")], [("k", f"SECOND{i}") for i in range(2000)] + [("other", "x")]]
    for n, part in enumerate(parts):
        found = [dict.fromkeys(names, "") | {"customer_id": k, "customer_city": city} for k, city in part]
        lines = [json.dumps(r) for r in found] if fmt == "json" else [",".join(names)] + [",".join(r.values()) for r in found]
        (folder / f"part-{n}.{fmt}").write_text("\n".join(lines) + "\n")
    land(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), multiline=multiline)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        unique = silver.clean_customers(read_bronze(spark, str(tmp_path / "bronze"), "customers", fmt))
        assert rows(unique, "customer_id", "customer_city") == [("k", "FIRST"), ("other", "x")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quoted_line_breaks_stay_in_their_row(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "customers_raw.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        'c1,u1,1,"Foz\ndo ""Iguaçu""",PR\nc2,u2,2,Rio,RJ\n'
    )
    land(spark, str(folder), str(tmp_path / "bronze"), multiline=True)
    landed = read_bronze(spark, str(tmp_path / "bronze"), "customers")
    direct = read_raw(spark, str(folder / "customers_raw.csv"), "customers", multiline=True)
    for found in (landed, direct):
        assert rows(found, "customer_id", "customer_city") == [("c1", 'Foz\ndo "Iguaçu"'), ("c2", "Rio")]
