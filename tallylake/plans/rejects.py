"""Values that Silver can't use: where they stood, what they said, and why they were left out."""

from pyspark.sql import functions as F

from tallylake.functions.expressions import as_type
from tallylake.operators.dedup import POSITION
from tallylake.schemas import KEYS, RAW

#: One line of the channel; place tells the order of the source's rows where the raw table has one.
COLUMNS = ["table_name", "key", "place", "column_name", "raw_text", "reason"]


def rejected_values(raw, table):
    """(table_name, key, place, column_name, raw_text, reason) per value of a raw table of texts that is rejected.

    Reasons: "no <type>" for a text that does not cast to its column's type, "missing key" for a null in a key column,
    "negative" for an amount that payments leave out. One pass of built-in functions; rows without a reject vanish
    before anything is shuffled.
    """
    def entry(condition, column, reason):
        value = F.struct(F.lit(column).alias("column_name"), F.col(column).cast("string").alias("raw_text"),
                         F.lit(reason).alias("reason"))
        return F.when(condition, value)

    found = [entry(F.col(k).isNull(), k, "missing key") for k in KEYS[table]]
    for column, dtype in RAW[table].items():
        if dtype != "string":
            bad = F.col(column).isNotNull() & as_type(F.col(column), dtype).isNull()
            found.append(entry(bad, column, f"no {dtype}"))
    if table == "order_payments":
        amount = as_type(F.col("payment_value"), RAW[table]["payment_value"])
        found.append(entry(amount < 0, "payment_value", "negative"))
    place = F.to_json(POSITION) if POSITION in raw.columns else F.lit(None).cast("string")
    key = F.to_json(F.struct(*KEYS[table]))
    return (
        raw.select(F.lit(table).alias("table_name"), key.alias("key"), place.alias("place"),
                   F.explode(F.array_compact(F.array(*found))).alias("reject"))
        .select("table_name", "key", "place", "reject.*")
    )


def all_rejects(raw_tables):
    """The channel of several raw tables: {table: DataFrame of texts}."""
    parts = [rejected_values(raw, table) for table, raw in raw_tables.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
