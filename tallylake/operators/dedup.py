"""Row deduplication and null-key quarantine."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

# Column that the raw readers add: where the row stood in its file. It is used and dropped by first_per_key.
POSITION = "_position"


def first_per_key(df, keys, order_by=()):
    """Keep one whole row per key: the least by order_by, then file position, then all other columns.

    The pick is a min over a struct, so copies collapse before the shuffle and one key that holds a third of
    the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c != POSITION]
    first = list(order_by) + ([F.col(POSITION)] if POSITION in df.columns else [])
    row = F.struct(*[c.alias(f"_order{i}") for i, c in enumerate(first)], *rest)
    return (
        df.groupBy(*keys)
        .agg(F.min(row).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns if c != POSITION])
    )


def split_null_keys(df, keys):
    """(rows whose keys are all present, quarantined rows with a null in any key)."""
    broken = reduce(or_, [F.col(k).isNull() for k in keys])
    return df.where(~broken), df.where(broken)
