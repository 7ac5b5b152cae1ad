"""Adding columns to a DataFrame from a function over Arrow batches."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text (or list entries) that one step inside a batch works on; a longer row is a step of its own.
STEP_SIZE = 1_000_000


def without(df, names):
    """df's columns except those that bear one of the names, in any case of letters."""
    taken = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


def spare_prefix(df):
    """A prefix that no column's name begins with: names made with it clash with none."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def add_columns(df, make, fields, needs=("text",), arrays=False):
    """df with new columns. make() is called once per task and returns f(columns of needs as lists) -> lists.

    With arrays, f takes and gives Arrow arrays. What f may have as f.close() is called when the task ends.

    Columns of df that bear a new name are replaced, all others pass unread. Rows reach f in steps of about STEP_SIZE,
    so memory is bounded by an Arrow batch and not by what f builds from it.
    """
    names = [f.name for f in fields]
    kept = [f for f in df.schema if f.name.lower() not in {n.lower() for n in names}]
    inputs = [f"_in{i}" for i in range(len(needs))]
    base = df.select(
        *[F.col(f"`{f.name}`").alias(f"_c{i}") for i, f in enumerate(kept)],
        *[F.col(f"`{c}`").alias(i) for c, i in zip(needs, inputs, strict=True)],
    )
    schema = T.StructType(kept + fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        compute = make()
        try:
            for batch in batches:
                for start, size in steps(batch.column("_in0")):
                    part = batch.slice(start, size)
                    new = compute(*[part.column(c) if arrays else part.column(c).to_pylist() for c in inputs])
                    columns = [part.column(i).cast(arrow.field(i).type) for i in range(len(kept))]
                    for n, v in zip(names, new, strict=True):
                        columns.append(v.cast(arrow.field(n).type) if arrays else pa.array(v, type=arrow.field(n).type))
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        finally:
            getattr(compute, "close", lambda: None)()

    return base.mapInArrow(run, schema)


def steps(column, size=STEP_SIZE):
    """(start, rows) of slices of about that many characters or entries of a column."""
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    start = total = 0
    for i, n in enumerate(pc.fill_null(length(column), 0).to_pylist()):
        if total and total + n > size:
            yield start, i - start
            start, total = i, 0
        total += n
    if start < len(column):
        yield start, len(column) - start
