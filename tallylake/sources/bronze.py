"""Bronze zone: raw files as text under year=/month=/day= folders, any Hadoop file system (file, s3a, gs, ...).

Every landed row carries its lineage: the file it came from, the start of its split there, and its place in the split.
These give the order of the source's rows, however many parts the source and the landed copy have.
"""

import datetime
import warnings
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tallylake.functions.expressions import missing_to_null
from tallylake.operators.dedup import POSITION
from tallylake.schemas import RAW

# Quoted empty text and unquoted nothing stay different, and blanks around a value are part of it.
_CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
# Not Spark's default name, which would make the column special again when the landed file is read.
_MISFIT = "_misfit_line"
LINEAGE = {"_source_file": "string", "_source_block": "bigint", "_source_row": "bigint"}
_LINE = "_source_line"
#: Rows of a landed part. Quoted line breaks may be in it, so it is read whole by one task.
_ROWS_PER_FILE = 1_000_000
#: Tables that are landed at the same time.
_AT_ONCE = 4


def _lineage():
    """Split in the source, then row in the split: in this order the rows stand as in the source."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return [c.alias(name) for c, name in zip(place, LINEAGE)]


def list_files(spark, folder, glob="*.{csv,json}", deep=False):
    """Path, length and modification time of the raw files; their content is not read. A missing folder raises."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", deep)
    return files.load(folder).select("path", "length", "modificationTime")


def _names(spark, source):
    """Names of the raw tables in a folder: each a .csv or .json file, or a folder of parts with such a name."""
    parts = F.split("path", "/")
    last, parent = F.element_at(parts, -1), F.element_at(parts, -2)
    is_part = parent.rlike(r"\.(csv|json)$")
    place = F.element_at(parts, F.when(is_part, -3).otherwise(-2))
    found = list_files(spark, source, deep=True).where(place == source.rstrip("/").rsplit("/", 1)[-1])
    return [row["name"] for row in found.select(F.when(is_part, parent).otherwise(last).alias("name")).distinct().collect()]


def land(spark, source, bronze, on=None, multiline=False):
    """Copy every raw .csv and .json file of source, all values as text with their lineage, into a date's partition.

    Returns the names landed. Each file is read and written in parallel splits, so it lands as a folder of parts
    under its own name; several files land at a time. A CSV line that does not fit its header lands with the whole line
    in _misfit_line. Values with quoted line breaks need multiline=True, which reads each file of the source in one
    task. A rerun for the same date overwrites that date only.
    """
    on = on or datetime.date.today()
    names = sorted(_names(spark, source))
    if not names:
        warnings.warn(f"no .csv or .json files in {source}", stacklevel=2)
    day = f"{bronze}/year={on.year}/month={on.month:02d}/day={on.day:02d}"

    def copy(name):
        path = f"{source}/{name}"
        if name.endswith(".json"):
            lines = spark.read.text(path).select(*_lineage(), F.col("value").alias(_LINE))
            lines.write.mode("overwrite").option("maxRecordsPerFile", _ROWS_PER_FILE).json(f"{day}/{name}")
            return
        read = spark.read.options(**_CSV, multiLine=multiline)
        header = read.csv(path).columns
        columns = ", ".join(f"`{c}` string" for c in [*header, _MISFIT])
        text = read.schema(columns).option("columnNameOfCorruptRecord", _MISFIT).csv(path)
        text = text.select(*[F.col(f"`{c}`") for c in text.columns], *_lineage())
        write = text.write.mode("overwrite").options(**_CSV, emptyValue='""', maxRecordsPerFile=_ROWS_PER_FILE)
        write.csv(f"{day}/{name}")

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(copy, names))
    return names


def partitions(spark, bronze, table, fmt="csv"):
    """The (year, month, day, folder) partitions in which a table has landed. Lists files; reads none."""
    files = spark.read.format("binaryFile").option("basePath", bronze)
    found = files.load(f"{bronze}/year=*/month=*/day=*/{table}_raw.{fmt}")
    folder = F.regexp_extract("path", r"^(.*/day=\d+)/", 1).alias("folder")
    return found.select(*[F.col(c).cast("int").alias(c) for c in ("year", "month", "day")], folder).distinct()


def read_raw(spark, path, table, fmt="csv", multiline=False):
    """Read raw or landed files as text columns, missing-value texts as null, with each row's place in its source.

    CSV columns are found by their header name and a file whose header differs raises. Quoted line breaks need
    multiline=True, except in landed files. Parquet input keeps its types.
    """
    columns = list(RAW[table])
    if fmt == "csv":
        read = spark.read.options(**_CSV, enforceSchema=False)
        df = read.option("multiLine", multiline).csv(path)
        if set(LINEAGE) <= set(df.columns) and not multiline:
            df = read.option("multiLine", True).schema(df.schema).csv(path)
    elif fmt == "json":
        fields = ", ".join(f"{c} string" for c in columns)
        extra = ", ".join(f"{c} {t}" for c, t in LINEAGE.items())
        df = spark.read.schema(f"{fields}, {extra}, {_LINE} string").json(path)
        parsed = F.from_json(_LINE, fields)
        df = df.withColumns({c: F.coalesce(c, parsed[c]) for c in columns})
    else:
        return spark.read.format(fmt).load(path).select(*columns)
    own = F.struct(*_lineage())
    if set(LINEAGE) <= set(df.columns):
        landed = F.struct(*[F.col(c).cast(t).alias(c) for c, t in LINEAGE.items()])
        own = F.when(F.col("_source_file").isNotNull(), landed).otherwise(own)
    return df.select(*[missing_to_null(F.col(c)).alias(c) for c in columns], own.alias(POSITION))


def newest_versions(spark, bronze, table, keys, fmt="csv", since=None):
    """The newest row per key over all landed dates: a late correction wins, a day without a key loses nothing.

    Within a date the last row of the source counts. since leaves earlier dates unread. Versions merge before the
    shuffle, so that a frequent key is few rows.
    """
    landed = partitions(spark, bronze, table, fmt)
    if since is not None:
        landed = landed.where(F.make_date("year", "month", "day") >= F.lit(since))
    days = sorted((r["year"], r["month"], r["day"], r["folder"]) for r in landed.collect())  # a row per landed date
    if not days:
        raise FileNotFoundError(f"no {table}_raw.{fmt} in {bronze} since {since or 'any date'}")
    whole = None
    for year, month, day, folder in days:
        rows = read_raw(spark, f"{folder}/{table}_raw.{fmt}", table, fmt)
        rows = rows.withColumn("_landed", F.lit(datetime.date(year, month, day)))
        whole = rows if whole is None else whole.unionByName(rows)
    rest = [c for c in RAW[table] if c not in keys]
    newest = whole.groupBy(*keys).agg(F.max(F.struct("_landed", POSITION, *rest)).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in RAW[table]])


def read_bronze(spark, bronze, table, fmt="csv", on=None):
    """Read one landed table: the partition of a date, or the latest one when no date is given."""
    landed = partitions(spark, bronze, table, fmt)
    if on is not None:
        landed = landed.where(F.make_date("year", "month", "day") == F.lit(on))
    newest = landed.orderBy(F.desc("year"), F.desc("month"), F.desc("day")).first()
    if newest is None:
        raise FileNotFoundError(f"no {table}_raw.{fmt} in {bronze} for {on or 'any date'}")
    return read_raw(spark, f"{newest['folder']}/{table}_raw.{fmt}", table, fmt)
