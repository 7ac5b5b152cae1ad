"""Run a registered query and its SQL counterpart and compare them as sets of rows."""

import datetime
from pathlib import Path

import duckdb
import pandas as pd

def oracle_frame(statement, sf_dir):
    with duckdb.connect() as con:
        for path in sorted(Path(sf_dir).glob("*.parquet")):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
        return con.execute(statement).fetchdf()


def _kind(dtype):
    return "datetime" if dtype.kind == "M" else str(dtype)


def _dates_as_datetimes(frame):
    for column in frame.columns:
        if len(frame) and type(frame[column].iloc[0]) is datetime.date:
            frame[column] = pd.to_datetime(frame[column])
    return frame


def _sorted_rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(None if v != v else v for v in row) for row in frame.itertuples(index=False)), key=repr)


def differences(spark_df, statement, sf_dir):
    """Empty when column names, types and rows agree; else a short description."""
    ours, theirs = _dates_as_datetimes(spark_df.toPandas()), oracle_frame(statement, sf_dir)
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    kinds = {c: (_kind(ours[c].dtype), _kind(theirs[c].dtype)) for c in ours.columns}
    kinds = {c: pair for c, pair in kinds.items() if len(set(pair)) > 1}
    left, right = _sorted_rows(ours), _sorted_rows(theirs)
    problems = [f"types {kinds}"] if kinds else []
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    elif left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b]
        problems.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return "; ".join(problems)
