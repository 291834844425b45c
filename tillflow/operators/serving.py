"""Read models over the aggregate collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.totals import COLLECTIONS

# Fixed value: how many documents the dashboard reads.
DASHBOARD_DOCUMENTS = 100


def latest_totals(snapshots: DataFrame, collection: str) -> DataFrame:
    """The current total of every key: its value in the last batch that changed it."""
    keys, value = COLLECTIONS[collection]
    return snapshots.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


def last_documents(snapshots: DataFrame, collection: str, n: int = DASHBOARD_DOCUMENTS) -> DataFrame:
    """The n newest snapshot documents, newest batch first, then by key."""
    keys, _ = COLLECTIONS[collection]
    return snapshots.orderBy(F.desc("batch_id"), *keys).limit(n)


def dashboard_rollup(snapshots: DataFrame, collection: str, n: int = DASHBOARD_DOCUMENTS) -> DataFrame:
    """What the dashboard shows: the values of the newest documents, summed.

    Kept for parity. Snapshots are running totals, so this counts a sale once
    per snapshot; ``latest_totals`` is the true figure.
    """
    keys, value = COLLECTIONS[collection]
    known = [F.col(k).isNotNull() for k in keys]
    newest = last_documents(snapshots, collection, n)
    for condition in known:
        newest = newest.where(condition)
    return newest.groupBy(*keys).agg(F.sum(value).alias(value))


def sample_documents(snapshots: DataFrame, collection: str, n: int) -> DataFrame:
    """The first n documents, oldest batch first, then by key."""
    keys, _ = COLLECTIONS[collection]
    return snapshots.orderBy("batch_id", *keys).limit(n)


def count_documents(snapshots: DataFrame) -> DataFrame:
    return snapshots.agg(F.count(F.lit(1)).alias("documents"))


def display_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order."""
    return df.select(*sorted(df.columns))


def as_records(df: DataFrame) -> DataFrame:
    """One JSON record per row, NULLs written out."""
    ordered = display_columns(df)
    return ordered.select(
        F.to_json(F.struct(*ordered.columns), {"ignoreNullFields": "false"}).alias("record"))
