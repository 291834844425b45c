"""The five aggregate collections.

Keys are few (years, countries, cards), so map-side partial aggregation leaves
one row per key and task to shuffle, and a hot key costs no more than another.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import exact_sum

# Collection names, with their key columns and value column.
COLLECTIONS = {
    "year_wise_total_sales_count": (("tran_year",), "tran_year_count"),
    "country_wise_total_sales_count": (("nationality",), "tran_country_count"),
    "card_type_wise_total_sales_count": (("tran_card_type",), "tran_card_type_count"),
    "card_type_wise_total_sales": (("tran_card_type",), "tran_card_type_total_sales"),
    "year_country_wise_total_sales": (("tran_year", "nationality"), "tran_year_country_total_sales"),
}

# Where a pipeline keeps all collections together.
SHARED = "collections"

KEYS = ("tran_year", "nationality", "tran_card_type")

# Counts are of non-null values of one column, so a NULL country or card counts
# 0, while a NULL year counts its amounts.
_VALUES = {
    "tran_year_count": lambda: F.count("tran_amount"),
    "tran_country_count": lambda: F.count("nationality"),
    "tran_card_type_count": lambda: F.count("tran_card_type"),
    "tran_card_type_total_sales": lambda: exact_sum(F.col("tran_amount")),
    "tran_year_country_total_sales": lambda: exact_sum(F.col("tran_amount")),
}


def needed(collections: Iterable[str] = COLLECTIONS) -> tuple[str, ...]:
    """The columns that the collections are made from."""
    columns = []
    for keys, value in (COLLECTIONS[c] for c in collections):
        # A count of the key itself reads nothing else.
        columns += [*keys] if value in ("tran_country_count", "tran_card_type_count") else [*keys, "tran_amount"]
    return tuple(dict.fromkeys(columns))


def total(rows: DataFrame, collection: str) -> DataFrame:
    """One collection as a grouped aggregate (running totals on a stream)."""
    keys, value = COLLECTIONS[collection]
    return rows.groupBy(*keys).agg(_VALUES[value]().alias(value))


def all_totals(rows: DataFrame) -> DataFrame:
    """All collections in one pass: one source read, one parse, one shuffle and,
    on a stream, one state store. ``pick`` takes a collection out again."""
    key_sets = list(dict.fromkeys(keys for keys, _ in COLLECTIONS.values()))
    return (
        rows.groupingSets([[F.col(k) for k in keys] for keys in key_sets], *map(F.col, KEYS))
        .agg(
            F.grouping_id().alias("key_set"),
            *(_VALUES[v]().alias(v) for v in
              ("tran_year_count", "tran_country_count", "tran_card_type_count")),
            exact_sum(F.col("tran_amount")).alias("total_sales"),
        )
    )


def _absent(keys: Iterable[str]) -> int:
    """The grouping id of a key set: a bit per key, first key highest, set where it is absent."""
    return sum(1 << bit for bit, k in enumerate(reversed(KEYS)) if k not in keys)


def pick(totals: DataFrame, collection: str) -> DataFrame:
    """One collection out of ``all_totals``."""
    keys, value = COLLECTIONS[collection]
    source = value if value.endswith("_count") else "total_sales"
    return totals.where(F.col("key_set") == _absent(keys)).select(*keys, F.col(source).alias(value))


def named(totals: DataFrame) -> DataFrame:
    """All collections of ``all_totals`` in one frame: keys, ``count_value`` or
    ``sum_value``, and the ``collection``. One pass; a key set that two collections
    share gives two rows."""
    def document(name: str):
        keys, value = COLLECTIONS[name]
        counts = value.endswith("_count")
        return F.when(F.col("key_set") == _absent(keys), F.struct(
            (F.col(value) if counts else F.lit(None)).cast("long").alias("count_value"),
            (F.lit(None) if counts else F.col("total_sales")).cast("double").alias("sum_value"),
            F.lit(name).alias("collection")))

    documents = F.array_compact(F.array(*map(document, COLLECTIONS)))
    return totals.select(*KEYS, F.explode(documents).alias("d")).select(*KEYS, "d.*")
