"""Transaction fields and dates on flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import date_text, draw_amount, draw_card, draw_suffix, year_of_epoch
from tillflow.functions.draws import PRODUCT, USER
from tillflow.schema import HOT

# Largest number appended to a user name and to a product.
USER_SUFFIX = 1000
PRODUCT_SUFFIX = 100


def enrich(flat: DataFrame, identity: str = "record_id", mode: str = "draw") -> DataFrame:
    """Card, user, product and amount of a transaction.

    ``draw`` derives them from the record's identity; ``passthrough`` keeps what
    the message says (the first card of its list). Columns a narrow job did not
    ask for are left out.
    """
    if mode not in ("draw", "passthrough"):
        raise ValueError(f"unknown enrichment mode: {mode}")
    if mode == "passthrough":
        new = {"tran_card_type": F.get("tran_card_type", F.lit(0))}
    else:
        flat = flat.withColumn("_digest", F.md5(F.col(identity).cast("string").cast("binary")))
        digest = F.col("_digest")
        new = {
            "user_id": draw_suffix(F.col("user_id"), digest, USER, USER_SUFFIX),
            "tran_card_type": draw_card(digest, F.col("tran_card_type")),
            "product_id": draw_suffix(F.col("product_id"), digest, PRODUCT, PRODUCT_SUFFIX),
            "tran_amount": draw_amount(F.col("tran_amount"), digest),
        }
    present = {name: value for name, value in new.items() if name in flat.columns}
    return flat.withColumns(present).drop("_digest")


def with_dates(rows: DataFrame) -> DataFrame:
    """``tran_date`` text and ``tran_year`` of the registration time."""
    return rows.withColumns({
        "tran_date": date_text(F.col("registered")),
        "tran_year": year_of_epoch(F.col("registered")),
    })


def hot_rows(rows: DataFrame) -> DataFrame:
    return rows.select(*HOT)
