"""Draws, money and dates, against plain Python."""

import hashlib
import math
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillflow.functions import (
    date_text, draw_amount, draw_card, draw_suffix, exact_sum, year_of_epoch, year_of_text,
)
from tillflow.functions.draws import PRODUCT, USER
from tillflow.operators.enrich import enrich

few = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def slot(identity: str, number: int) -> int:
    return int(hashlib.md5(identity.encode()).hexdigest()[8 * number:8 * number + 8], 16)


@few
@given(st.lists(st.tuples(st.text(max_size=8), st.integers(0, 10**9)), min_size=1, max_size=40))
def test_draws_follow_the_identity(spark, pairs):
    rows = [(i, cents / 100) for i, cents in pairs]
    df = spark.createDataFrame(rows, "id STRING, amount DOUBLE").withColumn("d", F.md5(F.col("id").cast("binary")))
    cards = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    got = df.select("id", "amount", draw_card(F.col("d"), cards), draw_suffix(F.lit("u"), F.col("d"), USER, 1000),
                    draw_suffix(F.lit("p"), F.col("d"), PRODUCT, 100),
                    draw_amount(F.col("amount"), F.col("d"))).collect()
    for identity, amount, card, user, product, drawn in got:
        share = Decimal(slot(identity, 3) % 10000) / 10000
        assert card == "abc"[slot(identity, 0) % 3]
        assert user == f"u{slot(identity, 1) % 1001}"
        assert product == f"p{slot(identity, 2) % 101}"
        exact = (Decimal(str(amount)) * share).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert drawn == float(exact)


@few
@given(st.lists(st.one_of(st.none(), st.integers(-10**12, 10**12)), max_size=60))
def test_exact_sum_is_exact(spark, cents):
    rows = [(None if c is None else c / 100,) for c in cents]
    got = spark.createDataFrame(rows, "a DOUBLE").repartition(5).agg(exact_sum(F.col("a"))).first()[0]
    known = [c for c in cents if c is not None]
    assert got == (float(Decimal(sum(known)) / 100) if known else None)


def test_exact_sum_keeps_amounts_beyond_decimals(spark):
    def total(*amounts):
        df = spark.createDataFrame([(a,) for a in amounts], "a DOUBLE")
        return df.agg(exact_sum(F.col("a"))).first()[0]
    assert total(1e300, 1.5, None) == 1e300 + 1.5
    assert total(1e300, 1e300) == 2e300
    assert math.isnan(total(1.0, float("nan")))


@pytest.mark.parametrize("amount", [None, 1e300, float("inf"), float("nan"), -12.34])
def test_odd_amounts_do_not_fail(spark, amount):
    df = spark.createDataFrame([(amount,)], "a DOUBLE")
    got = df.select(draw_amount(F.col("a"), F.md5(F.lit(b"x")))).first()[0]
    assert (got is None) == (amount is None)


def test_missing_cards_and_names_give_null(spark):
    df = spark.sql("SELECT 'i' AS record_id, CAST(NULL AS STRING) AS user_id,"
                   " CAST(NULL AS ARRAY<STRING>) AS tran_card_type")
    assert tuple(enrich(df).first()) == ("i", None, None)
    assert tuple(enrich(df, mode="passthrough").first()) == ("i", None, None)
    with pytest.raises(ValueError):
        enrich(df, mode="other")


@few
@given(st.lists(st.integers(-62135596800, 253402300799), min_size=1, max_size=40))
def test_dates(spark, epochs):
    df = spark.createDataFrame([(e,) for e in epochs], "e BIGINT")
    e = F.col("e")
    for epoch, text, year, again in df.select("e", date_text(e), year_of_epoch(e), year_of_text(date_text(e))).collect():
        when = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=epoch)
        assert text == f"{when.year:04d}-{when:%m-%d %H:%M:%S}"
        assert year == again == when.year


def test_foreign_date_text_is_null(spark):
    df = spark.createDataFrame([("2011",), ("soon",), (None,)], "t STRING")
    assert [r[0] for r in df.select(year_of_text(F.col("t"))).collect()] == [None, None, None]


def test_small_amounts_are_rounded_once(spark):
    df = spark.createDataFrame([(4e-7,)] * 10 + [(0.1,)] * 3, "amount double")
    assert df.agg(exact_sum(F.col("amount"))).first()[0] == 0.300004
    assert df.agg(exact_sum(F.col("amount"), 1)).first()[0] == 0.3
