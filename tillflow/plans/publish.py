"""Messages to a topic: the preparing end of the flow.

A message is completed as text: what is missing is put in, every other byte stays.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.operators.messages import DEFAULT_AMOUNT, DEFAULT_CARDS, DEFAULT_PRODUCT, ID_HEADER

# Fixed value: the field that holds the transaction's details.
DETAIL = "tran_detail"
_DEFAULTS = {leaf: json.dumps(value, separators=(",", ":")) for leaf, value in {
    "tran_card_type": list(DEFAULT_CARDS), "product_id": DEFAULT_PRODUCT, "tran_amount": DEFAULT_AMOUNT}.items()}
_ALL = "{" + ",".join(f'"{leaf}":{text}' for leaf, text in _DEFAULTS.items()) + "}"


def payload(rows: DataFrame, columns: Iterable[str] | None = None, key: Column | None = None) -> DataFrame:
    """``value`` (and ``key``) of a topic record: the row as one JSON object."""
    value = F.to_json(F.struct(*(columns or rows.columns))).alias("value")
    return rows.select(value) if key is None else rows.select(key.alias("key"), value)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _at(value: Column, path: str) -> Column:
    """What stands at a path of a parsed message; NULL if nothing does."""
    return F.try_variant_get(value, path, "variant")


def _size(value: Column) -> Column:
    """The number of fields of an object; NULL for anything else."""
    return F.cardinality(value.try_cast("map<string, variant>"))


def _patched(text: Column, pattern: str, new: Callable[[Column], Column], holds: Callable[[Column], Column]) -> Column:
    """The text with ``new`` of a match of the pattern in place of that match: the first one
    after which ``holds`` is true of the detail; NULL without any. What looks like the field
    may stand in a string or in another object, and only the parsed result tells which one
    is the field."""
    def tries(found: Column) -> Column:
        matches, around = found["matches"], found["around"]

        def one(i: Column) -> Column:
            parts = F.array_append(F.transform(matches, lambda m, j: F.when(j == i, new(m)).otherwise(m)), F.lit(""))
            return F.array_join(F.zip_with(around, parts, lambda x, y: F.concat(x, y)), "")
        return F.when(F.size(matches) > 0, F.transform(F.sequence(F.lit(0), F.size(matches) - 1), one))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("around"))
    fits = F.filter(_let(found, tries), lambda x: _let(_at(F.try_parse_json(x), f"$.{DETAIL}"), holds))
    return F.get(fits, F.lit(0))


def _every_leaf(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    def holds(detail: Column) -> Column:
        tests = (F.coalesce(test(_at(detail, f"$.{leaf}")), F.lit(False)) for leaf in _DEFAULTS)
        return reduce(Column.__and__, tests)
    return holds


def _in_place_of_null(default: str) -> Callable[[Column], Column]:
    return lambda match: F.replace(match, F.lit("null"), F.lit(default))


_FIELD = rf'"{DETAIL}"\s*:\s*'


def _with_detail(text: Column, fields: Column, detail: Column) -> Column:
    """The message with a whole detail, where it has none or a null."""
    last = F.concat(F.when(fields > 0, ",").otherwise(""), F.lit(f'"{DETAIL}":{_ALL}}}$1'))
    return (F.when(detail.isNull(), F.regexp_replace(text, F.lit(r"\}(\s*)\z"), last))
            .otherwise(_patched(text, _FIELD + "null", _in_place_of_null(_ALL), _every_leaf(Column.isNotNull))))


def _with_absent_leaves(text: Column, detail: Column) -> Column:
    """The leaves that the detail, an object, lacks, at once, behind its brace."""
    def put(absent: Column) -> Column:
        fields = F.concat(F.array_join(absent, ","), F.when(_size(detail) > 0, ",").otherwise(""))
        return F.when(F.size(absent) > 0, _patched(
            text, _FIELD + r"\{", lambda m: F.concat(m, fields), _every_leaf(Column.isNotNull))).otherwise(text)
    return _let(F.array_compact(F.array(*(F.when(_at(detail, f"$.{leaf}").isNull(), f'"{leaf}":{default}')
                                          for leaf, default in _DEFAULTS.items()))), put)


def _with_leaf(leaf: str, default: str, detail: Column) -> Callable[[Column], Column]:
    """A leaf that is null in the message's own detail; no other step touches it."""
    null = lambda detail: F.coalesce(F.is_variant_null(_at(detail, f"$.{leaf}")), F.lit(False))
    return lambda text: F.when(null(detail), _patched(
        text, rf'"{leaf}"\s*:\s*null', _in_place_of_null(default), lambda now: ~null(now) & _at(now, f"$.{leaf}").isNotNull())).otherwise(text)


def _complete(text: Column, fields: Column, detail: Column) -> Column:
    """The text of a message of so many fields that holds this detail, with all that it
    lacks put in; NULL if that is not possible. Only what is put in is parsed again."""
    leaves = reduce(_let, [_with_leaf(*item, detail) for item in _DEFAULTS.items()], _with_absent_leaves(text, detail))
    return (F.when(detail.isNull() | F.is_variant_null(detail), _with_detail(text, fields, detail))
            .when(_size(detail).isNotNull(), leaves).otherwise(text))


def _outcome(value: Column) -> Column:
    """``completed`` and ``reject_reason`` of a payload."""
    def of(message: Column) -> Column:
        def reason(text: Column, fields: Column) -> Column:
            return (F.when(value.isNull(), "null payload").when(message.isNull(), "malformed")
                    .when(fields.isNull(), "no object").when(text.isNull(), "escaped name"))

        def with_text(fields: Column) -> Column:
            text = F.when(fields.isNotNull(), _let(_at(message, f"$.{DETAIL}"), lambda detail: _complete(value, fields, detail)))
            return _let(text, lambda text: F.struct(text.alias("completed"), reason(text, fields).alias("reject_reason")))
        return _let(_size(message), with_text)
    return _let(F.try_parse_json(value), of)


def completed(decoded: DataFrame) -> DataFrame:
    """Decoded messages with ``completed``, the payload with default transaction
    details, and ``reject_reason`` where it cannot be completed.

    A leaf that is missing or null gets its default, a missing or null detail all of them.
    Only that text is put in: at the end of the message, at the beginning of the detail,
    or in place of the null. Numbers of any size, white space, escapes, the order of fields
    and fields of any name keep their bytes; a message that lacks nothing is untouched, as
    is one whose detail is itself no object. What is no JSON object, or has a key twice, is
    refused, and so is a message whose gap would have to be found under an escaped name.
    """
    # Exploded, so that it is worked out once a message: a filter on a computed column is
    # moved below it and takes a copy of the computation along. Outer, or Catalyst infers
    # such a filter by itself.
    outcome = F.explode_outer(F.array(_outcome(F.col("value")))).alias("__outcome")
    return decoded.select("*", outcome).select("*", "__outcome.*").drop("__outcome")


def completed_messages(decoded: DataFrame) -> DataFrame:
    """``key``, ``value`` and ``headers`` of every message that could be completed, ready to
    publish. The key is the message's own: it decides the partition, and so the order, that
    it keeps. A header carries its identity: publishing is at least once, and readers tell
    doubles by it (``sources.topics.once``)."""
    header = F.struct(F.lit(ID_HEADER).alias("key"), F.col("message_id").cast("binary").alias("value"))
    return completed(decoded).where(F.col("reject_reason").isNull()).select(
        "key", F.col("completed").alias("value"), F.array(header).alias("headers"))


def refused_messages(decoded: DataFrame) -> DataFrame:
    """The other ones, in the form of the quarantine."""
    return completed(decoded).where(F.col("reject_reason").isNotNull()).select(
        "message_id", "ingest_ts", "reject_reason", "value")


def kafka_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    """Options of the ``kafka`` format for ``write`` and ``writeStream``."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **options}
