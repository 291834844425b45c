"""Raw topic rows to one flat row per user."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schema import FLAT, FLAT_PATHS, message_schema

CORRUPT = "_corrupt_record"

# Where a message came from; carried next to every row derived from it.
ORIGIN = ("topic", "partition", "offset", "ingest_ts", "message_id")

# The default transaction details of an incomplete message.
DEFAULT_CARDS = ("Visa", "MasterCard", "Maestro")
DEFAULT_AMOUNT = 150.5
DEFAULT_PRODUCT = "PID-001"


# The header that carries a message's identity onto the topic it is published to.
ID_HEADER = "message_id"


def identity(raw: DataFrame) -> Column:
    """What a topic row is known by: the header it was published with, if the source hands
    out headers and it has one; else its position; else the digest of its payload."""
    at = F.concat_ws(":", "topic", "partition", "offset")
    own = F.when(F.col("offset").isNotNull(), at).otherwise(F.md5(F.col("value").cast("binary")))
    if "headers" not in raw.columns:
        return own
    given = F.get(F.filter("headers", lambda h: h["key"] == ID_HEADER), F.lit(0))
    return F.coalesce(given["value"].cast("string"), own)


def decode(raw: DataFrame) -> DataFrame:
    """Payload as text, with the message's key, origin and identity.

    The identity is the source position. A source without positions (plain
    files) identifies a message by the digest of its payload.
    """
    return raw.select(
        "key", "topic", "partition", "offset",
        F.col("timestamp").alias("ingest_ts"),
        identity(raw).alias("message_id"),
        F.col("value").cast("string").alias("value"),
    )


def parse(decoded: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Adds ``message``, the payload read with the fixed schema (PERMISSIVE).

    Without ``columns`` the whole schema is read and mistyped or broken payloads
    are marked in ``message._corrupt_record``; with them only the fields behind
    those flat columns are.
    """
    schema = message_schema(columns)
    if columns is None:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return decoded.withColumn(
        "message", F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT}))


def expand(parsed: DataFrame) -> DataFrame:
    """The message's own fields as columns."""
    return parsed.select(*ORIGIN, "value", "message.*")


def fill_defaults(expanded: DataFrame) -> DataFrame:
    """Default transaction details, leaf by leaf, where they are missing."""
    detail = F.col("tran_detail")
    defaults = {
        "tran_card_type": F.array(*map(F.lit, DEFAULT_CARDS)),
        "product_id": F.lit(DEFAULT_PRODUCT),
        "tran_amount": F.lit(DEFAULT_AMOUNT),
    }
    # A narrow parse may have left some of the leaves out.
    parsed = expanded.schema["tran_detail"].dataType.names
    return expanded.withColumn("tran_detail", F.struct(*(
        F.coalesce(detail[leaf], value).alias(leaf)
        for leaf, value in defaults.items() if leaf in parsed)))


def with_reject_reason(expanded: DataFrame) -> DataFrame:
    """Why a message is unfit: it yields no row, or lost a mistyped field.

    Needs the whole schema (see ``parse``). NULL for a clean message.
    """
    broken = F.col(CORRUPT).isNotNull()
    return expanded.withColumn(
        "reject_reason",
        F.when(F.col("value").isNull(), "null payload")
         .when(broken & F.col("results").isNull(), "malformed")
         .when(F.col("results").isNull(), "no results")
         .when(F.size("results") == 0, "empty results")
         .when(broken, "mistyped field"))


def explode_users_outer(expanded: DataFrame) -> DataFrame:
    """One row per user, and one with NULL ``pos`` for a message without users.

    Outer on purpose, also below the inner form: an inner generator makes
    Catalyst infer a ``size(...) > 0`` filter and push it under the parse, which
    then runs twice per message.
    """
    kept = [c for c in expanded.columns if c not in ("results", CORRUPT)]
    return expanded.select(*kept, F.posexplode_outer("results.user").alias("pos", "user"))


def explode_users(expanded: DataFrame) -> DataFrame:
    """One row per user; a NULL user is a row, a message without users is none."""
    return explode_users_outer(expanded).where(F.col("pos").isNotNull())


def flatten(exploded: DataFrame, columns: Iterable[str] = FLAT, also: Iterable[str] = ()) -> DataFrame:
    """Nested fields as flat columns; ``record_id`` is message identity and position."""
    return exploded.select(
        *also,
        "ingest_ts", "partition", "offset", "pos",
        F.concat_ws(":", "message_id", "pos").alias("record_id"),
        *(F.col(FLAT_PATHS[c]).alias(c) for c in columns),
    )
