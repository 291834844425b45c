"""The data model: one message, the flat row, the archive row, the hot row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

TEXT, EPOCH = T.StringType(), T.LongType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Field names of the message contract. ``zip`` is text (leading
# zeros and non-US codes survive) and the epochs are 64-bit.
_USER = struct(
    gender=TEXT,
    name=struct(title=TEXT, first=TEXT, last=TEXT),
    location=struct(street=TEXT, city=TEXT, state=TEXT, zip=TEXT),
    email=TEXT, username=TEXT, password=TEXT, salt=TEXT, md5=TEXT, sha1=TEXT, sha256=TEXT,
    registered=EPOCH, dob=EPOCH, phone=TEXT, cell=TEXT, PPS=TEXT,
    picture=struct(large=TEXT, medium=TEXT, thumbnail=TEXT),
)
MESSAGE = struct(
    results=T.ArrayType(struct(user=_USER)),
    nationality=TEXT, seed=TEXT, version=TEXT,
    tran_detail=struct(tran_card_type=T.ArrayType(TEXT), product_id=TEXT, tran_amount=T.DoubleType()),
)

# The columns a topic source delivers. A file stand-in has the same shape.
TOPIC = struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=TEXT, partition=T.IntegerType(),
    offset=T.LongType(), timestamp=T.TimestampType(), timestampType=T.IntegerType(),
)

# Headers of a message; sources hand them out on request.
HEADERS = T.StructField("headers", T.ArrayType(struct(key=TEXT, value=T.BinaryType())))

# Where each flat column lives in an exploded message, in the
# order of the flat row.
FLAT_PATHS = {
    "gender": "user.gender",
    "title": "user.name.title",
    "first_name": "user.name.first",
    "last_name": "user.name.last",
    "street": "user.location.street",
    "city": "user.location.city",
    "state": "user.location.state",
    "zip": "user.location.zip",
    "email": "user.email",
    "user_id": "user.username",
    "password": "user.password",
    "salt": "user.salt",
    "md5": "user.md5",
    "sha1": "user.sha1",
    "sha256": "user.sha256",
    "registered": "user.registered",
    "dob": "user.dob",
    "phone": "user.phone",
    "cell": "user.cell",
    "PPS": "user.PPS",
    "large": "user.picture.large",
    "medium": "user.picture.medium",
    "thumbnail": "user.picture.thumbnail",
    "nationality": "nationality",
    "seed": "seed",
    "version": "version",
    "tran_card_type": "tran_detail.tran_card_type",
    "product_id": "tran_detail.product_id",
    "tran_amount": "tran_detail.tran_amount",
}

FLAT = tuple(FLAT_PATHS)
ARCHIVE = (*FLAT, "tran_date")

# The keyed table's columns, primary key first.
HOT = (
    "user_id", "first_name", "last_name", "gender", "city", "state", "zip", "email",
    "nationality", "tran_card_type", "tran_date", "product_id", "tran_amount",
)
HOT_KEY = "user_id"

# Derived columns and the flat column they are computed from.
DERIVED_FROM = {"tran_date": "registered", "tran_year": "registered"}


def _type_at(path: str) -> T.DataType:
    # "user" paths start inside the array of results.
    node: T.DataType = MESSAGE
    if path.startswith("user."):
        node = MESSAGE["results"].dataType.elementType
    for part in path.split("."):
        node = node[part].dataType
    return node


def _row(columns: Iterable[str]) -> T.StructType:
    derived = {"tran_date": T.StringType(), "tran_year": T.IntegerType(),
               "tran_card_type": T.StringType()}
    return T.StructType([
        T.StructField(c, derived.get(c) or _type_at(FLAT_PATHS[c])) for c in columns
    ])


ARCHIVE_ROW = _row(ARCHIVE)
HOT_ROW = _row(HOT)


def _keep(struct: T.StructType, paths: list[list[str]]) -> T.StructType:
    fields = []
    for field in struct.fields:
        below = [p[1:] for p in paths if p[0] == field.name]
        if not below:
            continue
        kind = field.dataType
        if [] not in below and isinstance(kind, T.StructType):
            kind = _keep(kind, below)
        elif [] not in below and isinstance(kind, T.ArrayType):
            kind = T.ArrayType(_keep(kind.elementType, below))
        fields.append(T.StructField(field.name, kind))
    return T.StructType(fields)


def message_schema(columns: Iterable[str] | None = None) -> T.StructType:
    """The part of MESSAGE that the given flat or derived columns need.

    Catalyst does not prune the schema of ``from_json`` once several fields are
    read, and JSON parsing is the dearest step of an aggregate job, so jobs name
    their columns. The users array always stays: it decides the row count.
    """
    if columns is None:
        return MESSAGE
    wanted = {DERIVED_FROM.get(c, c) for c in columns}
    paths = [FLAT_PATHS[c].split(".") for c in wanted]
    paths = [["results", *p] if p[0] == "user" else p for p in paths]
    if not any(p[0] == "results" for p in paths):
        # Any user leaf will do; gender is the first.
        paths.append(["results", "user", "gender"])
    return _keep(MESSAGE, paths)
