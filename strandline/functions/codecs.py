"""Models as JSON texts: decoding with a check of the required fields, and encoding without nulls."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline import schemas
from strandline.functions.scalars import iso_time, parse_time


def _wire(kind: T.DataType) -> T.DataType:
    """The type of a value in JSON: times are texts."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _wire(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_wire(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _wire(kind.valueType))
    return T.StringType() if isinstance(kind, T.TimestampType) else kind


def _timed(value: Column, kind: T.DataType, change: Callable[[Column], Column]) -> Column:
    """The value with ``change`` applied to every time in it, at any depth."""
    if kind == _wire(kind):
        return value
    if isinstance(kind, T.StructType):
        made = F.struct(*(_timed(value[f.name], f.dataType, change).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), made)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _timed(x, kind.elementType, change))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _timed(x, kind.valueType, change))
    return change(value)


class Codec:
    """Encoding and decoding of one model, given as DDL."""

    def __init__(self, ddl: str, required: Iterable[str] = ()):
        self.schema = T.StructType.fromDDL(ddl)
        self.required = tuple(required)

    def decode(self, json: Column) -> Column:
        """A struct; null where the text is no JSON object, lacks a required field or has one of another type. Null and missing are the same; a field that isn't required and doesn't fit is null."""
        raw = F.from_json(json, _wire(self.schema), {"mode": "PERMISSIVE"})
        value = _timed(raw, self.schema, parse_time)
        whole = F.coalesce(F.json_object_keys(json).isNotNull(), F.lit(False))
        for name in self.required:
            whole &= value[name].isNotNull()
        return F.when(whole, value)

    def error(self, json: Column) -> Column:
        """'invalid-argument' where ``decode`` gives null."""
        return F.when(self.decode(json).isNull(), "invalid-argument")

    def encode(self, value: Column) -> Column:
        """JSON without null fields; times as ISO texts in milliseconds."""
        return F.to_json(_timed(value, self.schema, iso_time))


#: A codec for each model of ``schemas``, with what a row can't be without.
MODELS = {
    "user": Codec(schemas.USERS, ["dateOfEnrollment"]),
    "observation": Codec(schemas.OBSERVATIONS, ["status", "code"]),
    "backlog": Codec(schemas.BACKLOG, ["title", "body", "timestamp"]),
    "history": Codec(schemas.HISTORY, ["title", "body", "originalTimestamp"]),
    "pending_deletion": Codec(schemas.PENDING_DELETIONS, ["userId", "collection", "documentId", "retryCount", "nextRetryAt"]),
    "waitlist": Codec(schemas.WAITLIST, ["region", "email"]),
    "device": Codec(schemas.DEVICES, ["notificationToken", "platform"]),
    "message": Codec(schemas.MESSAGES, ["creationDate", "type", "title", "isDismissible"]),
    "auth_user": Codec(schemas.AUTH_USERS),
}
