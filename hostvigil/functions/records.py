"""JSON encoding and decoding of topic records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hostvigil.schemas import METRICS

# All fields are decoded as text: numbers may come quoted, and not-a-number must become null.
_RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("ts", "server_id", *METRICS)]
)
_ENVELOPE = T.StructType(
    [T.StructField("record", _RECORD), T.StructField("_corrupt", T.StringType())]
)


def encode_record(*columns: str) -> Column:
    """The named columns as one UTF-8 JSON object, nulls included."""
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return text.cast("binary")


def parse_value(text: Column) -> Column:
    """A record's JSON text as a struct of text fields ``record``, ``_corrupt`` set if malformed.

    The parser stops at the end of a value, so the text is read as a field's value: anything
    after it then breaks the object around it.
    """
    return F.from_json(
        F.concat(F.lit('{"record":'), text, F.lit("}")), _ENVELOPE,
        {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"},
    )


def may_hold_more(text: Column) -> Column:
    """Whether anything follows a closing brace; true for some single objects as well."""
    return text.rlike(r"\}[ \t\r\n]*[^ \t\r\n]")


def one_value(text: Column) -> Column:
    """Whether the text is one JSON value: a comma could have slipped in fields of the object."""
    values = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(T.StringType()),
        {"allowSingleQuotes": "false"},
    )
    return F.coalesce(F.size(values) == 1, F.lit(False))
