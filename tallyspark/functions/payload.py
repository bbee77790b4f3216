"""Reading the event payload (a JSON text column).

The reference reads each key with a separate text extraction and casts the
text at use. Here the payload is parsed once per row into a struct whose
fields are all strings: JSON booleans come out as ``'true'``/``'false'``,
numbers as their text and nested objects as their JSON text, which is what a
path-text extraction returns. A missing key, a JSON null and an unparsable
payload all give NULL. Key lookup is case-sensitive (``useJewel``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _string_struct(keys) -> T.StructType:
    return T.StructType([T.StructField(k, T.StringType(), True) for k in keys])


def json_fields(payload: Column | str, *keys: str) -> Column:
    """Parse ``payload`` once; returns a struct with one string field per key."""
    return F.from_json(_col(payload), _string_struct(keys))


def nested_fields(text: Column | str, *keys: str) -> Column:
    """Parse a nested object's text (``myinfo``/``opinfo``) the same way.

    Works whether the nested value was an object or a JSON-encoded string
    holding one: both arrive here as the object's JSON text."""
    return F.from_json(_col(text), _string_struct(keys))


def json_text(payload: Column | str, key: str) -> Column:
    """Single top-level key as text, for one-off use."""
    return F.get_json_object(_col(payload), f"$.{key}")


def int2(text: Column | str) -> Column:
    """``::int2`` that yields NULL for text that is not a smallint."""
    return _col(text).try_cast("smallint")


def int4(text: Column | str) -> Column:
    """``::integer`` that yields NULL for text that is not an int."""
    return _col(text).try_cast("int")
