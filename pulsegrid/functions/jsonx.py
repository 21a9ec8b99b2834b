"""JSON decoding rules of the message formats, as Column expressions over VARIANT.

A JSON text decodes like a typed record of the original services when:
  * it is exactly one JSON value (no trailing data) and that value is an object (or ``null``: all fields zero),
  * every known field has an acceptable JSON type: strings for ids, a plain integer for integer fields (``78.0``,
    ``1e2`` and ``"78"`` are rejected), a number for float fields, an RFC 3339 string for timestamps;
    ``null`` or an absent field leaves the zero value.
Unknown fields are ignored (lenient) or rejected (strict). Field names match exactly (the original matched
them case-insensitively; documented difference).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: formats -------------------------------------------------------------------
RFC3339_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
UTC_SUFFIX_PATTERN = r"(Z|[+-]00:00)$"
ZERO_TIME_MICROS = -62135596800000000  # 0001-01-01T00:00:00Z
NULL_KINDS = ("VOID",)
STRING_KINDS = ("STRING", "VOID")
INT_KINDS = ("BIGINT", "VOID")


def parse_single(text: Column) -> tuple[Column, Column]:
    """(value, is_single) with two parses instead of three: the value is read out of the ``{"v": ...}`` wrap
    (which also rejects a trailing ``}``-closed tail), the ``[...]`` wrap rejects a trailing ``]``-closed one."""
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    arr = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    single = F.coalesce((arr == 1) & wrapped.isNotNull(), F.lit(False))
    return F.try_variant_get(wrapped, "$.v", "variant"), single


def kind_in(k: Column, allowed: tuple[str, ...]) -> Column:
    """Absent (NULL kind) or one of ``allowed``."""
    return k.isNull() | k.isin(*allowed)


def number_kind(k: Column) -> Column:
    return kind_in(k, ("BIGINT", "DOUBLE", "FLOAT", "VOID")) | k.startswith("DECIMAL")


def rfc3339_text_ok(text: Column) -> Column:
    return F.coalesce(text.rlike(RFC3339_PATTERN), F.lit(False)) & F.try_to_timestamp(text).isNotNull()


def kind(v: Column, path: str) -> Column:
    """JSON type of a field: 'STRING', 'BIGINT', 'VOID' (null), 'OBJECT<...>', ...; NULL when absent."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def is_object_or_null(v: Column) -> Column:
    k = F.schema_of_variant(v)
    return k.startswith("OBJECT") | (k == F.lit("VOID"))


def string_field(v: Column, path: str) -> Column:
    """Value of a string field; absent or null gives '' (the zero value)."""
    return F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))


def timestamp_text(v: Column, path: str) -> Column:
    k = kind(v, path)
    return F.when(k == "STRING", F.try_variant_get(v, path, "string"))


def parse_timestamp(text: Column) -> Column:
    """Instant of an RFC 3339 text (offset applied); NULL for NULL."""
    return F.try_to_timestamp(text)


def is_utc_text(text: Column) -> Column:
    return text.rlike(UTC_SUFFIX_PATTERN)


def is_zero_time(ts: Column) -> Column:
    return ts.isNull() | (F.unix_micros(ts) == F.lit(ZERO_TIME_MICROS))


def keys_within(obj_json: Column, allowed: list[str]) -> Column:
    """Every key of a JSON object text is in ``allowed`` (strict decoding)."""
    extra = F.array_except(F.json_object_keys(obj_json), F.array(*[F.lit(a) for a in allowed]))
    return F.coalesce(F.size(extra) == 0, F.lit(True))
