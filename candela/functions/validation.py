"""Raw tick validation as column expressions over a VARIANT parse.

The message contract: a JSON object; required keys symbol, price, volume,
event_time, source; each known key, when present, of JSON type string or
number; extra keys allowed. The JSON type is read from the VARIANT itself —
a typed extraction would coerce ``true`` or ``"1.5"`` into a number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from candela.schema import FIELD_JSON_TYPES, REQUIRED_FIELDS

_NUMBER_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")


def _is_class(schema: Column, want: str) -> Column:
    """Whether a VARIANT value with this ``schema_of_variant`` is a JSON string or number."""
    if want == "number":
        return schema.isin(*_NUMBER_TYPES) | schema.startswith("DECIMAL")
    return schema == want.upper()


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` computed once a row, however often ``of`` names it."""
    return F.element_at(F.transform(F.array(value), of), 1)


def _field_errors(v: Column, key: str, want: str) -> Column:
    def judged(schema: Column) -> Column:
        # The schema is SQL NULL when the key is absent (a JSON null is VOID).
        missing = F.lit(f"missing:{key}") if key in REQUIRED_FIELDS else F.lit(None).cast("string")
        return F.when(schema.isNull(), missing).when(~_is_class(schema, want), F.lit(f"type:{key}"))

    return _bound(F.schema_of_variant(F.variant_get(v, f"$.{key}", "variant")), judged)


def tick_errors(json_text: Column) -> Column:
    """array<string> of violations: not_json, not_object, missing:<key>, type:<key>.

    The payload is parsed once and each field's type read once: an expression
    named twice is otherwise computed twice, which here means a parse a field
    and JSON type. A filter on the result still computes it again, so rows are
    judged through ``ingest.validate``.
    """

    def errors(v: Column) -> Column:
        fields = F.array_compact(F.array(*[_field_errors(v, key, want) for key, want in FIELD_JSON_TYPES.items()]))
        return (
            F.when(v.isNull(), F.array(F.lit("not_json")))
            .when(~F.schema_of_variant(v).startswith("OBJECT"), F.array(F.lit("not_object")))
            .otherwise(fields)
        )

    return _bound(F.try_parse_json(json_text), errors)
