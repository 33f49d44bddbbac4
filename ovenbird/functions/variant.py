"""Semi-structured helpers: object construction and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def object_of(**fields: Column) -> Column:
    """``OBJECT_CONSTRUCT(k1, v1, ...)`` as a VARIANT.  Keys whose value is NULL
    are dropped (``to_json`` omits NULL fields), matching the source dialect."""
    return F.parse_json(F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])))


def json_text(v) -> Column:
    """Canonical JSON text of a VARIANT (keys sorted, numbers normalised)."""
    c = F.col(v) if isinstance(v, str) else v
    return F.to_json(c)
