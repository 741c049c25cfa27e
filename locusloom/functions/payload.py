"""State payloads kept as JSON text: shape, fields of changing types, and the fields there are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_kind(value: Column) -> Column:
    """``object``, ``array``, ``text``, ``number``, ``boolean`` or ``null`` of a VARIANT; NULL without one."""
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    named = {"OBJECT": "object", "ARRAY": "array", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null"}
    out = F.when(kind.isNull(), F.lit(None).cast("string"))
    for name, text in named.items():
        out = out.when(kind == name, text)
    return out.otherwise("number")


def with_state(df: DataFrame, payload: str, fields: Mapping[str, tuple[str, str]], state: str = "state") -> DataFrame:
    """Add what can be read of a payload column and typed fields of it.

    ``fields`` maps a new column to its path (``$.sample.name``) and type. ``state`` is ``object``,
    ``shape`` (JSON, but no object), ``broken`` (no JSON, or an object that names a field twice) or NULL without a
    payload. A field is NULL when its payload is no object, when it is absent and when it doesn't
    fit its type, so payloads of different writers go through one query. The text is parsed once
    per row in the JVM. ``df`` must not have a column ``_variant``.
    """
    parsed = df.withColumn("_variant", F.try_parse_json(payload))
    broken = F.when(F.col(payload).isNotNull() & F.col("_variant").isNull(), "broken")
    shape = F.when(value_kind(F.col("_variant")) == "object", "object").when(F.col("_variant").isNotNull(), "shape")
    whole = F.when(shape == "object", F.col("_variant"))
    read = {name: F.try_variant_get(whole, path, kind) for name, (path, kind) in fields.items()}
    return parsed.withColumns({state: F.coalesce(broken, shape), **read}).drop("_variant")


def payload_fields(df: DataFrame, payload: str) -> DataFrame:
    """Top-level fields of all object payloads: ``(field, kind, n)``, counted inside the tasks first.

    Payloads that are broken or no objects have no fields; ``with_state`` tells them.
    """
    parsed = df.select(F.try_parse_json(payload).alias("_variant")).filter(value_kind(F.col("_variant")) == "object")
    items = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_variant").outer()))
    return items.groupBy(F.col("key").alias("field"), value_kind(F.col("value")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n")
    )
