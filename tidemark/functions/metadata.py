"""Free key-value metadata kept as a VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_metadata(text: Column) -> Column:
    """Metadata JSON to ``map<string,variant>`` of scalars.

    Nulls are dropped, nested values become their JSON text, and anything but
    an object gives an empty map.
    """
    fields = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    kept = F.map_filter(fields, lambda _, v: ~F.is_variant_null(v))

    def scalar(_: Column, v: Column) -> Column:
        nested = F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)<")
        return F.when(nested, F.to_json(v).cast("variant")).otherwise(v)

    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    return F.coalesce(F.transform_values(kept, scalar), empty)


def metadata_document(text: Column) -> Column:
    """Clean metadata back as one VARIANT."""
    return F.parse_json(F.to_json(clean_metadata(text)))
