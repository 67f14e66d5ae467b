"""JSON responses as VARIANT: parse, index, flatten, cast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_field(doc: Column, path: str, kind: str) -> Column:
    """`doc` (VARIANT) at `path`, cast to `kind`; a missing path gives NULL."""
    return F.variant_get(doc, path, kind)


def flatten_json(
    df: DataFrame, json_col: str, array_path: str, fields: Mapping[str, str], keep: list[str]
) -> DataFrame:
    """One row per element of the array at `array_path`, with typed `fields` of the element.

    `fields` maps an output column to its SQL type. `keep` columns are carried along and
    the element's position is returned as `pos`.
    """
    array = F.variant_get(F.parse_json(F.col(json_col)), array_path, "variant")
    elements = df.select(*keep, array.alias("_array")).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("_array").outer())
    )
    typed = [
        F.variant_get(F.col("value"), f"$.{name}", kind).alias(name) for name, kind in fields.items()
    ]
    return elements.select(*keep, F.col("pos"), *typed)
