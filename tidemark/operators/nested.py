"""Records with nested fields: widen, flatten, explode, split, serialise.

All of these work inside one row; none needs a shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.names import exactly, quoted


def widen_records(df: DataFrame, record: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One column per field of a record; lists and records inside stay whole.

    ``record`` is a struct, or JSON text with its ``schema``. Without a schema
    the fields are those found in any of the texts, by one pass over them.
    """
    field = F.col(record)
    if isinstance(df.schema[record].dataType, T.StringType):
        field = F.from_json(field, schema or infer_fields(df, record))
    kept = [c for c in df.columns if c != record]
    return df.select(*kept, field.alias("_record")).select(*kept, "_record.*")


def infer_fields(df: DataFrame, record: str) -> T.StructType:
    """Fields of the JSON texts in a column; fields of mixed types are text."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(record))).first()[0]
    # The function writes variant types; these are their column types.
    for variant, column in (("OBJECT", "STRUCT"), ("VOID", "STRING"), ("VARIANT", "STRING")):
        found = re.sub(rf"(^|<|: ){variant}(?=[<>,]|$)", rf"\1{column}", found)
    fields = T.DataType.fromDDL(found)
    if not isinstance(fields, T.StructType):
        raise ValueError(f"{record!r} holds no records but {found}")
    return fields


def flatten_records(df: DataFrame, sep: str = "_") -> DataFrame:
    """Replace every record column by its fields, at any depth, names joined."""

    def leaves(data_type: T.DataType, source: Column, name: str) -> list[Column]:
        if not isinstance(data_type, T.StructType):
            return [source.alias(name)]
        return [
            leaf
            for f in data_type.fields
            for leaf in leaves(f.dataType, source.getField(f.name), f"{name}{sep}{f.name}")
        ]

    return df.select(
        *[leaf for f in df.schema.fields for leaf in leaves(f.dataType, F.col(quoted(f.name)), f.name)]
    )


def explode_inner(df: DataFrame, items: str, name: str) -> DataFrame:
    """One row per list element; records without elements are dropped."""
    kept = [c for c in df.columns if c != items]
    return df.select(*kept, F.explode(items).alias(name))


def explode_outer(df: DataFrame, items: str, name: str) -> DataFrame:
    """One row per list element; records without elements stay, with null."""
    kept = [c for c in df.columns if c != items]
    return df.select(*kept, F.explode_outer(items).alias(name))


def explode_default(df: DataFrame, items: str, name: str, default: str = "") -> DataFrame:
    """One text row per list element; a record without elements gets ``default``."""
    kept = [c for c in df.columns if c != items]
    return df.select(*kept, F.explode(list_or_default(F.col(items), default)).alias(name))


def list_or_default(items: Column, default: str = "") -> Column:
    """The list as text, or one ``default`` when it is empty or missing."""
    filled = F.when(F.size(items) > 0, items.cast("array<string>"))
    return F.coalesce(filled, F.array(F.lit(default)))


def split_pipe(text: Column, sep: str = "|") -> Column:
    """The pieces of a joined text. Empty text has none, and a separator at the
    very end starts no further piece."""
    quoted = r"\Q" + sep + r"\E"
    trimmed = F.regexp_replace(text, quoted + "$", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, quoted))


def build_json(df: DataFrame, name: str = "json", columns: list[str] | None = None) -> DataFrame:
    """Each record as one JSON text; missing fields are left out."""
    return df.select(F.to_json(F.struct(*exactly(columns or df.columns))).alias(name))
