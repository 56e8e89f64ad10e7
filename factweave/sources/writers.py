"""Sinks. One file is only written where an export asks for one; tables stay partitioned."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, LongType, StructType, TimestampType


class NothingVerified(ValueError):
    """An export without a verified contact."""


def csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def both(df: DataFrame, stem: str) -> None:
    """CSV and JSON from one computation."""
    kept = df.persist()
    try:
        csv(kept, f"{stem}.csv")
        json_lines(kept, f"{stem}.json")
    finally:
        kept.unpersist()


def export(verified: DataFrame, stem: str) -> None:
    """Both formats of a flat export; raises if it would be empty."""
    if verified.isEmpty():
        raise NothingVerified("no verified contacts")
    both(verified, stem)


def any_columns(df: DataFrame, path: str) -> None:
    """CSV with sorted columns, nested values as JSON."""
    nested = {f.name for f in df.schema if isinstance(f.dataType, (ArrayType, StructType))}
    csv(df.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in sorted(df.columns))), path)


def summary(df: DataFrame, path: str) -> None:
    """A table of one row as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def json_schema(kind: DataType, title: str | None = None) -> dict:
    """A draft 2020-12 schema of a Spark type."""
    if isinstance(kind, StructType):
        made = {"type": "object", "properties": {f.name: json_schema(f.dataType) for f in kind}, "required": [f.name for f in kind if not f.nullable]}
    elif isinstance(kind, ArrayType):
        made = {"type": "array", "items": json_schema(kind.elementType)}
    elif isinstance(kind, TimestampType):
        made = {"type": "string", "format": "date-time"}
    else:
        made = {"type": {BooleanType: "boolean", DoubleType: "number", IntegerType: "integer", LongType: "integer"}.get(type(kind), "string")}
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title} | made if title else made


def schema_text(df: DataFrame, title: str) -> str:
    return json.dumps(json_schema(df.schema, title), indent=2, sort_keys=True)
