"""The structured path: column names, types, stamps and payloads."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.text import strip


def normalized_name(name: str) -> str:
    """Stripped, lower case, spaces to underscores; nothing else changes."""
    return name.strip().lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """All columns renamed at once. Names that would collide are an error."""
    names = [normalized_name(c) for c in df.columns]
    twice = sorted(n for n, times in Counter(names).items() if times > 1)
    if twice:
        raise ValueError(f"columns collide after normalisation: {twice}")
    return df.toDF(*names)


def stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.current_timestamp())


def coerce_types(
    df: DataFrame, schema: T.StructType | str, failures: str = "coercion_failures"
) -> DataFrame:
    """Text columns as the declared types, and how many of a row's values failed.

    A value that does not parse becomes null and counts; a blank one becomes
    null and does not.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)

    def cleaned(field: T.StructField) -> Column:
        return strip(F.col(f"`{field.name}`").cast("string"))

    def typed(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.StringType):
            return cleaned(field)
        return cleaned(field).try_cast(field.dataType)

    def failed(field: T.StructField) -> Column:
        bad = (F.length(cleaned(field)) > 0) & typed(field).isNull()
        return F.coalesce(bad, F.lit(False)).cast("int")

    others = [F.col(f"`{c}`") for c in df.columns if c not in schema.names]
    checked = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    total = sum((failed(f) for f in checked), F.lit(0))
    return df.select(
        *others, *[typed(f).alias(f.name) for f in schema], total.alias(failures)
    )


def pack_payload(df: DataFrame, source_file: Column, source_type: Column, without: tuple[str, ...] = ()) -> DataFrame:
    """Rows as the structured store keeps them: where from, and a VARIANT of all columns but ``without``."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in without])
    return df.select(
        source_file.alias("source_file"),
        source_type.alias("source_type"),
        F.to_variant_object(row).alias("raw_payload"),
    )


def payload_field(payload: Column, name: str, data_type: str) -> Column:
    """A top-level field of a payload as a type, null where absent or unfit."""
    return F.try_variant_get(payload, f"$.{name}", data_type)
