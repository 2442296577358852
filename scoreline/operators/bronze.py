"""Bronze: land raw records onto a declared schema, stamped with their batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(df: DataFrame, schema: T.StructType, stringify: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Project onto ``schema``'s fields: missing fields become null, extra
    fields are dropped (except ``keep``), non-null scalars are stringified
    (null stays null)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            cols.append((c.cast("string") if stringify else c.cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *(keep or []))


def align_all(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Records from sources with different field sets, on one schema."""
    out = None
    for df in frames:
        a = align(df, schema)
        out = a if out is None else out.unionByName(a)
    return out


def stamp(df: DataFrame, ingested_at: str, source_name: str) -> DataFrame:
    return df.withColumns({"ingested_at": F.lit(ingested_at), "source_name": F.lit(source_name)})
