"""The shape that all stages share: a ``metrics`` struct, and ``removal_reasons`` in the order of the stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require(df: DataFrame, *columns: str) -> None:
    """A ValueError when the plan is made, rather than a failure row by row."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def with_metrics(df: DataFrame, **metrics: Column) -> DataFrame:
    """Set fields of the metrics struct; the others stay."""
    kept = []
    if "metrics" in df.columns and isinstance(df.schema["metrics"].dataType, T.StructType):
        kept = [F.col(f"metrics.`{f}`").alias(f) for f in df.schema["metrics"].dataType.fieldNames() if f not in metrics]
    return df.withColumn("metrics", F.struct(*kept, *[c.alias(n) for n, c in metrics.items()]))


def with_reasons(df: DataFrame, **reasons: Column) -> DataFrame:
    """Append each reason where its column is true; makes the array where it is missing."""
    had = F.coalesce(F.col("removal_reasons"), F.array().cast("array<string>")) if "removal_reasons" in df.columns else F.array().cast("array<string>")
    more = [F.when(F.coalesce(c, F.lit(False)), F.array(F.lit(r))).otherwise(F.array().cast("array<string>")) for r, c in reasons.items()]
    return df.withColumn("removal_reasons", F.concat(had, *more))


def dotted(df: DataFrame, path: str, default: object = None) -> Column | None:
    """The column at a dotted path through structs and maps, or None where the schema has no such path.

    A column whose own name has the dots comes first. With a default, a literal, that stands for missing paths and nulls.
    """
    if default is not None:
        found = dotted(df, path)
        return F.lit(default) if found is None else F.coalesce(found, F.lit(default))
    if path in df.columns:
        return F.col(f"`{path}`")
    first, *rest = path.split(".")
    if first not in df.columns:
        return None
    column, kind = F.col(f"`{first}`"), df.schema[first].dataType
    for part in rest:
        if isinstance(kind, T.StructType) and part in kind.fieldNames():
            column, kind = column.getField(part), kind[part].dataType
        elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            column, kind = column.getItem(part), kind.valueType
        else:
            return None
    return column


def kind_of(df: DataFrame, path: str) -> T.DataType | None:
    column = dotted(df, path)
    return None if column is None else df.select(column.alias("x")).schema["x"].dataType
