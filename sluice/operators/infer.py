"""Column types found in the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.functions import values as V
from sluice.operators.flatten import opened_by_level

# The types inference can produce.
INFERRED = {
    "boolean": T.BooleanType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "string": T.StringType(),
}


def column_types(records: DataFrame, value: str = "value") -> DataFrame:
    """`path`, `type`: one row per flattened path over all records.

    Equal types stay, long with double gives double, other mixtures give string;
    nulls count only where nothing else is found. Each record is parsed once: what is
    written on the way down are the kinds of leaves, and objects still to be opened.
    """
    found = opened_by_level(records, lambda leaf: {"bit": _bit(leaf)}, value)
    # A path is a hot key by nature, but each task passes on one row per path.
    return _widened(found.groupBy("path").agg(F.bit_or("bit").alias("kinds"))).select("path", "type")


def _bit(leaf: Column) -> Column:
    """The kind of a leaf as a bit, 0 for null."""
    bit_of_type = F.create_map(*[F.lit(x) for n, name in enumerate(INFERRED) for x in (name, 1 << n)])
    kind = F.col("_kind")
    return F.when(kind == "VOID", F.lit(0)).otherwise(F.element_at(bit_of_type, V.inferred_type(leaf, kind)))


def _widened(found: DataFrame) -> DataFrame:
    names = list(INFERRED)
    numbers = (1 << names.index("long")) | (1 << names.index("double"))
    kinds = F.col("kinds")
    widened = F.coalesce(
        *[F.when(kinds == 1 << n, F.lit(name)) for n, name in enumerate(names)],
        F.when(kinds == numbers, F.lit("double")),
        F.lit("string"),
    )
    return found.select("path", widened.alias("type"))


def first_record(records: DataFrame, order: Sequence[str] = ("endpoint", "page", "pos")) -> DataFrame:
    """The first record in reading order; every task keeps one row."""
    return records.orderBy(*order).limit(1)


def infer_schema(
    records: DataFrame,
    value: str = "value",
    infer_types: bool = True,
    max_columns: int | None = None,
) -> T.StructType:
    """Schema with one nullable field per path; all STRING unless `infer_types`.

    One pass over the records, and over what is nested in them. More paths than
    `max_columns`, if it is given, are an error: such objects are maps, and belong in a
    declared MAP column.
    """
    ordered = column_types(records, value).orderBy("path")
    rows = (ordered if max_columns is None else ordered.limit(max_columns + 1)).collect()
    if max_columns is not None and len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} flattened paths; declare a schema instead")
    schema = T.StructType()
    for r in rows:
        schema.add(r["path"], INFERRED[r["type"]] if infer_types else T.StringType())
    return schema
