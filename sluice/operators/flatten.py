"""Nested objects to flat columns or to one row per leaf."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from sluice.functions import values as V
from sluice.session import shared_folder


def leaves(
    df: DataFrame,
    value: str = "value",
    keep: Sequence[str] = (),
    depth: int | None = None,
    sep: str = ".",
    strict: bool = True,
) -> DataFrame:
    """`keep`, `path STRING`, `leaf VARIANT`: one row per leaf.

    Lists and JSON nulls are leaves; an empty object leaves nothing; a record
    that is no object is one leaf called `_value`. The input is read once.

    Without `depth` the levels are written one after the other, however deep they go (see
    `opened_by_level`). With it they are one lazy plan; a record nested deeper fails the job
    rather than losing leaves, or unless `strict` shows the deeper object as a leaf.
    """
    if depth is None:
        return opened_by_level(df, lambda leaf: {"leaf": leaf}, value, keep, sep)
    level = _roots(df, value, keep)
    for _ in range(depth):
        level = _open(level, keep, sep)
    leaf = F.col("leaf")
    if strict:
        too_deep = F.raise_error(F.lit(f"object nested deeper than {depth} levels; pass a larger depth"))
        leaf = F.when(V.is_object(leaf), too_deep).otherwise(leaf)
    return level.where(V.kind(F.col("leaf")) != "OBJECT<>").select(*keep, _named("path"), leaf.alias("leaf"))


def opened_by_level(
    df: DataFrame,
    shape: Callable[[Column], dict[str, Column]],
    value: str = "value",
    keep: Sequence[str] = (),
    sep: str = ".",
) -> DataFrame:
    """`keep`, `path STRING`, and the columns that `shape` makes of a leaf: one row per leaf.

    Each pass opens the objects that the pass before has left, and writes what it finds:
    leaves in their final shape, objects to go on with as they are. So every record is parsed once, and
    rows that are done are not touched again; the last pass is the first that leaves no object.
    """
    folder = shared_folder(df.sparkSession, "levels")
    level, n = _roots(df, value, keep), 0
    found = F.col("leaf")
    while True:
        # The kind once per row: it walks through the whole value.
        opened = _open(level, keep, sep).withColumn("_kind", V.kind(found)).where("_kind <> 'OBJECT<>'")
        object_ = F.col("_kind").startswith("OBJECT")
        columns = [F.when(~object_, c).alias(f"_{name}") for name, c in shape(found).items()]
        part = opened.select(*keep, "path", F.when(object_, found).alias("_object"), object_.alias("_more"), *columns)
        seen = Observation()
        part.observe(seen, F.count_if("_more").alias("more")).write.parquet(f"{folder}/level={n}")
        written = df.sparkSession.read.schema(part.schema).parquet(f"{folder}/level={n}")
        if not seen.get["more"]:
            break
        level = written.where("_more").select(*keep, "path", F.col("_object").alias("leaf"))
        n += 1
    names = list(shape(found))
    done = df.sparkSession.read.schema(part.schema).parquet(*[f"{folder}/level={i}" for i in range(n + 1)]).where("NOT _more")
    return done.select(*keep, _named("path"), *[F.col(f"_{name}").alias(name) for name in names])


def _named(path: str) -> Column:
    return F.when(F.col(path) == "", F.lit(V.ROOT)).otherwise(F.col(path)).alias(path)


def _roots(df: DataFrame, value: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.lit("").alias("path"), F.col(value).alias("leaf"))


def _open(level: DataFrame, keep: Sequence[str], sep: str) -> DataFrame:
    members = F.col("leaf").try_cast("map<string,variant>")
    opened = level.select(
        *keep, "path", "leaf", F.explode_outer(members).alias("_key", "_member")
    )
    key, member = F.col("_key"), F.col("_member")
    path = F.when(F.col("path") == "", key).otherwise(F.concat("path", F.lit(sep), key))
    return opened.select(
        *keep,
        F.when(key.isNull(), F.col("path")).otherwise(path).alias("path"),
        F.when(key.isNull(), F.col("leaf")).otherwise(member).alias("leaf"),
    )


def flatten_long(
    df: DataFrame,
    value: str = "value",
    keep: Sequence[str] = (),
    depth: int | None = None,
    sep: str = ".",
) -> DataFrame:
    """`keep`, `path STRING`, `value_json STRING`: one row per leaf."""
    if depth is None:
        return opened_by_level(df, lambda leaf: {"value_json": V.json_of(leaf)}, value, keep, sep)
    return leaves(df, value, keep, depth, sep).select(*keep, "path", V.json_of(F.col("leaf")).alias("value_json"))


def flatten_struct(
    df: DataFrame, columns: Sequence[str] | None = None, sep: str = "."
) -> DataFrame:
    """Struct columns to one column per leaf, named by its path; arrays to JSON text.

    Leaves with one name, as of `a.b` beside `a: {b}`, are one column: the nested one where it
    is not null, else the other.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    found: dict[str, list[tuple[Column, T.DataType]]] = {}
    for field in _nested_first(fields, sep):
        for name, column, kind in _struct_leaves(F.col(f"`{field.name}`"), field.dataType, field.name, sep):
            found.setdefault(name, []).append((column, kind))
    return df.select(*[_one(same).alias(name) for name, same in found.items()])


def _one(same: list[tuple[Column, T.DataType]]) -> Column:
    """The first that is not null of leaves with one name, the most nested first; as text where
    their types differ."""
    if len({kind.simpleString() for _, kind in same}) == 1:
        return F.coalesce(*[c for c, _ in same]) if len(same) > 1 else same[0][0]
    return F.coalesce(*[c.cast("string") for c, _ in same])


def _struct_leaves(column: Column, data_type: T.DataType, name: str, sep: str) -> list[tuple[str, Column, T.DataType]]:
    if isinstance(data_type, T.StructType):
        return [
            leaf
            for f in _nested_first(data_type.fields, sep)
            for leaf in _struct_leaves(column.getField(f.name), f.dataType, f"{name}{sep}{f.name}", sep)
        ]
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return [(name, F.to_json(column), T.StringType())]
    return [(name, column, data_type)]


def _nested_first(fields: Sequence[T.StructField], sep: str) -> list[T.StructField]:
    """The fields in order, but structs first where a name could be that of a nested leaf."""
    if not any(sep in f.name for f in fields):
        return list(fields)
    return sorted(fields, key=lambda f: not isinstance(f.dataType, T.StructType))
