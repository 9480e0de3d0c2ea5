"""Where records and failures go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluice.functions import values as V

# Fixed value: the title failures are reported under.
INCIDENT_TITLE = "API Ingestion Job Failed"

INCIDENT_COLUMNS = ("endpoint", "page", "status", "short_description", "description")


def write_json(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = True
) -> None:
    """JSON Lines, UTF-8, replacing what `path` held; one folder per partition value.

    Each task writes a file per partition value it holds. With `gather` the rows
    are first brought together by value, in a shuffle that adaptive execution
    balances by splitting large values; rows that come clustered need none.
    """
    writer = _gathered(df, partition_by, gather).write.mode("overwrite")
    writer = writer.option("ignoreNullFields", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


# Begins the folder name of an endpoint, so that no name is empty or reads as a number.
_NAMED = "@"


def write_records(
    records: DataFrame, path: str, value: str = "value", gather: bool = True
) -> None:
    """VARIANT records as JSON Lines, one folder per endpoint; `gather` as above.

    `read_records` gives the endpoints their exact names back.
    """
    named = F.concat(F.lit(_NAMED), "endpoint")
    lines = records.select(named.alias("endpoint"), F.to_json(value).alias("value"))
    writer = _gathered(lines, ["endpoint"], gather).write.mode("overwrite")
    writer.partitionBy("endpoint").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """`endpoint STRING`, `record STRING` of what `write_records` wrote."""
    lines = spark.read.schema("value STRING, endpoint STRING").text(path)
    return lines.select(F.substring("endpoint", len(_NAMED) + 1, 1 << 30).alias("endpoint"), F.col("value").alias("record"))


def _gathered(df: DataFrame, partition_by: Sequence[str], gather: bool) -> DataFrame:
    return df.hint("rebalance", *partition_by) if gather and partition_by else df


def page_incidents(failed: DataFrame) -> DataFrame:
    """Incident rows for pages that could not be read."""
    cause = F.coalesce(F.col("error"), F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    return failed.select(
        "endpoint",
        "page",
        "status",
        F.lit(INCIDENT_TITLE).alias("short_description"),
        _describe("page ", F.col("page").cast("string"), F.lit(": "), cause).alias("description"),
    )


def conversion_problems(
    members: Sequence[Column], schema: T.StructType, converted: Sequence[Column] | None = None
) -> list[Column]:
    """For each field a message where its member is present but does not convert, else null.
    `converted` are the members as the fields' types, where they are there already."""
    checks = []
    for n, (found, field) in enumerate(zip(members, schema.fields)):
        present = F.coalesce(~F.is_variant_null(found), F.lit(False))
        lost = present & (converted[n] if converted else V.convert(found, field.dataType)).isNull()
        checks.append(F.when(lost, _not_as(field, V.text_of(found))))
    return checks


def null_problems(schema: T.StructType) -> list[Column]:
    """For each field that is declared as not nullable a message where its column is null."""
    return [F.when(F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name} is null")) for f in schema.fields if not f.nullable]


def conversion_incidents(
    records: DataFrame, schema: T.StructType, value: str = "value"
) -> DataFrame:
    """Incident rows for values that are present but do not convert to their column."""
    members = [V.flattened(F.col(value), f.name).alias(f"_member{n}") for n, f in enumerate(schema.fields)]
    checks = conversion_problems([F.col(f"_member{n}") for n in range(len(members))], schema)
    return record_incidents(records.select("endpoint", "page", *members), checks)


def null_incidents(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Incident rows for nulls in columns the schema declares as not nullable."""
    return record_incidents(records, null_problems(schema))


def _not_as(field: T.StructField, text: Column) -> Column:
    return F.concat(F.lit(f"{field.name} is not {field.dataType.simpleString()}: "), text)


def gathered(checks: Sequence[Column]) -> Column:
    """The messages among `checks` as a list."""
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def record_incidents(records: DataFrame, checks: Sequence[Column] | Column) -> DataFrame:
    """Incident rows for the messages of records: one for each check that is not null, or for
    each element of a list of messages."""
    messages = checks if isinstance(checks, Column) else gathered(checks)
    found = records.select("endpoint", "page", F.explode_outer(messages).alias("message"))
    return found.where(F.col("message").isNotNull()).select(
        "endpoint",
        "page",
        F.lit(None).cast("int").alias("status"),
        F.lit(INCIDENT_TITLE).alias("short_description"),
        _describe("page ", F.col("page").cast("string"), F.lit(": "), F.col("message")).alias("description"),
    )


def _describe(word: str, *parts: Column) -> Column:
    return F.concat(F.col("endpoint"), F.lit(" "), F.lit(word), *parts)
