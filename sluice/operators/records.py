"""Response bodies to records, one row each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.functions import values as V
from sluice.functions.envelopes import (
    elements_as_text,
    first_character,
    inside_strings,
    listed,
    may_hold_strings,
    quote_strings,
    raw_response,
    records_in,
    sole,
)

INVALID_JSON = "invalid JSON"
TOO_DEEP = "JSON text nested in too many strings"


def with_items(pages: DataFrame, body: str = "body") -> DataFrame:
    """Adds `items ARRAY<VARIANT>` and `problem STRING` (null when readable).

    The body is decoded as long as it is a JSON string. Text inside a string that is
    not JSON becomes one `raw_response` record; a body that is not JSON yields null
    items and a problem, and so does one with layers left (see `inside_strings`).
    """
    # Projections in sequence, so that each text is parsed once.
    text, parsed, value, items, problem = _item_columns(body, id(SparkContext._active_spark_context))
    df = pages.withColumn("_text", text).withColumns(parsed).withColumn("_value", value)
    return df.select(*pages.columns, items.alias("items"), problem.alias("problem"))


@lru_cache(maxsize=16)
def _item_columns(body: str, context: int) -> tuple:
    """The expressions of `with_items`, which take long to put together: once per context."""
    text = inside_strings(F.col(body))
    parsed = {"_listed": listed(F.col("_text")), "_first": first_character(F.col("_text"))}
    decoded = F.col("_text") != F.col(body)
    problem = F.when(F.col("_value").isNull() & ~decoded, F.lit(INVALID_JSON)).when(
        F.col("_value").isNotNull() & (F.col("_first") == '"'), F.lit(TOO_DEEP)
    )
    items = _items(F.col("_text"), F.col("_value"), F.col("_first"), decoded)
    return text, parsed, sole(F.col("_listed")), items, F.when(F.col(body).isNotNull(), problem)


def _items(text: Column, value: Column, first: Column, decoded: Column) -> Column:
    return (
        F.when(value.isNull(), F.when(decoded, F.array(raw_response(text))))
        .when(first.isin("[", "{"), records_in(value))
        .when(first == "n", F.array().cast("array<variant>"))
        .when(first != '"', F.array(raw_response(V.text_of(value))))
    )


def checked(pages: DataFrame, body: str = "body") -> DataFrame:
    """The pages, failing on one that was not read: another status than 2xx, an error, or no
    body. Tables without the columns `status` and `error` of raw pages hold bodies only.

    All readers of records go through this. Callers that want incidents instead of a
    failure split the pages first (`operators.paging`).
    """
    if not {"status", "error"} <= set(pages.columns):
        return pages
    place = [F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in ("endpoint", "page") if c in pages.columns]
    cause = F.coalesce("error", F.when(~F.col("status").between(200, 299), F.concat(F.lit("HTTP "), F.col("status").cast("string"))), F.lit("empty response"))
    read = F.col("error").isNull() & F.coalesce(F.col("status").between(200, 299), F.lit(False)) & F.col(body).isNotNull()
    failure = F.raise_error(F.concat(F.concat_ws(" page ", *place), F.lit(": "), cause))
    return pages.withColumn(body, F.when(read, F.col(body)).otherwise(failure))


def _readable(value: Column, body: Column, problem: Column | str = INVALID_JSON) -> Column:
    """The value, or a failure where there is a body but no value."""
    problem = F.lit(problem) if isinstance(problem, str) else problem
    invalid = F.raise_error(F.concat(problem, F.lit(": "), F.left(body, F.lit(100))))
    return F.coalesce(value, F.when(body.isNotNull() & problem.isNotNull(), invalid))


def unwrap(pages: DataFrame, body: str = "body", keep: Sequence[str] | None = None) -> DataFrame:
    """Envelope unwrap: `keep` columns, `pos INT`, `value VARIANT`.

    A list gives its elements; an object gives the first of its members
    results/data/items/records that is a list, else itself; JSON null gives
    nothing; other scalars give one `raw_response` record. A page that was not read, or
    whose body is not JSON, fails the query.
    """
    kept = _kept(pages, body, keep)
    items = with_items(checked(pages, body), body)
    return _one_row_each(items, kept, _readable(F.col("items"), F.col(body), F.col("problem")))


def records_of(pages: DataFrame, keep: Sequence[str] = ("endpoint", "page")) -> DataFrame:
    """`keep`, `pos INT`, `value VARIANT` of landed pages that kept their `items`."""
    return _one_row_each(pages, keep, F.col("items"))


def records_at(
    pages: DataFrame,
    json_path: str | None = None,
    body: str = "body",
    keep: Sequence[str] | None = None,
    scalar_page: str = "skip",
) -> DataFrame:
    """Records below `json_path`: a list gives its elements, an object one record.

    Pages holding a scalar there are skipped, or are one record each with
    `scalar_page="record"`. Pages without a value there give nothing. A page that was not
    read, or whose body is not JSON, fails the query.
    """
    if scalar_page not in ("skip", "record"):
        raise ValueError(f"scalar_page must be skip or record, not {scalar_page!r}")
    keep = _kept(pages, body, keep)
    parsed = checked(pages, body).select(*keep, body, listed(F.col(body)).alias("_listed")).select(
        *keep, _readable(sole(F.col("_listed")), F.col(body)).alias("_page")
    )
    found = parsed.select(*keep, V.at_path(F.col("_page"), json_path).alias("_found"))
    value = F.col("_found")
    single = F.array(value)
    if scalar_page == "skip":
        single = F.when(V.is_object(value), single)
    records = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.when(value.isNotNull(), single))
    return _one_row_each(found, keep, records)


def decode(df: DataFrame, text: str, keep: Sequence[str] | None = None) -> DataFrame:
    """One record per JSON text: `keep` columns and `value VARIANT`, null if not JSON."""
    keep = _kept(df, text, keep)
    # The generator is a barrier: filters on the value are not pushed below the
    # parsing, where they would parse the text again.
    parsed = df.select(*keep, F.explode_outer(F.array(listed(F.col(text)))).alias("_listed"))
    return parsed.select(*keep, sole(F.col("_listed")).alias("value"))


def _one_row_each(df: DataFrame, keep: Sequence[str], records: Column) -> DataFrame:
    # For a plain posexplode Spark infers filters on its argument and pushes them,
    # with all the parsing in them, down to the scan. The outer form parses once.
    exploded = df.select(*keep, F.posexplode_outer(records).alias("pos", "value"))
    return exploded.where(F.col("value").isNotNull())


def raw_records(pages: DataFrame, name: str, body: str = "body") -> DataFrame:
    """JSON text of every record in one STRING column called `name`.

    A list gives its elements, anything else is one record. Floats stay floats
    (`1.0`). A page that was not read, or whose body is not JSON, fails the query.
    """
    text, texts, parsed = F.col(body), F.col("_texts"), F.col("_parsed")
    # Projections in sequence, so that each text is parsed once.
    staged = checked(pages, body).select(body, elements_as_text(text).alias("_texts"), listed(text).alias("_listed")).select(
        body, "_texts", _readable(sole(F.col("_listed")), F.col(body)).alias("_parsed")
    )
    kinds = F.coalesce(parsed.try_cast("array<variant>"), F.array(parsed))
    found = (
        F.when(parsed.isNull(), F.lit(None).cast("array<string>"))
        .when(may_hold_strings(text, texts), quote_strings(texts, kinds))
        .otherwise(texts)
    )
    exploded = staged.select(F.explode_outer(found).alias(name))
    return exploded.where(F.col(name).isNotNull())


def project(records: DataFrame, schema: T.StructType | str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to the columns of `schema`, in its order; absent keys and fields of another
    type give null. Text that is not JSON fails the query rather than becoming nulls."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    noted = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    row = F.from_json(F.col(text), noted, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = records.select(*keep, F.col(text).alias("_text"), row.alias("_row"))
    # Only texts that the parser complains about are looked at again: most are bad fields.
    wrong = F.col(f"_row.{_CORRUPT}").isNotNull() & sole(listed(F.col("_text"))).isNull()
    failure = F.raise_error(F.concat(F.lit(f"{INVALID_JSON}: "), F.left("_text", F.lit(100))))
    checked_row = F.when(wrong, failure).otherwise(F.col("_row")).alias("_row")
    return parsed.select(*keep, checked_row).select(*keep, *[F.col(f"_row.`{n}`") for n in schema.names])


# Field in which the parser leaves texts that it could not read.
_CORRUPT = "_unreadable"


def project_values(
    records: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Flattened, typed columns of a VARIANT: `a.b` is member b of a, or the member a.b."""
    # Two projections, so that each member is looked up once however it is converted.
    members = [
        V.flattened(F.col(value), f.name).alias(f"_member{n}") for n, f in enumerate(schema.fields)
    ]
    columns = [
        V.convert(F.col(f"_member{n}"), f.dataType).alias(f.name) for n, f in enumerate(schema.fields)
    ]
    return records.select(*keep, *members).select(*keep, *columns)


def append_endpoints(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; columns an endpoint lacks are null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def _kept(pages: DataFrame, body: str, keep: Sequence[str] | None) -> list[str]:
    return [c for c in pages.columns if c != body] if keep is None else list(keep)
