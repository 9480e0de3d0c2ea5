"""Expressions on one JSON value held as VARIANT. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The accepted spellings.
TRUE_WORDS = ("true", "1", "yes")
STRICT_TRUE_WORDS = ("true", "1", "yes", "y")
STRICT_FALSE_WORDS = ("false", "0", "no", "n", "")

ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.]\d+)?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
# Forms with a zone but no minutes, or no seconds, which the cast wants spelled out.
_HOUR_AND_ZONE = r"^(.{11}\d{2})(Z|[+-]\d{2}:\d{2})$"
_MINUTE_AND_ZONE = r"^(.{11}\d{2}:\d{2})(Z|[+-]\d{2}:\d{2})$"
INTEGER = r"^\s*[+-]?0*\d{1,19}\s*$"
NUMBER = (
    r"^\s*[+-]?(\d+[.]?\d*|[.]\d+)([eE][+-]?\d+)?\s*$"
    r"|(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
)


# Column of records that are no objects.
ROOT = "_value"


def kind(value: Column) -> Column:
    """JSON kind: VOID, BOOLEAN, BIGINT, DECIMAL.., DOUBLE, STRING, ARRAY.., OBJECT.."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return kind(value).startswith("OBJECT")


def json_null_to_null(value: Column) -> Column:
    return F.when(~F.is_variant_null(value), value)


def child(value: Column, key: str) -> Column:
    """Member `key` of an object, null for anything else."""
    if "'" not in key:
        return F.try_variant_get(value, f"$['{key}']", "variant")
    if '"' not in key:
        return F.try_variant_get(value, f'$["{key}"]', "variant")
    return value.try_cast("map<string,variant>")[key]


def at_keys(value: Column, keys: list[str] | tuple[str, ...]) -> Column:
    """Value below the nested object members `keys`, JSON null included."""
    if not any("'" in k for k in keys):
        return F.try_variant_get(value, "$" + "".join(f"['{k}']" for k in keys), "variant")
    for key in keys:
        value = child(value, key)
    return value


def at_path(value: Column, path: str | None) -> Column:
    """Dotted path navigation through objects only; an empty path is the value itself.
    What is missing or JSON null gives null."""
    return json_null_to_null(at_keys(value, path.split("."))) if path else value


# Names of up to so many words are looked up by all ways to cut them into keys, 2 ** (words - 1).
_CUT_WORDS = 3


def flattened(value: Column, name: str) -> Column:
    """Leaf that flattening calls `name`, JSON null included.

    A dot may part two keys or belong to one; nested keys are tried first. Long names are
    resolved by the keys that the record has, one descent however many dots there are.
    """
    if name == ROOT:
        return F.coalesce(at_keys(value, [name]), F.when(~is_object(value), value))
    words = name.split(".")
    if len(words) > _CUT_WORDS:
        return _descended(value, name, len(words))
    return F.coalesce(*[at_keys(value, keys) for keys in _key_splits(words)])


def _key_splits(words: list[str]) -> list[list[str]]:
    splits = []
    for n in range(1, len(words)):
        splits += [[".".join(words[:n])] + rest for rest in _key_splits(words[n:])]
    return splits + [[".".join(words)]]


def _descended(value: Column, name: str, levels: int) -> Column:
    """The leaf `name`, found by going down the keys that begin it.

    A step replaces every object reached by its members whose key begins the rest of the
    name, the shortest key first: the walk of a trie that holds the record's keys. What is
    found keeps its place in the list, so that the first of them is the most nested one.
    """
    reached = "array<struct<value:variant,rest:string>>"

    def matching(found: Column) -> Column:
        rest = found["rest"]

        def members(held: Column) -> Column:
            keys = F.filter(F.map_keys(held), lambda k: (rest == k) | rest.startswith(F.concat(k, F.lit("."))))
            # All of them begin the same text, so that sorted is shortest first.
            return F.transform(
                F.array_sort(keys),
                lambda k: F.struct(held[k].alias("value"), F.when(rest != k, F.substr(rest, F.length(k) + 2)).alias("rest")),
            )

        below = F.coalesce(F.transform(F.array(found["value"].try_cast("map<string,variant>")), members)[0], F.array().cast(reached))
        return F.when(rest.isNull(), F.array(found)).otherwise(below)

    start = F.array(F.struct(value.alias("value"), F.lit(name).alias("rest"))).cast(reached)
    steps = F.sequence(F.lit(1), F.lit(levels))
    found = F.aggregate(steps, start, lambda at, _: F.flatten(F.transform(at, matching)).cast(reached))
    return F.get(F.filter(found, lambda x: x["rest"].isNull()), F.lit(0))["value"]


def json_of(value: Column) -> Column:
    """The value as JSON text; a float without a fraction keeps its `.0`."""
    return F.when(kind(value).startswith("DECIMAL"), text_of(value)).otherwise(F.to_json(value))


# ---------------------------------------------------------------- conversion


def text_of(value: Column) -> Column:
    """The value as text: `true`, `1`, `1.0`, bare strings, JSON for arrays and objects."""
    text = F.try_variant_get(value, "$", "string")
    k = kind(value)
    # A variant keeps 1.0 as the decimal 1; 19 digits and more are large integers.
    digits = F.length(F.ltrim(text, F.lit("-")))
    return (
        F.when(k.isin("STRING", "BIGINT", "BOOLEAN", "DOUBLE"), text)
        .when(k.startswith("DECIMAL"), F.when(text.contains(".") | (digits >= 19), text).otherwise(F.concat(text, F.lit(".0"))))
        .when(k != "VOID", F.to_json(value))
    )


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 text to TIMESTAMP; other text gives null.

    The pattern is needed because the cast alone also takes `2020` and `12:00`.
    """
    spelled_out = F.regexp_replace(
        F.regexp_replace(text, _HOUR_AND_ZONE, "$1:00:00$2"), _MINUTE_AND_ZONE, "$1:00$2"
    )
    # Spark keeps microseconds; further digits would make the cast fail.
    cut = F.regexp_replace(spelled_out, r"([.]\d{6})\d+", "$1")
    return F.when(text.rlike(ISO_TIMESTAMP), cut.try_cast("timestamp"))


def to_long(value: Column) -> Column:
    """Floats truncate, booleans give 1 or 0, text must be an integer."""
    text = F.try_variant_get(value, "$", "string")
    # A failed cast costs an exception, so only texts that look like integers get there.
    return F.when(
        kind(value) == "STRING", F.when(text.rlike(INTEGER), text.try_cast("bigint"))
    ).otherwise(F.try_variant_get(value, "$", "bigint"))


def to_double(value: Column) -> Column:
    """Text must be a decimal number, nan, inf or infinity."""
    text = F.try_variant_get(value, "$", "string")
    bare = F.regexp_replace(F.trim(text), r"(?i)^[+-]?nan$", "NaN")
    return F.when(
        kind(value) == "STRING", F.when(text.rlike(NUMBER), bare.try_cast("double"))
    ).otherwise(F.try_variant_get(value, "$", "double"))


def to_boolean(value: Column) -> Column:
    """True for true, 1 and the texts true/1/yes; everything else non-null is false."""
    k = kind(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(k == "VOID", F.lit(None).cast("boolean"))
        .when(k.isin("BOOLEAN", "BIGINT", "STRING"), F.lower(text).isin(*TRUE_WORDS))
        .when(k.isNotNull(), F.lit(False))
    )


def to_timestamp(value: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    return F.when(kind(value) == "STRING", iso_timestamp(text))


def convert(value: Column, data_type: T.DataType) -> Column:
    """The value as `data_type`; what cannot be converted gives null."""
    if isinstance(data_type, T.VariantType):
        return value
    if isinstance(data_type, T.StringType):
        return text_of(value)
    if isinstance(data_type, T.LongType):
        return to_long(value)
    if isinstance(data_type, T.DoubleType):
        return to_double(value)
    if isinstance(data_type, T.BooleanType):
        return to_boolean(value)
    if isinstance(data_type, T.TimestampType):
        return to_timestamp(value)
    if isinstance(data_type, T.NullType):
        return F.lit(None)
    if isinstance(data_type, (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType)):
        # Not castable from VARIANT; from_json knows their JSON spelling.
        field = T.StructType([T.StructField("v", data_type)])
        return F.from_json(F.to_json(F.struct(value.alias("v"))), field)["v"]
    return F.try_variant_get(value, "$", data_type.simpleString())


def inferred_type(value: Column, kind_of_value: Column | None = None) -> Column:
    """Name of the inferred type: boolean, long, double, timestamp or string."""
    k = kind(value) if kind_of_value is None else kind_of_value
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(k == "BOOLEAN", F.lit("boolean"))
        .when(k == "BIGINT", F.lit("long"))
        .when(k.startswith("DECIMAL") | (k == "DOUBLE"), F.lit("double"))
        .when((k == "STRING") & iso_timestamp(text).isNotNull(), F.lit("timestamp"))
        .otherwise(F.lit("string"))
    )


# ------------------------------------------------------------ strict booleans


def strict_boolean_or_null(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*STRICT_TRUE_WORDS), F.lit(True)).when(
        word.isin(*STRICT_FALSE_WORDS), F.lit(False)
    )


def strict_boolean(text: Column) -> Column:
    """Configuration flag text to boolean; any other text, or none, is an error."""
    shown = F.coalesce(text, F.lit("NULL"))
    return F.coalesce(
        strict_boolean_or_null(text),
        F.raise_error(F.concat(F.lit("Invalid boolean value: "), shown)),
    )
