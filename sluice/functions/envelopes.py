"""Expressions that take response bodies apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Members that may hold the records, in the order they are tried.
ENVELOPE_KEYS = ("results", "data", "items", "records")

# JSON white space.
BLANKS = " \t\r\n"

# Stands after a text, never inside one.
_END = "\u241c end of body \u241c"


def listed(text: Column) -> Column:
    """The parsed text as first element of a list with a known last element.

    `try_parse_json` stops after the first complete value, so `{..}{..}` would
    silently lose its second half. Inside the list the whole text is consumed.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))


def sole(parsed: Column) -> Column:
    """The value of a `listed` text; null when any part of the text is not JSON."""
    complete = F.try_variant_get(parsed, "$[1]", "string") == _END
    return F.when(complete, F.try_variant_get(parsed, "$[0]", "variant"))


def first_character(text: Column) -> Column:
    """First character that is not white space; for valid JSON it tells the kind."""
    return F.left(F.ltrim(text, F.lit(BLANKS)), F.lit(1))


def inside_strings(text: Column) -> Column:
    """What JSON strings around a text hold, however many; other texts stay as they are.

    A string escapes the quotes and backslashes of the one inside, which doubles them, so
    that the length bounds the layers. Where escapes are spelled as code points it does
    not; of such texts the last layers may be left.
    """
    layers = F.sequence(F.lit(1), F.ceil(F.log2(F.length(text) + 2)).cast("int"))

    def inner(quoted: Column) -> Column:
        return F.transform(F.array(listed(quoted)), lambda v: F.try_variant_get(sole(v), "$", "string"))[0]

    def opened(held: Column, _: Column) -> Column:
        return F.when(first_character(held) == '"', F.coalesce(inner(held), held)).otherwise(held)

    return F.when(first_character(text) == '"', F.aggregate(layers, text, opened)).otherwise(text)


def raw_response(text: Column) -> Column:
    return F.to_variant_object(F.struct(text.alias("raw_response")))


def records_in(value: Column) -> Column:
    """Records of a decoded list or object as ARRAY<VARIANT>; null for other kinds."""
    members = [F.try_variant_get(value, f"$.{key}", "array<variant>") for key in ENVELOPE_KEYS]
    return F.coalesce(
        F.try_variant_get(value, "$", "array<variant>"), *members, F.array(value)
    )


def elements_as_text(body: Column) -> Column:
    """Texts of a list's elements, or of the one other value; strings come without
    quotes. White space goes, and floats stay floats (`1.0`)."""
    as_list = F.when(first_character(body) == "[", body).otherwise(
        F.concat(F.lit("["), body, F.lit("]"))
    )
    return F.from_json(as_list, "array<string>")


def may_hold_strings(body: Column, texts: Column) -> Column:
    """False only if every element text surely is an object.

    A text that starts like an object can be a string only where a quote is
    followed by a brace in the body.
    """
    looks_like_object = F.forall(texts, lambda t: F.coalesce(t.startswith("{"), F.lit(False)))
    return ~looks_like_object | body.rlike(r'"\s*([{]|\\u007[bB])')


def quote_strings(texts: Column, kinds: Column) -> Column:
    """Element texts with strings quoted again, told apart by their parsed values."""
    return F.zip_with(
        texts,
        kinds,
        lambda t, v: F.when(F.schema_of_variant(v) == "STRING", F.to_json(v)).otherwise(
            F.coalesce(t, F.lit("null"))
        ),
    )
