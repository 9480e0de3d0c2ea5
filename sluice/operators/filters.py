"""Filters given as (column, operator, value) triples."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.functions import values as V

_COMPARISONS = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}


def literal_text(value: object) -> str:
    """The text a literal is compared as; booleans are written as in JSON."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def where(df: DataFrame, triples: Iterable[tuple]) -> DataFrame:
    """Rows for which all triples hold, on (flattened) columns of `df`.

    Where column and literal are of a kind, they are compared as such; else as text.
    """
    triples = list(triples)
    kinds = {f.name: f.dataType for f in df.schema}
    typed = [t for t in triples if _comparable(t, kinds)]
    others = [t for t in triples if not _comparable(t, kinds)]
    column = lambda name: F.col(f"`{name}`")
    conditions = [column(n).isin(list(w)) if op == "in" else column(n) == F.lit(w) for n, op, w in typed]
    rest = _all(others, column, lambda c: c.cast("string"))
    return df.where(functools.reduce(operator.and_, conditions, rest))


def _comparable(triple: tuple, kinds: dict[str, T.DataType]) -> bool:
    """Whether `=` or `in` can compare the column itself, which the scan can then prune by:
    text with text, numbers with numbers, booleans with booleans."""
    if not isinstance(triple, (tuple, list)) or len(triple) != 3 or triple[1] not in ("=", "in"):
        return False
    name, op, wanted = triple
    values = wanted if op == "in" else [wanted]
    if not isinstance(values, (list, tuple, set, frozenset)) or not values:
        return False
    kind = kinds.get(name)
    if isinstance(kind, T.BooleanType):
        return all(isinstance(v, bool) for v in values)
    if isinstance(kind, T.NumericType):
        return all(isinstance(v, (int, float)) and not isinstance(v, bool) and abs(v) < 1 << 63 for v in values)
    return isinstance(kind, T.StringType) and all(isinstance(v, str) for v in values)


def where_value(df: DataFrame, triples: Iterable[tuple], value: str = "value") -> DataFrame:
    """The same on the flattened members of a VARIANT, named by their path."""
    return df.where(_all(triples, lambda name: V.flattened(F.col(value), name), V.text_of))


def _all(triples: Iterable[tuple], column, as_text) -> Column:
    conditions = [_condition(t, column, as_text) for t in triples]
    return functools.reduce(operator.and_, conditions, F.lit(True))


def _condition(triple: tuple, column, as_text) -> Column:
    """`=` and `in` compare as text, the others as the literal's type. Nulls follow
    SQL, except that `= None` asks for null."""
    if not isinstance(triple, (tuple, list)) or len(triple) != 3 or not isinstance(triple[0], str):
        raise ValueError(f"a filter is (column, operator, value), not {triple!r}")
    name, op, wanted = triple
    found = column(name)
    if op == "=":
        if wanted is None:
            return as_text(found).isNull()
        return as_text(found) == F.lit(literal_text(wanted))
    if op == "in":
        if isinstance(wanted, (str, bytes)) or not isinstance(wanted, Iterable):
            raise ValueError(f"filter 'in' needs a list of values, not {wanted!r}")
        return as_text(found).isin([literal_text(w) for w in wanted])
    if op in _COMPARISONS:
        typed = found if as_text is not V.text_of else _typed(found, wanted)
        return _COMPARISONS[op](typed, F.lit(wanted))
    raise ValueError(f"unknown filter operator {op!r}")


def _typed(value: Column, wanted: object) -> Column:
    return V.to_double(value) if isinstance(wanted, (int, float)) else V.text_of(value)
