"""Text, flags and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mediatide.functions.numbers import parse_double, trimmed


def null_if_blank(text: Column) -> Column:
    return F.nullif(trimmed(text), F.lit(""))


def lower_trimmed(text: Column) -> Column:
    return F.lower(trimmed(text))


def upper_trimmed(text: Column) -> Column:
    return F.upper(trimmed(text))


def says_yes(text: Column) -> Column:
    """`true`, `1` or `yes` in any case, blanks around them allowed; NULL stays NULL."""
    return lower_trimmed(text).isin("true", "1", "yes")


def is_exactly_true(text: Column) -> Column:
    return F.coalesce(text == "true", F.lit(False))


def has_text(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))) > 0


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Value for a key of a small fixed table; an unknown key passes through."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)


def json_fields(text: Column, names: list[str]) -> Column:
    """One parse of an object's text into a struct of text fields.

    Anything that is not one whole object gives a struct of NULLs.
    """
    body = trimmed(text)
    whole = F.when(text.startswith("{") & text.endswith("}"), text).when(
        body.startswith("{") & body.endswith("}"), body
    )
    schema = ", ".join(f"`{name}` string" for name in names)
    return F.from_json(whole, schema, {"allowSingleQuotes": "false"})


def first_action_value(text: Column) -> Column:
    """`[{"value": "1.2"}, ...]` or a bare number, both as text, to a double."""
    value = F.coalesce(F.get_json_object(text, "$[0].value"), text)
    return F.coalesce(parse_double(value), F.lit(0.0))
