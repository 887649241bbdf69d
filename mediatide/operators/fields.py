"""Reading fields of a landed feed whose columns may be absent, NULL, text or typed."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediatide import __version__
from mediatide.functions.dates import iso_day
from mediatide.functions.numbers import parse_double, parse_integer, truncate_long


@dataclass(frozen=True)
class RunStamp:
    """What a run writes into the audit columns."""

    extracted_at: str = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).isoformat())
    version: str = __version__

    def columns(self) -> list[Column]:
        return [
            F.lit(self.extracted_at).alias("_extracted_at"),
            F.lit(self.version).alias("_pipeline_version"),
        ]


class Feed:
    """Typed access to a feed's columns; NULL means the same as an absent column.

    A column that arrives typed (a Parquet landing) is cast; one that arrives as text
    (JSON, CSV) is parsed leniently.
    """

    def __init__(self, df: DataFrame):
        self._types = {f.name: f.dataType for f in df.schema.fields}

    def _value(self, names: tuple[str, ...]) -> tuple[Column, T.DataType] | None:
        present = [n for n in names if n in self._types]
        if not present:
            return None
        types = {self._types[n] for n in present}
        if len(types) == 1:
            return F.coalesce(*(F.col(n) for n in present)), types.pop()
        return F.coalesce(*(F.col(n).cast("string") for n in present)), T.StringType()

    def text(self, *names: str, default: str = "") -> Column:
        found = self._value(names)
        return F.lit(default) if not found else F.coalesce(found[0].cast("string"), F.lit(default))

    def double(self, *names: str, default: float = 0.0) -> Column:
        found = self._value(names)
        if not found:
            return F.lit(default)
        value, kind = found
        number = parse_double(value) if isinstance(kind, T.StringType) else value.cast("double")
        return F.coalesce(number, F.lit(default))

    def long_or_null(self, *names: str) -> Column:
        found = self._value(names)
        if not found:
            return F.lit(None).cast("bigint")
        value, kind = found
        if isinstance(kind, T.IntegralType):
            return value.cast("bigint")
        return truncate_long(parse_double(value) if isinstance(kind, T.StringType) else value)

    def long(self, *names: str, default: Column | int = 0) -> Column:
        """`default` stands in for an absent value; an unreadable one counts as zero."""
        fallback = default if isinstance(default, Column) else F.lit(default).cast("bigint")
        found = self._value(names)
        if not found:
            return fallback
        number = self.long_or_null(*names)
        if isinstance(default, int) and default == 0:
            return F.coalesce(number, fallback)
        return F.when(found[0].isNull(), fallback).otherwise(F.coalesce(number, F.lit(0)))

    def flag(self, name: str) -> Column:
        """Truth of a value: a true boolean, a number other than zero, a non-empty text."""
        found = self._value((name,))
        if not found:
            return F.lit(False)
        value, kind = found
        if isinstance(kind, T.StringType):
            value = F.length(value) > 0
        return F.coalesce(value.cast("boolean"), F.lit(False))

    def day(self, name: str) -> Column:
        found = self._value((name,))
        if not found:
            return F.lit(None).cast("date")
        value, kind = found
        return iso_day(value) if isinstance(kind, T.StringType) else value.cast("date")

    def unix_seconds(self, name: str) -> Column:
        """Seconds since 1970; absent counts as zero, unreadable text as NULL."""
        found = self._value((name,))
        if not found:
            return F.lit(0).cast("bigint")
        value, kind = found
        if isinstance(kind, T.StringType):
            return F.when(value.isNull(), F.lit(0)).otherwise(parse_integer(value))
        return F.coalesce(truncate_long(value), F.lit(0))

    def type_of(self, name: str) -> T.DataType | None:
        return self._types.get(name)
