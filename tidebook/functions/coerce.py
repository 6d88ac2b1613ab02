"""Lenient reading of JSON values (VARIANT columns): what can't be read is null, never an error.

Two kinds of fallback exist side by side: `first_present` skips null and empty text only, so 0 and
false count, while `first_truthy` also skips 0, false and empty collections.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUE_WORDS = ("true", "1", "yes", "on")
FALSE_WORDS = ("false", "0", "no", "off")


def at(value: Column, path: str) -> Column:
    """The value at a path, as a VARIANT; null if it isn't there or the value isn't an object."""
    return F.try_variant_get(value, path, "variant")


def as_double(value: Column) -> Column:
    """Numbers, numeric text and booleans (1 or 0); null for anything else, NaN and infinities too."""
    number = F.try_variant_get(value, "$", "double")
    text = F.try_variant_get(value, "$", "string")
    return F.when(text.rlike("[dDfF]$") | F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def as_long(value: Column) -> Column:
    """Whole numbers, fractions cut; text only if it is a whole number."""
    text = F.try_variant_get(value, "$", "string")
    whole = F.try_variant_get(value, "$", "bigint")
    return F.when(is_text(value) & ~text.rlike(r"^\s*[+-]?\d+\s*$"), None).otherwise(whole)


def is_text(value: Column) -> Column:
    return F.startswith(F.to_json(value), F.lit('"'))


def as_bool(value: Column) -> Column:
    """Booleans, numbers (not 0), and the usual words in any case; else null."""
    json, number = F.to_json(value), F.try_variant_get(value, "$", "double")
    word = F.lower(F.trim(F.try_variant_get(value, "$", "string")))
    return (
        F.when(json.isin("true", "false"), json == "true")
        .when(is_text(value), F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False))
        .when(number.isNotNull(), number != 0)
    )


def as_text(value: Column) -> Column:
    """Text; numbers as written; true as ``True``; "" for what is null, 0, false or empty."""
    json = F.to_json(value)
    plain = F.when(is_text(value), F.try_variant_get(value, "$", "string")).when(json == "true", "True").otherwise(json)
    return F.when(is_truthy(value), plain).otherwise("")


def is_present(value: Column) -> Column:
    json = F.to_json(value)
    return F.coalesce(~json.isin("null", '""'), F.lit(False))


def is_truthy(value: Column) -> Column:
    json, number = F.to_json(value), F.try_variant_get(value, "$", "double")
    zero = ~is_text(value) & F.coalesce(number == 0, F.lit(False))
    return F.coalesce(~json.isin("null", '""', "[]", "{}", "false") & ~zero, F.lit(False))


def first_present(*values: Column) -> Column:
    """The first value that is neither null nor empty text; 0, false and empty collections count."""
    return F.coalesce(*[F.when(is_present(v), v) for v in values])


def first_truthy(*values: Column) -> Column:
    return F.coalesce(*[F.when(is_truthy(v), v) for v in values])


def canonical_json(value: Column) -> Column:
    """Compact JSON with sorted keys. Numbers lose superfluous zeros, exponents read 1.0E-7."""
    return F.to_json(value)


def iso_utc(nanoseconds: Column) -> Column:
    """Nanoseconds since 1970 as ISO text in UTC with microseconds; the session's time zone has no part in it."""
    at = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.floor(nanoseconds / 1000).cast("decimal(18,0)") / 1_000_000)
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
