"""Dates, numbers, arrays, maps, JSON and XML values as Column expressions."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def checked_date(text: str | None) -> str:
    """``YYYY-MM-DD`` or ValueError."""
    if text is None or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a date of the form YYYY-MM-DD: {text!r}")
    date.fromisoformat(text)
    return text


def day(ts: Column) -> Column:
    """The UTC day of an instant (the session runs in UTC)."""
    return F.to_date(ts)


def midnight(d: Column) -> Column:
    return d.cast("timestamp")


def from_epoch_ms(ms: Column) -> Column:
    """Zero is the epoch; null stays null."""
    return F.timestamp_millis(ms.cast("long"))


def from_rfc822(c: Column) -> Column:
    """``Wed, 30 Sep 2026 09:36:12 +0200`` or ``... GMT``; the weekday is optional, nonsense is null."""
    bare = F.trim(F.substring_index(c, ", ", -1))
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z"))
    )


def from_iso(c: Column) -> Column:
    """ISO text with an offset, ``Z`` or ``UTC``; nonsense is null."""
    return F.try_to_timestamp(c)


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Null where the whole is zero."""
    return F.round(F.try_divide(part * 100, whole), digits)


def gibibytes(n: Column, digits: int = 1) -> Column:
    return F.round(n / F.pow(F.lit(1024.0), F.lit(3)), digits)


def last_of(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def first_of(array: Column) -> Column:
    return F.get(array, F.lit(0))


def only_match(array: Column, test) -> Column:
    """The element that passes, if exactly one does."""
    found = F.filter(array, test)
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def match_else_first(array: Column, test) -> Column:
    return F.coalesce(F.get(F.filter(array, test), F.lit(0)), F.get(array, F.lit(0)))


def preferred_key(m: Column, *keys: str) -> Column:
    """The first of ``keys`` that the map has, else its smallest key, else null."""
    has = [F.when(F.map_contains_key(m, k), F.lit(k)) for k in keys]
    return F.coalesce(*has, F.array_min(F.map_keys(m)))


def json_scalar(c: Column, path: str) -> Column:
    """A JSON scalar as text; objects, arrays, JSON null and missing paths are null.

    The path's value is wrapped into a one-element array, so a scalar can be told from a text that
    only looks like an object.
    """
    value = F.get_json_object(c, path)
    variant = F.try_variant_get(F.try_parse_json(c), path, "variant")
    kind = F.schema_of_variant(variant)
    return F.when(~kind.rlike("^(OBJECT|ARRAY|VOID)"), value)


def json_array(c: Column, path: str) -> Column:
    """The elements of a JSON array as JSON texts; null if there is no array."""
    return F.from_json(F.get_json_object(c, path), "array<string>")


def required(c: Column, name: str) -> Column:
    """The value; a null stops the job, as a missing required field must."""
    return F.when(c.isNull(), F.raise_error(F.lit(f"required field {name} is missing"))).otherwise(c)
