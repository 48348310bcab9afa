"""Dates written in many ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, bind, tidy

_YEAR_FIRST = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd", "yyyyMMdd")
_DAY_FIRST = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d/M/yyyy HH:mm", "d MMM yyyy", "d MMMM yyyy", "M/d/yyyy", "M-d-yyyy", "MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy")


def _first(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def flexible_timestamp(c: Column | str) -> Column:
    """Year-first text as ISO; other text day first, then month first; anything else is null. Times are UTC."""
    return bind(tidy(c), lambda text: F.when(text.rlike("^[0-9]{4}"), _first(text, _YEAR_FIRST)).otherwise(_first(text, _DAY_FIRST)))


def registry_date(c: Column | str) -> Column:
    """ISO date of the five formats that registries use; other text as it is."""
    formats = ("yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy", "dd-MM-yyyy", "d MMMM yyyy")
    return bind(tidy(c), lambda text: F.coalesce(F.date_format(_first(text, formats), "yyyy-MM-dd"), text))


def event_timestamp(c: Column | str, issued_at: Column) -> Column:
    """ISO time, UTC if it names no zone; bad text is the time of issue."""
    return F.coalesce(F.to_timestamp(_first(_col(c), _YEAR_FIRST)), issued_at)
