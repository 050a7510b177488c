"""Cleaning rules for text columns."""

from pyspark.sql import Column, functions as F

from tierline.schemas import NOT_INFORMED


def title(value: Column) -> Column:
    """Spaces trimmed, each space-separated word capitalised."""
    return F.initcap(F.trim(value))


def place(value: Column, blank_as_missing: bool = False) -> Column:
    """A title-cased location; NULL becomes the placeholder.

    Blank text stays blank unless ``blank_as_missing``: only NULL counts as missing
    by default, and a blank partition value reads back from the lake as NULL.
    """
    if blank_as_missing:
        value = F.when(F.trim(value) != "", value)
    return title(F.coalesce(value, F.lit(NOT_INFORMED)))


def digits(value: Column) -> Column:
    """ASCII digits only; NULL stays NULL."""
    return F.regexp_replace(value, r"\D", "")


def url(value: Column) -> Column:
    return F.lower(F.trim(value))


def number(value: Column) -> Column:
    """Text as double; anything unreadable is NULL, also in ANSI mode."""
    return value.try_cast("double")


def joined(*parts: Column) -> Column:
    """Non-NULL parts separated by one space; all NULL gives an empty string."""
    return F.concat_ws(" ", *parts)
