"""String helpers for identifiers, file names and locations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def part_of(text: Column, separator: str, position: int) -> Column:
    """Part number ``position`` (1-based, negative from the end); NULL if absent."""
    return F.try_element_at(F.split(text, f"\\Q{separator}\\E"), F.lit(position))


def base_name(path: Column) -> Column:
    return part_of(path, "/", -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]+$", "")


def with_suffix(name: Column, suffix: str) -> Column:
    return F.concat(stem(name), F.lit(suffix))


def contains_folded(text: Column, fragment: str) -> Column:
    return F.lower(text).contains(fragment.lower())


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def taxi_type_of(file_name: Column) -> Column:
    """Taxi type by the file-name *prefix*; empty for other files."""
    return F.regexp_extract(file_name, r"^(green|yellow)_", 1)
